"""Content-hash ids: a prefix and the first hex digits of the SHA-256 of canonical JSON (sorted keys, no blanks, ASCII)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_string(text: Column) -> Column:
    """A JSON string literal with everything beyond printable ASCII escaped; null is ``null``."""
    unit = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))

    def one(c: Column) -> Column:
        n = F.ascii(c)
        out = F.when(c == '"', '\\"').when(c == "\\", "\\\\").when(c == "\n", "\\n").when(c == "\r", "\\r").when(c == "\t", "\\t").when(c == "\b", "\\b").when(c == "\f", "\\f")
        out = out.when(n >= 65536, F.concat(unit(F.lit(0xD800) + F.shiftright(n - 65536, 10)), unit(F.lit(0xDC00) + (n - 65536) % 1024)))
        return out.when((n < 32) | (n > 126), unit(n)).otherwise(c)

    plain = F.concat(F.lit('"'), text, F.lit('"'))
    runs = F.regexp_extract_all(text, F.lit("(?s)[ !#-\\[\\]-~]+|."), F.lit(0))  # what needs no escape in one piece, anything else by itself
    escaped = F.concat(F.lit('"'), F.array_join(F.transform(runs, one), ""), F.lit('"'))
    return F.when(text.isNull(), "null").when(text == "", '""').when(text.rlike('^[ !#-\\[\\]-~]*\\z'), plain).otherwise(escaped)


def stable_id(prefix: str, length: int = 24, **fields: Column) -> Column:
    """Fields are JSON values as text already, e.g. json_string(...) or a number cast to string."""
    parts = []
    for i, (k, v) in enumerate(sorted(fields.items())):
        parts += [F.lit(("," if i else "{") + f'"{k}":'), F.coalesce(v, F.lit("null"))]
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(F.concat(*parts, F.lit("}")), 256), 1, length))
