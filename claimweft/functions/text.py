"""Text rules as Column expressions. Words are bounded by anything that is no letter, digit or underscore."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules: word lists and patterns, written so that Java's and RE2's regular expressions agree.
CLAIM_VERBS = "is|are|was|were|has|had|have|contains|uses|requires|causes|indicates|reports|reported|found|observed|measured|increased|decreased|saw|heard|replaced|will|plan|plans|committed|should|must|can|cannot|did|does|failed|lacks"
NUMBER_OR_DATE = "[0-9]+|yesterday|today|tomorrow|last week|next week"
NEGATION = "not|no|never|without|neither|failed to|lacks|cannot|can't|won't|didn't|doesn't"
UNCERTAINTY = "appears|seems|may|might|likely|allegedly|reportedly|possibly|suggests|maybe"
COREFERENCE = "it|they|them|this|that|these|those|he|she|him|her|its|their"
LOW_VALUE = ("ok", "okay", "thanks", "thank you", "hi", "hello", "yes", "no", "lol", "great", "sure")
NUMBER_WORDS = "zero|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty"
UNITS = "masts?|engines?|meters?|metres?|feet|foot|ft|inches|inch|in|cm|mm|km|miles?|mi|kg|g|lbs?|pounds?|oz|tons?|hours?|hrs?|minutes?|mins?|seconds?|secs?|days?|weeks?|months?|years?|liters?|litres?|gallons?|percent|%"
NOT_ENTITIES = ("I", "The", "A", "An", "This", "That", "It", "They", "He", "She", "OCR", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
EMAIL = "(?:(?<![\\p{L}\\p{N}_])(?=[A-Za-z0-9_])|(?<=[\\p{L}\\p{N}_])(?=[.%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}(?![\\p{L}\\p{N}_])"
PHONE = "(?<!\\d)(?:\\+?1[\\s.-]?)?(?:\\(?\\d{3}\\)?[\\s.-]?)\\d{3}[\\s.-]?\\d{4}(?!\\d)"
SSN = "\\b\\d{3}-\\d{2}-\\d{4}\\b"
# The same as pii_redact's SQL has them: words and blanks are ASCII, a phone number takes the characters around it.
_EDGE = "(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
_GAP = "[\\t\\n\\f\\r .-]?"
SQL_EMAIL = f"{_EDGE}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}{_EDGE}"
SQL_NUMBER, SQL_AROUND = f"(?:\\+?1{_GAP})?(?:\\(?[0-9]{{3}}\\)?{_GAP})[0-9]{{3}}{_GAP}[0-9]{{4}}", ("\\A|[^0-9]", "\\z|[^0-9]")
SQL_PHONE = f"({SQL_AROUND[0]}){SQL_NUMBER}({SQL_AROUND[1]})"
SQL_SSN = f"{_EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_EDGE}"

VALUE = f"(?:[0-9]+(?:\\.[0-9]+)?|{NUMBER_WORDS})"
QUANTITY = (
    "(?i)\\b(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}|[0-9]{1,2}:[0-9]{2}(?:\\s?[ap]m)?|yesterday|today|tomorrow|last week|next week|"
    f"{VALUE}\\s*(?:-|to)\\s*{VALUE}(?:\\s+(?:{UNITS}))?|{VALUE}\\s+(?:{UNITS})|[0-9]+(?:\\.[0-9]+)?%?|{NUMBER_WORDS})\\b"
)
# Capitalised words of ASCII letters in a run; a word ends where a letter, digit or underscore meets anything else.
WORD_END = "(?:(?<=[A-Za-z0-9_])(?![\\p{L}\\p{N}_])|(?<=-)(?=[\\p{L}\\p{N}_]))"
BLANK = "[\\s\\p{Z}\\x{1c}-\\x{1f}\\x{85}]"
ENTITY = f"(?<![\\p{{L}}\\p{{N}}_])[A-Z][A-Za-z0-9_-]*(?:{BLANK}+[A-Z][A-Za-z0-9_-]*)*{WORD_END}"
SENTENCE = "[^.!?\n]++(?:[.!?]++|\n|\\z)"


def bounded(alternatives: str) -> str:
    return f"(?i)(^|[^\\p{{L}}\\p{{N}}_])({alternatives})($|[^\\p{{L}}\\p{{N}}_])"


def has_word(text: Column, alternatives: str) -> Column:
    return text.rlike(bounded(alternatives))


def strip(text: Column) -> Column:
    """Without white space at both ends, of every kind; most texts have none, which their ends tell."""
    return F.when(F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1)).rlike(BLANK), F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")).otherwise(text)


def sentences(text: Column) -> Column:
    """Array of trimmed sentences. An unterminated line counts only where the text ends; terminators stay."""
    found = F.regexp_extract_all(F.regexp_replace(text, "\n\\z", ""), F.lit(SENTENCE), F.lit(0))
    whole = F.filter(found, lambda s: ~F.endswith(s, F.lit("\n")))
    return F.filter(F.transform(whole, strip), lambda s: s != "")


def pieces(text: Column) -> Column:
    """The text cut into what may be a sentence, with what ends it, and stretches of terminators and line ends."""
    return F.regexp_extract_all(text, F.lit("[^.!?\n]++(?:[.!?]++|\n|\\z)|[.!?\n]++"), F.lit(0))


def claim_signs(text: Column) -> Column:
    """The sum of the weights of a segment's signs of a claim."""
    add = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0.0))
    return (
        F.lit(0.0) + add(has_word(text, CLAIM_VERBS), 0.45) + add(has_word(text, NUMBER_OR_DATE), 0.2) + add(has_word(text, NEGATION), 0.15)
        + add(has_word(text, UNCERTAINTY), 0.15) + add(F.endswith(strip(text), F.lit("?")), 0.4)
    )


def span_score(text: Column, signs: Column | None = None) -> Column:
    """How likely a segment bears a claim, .95 at most; null where it is blank, small talk or has no sign of a claim.

    ``signs`` are its ``claim_signs``, where they are computed already.
    """
    plain, total = F.lower(strip(text)), claim_signs(text) if signs is None else signs
    return F.when((plain == "") | plain.isin(*LOW_VALUE) | (total <= 0), F.lit(None).cast("double")).otherwise(F.least(total, F.lit(0.95)))


def modality(text: Column) -> Column:
    return F.when(F.endswith(strip(text), F.lit("?")), "question_asked").when(has_word(text, NEGATION), "negated").when(has_word(text, UNCERTAINTY), "uncertain_observation").otherwise("asserted")


def quantities(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(QUANTITY), F.lit(0)), lambda q: F.lower(q))))


def entities(text: Column) -> Column:
    return F.array_sort(F.array_except(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), strip)), F.array(*map(F.lit, NOT_ENTITIES))))


#: Letters whose upper case is several letters, and what stands for each where a letter stays one: DuckDB's upper has the latter.
_LONG = [c for c in map(chr, range(0x10000)) if len(c.upper()) > 1]
#: Letters to which Unicode 16 gave an upper case, which DuckDB's does not know.
_NEW = "".join(map(chr, (0x19B, 0x264, 0x1C8A, 0xA7CD, 0xA7DB, *range(0x10D70, 0x10D86))))
_LONG_IN, _LONG_OUT = "".join(_LONG) + _NEW, "".join("ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in _LONG) + _NEW


def simple_upper(text: str) -> str:
    """Spark's SQL for the upper case letter by letter, as DuckDB has it; Spark's own writes SS for ß."""
    runs = f"regexp_extract_all({text}, '[{_LONG_IN}]+|[^{_LONG_IN}]+', 0)"
    return f"CASE WHEN {text} RLIKE '[{_LONG_IN}]' THEN array_join(transform({runs}, r -> CASE WHEN r RLIKE '^[{_LONG_IN}]' THEN translate(r, '{_LONG_IN}', '{_LONG_OUT}') ELSE upper(r) END), '') ELSE upper({text}) END"


def slug(text: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(s == "", "unknown").otherwise(s)


def canonical_id(prefix: Column, text: Column) -> Column:
    return F.concat(prefix, F.lit(":"), slug(text))


#: What cleaning does, in order: name, pattern, replacement. Patterns begin with what is rare and match only what they change.
CLEANING = (("repair_hyphenation", "-\n(?<=[\\p{L}\\p{N}_]-\n)(?=[\\p{L}\\p{N}_])", ""), ("join_wrapped_lines", "\n(?<!\n\n)(?!\n)", " "), ("collapse_whitespace", "[ \t]{2,}|\t", " "))


def clean_block(text: Column) -> Column:
    """Hyphenation repaired, single line ends to spaces, runs of blanks to one. The steps leave the ends of a stripped text."""
    t = strip(text)
    for _, pattern, to in CLEANING:
        t = F.regexp_replace(t, pattern, to)
    return t


def cleanup_actions(text: Column, cleaned: Column | None = None) -> Column:
    """Names of the cleaning steps that change the text, in order; ``cleaned`` is the cleaned text, where it is known.

    No step undoes another: they shorten a text or take line ends and tabs out of it. One that stays as it was had none.
    """
    t, out = strip(text), []
    for name, pattern, to in CLEANING:
        after = F.regexp_replace(t, pattern, to)
        out.append(F.when(after != t, name))
        t = after
    names = F.array_compact(F.array(*out))
    return names if cleaned is None else F.when(strip(text) == cleaned, F.array().cast("array<string>")).otherwise(names)


def furniture_signature(text: Column, cleaned: bool = False) -> Column:
    """``cleaned``: the text is a cleaned block's."""
    return F.regexp_replace(F.regexp_replace(F.lower(text if cleaned else clean_block(text)), "\\b[0-9]+\\b", "#"), "\\s+", " ")
