"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A line's hash is the first 28 bits of its MD5; a rolling polynomial hash over WINDOW line hashes, modulo a prime, ends a
chunk wherever it is divisible by DIVISOR, so that an inserted line moves no other boundary than those near it, and a
chunk of more than MAX_LINES lines is cut every MAX_LINES. Of a chunk of MIN_LINES or more lines that stands in several
places, the first place (by doc_id, then position) is kept and the others are removed, after their bytes were compared
with the kept place's.

Lines are chunked twice: with every boundary, and with boundaries left out until MIN_LINES lines are gathered, a short
last chunk joined to the one before. In the second chunking each line of a text of MIN_LINES lines is in a chunk long
enough; the first finds short repeated runs whose surroundings differ. A line goes if a repeated chunk of either has it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.frames import shuffles_removed
from claimweft.llm.common import INNER, table, written

WINDOW = 3
DIVISOR = 3
MIN_LINES = 2
MAX_LINES = 64
#: So many of the most frequent chunks are dealt to DEALS tasks each.
HOT, DEALS = 1000, 32
PRIME = 2**31 - 1
FACTORS = tuple(pow(1_000_003, k + 1, PRIME) for k in range(WINDOW))


def _fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns so that later expressions, lambdas among them, read their values and don't compute them anew."""
    s = f"{INNER}s"
    return df.select("*", F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias(s)).select(*df.columns, *(F.col(f"{s}.{n}").alias(n) for n in columns))


def chunked(docs: DataFrame, leasts: tuple[int, ...] = (MIN_LINES, 1)) -> DataFrame:
    """Add __cw_lines and __cw_chunks to docs: the lines, and the distinct chunks of the chunkings with these least
    lengths, each with its first line ``at``, its number of lines ``n`` and its ``text``. A null text is an empty one.
    """
    lines, hashes, bits = f"{INNER}lines", f"{INNER}hashes", f"{INNER}bits"
    out = _fixed(docs, **{lines: F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)})
    out = _fixed(out, **{hashes: F.transform(lines, lambda line: F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long"))})
    last = F.size(lines) - 1

    def rolled(i: Column) -> Column:
        return sum((F.when(i >= k, F.element_at(hashes, (i - k + 1).cast("int"))).otherwise(0) * FACTORS[k] for k in range(WINDOW)), F.lit(0)) % PRIME

    # a digit a line, 1 where a chunk may end; the 1 ahead of the first line is the text's start
    out = _fixed(out, **{bits: F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: F.when(rolled(i) % DIVISOR == 0, "1").otherwise("0")), "")})
    starts = {f"{INNER}starts{least}": F.split(F.regexp_replace(F.concat(F.lit("1"), bits), f"1[01]{{{least - 1}}}", "1" + "0" * (least - 1)), "") for least in leasts}
    out = _fixed(out, **starts)

    def pieces(least: int, of: str) -> Column:
        ends = F.filter(F.sequence(F.lit(0), last), lambda i: (F.element_at(of, i + 2) == "1") & (last - i >= least))
        from_, to = F.concat(F.array(F.lit(-1)), ends), F.concat(ends, F.array(last))
        each = lambda a, b: F.transform(F.sequence(a, F.greatest(a, b - least), F.lit(MAX_LINES)), lambda x: F.struct((x + 1).alias("at"), F.when(x + MAX_LINES <= b - least, MAX_LINES).otherwise(b - x).alias("n")))
        return F.flatten(F.zip_with(from_, to, each))

    places = F.array_distinct(F.concat(*(pieces(least, of) for least, of in zip(leasts, starts))))
    text = lambda c: F.struct(c["at"].alias("at"), c["n"].alias("n"), F.array_join(F.slice(lines, c["at"] + 1, c["n"]), "\n").alias("text"))
    return _fixed(out, **{f"{INNER}chunks": F.transform(places, text)}).drop(hashes, bits, *starts)


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, leasts: tuple[int, ...] | None = None) -> DataFrame:
    """Replace ``text`` of docs by what is kept of it and add n_lines, n_removed (lines) and n_chunks (removed chunks).

    ``leasts`` are the least lengths of the chunkings, (min_lines, 1) unless given. Every row stays, other columns too
    (clashing names are replaced). A null text stays null, with no line removed; an empty text is one empty line. Rows
    alike in doc_id and text are treated alike: what either keeps, both keep. A null doc_id comes first. Texts with
    equal hashes but other bytes than the kept place's stay.
    """
    leasts = (min_lines, 1) if leasts is None else leasts
    docs = docs.drop("n_lines", "n_removed", "n_chunks")
    row = [F.col("doc_id").alias("d"), F.xxhash64(F.col("text").cast("string")).alias("h")]
    each = chunked(docs.select("doc_id", "text"), leasts).select(*row, F.explode(f"{INNER}chunks").alias("c")).where(F.col("c.n") >= min_lines)
    # keys only: which chunks are repeated at all, and where each stands first
    keyed = each.select(F.md5("c.text").alias("key"), "d", "h", F.struct("c.at", "c.n").alias("at"), F.col("c.text").alias("chunk"))
    place = F.struct("d", "h", "at")
    repeated = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("places"), F.min(place).alias("first")).where("places > 1"), "repeated")
    # the most frequent chunks are dealt to several tasks each; any other has no more than a HOTth of all places
    hot = repeated.orderBy(F.col("places").desc(), "key").limit(HOT).select(F.col("key").alias("hot_key"))
    dealt = lambda df, salt: df.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left").withColumn("deal", F.when(F.col("hot_key").isNotNull(), salt).otherwise(F.lit(0))).drop("hot_key")
    every = lambda df: df.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left").withColumn("deal", F.explode(F.sequence(F.lit(0), F.when(F.col("hot_key").isNotNull(), DEALS - 1).otherwise(0)))).drop("hot_key")
    firsts = every(repeated).select(F.col("key").alias("k"), F.col("deal").alias("k_deal"), "first")
    salted = dealt(keyed, F.pmod(F.xxhash64("d", "h"), F.lit(DEALS)).cast("int"))
    with shuffles_removed(docs.sparkSession):  # the texts of all chunks were shuffled for it, and those of documents are next
        held = written(salted.join(firsts, (F.col("key") == F.col("k")) & (F.col("deal") == F.col("k_deal"))).select("key", "deal", "d", "h", "at", "chunk", (place == F.col("first")).alias("kept")), "chunks")
    kept = every(held.where("kept").groupBy("key").agg(F.min("chunk").alias("bytes"))).select(F.col("key").alias("k"), F.col("deal").alias("k_deal"), "bytes")
    gone = held.where(~F.col("kept")).join(kept, (F.col("key") == F.col("k")) & (F.col("deal") == F.col("k_deal")) & (F.col("chunk") == F.col("bytes"))).groupBy("d", "h").agg(F.array_distinct(F.collect_list("at")).alias("gone"))
    full = docs.join(
        gone.withColumnsRenamed({"d": f"{INNER}d", "h": f"{INNER}h", "gone": f"{INNER}gone"}),
        F.col("doc_id").eqNullSafe(F.col(f"{INNER}d")) & (F.xxhash64(F.col("text").cast("string")) == F.col(f"{INNER}h")), "left",
    )
    gone_at, lines, left = f"{INNER}gone", f"{INNER}lines", f"{INNER}left"
    full = full.withColumn(gone_at, F.coalesce(F.col(gone_at), F.array().cast("array<struct<at:int,n:int>>")))
    full = _fixed(full, **{lines: F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)})
    full = _fixed(full, **{f"{INNER}out": F.array_distinct(F.flatten(F.transform(gone_at, lambda g: F.sequence(g["at"], g["at"] + g["n"] - 1))))})
    full = _fixed(full, **{left: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), f"{INNER}out")})
    texts = F.transform(left, lambda i: F.element_at(lines, i + 1))
    count = lambda n: F.when(F.col("text").isNull(), 0).otherwise(n).cast("long")
    return full.select(
        *(F.when(F.col("text").isNull(), F.lit(None)).when(F.size(gone_at) == 0, F.col("text").cast("string")).otherwise(F.array_join(texts, "\n")).alias("text") if c == "text" else F.col(c) for c in docs.columns),
        count(F.size(lines)).alias("n_lines"), count(F.size(f"{INNER}out")).alias("n_removed"), F.size(gone_at).cast("long").alias("n_chunks"),
    )


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document, as counts and a digest; see ``dedup_lines`` for nulls, ties and repeated rows."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "n_chunks", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: In a stretch of neighbouring boundaries every second one is kept (the text's start counts as one): MIN_LINES is 2.
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, i, l, ('0x' || substr(md5(l), 1, 7))::BIGINT AS h
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents)
), cuts AS (
  SELECT *, ({" + ".join(f"coalesce(lag(h, {k}) OVER w, 0) * {f}" for k, f in enumerate(FACTORS))}) % {PRIME} % {DIVISOR} = 0 AS cut, max(i) OVER (PARTITION BY doc_id) AS last FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), stretches AS (
  SELECT *, coalesce(max(i) FILTER (WHERE NOT cut) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING), -2) AS unbroken FROM cuts
), chunkings AS (
  SELECT 1 AS least, doc_id, i, l, cut FROM stretches
  UNION ALL SELECT 2, doc_id, i, l, cut AND (i - unbroken) % 2 = 1 AND last - i >= 2 FROM stretches
), numbered AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY least, doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM chunkings
), counted AS (
  SELECT *, i - min(i) OVER (PARTITION BY least, doc_id, c) AS j, count(*) OVER (PARTITION BY least, doc_id, c) AS size FROM numbered
), chunks AS (
  SELECT DISTINCT doc_id, b, n, chunk FROM (
    SELECT doc_id, min(i) AS b, count(*) AS n, string_agg(l, chr(10) ORDER BY i) AS chunk FROM counted GROUP BY least, doc_id, c, least(j // {MAX_LINES}, greatest(0, (size - least) // {MAX_LINES}))) WHERE n >= {MIN_LINES}
), gone AS (
  SELECT doc_id, b, n FROM chunks QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY doc_id, b, n) > 1
), removed AS (
  SELECT DISTINCT doc_id, unnest(range(b, b + n)) AS i FROM gone
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(removed.i)::BIGINT AS n_removed, coalesce(any_value(g.n), 0)::BIGINT AS n_chunks,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE removed.i IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN removed USING (doc_id, i) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id) GROUP BY doc_id
"""
