"""Mixing sources to target weights by fitting a token budget exactly.

Targets share the whole corpus by weight; a source's target stops at ``most`` times its size and the excess is shared
anew. A source takes each of its documents floor(target / size) times, and the remaining budget is a subset-sum over
the number of documents of each exact length: each length first gives its share of documents, rounded down; what then
is open is filled longest first; the small rest is fitted by a bounded-knapsack dynamic programme, for which short
documents are given back where it can't be met otherwise. Which documents of a
length are taken is decided by a seeded hash, so reruns agree.
"""

from __future__ import annotations

import math
import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.llm.common import INNER, aside, salted_rank, salts, ship, table, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST_TIMES = 3
SEED = 20240607
#: A word: a run without space, tab, line feed, vertical tab, form feed, carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Names of the columns that the mix adds.
ADDED = ("size", "source_size", "target", "copies")
#: Shares and longest documents leave half so many budget words to the dynamic programme, if they can; and so many words
#: of short documents are given back to it where the rest isn't met exactly.
DP_WORDS = 1 << 14


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_order(sources: DataFrame, out: str) -> DataFrame:
    """Add out: the rank from 0 of each source by code point, null last.

    The catalogue is dealt by the two bytes that follow what all sources begin with; only counts of those parts, 65,538
    at most, meet in one task.
    """
    least, most = sources.agg(F.min("source"), F.max("source")).first()
    shared = len(os.path.commonprefix([(least or "").encode(), (most or "").encode()]))
    raw = F.encode("source", "utf-8")
    byte = lambda i: F.coalesce(F.conv(F.nullif(F.hex(F.substring(raw, shared + i, 1)), F.lit("")), 16, 10).cast("int") + 1, F.lit(0))
    part = F.when(F.col("source").isNull(), F.lit(1 << 17)).otherwise(byte(1) * 257 + byte(2))
    return salted_rank(sources, [], part, [F.col("source").asc_nulls_last()], out, 1 << 17)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_TIMES) -> DataFrame:
    """From (source, source_size) make (source, source_size, weight, target).

    Sources in code-point order, null last, get the weights in turn. target = min(most * size, level * weight), with
    the level found by sharing the excess anew until no source is above; a source of size 0 has target 0. The catalogue
    of sources is one row a source, and only sums over it come to the driver.
    """
    at = f"{INNER}at"
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col(at) % len(weights) + 1).cast("int"))
    rows = written(in_order(written(sizes, "sources"), at).withColumn("weight", w).drop(at), "weighted")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, None
    while True:
        above = F.lit(False) if capped is None else F.col("source_size") * float(most) <= F.lit(capped) * F.col("weight")
        held, open_weight = rows.agg(F.sum(F.when(above, F.col("source_size") * float(most)).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        level = (total - (held or 0.0)) / open_weight if open_weight else math.inf
        if capped is not None and level <= capped:
            break
        capped = level
        if not math.isfinite(level):
            break
    cap = F.col("source_size") * float(most)
    return rows.withColumn("target", cap if not math.isfinite(level) else F.least(cap, F.lit(level) * F.col("weight")))


def nearest(sizes: list[int], counts: list[int], budget: int) -> tuple[list[int], int]:
    """How many of each size come nearest to the budget, and how far off they are: a bounded knapsack over bits."""
    # a sum beyond twice the budget is no nearer than none
    limit = min(2 * budget, budget + max((s for s, n in zip(sizes, counts) if n), default=0))
    mask, reach, steps = (1 << (limit + 1)) - 1, 1, []  # bit n of reach: n words can be had
    for i, (size, have) in enumerate(zip(sizes, counts)):
        if not size or not have or size > limit:
            continue
        k, have = 1, min(have, limit // size)
        while have and not reach >> budget & 1:  # binary parts of the bounded count
            k = min(k, have)
            steps.append((i, k, reach))
            reach |= (reach << (k * size)) & mask
            have -= k
            k *= 2
    at = next(n for off in range(budget + 1) for n in (budget - off, budget + off) if reach >> n & 1)
    off, out = abs(at - budget), [0] * len(sizes)
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            at -= k * sizes[i]
            out[i] += k
    return out, off


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many documents of each size to take, so that their words together come near to the budget.

    Every size gives its share, then the longest documents that fit are taken; the rest is fitted as near as the
    documents still open allow, long ones among them. Where that isn't exact, shares of short documents, dp_words words
    of them, are given back and fitted with the rest anew; so a budget of up to dp_words words is met as near as any
    choice of documents can.
    """
    order = np.argsort(-sizes)
    s, c = [int(x) for x in sizes[order]], [int(x) for x in counts[order]]
    total = sum(a * b for a, b in zip(s, c))
    if budget <= 0 or not total:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return counts.astype(np.int64)
    take = [n * budget // total for n in c]
    rest = budget - sum(a * t for a, t in zip(s, take))
    room = dp_words // 2
    for i, size in enumerate(s):  # longest first, but leave what the dynamic programme can fit, a longer open document too
        k = min(c[i] - take[i], max(0, rest - room) // size) if size else 0
        take[i] += k
        rest -= k * size
        room = max(room, size) if take[i] < c[i] else room
    for i in range(len(s) - 1, -1, -1):  # what is still open beyond the table goes to short documents
        if rest < dp_words:
            break
        k = min(c[i] - take[i], max(0, rest - room) // max(1, s[i]))
        take[i] += k
        rest -= k * s[i]
    more, off = nearest(s, [n - t for n, t in zip(c, take)], rest)
    if off:
        kept, again, left = list(take), rest, dp_words
        for i in range(len(s) - 1, -1, -1):
            back = min(kept[i], left // s[i]) if s[i] else 0
            kept[i] -= back
            left, again = left - back * s[i], again + back * s[i]
        other, nearer = nearest(s, [n - t for n, t in zip(c, kept)], again)
        if nearer < off:
            take, more = kept, other
    out = np.zeros(len(sizes), np.int64)
    out[order] = [a + b for a, b in zip(take, more)]
    return out


def sized(docs: DataFrame) -> DataFrame:
    """A written table of doc_id, source, the text's hash and its size: the only pass over the texts."""
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64(F.col("text").cast("string")).alias("h"), word_count(F.col("text").cast("string")).alias("size")), "sized")


def mix_sizes(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_TIMES, seed: int = SEED) -> DataFrame:
    """Add source_size, target and copies to a written table of doc_id, source, h and size."""
    ship(rows.sparkSession)
    counts = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "lengths")
    targets = written(source_targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size")), weights, most), "targets")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = min(int(target // size), most) if size else 0
        rest = 0 if whole >= most else int(round(target - whole * size))
        pdf["whole"] = whole
        pdf["more"] = fit_budget(pdf["size"].to_numpy(np.int64), pdf["docs"].to_numpy(np.int64), rest)
        return pdf[["source", "size", "source_size", "target", "whole", "more"]]

    lengths = counts.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "weight")
    fitted = lengths.groupBy("source").applyInPandas(fit, "source string, size long, source_size long, target double, whole int, more long")
    f = written(fitted, "fitted").withColumnsRenamed({"source": "fs", "size": "fz"})
    parts, rank = salts(rows.sparkSession), f"{INNER}rank"
    chance = F.xxhash64(F.col("doc_id"), F.lit(seed))
    ranked = salted_rank(rows, ["source", "size"], F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), F.lit(parts)).cast("int"), [chance.asc(), F.col("doc_id").asc(), F.col("h").asc()], rank, parts)
    joined = ranked.join(f, F.col("source").eqNullSafe(F.col("fs")) & (F.col("size") == F.col("fz")), "left")
    return joined.select(*rows.columns, "source_size", "target", (F.col("whole") + (F.col(rank) < F.col("more")).cast("int")).cast("int").alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_TIMES, seed: int = SEED) -> DataFrame:
    """Add size, source_size, target and copies (how often the mix takes the document) to docs.

    Nulls: a null text has size 0, a null source is a source of its own. A document of size 0 is taken once if its
    source takes all its documents at least once. Repeated rows are documents of their own. Other columns stay; columns
    with the added names are replaced.
    """
    docs = docs.select(*(c for c in docs.columns if c.lower() not in ADDED))
    plan = mix_sizes(sized(docs), weights, most, seed)
    d, s, h, rows, total, n = (f"{INNER}{x}" for x in ("d", "s", "h", "rows", "total", "n"))
    # rows alike in doc_id, source and text share their copies evenly
    alike = plan.groupBy(F.col("doc_id").alias(d), F.col("source").alias(s), F.col("h").alias(h)).agg(
        F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.count(F.lit(1)).alias(rows), F.sum("copies").alias(total))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & F.col("source").cast("string").eqNullSafe(F.col(s)) & (F.xxhash64(F.col("text").cast("string")) == F.col(h))
    found = docs.join(alike, on)
    share = lambda at: (F.floor(F.col(total) / F.col(rows)) + (at <= F.col(total) % F.col(rows)).cast("int")).cast("int")
    out = [*docs.columns, "size", "source_size", "target"]
    single = found.where(F.col(rows) == 1).select(*out, F.col(total).cast("int").alias("copies"))
    several = found.where(F.col(rows) > 1).withColumn(n, F.row_number().over(Window.partitionBy(d, s, h).orderBy(F.col(d))))
    return single.unionByName(several.select(*out, share(F.col(n)).alias("copies")))


def taken(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_TIMES, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with the columns of docs and their values."""
    held, back = aside(docs, ADDED)
    mixed = mix(held, weights, most, seed).where("copies > 0")
    return back(mixed.withColumn(f"{INNER}copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))


def op5_source_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents, a row a document; see ``mix`` for nulls, empty texts and repeated rows."""
    rows = mix_sizes(sized(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
