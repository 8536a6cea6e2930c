"""SimHash fingerprints and the search for all fingerprints within a Hamming radius.

Terms are runs of TERM_WORDS words (all words together in a shorter text), weighted by their number of occurrences.
Each occurrence votes by its 128 hash bits; a bit of the fingerprint is set where the votes for it are above zero.
The search cuts fingerprints into blocks with a small radius each, which add up to radius - blocks + 1: two fingerprints
within the radius are within a block's radius at one block at least. Each fingerprint is in one table a block, keyed by
its bits there; each query looks up all keys within the block's radius of its own.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.llm.common import INNER, flat, lean, mix, row_bounds, ship, slices, table, tasks, words, written

BITS = 128
TERM_WORDS = 3
#: Five-word Jaccard 0.8 (20 words changed in 1000) puts texts 7 to 20 bits apart.
RADIUS = 20
#: The most keys that a query looks up; of the cuts into blocks that need no more, the one with the longest blocks is used.
MOST_KEYS = 2000
#: Bytes of text of a run of neighbouring documents, which is a task.
RUN_BYTES = 256 << 20


def terms(data: np.ndarray, offsets: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Row number and 64-bit hash of each run of n_words words; a shorter text that is not empty is one run."""
    _, _, h, rows = words(data, offsets)
    bounds = row_bounds(rows, len(offsets) - 1)
    count = np.diff(bounds)
    place = np.arange(len(h)) - bounds[rows]
    total = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n_words):
            part = np.zeros(len(h), np.uint64)
            part[: max(0, len(h) - k)] = h[k:]
            if k:
                part[place + k >= count[rows]] = 0  # past the text's end, in texts shorter than a run
            total += mix(part + np.uint64(k + 1)) * np.uint64(2 * k + 1)
    first = place + n_words <= np.maximum(count[rows], n_words)
    return rows[first], mix(total[first])


_SIGNS = np.where(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) > 0, 1.0, -1.0)


def simhash(column: pa.Array, n_words: int = TERM_WORDS) -> np.ndarray:
    """(rows, BITS / 8) bytes: the fingerprint of each text; an empty or null one has none of its bits set."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    rows, h = terms(data, offsets, n_words)
    out = np.zeros((n, BITS // 8), np.uint8)
    for word in range(BITS // 64):
        with np.errstate(over="ignore"):
            v = mix(h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(word + 1))
        for b in range(8):
            byte = ((v >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)
            votes = np.bincount(rows * 256 + byte, minlength=n * 256).reshape(n, 256) @ _SIGNS
            out[:, 8 * word + b] = np.packbits(votes > 0, axis=1)[:, 0]
    return out


_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1.0 - _ONES[a ^ b].sum(axis=1) / BITS


def fingerprint(docs: DataFrame, n_words: int = TERM_WORDS) -> DataFrame:
    """Add a column ``fingerprint`` (hex) to docs, from ``text``; one of that name is replaced. Needs no shuffle.

    Null, empty and blank texts have the fingerprint without bits; equal texts have equal ones; other columns stay.
    """
    ship(docs.sparkSession)
    docs = docs.drop("fingerprint")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x.tobytes().hex() for x in simhash(part.column("text"), n_words)])], [*part.schema.names, "fingerprint"])

    return docs.mapInArrow(lean(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", fingerprint string")


def block_plan(radius: int, most_keys: int = MOST_KEYS) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each block, of the least number of blocks with at most so many keys in all, else the least keys."""
    plans = []
    for n in range(1, radius + 2):
        cuts = [i * BITS // n for i in range(n + 1)]
        wide = sorted(range(n), key=lambda i: cuts[i] - cuts[i + 1])  # longer blocks get what does not go round
        each, more = divmod(radius - n + 1, n)
        plan = [(cuts[i], cuts[i + 1] - cuts[i], each + (i in wide[:more])) for i in range(n)]
        if max(bits for _, bits, _ in plan) <= 64:
            plans.append((sum(math.comb(bits, k) for _, bits, t in plan for k in range(t + 1)), plan))
    return next((p for keys, p in plans if keys <= most_keys), min(plans)[1] if plans else [(0, 64, 0)])


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each distinct fingerprint of queries, each distinct one of prints within the radius, and how many rows have it.

    Returns fingerprint, other, distance, rows. Equal fingerprints are one row here however many documents have them;
    a pair that meets in several tables is kept in the first. Null fingerprints match nothing. The search is exact.
    """
    if not 0 <= radius < BITS:
        raise ValueError(f"the radius is from 0 to {BITS - 1}")
    plan = block_plan(radius)

    def cut(high: Column, low: Column, at: int, bits: int) -> Column:
        end = at + bits
        low = F.shiftrightunsigned(low, BITS - end)
        part = F.shiftrightunsigned(high, 64 - end) if end <= 64 else low if at >= 64 else F.shiftleft(high, end - 64).bitwiseOR(low)
        return part.bitwiseAND(F.lit((1 << bits) - 1)) if bits < 64 else part

    half = lambda c, i: F.conv(F.substring(c, 1 + 16 * i, 16), 16, -10).cast("long")
    mine = queries.where(F.col("fingerprint").isNotNull()).select("fingerprint").distinct().select(half("fingerprint", 0).alias("qh"), half("fingerprint", 1).alias("ql"))
    theirs = prints.where(F.col("fingerprint").isNotNull()).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows")).select(half("fingerprint", 0).alias("oh"), half("fingerprint", 1).alias("ol"), "rows")
    at = lambda h, l: F.array(*(F.struct(F.lit(i).alias("block"), cut(F.col(h), F.col(l), a, b).alias("bits")) for i, (a, b, _) in enumerate(plan)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    flips = [(i, signed(sum(1 << j for j in on))) for i, (_, b, t) in enumerate(plan) for k in range(t + 1) for on in itertools.combinations(range(b), k)]
    masks = queries.sparkSession.createDataFrame(flips, "block int, flip long")  # a bound fixed by the radius
    keys = mine.withColumn("key", F.explode(at("qh", "ql"))).select("qh", "ql", F.col("key.block").alias("block"), F.col("key.bits").alias("own"))
    asked = keys.join(F.broadcast(masks), "block").select("qh", "ql", "block", F.col("own").bitwiseXOR(F.col("flip")).alias("bits"))
    held = theirs.withColumn("key", F.explode(at("oh", "ol"))).select("oh", "ol", "rows", F.col("key.block").alias("block"), F.col("key.bits").alias("bits"))
    high, low = F.col("qh").bitwiseXOR(F.col("oh")), F.col("ql").bitwiseXOR(F.col("ol"))
    distance = (F.bit_count(high) + F.bit_count(low)).cast("int")
    met = F.lit(True)
    for i, (a, b, t) in enumerate(plan):
        met = met & ((F.col("block") <= i) | (F.bit_count(cut(high, low, a, b)) > t))
    pairs = asked.join(held, ["block", "bits"]).where((distance <= radius) & met)
    name = lambda h, l: F.lower(F.concat(F.lpad(F.hex(h), 16, "0"), F.lpad(F.hex(l), 16, "0")))
    return pairs.select(name("qh", "ql").alias("fingerprint"), name("oh", "ol").alias("other"), distance.alias("distance"), "rows")


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Deal docs (doc_id, text) to tasks so that each task sees runs in descending doc_id, each followed by the run's
    next document: columns run, ahead (1 for that extra document), doc_id, text, sorted within partitions.

    Rows with one doc_id are ordered by text, null last; a null doc_id comes after all others; the last document is
    followed by the first. Cut points are quantiles of doc_id, at most ``parts``; a row's run is found by bisection.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    cuts = d.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], max(10_000, 4 * parts))).first()[0] or []
    cuts = sorted(set(cuts))
    edges = F.from_json(F.lit(json.dumps(cuts)), "array<bigint>")
    steps = [1 << k for k in range(len(cuts).bit_length(), -1, -1)]
    bisected = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    runs = d.withColumn("run", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - bisected).cast("int"))
    heads = sorted(runs.groupBy("run").agg(F.max("doc_id").alias("doc_id")).collect(), key=lambda r: r["run"])  # one row a run
    follow = [(r["doc_id"], heads[i - 1]["run"]) for i, r in enumerate(heads)]  # the run before gets it
    to = spark.createDataFrame(follow, "doc_id long, to int").withColumnRenamed("doc_id", f"{INNER}d")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last()))
    head = F.col("doc_id").eqNullSafe(F.col(f"{INNER}d"))
    near = d.join(F.broadcast(to), head).withColumn("n", first).where("n = 1")  # a row or two a run
    both = runs.select("run", F.lit(0).alias("ahead"), "doc_id", "text").unionByName(near.select(F.col("to").alias("run"), F.lit(1).alias("ahead"), "doc_id", "text"))
    return both.repartitionById(len(cuts) + 2, "run").sortWithinPartitions("run", "ahead", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_last())


def op7_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and how many others are within RADIUS of every hundredth.

    A null text is an empty one, whose fingerprint has no bit set. Rows with one doc_id follow each other by text; a null
    doc_id comes last and is not looked up (n_within is null). An empty table gives an empty one.
    """
    ship(spark)
    docs = table(spark, sf_dir, "documents")

    def run(batches):
        held = None
        for batch in batches:
            for part in slices(batch, "text"):
                rows = pa.Table.from_batches([part] if held is None else [held, part]).combine_chunks()
                held = part.slice(part.num_rows - 1)
                if rows.num_rows < 2:
                    continue
                text = [t or "" for t in rows.column("text").to_pylist()]
                ahead = rows.column("ahead").to_pylist()
                at = [i for i in range(len(text) - 1) if not ahead[i]]
                if not at:
                    continue
                edited, n_chars = [], []
                for i in at:
                    n = len(text[i])
                    n_chars.append(n)
                    edited.append(text[i][: n - n // 2] + text[i + 1][: n // 2])
                own = simhash(rows.column("text").combine_chunks())
                other = simhash(pa.array(edited, pa.large_string()))
                at = np.asarray(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rows.column("doc_id")[int(i)].as_py() for i in at], pa.int64()), pa.array(n_chars, pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                        pa.array([x.tobytes().hex() for x in own[at]]), pa.array([x.tobytes().hex() for x in other]),
                        pa.array(likeness(own[at], other)), pa.array(likeness(own[at], own[at + 1])),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    n_bytes = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    prints = written(
        with_next(docs, tasks(spark, n_bytes, RUN_BYTES)).mapInArrow(lean(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"),
        "prints",
    )
    # a fixed query set: every document whose id is divisible by 100, against all; the others need no lookup
    asked = prints.where("doc_id % 100 = 0")
    found = within_radius(asked, prints).groupBy("fingerprint").agg((F.sum("rows") - 1).alias("n_within"))
    counted = asked.join(found.withColumnRenamed("fingerprint", "f"), F.col("fingerprint") == F.col("f"), "left").drop("f")
    return counted.unionByName(prints.where("doc_id % 100 <> 0 OR doc_id IS NULL").withColumn("n_within", F.lit(None).cast("long")))
