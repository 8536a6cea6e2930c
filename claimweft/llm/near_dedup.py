"""MinHash near-dedup with DartMinHash signatures.

A text is a weighted set of its runs of SHINGLE_WORDS words, weighted by their number of occurrences (or by any weights).
Above each element stands a plane of weight and rank on which darts fall evenly; an element has the darts below its
weight. Its weights are cut into regions, each twice as wide as the one before, and a region along the ranks into cells of
area one; a cell's darts, their number (Poisson) and their places all come from a hash of element, region and cell. So
heavy elements cost their logarithm and the darts they get, and all texts see the same darts. Darts are thrown down to a
rank that leaves about k ln k + 2 k of them on the whole text; each belongs to one of k coordinates, which keeps its
earliest. Two texts agree on a coordinate with the probability of their weighted Jaccard similarity. Bands of coordinates
make buckets.

Texts with equal words are one content. In a bucket every content is compared with the first one; connected components
follow; where a bucket still holds contents of several components, all pairs across components are compared in blocks.
So every pair that meets in a bucket is compared or already linked, whatever the bucket's size, and only links between
contents leave a task. All comparisons are exact, over the whole texts.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.llm.common import INNER, discard, flat, lean, mix, row_bounds, ship, slices, table, words, written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 20, 5
#: Contents of a block when a bucket is compared in blocks.
BLOCK = 256
SLICE = 3 << 20


def elements_of(column: pa.Array, n_words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and number of occurrences of each distinct run of words, by row and hash; and two 64-bit keys of each text's words.

    A text of fewer than n_words words is one run of all its words; one without words has no element and keys of 0.
    """
    data, offsets = flat(column)
    n = len(offsets) - 1
    _, _, h, rows = words(data, offsets)
    bounds = row_bounds(rows, n)
    count = np.diff(bounds)
    place = np.arange(len(h)) - bounds[rows]
    run = np.zeros(len(h), np.uint64)
    keys = np.zeros((2, n), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n_words):
            part = np.zeros(len(h), np.uint64)
            part[: max(0, len(h) - k)] = h[k:]
            part[place + k >= count[rows]] = 0
            run = run * np.uint64(0x9E3779B97F4A7C15) + mix(part + np.uint64(k + 1))
        run = mix(run)
        if len(h):
            some = count > 0
            for i in range(2):
                w = mix(h ^ mix(place.astype(np.uint64) + np.uint64(i + 1)))
                keys[i, some] = mix(np.add.reduceat(w, bounds[:-1][some]) + count[some].astype(np.uint64))
    first = np.flatnonzero(place + n_words <= np.maximum(count[rows], n_words))
    rows, run = rows[first], run[first]
    order = np.lexsort((run, rows))
    rows, run = rows[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return rows[at], run[at], np.diff(np.append(at, len(run))), keys[0], keys[1]


def unit_columns(run: np.ndarray, times: np.ndarray) -> np.ndarray:
    """A hash for each occurrence of each element, in order: what two texts share of them is the sum of the lesser counts."""
    at = np.repeat(np.arange(len(run)), times)
    occurrence = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    with np.errstate(over="ignore"):
        return mix(run[at] + occurrence.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Above 0, below 1."""
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


#: The chance that a cell of area one has at most so many darts, for 0, 1, ...
POISSON = np.cumsum([np.exp(-1.0) / math.factorial(i) for i in range(20)])


def throw(elements: np.ndarray, weights: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The darts below each element's weight, of a rank up to its depth: number of the element, rank, and identity.

    Weights are numbers above 0; the first region has the weights up to 1, the next ones those up to 3, 7, 15, ...
    """
    owner, ranks, idents = [], [], []
    with np.errstate(over="ignore"):
        for region in range(int(np.log2(1.0 + weights.max())) + 1 if len(weights) else 0):
            wide = 2.0**region
            own = np.flatnonzero(weights > wide - 1.0)
            if not len(own):
                break
            seed = mix(elements[own] ^ mix(np.asarray([region + 1], np.uint64)))
            cells = np.ceil(depth[own] * wide).astype(np.int64)  # a cell is the region's width times 1 / width of rank
            at = np.repeat(np.arange(len(own)), cells)
            cell = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
            z = mix(seed[at] + cell.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
            darts = np.searchsorted(POISSON, _uniform(z))
            which = np.repeat(np.arange(len(at)), darts)
            number = np.arange(len(which)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = mix(z[which] + (number + 1).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
            weight = wide - 1.0 + wide * _uniform(dart)
            dart = mix(dart + np.uint64(1))
            rank = (cell[which] + _uniform(dart)) / wide
            element = own[at[which]]
            hit = np.flatnonzero((weight < weights[element]) & (rank <= depth[element]))
            owner.append(element[hit]), ranks.append(rank[hit]), idents.append(mix(dart[hit] + np.uint64(2)))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(owner, np.int64), join(ranks, np.float64), join(idents, np.uint64)


def dart_signatures(rows: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts with elements, k) identities of the earliest dart of each coordinate; and the row numbers of those texts.

    ``rows`` has the text of each element, ``weights`` its weight there, a number above 0.
    """
    weights = np.asarray(weights, np.float64)
    total = np.bincount(rows, weights, minlength=n)
    texts = np.flatnonzero(total)
    out = np.zeros((n, k), np.uint64)
    open_texts, darts = texts, k * np.log(k) + 2 * k
    while len(open_texts):
        wanted = np.zeros(n, bool)
        wanted[open_texts] = True
        at = np.flatnonzero(wanted[rows])
        own, rank, ident = throw(elements[at], weights[at], darts / total[rows[at]])
        cell = rows[at][own] * k + (ident % np.uint64(k)).astype(np.int64)
        order = np.lexsort((ident, rank, cell))
        cell = cell[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        filled = np.bincount(cell[first] // k, minlength=n)
        out.reshape(-1)[cell[first]] = ident[order[first]]
        open_texts = open_texts[filled[open_texts] < k]
        darts *= 2
    return out[texts], texts


def signatures(sets: DataFrame, k: int, unit: float = 1.0) -> DataFrame:
    """Add ``signature`` (array of k longs) to a table of weighted sets: columns ``elements`` (strings) and ``weights``.

    ``unit``, the same for all sets to be compared, is a weight at the lower end of what is usual; a set whose weights add
    up to less than a thousandth of it would need too many darts and fails.
    Two sets agree in each place with the probability of their weighted Jaccard similarity. An element that is named twice
    has the sum of its weights; weights that are null, not above 0 or not finite count as absent. A null or empty set has
    a null signature. Other columns stay; a clashing one is replaced.
    """
    ship(sets.sparkSession)
    sets = sets.drop("signature")

    def run(batches):
        for batch in batches:
            names, values = batch.column("elements").to_pylist(), batch.column("weights").to_pylist()
            rows, hashes, weights = [], [], []
            for i, (own, w) in enumerate(zip(names, values)):
                total: dict[str, float] = {}
                for name, x in zip(own or (), w or ()):
                    if name is not None and x is not None and 0 < x < float("inf"):
                        total[name] = total.get(name, 0.0) + x
                rows += [i] * len(total)
                hashes += [int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little") for name in total]
                weights += total.values()
            rows, weights = np.asarray(rows, np.int64), np.asarray(weights) / unit
            total = np.bincount(rows, weights)
            if ((total > 0) & (total < 1e-3)).any():
                raise ValueError("weights far below the unit: choose a smaller one")
            found, texts = dart_signatures(rows, np.asarray(hashes, np.uint64), weights, batch.num_rows, k)
            out = [None] * batch.num_rows
            for i, x in zip(texts.tolist(), found.view(np.int64).tolist()):
                out[i] = x
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], [*batch.schema.names, "signature"])

    return sets.mapInArrow(lean(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sets.schema) + ", signature array<long>")


def _hex(a: np.ndarray, b: np.ndarray) -> list[str]:
    both = np.stack([a, b], axis=1).astype(">u8").tobytes().hex()
    return [both[i : i + 32] for i in range(0, len(both), 32)]


def sketches(docs: DataFrame, bands: int = BANDS, band_rows: int = BAND_ROWS, n_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, node (hex key of the text's words, null if it has none), n (weight), keys (bucket of each band)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                rows, elements, times, k1, k2 = elements_of(part.column("text"), n_words)
                n = part.num_rows
                weight = np.bincount(rows, times, minlength=n).astype(np.int64)
                signature, texts = dart_signatures(rows, elements, times, n, bands * band_rows)
                buckets = np.zeros((n, bands), np.uint64)
                with np.errstate(over="ignore"):
                    for b in range(bands):
                        h = np.full(len(texts), b + 1, np.uint64)
                        for r in range(band_rows):
                            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * band_rows + r])
                        buckets[texts, b] = h
                nodes = [x if w else None for x, w in zip(_hex(k1, k2), weight)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands), pa.int32()), pa.array(buckets.view(np.int64).reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(nodes, pa.string()), pa.array(weight, pa.int64()), lists], ["doc_id", "node", "n", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), "doc_id long, node string, n long, keys array<long>")


def _grams(docs: DataFrame, n_words: int) -> DataFrame:
    """node and the sorted hashes of its unit columns, as bytes."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                rows, elements, times, k1, k2 = elements_of(part.column("text"), n_words)
                columns, rows = unit_columns(elements, times), np.repeat(rows, times)
                order = np.lexsort((columns, rows))
                columns, bounds = columns[order], row_bounds(rows, part.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(_hex(k1, k2)), pa.array([columns[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], ["node", "grams"])

    return docs.select("text").mapInArrow(lean(run), "node string, grams binary")


def jaccard_at_least(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted arrays of distinct hashes have the similarity."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or len(small) < similarity * len(large) - 1e-9:
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int(np.count_nonzero(large[at] == small))
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def components(links: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for the nodes of links (a, b). Every round is a written table."""
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    held = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        labels = held.select("node", "label")
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("step"), F.col("label").alias("old"))
        lower = written(lower, "steps")
        up = lower.select(F.col("node").alias("up"), F.col("step").alias("beyond"))
        moved = written(lower.join(up, F.col("step") == F.col("up")).select("node", F.least("step", "beyond").alias("label"), "old"), "labels")
        discard(lower, held)
        held = moved
        if moved.where("label <> old").isEmpty():
            discard(edges)
            return held.select("node", "label")


def _compare_blocks(similarity: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = pdf["side"].to_numpy()
        node, comp = pdf["node"].to_list(), pdf["label"].to_list()
        grams = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
        top = {c: c for c in comp}

        def find(c):
            while top[c] != c:
                top[c] = top[top[c]]
                c = top[c]
            return c

        out = []
        same = bool((sides == 2).all())
        left = [i for i in range(len(node)) if sides[i] != 1]
        right = [i for i in range(len(node)) if sides[i] != 0]
        for x, i in enumerate(left):
            for j in right[x + 1 :] if same else right:
                if (a := find(comp[i])) != (b := find(comp[j])) and jaccard_at_least(grams[i], grams[j], similarity):
                    out.append((node[i], node[j]))
                    top[a] = b
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, band_rows: int = BAND_ROWS, n_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (the least doc_id of its class), class_size (its rows).

    A class is a connected component of the links of at least ``similarity``; texts with the same words in order are in
    one class. A text without words (null, empty, blank) is a class of its own, by doc_id. Repeated rows are in one
    class. Null doc_ids get a class of their texts like others, named by the least id that is not null.
    """
    spark = docs.sparkSession
    ship(spark)
    sketch = written(sketches(docs, bands, band_rows, n_words), "sketch")
    content = sketch.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("copies"))
    content = written(content, "content")
    member = content.select("node", F.explode("keys").alias("key"))
    buckets = member.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("hub")).where("members > 1").withColumnRenamed("key", "k")
    shared = written(member.join(buckets, F.col("key") == F.col("k")).select("key", "node", "hub", "members"), "buckets")
    wanted = shared.select("node").distinct().join(content.select("node", "rep"), "node").select(F.col("rep").alias("r")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    grams = written(_grams(texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("r")), "left_semi"), n_words).dropDuplicates(["node"]), "grams")

    def verify(batches):
        for batch in batches:
            ga, gb = batch.column("ga").to_pylist(), batch.column("gb").to_pylist()
            keep = [jaccard_at_least(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity) for x, y in zip(ga, gb)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    star = shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    size = F.length
    with_b = star.join(grams.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
    with_both = with_b.join(grams.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
    able = F.least(size("ga"), size("gb")) >= similarity * F.greatest(size("ga"), size("gb")) - 1e-6
    links = written(with_both.where(able).select("a", "b", "ga", "gb").mapInArrow(lean(verify), "a string, b string"), "links")
    labels = components(links)
    # buckets that hold several components: all pairs across components, in blocks
    named = shared.where("members > 2").join(labels.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("key", "node", "members", F.coalesce("label", "node").alias("label"))
    mixed = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").withColumnRenamed("key", "k")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = named.join(mixed, F.col("key") == F.col("k")).select("key", "node", "label", block.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"))
    dealt = dealt.select("key", "node", "label", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), F.when(F.col("block") == F.col("with"), 2).when(F.col("block") < F.col("with"), 0).otherwise(1).alias("side"))
    more = dealt.join(grams, "node").groupBy("key", "i", "j").applyInPandas(_compare_blocks(similarity), "a string, b string")
    more = written(more, "links")
    if not more.isEmpty():
        labels = components(links.union(more))
    named = content.join(labels.withColumnRenamed("node", "l"), F.col("node") == F.col("l"), "left").select("node", "rep", "copies", F.coalesce("label", "node").alias("label"))
    total = named.groupBy(F.col("label").alias("t")).agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    by_node = named.join(total, F.col("label") == F.col("t")).select(F.col("node").alias("of"), "class_id", "class_size")
    return sketch.join(by_node, F.col("node") == F.col("of"), "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that name their class, with all columns; of rows alike in doc_id and text one stays."""
    kept = classes(docs, similarity).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias(f"{INNER}d")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(f"{INNER}d")), "left_semi").dropDuplicates(["doc_id", "text"])


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """The class of every document; see ``classes`` for nulls, texts without words and repeated rows."""
    return classes(table(spark, sf_dir, "documents"))
