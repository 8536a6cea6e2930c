"""Best-fit packing of token sequences by linear grouping.

The plan is made from the histogram of piece lengths alone (at most ``capacity`` rows), so it costs the same for any
corpus: large lengths are dealt into groups of equal cardinality and rounded up to the largest of their group; a
linear programme over configurations of these few sizes is solved by column generation; whole configurations are
filled with actual pieces, which are no longer than the rounded sizes; what is left over and all small pieces then go
best-fit, longest first. Sequences that are filled alike are held as one class with a count.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.llm.common import INNER, lean, salted_rank, salts, ship, slices, table, written

CAPACITY = 1024
END_ID = 2
#: Lengths above capacity / SMALL_SHARE are large.
SMALL_SHARE = 8
#: Groups of equal cardinality, and so rows of the linear programme.
GROUPS = 96
#: Entries of a worker's cache of encoded chunks; when full it is emptied.
CACHE_ENTRIES = 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ---- tokens -------------------------------------------------------------------------------------------------------


class _Chunks(dict):
    """Chunk -> its ids as little-endian bytes. A chunk is what stands between single spaces; ``lead`` is put before it.

    A token never reaches over a single space between two solid characters, and the space goes with what follows, so
    chunks are encoded one by one and kept. The same holds for a line end between solid characters.
    """

    def __init__(self, raw, lead: str, bare: "_Chunks | None" = None):
        self.raw, self.lead = raw, lead
        self.bare = self if bare is None else bare
        self.tails = {c: raw(c) for c in ".,;:!?"}
        self.line = raw("\n")

    def __missing__(self, k: str) -> bytes:
        if k.isalpha():
            v = self.raw(self.lead + k)
        elif (tail := self.tails.get(k[-1:])) and k[:-1].isalpha():
            v = self[k[:-1]] + tail
        else:
            x, _, y = k.partition("\n")
            v = self[x] + self.line + self.bare[y] if x and y and not x[-1].isspace() and not y[0].isspace() else self.raw(self.lead + k)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[k] = v
        return v


class ByteBPE:
    """The byte-level BPE of a ``tokenizers`` file; a special token's string in a text is that token, as by default there.

    The file's vocabulary is run by tiktoken's encoder, which gives the same ids several times faster; a probe text
    compares the two on loading and refuses a file for which they differ. Texts are cut at the special tokens' strings
    (the longest of those that start first), and what stands between is encoded by itself.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    PROBE = "It's a (small) test,\nof 12 things:  naïve — ça va?\n\n\tüber 3.5 % 中文 😀 don't stop "

    def __init__(self, path: str):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        ranks = {bytes(map(shown.__getitem__, w)): i for w, i in model["vocab"].items() if all(c in shown for c in w)}
        own = Tokenizer.from_file(path)
        added = own.get_added_tokens_decoder()
        special = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        self._encode = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks={w: i for w, i in ranks.items() if w.decode("utf-8", "replace") not in special}, special_tokens={}).encode_ordinary
        self._special = special
        self._at_special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._first = _Chunks(self._raw, "")
        self._next = _Chunks(self._raw, " ", self._first)
        self._odd = re.compile(r"^\s|\s$|\s |\s\s").search  # white space beside white space or at an end: no chunks
        probe = self.PROBE + "".join(f"a {t} b{t}" for t in special)
        plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        if not plain or self.ids(probe) != array("I", own.encode(probe, add_special_tokens=False).ids).tobytes():
            raise ValueError(f"{path} is not a byte-level BPE with the known pattern")

    def _raw(self, text: str) -> bytes:
        return array("I", self._encode(text)).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as unsigned 32-bit little-endian numbers."""
        if self._at_special and self._at_special.search(text):
            out, at = [], 0
            for m in self._at_special.finditer(text):
                out += [self._ordinary(text[at : m.start()]), self._special[m.group()]]
                at = m.end()
            return b"".join([*out, self._ordinary(text[at:])])
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        if self._odd(text):
            return self._raw(text)
        first, *rest = text.split(" ")
        return self._first[first] + b"".join(map(self._next.__getitem__, rest))


_LOADED: dict[str, ByteBPE] = {}


def tokenizer(path: str) -> ByteBPE:
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenize each text, end it by END_ID, cut what is longer than capacity from the back into whole pieces.

    A null text is an empty one: a single piece with the end id. Equal rows give equal pieces. Returns doc_id, piece,
    start, length, ids_crc32 and, if asked for, ids (array of int).
    """
    ship(docs.sparkSession)
    end = array("I", [END_ID]).tobytes()

    def cut(batches):
        t = tokenizer(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text", 32 << 20):
                doc, piece, start, length, crc, kept = [], [], [], [], [], []
                for d, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = t.ids(text or "") + end
                    n = len(ids) // 4
                    at, k, size = 0, 0, (n - 1) % capacity + 1
                    while at < n:
                        own = ids[4 * at : 4 * (at + size)]
                        doc.append(d), piece.append(k), start.append(at), length.append(size), crc.append(zlib.crc32(own))
                        if with_ids:
                            kept.append(np.frombuffer(own, "<u4").astype(np.int32))
                        at, k, size = at + size, k + 1, capacity
                out = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(cut), PIECES + (", ids array<int>" if with_ids else ""))


# ---- plan ---------------------------------------------------------------------------------------------------------


def linear_groups(runs: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Deal (size, count) runs, largest first, into at most ``groups`` groups of equal cardinality."""
    total = sum(n for _, n in runs)
    if not total:
        return []
    each = -(-total // groups)
    out: list[list[tuple[int, int]]] = [[]]
    room = each
    for size, n in runs:
        while n:
            if not room:
                out.append([])
                room = each
            k = min(n, room)
            out[-1].append((size, k))
            n, room = n - k, room - k
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[tuple[int, ...], float]]:
    """Solve the linear programme over configurations of ``sizes`` by column generation.

    Columns are priced by an unbounded knapsack over the capacity. Returns (copies of each size, times used); at most
    len(sizes) of them. The rounds are a bound for floating-point cycling only; any basis is a valid plan.
    """
    k = len(sizes)
    if not k:
        return []
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.asarray(demand, float)
    size_of = np.asarray(sizes)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        price = np.maximum(np.ones(k) @ inverse, 0)
        best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(1, capacity + 1):
            fit = size_of <= c
            best[c] = best[c - 1]
            if fit.any():
                value = np.where(fit, price + best[np.maximum(c - size_of, 0)], -1)
                i = int(value.argmax())
                if value[i] > best[c] + 1e-12:
                    best[c], took[c] = value[i], i
        if best[capacity] <= 1 + 1e-6:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if took[c] < 0:
                c -= 1
            else:
                column[took[c]] += 1
                c -= sizes[took[c]]
        enters, level = inverse @ column, inverse @ need
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(enters > 1e-9, level / enters, np.inf)
        leaves = int(ratio.argmin())
        if not np.isfinite(ratio[leaves]):
            break
        basis[:, leaves] = column
    level = np.linalg.inv(basis) @ need
    return [(tuple(int(round(x)) for x in basis[:, j]), float(level[j])) for j in range(k) if level[j] > 1e-9]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small_share: int = SMALL_SHARE) -> dict[str, np.ndarray]:
    """Where pieces go, by (size, rank among the pieces of that size).

    Returns runs sorted by (size, rank): ``size``, ``rank`` (of the run's first piece), ``sequence`` (its sequence;
    the next piece goes to the next one) and ``offset``; and ``sequences``, their number.
    """
    classes: list[tuple[int, list[int]]] = []  # number of sequences, the sizes in each
    if whole := histogram.get(capacity, 0):
        classes.append((whole, [capacity]))
    runs = sorted(((s, n) for s, n in histogram.items() if s < capacity and n), reverse=True)
    grouped = linear_groups([r for r in runs if r[0] * small_share > capacity], groups)
    left: dict[int, int] = defaultdict(int)
    for s, n in runs:
        if s * small_share <= capacity:
            left[s] += n
    # groups with an equal largest size are one size of the programme
    merged: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for g in grouped:
        merged[g[0][0]].extend(g)
    tops = sorted(merged, reverse=True)
    queue = {t: [list(r) for r in merged[t]] for t in tops}
    for copies, times in configurations(tops, [sum(n for _, n in merged[t]) for t in tops], capacity):
        slots = [t for t, c in zip(tops, copies) for _ in range(c)]
        m = min([int(times + 1e-6), *(sum(n for _, n in queue[t]) // c for t, c in zip(tops, copies) if c)])
        if not slots or m <= 0:
            continue
        drawn = []
        for t in slots:  # each slot takes the next m pieces of its group, largest first
            got, n = [], m
            while n:
                size, have = queue[t][0]
                k = min(n, have)
                got.append((size, k))
                n -= k
                if k == have:
                    queue[t].pop(0)
                else:
                    queue[t][0][1] -= k
            drawn.append(got)
        edges = sorted({e for got in drawn for e in np.cumsum([k for _, k in got]).tolist()})
        ends = [np.cumsum([k for _, k in got]) for got in drawn]
        at = 0
        for e in edges:
            classes.append((e - at, [got[int(np.searchsorted(end, at, "right"))][0] for got, end in zip(drawn, ends)]))
            at = e
    for t in tops:
        for size, n in queue[t]:
            left[size] += n
    _best_fit(classes, left, capacity)
    return _runs(classes)


def _best_fit(classes: list[tuple[int, list[int]]], left: dict[int, int], capacity: int) -> None:
    """Best-fit ``left`` into the classes, longest first, changing classes; equal to going piece by piece.

    A piece goes to the sequence with the least room that holds it, which after it has still less room and so gets the
    next piece of that size too if it fits: a sequence with room r takes r // size of them before the next one.
    """
    by_room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for m, sizes in classes:
        by_room[capacity - sum(sizes)].append((m, sizes))
    rooms = sorted(by_room)
    classes.clear()
    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                by_room[capacity].append((-(-n // (capacity // size)), []))
                insort(rooms, capacity)
                continue
            room = rooms[i]
            m, sizes = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(i)
            each = min(room // size, n)
            b = min(m, n // each)
            n -= b * each
            for count, has in ((b, sizes + [size] * each), (m - b, sizes)):
                if count:
                    r = capacity - sum(has)
                    if not by_room[r]:
                        insort(rooms, r)
                    by_room[r].append((count, has))
    classes.extend(c for group in by_room.values() for c in group if c[1])


def _runs(classes: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    rank: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for m, sizes in classes:
        offset = 0
        for s in sizes:
            rows.append((s, rank[s], base, offset))
            rank[s] += m
            offset += s
        base += m
    rows.sort()
    a = np.asarray(rows, np.int64).reshape(-1, 4)
    return {"size": a[:, 0], "rank": a[:, 1], "sequence": a[:, 2], "offset": a[:, 3], "sequences": np.asarray([base])}


# ---- operator -----------------------------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Give each row of ``pieces`` (with doc_id, piece and length from 1 to capacity) a sequence_id and an offset.

    Every sequence is filled from 0 without gaps and holds at most capacity tokens. Rows with equal doc_id and piece
    are each packed; other columns stay. Reruns agree. An empty input gives an empty result.
    """
    ship(pieces.sparkSession)
    histogram = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    if any(not 1 <= s <= capacity for s in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    where = plan(histogram, capacity, groups)
    rank, parts = f"{INNER}rank", salts(pieces.sparkSession)
    same = [F.col(c).asc_nulls_first() for c in ("doc_id", "piece")] + [F.xxhash64(*(F.col(c) for c in pieces.columns)).asc()]
    ranked = salted_rank(pieces, ["length"], F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"), same, rank, parts)
    wide = 1 << 42
    key = where["size"] * wide + where["rank"]
    shift, offset = where["sequence"] - where["rank"], where["offset"]

    def place(batches):
        for b in batches:
            r = np.asarray(b.column(rank))
            at = np.searchsorted(key, np.asarray(b.column("length")) * wide + r, "right") - 1
            names = [n for n in b.schema.names if n != rank]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(shift[at] + r, pa.int64()), pa.array(offset[at], pa.int64())], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(lean(place), schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(written(token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of CAPACITY tokens. A null or empty text is one piece with the end id."""
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
