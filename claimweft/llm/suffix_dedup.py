"""Suffix-array dedup: every byte covered by a 200-byte string that starts anywhere else is removed.

A 200-byte window picks an anchor in itself: the right-most of the K-byte strings in it with the least hash. Equal
windows pick it at the same place, so only suffixes at anchors need sorting, and only at anchors whose K bytes stand
elsewhere too. The steps:

1. texts are dealt to groups by their content, equal ones as one text with a count, and written; each group sends the
   distinct hashes of its anchors to buckets, which answer each group which of them are repeated, so a frequent string
   is one number a group however many texts have it; some repeated strings come along as a sample;
2. the suffixes at those places (WINDOW bytes on, and what is before them, last byte first) are sorted in each group;
   equal ones are one entry; sorted runs are front-coded, split by splitters from the sample and exchanged;
3. runs are merged with a loser tree in which every entry knows its common prefix with the last output, so known
   prefixes are never compared again; common prefixes of neighbours come out of the merge, and parts follow each other
   in the order of suffixes;
4. entries with the same first K bytes are neighbours then: each finds how far left and right it agrees with another
   by a whole window, by comparison or, among many, by grouping equal windows. Where even that is too much for one
   task, each gives its windows (bounded by its neighbours' common prefixes) to a grouped count over all tasks;
5. texts get their intervals and lose those bytes.

Hashes only choose places and candidates: what is removed was found equal byte by byte.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.llm.common import BASE, BASE_INVERSE, _byte_table, _powers, lean, mix, ship, slices, table, tasks, written

WINDOW = 200
K = 100
BEFORE = WINDOW - K
ENTRY = WINDOW + BEFORE
#: Different suffixes with the same first K bytes that are compared one with all; with more, a task groups their windows.
TOGETHER = 256
#: With still more, the windows are counted by a grouped aggregation over all tasks.
IN_TASK = 100_000
#: Bytes of text for a bucket of anchors, a group of texts, and a part of the merge; bytes of a shuffle task.
BUCKET_BYTES, GROUP_BYTES, PART_BYTES, TASK_BYTES = 256 << 20, 8 << 20, 24 << 20, 128 << 20
#: Bytes of a slice of the table, and of a piece of joined texts whose anchors are found at once.
SLICE, PIECE = 6 << 20, 1 << 20
#: Suffixes of a sorted run.
RUN = 60_000
#: Repeated strings in the sample (expected), and the most splitters made of it; between two, parts are cut evenly.
SAMPLE, SPLITTERS = 20_000, 1024


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, 5))


def _unpack(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _sliding_least(h: np.ndarray, w: int) -> np.ndarray:
    """For each run of w hashes, ascending, the place of the least; the right-most among equals."""
    m = len(h)
    rows = np.concatenate([h, np.full(-m % w, ~np.uint64(0))]).reshape(-1, w)
    at = np.arange(rows.size, dtype=np.int32).reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1)
    before_at = np.maximum.accumulate(np.where(rows == before, at, np.int32(-1)), axis=1).reshape(-1)
    turned = rows[:, ::-1]
    after = np.minimum.accumulate(turned, axis=1)
    lower = np.ones(rows.shape, bool)
    lower[:, 1:] = turned[:, 1:] < after[:, :-1]
    step = np.maximum.accumulate(np.where(lower, np.arange(w, dtype=np.int32), np.int32(0)), axis=1)
    after_at = (at[:, -1:] - step)[:, ::-1].reshape(-1)
    after, before = after[:, ::-1].reshape(-1), before.reshape(-1)
    n = m - w + 1
    right = before[w - 1 : w - 1 + n] <= after[:n]
    return np.where(right, before_at[w - 1 : w - 1 + n], after_at[:n])


def anchors(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows that lie within a text, ascending, and the hashes of their k bytes."""
    n, m, w = len(data), len(data) - k + 1, window - k + 1
    if m < w:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(_byte_table()[data] * _powers("up", BASE, n), out=run[1:])
        h = mix((run[k:] - run[:m]) * _powers("down", BASE_INVERSE, n + 1)[:m])
    least = _sliding_least(h, w)
    inside = np.zeros(n + 1, np.int32)
    long = np.diff(offsets) >= window
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - window + 1, -1)
    least = least[np.cumsum(inside[: len(least)]).astype(bool)]
    if len(least):  # neighbours mostly pick the same anchor
        least = least[np.concatenate([[True], least[1:] != least[:-1]])]
    at = np.unique(least)
    return at, h[at]


def all_anchors(data: np.ndarray, offsets: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """As ``anchors``, by pieces of the data that overlap by what a window needs, so that memory does not grow with it."""
    places, hashes = [], []
    for a in range(0, max(1, len(data)), piece):
        b = min(len(data), a + piece + WINDOW - 1)
        lo, hi = np.searchsorted(offsets, [a, b], "right")
        at, h = anchors(data[a:b], np.clip(offsets[max(0, lo - 1) : hi + 1] - a, 0, b - a))
        places.append(at + a), hashes.append(h)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]


def _join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _groups(batches, key: str):
    """(key, rows) of a stream of batches that is sorted by key; rows have the other columns."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != at and held:
                yield at, held
                held = []
            at = row[key]
            held.append(row)
    if held:
        yield at, held


def _dealt(df: DataFrame, parts: int, *order: str) -> DataFrame:
    return df.repartitionById(parts, F.pmod(F.col(order[0]), F.lit(parts))).sortWithinPartitions(*order)


def _edges(sorted_: np.ndarray) -> list[tuple[int, int]]:
    """The runs of equal values."""
    cuts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1], [True]])) if len(sorted_) else np.zeros(1, np.int64)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


_ROW = "part int, kind int, blob binary"


def _rows(parts: list[int], kind: int, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([kind] * len(parts), pa.int32()), pa.array(blobs, pa.binary())], ["part", "kind", "blob"])


def _spans_by_group(group: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """One row (group, kind 1, blob) a group: the numbers of its texts and the intervals found in them."""
    order = np.argsort(group, kind="stable")
    group, doc, start, end = group[order], doc[order].astype(np.uint32), start[order].astype(np.uint32), end[order].astype(np.uint32)
    runs = _edges(group)
    return _rows([int(group[a]) for a, _ in runs], 1, [_pack(doc[a:b], start[a:b], end[a:b]) for a, b in runs])


# ---- step 1 -------------------------------------------------------------------------------------------------------


def _texts(n_groups: int):
    """The distinct texts of each slice, by group: (part, kind 0, blob of keys, counts and texts)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                seen: dict[bytes, list] = {}
                for t in part.column("text").to_pylist():
                    b = (t or "").encode()
                    seen.setdefault(hashlib.sha256(b).digest()[:16], [b, 0])[1] += 1
                by: dict[int, list[bytes]] = {}
                for key in seen:
                    by.setdefault(int.from_bytes(key[:8], "little") % n_groups, []).append(key)
                yield _rows(list(by), 0, [_pack(own, [seen[k][1] for k in own], [seen[k][0] for k in own]) for own in by.values()])

    return run


def _whole_groups(batches):
    """One row a group: the keys, counts and bytes of its distinct texts."""
    for part, rows in _groups(batches, "part"):
        number: dict[bytes, int] = {}
        keys, texts, counts = [], [], []
        for r in rows:
            for key, count, text in zip(*_unpack(r["blob"])):
                i = number.setdefault(key, len(keys))
                if i == len(keys):
                    keys.append(key), texts.append(text), counts.append(0)
                elif text != texts[i]:
                    raise ValueError("two texts with one key")
                counts[i] += count
        yield _rows([part], 0, [_pack(keys, counts, texts)])


def _offer(n_buckets: int, one_in: int):
    def run(batches):
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist()):
                data, offsets = _join(_unpack(blob)[2])
                at, h = all_anchors(data, offsets)
                h, first, count = np.unique(h, return_index=True, return_counts=True)
                bucket = (h % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                h, several, place, bucket = h[order], (count[order] > 1).astype(np.uint8), at[first[order]], bucket[order]
                chosen = mix(h + np.uint64(1)) % np.uint64(one_in) == 0
                out = []
                for a, b in _edges(bucket):
                    own = a + np.flatnonzero(chosen[a:b])
                    out.append((int(bucket[a]), part, h[a:b].tobytes(), several[a:b].tobytes(), b"".join(h[i].tobytes() + data[place[i] : place[i] + K].tobytes() for i in own.tolist())))
                if out:
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["bucket", "part", "hashes", "several", "sample"])

    return run


def _answer(batches):
    """(group, kind 1, its repeated hashes); (-1, kind 9, a repeated string and in how many groups it is) for the sample."""
    for _, rows in _groups(batches, "bucket"):
        hashes = [np.frombuffer(r["hashes"], "<u8") for r in rows]
        every = np.concatenate(hashes)
        several = np.frombuffer(b"".join(r["several"] for r in rows), np.uint8)
        distinct, number, count = np.unique(every, return_inverse=True, return_counts=True)
        repeated = (count > 1) | (np.bincount(number, several, len(distinct)) > 0)
        group = np.repeat(np.asarray([r["part"] for r in rows]), [len(h) for h in hashes])[repeated[number]]
        every = every[repeated[number]]
        order = np.argsort(group, kind="stable")
        group, every = group[order], every[order]
        runs = _edges(group)
        yield _rows([int(group[a]) for a, _ in runs], 1, [every[a:b].tobytes() for a, b in runs])
        sample = {r["sample"][i : i + 8]: r["sample"][i + 8 : i + 8 + K] for r in rows for i in range(0, len(r["sample"]), 8 + K)}
        own = [(np.searchsorted(distinct, np.frombuffer(k, "<u8")[0]), v) for k, v in sample.items()]
        own = [v + int(count[i]).to_bytes(8, "big") for i, v in own if repeated[i]]
        yield _rows([-1] * len(own), 9, own)


# ---- step 2 -------------------------------------------------------------------------------------------------------


def splitters(sample: list[tuple[bytes, int]], most: int = SPLITTERS) -> np.ndarray:
    """At most ``most`` - 1 strings that cut the weighted sample into even ranges, ascending."""
    sample = sorted(sample)
    weight = np.cumsum([w for _, w in sample]) if sample else np.zeros(0)
    at = np.unique(np.searchsorted(weight, np.arange(1, most) * (weight[-1] / most))) if sample else []
    return np.unique(np.asarray([sample[i][0] for i in at], f"S{K}"))


def part_of(prefixes: np.ndarray, cuts: np.ndarray, each: int) -> np.ndarray:
    """The number of the part of each K-byte string: ascending with the strings, ``each`` parts between two cuts.

    Between two cuts, the eight bytes after what both cuts begin with say where a string stands.
    """
    p = np.ascontiguousarray(prefixes)
    at = np.searchsorted(cuts, p.view(f"S{K}").reshape(-1), "right")
    ends = np.zeros((len(cuts) + 2, K + 8), np.uint8)
    ends[-1] = 255
    if len(cuts):
        ends[1:-1, :K] = np.frombuffer(cuts.astype(f"S{K}").tobytes(), np.uint8).reshape(-1, K)
    low, high = ends[:-1], ends[1:]
    other = low != high
    common = np.minimum(np.where(other.any(axis=1), other.argmax(axis=1), K), K)
    eight = np.arange(8)
    number = lambda rows, start: np.ascontiguousarray(np.take_along_axis(rows, start[:, None] + eight, axis=1)).view(">u8").reshape(-1).astype(np.float64)
    a, b = number(low, common), number(high, common)
    wide = np.concatenate([p, np.zeros((len(p), 8), np.uint8)], axis=1)
    x = (number(wide, common[at]) - a[at]) / np.maximum(b - a, 1.0)[at]
    return at * each + np.clip((x * each).astype(np.int64), 0, each - 1)


def entries(data: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, ENTRY) bytes: WINDOW bytes from each place, then the BEFORE bytes ahead of it, last first.

    What is outside the text is 255, which UTF-8 never has. Also how many bytes of the two parts are inside.
    """
    right, left = np.minimum(end - at, WINDOW), np.minimum(at - begin, BEFORE)
    m = np.full((len(at), ENTRY), 255, np.uint8)
    k, j = np.arange(WINDOW), np.arange(BEFORE)
    for a in range(0, len(at), 5_000):  # index matrices are wide
        own = slice(a, a + 5_000)
        p = at[own, None]
        m[own, :WINDOW] = np.where(k < right[own, None], data[np.minimum(p + k, len(data) - 1)], 255)
        m[own, WINDOW:] = np.where(j < left[own, None], data[np.maximum(p - 1 - j, 0)], 255)
    return m, right, left


def _prefixes(m: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it; 0 for the first."""
    out = np.zeros(len(m), np.int64)
    if len(m) > 1:
        other = m[1:] != m[:-1]
        first = other.argmax(axis=1)
        out[1:] = np.where(other[np.arange(len(first)), first], first, ENTRY)
    return out


def _runs(cuts: np.ndarray, each: int):
    def run(batches):
        for group, rows in _groups(batches, "part"):
            repeated = [np.frombuffer(r["blob"], "<u8") for r in rows if r["kind"] == 1]
            if not repeated:
                continue
            data, offsets = _join(next(_unpack(r["blob"])[2] for r in rows if r["kind"] == 0))
            rows.clear()
            repeated = np.sort(np.concatenate(repeated))
            at, h = all_anchors(data, offsets)
            at = at[repeated[np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)] == h]
            doc = np.searchsorted(offsets, at, "right") - 1
            for a in range(0, len(at), RUN):  # so that the matrices stay small
                d, p = doc[a : a + RUN], at[a : a + RUN]
                m, right, left = entries(data, offsets[d], offsets[d + 1], p)
                order = np.argsort(m.view(f"S{ENTRY}").reshape(-1), kind="stable")
                m, right, left, d, p = m[order], right[order], left[order], d[order], p[order] - offsets[d[order]]
                new = _prefixes(m) < ENTRY
                new[:1] = True
                count = np.diff(np.flatnonzero(np.append(new, True)))
                several = np.repeat(count > 1, count)
                hit = several & (left + right >= WINDOW)
                if hit.any():
                    yield _spans_by_group(np.full(int(hit.sum()), group), d[hit], (p - left)[hit], (p + right)[hit])
                m, right, left, d, p, several = m[new], right[new], left[new], d[new], p[new], several[new]
                part = part_of(m[:, :K], cuts, each)
                out = []
                for x, y in _edges(part):
                    common = _prefixes(m[x:y])
                    tails = m[x:y][np.arange(ENTRY) >= common[:, None]]
                    out.append((int(part[x]), _pack(group, common.astype(np.uint16), tails, right[x:y].astype(np.uint8), left[x:y].astype(np.uint8), several[x:y], d[x:y].astype(np.uint32), p[x:y].astype(np.uint32))))
                yield _rows([x for x, _ in out], 2, [b for _, b in out])

    return run


# ---- step 3 -------------------------------------------------------------------------------------------------------


def decode_run(common: np.ndarray, tails: np.ndarray) -> list[bytes]:
    """The entries of a front-coded run."""
    out, last, at, raw = [], b"", 0, tails.tobytes()
    for c in common.tolist():
        last = last[:c] + raw[at : at + ENTRY - c]
        at += ENTRY - c
        out.append(last)
    return out


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two entries that agree on ``known`` bytes."""
    n = ENTRY
    if a[known:] == b[known:]:
        return n
    lo, step = known, 16
    while lo + step < n and a[lo : lo + step] == b[lo : lo + step]:
        lo += step
        step *= 2
    hi = min(n, lo + step)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo if a[lo] != b[lo] else lo + 1


def merge_runs(runs: list[tuple[list[bytes], list[int]]]):
    """Merge sorted runs (entries, and the common prefix of each with the one before it) with a loser tree.

    Yields (run, index, common prefix with the last output). A contender holds its common prefix with the last output:
    of two, the longer one is the smaller entry without a comparison; with equal ones bytes are compared from there
    on only, and the loser keeps its common prefix with the winner, which is the next output of that path.
    """
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    at = [0] * k
    size = [len(r[0]) for r in runs] + [0] * (k - len(runs))
    prefix = [0] * k
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs."""
        if at[b] >= size[b]:
            return a, b
        if at[a] >= size[a]:
            return b, a
        x, y = prefix[a], prefix[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        s, t = runs[a][0][at[a]], runs[b][0][at[b]]
        c = _common(s, t, x)
        if c == ENTRY or s[c] < t[c]:
            prefix[b] = c
            return a, b
        prefix[a] = c
        return b, a

    winners = [0] * (2 * k)
    winners[k:] = range(k)
    for i in range(k - 1, 0, -1):
        winners[i], losers[i] = play(winners[2 * i], winners[2 * i + 1])
    top = winners[1] if k > 1 else 0
    while at[top] < size[top]:
        yield top, at[top], prefix[top]
        at[top] += 1
        if at[top] < size[top]:
            prefix[top] = runs[top][1][at[top]]
        i = (top + k) // 2
        while i:
            top, losers[i] = play(top, losers[i])
            i //= 2


# ---- step 4 -------------------------------------------------------------------------------------------------------


def reaches(m: np.ndarray, right: np.ndarray, left: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each asking row of m how far it agrees to the left and right with other rows by a whole window; else 0, 0."""
    best_l, best_r = np.zeros(len(asks), np.int64), np.zeros(len(asks), np.int64)
    each = max(1, (2 << 20) // (ENTRY * len(m)))
    for a in range(0, len(asks), each):
        own = asks[a : a + each]
        other = m[own][:, None, :] != m[None, :, :]
        r = np.where(other[:, :, :WINDOW].any(axis=2), other[:, :, :WINDOW].argmax(axis=2), WINDOW)
        l = np.where(other[:, :, WINDOW:].any(axis=2), other[:, :, WINDOW:].argmax(axis=2), BEFORE)
        r, l = np.minimum(r, right[own][:, None]), np.minimum(l, left[own][:, None])
        r, l = np.minimum(r, right[None, :]), np.minimum(l, left[None, :])
        ok = r + l >= WINDOW
        ok[np.arange(len(own)), own] = False
        best_l[a : a + each] = np.where(ok, l, 0).max(axis=1)
        best_r[a : a + each] = np.where(ok, r, 0).max(axis=1)
    return best_l, best_r


def window_reaches(m: np.ndarray, right: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``reaches``, for all rows, by grouping equal windows at each distance of the anchor from the window's start.

    Windows are grouped by their hashes and compared with the first of their group; where a group has different ones,
    the windows of that distance are grouped by their bytes.
    """
    lo, hi = np.full(len(m), WINDOW), np.full(len(m), -1)
    distance = np.arange(BEFORE + 1)
    hashes = np.empty((len(m), BEFORE + 1), np.uint64)
    line = np.concatenate([m[:, WINDOW:][:, ::-1], m[:, :WINDOW]], axis=1)
    up, down = _powers("up", BASE, ENTRY), _powers("down", BASE_INVERSE, ENTRY + 1)
    with np.errstate(over="ignore"):
        for a in range(0, len(m), 5000):
            own = line[a : a + 5000]
            run = np.zeros((len(own), ENTRY + 1), np.uint64)
            np.cumsum(_byte_table()[own] * up, axis=1, out=run[:, 1:])
            hashes[a : a + 5000] = mix((run[:, ENTRY - distance] - run[:, BEFORE - distance]) * down[BEFORE - distance])
    for d in range(BEFORE + 1):
        own = np.flatnonzero((left >= d) & (right >= WINDOW - d))
        _, first, number, count = np.unique(hashes[own, d], return_index=True, return_inverse=True, return_counts=True)
        own, first, count = own[count[number] > 1], own[first[number]][count[number] > 1], None
        if not len(own):
            continue
        windows = slice(BEFORE - d, ENTRY - d)
        if any((line[own[a : a + 50_000], windows] != line[first[a : a + 50_000], windows]).any() for a in range(0, len(own), 50_000)):
            _, number, count = np.unique(np.ascontiguousarray(line[own, windows]).view(f"V{WINDOW}").reshape(-1), return_inverse=True, return_counts=True)
            own = own[count[number] > 1]
        lo[own], hi[own] = np.minimum(lo[own], d), d
    return np.where(hi >= 0, hi, 0), np.where(hi >= 0, WINDOW - lo, 0)


_MERGED = "part int, kind int, blob binary, group int, doc int, place long, d int, window binary, several boolean"


def _widen(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays([*batch.columns, *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()))], [*batch.schema.names, "group", "doc", "place", "d", "window", "several"])


def _windows(m, right, left, several, group, doc, place, near):
    """Rows with the windows that the neighbours' common prefixes leave possible."""
    for i in range(len(m)):
        line = np.concatenate([m[i, WINDOW : WINDOW + left[i]][::-1], m[i, : right[i]]]).tobytes()
        ds = range(WINDOW - min(int(near[i]), int(right[i])), int(left[i]) + 1)
        if not len(ds):
            continue
        n, s = len(ds), [int(left[i]) - d for d in ds]
        columns = [[0] * n, [3] * n, [None] * n, [int(group[i])] * n, [int(doc[i])] * n, [int(place[i])] * n, list(ds), [line[x : x + WINDOW] for x in s], [bool(several[i])] * n]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "kind", "blob", "group", "doc", "place", "d", "window", "several"])


def _merge(together: int, in_task: int):
    def run(batches):
        for part, rows in _groups(batches, "part"):
            for r in rows:
                if r["kind"] == 1:  # intervals on their way
                    yield _widen(_rows([part], 1, [r["blob"]]))
            runs = [_unpack(r["blob"]) for r in rows if r["kind"] == 2]
            if not runs:
                continue
            coded = [(decode_run(r[1], r[2]), r[1].tolist()) for r in runs]
            which, index, common = (np.asarray(x, np.int64) for x in zip(*merge_runs(coded)))
            start = np.concatenate([[0], np.cumsum([len(c[0]) for c in coded])])
            flat_at = start[which] + index
            right, left, several, doc, place = (np.concatenate([r[i] for r in runs]).astype(np.int64)[flat_at] for i in (3, 4, 5, 6, 7))
            group = np.asarray([r[0] for r in runs], np.int64)[which]
            matrix = np.frombuffer(b"".join(b"".join(c[0]) for c in coded), np.uint8).reshape(-1, ENTRY)
            new = common < ENTRY
            new[:1] = True
            entry = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            full = (np.diff(np.append(first, len(new))) > 1) | (np.bincount(entry, several) > 0)
            found_l, found_r = np.where(full, left[first], 0), np.where(full, right[first], 0)
            bound = common[first].copy()
            bound[:1] = 0
            heads = np.flatnonzero(bound < K)
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(first)]):
                if b - a < 2 or full[a:b].all():
                    continue
                own = first[a:b]
                m, r, l = matrix[flat_at[own]], right[own], left[own]
                if b - a <= together:
                    asks = np.flatnonzero(~full[a:b])
                    found_l[a + asks], found_r[a + asks] = reaches(m, r, l, asks)
                elif b - a <= in_task:
                    x, y = window_reaches(m, r, l)
                    asks = ~full[a:b]
                    found_l[a:b][asks], found_r[a:b][asks] = x[asks], y[asks]
                else:
                    near = np.maximum(bound[a:b], np.append(bound[a + 1 : b], 0))
                    near[0] = bound[a + 1]
                    yield from _windows(m, r, l, full[a:b], group[own], doc[own], place[own], np.minimum(near, WINDOW))
            l, r = found_l[entry], found_r[entry]
            hit = l + r >= WINDOW
            if hit.any():
                yield _widen(_spans_by_group(group[hit], doc[hit], (place - l)[hit], (place + r)[hit]))

    return run


def _window_intervals(batches):
    for batch in batches:
        group, doc, place, low, high = (np.asarray(batch.column(c)).astype(np.int64) for c in ("group", "doc", "place", "low", "high"))
        yield _spans_by_group(group, doc, place - high, place - low + WINDOW)


# ---- step 5 -------------------------------------------------------------------------------------------------------


def spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal runs."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)]


def _cut(with_text: bool):
    def run(batches):
        for _, rows in _groups(batches, "part"):
            keys, counts, texts = next(_unpack(r["blob"]) for r in rows if r["kind"] == 0)
            found = [_unpack(r["blob"]) for r in rows if r["kind"] == 1]
            doc, starts, ends = (np.concatenate([f[i] for f in found]).astype(np.int64) if found else np.zeros(0, np.int64) for i in range(3))
            order = np.argsort(doc, kind="stable")
            doc, starts, ends = doc[order], starts[order], ends[order]
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            out = []
            for i, (key, text, count) in enumerate(zip(keys, texts, counts)):
                s = e = ()
                if count > 1 and len(text) >= WINDOW:
                    s, e = [0], [len(text)]
                elif bounds[i] < bounds[i + 1]:
                    s, e = (x.tolist() for x in spans(starts[bounds[i] : bounds[i + 1]], ends[bounds[i] : bounds[i + 1]]))
                kept = b"".join(text[a:b] for a, b in zip([0, *e], [*s, len(text)])) if s else text
                out.append((key.hex(), len(text), len(text) - len(kept), len(s), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False, together: int = TOGETHER, in_task: int = IN_TASK) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (binary).

    Texts are UTF-8 bytes, null is empty; texts below WINDOW bytes lose nothing; a text of WINDOW bytes or more that
    stands in two rows loses all its bytes in both. Extra columns aren't read. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(text.alias("text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = tasks(spark, total, TASK_BYTES)
    n_buckets, n_groups, n_parts = (max(n, total // b) for b in (BUCKET_BYTES, GROUP_BYTES, PART_BYTES))
    groups = written(_dealt(plain.mapInArrow(lean(_texts(n_groups)), _ROW), n, "part").mapInArrow(lean(_whole_groups), _ROW), "groups")
    offers = groups.mapInArrow(lean(_offer(n_buckets, max(1, total // (K // 2) // SAMPLE))), "bucket int, part int, hashes binary, several binary, sample binary")
    answers = written(_dealt(offers, n, "bucket").mapInArrow(lean(_answer), _ROW), "answers")
    sample = [(bytes(r[0][:K]), int.from_bytes(r[0][K:], "big")) for r in answers.where("kind = 9").select("blob").collect()]  # some SAMPLE rows
    cuts = splitters(sample)
    runs = _dealt(groups.union(answers.where("kind = 1")), n, "part", "kind").mapInArrow(lean(_runs(cuts, -(-n_parts // (len(cuts) + 1)))), _ROW)
    merged = written(_dealt(runs, n, "part", "kind").mapInArrow(lean(_merge(together, in_task)), _MERGED), "merged")
    intervals = merged.where("kind = 1").select("part", "kind", "blob")
    asked = merged.where("kind = 3").select("group", "doc", "place", "d", "window", "several")
    if not asked.isEmpty():  # d is part of the key: two anchors in one window would count its one place twice
        met = asked.groupBy(F.col("window").alias("w"), F.col("d").alias("z")).agg(F.count(F.lit(1)).alias("n"), F.max("several").alias("s")).where("n > 1 or s").select("w", "z")
        ranges = asked.where(~F.col("several")).join(met, (F.col("window") == F.col("w")) & (F.col("d") == F.col("z"))).groupBy("group", "doc", "place").agg(F.min("d").alias("low"), F.max("d").alias("high"))
        intervals = intervals.union(ranges.mapInArrow(lean(_window_intervals), _ROW))
    result = _dealt(groups.union(intervals), n, "part", "kind").mapInArrow(lean(_cut(with_text)), "key string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.substring(F.sha2(text.cast("binary"), 256), 1, 32).alias("of"))
    out = ids.join(result, F.col("of") == F.col("key")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    return out if with_text else out.drop("kept")


def op4_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """What is left of every document, as digests; see ``remove_repeats`` for nulls, short texts and repeated rows."""
    return remove_repeats(table(spark, sf_dir, "documents"))
