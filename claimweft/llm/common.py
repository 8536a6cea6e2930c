"""What the corpus operators share: tables, shipping code, written tables, ranks, hashing."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that a Python worker turns into numpy arrays at once. Temporary arrays take some 60 times as much.
SLICE_BYTES = 2 << 20
#: Column names that operators use inside begin with this, so that columns of the input cannot clash with them.
INNER = "__cw_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each SparkContext, so that Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_claimweft_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    target = Path(tempfile.mkdtemp(prefix="claimweft-")) / "claimweft_src.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "claimweft").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(target))
    sc._claimweft_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in ``spark.checkpoint.dir``, which driver and executors share.

    In local mode, as in tests, a folder is made where the setting is unset; on a cluster that is an error.
    """
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = getattr(spark.sparkContext, "_claimweft_dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = spark.sparkContext._claimweft_dir = "file://" + tempfile.mkdtemp(prefix="claimweft-shared-")
    return f"{where.rstrip('/')}/claimweft-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._claimweft_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t._claimweft_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rename the columns of df that an operator would replace by its own, and a function that gives back df's columns."""
    held = {c: f"{INNER}own_{c}" for c in df.columns if c.lower() in names}
    return df.withColumnsRenamed(held), lambda out: out.select(*(F.col(held.get(c, c)).alias(c) for c in df.columns))


def salts(spark: SparkSession) -> int:
    """Into how many parts the rows of a hot key are dealt: the session's shuffle partitions, 1024 at most.

    No row is left out beyond that: a part is a sort that spills, and tables keyed by part stay small.
    """
    return max(1, min(1024, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def tasks(spark: SparkSession, n_bytes: int, each: int) -> int:
    """Tasks for a shuffle of n_bytes: as many as keep a task at ``each`` bytes, the session's partitions at least."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // each))


def salted_rank(df: DataFrame, keys: list[str], salt: Column, order: list[Column], out: str, parts: int) -> DataFrame:
    """Add out: the row's rank from 0 among the rows with equal keys, ordered by (salt, order).

    A hot key is dealt to ``parts`` tasks by ``salt`` (an integer from 0 to parts - 1); each part is ranked
    alone and shifted by the number of rows in the parts before it, which are at most ``parts`` rows a key.
    """
    s, n, before = f"{INNER}salt", f"{INNER}n", f"{INNER}before"
    dealt = df.withColumn(s, salt)
    part = [*keys, s]
    ranked = dealt.withColumn(out, F.row_number().over(Window.partitionBy(*part).orderBy(*order)) - 1)
    shift = (
        dealt.groupBy(*part).agg(F.count(F.lit(1)).alias(n))
        .withColumn(before, F.coalesce(F.sum(n).over(Window.partitionBy(*keys).orderBy(s).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(*(F.col(k).alias(f"{INNER}k{i}") for i, k in enumerate(part)), before)
    )
    same = [F.col(k).eqNullSafe(F.col(f"{INNER}k{i}")) for i, k in enumerate(part)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return ranked.join(shift, on, "left").withColumn(out, (F.col(out) + F.col(before)).cast("long")).drop(s, before, *(f"{INNER}k{i}" for i in range(len(part))))


# ---- numpy over whole Arrow columns -------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice), in place on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES):
    """Cut a record batch into runs of rows whose texts have about ``most`` bytes together (one row at least)."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, nulls as empty texts, and the n + 1 offsets of its rows in them."""
    if column.null_count:
        column = column.fill_null("")
    column = pa.concat_arrays([column.cast(pa.large_string())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lean(run: Callable) -> Callable:
    """``run`` over Arrow batches, after which the worker gives freed memory back: it stays alive beside later stages."""

    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # not every C library has it
            pass

    return wrapped


_TABLES: dict[str, np.ndarray] = {}


def _byte_table() -> np.ndarray:
    if "byte" not in _TABLES:
        _TABLES["byte"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _TABLES["byte"]


BASE = np.uint64(0xD1342543DE82EF95)
BASE_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _TABLES.get(name)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            _TABLES[name] = have = np.multiply.accumulate(p)
    return have[:n]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that are not ASCII white space: start, end, 64-bit hash, and row of each, in order."""
    n = len(data)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[offsets[:-1][offsets[:-1] < n]] = True
    starts_mask = solid.copy()
    starts_mask[1:] &= ~solid[:-1] | edge[1:n]
    starts = np.flatnonzero(starts_mask)
    ends_mask = solid.copy()
    ends_mask[:-1] &= ~solid[1:] | edge[1:n]
    ends = np.flatnonzero(ends_mask) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, span_hashes(data, starts, ends), rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of data[start:end] for each span, from one running sum over all bytes."""
    n = len(data)
    run = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_byte_table()[data] * _powers("up", BASE, n), out=run[1:])
        h = (run[ends] - run[starts]) * _powers("down", BASE_INVERSE, n + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """n + 1 bounds of the runs of each row number in the sorted array rows."""
    return np.searchsorted(rows, np.arange(n + 1))
