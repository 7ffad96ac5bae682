"""Shared helpers: word splitting, vectorised substring hashing, shared-folder tables."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of bytes outside this class; ``bytes.split()`` splits at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"
MASK64 = (1 << 64) - 1


def _mix(x: int) -> int:
    """SplitMix64 finaliser, the rule that all pseudo-random tables here are built from."""
    x = (x + 0x9E3779B97F4A7C15) & MASK64
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK64
    return x ^ (x >> 31)


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers drawn from ``seed``."""
    return np.array([_mix(seed * 0x10001 + i) | 1 for i in range(n)], dtype=np.uint64)


def mix64(a: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser over an array."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


class SpanHash:
    """Hashes of arbitrary spans of one sequence in O(1) each, from a wrapped prefix sum.

    The sum of ``table[s[i]] * B**i`` over a span, times ``B**-start``, does not depend on where
    the span stands. Powers are kept and grown on demand.
    """

    _B = 0x9E3779B97F4A7C15
    _up = np.ones(1, dtype=np.uint64)
    _down = np.ones(1, dtype=np.uint64)

    @classmethod
    def _powers(cls, n: int) -> None:
        if len(cls._up) < n:
            size = max(n, 2 * len(cls._up), 1 << 16)
            for name, base in (("_up", cls._B), ("_down", pow(cls._B, -1, 1 << 64))):
                a = np.full(size, base, dtype=np.uint64)
                a[0] = 1
                setattr(cls, name, np.cumprod(a))

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self._up[:n], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self._down[start])


def bits_for(keys: int) -> int:
    """Bits of a table of so many keys: a power of two, 16 to 32 bits a key."""
    return 1 << max(20, (16 * max(1, keys) - 1).bit_length())


#: A key sets a bit for each of these shifts; all are set for one key in some 600 that the table doesn't hold.
PROBES = (0, 18, 36)


def collect_bits(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A table of ``bits`` bits as bytes, with the bits of every key (long) set. It is built by tasks, in slots of 4 KB."""
    value = F.explode(F.array(*(F.pmod(F.shiftrightunsigned(key, p), F.lit(bits)) + 1 for p in PROBES)))
    slots = keys.select(value.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("slot"))
    table = np.zeros(bits // 8, dtype=np.uint8)
    for r in slots.agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("map")).collect():
        table[4096 * (r["slot"] - 1) :][:4096] = np.frombuffer(r["map"], dtype=np.uint8)
    return table


def test_bits(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), dtype=bool)
    for p in PROBES:
        at = keys.view(np.uint64) >> np.uint64(p) & np.uint64(8 * len(table) - 1)
        found &= (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found


#: Folders that this process has made in the shared folder.
_MADE: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share.

    ``spark.checkpoint.dir`` names it. Only where that is unset and the session runs in one process (tests) a temporary
    folder is made; on a cluster an unset folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(base)
    _MADE.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def remove_tables(spark: SparkSession) -> None:
    """Delete every folder this process has made in the shared folder; for when results that read them are written."""
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, lost executors don't matter."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    if before is not None:
        spark.conf.set(key, "true")  # the shuffle files of this write go when it ends
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is not None:
            spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


_OWNED: dict[str, dict] = {}


def worker_memory(owner: str) -> dict:
    """What a Python worker keeps for an operator from task to task; what it kept for other operators goes."""
    others = [k for k in _OWNED if k != owner]
    for other in others:
        del _OWNED[other]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
    return _OWNED.setdefault(owner, {})


def release_memory() -> None:
    """Give what a Python worker has freed back to the system, at the end of a task; it stays for later tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Rows of an Arrow batch at most: texts are long, and both a task's JVM side and its worker hold whole batches.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_ROWS``, if they may be larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver's table, for queries of this subpackage: its session then has small Arrow batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(
    df: DataFrame, columns: list[str], schema: str, rows: Callable[[list], list[tuple]], step: int = 256
) -> DataFrame:
    """``mapInArrow`` over ``columns``: ``rows`` turns a list of at most ``step`` input tuples into output tuples."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                out = rows(list(zip(*(c.to_pylist() for c in batch.slice(lo, step).columns), strict=True)))
                cols = list(zip(*out, strict=True)) or [[] for _ in target]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), type=f.type) for c, f in zip(cols, target, strict=True)], schema=target
                )

    return df.select(*columns).mapInArrow(run, schema)


#: A key is heavy if it has more than one in so many of all rows: there are always fewer heavy keys than this.
HEAVY = 256


def heavy_keys(counts: DataFrame, weight: str, total: int, heavy: int = HEAVY) -> DataFrame:
    """Rows of ``counts``, one a key, whose ``weight`` is more than one in ``heavy`` of the total: fewer than ``heavy``."""
    return counts.filter(F.col(weight) > total // heavy)


def join_heavy(rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each value of ``keys`` (not null); ``hot`` is its rows of heavy keys.

    Heavy keys are few and broadcast, so their rows stay where they are; the others are shuffled.
    """
    near = rows.join(F.broadcast(hot), keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table.hint("merge"), keys)
    return near.unionByName(far)


def crc_bucket(column: str, modulus: int):
    """crc32 of a number written as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))
