"""Shared pieces: scratch tables, hashing of words in Arrow batches, batching by bytes.

The byte-level helpers work on a whole Arrow batch at a time: a word is a
maximal run of bytes outside ``\\x20\\x09-\\x0D``, and its 64-bit hash comes
from one cumulative sum over the batch, so no Python loop runs per word.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.session import checkpoint_dir

#: Regular expression of a word, for SQL functions.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled by one round of array operations in a task.
CHUNK_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns that aren't ``used`` renamed to their places, and what gives them their names back.

    So no column that is just passed on can meet a name that an operator works with.
    """
    names = list(docs.columns)
    plain = [c if c in used else f"column {i}" for i, c in enumerate(names)]

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in plain]).toDF(*names)
    return docs.toDF(*plain), back


def with_running_total(df: DataFrame, order: list[str], value: str, total: str, name: str) -> DataFrame:
    """Add ``total``: the sum of ``value`` over all rows before this one in ``order``.

    Rows are range-partitioned by the order columns; the sums of the
    partitions (one row each) give the offsets and a window inside each
    partition the rest.  Pass narrow rows.  The result doesn't depend on where
    the partition bounds fall; rows that tie on ``order`` come in any order.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), name)
    sums = rows.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(F.broadcast(offsets), "_part")       # one row per shuffle partition
            .withColumn(total, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_part", "_offset"))


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's batches, after which the worker gives memory back: it is kept for later tasks, beside the executor's heap."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # glibc only
        if trim:
            trim(0)
    return wrapped


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``CHUNK_BYTES`` of text (one row at least), with their bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offs = text_arrays(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + CHUNK_BYTES, side="right")) - 1)
            j = min(j, batch.num_rows)
            yield batch.slice(i, j - i), raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
            i = j


def words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of its document."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
    after = np.concatenate((solid[1:], [False])) & ~edge[1:]
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offs[1:], starts, side="right")


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        x = np.full(max(n, CHUNK_BYTES + 1024), base, dtype=np.uint64)
        x[0] = 1
        have = np.cumprod(x, dtype=np.uint64)
        if n <= 4 * CHUNK_BYTES:
            _powers[key] = have
    return have[:n]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes in every task."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _power(_P, len(raw)), dtype=np.uint64, out=sums[1:])
    value = (sums[ends] - sums[starts]) * _power(_P_INV, len(raw) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
