"""Token ids as ORC: run-length coded id columns, row indexes and Bloom filters on document ids.

``write_tokens`` range-partitions documents by id, so the files, and the
stripes inside each, hold disjoint ascending id ranges: ORC's own min/max
indexes and Bloom filters on ``doc_id`` then let a reader skip files, stripes
and row groups (``find``).  The ids of a document are one ``array<int>``,
which ORC stores with its integer run-length encoding.  ``read_tokens`` reads
the files stripe-parallel and derives each document's place in the id stream
from what the files hold.

Defined results: a null text is empty and holds the end id only; rows that
repeat a ``doc_id`` all stay, in order of their text's hash; an empty table
gives an empty folder and no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm import tokens
from starmart.llm.common import by_bytes

SCHEMA = "doc_id long, n_tokens int, ids array<int>"
READ = "doc_id long, n_tokens long, ids_crc32 long, _file string"


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for rows, raw, offs in by_bytes(batches):
            ids, counts = enc.encode(raw, offs)
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.record_batch([rows.column(0), pa.array(counts.astype(np.int32)),
                                   pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["doc_id", "n_tokens", "ids"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, files: int | None = None,
                 stripe_bytes: int = 16 << 20, index_rows: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Encode ``docs(doc_id, text)`` and write ORC files of ascending, disjoint id ranges to ``path``.

    ``files`` defaults to ``spark.sql.shuffle.partitions``.  The commit is
    Spark's: task files become visible when the job ends.
    """
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
            .repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text"))
    (rows.mapInArrow(_encode(tokenizer or tokens.tokenizer_path()), SCHEMA)
     .write.option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", index_rows).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", bloom_fpp).orc(path))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        ids = np.asarray(lists.flatten()).astype("<u4")
        size = np.asarray(lists.value_lengths(), dtype=np.int64)
        ends = np.cumsum(size)
        raw = memoryview(ids.tobytes())
        crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), size.tolist())]
        yield pa.record_batch([batch.column(0), pa.array(size), pa.array(crc, pa.int64()), batch.column(2)],
                              ["doc_id", "n_tokens", "ids_crc32", "_file"])


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows: ``doc_id, n_tokens, ids``."""
    return spark.read.schema(SCHEMA).orc(path)


def find(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some documents; the filter reaches the ORC reader, which prunes by index and Bloom filter."""
    return open_tokens(spark, path).filter(F.col("doc_id").isin(doc_ids))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` is the number of ids of all documents before it.  Files hold
    disjoint id ranges, so it is the sum over earlier files (one row each)
    plus a running sum inside the file.
    """
    written = open_tokens(spark, path)
    rows = written.select("doc_id", "ids", F.input_file_name().alias("_file")).mapInArrow(_digest, READ)
    # the counts alone give the offsets; files are named by partition, so by length and name they ascend as their ids do
    sums = written.select("n_tokens", F.input_file_name().alias("_file")).groupBy("_file").agg(F.sum("n_tokens").alias("_sum"))
    offsets = sums.select("_file", F.coalesce(F.sum("_sum").over(
        Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_file").orderBy("doc_id", "_at").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_at", F.monotonically_increasing_id())
            .join(F.broadcast(offsets), "_file")           # one row per file
            .select("doc_id", (F.col("_offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
                    "n_tokens", "ids_crc32"))
