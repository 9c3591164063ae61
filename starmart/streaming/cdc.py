"""Change-data-capture ingestion as a Structured Streaming merge.

Change rows (the table's columns plus an operation flag and a sequence
number) arrive as files.  Every micro-batch is reduced to the last change per
key (a max hash aggregate, not a sort) and merged as version ``batch_id + 1`` of a
``VersionedTable``: only the changes are written.  The table keeps each key's
sequence and marks of deleted keys, so a change that arrives in a later batch
than a newer one changes nothing: any split of the log into batches gives the
same table.  A retried batch rewrites its own version, so applying a batch
twice gives the same state.  Many changes are compacted into a whole state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart.operators.marts import merge_by_key
from starmart.operators.sync import VersionedTable

DELETE = "D"


def latest_changes(changes: DataFrame, key: str, seq: str = "seq", op: str = "op") -> DataFrame:
    """One change per key: the one with the highest sequence number, of those that tie a deletion or else the greatest."""
    others = [c for c in changes.columns if c != key]
    rank = F.struct(F.col(seq), F.coalesce(F.col(op) == DELETE, F.lit(False)), *others)
    agg = changes.groupBy(key).agg(F.max_by(F.struct(*others), rank).alias("_c"))
    return agg.select(key, *[F.col(f"_c.{c}").alias(c) for c in others])


def apply_changes(current: DataFrame | None, changes: DataFrame, key: str, op: str = "op",
                  seq: str = "seq") -> DataFrame:
    last = latest_changes(changes, key, seq, op)
    cols = [c for c in changes.columns if c not in (op, seq)]
    upserts = last.where(F.col(op) != DELETE).select(*cols)
    if current is None:
        return upserts
    deleted = last.where(F.col(op) == DELETE).select(key)
    kept = current.join(deleted, key, "left_anti")
    return merge_by_key(kept, upserts, key)


def merge_changes(table: VersionedTable, changes: DataFrame, key: str, op: str = "op", seq: str = "seq", version: int | None = None) -> str:
    """Write one version with the last change per key of ``changes``; one without a key names no row and takes no part."""
    last = latest_changes(changes.where(F.col(key).isNotNull()), key, seq, op).withColumn("_gone", F.col(op) == DELETE).drop(op)
    return table.merge(last, [key], deleted="_gone", seq=seq, version=version, replace=version is not None)


def start_cdc(spark: SparkSession, source_dir: str, schema: T.StructType, table_base: str, key: str,
              checkpoint: str, fmt: str = "parquet", op: str = "op", seq: str = "seq",
              available_now: bool = True, max_changes: int = 50, options: dict[str, str] | None = None) -> StreamingQuery:
    table = VersionedTable(table_base)

    def fn(batch: DataFrame, batch_id: int) -> None:
        merge_changes(table, batch, key, op, seq, version=batch_id + 1)
        table.compact(spark, max_changes=max_changes, share=1.0)

    stream = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(source_dir)
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
