"""Landing as a Structured Streaming job (S9, Spark-native form).

New feed files dropped in a folder are picked up by a file source; every
micro-batch runs the same anti join against the landed table and appends
the new rows as the batch's run partition.  ``trigger(availableNow=True)``
processes what is there and stops, which is the daily-batch schedule of the
reference; a processing-time trigger turns it into continuous landing.
The checkpoint location makes the job restartable after driver or
executor loss: a micro-batch is re-run with the same id and its partition
is overwritten, so a retried batch never lands twice.

With a ``window`` the stream keeps the keys of that much time in its state
(``dropDuplicatesWithinWatermark`` over arrival times, so no row is ever late):
rows whose key arrived within it are dropped without a look at the table, and
the anti join reads only rows that landed before it, through the key index if
there is one.  The state holds the keys of about two windows, whatever the
table's size.  A key lands once then, even if a batch repeats it; rows without
a key always land.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starmart.operators.key_index import KeyIndex
from starmart.operators.landing import new_rows, read_candidates, read_raw
from starmart.schemas import ORDER_ITEM_ID
from starmart.session import written


ARRIVED = "sm_arrived"


def land_batch(spark: SparkSession, raw_path: str, key: str, run_offset: int, window: str | None = None, index: KeyIndex | None = None):
    """foreachBatch body: stamp with run id = offset + batch id, append new rows."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        run_id = run_offset + batch_id
        arrived = F.current_timestamp()
        if window:
            batch = written(batch)                                       # the state is read once
            arrived = F.lit(batch.agg(F.max(ARRIVED)).first()[0]).cast("timestamp")      # a batch arrives at one time
            batch = batch.drop(ARRIVED)
        landed = read_raw(spark, raw_path) if index is None else read_candidates(spark, raw_path, batch, index)
        if landed is not None:
            # a retried micro-batch must not see its own earlier attempt
            landed = landed.where(F.col("etl_run_id") != run_id)
            if window:
                # keys that arrived since are in the state
                landed = landed.where(F.col("ingested_at") <= arrived - F.expr(f"INTERVAL {window}"))
        fresh = (new_rows(batch, landed, key)
                 .withColumn("etl_run_id", F.lit(run_id).cast("long"))
                 .withColumn("ingested_at", arrived))
        (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("etl_run_id").parquet(raw_path))
        if index is not None:
            table = read_raw(spark, raw_path)
            if table is not None:
                index.add(table.where(F.col("etl_run_id") == run_id))

    return fn


def start_landing(spark: SparkSession, source_dir: str, schema: T.StructType, raw_path: str,
                  checkpoint: str, fmt: str = "parquet", key: str = ORDER_ITEM_ID, run_offset: int = 1,
                  available_now: bool = True, options: dict[str, str] | None = None,
                  window: str | None = None, index: KeyIndex | None = None) -> StreamingQuery:
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)
    if window:
        # a row without a key is equal to no other
        known = F.coalesce(F.col(f"`{key}`").cast("string"), F.concat(F.lit("none-"), F.uuid()))
        stream = (stream.withColumn(ARRIVED, F.current_timestamp()).withColumn("_key", known)
                  .withWatermark(ARRIVED, window).dropDuplicatesWithinWatermark(["_key"]).drop("_key"))
    writer = stream.writeStream.foreachBatch(land_batch(spark, raw_path, key, run_offset, window, index)) \
                   .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
