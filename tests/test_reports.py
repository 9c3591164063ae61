"""Reports: how often the scored rows are read."""

from pyspark.sql import functions as F

from starmart.plans import pipeline


def test_reports_read_the_scored_rows_once(spark, tmp):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    scored = spark.range(100).select((F.col("id") % 2).cast("int").alias("label"), (F.col("id") / 100).alias("score")).mapInPandas(count, "label int, score double")
    pipeline.write_reports(spark, pipeline.Warehouse(tmp), scored, "v1")
    assert seen.value == 100
