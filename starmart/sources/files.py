"""File sources and sinks: CSV landing feed, Parquet tables, materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import PANDAS_NA_VALUES


def read_feed_csv(
    spark: SparkSession,
    path: str,
    encoding: str = "ISO-8859-1",
    na_values: list[str] | None = None,
) -> DataFrame:
    """Header CSV in Latin-1, every column kept as text.

    Without ``inferSchema`` Spark reads only the header to name columns, so
    there is no sampling pass.  Names are trimmed (the source pads some with
    blanks); the strings pandas reads as missing become null.
    """
    df = (spark.read.option("header", True).option("encoding", encoding)
          .option("multiLine", False).option("mode", "FAILFAST").csv(path))
    df = df.toDF(*[c.strip() for c in df.columns])
    na = PANDAS_NA_VALUES if na_values is None else na_values
    return df.select([F.when(~F.col(f"`{c}`").isin(na), F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Full Parquet scan; ``columns`` prunes the read schema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_run(spark: SparkSession, path: str, run_id: int, run_col: str = "etl_run_id") -> DataFrame:
    """One landing run; raw is partitioned by run id so this prunes files."""
    return spark.read.parquet(path).where(F.col(run_col) == F.lit(run_id))


def lookup_keys(df: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    """Rows whose ``key`` is in a key DataFrame (semi join, not an IN list).

    ``keys=None`` means all rows; an empty key frame means none.
    """
    if keys is None:
        return df
    return df.join(keys.select(F.col(key)).distinct(), on=key, how="left_semi")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Table materialisation (full rebuild or append)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def register_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation as a temp view."""
    df.createOrReplaceTempView(name)
    return df


class TableRegistry:
    """Declared sources — a name -> Parquet path map with lazy reads."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        self.spark = spark
        self.paths = dict(paths)

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths[name])

    def exists(self, name: str) -> bool:
        return name in self.paths


def tpch_registry(spark: SparkSession, sf_dir: str) -> TableRegistry:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    return TableRegistry(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})
