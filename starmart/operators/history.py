"""SCD type 2 history kept by merging new days (§2.11).

A history is a ``VersionedTable`` keyed by the dimension's key and
``effective_from``.  A batch of new days touches the keys that it has: their
open versions are read, closed where attributes change, and new versions are
added; only those rows are written.  Applying days in any batches gives the
history that ``marts.scd2`` gives over all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.operators.marts import daily_snapshots, signature
from starmart.operators.store import VersionedTable
from starmart.session import written


@dataclass
class History:
    """The versions of a dimension's rows under ``base``."""
    base: str
    key: str
    attrs: list[str]

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(f"{self.base}/versions")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All versions, as ``marts.scd2`` has them."""
        return self.table.read(spark)

    def through(self, spark: SparkSession):
        """The last day applied."""
        try:
            return spark.read.parquet(f"{self.base}/_days").agg(F.max("day")).first()[0]
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def apply(self, lines: DataFrame, date_col: str = "full_date", max_changes: int = 50) -> int:
        """Merge the days of ``lines``, all later than those applied before; returns the rows written.

        Lines without key or day take no part.  Days that aren't later are an
        error, as the versions no longer tell what was seen on such a day.
        """
        spark = lines.sparkSession
        daily = written(daily_snapshots(lines, self.key, self.attrs, date_col))
        first, last = daily.agg(F.min(date_col), F.max(date_col)).first()
        if first is None:
            return 0
        known = self.through(spark)
        if known is not None and first <= known:
            raise ValueError(f"days up to {known} are applied; the batch begins with {first}")
        before = self.read(spark)
        new = daily.select(self.key, F.col(date_col).alias("effective_from"), *self.attrs, F.lit(False).alias("_open"))
        if before is not None:
            touched = daily.select(self.key).distinct()
            opened = before.where("is_current").join(touched, self.key, "left_semi")
            new = new.unionByName(opened.select(self.key, "effective_from", *self.attrs, F.lit(True).alias("_open")))
        days = Window.partitionBy(self.key).orderBy("effective_from")
        changes = (new.withColumn("_sig", signature(self.attrs)).withColumn("_prev", F.lag("_sig").over(days))
                   .where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_sig"))))
        versions = changes.withColumn("effective_to", F.lead("effective_from").over(days))
        # an open version that stays open is not written again
        rows = versions.where(~F.col("_open") | F.col("effective_to").isNotNull()).select(
            self.key, *self.attrs, "effective_from", "effective_to", F.col("effective_to").isNull().alias("is_current"))
        self.table.merge(rows, [self.key, "effective_from"])
        spark.createDataFrame([(last,)], daily.select(F.col(date_col).alias("day")).schema).coalesce(1).write.mode("append").parquet(f"{self.base}/_days")
        n = self.table.entries(spark)[-1].rows
        self.table.compact(spark, max_changes=max_changes, share=1.0)
        return n
