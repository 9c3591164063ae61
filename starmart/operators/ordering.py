"""Order-dependent aggregates without a single-partition window.

A window with ``orderBy`` but no ``partitionBy`` runs in one task.  Here the
ordering column is cut into value ranges from an approximate-quantile
sketch (a few numbers on the driver, bounded by ``n_buckets``); a small
per-range total table gives each range its offset, and windows run inside
each range only.  Bucket membership depends on the value alone, so the
result is deterministic and recomputes identically after executor loss.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import written


def _n_buckets(df: DataFrame, n_buckets: int | None) -> int:
    if n_buckets:
        return n_buckets
    return max(2, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def value_buckets(df: DataFrame, order_col: str, n_buckets: int | None = None,
                  rel_error: float | None = None, out: str = "_bucket") -> DataFrame:
    """Attach a range-bucket id to every row (quantile splits of ``order_col``).

    The sketch's rank error defaults to a quarter of a bucket, so no bucket of
    distinct values outgrows the others by more than that at any count.
    """
    n = _n_buckets(df, n_buckets)
    rel_error = min(1e-3, 1 / (4 * n)) if rel_error is None else rel_error
    probs = [i / n for i in range(1, n)]
    cuts = df.select(F.col(order_col).cast("double").alias("_v")).approxQuantile("_v", probs, rel_error)
    inner = sorted(set(cuts)) or [0.0]        # empty input: one neutral split
    splits = [float("-inf")] + inner + [float("inf")]
    tmp = df.withColumn("_v", F.col(order_col).cast("double"))
    b = Bucketizer(splits=splits, inputCol="_v", outputCol=out, handleInvalid="keep")
    return b.transform(tmp).drop("_v")


def prefix_sums(df: DataFrame, order_col: str, value_cols: list[str], n_buckets: int | None = None,
                inclusive: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    """Add ``<v>_before`` = sum of ``v`` over rows ordered before this row.

    Rows are ordered by ``order_col`` then ``tiebreak``; with ``inclusive``
    the row's own value is included.
    """
    b = value_buckets(df, order_col, n_buckets)
    order = [F.col(order_col)] + [F.col(c) for c in (tiebreak or [])]
    totals = b.groupBy("_bucket").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    # One row per bucket: the ordered window over it is bounded by n_buckets.
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0)).alias(f"_o_{v}")
                                         for v in value_cols])
    frame_end = 0 if inclusive else -1
    wi = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    within = b.select("*", *[F.coalesce(F.sum(v).over(wi), F.lit(0)).alias(f"_w_{v}") for v in value_cols])
    joined = within.join(F.broadcast(offsets), "_bucket")
    return joined.select(*df.columns, *[(F.col(f"_o_{v}") + F.col(f"_w_{v}")).alias(f"{v}_before")
                                        for v in value_cols])


def global_row_number(df: DataFrame, order_cols: list[str], n_buckets: int | None = None,
                      out: str = "row_number") -> DataFrame:
    """Exact ``row_number() over (order by order_cols)`` (first column numeric).

    The first column decides the range bucket; the rest break ties.  Equal
    full keys are numbered in an arbitrary but stable order.
    """
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    numbered = prefix_sums(ones, order_cols[0], ["_one"], n_buckets, inclusive=True, tiebreak=order_cols[1:])
    return numbered.withColumnRenamed("_one_before", out).drop("_one")


def with_running_total(df: DataFrame, order: list[str], value: str, total: str) -> DataFrame:
    """Add ``total``: the sum of ``value`` over all rows before this one in ``order``.

    Rows are range-partitioned by the order columns; the sums of the
    partitions (one row each) give the offsets and a window inside each
    partition the rest.  Pass narrow rows.  The result doesn't depend on where
    the partition bounds fall; rows that tie on ``order`` come in any order.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    sums = rows.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(F.broadcast(offsets), "_part")       # one row per shuffle partition
            .withColumn(total, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_part", "_offset"))


def grouped_running(df: DataFrame, by: str, order: list[str], totals: dict[str, tuple[str, str]]) -> DataFrame:
    """Running aggregates inside each group of ``by``, up to and including the row, with no task per group.

    ``totals`` maps a new column to ``(function, column)``, the function being
    ``sum`` or ``bit_xor`` (those that combine by themselves).  ``by`` must not
    be null.  Rows are range-partitioned by ``by`` and ``order``, so a group
    with most of the rows spreads over many tasks; the only groups that cross a
    partition bound are the first and last ones of a partition, whose parts
    (two rows a partition) are carried over to the partitions after it.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.repartitionByRange(n, by, *order).withColumn("_part", F.spark_partition_id()))
    parts = rows.groupBy("_part", by).agg(*[F.expr(f"{f}(`{c}`)").alias(f"_sum_{out}") for out, (f, c) in totals.items()])
    one = F.struct(by, *[f"_sum_{out}" for out in totals])
    ends = (parts.groupBy("_part").agg(F.array_distinct(F.array(F.min(one), F.max(one))).alias("_ends"))
            .select("_part", F.inline("_ends")))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_part", by, *[F.expr(f"{f}(`_sum_{out}`)").over(before).alias(f"_carry_{out}") for out, (f, c) in totals.items()])
    inside = Window.partitionBy("_part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(F.broadcast(carried), ["_part", by], "left")        # two rows per shuffle partition at most
    for out, (f, c) in totals.items():
        own, carry = F.expr(f"{f}(`{c}`)").over(inside), F.coalesce(F.col(f"_carry_{out}"), F.lit(0))
        joined = joined.withColumn(out, own + carry if f == "sum" else own.bitwiseXOR(carry))
    return joined.drop("_part", *[f"_carry_{out}" for out in totals])
