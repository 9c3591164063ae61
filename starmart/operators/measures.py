"""Additivity-aware rollups over the star.

Documented rules: line measures are fully additive; order-level values
repeat on every line and are counted once per order; ratios roll up as
weighted averages; sales per customer is recomputed; durations take
average or median only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.numeric import exact_sum
from starmart.operators.marts import sized_dimension
from starmart.operators.ordering import grouped_running

ADDITIVE = ["sales", "order_item_total", "order_item_discount", "order_item_quantity"]


def rollup_sales(df: DataFrame, by: list[str], measures: list[str] | None = None,
                 mode: str = "group", places: int | None = 4) -> DataFrame:
    """Sum of the additive measures by any dimensions.

    ``mode`` is ``group``, ``rollup`` (subtotals left to right) or ``cube``.
    Sums are exact decimal sums rounded at the scale of the data (price x
    rate has 4 decimals), so they do not depend on summation order.
    """
    measures = measures or ADDITIVE
    grouped = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[mode](*by)
    aggs = [exact_sum(F.col(m), places).alias(f"sum_{m}") for m in measures]
    return grouped.agg(*aggs, F.count(F.lit(1)).alias("n_lines"))


def sales_per_customer(df: DataFrame, by: list[str], places: int | None = 6) -> DataFrame:
    """``SUM(sales) / COUNT(DISTINCT customer_id)``; null for a group without a customer."""
    return df.groupBy(*by).agg(
        _r(F.try_divide(exact_sum(F.col("sales")), F.countDistinct("customer_id").cast("double")), places).alias("sales_per_customer"),
        F.countDistinct("customer_id").alias("n_customers"))


def order_level_once(df: DataFrame, by: list[str], column: str = "benefit_per_order",
                     places: int | None = 2) -> DataFrame:
    """An order-level value repeated on every line, counted once per order.

    Two aggregations on different keys: the per-order step is a partial hash
    aggregate, so only one row per order and map task crosses the shuffle.
    """
    per_order = df.groupBy(*by, "order_id").agg(F.max(column).alias("_v"))
    return per_order.groupBy(*by).agg(exact_sum(F.col("_v"), places).alias(f"sum_{column}"),
                                      F.count(F.lit(1)).alias("n_orders"))


def weighted_ratio(df: DataFrame, by: list[str], ratio: str = "order_item_discount_rate",
                   weight: str = "sales", places: int | None = 6) -> DataFrame:
    """``sum(ratio * weight) / sum(weight)``; null where the weights sum to zero."""
    return df.groupBy(*by).agg(
        _r(F.try_divide(F.sum(F.col(ratio) * F.col(weight)), F.sum(weight)), places).alias(f"weighted_{ratio}"))


def median_by_histogram(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Exact median (interpolated, as ``percentile(c, 0.5)``) per group.

    A rank search over value ranges: the (group, value) counts are range-partitioned
    by group and value, running counts inside the ranges with the ranges' totals
    carried over give every value its ranks, and the values that hold the
    two middle ranks are averaged.  A group with most of the rows, even with as
    many values as rows, spreads over all tasks; Spark's exact ``median`` would
    buffer every value of it in one.  Nulls take no part.
    """
    hist = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_c"))
    hist = hist.withColumn("_g", F.to_json(F.struct(*by), {"ignoreNullFields": "false"}))
    cum = grouped_running(hist, "_g", [column], {"_cum": ("sum", "_c")})
    totals = cum.groupBy("_g").agg(F.sum("_c").alias("_n"))
    ranked = cum.join(sized_dimension(totals), "_g")
    holds = lambda k: (F.col("_cum") >= k) & (F.col("_cum") - F.col("_c") < k)
    lo = F.max(F.when(holds(F.floor((F.col("_n") + 1) / 2)), F.col(column)))
    hi = F.max(F.when(holds(F.floor(F.col("_n") / 2) + 1), F.col(column)))
    return ranked.groupBy(*by).agg(((lo + hi) / 2).alias(f"median_{column}"))


def ship_days_avg_median(df: DataFrame, by: list[str], column: str = "days_for_shipping_real",
                         places: int | None = 4) -> DataFrame:
    """Average and median of a duration."""
    avg = df.groupBy(*by).agg(_r(F.avg(column), places).alias(f"avg_{column}"))
    median = median_by_histogram(df, by, column)
    both = avg.alias("a").join(median.alias("m"), reduce(Column.__and__, [F.col(f"a.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]), "left")
    return both.select(*[F.col(f"a.{c}").alias(c) for c in by], f"avg_{column}", f"median_{column}")


def monthly_category_sales(fact: DataFrame, dim_date: DataFrame, dim_products: DataFrame,
                           places: int | None = 2) -> DataFrame:
    """Star join of the fact with date and product dimensions, by month and category."""
    # Both dimensions are counted and broadcast within the bound, so the fact
    # is read in one stage and only the (month, category) partials shuffle.
    star = (fact.select("date_key", "product_card_id", "sales")
            .join(sized_dimension(dim_date.select("date_key", "year", "month")), "date_key")
            .join(sized_dimension(dim_products.select("product_card_id", "category_name")), "product_card_id"))
    return star.groupBy("year", "month", "category_name").agg(
        exact_sum(F.col("sales"), places).alias("total_sales"),
        F.count(F.lit(1)).alias("n_lines"))


def _r(c: Column, places: int | None) -> Column:
    return c if places is None else F.round(c, places)
