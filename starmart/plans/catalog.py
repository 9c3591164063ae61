"""Query catalogue: every operator run end to end over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL lives in ``starmart.plans.oracle``.  Column names and types are
aligned with the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import evaluation, extra_trees, features, landing, marts, measures, modeling, quality, runs, sync
from starmart.operators.history import History
from starmart.operators.key_index import KeyIndex
from starmart.operators.neighbours import nearest
from starmart.operators.ordering import global_row_number
from starmart.operators.staging import stage_orders
from starmart.functions.dates import DEFAULT_TS_FORMAT
from starmart.session import scratch_path, written
from starmart.streaming import cdc
from starmart.plans import pipeline
from starmart.schemas import CATEGORICAL_FEATURES, CUSTOMER_COLUMNS, FACT_COLUMNS, FEATURE_COLUMNS, LOCATION_COLUMNS, PRODUCT_COLUMNS, conform, serving_schema
from starmart.sources.files import lookup_keys, read_feed_csv, read_run, read_table, register_view, tpch_registry, write_table
from starmart.sources.fixtures import orders_feed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# What the fact is built from: its columns and those that its location key hashes.
FACT_INPUT = list(dict.fromkeys([c for c in FACT_COLUMNS if c != "shipping_location_id"] + LOCATION_COLUMNS))

# What the features are built from: those of the dimensions and of the row itself.
FEATURE_INPUT = list(dict.fromkeys(
    ["order_item_id", "order_id", "product_card_id", "date_key", "order_date", "full_date", "payment_type", "order_status", "shipping_mode", "sales", "sales_per_customer",
     "benefit_per_order", "order_profit_per_order", "order_item_total", "order_item_discount", "order_item_discount_rate", "order_item_profit_ratio", "order_item_quantity"]
    + CUSTOMER_COLUMNS + PRODUCT_COLUMNS + LOCATION_COLUMNS))


class Star:
    """Silver, dimensions and fact for one scale-factor directory (lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize_stg: bool = False, columns: list[str] | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        stg = stage_orders(orders_feed(spark, sf_dir))
        # columns: those of silver that the query's tables are built from
        stg = stg.select(*columns) if columns else stg
        # Queries whose plan reads silver in many branches write it once, as the
        # pipeline does: each branch reads only the columns it uses.  Light
        # queries recompute it.
        self.stg = written(stg) if materialize_stg else stg

    @property
    def fact(self) -> DataFrame:
        return marts.fact_order_items(self.stg)

    @property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.stg)

    @property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg)

    @property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg)

    @property
    def dim_location(self) -> DataFrame:
        return marts.dim_shipping_location(self.stg)


@query("monthly_category_sales")
def monthly_category_sales(spark, sf_dir):
    s = Star(spark, sf_dir, materialize_stg=True)
    return measures.monthly_category_sales(s.fact, s.dim_date, s.dim_products)


@query("stg_orders")
def stg_orders(spark, sf_dir):
    return Star(spark, sf_dir).stg


@query("dim_customers")
def dim_customers(spark, sf_dir):
    return Star(spark, sf_dir).dim_customers


@query("dim_products")
def dim_products(spark, sf_dir):
    return Star(spark, sf_dir).dim_products


@query("dim_date")
def dim_date(spark, sf_dir):
    return Star(spark, sf_dir).dim_date


@query("dim_shipping_location")
def dim_shipping_location(spark, sf_dir):
    return Star(spark, sf_dir).dim_location


@query("fact_order_items")
def fact_order_items(spark, sf_dir):
    return Star(spark, sf_dir).fact


# The fixture's order_status is F/O/P in near-equal parts; 'P' plays the
# role of the positive (fraud) status value.
FIXTURE_LABEL = "P"
NUMERIC_PROFILE_COLUMNS = [
    "order_item_quantity", "sales", "sales_per_customer", "benefit_per_order",
    "order_profit_per_order", "order_item_total", "order_item_discount",
    "order_item_discount_rate", "order_item_profit_ratio", "order_month", "order_day",
    "order_hour", "order_day_of_week", "product_price", "latitude", "longitude",
]


def feature_table(spark, sf_dir, audit=False):
    """The feature table over silver; it is written, so branches that reuse it read it again and make no second copy."""
    return features.own_features(Star(spark, sf_dir, columns=FEATURE_INPUT).stg, label_value=FIXTURE_LABEL, audit=audit)


@query("fraud_features")
def fraud_features(spark, sf_dir):
    return feature_table(spark, sf_dir)


@query("event_time_parts")
def event_time_parts(spark, sf_dir):
    return features.event_time_parts(spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("dim_customers_latest")
def dim_customers_latest(spark, sf_dir):
    stg = Star(spark, sf_dir).stg
    # Give customers several attribute versions (street changes per order priority).
    stg = stg.withColumn("customer_street", F.concat_ws(" ", "customer_street", "payment_type"))
    return marts.dim_customers(stg, dedupe="latest")


def _existing_fact(s: Star) -> DataFrame:
    return s.fact.where(F.col("order_date") < F.lit("1998-01-01").cast("timestamp_ntz"))


def _batch(s: Star) -> DataFrame:
    return s.stg.where(F.col("order_date") >= F.lit("1997-01-01").cast("timestamp_ntz"))


@query("fact_incremental_new_only")
def fact_incremental_new_only(spark, sf_dir):
    s = Star(spark, sf_dir, materialize_stg=True, columns=FACT_INPUT)
    return marts.fact_incremental(_batch(s), _existing_fact(s), mode="new_only")


@query("fact_incremental_null_target")
def fact_incremental_null_target(spark, sf_dir):
    s = Star(spark, sf_dir)
    dirty = (F.col("delivery_status") == "F") & (F.col("order_date") < F.lit("1995-02-01").cast("timestamp_ntz"))
    existing = _existing_fact(s).withColumn("order_item_id", F.when(~dirty, F.col("order_item_id")))
    return marts.fact_incremental(_batch(s), existing, mode="new_only")


@query("fact_merge")
def fact_merge(spark, sf_dir):
    s = Star(spark, sf_dir)
    existing = _existing_fact(s).withColumn("sales", F.col("sales") + 1)
    return marts.fact_incremental(_batch(s), existing, mode="merge")


@query("profile_numeric")
def profile_numeric(spark, sf_dir):
    p = features.profile_numeric(feature_table(spark, sf_dir), NUMERIC_PROFILE_COLUMNS)
    # reported to 4 places, as the reference logs them; 6 places can straddle a
    # rounding boundary when two engines sum in different orders
    return p.select("column_name", "min", "max", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query("profile_categorical_top5")
def profile_categorical_top5(spark, sf_dir):
    return features.profile_categorical(feature_table(spark, sf_dir), CATEGORICAL_FEATURES, top=5)


@query("profile_boolean")
def profile_boolean(spark, sf_dir):
    return features.profile_boolean(feature_table(spark, sf_dir), ["is_weekend"])


@query("class_balance")
def class_balance(spark, sf_dir):
    return features.class_balance(feature_table(spark, sf_dir))


# --- quality -----------------------------------------------------------------

def dirty_silver(stg: DataFrame) -> DataFrame:
    """Silver with injected defects for every landing rule (value-based)."""
    q = F.col("order_item_quantity")
    nan = F.lit(float("nan"))
    dirty = {
        "order_item_id": F.when(q == 13, F.lit(None)).when(q == 20, F.lit(1)).otherwise(F.col("order_item_id")),
        "order_item_quantity": F.when((F.col("shipping_mode") == "R") & (q < 5), q - 5).otherwise(q),
        "order_status": F.when(F.col("order_status") == "F", F.lit("CANCELED"))
                         .when((F.col("payment_type") == "5-LOW") & (q > 45), F.lit(None))
                         .otherwise(F.col("order_status")),
        "sales": F.when((F.col("delivery_status") == "O") & (q < 10), -F.col("sales")).otherwise(F.col("sales")),
        "order_item_discount_rate": F.when(q == 33, nan)
            .when(F.col("payment_type") == "1-URGENT", F.col("order_item_discount_rate") * 11)
            .otherwise(F.col("order_item_discount_rate")),
        "late_delivery_risk": F.when(q == 49, F.lit(2)).when(q == 48, F.lit(None))
            .otherwise(F.col("late_delivery_risk")),
    }
    return stg.select(*[dirty[c].cast(stg.schema[c].dataType).alias(c) if c in dirty else F.col(c)
                        for c in stg.columns])


@query("quality_landing")
def quality_landing(spark, sf_dir):
    return quality.landing_checks(dirty_silver(Star(spark, sf_dir).stg), names=quality.SILVER_NAMES)


def star_tables(s: Star, audit: bool = True) -> dict[str, DataFrame]:
    # The feature table feeds two full test passes (unique key, 30 not-null
    # columns); like the pipeline's written table it is computed once.
    customers, products = written(s.dim_customers), written(s.dim_products)
    feats = features.fraud_features_from_silver(s.stg, customers, products, label_value=FIXTURE_LABEL, audit=audit, own_dims=True)
    return {
        "stg_orders": s.stg, "dim_customers": customers, "dim_products": products,
        "dim_date": written(s.dim_date), "dim_shipping_location": written(s.dim_location), "fact_order_items": s.fact,
        "fraud_features": written(feats),
    }


@query("quality_suite")
def quality_suite(spark, sf_dir):
    return quality.run_model_tests(star_tables(Star(spark, sf_dir, materialize_stg=True)))


@query("quality_dirty")
def quality_dirty(spark, sf_dir):
    s = Star(spark, sf_dir, materialize_stg=True)
    two_versions = s.stg.withColumn("customer_street", F.concat_ws(" ", "customer_street", "payment_type"))
    products = written(s.dim_products)
    feats = features.fraud_features_from_silver(s.stg, written(s.dim_customers), products,
                                                label_value=FIXTURE_LABEL, audit=False, own_dims=True)
    feats = feats.withColumn("latitude", F.when(F.col("shipping_mode") != "A", F.col("latitude")))
    tables = {
        "dim_customers": marts.dim_customers(two_versions),
        "dim_products": products.where(F.col("product_status") == 0),
        "fact_order_items": s.fact,
        "fraud_features": written(feats),
    }
    tests = [t for t in quality.MART_TESTS
             if t.model in ("dim_customers", "fraud_features") and t.column != "created_at"
             or (t.model == "fact_order_items" and t.to_model in ("dim_products", "dim_customers"))]
    return quality.run_model_tests(tables, tests)


@query("quality_tolerance")
def quality_tolerance(spark, sf_dir):
    stg = Star(spark, sf_dir).stg
    q = F.col("order_item_quantity")
    stg = (stg.withColumn("sales", F.when(q != 50, F.col("sales")))
              .withColumn("product_price", F.when((q != 1) | (F.col("shipping_mode") != "N"), F.col("product_price"))))
    return quality.tolerance_checks(
        stg, ["sales", "product_price", "customer_id"], max_null_frac=0.015,
        date_column="order_date", date_min="1995-01-01 00:00:00", date_max="2000-12-31 23:59:59",
        status_column="order_status", allowed=["F", "O"])


def _runs_silver(s: Star) -> DataFrame:
    """Each order year plays one landing run."""
    return dirty_silver(s.stg).withColumn("etl_run_id", F.year("order_date").cast("long"))


@query("quality_by_run")
def quality_by_run(spark, sf_dir):
    return quality.landing_checks(_runs_silver(Star(spark, sf_dir)), names=quality.SILVER_NAMES, by=["etl_run_id"])


# --- measures ------------------------------------------------------------------

def _fact_products(s: Star) -> DataFrame:
    return s.fact.join(marts.sized_dimension(s.dim_products.select("product_card_id", "category_name",
                                                                   "department_name")), "product_card_id")


@query("rollup_sales")
def rollup_sales(spark, sf_dir):
    return measures.rollup_sales(_fact_products(Star(spark, sf_dir, materialize_stg=True)),
                                 ["department_name", "category_name"],
                                 mode="rollup")


@query("sales_per_customer")
def sales_per_customer(spark, sf_dir):
    return measures.sales_per_customer(Star(spark, sf_dir).fact, ["payment_type"])


@query("order_level_once")
def order_level_once(spark, sf_dir):
    return measures.order_level_once(Star(spark, sf_dir).fact, ["order_status"])


@query("weighted_ratio")
def weighted_ratio(spark, sf_dir):
    return measures.weighted_ratio(Star(spark, sf_dir).fact, ["shipping_mode"])


@query("ship_days_avg_median")
def ship_days_avg_median(spark, sf_dir):
    return measures.ship_days_avg_median(Star(spark, sf_dir).fact, ["shipping_mode", "delivery_status"])


@query("sales_median")
def sales_median(spark, sf_dir):
    """Median of a measure with nearly as many values as rows."""
    m = measures.median_by_histogram(Star(spark, sf_dir).fact.withColumn("shipping_mode", F.when(F.col("shipping_mode") != "A", F.col("shipping_mode"))), ["shipping_mode"], "sales")
    return m.select("shipping_mode", F.round("median_sales", 4).alias("median_sales"))


def monthly_fact(spark, sf_dir) -> tuple[str, Star]:
    """A fact partitioned by month whose sales are all one too high, after a rebuild of the months that urgent lines of early 1996 touch."""
    s = Star(spark, sf_dir, materialize_stg=True)
    path = scratch_path(spark, "months")
    write_table(s.fact.withColumn("sales", F.col("sales") + 1).withColumn("month_key", marts.month_key()), path, partition_by=["month_key"])
    batch = s.fact.where((F.col("payment_type") == "1-URGENT") & (F.col("order_date") >= _ts("1996-01-01")) & (F.col("order_date") < _ts("1996-04-01")))
    marts.rebuild_months(s.fact, batch.select(marts.month_key().alias("month_key")), path)
    return path, s


@query("fact_month_rebuild")
def fact_month_rebuild(spark, sf_dir):
    path, _ = monthly_fact(spark, sf_dir)
    return spark.read.parquet(path).select("order_item_id", "order_id", "date_key", "sales", "month_key")


@query("fact_months_pruned")
def fact_months_pruned(spark, sf_dir):
    """A quarter's weekend sales from that table: the days' months prune its partitions at run time."""
    path, s = monthly_fact(spark, sf_dir)
    days = written(s.dim_date).where((F.col("year") == 1996) & (F.col("month") <= 3) & F.col("is_weekend"))
    return marts.sales_of_days(spark.read.parquet(path), days)


# --- evaluation ----------------------------------------------------------------

def scored_lines(spark, sf_dir) -> DataFrame:
    """(order_item_id, label, score) with a deterministic score from the lines.

    The score sits on an exact grid (0.5 for open lines plus 5 x discount),
    so both engines compare identical doubles against the thresholds.
    """
    stg = Star(spark, sf_dir).stg
    return stg.select(
        "order_item_id", "order_id", "order_date",
        (F.col("order_status") == FIXTURE_LABEL).cast("int").alias("label"),
        (F.when(F.col("delivery_status") == "O", F.lit(0.5)).otherwise(F.lit(0.0))
         + F.col("order_item_discount_rate") * 5).alias("score"))


@query("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(scored_lines(spark, sf_dir), 0.5)


@query("threshold_sweep")
def threshold_sweep(spark, sf_dir):
    return evaluation.threshold_sweep(scored_lines(spark, sf_dir))


@query("best_threshold")
def best_threshold(spark, sf_dir):
    return evaluation.best_threshold(evaluation.threshold_sweep(scored_lines(spark, sf_dir)))


@query("roc_auc")
def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(scored_lines(spark, sf_dir))


@query("roc_curve")
def roc_curve(spark, sf_dir):
    c = evaluation.roc_curve(scored_lines(spark, sf_dir))
    return c.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query("class_report")
def class_report(spark, sf_dir):
    return evaluation.class_report(scored_lines(spark, sf_dir), 0.5)


# --- modeling ------------------------------------------------------------------

def split_features(spark, sf_dir) -> DataFrame:
    return modeling.stratified_split(feature_table(spark, sf_dir))


@query("stratified_split")
def stratified_split(spark, sf_dir):
    return split_features(spark, sf_dir).select("order_item_id", "target", "is_test")


@query("ordinal_encode")
def ordinal_encode(spark, sf_dir):
    # split, fit and encoding read the narrow feature table: cut once, as the pipeline writes it
    narrow = written(feature_table(spark, sf_dir).select("order_item_id", "target", *CATEGORICAL_FEATURES))
    split = written(modeling.stratified_split(narrow))
    mapping = modeling.fit_ordinal_encoder(split.where(~F.col("is_test")), CATEGORICAL_FEATURES)
    enc = modeling.apply_ordinal_encoder(split, mapping, CATEGORICAL_FEATURES)
    return enc.select("order_item_id", "is_test", *CATEGORICAL_FEATURES)


def rare_label_features(spark, sf_dir) -> DataFrame:
    """Feature table whose positive class is rare: urgent partially-shipped
    orders play SUSPECTED_FRAUD (about 7 % of lines)."""
    stg = Star(spark, sf_dir, columns=FEATURE_INPUT).stg.withColumn("order_status", F.when(
        (F.col("order_status") == "P") & (F.col("payment_type") == "1-URGENT"),
        F.lit("SUSPECTED_FRAUD")).otherwise(F.col("order_status")))
    return features.own_features(stg, audit=False)


def encoded_split(spark, sf_dir):
    # a narrow pass over the written features, so its readers need no second copy
    split = modeling.stratified_split(rare_label_features(spark, sf_dir))
    mapping = modeling.fit_ordinal_encoder(split.where(~F.col("is_test")), CATEGORICAL_FEATURES)
    return modeling.apply_ordinal_encoder(split, mapping, CATEGORICAL_FEATURES), mapping


MODEL_FEATURES = [c for c in FEATURE_COLUMNS]
RANGE_COLUMNS = ["sales", "order_item_quantity", "product_price"]


@query("smote_oversample")
def smote_oversample(spark, sf_dir):
    enc, _ = encoded_split(spark, sf_dir)
    train = enc.where(~F.col("is_test")).drop("is_test")
    return modeling.smote(train, MODEL_FEATURES)


@query("smote_neighbours")
def smote_neighbours(spark, sf_dir):
    """Squared distances of every minority training row to the five rows that it may be interpolated with."""
    enc, _ = encoded_split(spark, sf_dir)
    train = enc.where(~F.col("is_test")).drop("is_test")
    rows = modeling.minority_points(train, MODEL_FEATURES)
    near = nearest(rows.withColumnRenamed("_rid", "_rank"), 5, len(MODEL_FEATURES))
    return near.select(F.col("_rank").alias("order_item_id"), F.posexplode("_near").alias("place", "_n")).select(
        "order_item_id", (F.col("place") + 1).alias("place"), F.round("_n._d", 2).alias("squared_distance"))


@query("forest_scores")
def forest_scores(spark, sf_dir):
    enc, _ = encoded_split(spark, sf_dir)
    # depth 30, the default, takes ten times as long on this table
    model = modeling.train_oversampled(enc.where(~F.col("is_test")).drop("is_test"), MODEL_FEATURES, modeling.ForestParams(max_depth=12))
    scores = modeling.predict_proba(model, enc.where(F.col("is_test")), MODEL_FEATURES,
                                    keep=["order_item_id", "order_id", "target"])
    return modeling.to_predictions(scores, 0.5)


@query("smote_balance")
def smote_balance(spark, sf_dir):
    """Class sizes after oversampling, and synthetic values outside the minority's range."""
    out = written(smote_oversample(spark, sf_dir).select("target", "synthetic", *RANGE_COLUMNS))
    real = out.where((F.col("target") == 1) & ~F.col("synthetic"))
    low_high = real.agg(*[F.min(c).alias(f"lo_{c}") for c in RANGE_COLUMNS], *[F.max(c).alias(f"hi_{c}") for c in RANGE_COLUMNS])
    outside = F.lit(False)
    for c in RANGE_COLUMNS:
        outside = outside | (F.col(c) < F.col(f"lo_{c}")) | (F.col(c) > F.col(f"hi_{c}"))
    synthetic = out.where("synthetic").join(F.broadcast(low_high))          # one row
    n_outside = synthetic.agg(F.count_if(outside)).scalar()
    sizes = out.agg(F.count_if(F.expr("target = 0")).alias("n_majority"), F.count_if(F.expr("target = 1 AND NOT synthetic")).alias("n_minority"),
                    F.count_if(F.col("synthetic")).alias("n_synthetic"))
    return sizes.select("*", n_outside.alias("n_outside"))


@query("forest_checks")
def forest_checks(spark, sf_dir):
    """Scoring of the test split by a small forest: rows, scores out of range, labels that don't follow the threshold."""
    enc, _ = encoded_split(spark, sf_dir)
    model = modeling.train_oversampled(enc.where(~F.col("is_test")).drop("is_test"), MODEL_FEATURES, modeling.ForestParams(num_trees=10, max_depth=6))
    scores = modeling.to_predictions(modeling.predict_proba(model, enc.where("is_test"), MODEL_FEATURES, keep=["order_item_id", "order_id"]), 0.3)
    per_order = modeling.one_per_order(scores.drop("p"), keep="first")
    bad_label = F.col("predicted_label") != (F.col("p") >= 0.3)
    n_orders = per_order.agg(F.count(F.lit(1))).scalar()
    counts = scores.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if((F.col("p") < 0) | (F.col("p") > 1) | F.isnan("p")).alias("n_out_of_range"),
                        F.count_if(bad_label).alias("n_wrong_labels"))
    return counts.select("*", n_orders.alias("n_orders"))


@query("model_auc")
def model_auc(spark, sf_dir):
    """Both kinds of trees fitted to the oversampled split and scored on its test rows: rows scored, scores out of range, and whether the AUC beats chance."""
    enc, _ = encoded_split(spark, sf_dir)
    keep = ["order_item_id", "target"]
    train = written(modeling.smote(enc.where(~F.col("is_test")).drop("is_test"), MODEL_FEATURES).select(*MODEL_FEATURES, "target", "weight"))
    test = written(enc.where("is_test").select(*keep, *MODEL_FEATURES))
    forest = modeling.train_forest(train, MODEL_FEATURES, params=modeling.ForestParams(num_trees=10, max_depth=6))
    extra = extra_trees.fit(train, MODEL_FEATURES, num_trees=10, max_depth=6)
    rows = []
    for name, scores in (("random forest", modeling.predict_proba(forest, test, MODEL_FEATURES, keep)), ("extra trees", extra.predict(test, keep))):
        scores = written(scores.select(F.col("target").alias("label"), F.col("p").alias("score")))
        bad = F.count_if((F.col("score") < 0) | (F.col("score") > 1) | F.isnan("score"))
        rows.append(scores.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), bad.alias("n_out_of_range"))
                    .select("*", (evaluation.roc_auc(scores).select("roc_auc").scalar() > 0.5).alias("beats_chance")))
    return rows[0].unionByName(rows[1])


@query("feature_checks")
def feature_checks(spark, sf_dir):
    feats = feature_table(spark, sf_dir).drop("latitude")
    feats = feats.withColumn("target", F.when(F.col("shipping_mode") != "A", F.col("target")))
    return features.frame_checks(feats)


@query("stg_orders_text")
def stg_orders_text(spark, sf_dir):
    """The feed as a CSV landing has it, every column text, typed again by staging."""
    feed = orders_feed(spark, sf_dir)
    text = [F.date_format(F.col(f"`{f.name}`"), DEFAULT_TS_FORMAT) if f.dataType.typeName().startswith("timestamp") else F.col(f"`{f.name}`").cast("string")
            for f in feed.schema.fields]
    return stage_orders(feed.select(*[c.alias(f.name) for c, f in zip(text, feed.schema.fields)]))


@query("csv_feed")
def csv_feed(spark, sf_dir):
    """The feed written as Latin-1 CSV with padded column names, gzipped, read back as text and staged."""
    feed = orders_feed(spark, sf_dir)
    text = [F.date_format(F.col(f"`{f.name}`"), DEFAULT_TS_FORMAT) if f.dataType.typeName().startswith("timestamp") else F.col(f"`{f.name}`").cast("string")
            for f in feed.schema.fields]
    path = scratch_path(spark, "csv")
    feed.select(*text).toDF(*[f" {c} " for c in feed.columns]).write.option("header", True).option("encoding", "ISO-8859-1").option("compression", "gzip").option("zlib.compress.level", "FOUR").csv(path)
    return stage_orders(read_feed_csv(spark, path))


@query("prepared_features")
def prepared_features(spark, sf_dir):
    """The written feature table scanned and prepared for training: status and audit columns dropped."""
    path = write_table(feature_table(spark, sf_dir, audit=True), scratch_path(spark, "features"))
    return features.prepare_features(read_table(spark, path))


@query("view_scan")
def view_scan(spark, sf_dir):
    """Events by type from a registered view."""
    register_view(_events(spark, sf_dir), "sm_events")
    return spark.sql("SELECT event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users FROM sm_events GROUP BY event_type")


@query("land_stamped")
def land_stamped(spark, sf_dir):
    """A batch with its run id and ingest time."""
    return landing.stamp(event_batch(spark, sf_dir), 9, F.lit(FIXED_TS).cast("timestamp_ntz")).select("event_id", "ts", "value", "etl_run_id", "ingested_at")


@query("serving_products")
def serving_products(spark, sf_dir):
    """Products in the types that their serving table declares."""
    return conform(Star(spark, sf_dir).dim_products, serving_schema("dim_products"))


def _reports(spark, sf_dir) -> pipeline.Warehouse:
    wh = pipeline.Warehouse(scratch_path(spark, "reports"))
    pipeline.write_reports(spark, wh, scored_lines(spark, sf_dir), "v9")
    return wh


@query("report_sweep_csv")
def report_sweep_csv(spark, sf_dir):
    """The threshold sweep as the CSV report holds it."""
    like = evaluation.threshold_sweep(scored_lines(spark, sf_dir)).schema
    return spark.read.schema(like).option("header", True).csv(_reports(spark, sf_dir).path("reports/threshold_sweep"))


@query("report_metrics_json")
def report_metrics_json(spark, sf_dir):
    """Counts at the default threshold as the JSON report holds them."""
    text = spark.read.text(_reports(spark, sf_dir).path("reports/metrics"))
    counts = F.from_json("value", "model_version string, at_threshold_0_5 struct<tn: bigint, fp: bigint, fn: bigint, tp: bigint>")
    return text.select(counts.alias("m")).select("m.model_version", "m.at_threshold_0_5.*")


@query("score_new_orders")
def score_new_orders(spark, sf_dir):
    """The scoring job: a saved bundle is loaded, orders without a prediction are scored and added to a store that has the earlier ones."""
    wh = pipeline.Warehouse(scratch_path(spark, "scoring"))
    rare_label_features(spark, sf_dir).write.option("compression", "zstd").parquet(wh.path("warehouse/fraud_features"))
    feats = read_table(spark, wh.path("warehouse/fraud_features"))
    mapping = modeling.fit_ordinal_encoder(feats, CATEGORICAL_FEATURES)
    enc = modeling.apply_ordinal_encoder(feats, mapping, CATEGORICAL_FEATURES)
    model = modeling.train_forest(enc, MODEL_FEATURES, params=modeling.ForestParams(num_trees=10, max_depth=6))
    modeling.save_bundle(modeling.Bundle(model, mapping, MODEL_FEATURES, CATEGORICAL_FEATURES, 0.3, "v3"), wh.path("ml/bundle"))
    sync.VersionedTable(wh.path("warehouse/predictions")).write(stored_predictions(spark, sf_dir))
    state = pipeline.predict_new(spark, wh)
    p = F.col("fraud_probability")
    return state.select("prediction_id", "order_id", "threshold_used", "model_version", ((p >= 0) & (p <= 1) & (F.col("predicted_label") == ((p >= 0.3) & (F.col("model_version") == "v3")))).alias("sound"))


@query("run_scan")
def run_scan(spark, sf_dir):
    """One landing run read back from a table partitioned by run: other runs' files aren't opened."""
    path = scratch_path(spark, "runs")
    write_table(event_runs(spark, sf_dir), path, partition_by=["etl_run_id"])
    return read_run(spark, path, 17).select("event_id", "user_id", "event_type", "value", F.col("etl_run_id").cast("long").alias("etl_run_id"))


@query("order_lookup")
def order_lookup(spark, sf_dir):
    """Lines of the orders in a key table (urgent ones), through the registry of declared sources."""
    source = tpch_registry(spark, sf_dir)
    keys = source("orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    return lookup_keys(source("lineitem"), keys, "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("publish_new_rows")
def publish_new_rows(spark, sf_dir):
    """What publishing an insert-only table appends to a serving store that holds its older rows."""
    s = Star(spark, sf_dir, materialize_stg=True, columns=FACT_INPUT)
    store = sync.VersionedTable(scratch_path(spark, "serving"))
    store.write(_fact_target(s))
    sync.publish_table(sync.TableSpec("warehouse.fact_order_items", "order_item_id", "upsert"), s.fact, store, spark)
    return spark.read.parquet(f"{store.base}/{sync.VERSION_COL}=1").select("order_item_id", "order_id", "sales")


def merged_store(spark, sf_dir) -> sync.VersionedTable:
    """A serving store of lines before 1997 with old sales, then the lines of 1996 and 1997 merged in, then open ones of 1997 deleted."""
    fact = written(Star(spark, sf_dir).fact.select("order_item_id", "order_id", "order_status", "sales", "order_date"))
    year = F.year("order_date")
    store = sync.VersionedTable(scratch_path(spark, "merged"))
    store.write(fact.where(year < 1997).withColumn("sales", F.col("sales") + 1))
    store.merge(fact.where((year >= 1996) & (year <= 1997)), ["order_item_id"])
    store.merge(fact.where((year == 1997) & (F.col("order_status") == "O")).withColumn("gone", F.lit(True)), ["order_item_id"], deleted="gone")
    return store


@query("merge_store")
def merge_store(spark, sf_dir):
    """State read from a store that was changed by key: newest row of each, deleted ones left out."""
    return merged_store(spark, sf_dir).read(spark).drop("order_date")


@query("merge_store_writes")
def merge_store_writes(spark, sf_dir):
    """Rows that each version of that store has written: the batch's, not the table's."""
    store = merged_store(spark, sf_dir)
    entries = [(e.version, e.whole, e.rows) for e in store.entries(spark)]
    return spark.createDataFrame(entries, "version long, whole boolean, rows long")


@query("cdc_table")
def cdc_table(spark, sf_dir):
    """Each user's last event as a table kept by a change stream whose files come in an order of their own; an error deletes the user."""
    e = _events(spark, sf_dir).select("user_id", "event_id", "event_type", "value", F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"), F.col("event_id").alias("seq"))
    changes, table = scratch_path(spark, "changes"), scratch_path(spark, "cdc")
    e.repartition(4, F.xxhash64("event_id")).write.parquet(changes)
    cdc.start_cdc(spark, changes, e.schema, table, "user_id", scratch_path(spark, "cdc-log"), max_changes=2, options={"maxFilesPerTrigger": "1"}).awaitTermination()
    return sync.VersionedTable(table).read(spark)


# --- prediction store ------------------------------------------------------------

STORE_COLUMNS = ["prediction_id", "order_id", "fraud_probability", "predicted_label", "threshold_used",
                 "model_version", "pipeline_version"]
FIXED_TS = "2024-01-01 00:00:00"


def stored_predictions(spark, sf_dir) -> DataFrame:
    """A prediction store as an earlier run left it: every order before 1996."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    old = o.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("order_id"))
    ts = F.lit(FIXED_TS).cast("timestamp")
    return global_row_number(old, ["order_id"], out="prediction_id").select(
        F.col("prediction_id").cast("long"), "order_id", F.lit(0.25).alias("fraud_probability"),
        F.lit(False).alias("predicted_label"), F.lit(0.3).alias("threshold_used"),
        F.lit("v0").alias("model_version"), F.lit(modeling.PIPELINE_VERSION).alias("pipeline_version"),
        ts.alias("predicted_at"), ts.alias("created_at"), ts.alias("modified_at"))


def line_predictions(spark, sf_dir, threshold: float) -> DataFrame:
    lines = scored_lines(spark, sf_dir)
    return modeling.to_predictions(lines.select("order_id", "order_item_id", "order_date", F.col("score").alias("p")),
                                   threshold).drop("p")


@query("unscored_orders")
def unscored_orders(spark, sf_dir):
    return modeling.unscored_orders(feature_table(spark, sf_dir), stored_predictions(spark, sf_dir))


@query("first_score_per_order")
def first_score_per_order(spark, sf_dir):
    batch = modeling.one_per_order(line_predictions(spark, sf_dir, 0.3), keep="first")
    new = modeling.insert_if_absent(stored_predictions(spark, sf_dir), batch, 0.3, "v1")
    return new.select(*STORE_COLUMNS)


@query("upsert_predictions")
def upsert_predictions(spark, sf_dir):
    lines = line_predictions(spark, sf_dir, 0.4).where(F.col("order_date") >= F.lit("1995-07-01").cast("timestamp_ntz"))
    batch = modeling.one_per_order(lines, keep="last")
    state = modeling.upsert(stored_predictions(spark, sf_dir), batch, 0.4, "v2")
    return state.select(*STORE_COLUMNS)


# --- sync ----------------------------------------------------------------------

@query("sync_full")
def sync_full_q(spark, sf_dir):
    s = Star(spark, sf_dir)
    return sync.sync_full(s.dim_products, s.dim_products.where(F.col("product_status") == 0)).state


@query("sync_full_skip")
def sync_full_skip(spark, sf_dir):
    s = Star(spark, sf_dir)
    stale = s.dim_products.withColumn("product_price", F.col("product_price") + 1)
    return sync.sync_full(s.dim_products, stale).state


def _fact_target(s: Star) -> DataFrame:
    return (s.fact.where(F.col("order_date") < F.lit("1997-01-01").cast("timestamp_ntz"))
            .withColumn("sales", F.col("sales") + 1))


@query("sync_insert_only")
def sync_insert_only_q(spark, sf_dir):
    s = Star(spark, sf_dir, materialize_stg=True, columns=FACT_INPUT)
    return sync.sync_insert_only(s.fact, _fact_target(s), "order_item_id").state


def event_source(spark, sf_dir) -> DataFrame:
    """Local event table: purchases were modified 30 days after they happened."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    mod = F.when(F.col("event_type") == "purchase", F.col("ts") + F.expr("INTERVAL 30 DAYS")).otherwise(F.col("ts"))
    return e.select((F.col("event_id") * 10).alias("row_id"), "event_id", "ts", "user_id", "event_type",
                    "value", "props", mod.alias("modified_at"))


def event_target(spark, sf_dir) -> DataFrame:
    """Serving copy synced up to 2024-01-20, with stale values and its own serial ids."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    numbered = global_row_number(e, ["event_id"], out="row_id")
    return numbered.select(F.col("row_id").cast("long"), "event_id", "ts", "user_id", "event_type",
                           (F.col("value") + 1).alias("value"), "props", F.col("ts").alias("modified_at"))


@query("sync_watermark")
def sync_watermark(spark, sf_dir):
    return sync.sync_incremental(event_source(spark, sf_dir), event_target(spark, sf_dir), "event_id",
                                 "modified_at", ("row_id",)).state


def _local_remote(s: Star):
    local = {"dim_customers": s.dim_customers, "dim_products": s.dim_products, "dim_date": s.dim_date,
             "fact_order_items": s.fact}
    remote = {"dim_customers": s.dim_customers, "dim_products": s.dim_products.where(F.col("product_status") == 0),
              "dim_date": s.dim_date, "fact_order_items": _fact_target(s)}
    return local, remote


@query("sync_verify")
def sync_verify(spark, sf_dir):
    return sync.verify(*_local_remote(Star(spark, sf_dir, materialize_stg=True)))


@query("sync_verdict")
def sync_verdict(spark, sf_dir):
    return sync.verdict(sync.verify(*_local_remote(Star(spark, sf_dir, materialize_stg=True))), 4)


@query("sync_summary")
def sync_summary(spark, sf_dir):
    s = Star(spark, sf_dir, materialize_stg=True)
    registry = [
        sync.TableSpec("dim_customers", "customer_id", "full"),
        sync.TableSpec("dim_products", "product_card_id", "full"),
        sync.TableSpec("fact_order_items", "order_item_id", "upsert"),
        sync.TableSpec("events", "event_id", "incremental", "modified_at", ("row_id",)),
        sync.TableSpec("missing_table", "id", "full"),
    ]
    sources = {"dim_customers": s.dim_customers, "dim_products": s.dim_products, "fact_order_items": s.fact,
               "events": event_source(spark, sf_dir)}
    targets = {"dim_customers": s.dim_customers, "dim_products": s.dim_products.where(F.col("product_status") == 0),
               "fact_order_items": _fact_target(s), "events": event_target(spark, sf_dir)}
    _, stats = sync.sync_all(registry, sources, targets)
    return sync.sync_summary(stats)


@query("assign_serial_ids")
def assign_serial_ids(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("customer_id"),
                                                                "c_nationkey")
    existing = global_row_number(c.where(F.col("c_nationkey") < 10), ["customer_id"], out="serial_id")
    new = c.where(F.col("c_nationkey") >= 10)
    return sync.assign_serial(new, existing, "serial_id", "customer_id").select("customer_id", "serial_id")


# --- landing and runs --------------------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*EVENT_COLUMNS)


def _ts(v: str):
    return F.lit(v).cast("timestamp_ntz")


def event_batch(spark, sf_dir) -> DataFrame:
    """A landing batch: events from 2024-01-10 on, signups after the 25th sent
    twice, and errors after the 28th without an id."""
    e = _events(spark, sf_dir)
    main = e.where(F.col("ts") >= _ts("2024-01-10"))
    dup = e.where((F.col("event_type") == "signup") & (F.col("ts") >= _ts("2024-01-25")))
    nokey = e.where((F.col("event_type") == "error") & (F.col("ts") >= _ts("2024-01-28"))) \
             .withColumn("event_id", F.lit(None).cast("long"))
    return main.unionByName(dup).unionByName(nokey)


@query("land_new_rows")
def land_new_rows(spark, sf_dir):
    landed = _events(spark, sf_dir).where(F.col("ts") < _ts("2024-01-20"))
    return landing.new_rows(event_batch(spark, sf_dir), landed, key="event_id")


@query("land_indexed")
def land_indexed(spark, sf_dir):
    """A batch landed after three earlier runs, reading only the files that may hold its keys."""
    path, index = scratch_path(spark, "landed"), KeyIndex(scratch_path(spark, "key-index"), "event_id")
    e = _events(spark, sf_dir)
    for run, (begin, end) in enumerate([("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-20")], 1):
        landing.land(spark, e.where((F.col("ts") >= _ts(begin)) & (F.col("ts") < _ts(end))), path, run, "event_id", index=index)
    got = landing.land(spark, event_batch(spark, sf_dir), path, 4, "event_id", index=index)
    return got.select(*EVENT_COLUMNS)


@query("sync_full_by_rows")
def sync_full_by_rows(spark, sf_dir):
    """A copy with as many rows, one product in five with another price: it is replaced, as the rows differ."""
    dim = written(Star(spark, sf_dir).dim_products)
    stale = dim.withColumn("product_price", F.when(F.col("product_card_id") % 5 == 0, F.col("product_price") + 1).otherwise(F.col("product_price")))
    return sync.sync_full(dim, stale, by_rows=True).state


@query("same_rows")
def same_rows(spark, sf_dir):
    """Verdicts of the skip test by contents: the same rows in another order, a replaced row, a row less, other repeats."""
    e = written(_events(spark, sf_dir).drop("ts"))
    top = e.agg(F.max("event_id")).scalar()
    twice = lambda i: e.where(F.col("event_id") == i)
    cases = {"same": (e, e.orderBy(F.desc("event_id"))), "replaced": (e, e.withColumn("value", F.when(F.col("event_id") == top, F.lit(-1.0)).otherwise(F.col("value")))),
             "fewer": (e, e.where(F.col("event_id") != top)), "repeats": (e.unionByName(twice(top)), e.unionByName(twice(0)))}
    return spark.createDataFrame([(name, runs.counts_match(a, b), runs.same_rows(a, b)) for name, (a, b) in cases.items()], "case string, same_count boolean, same_rows boolean")


@query("land_evolve")
def land_evolve(spark, sf_dir):
    e = _events(spark, sf_dir)
    landed = e.where(F.col("ts") < _ts("2024-01-20")).drop("props")
    batch = landing.new_rows(e.where(F.col("ts") >= _ts("2024-01-20")), landed, key="event_id")
    return landing.evolve(landed, batch)


def event_runs(spark, sf_dir) -> DataFrame:
    """Events landed as daily runs: run id = day of month, ingest time = ts."""
    return _events(spark, sf_dir).select("*", F.dayofmonth("ts").cast("long").alias("etl_run_id"),
                                         F.col("ts").alias("ingested_at"))


def run_list(spark) -> DataFrame:
    return spark.range(1, 32).select(F.col("id").alias("etl_run_id"))


@query("run_audit")
def run_audit(spark, sf_dir):
    return runs.run_audit(event_runs(spark, sf_dir), run_list(spark))


def _mixed_runs(s: Star) -> DataFrame:
    """Order years as runs; 1995 and 1996 carry injected defects."""
    year = F.year("order_date")
    bad = dirty_silver(s.stg.where(year <= 1996))
    good = s.stg.where((year > 1996) | F.col("order_date").isNull())
    return bad.unionByName(good).withColumn("etl_run_id", F.year("order_date").cast("long"))


def _verdicts(s: Star) -> DataFrame:
    checks = quality.landing_checks(_mixed_runs(s), names=quality.SILVER_NAMES, by=["etl_run_id"])
    return runs.run_verdicts(checks)


@query("run_verdicts")
def run_verdicts(spark, sf_dir):
    return _verdicts(Star(spark, sf_dir))


@query("gate_passed_runs")
def gate_passed_runs(spark, sf_dir):
    s = Star(spark, sf_dir)
    return runs.passed_rows(_mixed_runs(s), _verdicts(s)).select("order_item_id", "etl_run_id")


def _event_audit(spark, sf_dir) -> DataFrame:
    """Audit of the daily event runs; days 1-20 validated (even days fail)."""
    audit = runs.run_audit(event_runs(spark, sf_dir), run_list(spark))
    v = run_list(spark).where(F.col("etl_run_id") <= 20).select(
        "etl_run_id", (F.col("etl_run_id") % 2).alias("checks_failed"),
        F.when(F.col("etl_run_id") % 2 == 0, F.lit(runs.PASSED)).otherwise(F.lit(runs.FAILED)).alias("validation_status"))
    return runs.apply_verdicts(audit, v)


@query("latest_pending_run")
def latest_pending_run(spark, sf_dir):
    return runs.latest_pending_run(_event_audit(spark, sf_dir))


@query("pipeline_snapshot")
def pipeline_snapshot(spark, sf_dir):
    s = Star(spark, sf_dir, materialize_stg=True)
    verdict = sync.verdict(sync.verify(*_local_remote(s)), 4)
    return runs.pipeline_snapshot(_event_audit(spark, sf_dir), s.fact,
                                  stored_predictions(spark, sf_dir), verdict)


# --- planned-only items ------------------------------------------------------------

def _addresses(stg: DataFrame) -> DataFrame:
    """Addresses change with the order priority, giving customers a history."""
    return stg.withColumn("customer_street", F.concat_ws(" ", "customer_street", "payment_type"))


def _ntz(history: DataFrame) -> DataFrame:
    """Dates exposed as zone-less timestamps so both engines hand over one type."""
    return (history.withColumn("effective_from", F.col("effective_from").cast("timestamp_ntz"))
            .withColumn("effective_to", F.col("effective_to").cast("timestamp_ntz")))


@query("scd2_customers")
def scd2_customers(spark, sf_dir):
    # written between the feed's joins and the day's snapshots, so that a task doesn't hold the sorts of both
    lines = written(_addresses(Star(spark, sf_dir).stg).select(*CUSTOMER_COLUMNS, "full_date", "order_date", "order_item_id"))
    return _ntz(marts.scd2(lines, "customer_id", CUSTOMER_COLUMNS[1:]))


def merged_history(spark, stg: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """A history into which the lines are merged half-year by half-year."""
    lines = stg.select(key, *attrs, "full_date", "order_date", "order_item_id", (F.year("full_date") * 2 + (F.month("full_date") > 6).cast("int")).alias("_half"))
    # partitioned, so that a half-year reads its own files
    path = write_table(lines.where("_half IS NOT NULL"), scratch_path(spark, "lines"), partition_by=["_half"])
    lines = spark.read.schema(lines.schema).parquet(path)
    history = History(scratch_path(spark, "history"), key, attrs)
    for r in lines.select("_half").distinct().orderBy("_half").collect():      # the half-years of the feed
        history.apply(lines.where(F.col("_half") == r["_half"]), max_changes=4)
    return history.read(spark)


@query("scd2_customers_merge")
def scd2_customers_merge(spark, sf_dir):
    return _ntz(merged_history(spark, _addresses(Star(spark, sf_dir).stg), "customer_id", CUSTOMER_COLUMNS[1:]))


@query("scd2_products_merge")
def scd2_products_merge(spark, sf_dir):
    # a product's status changes with the shipping mode
    stg = Star(spark, sf_dir).stg.withColumn("product_status", F.when(F.col("shipping_mode") == "A", 1).otherwise(0))
    return _ntz(merged_history(spark, stg, "product_card_id", PRODUCT_COLUMNS[1:]))
