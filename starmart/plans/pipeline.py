"""End-to-end jobs: land -> validate -> build warehouse -> train -> score -> publish.

Each job reads Parquet tables and writes Parquet tables under a warehouse
root (a shared cluster path).  Silver is written once and every downstream
model reads it (the reference recomputes its staging view per model).
Plans between the writes are left to Catalyst and AQE.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators import evaluation, features, landing, marts, modeling, quality, runs, sync
from starmart.operators.staging import stage_orders
from starmart.session import written
from starmart.schemas import CATEGORICAL_FEATURES, FEATURE_COLUMNS, LABEL_VALUE


@dataclass
class Warehouse:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.option("mergeSchema", True).parquet(self.path(name))


def land_and_validate(spark: SparkSession, wh: Warehouse, batch: DataFrame, run_id: int) -> DataFrame:
    """Entry point A, first half: land one run, validate it, record the audit."""
    landed = landing.land(spark, batch, wh.path("raw/orders_raw"), run_id)
    checks = quality.landing_checks(landed, by=["etl_run_id"])
    verdicts = runs.run_verdicts(checks)
    audit = runs.apply_verdicts(runs.run_audit(landed), verdicts)
    audit.write.mode("append").parquet(wh.path("raw/etl_runs"))
    checks.write.mode("append").parquet(wh.path("raw/landing_checks"))
    return verdicts


def build_warehouse(spark: SparkSession, wh: Warehouse, passed_only: bool = False,
                    label_value: str = LABEL_VALUE, ts_format: str | None = None,
                    partition_fact: bool = True) -> dict[str, str]:
    """Entry point B: silver, four dimensions, fact (new rows only) and features.

    The fact is partitioned by order month (``month_key`` = yyyymm), so
    month-filtered rollups read only their partitions.
    """
    raw = wh.read(spark, "raw/orders_raw")
    if passed_only:
        checks = spark.read.parquet(wh.path("raw/landing_checks"))
        raw = runs.passed_rows(raw, runs.run_verdicts(checks))
    stg = stage_orders(raw) if ts_format is None else stage_orders(raw, ts_format)
    stg.write.mode("overwrite").parquet(wh.path("staging/stg_orders"))
    stg = spark.read.parquet(wh.path("staging/stg_orders"))

    out = {}
    for name, df in (("dim_customers", marts.dim_customers(stg)), ("dim_products", marts.dim_products(stg)),
                     ("dim_date", marts.dim_date(stg)), ("dim_shipping_location", marts.dim_shipping_location(stg))):
        df.write.mode("overwrite").parquet(wh.path(f"warehouse/{name}"))
        out[name] = wh.path(f"warehouse/{name}")

    fact_path = wh.path("warehouse/fact_order_items")
    existing = landing.read_raw(spark, fact_path)
    fact = (marts.fact_order_items(stg) if existing is None
            else marts.fact_incremental(stg, existing, "new_only"))
    writer = fact.withColumn("month_key", marts.month_key()).write if partition_fact else fact.write
    writer = writer.partitionBy("month_key") if partition_fact else writer
    writer.mode("overwrite" if existing is None else "append").parquet(fact_path)
    out["fact_order_items"] = fact_path

    feats = features.fraud_features(
        spark.read.parquet(fact_path), spark.read.parquet(out["dim_customers"]),
        spark.read.parquet(out["dim_products"]), spark.read.parquet(out["dim_date"]),
        spark.read.parquet(out["dim_shipping_location"]), label_value=label_value)
    feats.write.mode("overwrite").parquet(wh.path("warehouse/fraud_features"))
    out["fraud_features"] = wh.path("warehouse/fraud_features")
    return out


def check_models(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The 51 declared model tests over the written tables, as one result table."""
    names = ["dim_customers", "dim_products", "dim_date", "dim_shipping_location", "fact_order_items",
             "fraud_features"]
    tables = {n: spark.read.parquet(wh.path(f"warehouse/{n}")) for n in names}
    tables["stg_orders"] = spark.read.parquet(wh.path("staging/stg_orders"))
    res = quality.run_model_tests(tables)
    res.write.mode("overwrite").parquet(wh.path("reports/model_tests"))
    return spark.read.parquet(wh.path("reports/model_tests"))


def write_reports(spark: SparkSession, wh: Warehouse, scored: DataFrame, model_version: str) -> dict:
    """Sweep as CSV, metrics as JSON, class report and ROC curve as tables, of (label, score) rows.

    The threshold is the arg-max of the unrounded F1, 0.5 kept when no F1 > 0.
    Seven aggregates read the rows, so label and score are written once.
    """
    scored = written(scored.select("label", "score"))
    evaluation.threshold_sweep(scored).coalesce(1).write.mode("overwrite").option("header", True).csv(wh.path("reports/threshold_sweep"))
    best = evaluation.best_threshold(evaluation.threshold_sweep(scored, places=None), variant="train").first()
    threshold = float(best["threshold"])
    # metrics at the default 0.5, then at the deployed threshold (saved artefacts use the latter)
    at_default = evaluation.with_metrics(evaluation.confusion_matrix(scored, 0.5)).first().asDict()
    cm = evaluation.with_metrics(evaluation.confusion_matrix(scored, threshold)).first().asDict()
    auc = evaluation.roc_auc(scored).first()["roc_auc"]
    metrics = {**cm, "roc_auc": auc, "threshold": threshold, "model_version": model_version,
               "at_threshold_0_5": at_default}
    spark.createDataFrame([(json.dumps(metrics),)], "metrics string").coalesce(1) \
        .write.mode("overwrite").text(wh.path("reports/metrics"))
    evaluation.class_report(scored, threshold).write.mode("overwrite").parquet(wh.path("reports/class_report"))
    evaluation.roc_curve(scored).write.mode("overwrite").parquet(wh.path("reports/roc_curve"))
    return metrics


def train(spark: SparkSession, wh: Warehouse, model_version: str = "1.0",
          forest: modeling.ForestParams | None = None) -> dict:
    """Split, encode, oversample, fit, evaluate, tune the threshold and save the bundle."""
    feats = features.prepare_features(spark.read.parquet(wh.path("warehouse/fraud_features")))
    errors = features.check_frame(feats, required=[c for c in features.REQUIRED_COLUMNS if c != "order_status"])
    if errors:
        raise ValueError("; ".join(errors))
    split = modeling.stratified_split(feats)
    split.write.mode("overwrite").parquet(wh.path("ml/split"))
    split = spark.read.parquet(wh.path("ml/split"))
    mapping = modeling.fit_ordinal_encoder(split.where(~F.col("is_test")), CATEGORICAL_FEATURES)
    enc = modeling.apply_ordinal_encoder(split, mapping, CATEGORICAL_FEATURES)
    train_set = modeling.smote(enc.where(~F.col("is_test")).drop("is_test"), FEATURE_COLUMNS)
    train_set.write.mode("overwrite").parquet(wh.path("ml/train_resampled"))
    model = modeling.train_forest(spark.read.parquet(wh.path("ml/train_resampled")), FEATURE_COLUMNS, params=forest)

    test = enc.where(F.col("is_test"))
    scores = modeling.predict_proba(model, test, FEATURE_COLUMNS, keep=["order_item_id", "order_id", "target"])
    scores.write.mode("overwrite").parquet(wh.path("ml/test_scores"))
    scored = spark.read.parquet(wh.path("ml/test_scores")).select("order_item_id", "order_id",
                                                                  F.col("target").alias("label"),
                                                                  F.col("p").alias("score"))
    metrics = write_reports(spark, wh, scored, model_version)
    threshold = metrics["threshold"]
    (modeling.to_predictions(spark.read.parquet(wh.path("ml/test_scores")), threshold)
     .write.mode("overwrite").option("header", True).csv(wh.path("reports/test_predictions")))
    modeling.save_bundle(modeling.Bundle(model, mapping, FEATURE_COLUMNS, CATEGORICAL_FEATURES, threshold,
                                         model_version), wh.path("ml/bundle"))
    return metrics


def predict_new(spark: SparkSession, wh: Warehouse, order_ids: DataFrame | None = None) -> DataFrame:
    """Entry point C: score unscored orders (insert-if-absent), or rescore the
    given order keys (upsert).  The store is versioned; returns the new state."""
    bundle = modeling.load_bundle(spark, wh.path("ml/bundle"))
    store = sync.VersionedTable(wh.path("warehouse/predictions"))
    current = store.read(spark)
    current = modeling.empty_predictions(spark) if current is None else current
    feats = features.prepare_for_prediction(spark.read.parquet(wh.path("warehouse/fraud_features")))
    if order_ids is None:
        keys = written(modeling.unscored_orders(feats, current))
        most = 3 * keys.count() >= current.count()          # a quarter of the orders or more
        scored = modeling.score(bundle, feats, keep=["order_id", "order_item_id"], orders=keys, most=most)
        batch = modeling.one_per_order(scored.drop("p"), keep="first")
        new = written(modeling.insert_if_absent(current, batch, bundle.threshold, bundle.model_version))
        if store.latest_version(spark) is None:
            store.write(new)
        elif not new.isEmpty():
            store.append(new)
    else:
        scored = modeling.score(bundle, feats, keep=["order_id", "order_item_id"], orders=order_ids.select("order_id").distinct())
        batch = modeling.one_per_order(scored.drop("p"), keep="last")
        if store.latest_version(spark) is None:
            store.write(current)
        store.merge(modeling.upsert_rows(current, batch, bundle.threshold, bundle.model_version), ["order_id"])
        store.compact(spark, max_changes=50, share=0.5)
    return store.read(spark)


def publish(spark: SparkSession, wh: Warehouse, serving_root: str,
            registry: list[sync.TableSpec] | None = None, force_full: bool = False) -> DataFrame:
    """Sync every registry table to the serving root; what changed becomes a new version of its table."""
    registry = registry or sync.DEFAULT_REGISTRY
    results = []
    for spec in registry:
        name = spec.table.split(".")[-1]
        src = (sync.VersionedTable(wh.path("warehouse/predictions")).read(spark) if name == "predictions"
               else landing.read_raw(spark, wh.path(f"warehouse/{name}")))
        results.append(sync.publish_table(spec, src, sync.VersionedTable(f"{serving_root}/{name}"), spark, force_full))
    stats = results[0]
    for s in results[1:]:
        stats = stats.unionByName(s)
    stats.write.mode("overwrite").parquet(f"{serving_root}/_sync_stats")
    return spark.read.parquet(f"{serving_root}/_sync_stats")
