import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.operators import evaluation, ordering


def _scores(spark, pairs):
    return spark.createDataFrame([(float(s), int(y)) for s, y in pairs], "score double, label int")


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_fixture_scores(spark):
    df = _scores(spark, [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)])
    assert evaluation.roc_auc(df).first()["roc_auc"] == 0.625
    cm = evaluation.confusion_matrix(df, 0.5).first()
    assert (cm["tp"], cm["fp"], cm["fn"], cm["tn"]) == (2, 1, 0, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_sweep_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, 800)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)   # many ties
    pairs = list(zip(s.tolist(), y.tolist()))
    df = _scores(spark, pairs)
    auc = evaluation.roc_auc(df, n_buckets=7, places=None).first()["roc_auc"]
    assert abs(auc - brute_auc(pairs)) < 1e-12
    sweep = {r["threshold"]: r for r in evaluation.threshold_sweep(df).collect()}
    for t in evaluation.THRESHOLDS:
        pred = s >= t
        tp, fp = int((pred & (y == 1)).sum()), int((pred & (y == 0)).sum())
        fn, tn = int((~pred & (y == 1)).sum()), int((~pred & (y == 0)).sum())
        r = sweep[round(t, 2)]
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (tp, fp, fn, tn)
        f1 = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
        assert r["f1"] == round(f1, 4)
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(pairs)


def test_best_threshold_variants(spark):
    sweep = spark.createDataFrame([(0.1, 0.5), (0.2, 0.7), (0.3, 0.7)], "threshold double, f1 double")
    assert evaluation.best_threshold(sweep).first()["threshold"] == 0.2
    zero = spark.createDataFrame([(0.1, 0.0), (0.2, 0.0)], "threshold double, f1 double")
    assert evaluation.best_threshold(zero, variant="train").first()["threshold"] == 0.5


def test_roc_curve_endpoints(spark):
    df = _scores(spark, [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)])
    pts = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluation.roc_curve(df).collect()}
    assert pts[float("inf")] == (0.0, 0.0)
    assert pts[0.1] == (1.0, 1.0) and pts[0.9] == (0.5, 0.5)


def test_class_report(spark):
    df = _scores(spark, [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)])
    rep = {r["class"]: r for r in evaluation.class_report(df, 0.5).collect()}
    assert rep["fraud"]["precision"] == round(2 / 3, 4) and rep["fraud"]["recall"] == 1.0
    assert rep["clean"]["recall"] == 0.5 and rep["accuracy"]["f1"] == 0.75
    assert rep["weighted avg"]["support"] == 4


def test_prefix_sums_and_row_number(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(0, 50, 500)
    w = rng.integers(1, 5, 500)
    df = spark.createDataFrame([(int(a), int(b), i) for i, (a, b) in enumerate(zip(v, w))], "v long, w long, i long")
    got = {r["i"]: r["w_before"] for r in ordering.prefix_sums(df, "v", ["w"], n_buckets=6, tiebreak=["i"]).collect()}
    order = sorted(range(500), key=lambda i: (v[i], i))
    acc = 0
    for i in order:
        assert got[i] == acc
        acc += int(w[i])
    rn = ordering.global_row_number(df, ["v", "i"], n_buckets=5).collect()
    assert sorted(r["row_number"] for r in rn) == list(range(1, 501))
    pos = {r["i"]: r["row_number"] for r in rn}
    assert [pos[i] for i in order] == list(range(1, 501))


def test_single_class_empty_and_zero_weight_give_null(spark):
    from starmart.operators import features, measures

    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert evaluation.roc_auc(one).first()["roc_auc"] is None
    assert {r["fpr"] for r in evaluation.roc_curve(one).collect()} == {None, 0.0}
    empty = spark.createDataFrame([], "target int")
    assert features.class_balance(empty).first()["pct_fraud"] is None
    rows = spark.createDataFrame([("a", 0.1, 5.0, 1), ("a", 0.2, -5.0, 1), ("b", 0.5, 2.0, None)],
                                 "g string, order_item_discount_rate double, sales double, customer_id int")
    got = {r["g"]: r[1] for r in measures.weighted_ratio(rows, ["g"]).collect()}
    assert got == {"a": None, "b": 0.5}
    assert {r["g"]: r["sales_per_customer"] for r in measures.sales_per_customer(rows, ["g"]).collect()} == {"a": 0.0, "b": None}


def test_auc_of_billions_does_not_overflow(spark):
    import pyspark.sql.functions as F

    from starmart.operators.ordering import prefix_sums

    hist = spark.createDataFrame([(0.1, 0, 4_000_000_000), (0.9, 4_000_000_000, 0)], "score double, pos long, neg long")
    original = evaluation.score_histogram
    evaluation.score_histogram = lambda *a, **k: hist
    try:
        assert evaluation.roc_auc(hist).first()["roc_auc"] == 1.0
    finally:
        evaluation.score_histogram = original
    big = prefix_sums(spark.range(0, 20000).select((F.col("id") * 1.0).alias("s"), F.lit(1).alias("n")), "s", ["n"], n_buckets=400)
    assert big.where("n_before != cast(s as long)").count() == 0


def test_buckets_stay_even_at_many(spark):
    import pyspark.sql.functions as F

    from starmart.operators.ordering import value_buckets

    rows = spark.range(0, 200_000).select(F.rand(3).alias("s"))
    sizes = [r["count"] for r in value_buckets(rows, "s", 4000).groupBy("_bucket").count().collect()]
    assert max(sizes) < 3 * 200_000 / 4000


def test_exact_sum_keeps_small_values(spark):
    import pyspark.sql.functions as F

    from starmart.functions.numeric import exact_sum

    df = spark.range(10).select(F.lit(0.00004).alias("x"))
    assert df.agg(exact_sum(F.col("x"), 6).alias("s")).first()["s"] == 0.0004


def test_roc_curve_without_collinear_points(spark):
    rows = [(0, 0.1), (0, 0.2), (1, 0.3), (1, 0.4), (0, 0.5), (1, 0.6), (1, 0.7)]
    df = spark.createDataFrame(rows, "label int, score double")
    full = sorted((r["fpr"], r["tpr"]) for r in evaluation.roc_curve(df).collect())
    bent = sorted((r["fpr"], r["tpr"]) for r in evaluation.roc_curve(df, drop_intermediate=True).collect())
    assert len(full) == 8 and set(bent) < set(full)
    slopes = [(b[0] - a[0], b[1] - a[1]) for a, b in zip(bent, bent[1:])]
    assert all(abs(p[0] * q[1] - p[1] * q[0]) > 1e-9 for p, q in zip(slopes, slopes[1:]))
    assert bent[0] == (0.0, 0.0) and bent[-1] == (1.0, 1.0)
