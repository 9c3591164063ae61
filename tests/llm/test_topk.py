"""Pivot-distance search against brute force over plain Python whole numbers."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import queries, topk
from tools.check_oracle import value_hash

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"
LIMIT = (1 << 63) - 1


def expect(rows, k=10, every=100):
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(1024 * x) for x in v):
            continue
        vectors.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    asked = {}
    for i, v in vectors:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scored = sorted((-max(-LIMIT, min(LIMIT, sum(a * b for a, b in zip(v, x)))), i) for i, x in vectors if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def clustered(n, dim=12, centres=9, seed=5):
    r = np.random.default_rng(seed)
    c = r.normal(size=(centres, dim))
    x = c[r.integers(0, centres, n)] + 0.05 * r.normal(size=(n, dim))
    return [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("every, block_bytes", [(100, 32 << 20), (7, 40_000)])
def test_against_brute_force_in_one_and_many_blocks(spark, every, block_bytes):
    rows = clustered(1500)
    rows += [(5000 + i, [0.25] * 12) for i in range(700)]                    # a third are copies: ties to smaller ids
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    index = topk.build_index(df, pivots=16, sample=300, rings=8)
    found = topk.search(index, index.rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding"), 10, block_bytes)
    assert got(found) == expect(rows, every=every)


def test_far_annuli_are_not_read(spark):
    rows = clustered(3000, centres=30)
    index = topk.build_index(spark.createDataFrame(rows, SCHEMA), pivots=30, sample=2000, rings=8)
    q = np.floor(1024 * np.array(rows[700][1]))[None, :]
    d = topk._distances(*topk._stretched(q, index.length), index.pivots)
    x = np.floor(1024 * np.array([v for _, v in rows]))
    kth = np.sort((x @ q[0]).astype(np.int64))[-10:][:1]
    low, high = topk.last_reach(index, q, d, kth)
    read = topk._within(index, low, high)
    assert read.count() < 0.35 * index.rows.count()
    assert "PushedFilters: [Or" in read._jdf.queryExecution().toString()


def test_nulls_ragged_large_repeated_and_clashing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, -2.0, 3.0]), (200, []), (300, None), (400, [None, 1.0]), (500, [nan, 1.0]), (600, [inf]), (700, [1e300, 1e300]), (800, [3e15, -3e15]),
            (None, [1.0]), (900, [0.0, 0.0]), (1000, [1.0]), (1000, [0.5]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0009, -0.0009]), (-100, [7.0]), (3, [1e306 * 1e2])]
    rows += [(10 + i, [float(i % 3), 0.5, 0.25]) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pivot", "dist", "block", "no", "one", "query_id", "score", "rank", "square"):
        df = df.withColumn(name, F.lit("x"))
    assert got(topk.top_k(df)) == expect(rows)


def test_fewer_rows_than_k_empty_and_without_queries(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.5, 0.5]), (7, [0.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(topk.top_k(df)) == expect(rows)
    for none in (df.limit(0), df.where("vec_id = 7"), df.select("vec_id", F.lit(None).cast("array<double>").alias("embedding"))):
        assert topk.top_k(none).count() == 0
        assert topk.top_k(none).columns == ["query_id", "rank", "vec_id", "score"]


def test_products_are_whole_beyond_doubles():
    r = random.Random(2)
    x = np.array([[float(r.randint(-(1 << 30), 1 << 30)) for _ in range(5)] for _ in range(4)])
    want = [[sum(int(a) * int(b) for a, b in zip(u, v)) for v in x] for u in x]
    assert topk._products(x, x).tolist() == [[max(-LIMIT, min(LIMIT, w)) for w in row] for row in want]
    assert topk._vectors(pa.array([[1.0, -0.0001], None, [2.0]]), 2)[0].tolist() == [1024.0, -1.0]


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    mine = queries.op12_pivot_topk(spark, SF).toPandas()
    theirs = con.execute(queries.ORACLE["op12_pivot_topk"]).df()
    assert sorted(mine.columns) == sorted(theirs.columns) and value_hash(mine) == value_hash(theirs)
