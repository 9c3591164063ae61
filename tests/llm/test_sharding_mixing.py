"""Sharding laws and mixing targets against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm import mixing, queries, sharding

SF = "/root/testdata/sf0.001"


def odd(spark, n=400):
    """A third of the rows in one group and one source, null and empty texts, ids that repeat, clashing columns."""
    rows = [(i % 350, "hot text here" if i % 3 == 0 else (None if i % 50 == 1 else ("" if i % 50 == 2 else f"w{i // 4} " * (1 + i % 40))),
             "big" if i % 3 == 0 else [None, "a", "b", "tiny"][i % 4 if i % 97 else 3], i, "x") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, shard string").repartition(4)


def check_shards(rows, shards=40):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_a_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op8_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check_shards(rows)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "rows")


def test_propagation_joins_groups_and_keeps_counts(spark):
    df = odd(spark)
    got = sharding.shard_documents(df, shards=8).cache()
    check_shards(got.collect(), 8)
    assert got.count() == 400
    start = sharding.cut_share(got.withColumn("shard", F.col("rank") % 8))
    assert sharding.cut_share(got) < 0.3 * start
    again = sharding.shard_documents(df.repartition(3), shards=8)
    key = lambda d: Counter((r.doc_id, r.text_crc32, r["size"], r.shard) for r in d.collect())
    assert key(again) == key(got)
    assert sharding.shard_documents(df.filter("false")).count() == 0


def test_grants_keep_counts():
    import numpy as np

    rnd = np.random.default_rng(2)
    for _ in range(50):
        asked = rnd.integers(0, 9, (6, 6))
        np.fill_diagonal(asked, 0)
        free = rnd.integers(0, 20, 6)
        granted, give = sharding._grants(asked, free)
        moved = granted + give
        assert (moved.sum(0) == moved.sum(1)).all()
        assert (granted <= asked).all() and (give.sum(1) <= free).all() and (give >= 0).all()


def targets(sizes):
    names = sorted((k for k in sizes if k is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, live, out = sum(sizes.values()), set(names), {}
    while live:
        rest = sum(weight[s] for s in live)
        stop = {s for s in live if weight[s] * left / rest >= 3 * sizes[s]}
        if not stop:
            out.update({s: weight[s] * left / rest for s in live})
            break
        for s in stop:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in stop)
        live -= stop
    return out


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_mix_meets_its_targets(spark, table):
    df = spark.read.parquet(f"{SF}/documents.parquet") if table == "documents" else odd(spark)
    docs = df.select("doc_id", "text", "source").collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = Counter()
    for r in docs:
        per[r.source] += size(r.text)
    want = targets(per)
    rows, draws = mixing.mix_documents(df, blocks=64)
    rows, draws = rows.collect(), draws.collect()
    taken = Counter()
    for d in draws:
        taken[d._row] += d.words
    by_source = Counter()
    for r in rows:
        assert r.taken == taken[r._row] and r.taken <= 3 * r["size"]
        assert r.source_size == per[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
        by_source[r.source] += r.taken
    for s, n in by_source.items():
        assert want[s] - 1 <= n <= want[s] + 1e-6
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((r.doc_id, size(r.text)) for r in docs)
    again = mixing.mixed_sizes(df.repartition(2), blocks=64).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in again) == Counter((r.doc_id, r["size"], r.taken) for r in rows)
    if table == "documents":
        order = {r.doc_id: hashlib.md5(f"17:{r.doc_id}".encode()).hexdigest() for r in rows}
        for s in per:
            own = sorted((r for r in rows if r.source == s), key=lambda r: order[r.doc_id])
            full, more = divmod(int(want[s]), per[s])
            for r in own:
                k = max(0, min(r["size"], more))
                assert r.taken == full * r["size"] + k
                more -= k


def test_quotas_split_all_blocks(spark):
    blocks = spark.createDataFrame([("a", 300), ("b", 7), (None, 45), ("c", 0)], "source string, blocks long")
    got = mixing.block_quotas(blocks, 10).collect()
    per, shard = defaultdict(list), Counter()
    for r in got:
        per[r.source].append((r["first"], r.quota))
        shard[r.shard] += r.quota
    for name, n in (("a", 300), ("b", 7), (None, 45)):
        at = 0
        for first, quota in sorted(per[name]):
            assert first == at
            at += quota
        assert at == n
    assert max(shard.values()) - min(shard.values()) <= 4 and len(shard) == 10


def test_mixed_documents_hold_the_words_taken(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.taken for r in mixing.mixed_sizes(df).collect()}
    out = mixing.filter_documents(df)
    assert out.columns == df.columns
    got = Counter()
    for r in out.select("doc_id", "text").collect():
        got[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert got == Counter({k: v for k, v in rows.items() if v})
    assert mixing.filter_documents(df.filter("false")).count() == 0


def test_shards_hold_their_quotas_and_the_mix_comes_in_their_order(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows, draws = mixing.mix_documents(df, shards=4, blocks=64)
    draws = draws.collect()
    per = Counter()
    for d in draws:
        per[d.shard] += d.words
    total = sum(per.values())
    # blocks of equal words: no shard is left with empty blocks of a source's last pass
    assert set(per) == set(range(4)) and all(0.7 * total / 4 < n < 1.3 * total / 4 for n in per.values())
    place = {(d.doc_id, d["pass"]): (d.shard, d.position) for d in draws}
    order = [r.doc_id for r in mixing.filter_documents(df, shards=4, blocks=64).select("doc_id").collect()]
    assert Counter(order) == Counter(d for d, _ in place)
    want = [d for d, _ in sorted(place, key=lambda k: (*place[k], k))]
    assert order == want
    # neighbours in the mix aren't neighbours in the table
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 0.1 * len(order)
