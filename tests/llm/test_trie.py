"""Prefix trie against a plain Python one, with shards and queues small enough to be cut and spilled."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import queries, trie
from tools.check_oracle import value_hash

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def expect(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    tie = lambda t: hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()
    for c in own:
        own[c] = [(r, x) for _, r, x in sorted(own[c], key=lambda t: (t[0] is not None, t[0] or 0, tie(t)))]
    nodes = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        turns = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append((c, d == len(turns)))
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)
    sums = {}
    for key in sorted(nodes, key=len, reverse=True):
        below = [sums[k] for k in children.get(key, [])]
        size = len(key[-1][1].encode()) if key else 0
        sums[key] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(nodes[key]) - 1) * size)
    first = {k: min(c for c, _ in m) for k, m in nodes.items()}
    return sorted(((first[k], len(k), first[k[:-1]] if k else None, len(m), len(children.get(k, [])), *sums[k],
                    hashlib.sha256(",".join(map(str, sorted(c for c, end in m if end))).encode()).hexdigest()) for k, m in nodes.items()), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sample(n=300, seed=3):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        # a first turn that most share, whole copies, and others
        words = ["hot"] * 3 + ["a", "b", "é" * 7, ""]
        for turn in range(r.randint(1, 9)):
            rows.append((c, turn, r.choice(["user", "user", "user", "tool"]), "start" if not turn and c % 3 else r.choice(words)))
    rows += [(1000 + 5 * c, turn, "user", f"copy {turn}") for c in range(80) for turn in range(4)]
    return rows


@pytest.mark.parametrize("shard_rows, queue_rows, max_heavy", [(20_000, 1_000_000, 200_000), (40, 3, 200_000), (7, 1, 0), (1, 10, 5)])
def test_against_plain_trie_at_any_shard_and_queue_size(spark, shard_rows, queue_rows, max_heavy):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(trie.prefix_trie(df, shard_rows, queue_rows, max_heavy)) == expect(rows)


def test_one_conversation_with_most_of_the_turns(spark):
    rows = [(20, i, "user", f"t{i % 50}") for i in range(1500)] + [(c, i, "user", f"t{i}") for c in range(40) for i in range(c % 4)]
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), 100, 5)) == expect(rows)


def test_nulls_ties_repeats_empty_and_clashing_columns(spark):
    rows = [(1, None, "user", "b"), (1, None, "user", "a"), (1, None, "user", "a"), (1, 0, None, None), (1, 0, "", ""), (2, 5, "user", "x" * 200_000), (2, 4, "user", None),
            (-7, 0, "user", "n"), (-5, 0, "user", "m"), (-5, 1, "user", "m"), (-5, 2, "user", "m"), (None, 0, "user", "lost"), (7, 0, "user", "only")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("t", "place", "depth", "k1", "one", "_part", "bytes", "length", "no", "shard", "h"):
        df = df.withColumn(name, F.lit("x"))
    assert got(trie.prefix_trie(df)) == expect(rows)
    assert trie.prefix_trie(df.limit(0)).count() == 0
    assert trie.prefix_trie(df.where("conv_id IS NULL")).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "x") for c in range(30)]
    found = {r["depth"]: r for r in trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect() if not r["depth"]}
    assert found[0]["n_convs"] == 30 and found[0]["parent_conv_id"] is None
    assert got(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == expect(rows)


def test_queue_spills_and_adds_up(tmp):
    r = random.Random(1)
    queue, want, found = trie.SpillingQueue(f"file://{tmp}/q", 10, block=4), {}, {}
    for step in range(200):
        pushed = sorted(r.randint(step * 10 + 1, 3000) for _ in range(r.randint(0, 9)))
        for x in pushed:
            want[x] = want.get(x, 0) + x
        queue.push(np.array([pushed, pushed], np.int64).reshape(2, -1))
        for run in queue.pop(step * 10):
            assert run[0].max() <= step * 10
            for k, v in run.T.tolist():
                found[k] = found.get(k, 0) + v
    for run in queue.pop(10_000):
        for k, v in run.T.tolist():
            found[k] = found.get(k, 0) + v
    assert found == want and queue.spilled > 5 and not queue.files


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    mine = queries.op11_prefix_trie(spark, SF).toPandas()
    theirs = con.execute(queries.ORACLE["op11_prefix_trie"]).df()
    assert sorted(mine.columns) == sorted(theirs.columns) and value_hash(mine) == value_hash(theirs)
