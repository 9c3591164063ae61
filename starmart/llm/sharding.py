"""Balanced label propagation: documents with equal texts move to the same shard, counts stay even.

Linked documents (equal texts; any group column will do) start in the shards
that their rank in id order deals them (rank mod shards), so counts are at
most one apart: the law ``rows``.  Every round, each group's members look at
the shard that holds most of their group and ask to move there.  Shards trade:
moves between two shards against each other, and documents that have no link
make room for the others, so every shard keeps its count exactly.  Rounds end
when nothing moves any more or after ``rounds``.

A group larger than half a shard is split into blocks of neighbouring ranks of
at most that size, so no group asks for more than a shard can give and no task
gathers it.  What the driver sees is counts by pairs of shards and salt
buckets, a table whose size depends on the number of shards only.

Defined results: a null text is its own value (null texts are linked with each
other, not with empty ones) and counts no bytes; rows that repeat an id are
documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import cut, with_running_total
from starmart.operators.ordering import grouped_running

SHARDS = 40
ROUNDS = 8
#: Buckets that the movers between two shards are ordered in, one task each at most.
SALT = 16
#: Bytes a row counts besides its text.
OVERHEAD = 16


def _grants(asked: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moves of linked documents and of unlinked ones between shards, from what is asked and what may give way.

    Both results keep every shard's count: rows and columns of their sum agree.
    """
    n = len(free)
    granted = np.minimum(asked, asked.T)                     # trades of two shards
    rest = asked - granted
    out = np.zeros(n, np.int64)
    into = np.zeros(n, np.int64)
    room = free.copy()
    for s in range(n):                                       # the rest against unlinked documents of the other shard
        for t in np.argsort(-rest[s], kind="stable"):
            k = min(rest[s, t], room[t])
            if k > 0:
                granted[s, t] += k
                room[t] -= k
                out[s] += k
                into[t] += k
    give = np.zeros((n, n), np.int64)
    need = out - into                                        # positive: a shard that has to be filled up
    short, long_ = [i for i in range(n) if need[i] > 0], [i for i in range(n) if need[i] < 0]
    for t in long_:
        left = -need[t]
        for s in short:
            k = min(left, need[s])
            if k > 0:
                give[t, s] += k
                need[s] -= k
                left -= k
    return granted, give


def _moves(counts: dict, granted: np.ndarray, spark) -> DataFrame:
    """``(_from, _into, _bucket, _most)``: how many of each salt bucket move, filled bucket after bucket."""
    rows = []
    left = granted.copy()
    for (s, t, b), n in sorted(counts.items()):
        k = int(min(n, left[s, t]))
        if k:
            rows.append((s, t, b, k))
            left[s, t] -= k
    return spark.createDataFrame(rows, "_from int, _into int, _bucket int, _most long")


def _free_moves(counts: dict, give: np.ndarray, spark) -> DataFrame:
    """``(_from, _bucket, _lo, _hi, _goal)``: ranges of unlinked documents of each shard and bucket that go to another."""
    rows = []
    for s in range(len(give)):
        wants = [(t, int(k)) for t, k in enumerate(give[s]) if k]
        for b in range(SALT):
            at, n = 0, counts.get((s, b), 0)
            while wants and at < n:
                t, k = wants[0]
                take = min(k, n - at)
                rows.append((s, b, at, at + take, t))
                at += take
                wants[0] = (t, k - take)
                if k == take:
                    wants.pop(0)
    return spark.createDataFrame(rows, "_from int, _bucket int, _lo long, _hi long, _goal int")


def balanced_shards(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Add ``shard`` to ``rows(doc_id, group, rank, ...)``; ``rank`` numbers all rows from 0 without gaps.

    ``group`` is any comparable value; rows with an equal one are linked.
    """
    spark = rows.sparkSession
    total = rows.count()
    if not total:
        return rows.withColumn("shard", F.lit(0))
    most = max(2, total // shards // 2)
    size = rows.groupBy("group").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("group").alias("_g"), "_n")
    # members are numbered inside their group, over range partitions, and cut into blocks of equal counts
    numbered = rows.withColumn("_link", F.coalesce(F.xxhash64("group"), F.lit(0))).withColumn("_one", F.lit(1).cast("long"))
    numbered = grouped_running(numbered, "_link", ["rank"], {"_place": ("sum", "_one")}).drop("_link", "_one")
    block = F.expr(f"(_place - 1) div ceil(_n / ceil(_n / {most}))")
    state = (numbered.join(size, F.col("group").eqNullSafe(F.col("_g")), "left")
             .withColumn("_block", F.when(F.col("_n").isNotNull(), F.xxhash64("group", block))).drop("_place")
             .withColumn("shard", (F.col("rank") % shards).cast("int"))
             .withColumn("_salt", F.pmod(F.xxhash64("rank"), F.lit(SALT)).cast("int")).drop("_g", "_n"))
    state = cut(state, "shards")
    for _ in range(rounds):
        here = state.filter("_block is not null").groupBy("_block", "shard").agg(F.count("*").alias("_here"))
        # ties go to the smaller of a hash, which spreads the groups over the shards
        goal = here.groupBy("_block").agg(F.max_by("shard", F.struct("_here", F.xxhash64("_block", "shard"))).alias("_to"), F.count("*").alias("_spread"))
        goal = goal.filter("_spread > 1").select(F.col("_block").alias("_b"), "_to")
        # unlinked documents have no key to join on: they would all meet in one task
        linked_rows = state.filter("_block is not null").join(goal, F.col("_block") == F.col("_b"), "left").drop("_b")
        single_rows = state.filter("_block is null").withColumn("_to", F.lit(None).cast("int"))
        asked = cut(linked_rows.withColumn("_to", F.when(F.col("_to") != F.col("shard"), F.col("_to"))).unionByName(single_rows), "asked")
        demand = {(r["shard"], r["_to"], r["_salt"]): r["n"] for r in asked.filter("_to is not null").groupBy("shard", "_to", "_salt").agg(F.count("*").alias("n")).collect()}
        free = {(r["shard"], r["_salt"]): r["n"] for r in asked.filter("_block is null").groupBy("shard", "_salt").agg(F.count("*").alias("n")).collect()}
        wish, room = np.zeros((shards, shards), np.int64), np.zeros(shards, np.int64)
        for (s, t, _), n in demand.items():
            wish[s, t] += n
        for (s, _), n in free.items():
            room[s] += n
        granted, give = _grants(wish, room)
        if not granted.sum():
            break
        order = Window.partitionBy("shard", "_to", "_salt", F.col("_block").isNull()).orderBy("_block", "rank")
        ranked = asked.withColumn("_k", F.row_number().over(order) - 1)
        linked = F.broadcast(_moves(demand, granted, spark))             # shards * shards * SALT rows at most
        singles = F.broadcast(_free_moves(free, give, spark))
        goes = (F.col("shard") == F.col("_from")) & (F.col("_to") == F.col("_into")) & (F.col("_salt") == F.col("_bucket")) & (F.col("_k") < F.col("_most"))
        moved = ranked.join(linked, goes, "left").withColumn("_goes", F.col("_most").isNotNull()).drop(*linked.columns)
        gives = F.col("_block").isNull() & (F.col("shard") == F.col("_from")) & (F.col("_salt") == F.col("_bucket")) & (F.col("_k") >= F.col("_lo")) & (F.col("_k") < F.col("_hi"))
        moved = (moved.join(singles, gives, "left")
                 .withColumn("shard", F.when(F.col("_goes"), F.col("_to")).otherwise(F.coalesce("_goal", "shard")).cast("int")))
        state = cut(moved.select(*state.columns), "shards")
    return state.drop("_block", "_salt")


def with_slots(rows: DataFrame, width: int = 100_000) -> DataFrame:
    """Add ``slot``: a number within the shard, from 0 without gaps, in rank order."""
    rows = rows.withColumn("_range", F.expr(f"rank div {width}"))
    counts = rows.groupBy("shard", "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard", "_range").orderBy("rank")
    return (rows.withColumn("_k", F.row_number().over(inside) - 1).join(base, ["shard", "_range"])
            .withColumn("slot", (F.col("_base") + F.col("_k")).cast("long")).drop("_range", "_k", "_base"))


def cut_share(rows: DataFrame) -> float:
    """Share of the links (each member of a group of equal texts to the next in rank order) that cross shards."""
    linked = rows.withColumn("_before", F.lag("shard").over(Window.partitionBy("group").orderBy("rank"))).filter("_before is not null")
    got = linked.agg(F.avg((F.col("_before") != F.col("shard")).cast("double")).alias("x")).first()
    return got.x or 0.0


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, group, rank, shard, slot``."""
    raw = F.encode(F.col("text"), "UTF-8")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
                         F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
                         F.xxhash64(F.octet_length("text"), F.crc32(raw), F.xxhash64("text")).alias("group"), F.lit(1).cast("long").alias("_one"))
    ranked = with_running_total(narrow, ["doc_id", "group"], "_one", "rank", "ranks").drop("_one")
    return with_slots(balanced_shards(cut(ranked, "ranked"), shards, rounds))
