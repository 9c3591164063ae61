"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Built from DataFrame functions only.  Each source has a target number of words
(``source_targets``).  Its documents, in the order of a seeded hash, form one
long run of words per pass over the source; the mix takes as many whole passes
as fit in the target and the beginning of one more, so a document is taken
that many times and the one at the end in part.  Passes are cut into blocks of
``block_words``.  The numbers of blocks of each source that go to the two
halves of the output shards are drawn from the multivariate hypergeometric
distribution, then those of their halves, and so on (``block_quotas``); every
shard gets disjoint blocks of a source, picked in a permuted order, and holds
its draws in a shuffled order; ``filter_documents`` gives the mix in that order.

Order is decided by MD5 of seed and id, so reruns and other engines agree.  A
source of any size is summed by hash range first and ordered within ranges.

Defined results: a null text or one without words has size 0 and is never
taken; a null source is a source of its own, the last; rows that repeat an id
are documents of their own; an empty table gives no rows; columns other than
``doc_id, text, source`` are passed on by ``mix_documents`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import WORD, apart, cut

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target stops at so many times its size.
MAX_REPEATS = 3
SEED = 17
#: Ranges of the order hash by which a source's sizes are summed first (two hexadecimal digits each).
RANGE_DIGITS = 3
SHARDS = 16
#: Blocks that all sources together are cut into, at most about; bounds the splitting tree.
BLOCKS = 2048


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` and the order key ``_key`` of every row."""
    key = F.md5(F.concat_ws(":", F.lit(str(SEED)), F.col("doc_id").cast("string")).cast("binary"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("_key"))


def source_targets(by_source: DataFrame, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``weight`` and ``target`` to ``(source, source_size)``, one row per source.

    The sum of all sizes is shared by weight; targets stop at ``repeats`` times
    the source's size and the excess goes to the others by weight.  The
    sources that stop are those with the smallest size for their weight: in
    that order, a source stops if its limit is at most its share of what the
    ones before it leave.
    """
    n = len(weights)
    names = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(names) - 1, F.lit(n)) + 1).cast("int")).cast("long"))
    order = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = total - repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    step = ranked.withColumn("_left", left).withColumn("_rest", rest)
    stops = repeats * F.col("source_size") * F.col("_rest") <= F.col("weight") * F.col("_left")
    step = step.withColumn("_stops", F.min(stops.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    # what the first source that doesn't stop had left is shared among it and those after it
    level = F.first(F.when(~F.col("_stops"), F.col("_left").cast("double") / F.col("_rest")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return step.withColumn("target", F.when(F.col("_stops"), (repeats * F.col("source_size")).cast("double"))
                           .otherwise(F.col("weight") * level)).select("source", "source_size", "weight", "target")


def _before(rows: DataFrame) -> DataFrame:
    """Add ``_at``: the words of a source's documents before each, in the order of the key."""
    rows = rows.withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    ranges = rows.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
            .withColumn("_at", F.col("_base") + F.col("_in")).drop("_s", "_r", "_base", "_in", "_range"))


def takes(docs: DataFrame, weights: tuple = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken`` and its place ``_at`` in a pass."""
    rows = cut(sizes(docs), "sizes")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    targets = targets.withColumnRenamed("source", "_source")
    placed = _before(rows).join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    words = F.floor("target")
    passes = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(F.lit(0))
    more = words - passes * F.col("source_size")
    return placed.withColumn("taken", (passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), more - F.col("_at")))).cast("long"))


# --- the splitting tree -----------------------------------------------------

def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that the parts decide."""
    return F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _draw(node: Column, name: Column, kind: Column, rest: Column, draws: Column) -> Column:
    """How many of ``kind`` balls are among ``draws`` of ``kind + rest`` balls: one urn step per ball of the kind."""
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("i"))
    step = lambda acc, k: F.struct(
        (acc["hit"] + F.when(_uniform(node, name, k) * (kind + rest - acc["i"]) < (draws - acc["hit"]), F.lit(1)).otherwise(F.lit(0))).cast("long").alias("hit"),
        (acc["i"] + 1).cast("long").alias("i"))
    return F.when(kind > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(kind, F.lit(1))), zero, step, lambda acc: acc["hit"])).otherwise(F.lit(0).cast("long"))


def block_quotas(blocks: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``source, shard, first, quota`` from ``(source, blocks)``: disjoint runs of each source's permuted blocks.

    Every node of the tree holds one row: the shards it covers and the list of
    (source, blocks).  Its left half of the shards gets its share of all the
    node's blocks; how many of each source is a draw without replacement,
    source after source.
    """
    tree = (blocks.filter("blocks > 0").groupBy().agg(F.sort_array(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("name"), F.col("source"), F.col("blocks").cast("long").alias("n"), F.lit(0).cast("long").alias("first")))).alias("urn"))
            .select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "urn"))
    for _ in range(max(1, shards - 1).bit_length()):
        all_n = F.aggregate("urn", F.lit(0).cast("long"), lambda a, x: a + x["n"])
        node = (tree.withColumn("mid", F.expr("(lo + hi) div 2")).withColumn("total", all_n)
                .withColumn("left", F.expr("total * (mid - lo) div (hi - lo)")))
        empty = "cast(array() as array<struct<x: struct<name: string, source: string, n: bigint, first: bigint>, hit: bigint>>)"
        start = F.struct(F.col("total").alias("balls"), F.col("left").alias("draws"), F.expr(empty).alias("out"))

        def split(acc: Column, x: Column) -> Column:
            hit = _draw(F.concat_ws("-", "lo", "hi"), x["name"], x["n"], acc["balls"] - x["n"], acc["draws"])
            pair = F.transform(F.array(hit), lambda h: F.struct(x.alias("x"), h.alias("hit")))
            done = F.transform(F.array(F.concat(acc["out"], pair)), lambda out: F.struct(
                (acc["balls"] - x["n"]).alias("balls"), (acc["draws"] - F.element_at(out, -1)["hit"]).alias("draws"), out.alias("out")))
            return F.element_at(done, 1)

        node = node.withColumn("cut", F.aggregate("urn", start, split)["out"])
        lefts = F.transform("cut", lambda c: F.struct(c["x"]["name"].alias("name"), c["x"]["source"].alias("source"), c["hit"].alias("n"), c["x"]["first"].alias("first")))
        rights = F.transform("cut", lambda c: F.struct(c["x"]["name"].alias("name"), c["x"]["source"].alias("source"), (c["x"]["n"] - c["hit"]).alias("n"), (c["x"]["first"] + c["hit"]).alias("first")))
        halves = F.when(F.col("hi") - F.col("lo") > 1, F.array(F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), lefts.alias("urn")), F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), rights.alias("urn")))) \
            .otherwise(F.array(F.struct(F.col("lo"), F.col("hi"), F.col("urn"))))
        tree = cut(node.select(F.explode(halves).alias("h")).select("h.*"), "tree")
    return (tree.select(F.col("lo").alias("shard"), F.explode("urn").alias("u"))
            .select("shard", F.col("u.source").alias("source"), F.col("u.first").alias("first"), F.col("u.n").alias("quota")).filter("quota > 0"))


def mix_documents(docs: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, weights: tuple = WEIGHTS,
                  repeats: int = MAX_REPEATS) -> tuple[DataFrame, DataFrame]:
    """Documents and draws.

    Documents: the rows of ``takes`` with a number ``_row``.  Draws: ``_row,
    doc_id, pass, words, shard, position``, a row for each time a document is
    taken: ``words`` is its size, or less where the mix ends within it.  A
    draw belongs to the block in which it begins; ``position`` orders the
    draws of a shard.
    """
    rows = cut(takes(docs, weights, repeats).withColumn("_row", F.monotonically_increasing_id()), "takes")
    per_source = rows.groupBy("source").agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"))
    width = F.greatest(F.lit(1), F.ceil(F.sum("target").over(Window.partitionBy()) / blocks)).cast("long")
    # the blocks of each pass are numbered on from those of the passes before
    shape = per_source.withColumn("width", width).withColumn("a_pass", F.ceil(F.col("source_size") / F.col("width")).cast("long"))
    # a block in which no draw begins is none: the last pass ends with the target
    full = F.expr("cast(floor(target) as long) div greatest(source_size, 1)")
    more = F.floor("target").cast("long") - full * F.col("source_size")
    shape = shape.withColumn("blocks", full * F.col("a_pass") + F.ceil(more / F.col("width")).cast("long"))
    shape = cut(shape.filter("source_size > 0 and target >= 1").select("source", "width", "a_pass", "blocks"), "shape")
    quotas = block_quotas(shape.select("source", "blocks"), shards)
    numbers = shape.select("source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(SEED), F.col("source"), F.col("block")), "block")
    permuted = numbers.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    place = (permuted.alias("p").join(quotas.alias("q"), F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("quota")))
             .select(F.col("p.source").alias("_source"), F.col("block").alias("_block"), "shard"))
    place = cut(place, "place")                            # a row per block: about ``blocks``, and some per source
    drawn = (rows.filter("taken > 0").join(shape.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("pass", F.explode(F.expr("sequence(0L, (taken - 1) div size)")))
             .withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size")))
             .withColumn("block", F.col("pass") * F.col("a_pass") + F.expr("_at div width"))
             .join(place, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))))
    return rows, drawn.select("_row", "doc_id", "pass", "words", "shard", F.xxhash64(F.lit(SEED), F.col("_key"), F.col("pass")).alias("position"))


def mixed_sizes(docs: DataFrame, **shape) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``; ``taken`` sums its draws."""
    rows, draws = mix_documents(docs, **shape)
    taken = draws.groupBy("_row").agg(F.sum("words").alias("_taken"))
    return rows.join(taken, "_row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"))


def filter_documents(docs: DataFrame, shards: int = SHARDS, repeats: int = MAX_REPEATS, **shape) -> DataFrame:
    """The mix as documents, shard after shard in the order of each: a row for each draw, with the document's columns.

    Where a draw doesn't take the whole document, its text is the words taken,
    joined by blanks, and ``n_chars`` (if there is one) counts them.  Rows that
    repeat an id and a size share the words taken of them evenly, and go where
    the first of their draws goes.
    """
    spark = docs.sparkSession
    docs, back = apart(docs, ("doc_id", "text", "source", "n_chars"))
    rows, draws = mix_documents(docs, shards=shards, repeats=repeats, **shape)
    place = [F.min(F.when(F.col("pass") == p, F.struct("shard", "position"))).alias(f"_at{p}") for p in range(repeats + 1)]
    per_row = draws.groupBy("_row").agg(F.sum("words").alias("_words"), *place)
    wanted = (rows.join(per_row, "_row", "left").groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_size"))
              .agg(F.coalesce(F.sum("_words"), F.lit(0)).alias("_all"), F.count("*").alias("_copies"),
                   F.array(*[F.min(f"_at{p}") for p in range(repeats + 1)]).alias("_places"))
              .withColumn("_each", F.expr("_all div _copies")).filter("_each > 0"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    out = (docs.withColumn("_own", size).join(wanted, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_size")))
           .withColumn("_pass", F.explode(F.expr("sequence(0L, (_each - 1) div _size)")))
           .withColumn("_words", F.least(F.col("_size"), F.col("_each") - F.col("_pass") * F.col("_size")))
           .withColumn("_place", F.coalesce(F.get("_places", F.col("_pass").cast("int")), F.get("_places", F.lit(0)))))
    # a shard is a run of files, its draws in the shuffled order of the tree's blocks
    n = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = out.repartitionByRange(n, "_place.shard", "_place.position").sortWithinPartitions("_place.shard", "_place.position")
    whole = F.col("_words") == F.col("_size")
    begun = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_words").cast("int")), " ")
    out = out.withColumn("text", F.when(whole, F.col("text")).otherwise(begun))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return back(out)
