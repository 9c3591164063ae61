"""Merkle manifest of a dataset, kept as one hex string per level and aligned block.

A leaf is the SHA-256 of a row's fields.  Per group, leaves stand in order and
every 8 neighbours are hashed into a parent until one node, the group's
subroot, remains; the subroots, in order of their groups, are hashed the same
way into the root.  A block holds 512 aligned nodes, three levels of eight:
each level is one string of 64 hex digits a node, so a parent is the hash of a
fixed-width substring, and a node's siblings are the two substrings beside it
in its run.  The roots of a group's blocks are the nodes of the next round,
until every group has one block; rounds grow with the logarithm of the rows.

Positions come from running counts over range partitions, so a group with most
of the rows is spread over many tasks, and no task sees more than a block of it.

Defined results: a null field is written ``-``, any other as its UTF-8 length,
``:`` and its text, so no two rows share a leaf by accident; a null group is a
group of its own and comes first; null order values come first; rows that tie
in order stand by leaf; a lone node is its own root; a last run may be shorter,
even one node; an empty table has no rows and a null root; other columns are
ignored whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.ordering import grouped_running, with_running_total
from starmart.session import written

ARITY = 8
#: Levels of a block, and the nodes of its lowest one.
LEVELS = 3
BLOCK = ARITY ** LEVELS
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A document is tampered with where this divides the crc32 of its id.
TAMPER = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: list[Column]) -> Column:
    """A row's leaf: every field as ``-`` if null, else byte count, ``:`` and value."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _runs(level: str) -> Column:
    """The level's string cut into runs of siblings."""
    width = ARITY * DIGEST
    return F.expr(f"transform(sequence(0L, (length({level}) - 1L) div {width}), r -> substring({level}, cast(r * {width} + 1 as int), {width}))")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Aligned blocks of ``nodes`` (g, i, digest, extra): strings of their levels, height and root.

    A group's only block is as high as its nodes need; one of several is full
    height even with a single node, as other nodes of the group remain.
    """
    b = nodes.groupBy("g", F.expr(f"i div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("i", "digest", "extra"))).alias("items"))
    b = b.withColumn("level_0", F.array_join("items.digest", ""))
    for k in range(LEVELS):
        b = b.withColumn(f"level_{k + 1}", F.array_join(F.transform(_runs(f"level_{k}"), lambda run: F.sha2(run, 256)), ""))
    n = F.size("items")
    height = F.when((F.col("block") > 0) | (n == BLOCK), LEVELS)
    for k in reversed(range(LEVELS)):
        height = height.when(n > ARITY ** k, k + 1)
    b = b.withColumn("height", height.otherwise(0))
    root = F.array(*[F.col(f"level_{k}") for k in range(LEVELS + 1)])
    return b.select("g", "block", "items", *[f"level_{k}" for k in range(LEVELS)], "height", F.get(root, F.col("height")).alias("root"))


def _tree(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of blocks, the last with one block for each group; each is written once."""
    rounds = []
    while True:
        rounds.append(written(_blocks(nodes)))
        if rounds[-1].where("block > 0").isEmpty():
            return rounds
        nodes = rounds[-1].select("g", F.col("block").alias("i"), F.col("root").alias("digest"), F.lit(None).cast("string").alias("extra"))


def _with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes of the blocks with the siblings on their way up: those of the block, then those ``above`` it."""
    b = blocks.join(above, ["g", "block"])
    for k in range(LEVELS):
        b = b.withColumn(f"runs_{k}", _runs(f"level_{k}"))

    def step(item: Column, k: int) -> Column:
        place = F.floor(item["i"] % BLOCK / ARITY ** k).cast("int")
        run, at = F.get(F.col(f"runs_{k}"), F.floor(place / ARITY).cast("int")), (place % ARITY) * DIGEST
        return F.struct(F.substring(run, F.lit(1), at).alias("before"), F.substring(run, at + DIGEST + 1, F.lit(ARITY * DIGEST)).alias("after"))

    def node(item: Column) -> Column:
        own = F.slice(F.array(*[step(item, k) for k in range(LEVELS)]), F.lit(1), F.col("height"))
        return F.struct(item["i"].alias("i"), item["digest"].alias("digest"), item["extra"].alias("extra"), F.concat(own, F.col("above")).alias("path"))
    return b.select("g", *[c for c in above.columns if c not in ("g", "block", "above")], F.inline(F.transform("items", node)))


def _down(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """Nodes of the lowest round with their whole paths; ``top`` has g, above and whatever goes with a group."""
    above = top.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds[1:]):
        above = _with_paths(blocks, above).drop("digest", "extra").withColumnsRenamed({"i": "block", "path": "above"})
    return _with_paths(rounds[0], above)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda h, p: digest(p["before"], h, p["after"]))


def siblings(path: Column) -> Column:
    """All siblings on the way, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), "")


@dataclass
class Manifest:
    """Written rounds of blocks per group, those over the subroots, the subroots, and the root (null if empty)."""
    rounds: list[DataFrame]
    over: list[DataFrame]
    subroots: DataFrame
    root: str | None

    def proofs(self) -> DataFrame:
        """Every leaf with its path to the root: ``digest, extra, subroot, path`` (before and after, a struct a level)."""
        by_place = _down(self.over, self.over[0].select("g").distinct().withColumn("above", F.array().cast("array<struct<before:string,after:string>>")))
        # one row a group on both sides
        top = self.subroots.join(by_place.select("i", F.col("path").alias("above")), "i").select("g", F.col("digest").alias("subroot"), "above")
        return _down(self.rounds, top).select("g", "i", "digest", "extra", "subroot", "path")


def build(leaves: DataFrame, order: list[str]) -> Manifest:
    """The manifest of ``leaves``: g (string, not null), digest, extra (any sortable value that goes along) and the order columns."""
    rows = leaves.withColumn("one", F.lit(1).cast("long"))
    placed = grouped_running(rows, "g", [*order, "digest"], {"place": ("sum", "one")})
    rounds = _tree(placed.select("g", (F.col("place") - 1).alias("i"), "digest", "extra"))
    ends = rounds[-1].select("g", F.col("root").alias("digest"), F.lit(1).cast("long").alias("one"))
    subroots = written(with_running_total(ends, ["g"], "one", "i").select("g", F.col("i").cast("long").alias("i"), "digest"))
    over = _tree(subroots.select(F.lit("").alias("g"), "i", "digest", F.lit(None).cast("string").alias("extra")))
    found = over[-1].select("root").first()                    # one row, or none of an empty table
    return Manifest(rounds, over, subroots, found["root"] if found else None)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents by language; ``extra`` has the id and, where the document is tampered with, the leaf it then has."""
    d = docs.select(*[F.col(c).alias(c) for c in FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    changed = [F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in FIELDS]
    return d.select(F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0")).alias("g"), "doc_id", leaf([F.col(c) for c in FIELDS]).alias("digest"),
                    F.struct("doc_id", F.when(tampered, leaf(changed)).alias("changed")).alias("extra"))


def verify_documents(docs: DataFrame) -> DataFrame:
    """Each document's leaf, subroot, root and proof, and the root that its (perhaps tampered) text folds to."""
    manifest = build(written(document_leaves(docs)), ["doc_id"])
    start = F.coalesce("extra.changed", "digest")
    rows = manifest.proofs().select(
        F.col("extra.doc_id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", F.lit(manifest.root).cast("string").alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), fold(start, F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
