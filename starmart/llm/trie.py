"""Conversation prefix trie whose subtree totals come by time-forward processing.

A node is a distinct sequence of first turns.  Its key is 128 bits: the xor of
a hash of every turn with its place, so that prefix keys are running xors over
the turns in order, computed over range partitions, and a parent's key is the
node's without its last turn.  Grouping the prefixes by key gives the nodes
with their members, smallest member and text size.

Totals of subtrees (leaves, saved tokens) pass from children to parents in
reverse level order.  A node's weight is the number of turns that its members
still have before them, a bound on its subtree.  Weights cut the trie into
shards of at most ``SHARD_ROWS`` nodes: a subtree whose root is lighter than
that, or a stretch of heavier nodes whose weights have the same quotient by
``SHARD_ROWS``, which is always a path.  In a task Spark sorts the nodes of its
shards by their number in reverse level order (an external sort), and each node
takes its children's messages from a priority queue and puts its own in; the
queue keeps ``QUEUE_ROWS`` messages and spills sorted runs beyond them to the
shared folder.  Complete subtrees come first; then the tree of the shards' roots
(one row for about ``SHARD_ROWS`` turns) is processed the same way; last the
paths, with the totals of the shards that hang from them.

So neither a first turn that most conversations share, nor a conversation with
most of the turns, nor copies of one lands in one task.

Defined results: null role or text is empty, null turns come first, turns that
tie stand by a hash of role and text; rows without conv_id take no part;
an empty table has no nodes; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import cut, scratch_path
from starmart.operators.ordering import grouped_running, with_running_total

#: Nodes of a shard at most.
SHARD_ROWS = 20_000
#: Messages that a task's queue holds in memory.
QUEUE_ROWS = 1_000_000
#: Heavy nodes (40 bytes each) that are broadcast; more are joined by a shuffle.
MAX_HEAVY = 200_000
#: Conversations of a family share the first turns of its first one, fewer than ``BORROWED``.
FAMILY, BORROWED = 5, 9
#: Member ids joined into one row before they are hashed.
IDS = 4096

KEY = ["depth", "k1", "k2"]


# --- turns and prefixes -----------------------------------------------------------

def _place(conversations: DataFrame) -> DataFrame:
    """Turns with their hash, size and place (from 1) in the conversation."""
    c = conversations.select(F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    rows = c.where("conv_id IS NOT NULL").select("conv_id", "turn", t.alias("t"), F.octet_length("text").cast("long").alias("bytes"), F.lit(1).cast("long").alias("one"))
    return grouped_running(cut(rows, "trie-turns"), "conv_id", ["turn", "t"], {"place": ("sum", "one")}).select("conv_id", "t", "bytes", "place")


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: their turns (conv_id, depth, t, bytes) and their lengths (conv_id, length).

    Conversation c has the first h turns of conversation c - c % 5 (all if
    fewer), then its own after its first h; h is the crc32 of c's decimals % 9.
    """
    own = cut(_place(conversations), "trie-places")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = own.groupBy("conv_id").agg(F.max("place").alias("n")).select("conv_id", "n", h.alias("h"), base.alias("base"))
    first = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(first, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = cut(convs.select("conv_id", "h", "base", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-lengths")
    kept = own.join(convs, "conv_id").where("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("depth"), "t", "bytes")
    # at most eight turns of a base, each for at most five conversations
    lent = own.where(F.col("place") < BORROWED).withColumnRenamed("conv_id", "base").join(convs, "base").where("place <= m").select("conv_id", F.col("place").alias("depth"), "t", "bytes")
    return kept.unionByName(lent), convs.select("conv_id", "length")


def _half(digest: Column, begin: int) -> Column:
    return F.conv(F.substring(digest, begin, 16), 16, -10).cast("long")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every prefix of every conversation, the empty one included: node key, parent's key, bytes of the last text."""
    digest = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), "t").cast("binary"))
    hashed = turns.select("conv_id", "depth", "bytes", digest.alias("x")).select("conv_id", "depth", "bytes", _half(F.col("x"), 1).alias("h1"), _half(F.col("x"), 17).alias("h2"))
    keyed = grouped_running(hashed, "conv_id", ["depth"], {"k1": ("bit_xor", "h1"), "k2": ("bit_xor", "h2")})
    rows = keyed.join(lengths, "conv_id").select(
        "conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "bytes", "length")
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("bytes"), "length")
    return rows.unionByName(roots)


# --- members that end at a node ------------------------------------------------------

def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of the same node as text, a row for at most ``IDS``."""
    for batch in batches:
        depth, k1, k2, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        new = np.flatnonzero((np.diff(depth) != 0) | (np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
        starts = np.unique(np.concatenate(([0], new, np.arange(0, len(ids), IDS)))) if len(ids) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(ids)) if len(starts) else starts
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(depth[starts]), pa.array(k1[starts]), pa.array(k2[starts]), pa.array(ids[starts]), pa.array(texts, pa.string())],
                                         names=[*KEY, "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of each node, which follow each other: one state in memory, whatever a node's members."""
    key, state = None, None
    for batch in batches:
        out = []
        for *own, ids in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*KEY, "ids"))):
            if own != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield _rows(out)
    if key is not None:
        yield _rows([(*key, state.hexdigest())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    *ints, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in ints], pa.array(texts, pa.string())], names=[*KEY, "ends_sha256"])


def ends(paths: DataFrame) -> DataFrame:
    """Per node at which conversations end: SHA-256 of their ids, ascending and comma-joined."""
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*KEY, "conv_id"]
    joined = (paths.where("depth = length").select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
              .mapInArrow(_joined, "depth long, k1 long, k2 long, first long, ids string"))
    return joined.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashed, "depth long, k1 long, k2 long, ends_sha256 string")


# --- time-forward processing -----------------------------------------------------------

class SpillingQueue:
    """Messages by receiver: rows of an int64 array, the receiver first, then sums.

    Sorted runs stay in memory up to ``limit`` rows; then they are merged into
    one, messages to the same receiver added up, and written to ``folder`` as
    a file of blocks, of which one is read at a time.
    """

    def __init__(self, folder: str, limit: int, block: int = 65_536):
        self.folder, self.limit, self.block = folder, limit, block
        self.runs: list[np.ndarray] = []
        self.files: list[list] = []             # [iterator of blocks, block, path]
        self.held = self.spilled = 0

    def push(self, run: np.ndarray) -> None:
        if not run.shape[1]:
            return
        self.runs.append(merged([run]))
        self.held += run.shape[1]
        if len(self.runs) > 64:
            self.runs = [merged(self.runs)]
        if self.held > self.limit:
            self._spill(merged(self.runs))

    def _spill(self, run: np.ndarray) -> None:
        store, root = pafs.FileSystem.from_uri(self.folder)
        store.create_dir(root, recursive=True)
        path = f"{root}/run-{uuid.uuid4().hex}"
        schema = pa.schema([(f"c{i}", pa.int64()) for i in range(len(run))])
        with store.open_output_stream(path) as out, pa.ipc.new_stream(out, schema) as writer:
            for a in range(0, run.shape[1], self.block):
                writer.write_batch(pa.RecordBatch.from_arrays([pa.array(x) for x in run[:, a:a + self.block]], schema=schema))
        self.files.append([self._blocks(store, path), None, path])
        self.runs, self.held, self.spilled = [], 0, self.spilled + 1
        self._next(self.files[-1])

    @staticmethod
    def _blocks(store: pafs.FileSystem, path: str) -> Iterator[np.ndarray]:
        with store.open_input_stream(path, compression=None) as source, pa.ipc.open_stream(source) as reader:
            for batch in reader:
                yield np.stack([c.to_numpy() for c in batch.columns])
        store.delete_file(path)

    def _next(self, file: list) -> None:
        file[1] = next(file[0], None)

    def pop(self, last: int) -> list[np.ndarray]:
        """All messages to receivers up to ``last``."""
        out, left = [], []
        for run in self.runs:
            n = int(np.searchsorted(run[0], last, side="right"))
            if n:
                out.append(run[:, :n])
                self.held -= n
            if n < run.shape[1]:
                left.append(run[:, n:])
        self.runs = left
        for file in self.files:
            while file[1] is not None:
                n = int(np.searchsorted(file[1][0], last, side="right"))
                if n:
                    out.append(file[1][:, :n])
                if n < file[1].shape[1]:
                    file[1] = file[1][:, n:]
                    break
                self._next(file)
        self.files = [f for f in self.files if f[1] is not None]
        return out


def merged(runs: list[np.ndarray]) -> np.ndarray:
    """Runs as one sorted by receiver, with its messages added up."""
    run = np.concatenate(runs, axis=1)
    run = run[:, np.argsort(run[0], kind="stable")]
    first = np.flatnonzero(np.concatenate(([True], run[0, 1:] != run[0, :-1])))
    return np.concatenate([run[:1, first], np.add.reduceat(run[1:], first, axis=1)])


def _sweep(folder: str, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nodes in order of ``no``; children, leaves and saved become those of whole subtrees within the shard."""
    sums = ("children", "leaves", "saved")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(folder, limit)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {name: batch.schema.get_field_index(name) for name in ("no", "depth", "up", *sums)}
            no, depth = (batch.column(at[c]).to_numpy() for c in ("no", "depth"))
            up = batch.column(at["up"]).fill_null(-1).to_numpy()
            total = np.stack([batch.column(at[c]).to_numpy() for c in sums])
            # a node's children are on the level before its own
            bounds = np.concatenate(([0], np.flatnonzero(np.diff(depth)) + 1, [len(no)]))
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                got = queue.pop(int(no[b - 1]))
                if got:
                    got = merged(got)
                    total[:, a + np.searchsorted(no[a:b], got[0])] += got[1:]
                total[1, a:b] += total[0, a:b] == 0
                send = a + np.flatnonzero(up[a:b] >= 0)
                queue.push(np.stack([up[send], np.ones(len(send), np.int64), total[1, send], total[2, send]]))
            columns = list(batch.columns)
            for i, c in enumerate(sums):
                columns[at[c]] = pa.array(total[i])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
    return run


def time_forward(nodes: DataFrame, shard: str | None, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """Totals of ``children``, ``leaves`` and ``saved`` over each node's subtree within its shard.

    ``nodes`` have ``no`` (reverse level order), ``depth``, ``up`` (the parent's
    number, null at the top of a shard), and the three sums: on the way in a
    node's own, with what comes from other shards.  Without ``shard`` all
    nodes are one.  Other columns go along.
    """
    spark = nodes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.repartition(n, shard) if shard else nodes.repartition(1)
    return dealt.sortWithinPartitions("no").mapInArrow(_sweep(scratch_path(spark, "trie-queue"), queue_rows), nodes.schema)


# --- the trie -----------------------------------------------------------------------------

def _nodes(paths: DataFrame, shard_rows: int, max_heavy: int) -> tuple[DataFrame, int]:
    """Nodes with number, parent and shard (the key of its top node), and the count of heavy ones."""
    found = cut(paths.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
                                        F.min("bytes").alias("bytes"), F.sum(F.col("length") - F.col("depth")).alias("weight")), "trie-nodes")
    found = found.withColumn("q", F.expr(f"weight div {shard_rows}"))
    heavy = found.where("q > 0")
    n_heavy = heavy.count()
    known = lambda df: F.broadcast(df) if n_heavy <= max_heavy else df
    # the top of a conversation's stretch of each quotient: all members of a node share it
    stretch = paths.join(known(heavy.select(*KEY, "q")), KEY, "left").withColumn("q", F.coalesce("q", F.lit(0)))
    tops = stretch.groupBy("conv_id", "q").agg(F.min_by(F.struct(*KEY), "depth").alias("shard"))
    numbered = with_running_total(found.join(tops, ["conv_id", "q"]).select("*", (-F.col("depth")).alias("level"), F.lit(1).cast("long").alias("one")), ["level", "k1", "k2"], "one", "no")
    nodes = cut(numbered.drop("level", "one"), "trie-numbered")

    def parents(df: DataFrame) -> DataFrame:
        return df.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("no").alias("parent_no"), F.col("conv_id").alias("parent_conv_id"), F.col("shard").alias("parent_shard"))
    up = ["depth", "p1", "p2"]
    below = nodes.where("depth > 0")
    if n_heavy <= max_heavy:
        # a parent of many children is heavy; a light one has fewer than shard_rows
        big = parents(nodes.where("q > 0"))
        linked = below.join(F.broadcast(big), up).unionByName(
            below.join(F.broadcast(big.select(*up)), up, "left_anti").join(parents(nodes.where("q = 0")), up))
    else:
        linked = below.join(parents(nodes), up)
    linked = linked.unionByName(nodes.where("depth = 0"), allowMissingColumns=True)
    inside = F.col("parent_shard") == F.col("shard")
    zero = F.lit(0).cast("long")
    return cut(linked.select(*KEY, "no", "conv_id", "parent_conv_id", "parent_no", "n_convs", "q", "shard", "parent_shard", F.when(inside, F.col("parent_no")).alias("up"),
                             zero.alias("children"), zero.alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "trie-linked"), n_heavy


def _messages(tops: DataFrame) -> DataFrame:
    """What the tops of shards pass on, added up by receiver."""
    return tops.where("parent_no IS NOT NULL").groupBy(F.col("parent_no").alias("no")).agg(
        F.count(F.lit(1)).alias("children_in"), F.sum("leaves").alias("leaves_in"), F.sum("saved").alias("saved_in"))


def _received(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    columns = nodes.columns
    sums = {c: (F.col(c) + F.coalesce(f"{c}_in", F.lit(0))).alias(c) for c in ("children", "leaves", "saved")}
    return nodes.join(messages, "no", "left").select(*[sums.get(c, F.col(c)) for c in columns])


def totals(nodes: DataFrame, n_heavy: int, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """Nodes with the sums of their whole subtrees: complete subtrees, then shard roots, then the paths between them."""
    light = cut(time_forward(nodes.where("q = 0"), "shard", queue_rows), "trie-light")
    if not n_heavy:
        return light
    is_top = F.col("shard") == F.struct(*KEY)
    heavy = cut(_received(nodes.where("q > 0"), _messages(light.where(is_top))), "trie-heavy")
    # the tree of the heavy shards' roots, each with the sums of its shard
    own = heavy.groupBy("shard").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    roots = heavy.where(is_top).select("no", "depth", "parent_no", "shard", "parent_shard").join(own, "shard")
    above = heavy.where(is_top).select(F.col("shard").alias("parent_shard"), F.col("no").alias("up"))
    roots = roots.join(above, "parent_shard", "left").select("no", "depth", "up", "parent_no", F.lit(1).cast("long").alias("children"), "leaves", "saved")
    swept = cut(time_forward(roots, None, queue_rows), "trie-roots")
    return light.unionByName(time_forward(_received(heavy, _messages(swept)), "shard", queue_rows))


def build(paths: DataFrame, shard_rows: int = SHARD_ROWS, queue_rows: int = QUEUE_ROWS, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """The trie of ``paths`` (as ``prefixes`` gives them): a row for each node with its subtree's sums."""
    nodes, n_heavy = _nodes(paths, shard_rows, max_heavy)
    nothing = hashlib.sha256(b"").hexdigest()
    return totals(nodes, n_heavy, queue_rows).join(ends(paths), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, queue_rows: int = QUEUE_ROWS, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns, lengths = rebuild(conversations)
    return build(cut(prefixes(turns, lengths), "trie-paths"), shard_rows, queue_rows, max_heavy)
