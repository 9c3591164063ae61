"""Exact Jaccard join over word shingles, and its connected components.

Candidates come from prefixes: with shingles in one global order, two sets
whose Jaccard similarity is at least 3/4 share a shingle among the first
``n - ceil(3n/4) + 1`` of either.  The order puts shingles of many documents
last (the ``MAX_FREQUENT`` most frequent ones, found by an exact count over the
corpus; the order only decides how much work there is, any order gives the
same links).  What follows is a chain of ever narrower filters:

* documents that share a prefix shingle, gathered by packed arrays: all pairs
  of a small group; of a larger one a star around its smallest document;
* size band: the smaller set has at least 3/4 of the larger one's size;
* hashed bitmap: each set is a parity bitmap whose length is that of its size
  band (folded to the shorter one for a pair).  The bits that differ can't
  outnumber the shingles that differ, so their count bounds the overlap from
  above;
* exact intersection of the sorted shingle arrays.

The stars leave some pairs of large groups open.  Where the members of such a
group are in different components, its pairs across components are tested by
the same filters, in tiles of two blocks of the same or adjacent size bands:
first the nearest documents by bitmap, then, if the components still differ,
all the others.  Equal
sets are handled once: they are linked by their digest, and one document
stands for all of them in every later step.

Defined results: words are bytes outside ``\\x20\\x09-\\x0D``, A-Z lowered; a text
of fewer words than a shingle is one shingle; without words, or null, a text
is empty and linked with nothing; rows that repeat a ``doc_id`` are one
document, linked where any of its texts is; a null ``doc_id`` is linked with
nothing and has no component; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import LOWER, apart, by_bytes, cut, lean, mix, span_hashes, words

SHINGLE = 5
#: The threshold as a fraction: intersection / union >= OVER / UNDER.
OVER, UNDER = 3, 4
#: Documents from which on a shingle counts as frequent, and how many of them the order takes into account.
FREQUENT, MAX_FREQUENT = 16, 1 << 20
#: Members up to which a task, or all tasks together, list every pair of a group.
LOCAL_PAIRS, ALL_PAIRS = 8, 8
#: Rows of a block of a tile.
BLOCK = 2048
#: Nearest documents of each component that are tested for a document of a tile, in the first round and, where
#: there were more, in the second; that takes all that are left, so the first only decides how many those are.
DEPTHS = (4, 1 << 30)
#: Ids up to which those of candidate documents are broadcast to pick their texts.
MAX_IDS = 1_000_000
MAX_BITS = 1 << 16

_K = [np.uint64(k) for k in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD, 0xA24BAED4963EE407, 0x9E6C63D0676A9A99)]


def shingle_sets(raw: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    n = len(offs) - 1
    starts, ends, doc = words(raw, offs)
    h = span_hashes(LOWER[raw], starts, ends)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    value = np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64)
    for j in range(size):
        value += h[j:j + len(value)] * _K[j % len(_K)] + np.uint64(j)
    value = mix(value)
    out = []
    for f, c in zip(first.tolist(), count.tolist()):
        if c >= size:
            out.append(np.unique(value[f:f + c - size + 1]))
        elif c:
            whole = np.array([c], dtype=np.uint64)
            for i in range(f, f + c):
                whole = mix(whole * _K[4] + h[i:i + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def bitmap_bits(n: int) -> int:
    """Bits of the bitmap of a size band: at least twice the sets of the band, a power of two."""
    return min(MAX_BITS, max(64, 1 << (2 * max(n, 1) - 1).bit_length()))


def bitmap(values: np.ndarray) -> bytes:
    """Parity bitmap: a bit is set if an odd number of shingles fall on it."""
    bits = bitmap_bits(len(values))
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, after the longer one is folded to the length of the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def may_link(n_a: int, n_b: int, differ: int) -> bool:
    """Whether sets of these sizes with at least ``differ`` shingles of difference can reach the threshold."""
    overlap = (n_a + n_b - differ) // 2
    return min(n_a, n_b) * UNDER >= OVER * max(n_a, n_b) and UNDER * overlap >= OVER * (n_a + n_b - overlap)


def prefix_length(n: int) -> int:
    return n - -(-OVER * n // UNDER) + 1


# --- sets of documents ------------------------------------------------------

def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in by_bytes(batches):
            sets = shingle_sets(raw, offs, size)
            digest = [np.array([(mix(s * _K[0])).sum(dtype=np.uint64), (mix(s * _K[1] + _K[2])).sum(dtype=np.uint64)], "<u8").tobytes() for s in sets]
            yield pa.record_batch([rows.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                                   pa.array([bitmap(s) for s in sets], pa.binary())], ["doc_id", "n", "digest", "bits"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offs in by_bytes(batches):
            yield pa.record_batch([rows.column(0), pa.array([s.astype("<u8").tobytes() for s in shingle_sets(raw, offs, size)], pa.binary())], ["doc_id", "hashes"])
    return run


# --- frequent shingles ------------------------------------------------------

def _bucket(values: np.ndarray) -> np.ndarray:
    """48 bits of a shingle that stand for it in the count; shingles that share them only share their rank."""
    return values >> np.uint64(15)


def _count(size: int, parts: int):
    """Counts of a task's shingles in the lower half of the hash range, where prefixes lie, packed by part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            part = (keys % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            keys, n, edges = keys[order], n[order], np.searchsorted(part[order], np.arange(parts + 1))
            some = [p for p in range(parts) if edges[p] < edges[p + 1]]
            single, repeated, times = [], [], []
            for p in some:
                k, c = keys[edges[p]:edges[p + 1]], n[edges[p]:edges[p + 1]]
                # six bytes are enough for 48 bits
                single.append(k[c == 1].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
                repeated.append(k[c > 1].astype("<u8").tobytes())
                times.append(c[c > 1].astype("<i4").tobytes())
            yield pa.record_batch([pa.array(some, pa.int32()), *(pa.array(x, pa.binary()) for x in (single, repeated, times))], ["part", "single", "repeated", "times"])
            held.clear()

        for _, raw, offs in by_bytes(batches):
            for s in shingle_sets(raw, offs, size):
                low = s[:np.searchsorted(s, np.uint64(1 << 63))]
                held.append(_bucket(low))
                many += len(low)
            if many > 4_000_000:
                yield from out()
                many = 0
        if many:
            yield from out()
    return run


def _gather_counts(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = [], []
        for b in batches:
            for single, repeated, n in zip(*(c.to_pylist() for c in b.columns[1:])):
                raw = np.frombuffer(single, np.uint8).reshape(-1, 6)
                wide = np.zeros((len(raw), 8), np.uint8)
                wide[:, :6] = raw
                keys += [wide.view("<u8").ravel(), np.frombuffer(repeated, "<u8")]
                times += [np.ones(len(raw), np.int32), np.frombuffer(n, "<i4")]
        if keys:
            key, n = np.concatenate(keys), np.concatenate(times)
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            total = np.add.reduceat(n, first, dtype=np.int64)
            hot = total >= least
            if hot.any():
                yield pa.record_batch([pa.array(key[first][hot].astype(np.int64)), pa.array(total[hot])], ["bucket", "n"])
    return run


def frequent_shingles(docs: DataFrame, size: int = SHINGLE, least: int = FREQUENT, most: int = MAX_FREQUENT) -> np.ndarray:
    """Sorted buckets of the shingles of at least ``least`` documents, the ``most`` most frequent ones if there are more."""
    parts = _parts(docs)
    packed = docs.select("text").mapInArrow(lean(_count(size, parts)), "part int, single binary, repeated binary, times binary")
    counts = cut(packed.repartition(parts, "part").mapInArrow(lean(_gather_counts(least)), "bucket long, n long"), "frequent")
    if counts.count() > most:
        counts = counts.orderBy(F.desc("n"), "bucket").limit(most)
    return np.sort(np.asarray(counts.select("bucket").toArrow().column(0)).astype(np.uint64))


def _parts(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# --- candidates -------------------------------------------------------------

def _ordered_prefix(values: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the global order: by hash, the frequent ones after the others."""
    n = prefix_length(len(values))
    if len(frequent):
        low = values[:np.searchsorted(values, np.uint64(1 << 63))]
        at = np.searchsorted(frequent, _bucket(low))
        hot = np.zeros(len(values), dtype=bool)
        hot[:len(low)] = frequent[np.minimum(at, len(frequent) - 1)] == _bucket(low)
        if hot[:n].any():
            return np.concatenate((values[~hot], values[hot]))[:n]
    return values[:n]


def _star(token: np.ndarray, doc: np.ndarray, small: int):
    """Groups of equal tokens: pairs of the groups up to ``small`` members, else a star around the smallest id.

    Arrays must be sorted by token, then document, without repeats.  Returns
    pairs and a mask of the rows that belong to larger groups.
    """
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    size = np.diff(np.concatenate((first, [len(token)])))
    group = np.repeat(np.arange(len(first)), size)
    big = size > small
    a, b = [], []
    star = big[group] & (np.arange(len(token)) != first[group])
    a.append(doc[first[group[star]]])
    b.append(doc[star])
    for gap in range(1, small):
        own = np.flatnonzero((group[gap:] == group[:-gap]) & ~big[group[gap:]]) if gap < len(token) else np.zeros(0, np.int64)
        if not len(own):
            break
        a.append(doc[own])
        b.append(doc[own + gap])
    return np.concatenate(a), np.concatenate(b), big[group]


def _unique_rows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return a[keep], b[keep]


POSTED = "part int, token binary, doc binary, joined binary"


def _post(size: int, parts: int, shared):
    """Prefix shingles of a task's documents, packed by part.

    Part -1 holds pairs, part -2 members (shingle, document) of groups that
    were large within the task: of these only the smallest document goes on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        tokens, docs, many = [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            token, doc = _unique_rows(np.concatenate(tokens), np.concatenate(docs))
            tokens.clear()
            docs.clear()
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            size_of = np.diff(np.concatenate((first, [len(token)])))
            group = np.repeat(np.arange(len(first)), size_of)
            big = (size_of > LOCAL_PAIRS)[group]
            lead = np.arange(len(token)) == first[group]
            if big.any():
                a, b, _ = _star(token[big], doc[big], 0)
                a, b = _unique_rows(a, b)
                yield _packed([-1, -2], [a.view(np.uint64), token[big]], [b, doc[big]], [np.zeros(0, np.uint8)] * 2)
            send = ~big | lead
            token, doc, joined = token[send], doc[send], (big & lead)[send].astype(np.uint8)
            part = (token % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            some = [p for p in range(parts) if edges[p] < edges[p + 1]]
            own = [order[edges[p]:edges[p + 1]] for p in some]
            yield _packed(some, [token[o] for o in own], [doc[o] for o in own], [joined[o] for o in own])

        for rows, raw, offs in by_bytes(batches):
            for d, s in zip(rows.column(0).to_pylist(), shingle_sets(raw, offs, size)):
                if d is not None and len(s):
                    p = _ordered_prefix(s, frequent)
                    tokens.append(p)
                    docs.append(np.full(len(p), d, dtype=np.int64))
                    many += len(p)
            if many > 2_000_000:
                yield from out()
                many = 0
        if many:
            yield from out()
    return run


def _packed(parts, tokens, docs, joined) -> pa.RecordBatch:
    return pa.record_batch([pa.array(parts, pa.int32()), pa.array([x.astype("<u8").tobytes() for x in tokens], pa.binary()),
                            pa.array([x.astype("<i8").tobytes() for x in docs], pa.binary()), pa.array([x.tobytes() for x in joined], pa.binary())],
                           ["part", "token", "doc", "joined"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of a shingle over all tasks: ``token`` is null in a pair, and set in a member of a large group."""
    token, doc, joined = [], [], []
    for batch in batches:
        for t, d, j in zip(*(c.to_pylist() for c in batch.columns[1:])):
            token.append(np.frombuffer(t, "<u8"))
            doc.append(np.frombuffer(d, "<i8"))
            joined.append(np.frombuffer(j, np.uint8))
    if not token:
        return
    token, doc, joined = np.concatenate(token), np.concatenate(doc), np.concatenate(joined)
    order = np.lexsort((doc, token))
    token, doc, joined = token[order], doc[order], joined[order]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    size = np.diff(np.concatenate((first, [len(token)])))
    group = np.repeat(np.arange(len(first)), size)
    large = (size > ALL_PAIRS) | (np.maximum.reduceat(joined, first) > 0)
    some = (size > 1)[group]
    yield from _rows(*_star_of(token, doc, some & ~large[group], ALL_PAIRS))
    yield from _rows(*_star_of(token, doc, some & large[group], 0))
    own = large[group]
    if own.any():
        yield pa.record_batch([pa.array(token[own].view(np.int64)), pa.array(doc[own]), pa.nulls(int(own.sum()), pa.int64())], ["token", "a", "b"])


def _star_of(token, doc, mask, small):
    if not mask.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, _ = _star(token[mask], doc[mask], small)
    return _unique_rows(a, b)


def _rows(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(a), 100_000):
        k = len(a[i:i + 100_000])
        yield pa.record_batch([pa.nulls(k, pa.int64()), pa.array(a[i:i + 100_000]), pa.array(b[i:i + 100_000])], ["token", "a", "b"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p, t, d in zip(*(c.to_pylist() for c in batch.columns[:3])):
            t, d = np.frombuffer(t, "<u8").view(np.int64), np.frombuffer(d, "<i8")
            if p == -1:
                yield from _rows(t, d)
            else:
                yield pa.record_batch([pa.array(t), pa.array(d), pa.nulls(len(t), pa.int64())], ["token", "a", "b"])


# --- verification -----------------------------------------------------------

def _by_bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, n_a, n_b, x, y = (c.to_pylist() for c in batch.columns)
        differ = [differing(s, t) for s, t in zip(x, y)]
        keep = pa.array([i for i, d in enumerate(differ) if may_link(n_a[i], n_b[i], d)], pa.int64())
        yield pa.record_batch([batch.column(0).take(keep), batch.column(1).take(keep), pa.array(differ, pa.int64()).take(keep)], ["a", "b", "differ"])


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = (c.to_pylist() for c in batch.columns[2:])
        keep = []
        for i, (s, t) in enumerate(zip(x, y)):
            s, t = np.frombuffer(s, "<u8"), np.frombuffer(t, "<u8")
            both = np.concatenate((s, t))
            both.sort(kind="stable")                       # two ascending runs
            overlap = int((both[1:] == both[:-1]).sum())
            keep.append(UNDER * overlap >= OVER * (len(s) + len(t) - overlap) and len(s) > 0)
        mask = pa.array(keep, pa.bool_())
        yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def _verify(pairs: DataFrame, docs: DataFrame, size: int, name: str) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold, by intersection of their sorted arrays."""
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-ids")
    wanted = F.broadcast(ids) if ids.count() <= MAX_IDS else ids      # eight bytes an id
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    sets = cut(texts.mapInArrow(lean(_sets(size)), "doc_id long, hashes binary"), f"{name}-sets")
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y"))
    return cut(both.mapInArrow(lean(_exact), "a long, b long").distinct(), f"{name}-links")


def _fold(bits: list[bytes], size: int) -> np.ndarray:
    """The bitmaps as rows of 64-bit words, all folded to ``size`` bytes."""
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, size // 8), axis=0) for x in bits])


def _tile_pairs(left: list, right: list, depth: int) -> list[tuple[int, int, bool]]:
    """Pairs across components of a tile that may link: for each left document the ``depth`` nearest of each component.

    Sides are lists of (doc, n, comp, bits).  The last value tells whether
    more pairs of this document and component were left out.
    """
    size = min(len(r[3]) for r in left + right)
    right = sorted(right, key=lambda r: r[1])
    x, y = _fold([r[3] for r in left], size), _fold([r[3] for r in right], size)
    ids, n, comp = (np.array([r[k] for r in right], dtype=np.int64) for k in range(3))
    out = []
    for i, (d, m, c, _) in enumerate(left):
        # the band of sizes that can be linked with this one
        band = slice(np.searchsorted(n * UNDER, OVER * m), np.searchsorted(n * OVER, UNDER * m, side="right"))
        some = band.start + np.flatnonzero(comp[band] != c)
        if not len(some):
            continue
        differ = np.bitwise_count(y[some] ^ x[i]).sum(axis=1, dtype=np.int64)
        overlap = (n[some] + m - differ) // 2
        near = UNDER * overlap >= OVER * (n[some] + m - overlap)
        if not near.any():
            continue
        some, differ = some[near], differ[near]
        some = some[np.lexsort((ids[some], differ, comp[some]))]
        own = comp[some]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        size_of = np.diff(np.concatenate((first, [len(own)])))
        place, total = np.arange(len(own)) - np.repeat(first, size_of), np.repeat(size_of, size_of)
        out += [(min(d, o), max(d, o), bool(t > depth)) for o, p, t in zip(ids[some].tolist(), place.tolist(), total.tolist()) if p < depth]
    return out


def _run_tiles(depth: int):
    """Rows come sorted by tile, left side first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, found = None, ([], []), {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(*pair, more) for pair, more in found.items()]
            found.clear()
            if rows:
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.bool_()))], ["a", "b", "more"])

        def close() -> None:
            if sides[0] and sides[1]:
                for a, b, more in _tile_pairs(*sides, depth):
                    found[(a, b)] = found.get((a, b), False) or more

        for batch in batches:
            for tile, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != key:
                    close()
                    key, sides = tile, ([], [])
                sides[side].append(row)
            if len(found) > 300_000:
                yield from out()
        close()
        yield from out()
    return run


def _tiles(large: DataFrame, comp: DataFrame, own: DataFrame, depth: int) -> DataFrame:
    """Candidate pairs ``(a, b, more)`` among members ``(token, doc)`` of large groups that span components.

    A tile's left side is a block of the members outside the group's largest
    component, its right side a block of all members.  Within a tile each
    left document meets the band of right ones whose size allows a link.
    """
    members = large.join(comp, F.col("doc") == F.col("node"), "left").select("token", "doc", F.coalesce("comp", "doc").alias("comp"))
    per_comp = members.groupBy("token", "comp").agg(F.count("*").alias("m"))
    spans = (per_comp.groupBy("token").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.sum("m").alias("m"), F.max("m").alias("most"))
             .filter("m > most"))
    # only members of groups that span components carry their bitmaps
    rows = (members.join(spans, "token").join(own.withColumnRenamed("doc_id", "doc"), "doc")
            .withColumn("lefts", F.ceil((F.col("m") - F.col("most")) / BLOCK).cast("int")).withColumn("rights", F.ceil(F.col("m") / BLOCK).cast("int")))
    block = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    left = (rows.filter("comp != main").withColumn("one", block("lefts")).withColumn("side", F.lit(0))
            .withColumn("two", F.explode(F.expr("sequence(0, rights - 1)"))))
    right = (rows.withColumn("two", block("rights")).withColumn("side", F.lit(1))
             .withColumn("one", F.explode(F.expr("sequence(0, lefts - 1)"))))
    tile = F.xxhash64("token", "one", "two").alias("tile")                       # tiles that collide only test more pairs
    # groups of the same family of documents share most of their pairs: where they share a task, a pair comes out once
    family = F.xxhash64("main", "one", "two").alias("family")
    columns = ["side", "doc", "n", "comp", "bits"]
    tiled = left.select(family, tile, *columns).union(right.select(family, tile, *columns))
    return (tiled.repartition(_parts(large), "family").sortWithinPartitions("family", "tile", "side").select("tile", *columns)
            .mapInArrow(lean(_run_tiles(depth)), "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more")))


# --- components -------------------------------------------------------------

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, comp)`` of the nodes of ``edges(a, b)``: the smallest node each can reach.

    Every round takes the smallest label among a node's neighbours and then
    the label of that label, so a chain is halved each time.  Labels are
    written after each round.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).select(F.col("a").alias("node"), "comp"), name)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("least"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("comp").alias("old"), F.least("comp", "least").alias("comp"))
        step = cut(hooked, name)
        up = step.select(F.col("node").alias("_up"), F.col("comp").alias("_to"))
        step = cut(step.join(up, F.col("comp") == F.col("_up"), "left").select("node", "old", F.coalesce("_to", "comp").alias("comp")), name)
        labels = step.select("node", "comp")
        if step.filter("comp != old").isEmpty():
            return labels


# --- the join ---------------------------------------------------------------

def similar_documents(docs: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sets, classes, links and components.

    Returns ``sets(doc_id, n)``; ``classes(doc_id, rep)``: the smallest document
    with an equal set, for documents with a non-empty one; ``links(a, b)`` between
    class representatives, the pairs that were needed to connect the linked
    classes and were found to reach the threshold; and ``components(node, comp)``
    of these links.
    """
    spark, parts = docs.sparkSession, _parts(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = cut(texts.mapInArrow(lean(_describe(size)), "doc_id long, n long, digest binary, bits binary"), "sets")
    known = sets.filter("doc_id is not null and n > 0")
    equal = known.groupBy("n", "digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    copied = cut(equal.filter("copies > 1").drop("copies"), "copied")
    every = cut(known.select("doc_id", "n", "digest").join(copied, ["n", "digest"], "left")
                .select("doc_id", F.coalesce("rep", "doc_id").alias("rep")).distinct(), "classes")
    classes = every.groupBy("doc_id").agg(F.min("rep").alias("rep"))
    # a document of several texts links their classes
    bridges = every.withColumnRenamed("rep", "b").join(classes, "doc_id").select(F.col("rep").alias("a"), "b").filter("a != b").distinct()

    frequent = spark.sparkContext.broadcast(frequent_shingles(texts, size, FREQUENT, MAX_FREQUENT))       # MAX_FREQUENT numbers at most
    posted = cut(texts.mapInArrow(lean(_post(size, parts, frequent)), POSTED), "posted")
    met = posted.filter("part >= 0").repartition(parts, "part").mapInArrow(lean(_meet), "token long, a long, b long")
    found = cut(met.union(posted.filter("part < 0").mapInArrow(lean(_unpack), "token long, a long, b long")), "found")

    rep = lambda x: classes.select(F.col("doc_id").alias(x), F.col("rep").alias(f"rep_{x}"))
    pairs = (found.filter("token is null").select("a", "b").distinct().join(rep("a"), "a").join(rep("b"), "b")
             .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).filter("a != b").distinct())
    # a representative's own row; where rows repeat an id, each of its sets
    own = known.select("doc_id", "n", "bits").distinct()
    side = lambda x: own.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    near = (pairs.join(side("a"), "a").join(side("b"), "b").filter(f"least(n_a, n_b) * {UNDER} >= {OVER} * greatest(n_a, n_b)")
            .select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(lean(_by_bitmap), "a long, b long, differ long"))
    near = cut(near.groupBy("a", "b").agg(F.min("differ").alias("differ")), "near")

    # each document with the nearest one before it, then what still lies between components
    nearest = cut(near.groupBy("b").agg(F.min_by("a", F.struct("differ", "a")).alias("a")).select("a", "b"), "nearest")
    links = _verify(nearest, texts, size, "nearest").union(bridges)
    comp = components(links)
    side = lambda x: comp.select(F.col("node").alias(x), F.col("comp").alias(f"comp_{x}"))
    apart = F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")
    others = cut(near.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(apart).select("a", "b").join(nearest, ["a", "b"], "left_anti"), "others")
    links, comp = _more_links(links, comp, others, texts, size)

    large = found.filter("token is not null").select("token", F.col("a").alias("doc"))
    large = cut(large.join(rep("a").withColumnRenamed("a", "doc"), "doc").select("token", F.col("rep_a").alias("doc")).distinct(), "large")
    tested = nearest.union(others)
    for depth in DEPTHS:
        candidates = cut(_tiles(large, comp, own, depth), "tiles")
        more = cut(candidates.select("a", "b").join(tested, ["a", "b"], "left_anti"), "open")
        links, comp = _more_links(links, comp, more, texts, size)
        if candidates.filter("more").isEmpty():
            break
        tested = tested.union(more)
    return sets.select("doc_id", "n"), classes, links, comp


def _more_links(links: DataFrame, comp: DataFrame, pairs: DataFrame, docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Links and components after the pairs that reach the threshold are added."""
    if pairs.isEmpty():
        return links, comp
    new = _verify(pairs, docs, size, "more")
    if new.isEmpty():
        return links, comp
    links = links.union(new)
    return links, components(links)


def join_components(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per ``doc_id``: ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    sets, classes, _, comp = similar_documents(docs, size)
    comp = comp.withColumnRenamed("node", "rep")
    per_doc = sets.filter("doc_id is not null").groupBy("doc_id").agg(F.max("n").alias("n_shingles"))
    labelled = classes.join(comp, "rep", "left").select("doc_id", F.coalesce("comp", "rep").alias("component_id"))
    out = per_doc.join(labelled, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.union(sets.filter("doc_id is null").select("doc_id", "n", F.lit(None).cast("long")))


def filter_documents(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Rows without an id stay.  Of rows that repeat an id, one stays.
    """
    docs, back = apart(docs, ("doc_id", "text"))
    found = cut(join_components(docs, size), "components")
    kept = cut(found.filter("doc_id = component_id").select(F.col("doc_id").alias("_id")), "kept")
    wanted = F.broadcast(kept) if kept.count() <= MAX_IDS else kept                # eight bytes an id
    out = docs.join(wanted, F.col("doc_id").cast("long") == F.col("_id"), "left_semi")
    known = docs.filter("doc_id is not null")
    if known.count() != found.filter("doc_id is not null").count():
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        out = out.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(whole, F.xxhash64("text")).alias("_row")).select("_row.*")
    return back(out.unionByName(docs.filter("doc_id is null")))
