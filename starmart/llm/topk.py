"""Exact top-k inner products through a pivot-distance index.

Components become whole numbers, floor(1024 * x).  With M the largest length
of a vector, each gets one more component that brings its length to M, and a
query is stretched to length M: then the distance of query and vector falls
exactly as their inner product rises, and the triangle inequality bounds one by
the other.  ``PIVOTS`` points are chosen on a bounded sample; every vector is
keyed by its nearest pivot and its distance to it, and the index is sorted by
that key, so that a range of distances around a pivot, an annulus, is a run of
rows that Parquet's statistics find.

Queries go in blocks of ``BLOCK_BYTES``, ordered by the index's key so that
those of a block lie together; a block is broadcast.  Its queries first search the annulus
that they lie in around their nearest pivots; the k-th score found gives each a
radius.  No vector beyond the radius can enter the result, and those within it
have a distance to any pivot that differs from the query's by at most the
radius: the annuli are expanded to that width, and the rest of the index is
never read.  Within a task the bound is applied again to each slice of sorted
rows, the remaining ones are multiplied as blocks of a matrix, and at most k
rows a query leave the task.

The result is exact for any choice of pivots; the sample only decides the work.

Defined results: vectors that are null or hold a null or non-finite component
(also after scaling) and rows without vec_id take no part; shorter vectors
count as padded with zeros, so an empty one scores 0; rows that repeat a vec_id
are candidates of their own, but never for the query of that id, which is asked
once, with the smallest of its vectors; scores beyond 64 bits are held at the
limit; an empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import cut, scratch_path
from starmart.operators.ordering import with_running_total

SCALE = 1024.0
PIVOTS = 64
#: Rows, the first by a hash of their id, on which pivots are chosen.
SAMPLE = 4096
#: Annuli of equal counts around each pivot in which the search begins.
RINGS = 64
#: Nearest pivots around which a query begins.
NEAR = 2
#: Bytes of a block of queries with their distances; a block is broadcast.
BLOCK_BYTES = 32 << 20
#: Rows and bytes of a slice of the index, and queries that are multiplied at once.
SLICE_ROWS, SLICE_BYTES, TILE = 512, 8 << 20, 4096
#: Candidates that a task gathers before it keeps the best.
GATHER = 400_000
#: Slack for rounding of distances, as a share of M.
SLACK = 1e-5

_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_NONE = -(1 << 63)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """Whole-number vectors of a list column, padded to ``dim`` components; a row of nan where one takes no part."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().cast(pa.float64())
    size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(values.fill_null(float("nan")).to_numpy(zero_copy_only=False) * SCALE)
    if len(size) and (size == dim).all():
        out = flat.reshape(-1, dim)
    else:
        out = np.zeros((len(size), dim))
        out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    bad = ~np.isfinite(out).all(axis=1)
    if column.null_count:
        bad |= ~column.is_valid().to_numpy(zero_copy_only=False)
    if bad.any():
        out = out.copy()
        out[bad] = np.nan
    return out


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whole-number inner products of the rows of x and y, as longs."""
    most = np.abs(x).max(initial=0.0) * np.abs(y).max(initial=0.0) * max(x.shape[1], 1)
    if most < _EXACT:                                   # then every partial sum is exact in a double
        return (x @ y.T).astype(np.int64)
    big = lambda a: np.array([[int(v) for v in row] for row in a], dtype=object).reshape(a.shape)
    return np.clip(big(x) @ big(y).T, _NONE + 1, _LONG).astype(np.int64)


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors with their extra component to the pivots (whose last component is theirs)."""
    d = (x * x).sum(axis=1)[:, None] + (extra * extra)[:, None] + (pivots * pivots).sum(axis=1)[None, :]
    d -= 2 * (x @ pivots[:, :-1].T + extra[:, None] * pivots[None, :, -1])
    return np.sqrt(np.maximum(d, 0))


def _extra(x: np.ndarray, length: float) -> np.ndarray:
    return np.sqrt(np.maximum(length * length - (x * x).sum(axis=1), 0))


def choose_pivots(x: np.ndarray, extra: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` pivots: points far from each other, moved to the means of what is nearest to them."""
    points = np.concatenate([x, extra[:, None]], axis=1)
    chosen = [0]
    nearest = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    pivots = points[chosen]
    for _ in range(5):
        own = _distances(points[:, :-1], points[:, -1], pivots).argmin(axis=1)
        sums, sizes = np.zeros_like(pivots), np.bincount(own, minlength=len(pivots))
        np.add.at(sums, own, points)
        pivots = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], pivots)
    return pivots


@dataclass
class Index:
    """Rows sorted by (pivot, dist, vec_id), and what locates a vector among them."""
    rows: DataFrame
    pivots: np.ndarray
    length: float
    dim: int
    rings: dict[int, np.ndarray]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids and squared lengths of the vectors that take part, and their dimensions."""
    for batch in batches:
        column = batch.column(1)
        size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        for a, b in _pieces(len(size), int(size.max(initial=0))):
            x = _vectors(column.slice(a, b - a), int(size[a:b].max(initial=0)))
            with np.errstate(over="ignore", invalid="ignore"):
                square = (x * x).sum(axis=1) if x.shape[1] else np.zeros(len(x))
                ok = np.isfinite(x).all(axis=1) & column.slice(a, b - a).is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(square[ok]), pa.array(size[a:b][ok])], names=["square", "dim"])


def _pieces(rows: int, dim: int) -> list[tuple[int, int]]:
    step = max(1, min(SLICE_ROWS, SLICE_BYTES // (8 * max(dim, 1))))
    return [(a, min(a + step, rows)) for a in range(0, rows, step)]


def _locate(pivots: np.ndarray, length: float, dim: int, stretch: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add each vector's nearest pivot and its distance; vectors that take no part go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _pieces(batch.num_rows, dim):
                part = batch.slice(a, b - a)
                x = _vectors(part.column(1), dim)
                ok = np.isfinite(x).all(axis=1) & part.column(1).is_valid().to_numpy(zero_copy_only=False)
                part, x = part.filter(pa.array(ok)), x[ok]
                with np.errstate(over="ignore", invalid="ignore"):
                    d = _distances(*_stretched(x, length), pivots) if stretch else _distances(x, _extra(x, length), pivots)
                d = np.nan_to_num(d, nan=0.0, posinf=np.finfo(float).max)
                near = d.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near])],
                                                 names=[*part.schema.names, "pivot", "dist"])
    return run


def _stretched(q: np.ndarray, length: float) -> tuple[np.ndarray, np.ndarray]:
    """Queries stretched to ``length``; their extra component is 0.  A zero query stays where it is."""
    norm = np.sqrt((q * q).sum(axis=1))
    return q * np.divide(length, norm, out=np.ones_like(norm), where=norm > 0)[:, None], np.zeros(len(q))


def build_index(embeddings: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE, rings: int = RINGS) -> Index | None:
    """Index every vector that takes part; None if there is none.  ``embeddings`` have vec_id and embedding."""
    spark = embeddings.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = embeddings.select(F.col("vec_id").alias("vec_id"), F.col("embedding").alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    most = given.mapInArrow(_measure, "square double, dim long").agg(F.max("square").alias("square"), F.max("dim").alias("dim"), F.count(F.lit(1)).alias("n")).first()
    if not most["n"]:
        return None
    dim, length = int(most["dim"]), float(np.sqrt(most["square"]))
    # a bounded sample by hash; equal vectors in it give one pivot
    some = given.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
    x = _vectors(some.column(0), dim)
    x = x[np.isfinite(x).all(axis=1)]
    with np.errstate(over="ignore", invalid="ignore"):
        chosen = choose_pivots(x, _extra(x, length), pivots) if len(x) and np.isfinite(length) else np.zeros((1, dim + 1))
    chosen = np.nan_to_num(chosen, posinf=0.0, neginf=0.0)
    kind = given.schema["embedding"].dataType.simpleString()
    id_type = given.schema["vec_id"].dataType.simpleString()
    keyed = given.mapInArrow(_locate(chosen, length, dim, False), f"vec_id {id_type}, embedding {kind}, pivot int, dist double")
    order = ["pivot", "dist", "vec_id"]
    rows = cut(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order), "topk-index")
    cuts = rows.groupBy("pivot").agg(F.percentile_approx("dist", [i / rings for i in range(1, rings)], 10_000).alias("cuts")).collect()      # a row a pivot
    return Index(rows, chosen, length, dim, {r["pivot"]: np.array(r["cuts"]) for r in cuts})


# --- search ---------------------------------------------------------------------------

def first_reach(index: Index, d: np.ndarray, near: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of distances to each pivot in which a query begins: the annulus that it lies in, around its nearest pivots."""
    low, high = np.full(d.shape, np.inf), np.full(d.shape, -np.inf)
    slack = SLACK * index.length
    for p in np.argsort(d, axis=1, kind="stable")[:, :near].T:
        at = np.arange(len(d))
        for pivot in np.unique(p):
            own, cuts = at[p == pivot], index.rings.get(int(pivot))
            if cuts is None:
                continue
            place = np.searchsorted(cuts, d[own, pivot])
            edges = np.concatenate(([-np.inf], cuts, [np.inf]))
            low[own, pivot], high[own, pivot] = edges[place] - slack, edges[place + 1] + slack
    return low, high


def last_reach(index: Index, q: np.ndarray, d: np.ndarray, kth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that can hold a vector scoring ``kth`` or more: distances that differ from the query's by its radius at most."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        norm = np.sqrt((q * q).sum(axis=1))
        square = 2 * index.length ** 2 - 2 * (index.length / norm) * kth.astype(float)
        radius = np.sqrt(np.maximum(square, 0)) + SLACK * index.length
    radius[(kth == _NONE) | ~np.isfinite(radius) | (norm == 0)] = np.inf
    return d - radius[:, None], d + radius[:, None]


def _best(found: list[np.ndarray], k: int) -> np.ndarray:
    """Rows (query, score, vec_id): the k best of each query, ties to smaller ids."""
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
    first = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))[:rows.shape[1]]
    place = np.arange(rows.shape[1]) - np.repeat(first, np.diff(np.append(first, rows.shape[1])))
    return rows[:, place < k]


def _scan(shared, k: int, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each query's k best of a task's rows, from the slices that its ranges meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, low, high, kth = shared.value
        kth = kth.copy()
        found, held = [], 0

        def keep() -> None:
            nonlocal held
            best = _best(found, k)
            found[:] = [best]
            held = best.shape[1]
            full, at = np.unique(best[0], return_index=True)
            count = np.diff(np.append(at, held))
            kth[full[count == k]] = np.maximum(kth[full[count == k]], best[1, (at + count - 1)[count == k]])
        for batch in batches:
            own_ids, pivot, dist = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("vec_id", "pivot", "dist"))
            vectors = batch.column(batch.schema.get_field_index("embedding"))
            for p0, p1 in _pieces(len(own_ids), dim):
                turns = p0 + np.flatnonzero(np.diff(pivot[p0:p1])) + 1
                for a, b in zip([p0, *turns.tolist()], [*turns.tolist(), p1]):
                    live = np.flatnonzero((low[:, pivot[a]] <= dist[a:b].max()) & (high[:, pivot[a]] >= dist[a:b].min()))
                    if not len(live):
                        continue
                    x, xid = _vectors(vectors.slice(a, b - a), dim), own_ids[a:b].astype(np.int64)
                    # of equal vectors, which stand by id, only the first k and the query's own can be in a result
                    begin = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]).any(axis=1) | (np.diff(xid) < 0))))
                    place = np.arange(len(x)) - np.repeat(begin, np.diff(np.append(begin, len(x))))
                    x, xid = x[place <= k], xid[place <= k]
                    for t in range(0, len(live), TILE):
                        some = live[t:t + TILE]
                        s = _products(q[some], x)
                        i, j = np.nonzero((s >= kth[some, None]) & (xid[None, :] != ids[some, None]))
                        if len(i):
                            found.append(np.stack([some[i], s[i, j], xid[j]]))
                            held += len(i)
                        if held > GATHER + 2 * k * len(ids):
                            keep()
        if held:
            best = _best(found, k)
            yield pa.RecordBatch.from_arrays([pa.array(ids[best[0]]), pa.array(best[2]), pa.array(best[1])], names=["query_id", "vec_id", "score"])
    return run


HITS = "query_id long, vec_id long, score long"


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _within(index: Index, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """Rows of the index that any query's range around their pivot meets: a range of the sorted key for each pivot."""
    lows, highs = low.min(axis=0), high.max(axis=0)
    reached = F.lit(False)
    for p in np.flatnonzero(lows <= highs).tolist():
        one = F.col("pivot") == p
        if np.isfinite(lows[p]):
            one = one & (F.col("dist") >= float(lows[p]))
        if np.isfinite(highs[p]):
            one = one & (F.col("dist") <= float(highs[p]))
        reached = reached | one
    return index.rows.where(reached)


def search(index: Index, queries: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best vectors of every query (query_id, embedding), the one with the query's own id left out.

    Queries are asked in blocks; a block of them, and one score for each, pass
    through the driver at a time.
    """
    spark = queries.sparkSession
    kind = queries.schema["embedding"].dataType.simpleString()
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").alias("embedding")).where("query_id IS NOT NULL AND embedding IS NOT NULL")
    located = (asked.groupBy("query_id").agg(F.min("embedding").alias("embedding"))
               .mapInArrow(_locate(index.pivots, index.length, index.dim, True), f"query_id long, embedding {kind}, pivot int, dist double"))
    numbered = with_running_total(located.withColumn("one", F.lit(1).cast("long")), ["pivot", "dist", "query_id"], "one", "no")
    size = max(1, block_bytes // (8 * (index.dim + 3 * len(index.pivots) + 2 * k)))
    numbered = cut(numbered.withColumn("block", F.expr(f"no div {size}")).select("block", "no", "query_id", "embedding"), "topk-queries")
    blocks = numbered.agg(F.max("block")).first()[0]
    path = scratch_path(spark, "topk-hits")
    for b in range(-1 if blocks is None else blocks + 1):
        rows = numbered.where(F.col("block") == b).orderBy("no").toArrow()
        ids, q = rows.column("query_id").to_numpy(), _vectors(rows.column("embedding"), index.dim)
        with np.errstate(over="ignore", invalid="ignore"):
            d = np.nan_to_num(_distances(*_stretched(q, index.length), index.pivots), nan=0.0, posinf=np.finfo(float).max)
        low, high = first_reach(index, d)
        shared = spark.sparkContext.broadcast((ids, q, low, high, np.full(len(ids), _NONE)))
        begun = _within(index, low, high).mapInArrow(_scan(shared, k, index.dim), HITS)
        known = _ranked(begun, k).where(F.col("rank") == k).select("query_id", "score").toArrow()          # at most a row a query of the block
        place = np.argsort(ids)
        kth = np.full(len(ids), _NONE)
        kth[place[np.searchsorted(ids[place], known.column("query_id").to_numpy())]] = known.column("score").to_numpy()
        shared.unpersist()
        low, high = last_reach(index, q, d, kth)
        shared = spark.sparkContext.broadcast((ids, q, low, high, kth))
        hits = _within(index, low, high).mapInArrow(_scan(shared, k, index.dim), HITS)
        hits.write.parquet(f"{path}/block={b}")
        shared.unpersist()
    if blocks is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _ranked(spark.read.schema(HITS).parquet(path), k)


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The k best rows of each query: every vector whose id is divisible by ``every``, against all others."""
    index = build_index(embeddings)
    if index is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return search(index, index.rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding"), k)
