"""Packing of documents into windows by minimum bin slack.

Every task encodes its documents and packs them in groups of about
``group_tokens`` ids, so no row is shuffled and no group outgrows a task.  A
document longer than a window fills whole windows first; what remains of each
document (its length modulo the window) goes into a multiset of lengths.
The packer takes the largest length left and looks for the multiset of
other lengths that fills the rest of the window best: a subset-sum dynamic
program over a bitset, with the counts of each length found by backtracking.
The same pattern is applied as often as the counts allow.  Where no multiset
fills a window to the end, one piece is cut.  The last window of a group is
cut into sequences whose lengths are powers of two, which need no padding.

Defined results: a null or empty text is its end id alone; rows that repeat a
``doc_id`` are packed as documents of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm import tokens
from starmart.llm.common import by_bytes, cut, lean

WINDOW = 4096
#: Ids packed together; bounds a task's memory at any size of its input.
GROUP_TOKENS = 6_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, _part int, _group int, _seq long, offset long"


def best_fill(counts: dict[int, int], lengths: list[int], target: int) -> dict[int, int]:
    """Counts of the lengths whose sum is the largest that is at most ``target``.

    ``lengths`` are the keys of ``counts``, descending.  Bit ``s`` of ``bits``
    tells whether ``s`` can be made; each layer adds 1, 2, 4, ... copies of a
    length, and stops once ``target`` can be made.
    """
    bits, mask, layers = 1, (1 << (target + 1)) - 1, []
    for length in lengths:
        if length > target:
            continue
        left, step = min(counts[length], target // length), 1
        while left:
            take = min(step, left)
            more = (bits << (length * take)) & mask
            if more | bits != bits:
                layers.append((length, take, bits))
                bits |= more
            left, step = left - take, step * 2
        if bits >> target & 1:
            break
    total, used = bits.bit_length() - 1, {}
    for length, take, before in reversed(layers):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def pack(sizes: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents of the given sizes."""
    out: list[tuple[int, int, int, int, int]] = []
    seq = 0
    stock: dict[int, list[tuple[int, int]]] = {}          # length -> pieces (document, start)
    for d, size in enumerate(sizes.tolist()):
        whole = size // window
        for k in range(whole):
            out.append((d, k * window, window, seq, 0))
            seq += 1
        if size % window:
            stock.setdefault(size % window, []).append((d, whole * window))
    total = sum(k * len(v) for k, v in stock.items())
    counts = {k: len(v) for k, v in stock.items()}
    lengths = sorted(counts, reverse=True)

    def take(length: int) -> tuple[int, int]:
        counts[length] -= 1
        return stock[length].pop()

    def put(length: int, piece: tuple[int, int]) -> None:
        stock.setdefault(length, []).append(piece)
        if length not in counts:
            lengths.append(length)
            lengths.sort(reverse=True)
        counts[length] = counts.get(length, 0) + 1

    while total >= window:
        lengths = [x for x in lengths if counts[x]]
        first = lengths[0]
        counts[first] -= 1
        pattern = best_fill(counts, lengths, window - first)
        counts[first] += 1
        pattern[first] = pattern.get(first, 0) + 1
        slack = window - sum(k * n for k, n in pattern.items())
        for _ in range(1 if slack else min(counts[k] // n for k, n in pattern.items())):
            at = 0
            for length, n in pattern.items():
                for _ in range(n):
                    d, start = take(length)
                    out.append((d, start, length, seq, at))
                    at += length
            if slack:
                longer = next(x for x in lengths if counts[x])
                d, start = take(longer)
                out.append((d, start, slack, seq, at))
                put(longer - slack, (d, start + slack))
            seq += 1
            total -= window
    # the rest: sequences of descending powers of two
    room = at = 0
    for length in sorted(counts, reverse=True):
        for d, start in stock[length]:
            left = length
            while left:
                if not room:
                    room, at = 1 << (total.bit_length() - 1), 0
                part = min(left, room)
                out.append((d, start, part, seq, at))
                start, left, room, at, total = start + part, left - part, room - part, at + part, total - part
                seq += not room
    return out


def _packed(path: str, window: int, group_tokens: int):
    def rows(group: int, doc_ids: list, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        pieces = np.asarray(pack(sizes, window), dtype=np.int64).reshape(-1, 5)
        d = pieces[:, 0]
        first = np.cumsum(sizes) - sizes
        raw = memoryview(ids.astype("<u4").tobytes())
        begin = (first[d] + pieces[:, 1]).tolist()
        crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(begin, pieces[:, 2].tolist())]
        part = TaskContext.get().partitionId()
        n = len(pieces)
        names = pa.array(doc_ids, pa.int64()).take(pa.array(d))
        return pa.record_batch([names, pa.array(pieces[:, 1]), pa.array(pieces[:, 2]), pa.array(crc, pa.int64()),
                                pa.array(sizes[d]), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, group, np.int32)),
                                pa.array(pieces[:, 3]), pa.array(pieces[:, 4])],
                               ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_part", "_group", "_seq", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        group, held, doc_ids, ids, sizes = 0, 0, [], [], []
        for some, raw, offs in by_bytes(batches):
            got, counts = enc.encode(raw, offs)
            doc_ids += some.column(0).to_pylist()
            ids.append(got.astype(np.uint16 if len(enc.closes) <= 1 << 16 else np.uint32))
            sizes.append(counts)
            held += len(got)
            if held >= group_tokens:
                yield rows(group, doc_ids, np.concatenate(ids), np.concatenate(sizes))
                group, held, doc_ids, ids, sizes = group + 1, 0, [], [], []
        if doc_ids:
            yield rows(group, doc_ids, np.concatenate(ids), np.concatenate(sizes))
    return run


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW,
                   group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Sequence ids are numbered through by task and group; the result is
    written once to the shared folder, so ids and pieces belong together.
    """
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .mapInArrow(lean(_packed(tokenizer or tokens.tokenizer_path(), window, group_tokens)), SCHEMA), "packed")
    groups = rows.groupBy("_part", "_group").agg((F.max("_seq") + 1).alias("_n"))
    before = Window.orderBy("_part", "_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("_part", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # one row per group of some millions of ids; Spark checks the size before it broadcasts
    return (rows.join(offsets, ["_part", "_group"])
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_base") + F.col("_seq")).alias("sequence_id"), "offset"))
