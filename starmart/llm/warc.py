"""Deterministic sharded WARC writer and reader.

Records are numbered in id order and cut into shards by a running total of
their payload bytes, so a shard's records depend on the data alone, not on
partitions or retries.  A task writes the shards it holds in id order: every
record is a gzip member of its own, and a new file is begun where the
compressed size would pass ``roll_bytes``.  Headers are built anew: lengths,
SHA-1 digests of block and payload, record ids derived from the record's
identity, and the date given.  A record whose payload equals that of a smaller
id is a ``revisit`` that names it.

Files are written under temporary names and renamed when complete; each task
then returns its lines of the manifest.  The manifest, written as Parquet at
the end, names the files, their sizes and digests: readers open only what it
lists, so files of lost or repeated tasks are never read, and a rerun gives
the same bytes.

Paths go through ``pyarrow.fs``, so the target may be any shared store it
knows.  Defined results: a null payload is empty; empty payloads are payloads
like others; rows that repeat an id are records of their own, and the first
by id and url is the one referred to (rows equal to it are responses too); an
empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import cut, with_running_total

#: Compressed bytes after which a file is closed.
ROLL_BYTES = 64 << 20
#: A shard's payload bytes, if not given: a quarter of a shuffle partition's share of all, within these bounds.
SHARD_BYTES = (1 << 20, 256 << 20)
DATE = "2024-01-01T00:00:00Z"
#: Payloads of fewer bytes are never written as revisits.
MIN_REVISIT = 0

MANIFEST = "file string, shard long, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, date string, file string, position long"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(url: str | None) -> str:
    """A header line's value: line breaks and blanks at its ends would break the record."""
    return " ".join((url or "").split())


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, refers_url: str | None, date: str = DATE) -> bytes:
    """One WARC record: an HTTP response block, or a revisit that keeps the HTTP header only."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    uri = _clean(url)
    name = lambda i, u: f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{i} {u}')}>"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id, uri)}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {uri}", f"WARC-Page-ID: {page_id}", f"WARC-Payload-Digest: sha1:{_digest(payload)}", f"WARC-Block-Digest: sha1:{_digest(block)}",
             "Content-Type: application/http; msgtype=response", f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to, _clean(refers_url))}",
                  f"WARC-Refers-To-Target-URI: {_clean(refers_url)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member without time or name, so equal data gives equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Files:
    """The files of one shard: written under temporary names, renamed when closed."""

    def __init__(self, store: pafs.FileSystem, root: str, shard: int, roll: int):
        self.store, self.root, self.shard, self.roll = store, root, shard, roll
        self.number, self.out, self.lines = 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is not None and self.size + len(data) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.root}/_temporary-{self.name}-{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.sha = self.store.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha1()
            self.number += 1
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.root}/{self.name}")
            self.lines.append((self.name, self.shard, self.records, self.size, self.sha.hexdigest()))
            self.out = None


def _write(uri: str, roll: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(uri)
        files, note = None, ((), None, None)
        lines: list = []
        for batch in batches:
            for shard, page_id, url, digest, payload, refers_to, refers_url, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if not kind:
                    note = ((page_id, url, digest), refers_to, refers_url)
                    continue
                _, refers_to, refers_url = note if note[0] == (page_id, url, digest) else ((), None, None)
                if files is None or files.shard != shard:
                    if files is not None:
                        files.close()
                        lines += files.lines
                    files = _Files(store, root, shard, roll)
                files.add(member(record(page_id, url, payload, refers_to, refers_url, date)))
        if files is not None:
            files.close()
            lines += files.lines
        yield pa.record_batch([pa.array(list(c)) for c in zip(*lines)] if lines else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())],
                              ["file", "shard", "records", "bytes", "sha1"])
    return run


def write_warc(pages: DataFrame, uri: str, roll_bytes: int = ROLL_BYTES, shard_bytes: int | None = None, date: str = DATE, min_revisit: int = MIN_REVISIT) -> None:
    """Write ``pages(page_id, url, html)`` as WARC files and a manifest under ``uri``."""
    spark = pages.sparkSession
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    narrow = rows.select("page_id", "url", F.octet_length("payload").cast("long").alias("bytes"), F.concat(F.sha1("payload"), F.hex(F.crc32("payload"))).alias("digest"))
    ranked = cut(with_running_total(narrow, ["page_id", "url", "digest"], "bytes", "before", "warc-order"), "warc-rows")
    # the first record of each payload that occurs more than once; groups are summed before they are shuffled
    first = (ranked.filter(F.col("bytes") >= min_revisit).groupBy("digest")
             .agg(F.min(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")).filter("n > 1")
             .select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if shard_bytes is None:
        total = ranked.agg(F.sum("bytes")).first()[0] or 0
        shard_bytes = min(max(total // (4 * n), SHARD_BYTES[0]), SHARD_BYTES[1])
    same = F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("url").eqNullSafe(F.col("refers_url"))
    notes = (ranked.join(first, "digest").filter(~same).groupBy("page_id", "url", "digest")
             .agg(F.first("refers_to").alias("refers_to"), F.first("refers_url").alias("refers_url")))
    # the first id of each shard: as many numbers as there are shards
    firsts = ranked.groupBy("page_id").agg(F.min("before").alias("before")).groupBy(F.expr(f"before div {int(shard_bytes)}")).agg(F.min("page_id").alias("id"))
    bounds = spark.sparkContext.broadcast(np.sort(np.array([r.id for r in firsts.filter("id is not null").collect()], dtype=np.int64)))

    @F.pandas_udf("long")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(bounds.value, ids.to_numpy(), side="right") - 1, 0))

    # records and what is to be noted of them meet in one shuffle: the note stands right before its records
    full = rows.select("page_id", "url", F.concat(F.sha1("payload"), F.hex(F.crc32("payload"))).alias("digest"), "payload",
                       F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"), F.lit(1).alias("kind"))
    noted = notes.select("page_id", "url", "digest", F.lit(None).cast("binary").alias("payload"), "refers_to", "refers_url", F.lit(0).alias("kind"))
    least = F.lit(np.iinfo(np.int64).min).cast("long")          # a null id goes to the first shard
    records = full.union(noted).select(shard_of(F.coalesce("page_id", least)).alias("shard"), "*")
    store, root = pafs.FileSystem.from_uri(uri)
    store.create_dir(root, recursive=True)
    lines = (records.repartition(n, "shard").sortWithinPartitions("shard", "page_id", "url", "digest", "kind")
             .mapInArrow(_write(uri, roll_bytes, date), MANIFEST))
    lines.write.parquet(f"{uri}/_manifest")


def _records(store: pafs.FileSystem, path: str) -> Iterator[tuple[int, bytes]]:
    """The gzip members of a file one after the other, with their positions."""
    with store.open_input_stream(path, compression=None) as source:
        z, parts, at, begin = zlib.decompressobj(31), [], 0, 0
        data = source.read(1 << 20)
        while data:
            parts.append(z.decompress(data))
            if z.eof:
                at += len(data) - len(z.unused_data)
                yield begin, b"".join(parts)
                data, z, parts, begin = z.unused_data, zlib.decompressobj(31), [], at
                data = data or source.read(1 << 20)
            else:
                at += len(data)
                data = source.read(1 << 20)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; raises if its block digest does not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or fields["WARC-Block-Digest"] != f"sha1:{_digest(block)}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, block


def _read(uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, held = [], 0
                for position, data in _records(store, f"{root}/{file}"):
                    f, block = parse(data)
                    kind = f["WARC-Type"]
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    if payload is not None and f["WARC-Payload-Digest"] != f"sha1:{_digest(payload)}":
                        raise ValueError(f"payload of {f['WARC-Record-ID']} does not fit its digest")
                    page, to = f["WARC-Page-ID"], f.get("WARC-Refers-To-Page-ID")
                    rows.append((None if page == "None" else int(page), f["WARC-Target-URI"], payload, int(f["WARC-Payload-Length"]),
                                 f["WARC-Payload-Digest"][5:], kind, int(to) if to else None, f["WARC-Date"], file, position))
                    held += len(data)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)
    return run


def _batch(rows: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)


def read_manifest(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{uri}/_manifest")


def read_warc(spark: SparkSession, uri: str) -> DataFrame:
    """The records of the files that the manifest lists; digests are checked.

    ``payload`` is null in a revisit: the record it refers to has it.
    """
    files = read_manifest(spark, uri).select("file")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n).mapInArrow(_read(uri), RECORDS)


def warc_round_trip(pages: DataFrame, uri: str, **shape) -> DataFrame:
    """Write, then per record read: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    write_warc(pages, uri, **shape)
    return read_warc(pages.sparkSession, uri).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
