"""Token output (ORC) and packing against the tokenizers library itself."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import packing, queries, token_orc, tokens
from starmart.llm.common import scratch_path

SF = "/root/testdata/sf0.001"
HARD = [(5, "Hello, World! it's don't they'll,"), (1, None), (2, ""), (3, " \t\n"), (9, "x<|endoftext|>y <|ENDOFTEXT|> z"),
        (7, "H̱ İ a…!! b!… ÉCOLE, ×, a,̈ b."), (8, "1234, 12a, a1!"), (7, "again"), (7, "again"),
        (11, "word, " * 9000), (-4, "日本語。, emoji\U0001f600! it's,")]


def library(text):
    return tokens.encoder(tokens.tokenizer_path()).library.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def hard(spark):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in HARD], "doc_id long, text string, ids string, start int").repartition(3)


def test_random_texts_match_the_library():
    import random

    import pyarrow as pa

    from starmart.llm.common import by_bytes

    rnd, enc = random.Random(3), tokens.Encoder(tokens.tokenizer_path(), max_words=50)
    texts = ["".join(rnd.choices("aAbB,.'!-sStT 12éÉ́ßİ …<|>\t\n", k=rnd.randint(0, 14))) for _ in range(3000)]
    for rows, raw, offs in by_bytes(iter([pa.record_batch({"text": texts[i:i + 500]}) for i in range(0, 3000, 500)])):
        ids, counts = enc.encode(raw, offs)
        for text, got in zip(rows.column(0).to_pylist(), np.split(ids, np.cumsum(counts)[:-1])):
            assert got.tolist() == library(text)


def expect_orc(rows):
    out, start = [], 0
    for d, t in rows:
        ids = library(t)
        out.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_orc_round_trip_over_a_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, queries.op6_token_orc(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert got == expect_orc(rows)


def test_orc_hard_rows_lookup_and_empty(spark):
    path = scratch_path(spark, "t")
    token_orc.write_tokens(hard(spark), path, files=4)
    got = sorted(token_orc.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(d for d, _ in HARD)
    texts = {d: t for d, t in HARD}
    at = 0
    for r in got:
        assert r.start == at
        if r.doc_id != 7:
            assert (r.n_tokens, r.ids_crc32) == (len(library(texts[r.doc_id])), crc(library(texts[r.doc_id])))
        at += r.n_tokens
    assert token_orc.find(spark, path, [9]).first().ids == library(texts[9])
    empty = scratch_path(spark, "t")
    token_orc.write_tokens(hard(spark).filter("false"), empty)
    assert token_orc.read_tokens(spark, empty).count() == 0


def check_packing(pieces, texts):
    by_doc, by_seq = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, own in by_doc.items():
        ids, at = library(texts[d]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert set(by_doc) == set(texts)
    assert sorted(by_seq) == list(range(len(by_seq)))
    return padding / total


def test_packing_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert check_packing(queries.op10_packing(spark, SF).collect(), texts) == 0


def test_packing_small_groups_hard_rows_and_empty(spark):
    rows = hard(spark).filter("doc_id != 7")
    texts = {d: t for d, t in HARD if d != 7}
    assert check_packing(packing.pack_documents(rows, group_tokens=20).collect(), texts) == 0
    assert packing.pack_documents(hard(spark)).groupBy().agg(F.sum("length")).first()[0] == sum(len(library(t)) for _, t in HARD)
    assert packing.pack_documents(rows.filter("false")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_fill_is_the_best_subset_sum(seed):
    rnd = np.random.default_rng(seed)
    counts = {int(k): int(rnd.integers(1, 4)) for k in rnd.integers(1, 60, 6)}
    target = int(rnd.integers(5, 150))
    sums = {0}
    for k, n in counts.items():
        sums = {s + k * j for s in sums for j in range(n + 1) if s + k * j <= target}
    used = packing.best_fill(counts, sorted(counts, reverse=True), target)
    assert sum(k * n for k, n in used.items()) == max(sums)
    assert all(n <= counts[k] for k, n in used.items())
