"""Columns that clash with names inside the operators, records beyond a variant, blocks of copies that lie together."""

import glob
import json
import os
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from starmart.llm import chat, jaccard, mixing, quality, sharding, token_orc, toxicity
from test_chat_warc import RECORDS, conversations, sha

SF = "/root/testdata/sf0.001"
SOURCES = Path(chat.__file__).parent


def internal_names():
    """Every short name that the modules give to a column of their own."""
    found = set()
    for module in ("toxicity", "quality", "mixing", "jaccard", "common"):
        found |= set(re.findall(r'"(_?[a-z][a-z0-9_]{0,14})"', (SOURCES / f"{module}.py").read_text()))
    return sorted(found - {"doc_id", "text", "lang", "source", "n_chars"})


def test_filters_pass_on_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    names = internal_names()
    assert {"_score", "_q_kept", "_id", "_own", "_each", "_size", "_words", "_pass"} <= set(names)
    wide = docs.select("*", *[F.lit(f"v {n}").alias(n) for n in names])
    model = toxicity.fit(docs, labels)
    for apply in (lambda d: quality.filter_documents(d), lambda d: toxicity.filter_documents(d, model), lambda d: jaccard.filter_documents(d), lambda d: mixing.filter_documents(d)):
        got = apply(wide)
        assert got.columns == wide.columns
        wrong = F.lit(False)
        for n in names:
            wrong = wrong | ~F.col(f"`{n}`").eqNullSafe(F.lit(f"v {n}"))
        assert got.where(wrong).count() == 0
        key = lambda d: Counter(map(tuple, d.select("doc_id", "text").collect()))
        assert key(got) == key(apply(docs))


def test_records_beyond_a_variant_are_read_by_types(spark):
    rows = [(i, json.dumps(r) if r is not None else None) for i, (r, _, _) in enumerate(RECORDS)] + [(99, "{broken")]
    df = spark.createDataFrame(rows, "id int, record string")
    small = {r.id: r for r in chat.to_turns(df).collect()}
    for r in chat.to_turns(df, variant_bytes=0).collect():
        assert (r.layout, r.turns) == (small[r.id].layout, small[r.id].turns), rows[r.id]
    talks = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    records = chat.conversation_records(talks)
    by = lambda limit: {r.conv_id: (r.layout, r.turns) for r in chat.to_turns(records, variant_bytes=limit).collect()}
    assert by(0) == by(chat.VARIANT_BYTES)


def test_a_text_longer_than_a_variant_is_formatted_whole(spark):
    n = 14_000_000
    rows = spark.range(1).select(F.lit(1).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text")),
                                 F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"), F.repeat(F.lit("abcdefghi\n"), n).alias("text")))).alias("t")).select("conv_id", "t.*")
    r = chat.digests(chat.format_conversations(rows)).first()
    text = "abcdefghi\n" * n
    assert (r.n_turns, r.loss_chars, r.loss_sha256, r.turns_sha256) == (2, 10 * n, sha(text), sha(f"user\nhi\nassistant\n{text}\n"))


def test_copies_that_lie_together_are_cut_into_even_blocks(spark):
    rows = [(i, "copy" if 1000 <= i < 3000 else f"text {i}", None) for i in range(8000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(4))
    held = Counter(r["shard"] for r in got.where("doc_id BETWEEN 1000 AND 2999").collect())
    assert sum(sorted(held.values(), reverse=True)[:24]) > 1900                      # ten full shards would hold them all; blocks are half a shard
    assert sum(n >= 90 for n in held.values()) >= 15
    counts = Counter(r["shard"] for r in got.collect())
    assert set(counts.values()) == {200}


def test_offsets_follow_the_number_of_a_file_not_its_spelling(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    token_orc.write_tokens(docs, f"{tmp}/orc", files=5)
    want = sorted(map(tuple, token_orc.read_tokens(spark, f"{tmp}/orc").collect()))
    for f in glob.glob(f"{tmp}/orc/part-*"):
        n = int(os.path.basename(f).split("-")[1])
        os.rename(f, f.replace(f"part-{n:05d}", f"part-{99_998 + n}"))
        crc = f"{tmp}/orc/.{os.path.basename(f)}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    assert sorted(map(tuple, token_orc.read_tokens(spark, f"{tmp}/orc").collect())) == want
