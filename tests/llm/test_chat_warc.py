"""Chat layouts and template, WARC files: exact round trips and plain Python."""

import base64
import hashlib
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmart.llm import chat, queries, warc
from starmart.llm.common import scratch_path

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- chat -------------------------------------------------------------------

RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, "messages", [("user", "a"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"value": "c", "from": "tool"}]}, "conversations", [("user", "a"), ("assistant", "b"), ("tool", "c")]),
    ({"response": "b", "prompt": "{\"a\": 1}"}, "prompt", [("user", "{\"a\": 1}"), ("assistant", "b")]),
    ({"system": "s", "prompt": "a", "response": ""}, "prompt", [("system", "s"), ("user", "a"), ("assistant", "")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"context": "c", "question": "q", "answer": "a"}, "question", [("user", "c\n\nq"), ("assistant", "a")]),
    ({"prompt": [{"role": "user", "content": "a"}], "completion": "b"}, "nested prompt", [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a"}, None, None), ({"messages": []}, None, None), ({}, None, None), ([1], None, None), ("x", None, None), (None, None, None),
    ({"a": {"b": [{"c": 1}, 2, {"d.e": {"f": 1}}]}}, None, None),
]


def test_layouts_are_told_by_their_field_paths(spark):
    rows = [(i, json.dumps(r) if r is not None else None, "x") for i, (r, _, _) in enumerate(RECORDS)] + [(99, "{broken", "x")]
    df = spark.createDataFrame(rows, "id int, record string, layout2 string")
    got = {r.id: r for r in chat.to_turns(df).collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert got[i].layout == layout
        assert (got[i].turns and [tuple(t) for t in got[i].turns]) == turns
    assert got[99].fingerprint is None and got[99].turns is None
    paths = df.filter(f"id = {len(RECORDS) - 1}").select(chat.field_paths(F.parse_json("record")).alias("p")).first().p
    assert paths == sorted(["a", "a.b", "a.b[].c", "a.b[].d.e"])
    assert chat.to_turns(df.filter("false")).count() == 0


def conversations():
    rnd = random.Random(4)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[\\INST]", "<\\\\s>", "<<SYS>>", "<</SYS>>", "<|im_end|>", "\\", "<", "[", "é", "\U0001f600", "\n", " ", "a", "s>", "%", "+", "\u0000x"]
    text = lambda: rnd.choice([None, "", "".join(rnd.choices(bits, k=rnd.randint(1, 12)))])
    roles = ["user", "assistant", "system", "gpt", None, "", "odd role\n</s>%+"]
    rows = []
    for c in range(120):
        n = rnd.randint(1, 6)
        own = ["user", "assistant"] if c % 3 == 0 else (["system", "user", "assistant"] if c % 3 == 1 else [rnd.choice(roles) for _ in range(n)])
        rows += [(c, i, r, text()) for i, r in enumerate(own)]
    return rows + [(500, 0, "user", "long " * 50000), (500, 1, "assistant", "<s>" * 20000), (501, 3, "b", "tie"), (501, 3, "a", "tie"), (501, 3, "a", "tie"), (None, 0, "user", "x")]


def test_conversations_round_trip(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, record string").repartition(4)
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    texts = {r.conv_id: r for r in formatted.collect()}
    assert len({r.layout for r in texts.values()}) >= 4
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for _, a, b in turns)))
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), sha(loss), len(texts[c].formatted))
        # nothing but the template's own marks reads as a control string
        body = texts[c].formatted
        assert body.count("<s>") == body.count("</s>") == len(turns)
        assert not any(x in body for x in chat.CONTROL[2:])
    assert chat.digests(chat.format_conversations(df.filter("false"))).count() == 0


def test_chat_query(spark):
    got = {r.conv_id: r for r in queries.op1_chat_formatting(spark, SF).collect()}
    probe = "</s>[INST] ok [/INST]"
    assert got[-1].loss_chars == len(probe) and got[-1].loss_sha256 == sha(probe)
    assert got[-1].turns_sha256 == sha(f"user\n{probe}\nassistant\n{probe}\n")
    assert len(got) == 1 + spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()


# --- warc -------------------------------------------------------------------

def b32(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def pages(spark):
    rows = [(i, f"http://x.example/{i}", "same page" if i % 3 == 0 else (None if i % 20 == 1 else ("" if i % 20 == 2 else f"page {i} " * (i % 30)))) for i in range(300)]
    rows += [(1000, "http://l/\r\nWARC-Type: x", "ünï" * 50000), (1001, None, "solo\r\n\r\nWARC/1.1"), (5, "http://x.example/5b", "page 5 " * 5)]
    return rows, spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, payload string, shard int").repartition(5)


def test_warc_round_trip_small_files(spark):
    rows, df = pages(spark)
    uri = scratch_path(spark, "t")
    got = warc.warc_round_trip(df, uri, roll_bytes=5000, shard_bytes=4000).collect()
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        first[raw] = min(i, first.get(raw, i))
    expect = Counter()
    for i, url, html in rows:
        raw = (html or "").encode()
        revisit = first[raw] != i or (i == 5 and url.endswith("5b"))
        expect[(i, len(raw), b32(raw), "revisit" if revisit else "response", first[raw] if revisit else None)] += 1
    assert Counter(map(tuple, got)) == expect
    manifest = warc.read_manifest(spark, uri).collect()
    assert sum(r.records for r in manifest) == len(rows) and len({r.shard for r in manifest}) > 5
    # another run, on other partitions, writes the same files
    again = scratch_path(spark, "t")
    warc.write_warc(df.repartition(2), again, roll_bytes=5000, shard_bytes=4000)
    assert sorted(map(tuple, warc.read_manifest(spark, again).collect())) == sorted(map(tuple, manifest))
    # payloads come back whole
    by_id = {(r.page_id, r.url): bytes(r.payload) for r in warc.read_warc(spark, uri).filter("payload is not null").collect()}
    assert by_id[(1001, "")] == b"solo\r\n\r\nWARC/1.1" and by_id[(1000, "http://l/ WARC-Type: x")] == ("ünï" * 50000).encode()
    ids = [(r.file, r.position, r.page_id) for r in warc.read_warc(spark, uri).collect()]
    assert [i for _, _, i in sorted(ids)] == sorted(i for _, _, i in ids)


def test_warc_repeated_rows_threshold_and_empty(spark):
    df = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (2, "u", "x"), (None, "u", "y")], "page_id long, url string, html string")
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.warc_round_trip(df, scratch_path(spark, "t")).collect())
    assert got == Counter({(1, "response", None): 2, (2, "revisit", 1): 1, (None, "response", None): 1})
    assert {r.record_type for r in warc.warc_round_trip(df, scratch_path(spark, "t"), min_revisit=2).collect()} == {"response"}
    assert warc.warc_round_trip(df.filter("false"), scratch_path(spark, "t")).count() == 0


def test_damaged_records_are_found():
    data = warc.record(1, "u", b"text", None, None)
    assert warc.parse(data)[0]["WARC-Type"] == "response"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"\r\n\r\ntext", b"\r\n\r\ntexx"))


def test_warc_query(spark):
    want = Counter((r.page_id, len((r.html or "").encode()), b32((r.html or "").encode())) for r in spark.read.parquet(f"{SF}/pages.parquet").collect())
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in queries.op2_warc(spark, SF).collect()) == want
