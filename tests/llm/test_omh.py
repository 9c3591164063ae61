"""Order MinHash against a plain Python version of its definition."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from starmart.llm import omh, queries

SF = "/root/testdata/sf0.001"
LOW = (1 << 24) - 1


def h(*parts):
    seed = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else (p.to_bytes(8, "little", signed=True) if not isinstance(p, tuple) else p[0].to_bytes(4, "little", signed=True))
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def fingerprint(text):
    words = [h(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    grams = [h(*words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else ([h(*words)] if words else [])
    seen, items = {}, []
    order = {}
    for i, g in enumerate(grams):
        order.setdefault(g >> 24, []).append(i)
    for top, places in order.items():
        for n, i in enumerate(places):
            value = grams[i] >> 24 if not n else h(top, (n,)) >> 24
            items.append((value << 24 | i, i))
    items.sort()
    sketches = {}
    for packed, _ in items:
        sketches.setdefault((packed & (1 << 64) - 1) >> 58, []).append(packed)
    out = []
    for number, some in sketches.items():
        two = sorted(some[:2], key=lambda x: x & LOW)
        out.append(number << 24 | h(*[x >> 24 for x in two]) & LOW)
    return out


def like(a, b):
    if not a and not b:
        return 1.0
    return len(set(a) & set(b)) / len({x >> 24 for x in a} | {x >> 24 for x in b})


def expect(rows):
    rows = sorted((d, t or "") for d, t in rows)
    out = []
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        f, e, n = fingerprint(t), fingerprint(edited), fingerprint(nxt)
        hexed = lambda x: "".join(f"{v:08x}" for v in x)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), hexed(f), hexed(e), like(f, e), like(f, n)))
    return out


def check(df, rows):
    got = sorted(map(tuple, df.collect()))
    want = sorted(expect(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5:] for g in got] == [pytest.approx(w[5:]) for w in want]


def test_hard_texts(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices("abcdefgh", k=rnd.randint(0, 60)))) for i in range(0, 160, 2)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "one two"), (205, "É\U0001f600 x  y\nz"), (206, "same " * 3000), (206, "another text with the same id"), (-7, "first of all words here")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, _range int, fp string").repartition(5)
    check(omh.fingerprint_documents(df), rows)
    assert omh.fingerprint_documents(df.filter("false")).count() == 0
    one = omh.fingerprint_documents(df.filter("doc_id = 204")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"one one").hexdigest()


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(queries.op7_order_minhash(spark, SF), rows)


def test_likeness_falls_with_edits_and_sees_order(spark):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(600)]
    block = base[300:] + base[:300]
    few = [w if rnd.random() > 0.02 else "x" for w in base]
    many = [w if rnd.random() > 0.2 else "x" for w in base]
    df = spark.createDataFrame([(" ".join(base), " ".join(v)) for v in (base, few, many, block)], "a string, b string")
    same, near, far, moved = [r[0] for r in df.select(omh.likeness(omh.order_minhash(F.col("a")), omh.order_minhash(F.col("b")))).collect()]
    assert same == 1.0 and near > far and near > 0.5
    assert moved < 0.8                                        # the same k-mers but for two, in another order
