"""Jaccard join against all pairs, on the small table and on planted families."""

import random
import re

import pytest

from starmart.llm import jaccard, queries

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {}
    for d, t in rows:
        sets.setdefault(d, []).append(shingles(t))
    ids = sorted(sets)
    comp = {d: d for d in ids}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            for s in sets[a]:
                for t in sets[b]:
                    both = len(s & t)
                    if both and 100 * both >= 75 * (len(s) + len(t) - both):
                        x, y = find(a), find(b)
                        comp[max(x, y)] = min(x, y)
    return sorted((d, max(map(len, sets[d])), find(d)) for d in ids)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def family(rnd, first, base, n, edits):
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"x{rnd.random():.6f}"
        out.append((first + k, " ".join(w)))
    return out


@pytest.fixture(scope="module")
def planted():
    """Families at the threshold, chains, a large family, a passage that all share, copies, short and odd texts."""
    rnd = random.Random(5)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randrange(4000))
    passage = [word() for _ in range(30)]
    rows = [(1000 + i, " ".join([word() for _ in range(25)] + passage + [word() for _ in range(30)])) for i in range(60)]
    for f in range(25):
        rows += family(rnd, 2000 + 20 * f, [word() for _ in range(rnd.randint(20, 120))], rnd.randint(2, 8), 5)
    rows += family(rnd, 4000, [word() for _ in range(60)], 90, 3)
    chain = [word() for _ in range(200)]
    rows += [(5000 + i, " ".join(chain[2 * i:2 * i + 60])) for i in range(60)]
    rows += [(6000 + i, "same few words here now and then") for i in range(40)] + [(6100, "ONE two"), (6101, "one  TWO\n"), (6102, "one two three")]
    rows += [(7000, None), (7001, ""), (7002, " \t"), (7003, "long " * 3000), (7004, "Long " * 2999), (7005, "É x"), (7006, "é x")]
    rows += [(2000, rows[62][1]), (1000, rows[0][1])]           # ids that repeat
    rnd.shuffle(rows)
    return rows


def test_planted_families_match_all_pairs(spark, planted, monkeypatch):
    expect = brute(planted)
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in planted], "doc_id long, text string, n int, rep string").repartition(5)
    assert rows_of(jaccard.join_components(df)) == expect
    # the same with groups that are large from three members on, and without frequent shingles
    monkeypatch.setattr(jaccard, "LOCAL_PAIRS", 2)
    monkeypatch.setattr(jaccard, "ALL_PAIRS", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "FREQUENT", 10_000)
    assert rows_of(jaccard.join_components(df)) == expect


def test_table_matches_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op4_jaccard_join(spark, SF)) == brute(rows)


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.join_components(df).collect()), key=str) == [(3, 2, 3), (None, 2, None), (None, 2, None)]
    assert jaccard.join_components(df.filter("false")).count() == 0


def test_bitmaps_bound_the_overlap_from_above():
    import numpy as np

    rnd = np.random.default_rng(1)
    for _ in range(200):
        pool = rnd.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = np.unique(rnd.choice(pool, rnd.integers(1, 300))), np.unique(rnd.choice(pool, rnd.integers(1, 300)))
        differ = jaccard.differing(jaccard.bitmap(a), jaccard.bitmap(b))
        assert differ <= len(np.setxor1d(a, b))
        assert (len(a) + len(b) - differ) // 2 >= len(np.intersect1d(a, b))
