"""Merkle manifest against a plain Python tree, and the query against DuckDB."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from starmart.llm import merkle, queries
from tools.check_oracle import value_hash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // 8 * 8
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + 8])))
        i //= 8
    return out


def expect(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    keys = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in keys:
        langs[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[k] = tree([leaf(r) for r in langs[k]])
    top = tree([trees[k][-1][0] for k in keys])
    out = []
    for n, k in enumerate(keys):
        for i, r in enumerate(langs[k]):
            path = way(trees[k], i) + way(top, n)
            h = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                h = leaf((*r[:4], lower(r[4])))
            for before, after in path:
                h = H(before, h, after)
            out.append((r[0], leaf(r), trees[k][-1][0], top[-1][0], H(*[a + b for a, b in path]), h, h == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_heights_ties_nulls_and_many_languages(spark):
    rows = [(i, "web", "en", i, f"Text {i}") for i in range(1200)]                    # more blocks than one, the last one short
    rows += [(i, None, "de", None, None) for i in range(513)]                          # one node in the last block
    rows += [(i, "a", "fr", 1, "É Z") for i in range(512)] + [(i, "a", "it", 1, "z") for i in range(64)] + [(i, "a", "es", 1, "Q") for i in range(9)]
    rows += [(7, "x", f"l{i}", 0, "") for i in range(600)]                            # subroots of more blocks than one
    rows += [(None, "a", "fr", 1, "N"), (None, "a", "fr", 1, "M"), (3, "a", "fr", 1, "Tie"), (3, "a", "fr", 1, "Tie"), (5, "b", None, 2, "Null"), (6, "b", "", 2, "X" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(merkle.verify_documents(df)) == expect(rows)


def test_single_row_empty_table_and_clashing_columns(spark):
    one = spark.createDataFrame([(1, "s", "en", 2, "Ab")], SCHEMA)
    for extra in ("g", "i", "digest", "extra", "one", "place", "_part", "block", "root", "leaf", "path"):
        one = one.withColumn(extra, F.lit("x"))
    assert got(merkle.verify_documents(one)) == expect([(1, "s", "en", 2, "Ab")])
    empty = merkle.verify_documents(one.limit(0))
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and empty.count() == 0


def test_manifest_levels_prove_leaves(spark):
    rows = [(i, "s", "en", i, f"T{i}") for i in range(700)]
    m = merkle.build(merkle.document_leaves(spark.createDataFrame(rows, SCHEMA)), ["doc_id"])
    levels = m.rounds[0].where("block = 0").first()
    assert len(levels["level_0"]) == 64 * 512 and len(levels["level_1"]) == 64 * 64 and len(levels["level_2"]) == 64 * 8
    wrong = m.proofs().where(merkle.fold(F.col("digest"), F.col("path")) != F.lit(m.root))
    assert wrong.count() == 0 and m.proofs().count() == 700


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    mine = queries.op13_merkle_manifest(spark, SF).toPandas()
    theirs = con.execute(queries.ORACLE["op13_merkle_manifest"]).df()
    assert sorted(mine.columns) == sorted(theirs.columns) and value_hash(mine) == value_hash(theirs)
    assert 0 < mine["verified"].sum() < len(mine)
