"""Quality rules and toxicity against plain Python and labels; the pipeline stage by stage."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import queries, quality, toxicity, tokens

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    w, t = words(text), text or ""
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


HARD = [(1, None, "en"), (2, "", None), (3, " \n\t", "en"), (4, "a b c a b c\na b c a b c\n\na b c a b c", "en"), (5, "É\U0001f600 |x| <y>\n#\n#\n # ", "fr"),
        (6, "one word here and " * 4000, "en"), (6, "again", "xx"), (6, "again", "xx"), (7, "x\x0by\x0cz\r\nx\x0by\x0cz\r\n\x1c\x85", None), (None, "no id", "en")]


def test_base_counts_of_hard_texts(spark):
    df = spark.createDataFrame([(*r, 1, True) for r in HARD], "doc_id long, text string, lang string, n_words int, kept boolean").repartition(3)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality_rules(df).collect())
    want = Counter((d, *base(t), base(t)[0] < 50 or 100 * base(t)[4] > 50 * base(t)[0]) for d, t, _ in HARD)
    assert got == want
    assert quality.quality_rules(df.filter("false")).count() == 0
    kept = quality.filter_documents(df)
    assert kept.columns == df.columns


def test_quality_of_a_table_matches_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    got = {r.doc_id: r for r in queries.op5_quality_rules(spark, SF).collect()}
    assert len(got) == len(rows)
    # the references once more, from counts of whole words
    from starmart.llm.common import span_hashes

    classes, bins = {}, {}
    kind = lambda c: 7 if ord(c) > 127 else 4 if c == "\n" else 3 if c in "\t\x0b\x0c\r " else 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if c.isdigit() else 5 if c in ".,;:!?'\"()-" else 6

    def bin_of(word):
        raw = np.frombuffer(re.sub("[A-Z]", lambda m: m[0].lower(), word).encode(), np.uint8)
        return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0] % np.uint64(quality.WORD_BINS))

    memo = {}
    own = {}
    for r in rows:
        c, w = Counter(map(kind, r.text)), Counter(memo.setdefault(x, bin_of(x)) if x not in memo else memo[x] for x in words(r.text))
        own[r.doc_id] = (c, w)
        classes.setdefault(r.lang, Counter()).update(c)
        bins.setdefault(r.lang, Counter()).update(w)

    def jsd(p, q):
        total = 0.0
        for k in set(p) | set(q):
            m = (p.get(k, 0) + q.get(k, 0)) / 2
            total += sum(x * math.log2(x / m) / 2 for x in (p.get(k, 0), q.get(k, 0)) if x)
        return math.sqrt(max(0.0, min(1.0, total)))

    share = lambda c: {k: n / max(1, sum(c.values())) for k, n in c.items()}
    for r in rows:
        c, w = own[r.doc_id]
        top = {k for k, _ in sorted(bins[r.lang].items(), key=lambda x: (-x[1], x[0]))[:quality.COMMON]}
        fold = lambda x: share(Counter({k: sum(n for b, n in x.items() if (b if b in top else -1) == k) for k in top | {-1}}))
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == base(r.text)
        assert g.char_distance == pytest.approx(jsd(share(c), share(classes[r.lang])), abs=1e-9)
        assert g.word_distance == pytest.approx(jsd(fold(w), fold(bins[r.lang])), abs=1e-6)
        failed = g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words
        far = g.char_distance > quality.MAX_CHAR_DISTANCE and len(r.text) >= quality.MIN_CHARS or g.word_distance > quality.MAX_WORD_DISTANCE and g.n_words >= quality.MIN_WORDS
        assert g.base_failed == failed and g.kept == (not failed and not far)


def test_every_language_has_its_own_reference(spark):
    rng = np.random.default_rng(3)
    rows = []
    for lang in range(270):
        # small languages are written in letters beyond ASCII and have words of their own
        first, n = (0x430, 2) if lang >= 256 else (0x61, 3)
        vocabulary = ["".join(map(chr, first + rng.integers(0, 26, 5))) for _ in range(20)]
        rows += [(10 * lang + i, " ".join(rng.permutation(vocabulary * 6)), None if lang == 269 else f"l{lang}") for i in range(n)]
    df = spark.createDataFrame([*rows, (9999, "", "empty")], "doc_id long, text string, lang string").repartition(3)
    at_once = lambda **how: {r.doc_id: tuple(r) for r in quality.quality_rules(df, refs=quality.references(df, **how)).collect()}
    got = {r.doc_id: tuple(r) for r in quality.quality_rules(df).collect()}
    assert len(got) == len(rows) + 1
    assert all(r[-1] for d, r in got.items() if d != 9999) and not got[9999][-1]
    assert got == at_once(max_languages=1000) == at_once(max_languages=3, max_broadcast=0)


def test_quality_rejects_junk_and_keeps_clean(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = queries.op5_quality_rules(spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    junk, clean = [r for r in rows if not r.quality], [r for r in rows if r.quality and not r.base_failed]
    assert sum(r.kept for r in junk) <= 0.02 * len(junk)
    assert sum(r.kept for r in clean) >= 0.995 * len(clean)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op3_toxicity(spark, sf).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    toxic, clean = [p for t, p in held if t], [p for t, p in held if not t]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    # labels of held-out rows are never read
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), flipped)
    assert {r.doc_id: r.score for r in again.collect()} == {r.doc_id: r.score for r in rows}


def test_clauses_compose():
    g = toxicity.Grammar({"idiot ": 4.0, "vequ": 2.0})
    score = lambda *texts: [list(map(float, row)) for row in g.features(np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))))]
    plain, target, negated, reported, word, split, none = (r[0] for r in score("he is an idiot", "You idiot.", "he is not an idiot", "she said idiot", "idiotic", "not good, idiot", "nothing"))
    assert (plain, target, word, none) == (4.0, 6.0, 0.0, 0.0)
    assert negated == 2.0 and reported == pytest.approx(2.4) and split == 4.0
    assert score("VEQUA!", "xvequ", "I will kill you", "kill time")[0][0] == 2.0
    assert [r[0] for r in score("xvequ", "I will kill you", "kill time", "")] == [0.0, pytest.approx(4.5), 0.0, 0.0]


def test_words_are_matched_as_they_are_learned():
    g = toxicity.Grammar({"idiot": 4.0, "дурак ": 3.0, "ηλίθιος ": 2.0, "straße ": 2.0})

    def scores(*texts):
        return g.features(np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))))[:, 0].tolist()
    assert scores("¡idiota!", "“idiot”", "«idiot»", "so—idiot", "so\u00a0idiot", "İ idiot") == [4.0] * 6
    assert scores("Дурак", "ДУРАК!", "ΗΛΊΘΙΟΣ", "STRAßE", "xidiot", "éidiot", "") == [3.0, 3.0, 2.0, 2.0, 0.0, 0.0, 0.0]
    # targets, negations and threats beside such marks
    assert scores("“you” idiot", "“not” idiot", "«kill» you…", "I will kill—you", "\U0001f600 idiot «TÚ»") == [6.0, 2.0, 4.5, 4.5, 6.0]
    # every code point of the text counts once, whatever stands before it
    assert scores("İİİ no clause", "İ, you. Idiot") == [0.0, 4.0]


def test_a_clause_is_read_whole():
    g = toxicity.Grammar({"idiot ": 4.0})
    score = lambda text: g.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0, 0]
    far = "word " * 40
    assert score(f"you {far}idiot") == score(f"idiot {far}you") == 6.0
    assert score(f"she said {far}idiot") == pytest.approx(2.4) and score(f"I will kill {far}you") == pytest.approx(4.5)
    assert score(f"I will kill. {far}you") == 0.0 and score(f"you. {far}idiot") == 4.0
    # no targets from the ends of cut words, negations however long the words between are
    assert score(f"{'x' * 79}u idiot") == 4.0 and score(f"not {'x' * 60} idiot") == 2.0
    assert score("he isn't an idiot") == score("he isn’t an idiot") == score("HE ISN'T an idiot") == 2.0
    assert score("he isn t an idiot") == score("not one of the idiot") == score("he isn't. an idiot") == 4.0


def plain_score(text, weights):
    """Total clause score of a text, word by word."""
    import regex

    low = text.lower()
    found = [(m.start(), m.end(), m.group()) for m in regex.finditer(r"\p{L}+", low)]
    clause = lambda i: sum(c in ".,;:!?\n" for c in low[:i + 1])
    sentence = lambda i: sum(c in ".!?\n" for c in low[:i + 1])
    spans, opened = [], None
    for i, c in enumerate(low):
        if c in "«„»”\"“":
            if opened is None:
                opened = i if c not in "»”" else None
            elif c not in "«„":
                spans.append((opened, i))
                opened = None
    verbs = [a for a, _, w in found if w in toxicity._reports]
    cited = []
    for a, b in spans:
        begin = max([low.rfind(c, 0, a) for c in ".!?\n"])
        rest = b + 2 if low[b + 1:b + 2] == "," else b + 1
        end = min([i for i in range(rest, len(low)) if low[i] in ".,;:!?\n"], default=len(low))
        if any(begin < v < a or b < v < end for v in verbs):
            cited.append((a, b))
    ends = {clause(i): low[i] for i in range(len(low)) if low[i] in ".,;:!?\n"}             # clause number after a stop -> the stop
    told = {clause(v) for v in verbs}
    told |= {c + 1 for c in told if ends.get(c + 1) in (",", ":")}
    total = {}
    for k, (a, b, word) in enumerate(found):
        fits = [w for p, w in weights.items() if (word == p[:-1] if p.endswith(" ") else word.startswith(p))]
        w = max(fits, default=0.0)
        threat = not w and word in toxicity._threats
        if not w and not threat:
            continue
        target = any(x in toxicity._targets and sentence(i) == sentence(a) for i, _, x in found)
        if threat and not target:
            continue
        w = w or toxicity.THREAT_WEIGHT
        negated = any(clause(i) == clause(a) and (x in toxicity._negations or x == "t" and low[i - 1:i] in ("'", "’") and low[i - 2:i - 1] == "n") for i, _, x in found[max(0, k - 3):k])
        reported = clause(a) in told or any(x < a < y for x, y in cited)
        total[clause(a)] = total.get(clause(a), 0.0) + w * (1.5 if target else 1) * (0.5 if negated else 1) * (0.6 if reported else 1)
    return sum(total.values())


def test_clause_scores_equal_plain_ones():
    import random

    r = random.Random(8)
    weights = {"idiot": 4.0, "fool ": 3.0, "vequ": 2.0, "idiots ": 5.0}
    g = toxicity.Grammar(weights)
    bits = ["idiot", "idiots", "fool", "foolish", "vequa", "kill", "hurt", "you", "du", "not", "isn't", "don’t", "said", "wrote", "he", "word", "x", "Ünder", "İ",
            ",", ".", ":", ";", "!", "?", "\n", '"', "“", "”", "«", "»", "„", " ", " ", " ", " ", " "]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    got = g.features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))[:, 0]
    for t, x in zip(texts, got.tolist()):
        assert x == pytest.approx(plain_score(t, weights)), repr(t)


def test_report_verbs_cover_what_is_said():
    g = toxicity.Grammar({"idiot": 3.0})
    score = lambda text: pytest.approx(g.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0, 0])
    assert score("you idiot") == 4.5
    for text in ("he said you idiot", "he said, you idiot", 'he said: "you idiot"', "she wrote: you are an idiot", '"You idiot," he said.', "«you, you idiot. Really», she wrote", "he said, on Monday, “you idiot”"):
        assert score(text) == 2.7, text
    assert score("He said so. You idiot") == 4.5 and score('"Hello", he said. You idiot') == 4.5 and score('he "said", well, you idiot') == 4.5
    assert score("I will kill, you know, you") == 4.5


def test_toxicity_without_labels_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (2, "x " * 50000, "c"), (None, "you idiot", "d")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 1 and all(r.predicted == 0 for r in got)
    assert toxicity.score_documents(docs.filter("false"), labels).count() == 0
    assert toxicity.filter_documents(docs, toxicity.fit(docs, labels)).columns == docs.columns


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts = {r.doc_id: r.kept for r in queries.op5_quality_rules(spark, SF).collect()}
    after, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        from starmart.llm.common import cut

        after = cut(stage(spark, after, SF), "test-stage")
        seen.append(after)
        if name != "packing":
            assert after.columns == docs.columns
    kept = sorted(r.doc_id for r in seen[0].select("doc_id").collect())
    assert kept == sorted(d for d, k in verdicts.items() if k)
    scores = toxicity.score_documents(seen[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(r.doc_id for r in seen[1].select("doc_id").collect()) == sorted(r.doc_id for r in scores.filter("predicted = 0").collect())
    from starmart.llm import jaccard, mixing

    comps = jaccard.join_components(seen[1])
    assert sorted(r.doc_id for r in seen[2].select("doc_id").collect()) == sorted(r.doc_id for r in comps.filter("doc_id = component_id").collect())
    taken = {r.doc_id: r.taken for r in mixing.mixed_sizes(seen[2]).collect()}
    got = Counter()
    for r in seen[3].select("doc_id", "text").collect():
        got[r.doc_id] += len(words(r.text))
    assert got == Counter({k: v for k, v in taken.items() if v})
    library = tokens.encoder(tokens.tokenizer_path()).library
    want = Counter()
    for r in seen[3].select("doc_id", "text").collect():
        want[r.doc_id] += len(library.encode(r.text, add_special_tokens=False).ids) + 1
    pieces = Counter()
    for r in seen[4].collect():
        pieces[r.doc_id] += r.length
    assert pieces == want
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect())) == Counter(map(tuple, seen[4].select("doc_id", "start", "length", "ids_crc32").collect()))
