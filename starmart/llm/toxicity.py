"""Toxicity by a weighted finite-state pattern grammar over clauses.

The insult transducer is a weighted automaton of word beginnings and whole
words learned from labelled documents; fixed transducers read threats,
targets (second person), negations and reported speech.  They are composed
clause by clause: a clause counts only where an insult or threat is accepted.
A target anywhere in the sentence raises its weight, a negation among the three
words before the match in its clause lowers it, and so does a report verb: one in
the clause, one in the clause before that ends in a comma or colon, and for what stands
in quotation marks one in the sentence up to them or in the clause after them.  A
logistic model over the clause scores of a document gives its score.

Texts are read as they are learned from: lower-cased by Unicode, words are
runs of letters (``\\p{L}``), and every other code point is a blank.

Learning uses labelled rows with ``crc32(doc_id as text) mod 4`` other than 2,
at most about ``MAX_LABELLED`` of them, chosen by a hash of the id.  Pattern
counts are summed by Spark; the model is fitted to features that come from
patterns learned on the other folds.  ``doc_id``, ``lang``, ``source`` and
labels are never inputs of a score, so equal texts get equal scores.

Defined results: null and empty texts get the score of a text without any
match; without a toxic labelled row every score is the base rate; rows that
repeat an id each get a score; other columns are ignored or passed on.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import apart, by_bytes, cut, lean

#: Bound on the labelled rows that patterns and model are fitted to.
MAX_LABELLED = 12_000
THRESHOLD = 0.3
FOLDS = 4
#: Lengths of the word beginnings that are tried as patterns.
LENGTHS = range(3, 9)
#: A pattern is kept if its log-likelihood ratio and its likelihood ratio reach these, up to so many patterns.
MIN_EVIDENCE, MIN_RATIO, MAX_PATTERNS = 30.0, 5.0, 5_000

# Fixed values of the transducers that aren't learned.
THREATS = "kill hurt destroy smash murder burn beat crush umbringen töten verletzen tuer frapper détruire matar golpear destruir"
TARGETS = "you your yours yourself u du dich dir dein deine tu te toi vous votre tú ti usted vosotros"
NEGATIONS = "not never no nicht kein keine nie jamais pas nunca"
REPORTS = "said says wrote writes called calls quoted claimed sagte schrieb dit disait écrit dijo escribió"
THREAT_WEIGHT, TARGET_FACTOR, NEGATED_FACTOR, REPORTED_FACTOR = 3.0, 1.5, 0.5, 0.6

_WORD = regex.compile(r"\p{L}+")
_threats, _targets, _negations, _reports = (set(s.split()) for s in (THREATS, TARGETS, NEGATIONS, REPORTS))
NEGATION_WORDS = 3

_STOPS = np.array([ord(c) for c in ".,;:!?\n"], dtype=np.uint32)
_SENTENCE = np.array([ord(c) for c in ".!?\n"], dtype=np.uint32)
_LEADS = np.array([ord(c) for c in ",:"], dtype=np.uint32)
#: Quotation marks: those that only open, those that only close (the others do either).
_OPEN, _CLOSE, _EITHER = "«„", "»”", "\"“"
_QUOTES = np.array([ord(c) for c in _OPEN + _CLOSE + _EITHER], dtype=np.uint32)


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    out = np.zeros(0x110000, dtype=bool)
    for a in range(0, 0x110000, 0x800):
        if not 0xD800 <= a < 0xE000:
            for m in _WORD.finditer("".join(map(chr, range(a, a + 0x800)))):
                out[a + m.start():a + m.end()] = True
    return out


def lowered(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, a blank before each and after the last, and the places of the blanks before them."""
    data = raw.tobytes()
    texts = [data[a:b].decode().lower() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    return np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le"), np.uint32), begin


@cache
def _marks():
    """The automaton of targets (0), negations (1) and report verbs (2)."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for kind, some in enumerate((_targets, _negations, _reports)):
        for word in some:
            machine.add_word(f" {word} ", (len(word), kind))
    machine.make_automaton()
    return machine


def _contractions(points: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Places of the ``t`` of words that end in n't."""
    t = np.flatnonzero(low[2:-1] == ord("t")) + 2
    return t[(low[t + 1] == 32) & np.isin(points[t - 1], [0x27, 0x2019]) & (low[t - 2] == ord("n"))]


def _quoted(points: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the marks around every quotation; a quotation ends within its text."""
    at = np.flatnonzero(np.isin(points, _QUOTES))
    spans, opened = [], None
    for p, doc, mark in zip(at.tolist(), (np.searchsorted(begin, at, side="right")).tolist(), map(chr, points[at].tolist())):
        if opened is not None and opened[1] != doc:
            opened = None
        if opened is None:
            if mark not in _CLOSE:
                opened = (p, doc)
        elif mark not in _OPEN:
            spans.append((opened[0], p))
            opened = None
    both = np.array(spans, dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


class Grammar:
    """The composed transducers for one set of weighted patterns (``"abc"``: beginning, ``"abc "``: whole word)."""

    def __init__(self, weights: dict[str, float]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for pattern, w in weights.items():
            self.machine.add_word(" " + pattern, (len(pattern) + 1, w))
        for threat in _threats:
            key = f" {threat} "
            if key not in self.machine:
                self.machine.add_word(key, (len(key), -THREAT_WEIGHT))
        self.machine.make_automaton()

    def features(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Per document: total clause score, largest, number of matched clauses, score per hundred words."""
        n = len(offs) - 1
        out = np.zeros((n, 4))
        if not len(raw):
            return out
        points, begin = lowered(raw, offs)
        low = np.where(_letters()[points], points, np.uint32(32))
        ends = np.concatenate((begin, [len(low) - 1]))
        stops = np.union1d(np.flatnonzero(np.isin(points, _STOPS)), ends)
        sentences = np.union1d(np.flatnonzero(np.isin(points, _SENTENCE)), ends)
        text = low.tobytes().decode("utf-32-le")
        best: dict[int, float] = {}                            # word start -> weight
        for end, (size, w) in self.machine.iter(text):
            at = end - size + 2
            if abs(w) > abs(best.get(at, 0.0)):
                best[at] = w
        starts = np.flatnonzero((low[1:] != 32) & (low[:-1] == 32)) + 1
        if best:
            at = np.fromiter(sorted(best), np.int64, len(best))
            clause = np.searchsorted(stops, at, side="right") - 1
            score: dict[int, float] = {}
            for c, w in zip(clause.tolist(), self._composed(text, points, low, starts, stops, sentences, begin, at, clause, np.array([best[a] for a in at.tolist()])).tolist()):
                score[c] = score.get(c, 0.0) + w
            for c, s in score.items():
                if s > 0:
                    d = int(np.searchsorted(begin, stops[c], side="right")) - 1
                    out[d, 0] += s
                    out[d, 1] = max(out[d, 1], s)
                    out[d, 2] += 1
        size = np.bincount(np.searchsorted(begin, starts, side="right") - 1, minlength=n)
        out[:, 3] = 100 * out[:, 0] / (size + 20)
        return out

    @staticmethod
    def _composed(text: str, points: np.ndarray, low: np.ndarray, starts: np.ndarray, stops: np.ndarray, sentences: np.ndarray,
                  begin: np.ndarray, at: np.ndarray, clause: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The weights of the accepted words in their clauses, after the other transducers."""
        found: tuple = ([], [], [])
        for end, (size, kind) in _marks().iter(text):
            found[kind].append(end - size)
        targets, negations, reports = (np.array(x, dtype=np.int64) for x in found)
        negations = np.union1d(negations, _contractions(points, low))
        target = np.isin(np.searchsorted(sentences, at, side="right"), np.searchsorted(sentences, targets, side="right"))
        # the clause of a report verb, and the one after its comma or colon
        told = np.unique(np.searchsorted(stops, reports, side="right") - 1)
        led = told[np.isin(points[stops[np.minimum(told + 1, len(stops) - 1)]], _LEADS)] + 1
        reported = np.isin(clause, np.union1d(told, led))
        if len(reports):
            first, last = _quoted(points, begin)
            # report verbs in the sentence up to a quotation, or in the clause after it
            line = sentences[np.searchsorted(sentences, first, side="right") - 1]
            after = np.searchsorted(stops, last, side="right")
            comma = (stops[np.minimum(after, len(stops) - 1)] == last + 1) & (points[np.minimum(last + 1, len(points) - 1)] == ord(","))
            until = stops[np.minimum(after + comma, len(stops) - 1)]
            count = lambda a, b: np.searchsorted(reports, b) - np.searchsorted(reports, a)
            cited = (count(line, first) > 0) | (count(last, until) > 0)
            first, last = first[cited], last[cited]
            if len(first):
                span = np.searchsorted(first, at) - 1
                reported |= (span >= 0) & (at < last[np.maximum(span, 0)])
        # the last negation before the word, if it is near and in the same clause
        before = np.searchsorted(negations, at) - 1
        last = negations[np.maximum(before, 0)] if len(negations) else np.zeros(len(at), np.int64)
        near = np.searchsorted(starts, at) - np.searchsorted(starts, last) <= NEGATION_WORDS
        negated = (before >= 0) & near & (last >= stops[clause])
        out = np.abs(w) * np.where(target, TARGET_FACTOR, 1.0) * np.where(negated, NEGATED_FACTOR, 1.0) * np.where(reported, REPORTED_FACTOR, 1.0)
        return np.where((w < 0) & ~target, 0.0, out)           # a threat needs a target


def _design(features: np.ndarray) -> np.ndarray:
    total, top, clauses, rate = features.T
    return np.stack([np.ones(len(features)), np.log1p(total), top / 6, np.log1p(clauses), np.log1p(rate)], axis=1)


class Model:
    def __init__(self, grammar: Grammar, beta: np.ndarray):
        self.grammar, self.beta = grammar, beta

    def scores(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(self.grammar.features(raw, offs)) @ self.beta, -30, 30)))


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task that hold each beginning or word, by label and fold."""
    seen: Counter = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        keys = list(seen)
        for i in range(0, len(keys), 25_000):
            some = keys[i:i + 25_000]
            yield pa.record_batch([pa.array([k[0] for k in some]), pa.array([k[1] for k in some], pa.int32()),
                                   pa.array([k[2] for k in some], pa.int32()), pa.array([seen[k] for k in some], pa.int64())],
                                  ["pattern", "toxic", "fold", "n"])
        seen.clear()

    for batch in batches:
        for text, toxic, fold in zip(*(c.to_pylist() for c in batch.columns)):
            own = set()
            for w in set(_WORD.findall((text or "").lower())):
                own.update(w[:k] for k in LENGTHS if len(w) >= k)
                own.add(w + " ")
            seen.update((p, toxic, fold) for p in own)
            if len(seen) > 100_000:
                yield from out()
    yield from out()


def _weights(rows: list, totals: dict, leave: int | None) -> dict[str, float]:
    """Patterns that tell toxic documents, with their log likelihood ratios; ``leave``: the fold left out."""
    nt = sum(n for (toxic, fold), n in totals.items() if toxic and fold != leave)
    nc = sum(n for (toxic, fold), n in totals.items() if not toxic and fold != leave)
    found = []
    for pattern, counts in rows:
        t = sum(n for (toxic, fold), n in counts.items() if toxic and fold != leave)
        c = sum(n for (toxic, fold), n in counts.items() if not toxic and fold != leave)
        ratio = (t + 0.5) / (nt + 1) / ((c + 0.5) / (nc + 1))
        if t < 3 or ratio < MIN_RATIO:
            continue
        share = (t + c) / (nt + nc)
        evidence = 2 * (t * math.log(t / (nt * share)) + (c * math.log(c / (nc * share)) if c else 0))
        if evidence >= MIN_EVIDENCE:
            found.append((-evidence, pattern, min(6.0, math.log(ratio))))
    return {p: w for _, p, w in sorted(found)[:MAX_PATTERNS]}


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn the pattern weights and the model from the labelled rows that may be used."""
    spark = docs.sparkSession
    usable = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    n = usable.count()
    spread = F.pmod(F.xxhash64("_id"), F.lit(1_000_003))
    chosen = usable.filter(spread < int(1_000_003 * min(1.0, max_labelled / max(1, n)))) if n > max_labelled else usable
    fold = F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold")
    sample = cut(docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
                 .join(F.broadcast(chosen), "_id").select("text", "toxic", fold), "labelled")   # about max_labelled rows of ids
    totals = {(r.toxic, r.fold): r.n for r in sample.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_all = sum(v for k, v in totals.items() if k[0]), sum(totals.values())
    if not n_toxic or n_toxic == n_all:
        base = (n_toxic + 0.5) / (n_all + 20)
        return Model(Grammar({}), np.array([math.log(base / (1 - base)), 0, 0, 0, 0]))

    counts = sample.mapInArrow(lean(_patterns), "pattern string, toxic int, fold int, n long").groupBy("pattern", "toxic", "fold").agg(F.sum("n").alias("n"))
    wide = counts.groupBy("pattern").agg(
        *[F.sum(F.when((F.col("toxic") == t) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"n_{t}_{f}") for t in (0, 1) for f in range(FOLDS)])
    t_all, c_all = (sum((F.col(f"n_{t}_{f}") for f in range(FOLDS)), F.lit(0)) for t in (1, 0))
    # toxic documents that hold the pattern, against what its share among the clean would give
    strong = wide.filter((t_all >= 3) & (t_all * (n_all - n_toxic) >= (MIN_RATIO - 2) * (c_all + 0.5) * n_toxic)).withColumn("_t", t_all).orderBy(F.desc("_t"), "pattern").limit(4 * MAX_PATTERNS)
    rows = [(r["pattern"], {(t, f): r[f"n_{t}_{f}"] for t in (0, 1) for f in range(FOLDS)}) for r in strong.collect()]

    shared = spark.sparkContext.broadcast([_weights(rows, totals, f) for f in range(FOLDS)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammars = [Grammar(w) for w in shared.value]
        for some, raw, offs in by_bytes(batches):
            folds = np.asarray(some.column(2))
            out = np.zeros((some.num_rows, 4))
            for f, g in enumerate(grammars):
                own = np.flatnonzero(folds == f)
                if len(own):
                    size = np.diff(offs)[own]
                    data = np.concatenate([raw[offs[i]:offs[i + 1]] for i in own])
                    out[own] = g.features(data, np.concatenate(([0], np.cumsum(size))))
            yield pa.record_batch([some.column(1), *(pa.array(x) for x in out.T)], ["toxic", "a", "b", "c", "d"])

    # four numbers for each of the about max_labelled rows
    table = sample.mapInArrow(lean(read), "toxic int, a double, b double, c double, d double").toArrow()
    order = np.lexsort([np.asarray(table.column(i)) for i in range(5)])
    y = np.asarray(table.column(0)).astype(float)[order]
    x = _design(np.stack([np.asarray(table.column(i)) for i in range(1, 5)], axis=1)[order])
    return Model(Grammar(_weights(rows, totals, None)), _logistic(x, y))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(beta)), x.T @ (y - p) - penalty * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def judge(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row and its score ``_score``."""
    spark = docs.sparkSession
    weights = {}
    for word in model.grammar.machine:
        weights[word] = model.grammar.machine.get(word)
    shared = spark.sparkContext.broadcast(({k[1:]: w for k, (_, w) in weights.items() if w > 0}, model.beta))
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, beta = shared.value
        own = Model(Grammar(w), beta)
        for some, raw, offs in by_bytes(batches):
            yield pa.record_batch([some.column(i) for i in range(len(keep))] + [pa.array(own.scores(raw, offs))], [*keep, "_score"])

    read = docs.select(*[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(keep)], "text")
    return read.mapInArrow(lean(run), ", ".join([f"`{c}` {fields[c]}" for c in keep] + ["_score double"]))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    return judge(docs, fit(docs, labels), ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"))


def filter_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    plain, back = apart(docs, ("text",))
    return back(judge(plain, model, plain.columns).filter(F.col("_score") < threshold))
