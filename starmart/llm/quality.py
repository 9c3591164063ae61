"""Quality rules: base counts and Jensen-Shannon distance to language references.

Two passes over the texts, no shuffle of texts.  The first sums, for each
language, a histogram of character classes and one of words (lower-cased, hashed into ``WORD_BINS`` bins); the ``COMMON``
largest bins of a language are its common words.  Both sums are exact and
come from every document.  The second pass compares each document with the
reference of its language: a distance above its limit rejects the document,
unless the document is too short for that histogram to mean anything.

Defined results: a null text has no words; a null language is a group of its
own; a language without any text has an empty reference; every row gives one
row, repeated ids too; columns other than ``doc_id, text, lang`` are passed on
by ``filter_documents`` and ignored elsewhere.

Every language has its own reference.  Those of the ``MAX_LANGUAGES`` largest
reach the tasks at once; those of the others are joined to their documents by
language, by broadcast up to ``MAX_BROADCAST`` languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import LOWER, apart, by_bytes, cut, lean, mix, span_hashes, words

WORD_BINS = 1 << 14
COMMON = 64
#: Languages whose references are held by the driver and every task, and languages beyond them that are joined by broadcast.
MAX_LANGUAGES = 256
MAX_BROADCAST = 5_000
#: Limits of the two distances (0 to 1) and the guards below which they aren't applied.
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.48
MIN_CHARS = 200
MIN_WORDS = 50

#: Character classes: a-z, A-Z, digits, blanks, line ends, marks of prose, other ASCII, beyond ASCII.
CLASSES = 8
_CLASS = np.full(256, 6, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 3, 4
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 5
_CLASS[128:] = 7
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_FIRST = np.ones(256, dtype=bool)          # bytes that begin a code point
_FIRST[0x80:0xC0] = False

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
REFERENCE = "lang string, kind int, bin int, n long"


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[offs[1:]] - total[offs[:-1]]


def _class_counts(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Code points of each class per document."""
    n = len(offs) - 1
    doc = np.repeat(np.arange(n), np.diff(offs))
    first = _FIRST[raw]
    return np.bincount(doc[first] * CLASSES + _CLASS[raw[first]], minlength=n * CLASSES).reshape(n, CLASSES)


def base_counts(raw: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each document of a chunk (see ``BASE``)."""
    n = len(offs) - 1
    starts, ends, doc = words(raw, offs)
    out = {"n_words": np.bincount(doc, minlength=n)}
    solid = np.zeros(len(raw) + 1, dtype=np.int8)
    solid[starts] += 1
    solid[ends] -= 1                       # words never touch unless a document ends between them
    inside = np.cumsum(solid[:-1]) > 0
    out["word_chars"] = _sums(inside & _FIRST[raw], offs)
    out["n_symbols"] = _sums(_SYMBOL[raw], offs)
    # lines with a word that equal an earlier line of the document
    breaks = np.flatnonzero(raw == 10)
    begin = np.unique(np.concatenate((offs[:-1][np.diff(offs) > 0], breaks + 1)))
    begin = begin[begin < len(raw)]
    stop = np.concatenate((begin[1:], [len(raw)])) if len(begin) else begin
    stop = np.where(raw[stop - 1] == 10, stop - 1, stop) if len(begin) else stop
    lines = np.unique(np.searchsorted(begin, starts, side="right") - 1) if len(starts) else np.zeros(0, np.int64)
    owner = np.searchsorted(offs[1:], begin[lines], side="right")
    key = mix(span_hashes(raw, begin[lines], stop[lines]) + mix(owner.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)
    # words in three-word windows found twice or more
    h = span_hashes(raw, starts, ends)
    same = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    covered = np.zeros(len(doc), dtype=bool)
    if len(same):
        k1, k2, k3 = (np.uint64(k) for k in (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
        window = mix(h[same] * k1 + h[same + 1] * k2 + h[same + 2] * k3 + mix(doc[same].astype(np.uint64) + np.uint64(1)))
        _, inverse, count = np.unique(window, return_inverse=True, return_counts=True)
        again = same[count[inverse] > 1]
        for k in range(3):
            covered[again + k] = True
    out["n_repeat_words"] = np.bincount(doc, weights=covered, minlength=n).astype(np.int64)
    return out


def _word_bins(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and document of every word."""
    starts, ends, doc = words(raw, offs)
    return (span_hashes(LOWER[raw], starts, ends) % np.uint64(WORD_BINS)).astype(np.int64), doc


def _groups(index: np.ndarray, n: int) -> list[np.ndarray]:
    """Positions of each of the values 0 to n - 1."""
    order = np.argsort(index, kind="stable")
    return np.split(order, np.searchsorted(index[order], np.arange(1, n)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, sums in held.items():
            for kind, n in enumerate(sums):
                bins = np.flatnonzero(n)
                yield pa.record_batch([pa.array([lang] * len(bins), pa.string()), pa.array(np.full(len(bins), kind, np.int32)),
                                       pa.array(bins.astype(np.int32)), pa.array(n[bins])], ["lang", "kind", "bin", "n"])
        held.clear()

    for rows, raw, offs in by_bytes(batches):
        langs = rows.column(rows.schema.get_field_index("lang")).to_pylist()
        ids = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        index = np.fromiter((ids[x] for x in langs), np.int64, len(langs))
        classes = _class_counts(raw, offs)
        bins, doc = _word_bins(raw, offs)
        docs_of, words_of = _groups(index, len(ids)), _groups(index[doc], len(ids))
        for lang, i in ids.items():
            if len(held) > 1000:
                yield from out()
            have = held.setdefault(lang, (np.zeros(CLASSES, np.int64), np.zeros(WORD_BINS, np.int64)))
            have[0][:] += classes[docs_of[i]].sum(axis=0)
            have[1][:] += np.bincount(bins[words_of[i]], minlength=WORD_BINS)
    yield from out()


@dataclass
class References:
    """Histograms by language: ``known`` of the largest ones (``names``), ``rest`` as a table (``_lang, _parts``), if there are more."""

    known: dict
    names: DataFrame
    rest: DataFrame | None
    small: bool


def _histograms(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of the classes, place of each bin among the common ones, shares of these and of the others."""
    q = np.zeros(CLASSES)
    top = sorted((b, n, total) for kind, b, n, total in parts if kind == 1)
    for kind, b, n, total in parts:
        if kind == 0:
            q[b] = n / total
    place, w = np.full(WORD_BINS, len(top), dtype=np.int64), np.zeros(len(top) + 1)
    for i, (b, n, total) in enumerate(top):
        place[b], w[i] = i, n / total
    w[-1] = max(0.0, 1.0 - w[:-1].sum())
    return q, place.astype(np.int16), w


def references(docs: DataFrame, max_languages: int = MAX_LANGUAGES, common: int = COMMON, max_broadcast: int = MAX_BROADCAST) -> References:
    """Reference histograms of every language.

    What reaches the driver is bounded: ``max_languages`` times the classes and common bins.
    """
    counted = docs.select("lang", "text").mapInArrow(lean(_count), REFERENCE)
    sums = cut(counted.groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")), "reference")
    total = Window.partitionBy("lang", "kind")
    ranked = (sums.withColumn("total", F.sum("n").over(total))
              .withColumn("rank", F.row_number().over(total.orderBy(F.desc("n"), "bin")))
              .filter((F.col("kind") == 0) | (F.col("rank") <= common)))
    every = cut(ranked.groupBy(F.col("lang").alias("_lang")).agg(F.max(F.when(F.col("kind") == 0, F.col("total"))).alias("size"),
                                                                 F.collect_list(F.struct("kind", "bin", "n", "total")).alias("_parts")), "languages")
    largest = every.orderBy(F.desc("size"), F.col("_lang").asc_nulls_first()).limit(max_languages)
    known = {r["_lang"]: _histograms(r["_parts"]) for r in largest.collect()}
    names = largest.select(F.col("_lang").alias("_name"))
    more = every.count() - len(known)
    rest = every.join(F.broadcast(names), F.col("_lang").eqNullSafe(F.col("_name")), "left_anti").select("_lang", "_parts") if more else None
    return References(known, names, rest, more <= max_broadcast)


def _with_parts(read: DataFrame, refs: References) -> DataFrame:
    """Add ``_parts``, the reference of the document's language, null for the known ones."""
    same = F.col("lang").eqNullSafe(F.col("_lang"))
    if refs.small:
        return read.join(F.broadcast(refs.rest), same, "left").drop("_lang")
    name = F.col("lang").eqNullSafe(F.col("_name"))
    # the texts of the largest languages aren't shuffled
    large = read.join(F.broadcast(refs.names), name, "left_semi").withColumn("_parts", F.lit(None).cast(refs.rest.schema["_parts"].dataType))
    other = read.join(F.broadcast(refs.names), name, "left_anti").join(refs.rest.hint("merge"), same, "left").drop("_lang")
    return large.unionByName(other)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (square root of the divergence in bits) of each row of ``p`` to ``q``."""
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=-1)
    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


def _distances(raw, offs, langs, known, parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(offs) - 1
    classes = _class_counts(raw, offs)
    bins, doc = _word_bins(raw, offs)
    chars, word = np.zeros(n), np.zeros(n)
    ids = {x: i for i, x in enumerate(dict.fromkeys(langs))}
    index = np.fromiter((ids[x] for x in langs), np.int64, n)
    docs_of, words_of = _groups(index, len(ids)), _groups(index[doc], len(ids))
    within = np.zeros(n, dtype=np.int64)
    for lang, i in ids.items():
        own, mine = docs_of[i], words_of[i]
        if lang in known:
            q, place, w = known[lang]
        else:
            found = parts[int(own[0])].as_py() if parts is not None else None
            q, place, w = _histograms([(p["kind"], p["bin"], p["n"], p["total"]) for p in found or []])
        c = classes[own].astype(float)
        chars[own] = distance(c / np.maximum(c.sum(axis=1, keepdims=True), 1), q)
        within[own] = np.arange(len(own))
        k = len(w)
        counts = np.bincount(within[doc[mine]] * k + place[bins[mine]], minlength=len(own) * k).reshape(-1, k).astype(float)
        word[own] = distance(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1), w)
    return chars, word, classes.sum(axis=1)


COLUMNS = [(b, "long") for b in BASE] + [("char_distance", "double"), ("word_distance", "double"), ("base_failed", "boolean"), ("kept", "boolean")]


def judge(docs: DataFrame, refs: References | None = None, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
          min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, keep: list[str] | None = None) -> DataFrame:
    """Add the base counts, both distances and the verdict ``kept`` to every row.

    ``keep`` names the columns passed on (default ``doc_id``).
    """
    refs = refs if refs is not None else references(docs)
    shared = docs.sparkSession.sparkContext.broadcast(refs.known)
    passed = keep if keep is not None else ["doc_id"]
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in passed] + [f"`_q_{c}` {t}" for c, t in COLUMNS])
    read = docs.select(*[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(passed)], "text", "lang")
    if refs.rest is not None:
        read = _with_parts(read, refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows, raw, offs in by_bytes(batches):
            base = base_counts(raw, offs)
            chars, word, points = _distances(raw, offs, rows.column(len(passed) + 1).to_pylist(), known,
                                             rows.column(len(passed) + 2) if rows.num_columns > len(passed) + 2 else None)
            failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
            far = ((chars > max_char) & (points >= min_chars)) | ((word > max_word) & (base["n_words"] >= min_words))
            yield pa.record_batch([rows.column(i) for i in range(len(passed))] + [pa.array(base[b].astype(np.int64)) for b in BASE]
                                  + [pa.array(x) for x in (chars, word, failed, ~failed & ~far)],
                                  [*passed, *[f"_q_{c}" for c, _ in COLUMNS]])
    return read.mapInArrow(lean(run), schema)


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, both distances, ``base_failed`` and ``kept``."""
    rows = judge(docs, **limits)
    return rows.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c, _ in COLUMNS])


def filter_documents(docs: DataFrame, **limits) -> DataFrame:
    """The documents that are kept, with all their columns."""
    plain, back = apart(docs, ("text", "lang"))
    return back(judge(plain, keep=plain.columns, **limits).filter("_q_kept"))
