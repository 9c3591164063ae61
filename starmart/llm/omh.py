"""Order MinHash fingerprints of documents, from DataFrame functions only.

A text's k-mers are its runs of ``KMER`` words (a shorter text is one k-mer),
each numbered by its occurrence, so repeated ones differ.  A hash sorts the
numbered k-mers; its leading bits deal them to ``SKETCHES`` sketches.  Of each
sketch the ``2`` smallest are kept, put in the order they have in the text,
and hashed as a tuple.  Moving, inserting or replacing words changes which
k-mers are smallest or their order, so the share of equal sketches falls with
edit distance, where plain MinHash doesn't see order at all.

All of it is array expressions over one row: hash and position share one long
(40 and 24 bits), so both sorts are of longs, and occurrence numbers come from
a search for the begin of a run in the sorted array.

Defined results: a null text is empty; texts without words have an empty
fingerprint; two empty fingerprints are alike (1), an empty and another one
are not (0); rows that repeat an id stand in the order of their text; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KMER = 3
#: log2 of the number of sketches.
SKETCH_BITS = 6
_SPACES = r"[\x20\x09-\x0D]+"
_PLACE = 24
_LOW = (1 << _PLACE) - 1


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _pack(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~_LOW)).bitwiseOR(F.least(place.cast("long"), F.lit(_LOW)))


def _top(x: Column) -> Column:
    return F.shiftright(x, _PLACE)


def _kmers(h: Column, k: int) -> Column:
    """Hash and position of every k-mer of a list of word hashes."""
    n = F.size(h)
    own = F.transform(F.slice(h, F.lit(1), F.greatest(n - (k - 1), F.lit(0))),
                      lambda x, i: _pack(F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]), i))
    return F.when(n >= k, own).when(n > 0, F.array(_pack(F.xxhash64(h), F.lit(0)))).otherwise(F.expr("cast(array() as array<bigint>)"))


def _numbered(s: Column) -> Column:
    """The sorted k-mers with later occurrences hashed anew with their number."""
    steps = F.array(*[F.lit(1 << j) for j in reversed(range(_PLACE))])

    def earlier(x: Column, j: Column) -> Column:
        # how many equal k-mers stand before: a binary search in the sorted array
        return F.aggregate(steps, F.lit(0), lambda o, step: F.when(_top(F.get(s, j - o - step)) == _top(x), o + step).otherwise(o))

    return F.transform(s, lambda x, j: F.when(_top(F.get(s, j - 1)) == _top(x), _pack(F.xxhash64(_top(x), earlier(x, j)), x.bitwiseAND(F.lit(_LOW)))).otherwise(x))


def order_minhash(text: Column, k: int = KMER, bits: int = SKETCH_BITS) -> Column:
    """The fingerprint: for each sketch that has k-mers, its number and 24 bits of its tuple's hash, as one int."""
    sketch = lambda x: F.shiftrightunsigned(x, 64 - bits)

    def entry(c: Column, x: Column, i: Column) -> Column:
        other = F.get(c, i + 1)
        place = lambda y: y.bitwiseAND(F.lit(_LOW))
        pair = F.when(place(x) < place(other), F.xxhash64(_top(x), _top(other))).otherwise(F.xxhash64(_top(other), _top(x)))
        value = F.when(sketch(other) == sketch(x), pair).otherwise(F.xxhash64(_top(x)))
        first = F.coalesce(sketch(F.get(c, i - 1)) != sketch(x), F.lit(True))
        return F.when(first, F.shiftleft(sketch(x), _PLACE).bitwiseOR(value.bitwiseAND(F.lit(_LOW))).cast("int"))

    words = F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES), lambda w: w != "")
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h:
                _let(F.sort_array(_kmers(h, k)), lambda s:
                     _let(F.sort_array(_numbered(s)), lambda t:
                          _let(F.filter(t, lambda x, i: F.coalesce(sketch(F.get(t, i - 2)) != sketch(x), F.lit(True))), lambda c:
                               F.filter(F.transform(c, lambda x, i: entry(c, x, i)), lambda e: e.isNotNull())))))


def fingerprint_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda e: F.lpad(F.lower(F.hex(e)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches among those that either fingerprint has."""
    number = lambda x: F.transform(x, lambda e: F.shiftright(e, _PLACE))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) / F.size(F.array_union(number(a), number(b)))).cast("double")


def with_next(docs: DataFrame, carried: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """Add ``next_<c>`` for each of ``columns``: their values in the following document by id; the last takes the first's.

    ``docs`` has ``doc_id`` and ``text``; ``carried`` adds further columns before the
    texts are dealt to ranges of ids.  A range ends with a copy of the first
    document of the next one, so texts are shuffled once.
    """
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 50 * n)).first()[0] or []     # n numbers
    bounds = sorted(set(cuts))
    edges = F.array(*[F.lit(x).cast("long") for x in bounds]) if bounds else F.expr("cast(array() as array<bigint>)")
    steps = F.array(*[F.lit(1 << j) for j in reversed(range(max(1, len(bounds).bit_length())))])
    bucket = F.aggregate(steps, F.lit(0), lambda o, step: F.when(F.get(edges, o + step - 1) < F.col("doc_id"), o + step).otherwise(o))
    rows = docs.withColumn("_range", bucket)
    # the first id of each range, and the range that it ends: the one before it, the first ends the last
    firsts = rows.groupBy("_range").agg(F.min("doc_id").alias("_id"), F.max(F.col("doc_id").isNull()).alias("_null"))
    firsts = firsts.withColumn("_id", F.when(~F.col("_null"), F.col("_id"))).select("_range", "_id")
    order = Window.orderBy("_range")
    before = firsts.select("_id", F.coalesce(F.lag("_range").over(order), F.max("_range").over(Window.partitionBy())).alias("_ends"))
    ends = (docs.join(F.broadcast(before), F.col("doc_id").eqNullSafe(F.col("_id"))).groupBy("_ends", "doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
            .select("doc_id", "text", F.col("_ends").alias("_range")))               # one row per range
    both = carried(rows.withColumn("_end", F.lit(0)).unionByName(ends.withColumn("_end", F.lit(1))))
    follow = Window.partitionBy("_range").orderBy("_end", "doc_id", "text")
    return (both.select("*", *[F.lead(c).over(follow).alias(f"next_{c}") for c in columns]).filter("_end = 0").drop("_end", "_range"))


def fingerprint_documents(docs: DataFrame, k: int = KMER, bits: int = SKETCH_BITS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike it is to that and to the next document.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced
    by the first as many of the next document.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(texts, lambda d: d.withColumn("fp", order_minhash(F.col("text"), k, bits)), ["text", "fp"])
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(length(text) div 2 as int))"), F.expr("substring(next_text, 1, cast(length(text) div 2 as int))"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    rows = rows.withColumn("edited_fp", order_minhash(F.col("edited"), k, bits))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint_text(F.col("fp")).alias("fingerprint"),
                       fingerprint_text(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
