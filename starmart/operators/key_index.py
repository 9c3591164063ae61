"""An index of landed keys: which files of a landed table may hold keys of a batch.

For each landed file it keeps the least and greatest key and a Bloom filter of
its keys, kept as bitmaps of 32,768 bits (``bitmap_construct_agg``).  Before an
anti join, the files whose range holds no key of the batch are left out, then
those of which few keys fall into the range and none passes the filter.  What
is left out can't hold a key of the batch; what is opened in vain costs time
only.  Keys are whole numbers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import written

#: Bits of a filter per key, and hashes of a key: one in 160 keys that a file lacks passes.
BITS_PER_KEY, HASHES = 16, 3
BITMAP_BITS = 32_768
#: Files of which more batch keys than this fall into the range are opened without a look at the filter.
PROBES = 2_000
#: Files whose ranges are held by every task (24 bytes each); beyond it all files with rows in the batch's range are opened.
MAX_FILES = 200_000


def _place(key: Column, buckets: Column, n: int) -> Column:
    """The bit of a key's n-th hash in a filter of ``buckets`` bitmaps."""
    return F.pmod(F.xxhash64(key, F.lit(n)), buckets * BITMAP_BITS)


def _name(file: str) -> str:
    """A file's name whichever way Spark spells it: slashes after the scheme, escapes."""
    return re.sub(r"^([\w+.-]+:)/+", r"\1/", unquote(file))


@dataclass
class KeyIndex:
    """Ranges and filters of landed files, as Parquet under ``base``."""
    base: str
    key: str

    def _read(self, spark: SparkSession, name: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.base}/{name}")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def add(self, landed: DataFrame) -> None:
        """Index the files of ``landed``, which reads them as they lie; files that are known are left as they are."""
        spark = landed.sparkSession
        rows = landed.select(F.col("_metadata.file_path").alias("file"), F.col(f"`{self.key}`").cast("long").alias("key"))
        known = self._read(spark, "files")
        if known is not None:
            rows = rows.join(known.select("file"), "file", "left_anti")
        rows = rows.where("key IS NOT NULL")
        files = written(rows.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"))
                        .withColumn("buckets", F.ceil(F.col("n") * BITS_PER_KEY / BITMAP_BITS)))
        # a row a file
        places = rows.join(files.select("file", "buckets"), "file").select("file", F.explode(F.array(*[_place(F.col("key"), F.col("buckets"), n) for n in range(HASHES)])).alias("p"))
        bits = places.groupBy("file", F.expr(f"p div {BITMAP_BITS}").alias("bucket")).agg(F.bitmap_construct_agg(F.col("p") % BITMAP_BITS).alias("bits"))
        # filters first: a file without an entry is always opened
        bits.write.mode("append").parquet(f"{self.base}/bits")
        files.write.mode("append").parquet(f"{self.base}/files")

    def candidates(self, batch: DataFrame, of: list[str]) -> list[str]:
        """Those of the files ``of`` that may hold a key of the batch."""
        spark = batch.sparkSession
        files = self._read(spark, "files")
        if files is None:
            return of
        listed = {_name(f): f for f in of}
        keys = written(batch.select(F.col(f"`{self.key}`").cast("long").alias("key")).where("key IS NOT NULL").distinct())
        low, high = keys.agg(F.min("key"), F.max("key")).first()
        unknown = set(listed) - {_name(r["file"]) for r in files.select("file").collect()}            # names of files
        if low is None:
            return sorted(listed[f] for f in unknown)
        near = files.where((F.col("high") >= low) & (F.col("low") <= high)).orderBy("file").limit(MAX_FILES + 1).toPandas()
        if len(near) > MAX_FILES:
            return of
        lows, highs = near["low"].to_numpy(), near["high"].to_numpy()

        def count(batches):
            total = np.zeros(len(lows), np.int64)
            for pdf in batches:
                k = np.sort(pdf["key"].to_numpy())
                total += np.searchsorted(k, highs, side="right") - np.searchsorted(k, lows, side="left")
            hit = np.flatnonzero(total)
            yield pd.DataFrame({"no": hit, "keys": total[hit]})
        hits = {r["no"]: r["keys"] for r in keys.mapInPandas(count, "no long, keys long").groupBy("no").agg(F.sum("keys").alias("keys")).collect()}       # a row a file
        opened = {near["file"][no] for no, n in hits.items() if n > PROBES}
        probed = np.array(sorted(no for no, n in hits.items() if n <= PROBES), np.int64)
        if len(probed):
            def pairs(batches):
                for pdf in batches:
                    k = np.sort(pdf["key"].to_numpy())
                    a, b = np.searchsorted(k, lows[probed], side="left"), np.searchsorted(k, highs[probed], side="right")
                    at = np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist())]) if len(a) else a
                    yield pd.DataFrame({"no": np.repeat(probed, b - a), "key": k[at]})
            numbers = spark.createDataFrame(near.loc[probed, ["file", "buckets"]].assign(no=probed))
            tried = keys.mapInPandas(pairs, "no long, key long").join(F.broadcast(numbers), "no")            # a row a file
            tried = tried.select("file", "key", F.posexplode(F.array(*[_place(F.col("key"), F.col("buckets"), n) for n in range(HASHES)])).alias("h", "p"))
            byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("p") % BITMAP_BITS / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            bit = F.getbit(byte, (F.col("p") % 8).cast("int")) == 1
            tried = tried.withColumn("bucket", F.expr(f"p div {BITMAP_BITS}")).join(self._read(spark, "bits"), ["file", "bucket"], "left")
            passed = tried.groupBy("file", "key").agg(F.min(F.coalesce(bit, F.lit(False))).alias("all")).where("all").select("file").distinct()
            opened |= {r["file"] for r in passed.collect()}                                  # names of files
        opened = unknown | {_name(o) for o in opened}
        return sorted(listed[f] for f in listed if f in opened)
