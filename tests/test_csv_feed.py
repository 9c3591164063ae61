"""The CSV landing of csv_feed: compressed, and read back whole."""

import glob
import gzip

from starmart.plans import catalog

from conftest import SF_SMALL


def test_csv_feed_lands_gzipped(spark, tmp, monkeypatch):
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmp}/{name}")
    got = catalog.csv_feed(spark, SF_SMALL)
    files = glob.glob(f"{tmp}/csv/part-*")
    assert files and all(f.endswith(".csv.gz") for f in files)
    lines = sum(len(gzip.open(f, "rt", encoding="latin-1").read().splitlines()) - 1 for f in files)
    assert got.count() == lines == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
