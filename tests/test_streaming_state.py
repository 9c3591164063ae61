"""Landing with recent keys in the stream's state."""

import time

import pytest

from starmart.operators import landing
from starmart.operators.key_index import KeyIndex
from starmart.streaming.landing import start_landing

SCHEMA = "`Order Item Id` long, x string"


@pytest.mark.parametrize("indexed", [False, True])
def test_repeated_files_and_restarts_land_nothing_twice_and_state_stays_bounded(spark, tmp, indexed):
    src, raw, log = f"{tmp}/in", f"{tmp}/raw", f"{tmp}/log"
    st = spark.createDataFrame([], SCHEMA).schema
    index = KeyIndex(f"{tmp}/index", "Order Item Id") if indexed else None
    held = []

    def land(name, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{src}/{name}")
        q = start_landing(spark, f"{src}/*", st, raw, log, window="1 second", index=index)
        q.awaitTermination(120)
        assert q.exception() is None
        held.append(max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]))

    for i in range(5):
        land(f"f{i}", [(100 * i + j, f"v{i}") for j in range(100)])
        time.sleep(1.2)
    land("again-old", [(j, "old") for j in range(150)])                                     # out of the state: the anti join sees them
    land("again-new", [(450 + j, "new") for j in range(60)] + [(900, "a"), (900, "b"), (None, "n"), (None, "n")])
    land("again-both", [(j, "all") for j in range(520)] + [(900, "c")])
    rows = landing.read_raw(spark, raw).collect()
    keys = [r["Order Item Id"] for r in rows]
    assert sorted(k for k in keys if k is not None) == [*range(510), *range(510, 520), 900]
    assert sum(k is None for k in keys) == 2
    assert {r["x"] for r in rows if r["Order Item Id"] is not None and r["Order Item Id"] < 500} == {f"v{i}" for i in range(5)}
    assert max(held[:5]) <= 300                                                             # two windows of files, not all
