"""Gold made again for the days that a change can reach equals the full build."""

import random

import pytest
from pyspark.sql import functions as F

from builders import bar, dim, price_doc, random_price_docs, rows, weights
from orefold import schemas
from orefold.plans import gold, silver
from orefold.sources import bronze
from orefold.streaming import gold_changes, incremental

SECTORS = (("A", "a", "Tech"), ("B", "b", "Tech"), ("C", "c", "Energy"), ("D", "d", "Energy"))


def land(spark, docs, path):
    raw = spark.createDataFrame([price_doc(*d) for d in docs], schemas.RAW_PRICES)
    raw.withColumn(bronze.PARTITION, F.to_date("extracted_at")).coalesce(1).write.mode("append").partitionBy(
        bronze.PARTITION
    ).parquet(path)


def rounded(df):
    return rows(df.select("bar_ts", "sector", F.round("sector_pct_change", 9), "n_tickers"))


class Store:
    def __init__(self, spark, tmp_path, sectors=SECTORS, **caps):
        self.spark, self.bronze, self.root = spark, f"{tmp_path}/bronze", f"{tmp_path}/store"
        self.dim, self.caps = dim(spark, *sectors), weights(spark, **(caps or {"A": 3, "B": 1, "C": 2, "E": 5}))

    def take(self, docs):
        land(self.spark, docs, self.bronze)
        incremental.advance_prices(self.spark, self.bronze, self.root)
        return gold_changes.advance_gold(self.spark, self.root, self.dim, self.caps)

    def check(self):
        raw = bronze.read_raw_prices(self.spark, self.bronze)
        full = gold.sector_hourly_perf(silver.silver_stock_prices(raw, self.dim), self.caps)
        assert rounded(gold_changes.read_gold(self.spark, self.root)) == rounded(full)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_full_build_in_any_order(spark, tmp_path, seed):
    store, docs = Store(spark, tmp_path), random_price_docs(seed, 36)
    random.Random(seed).shuffle(docs)
    for i in range(0, 36, 12):
        store.take(docs[i : i + 12])
        store.check()


def days(symbol, at, closes):
    return (symbol, at, [bar(f"2026-04-{d:02d}T{h:02d}:30:00-04:00", c) for d, h, c in closes])


def test_only_reached_days_are_made(spark, tmp_path):
    store = Store(spark, tmp_path)
    first = "2026-04-25T10:00:00+00:00"
    every = [(d, h, float(d + h)) for d in range(1, 21) for h in (9, 15)]
    store.take([days(s, first, every) for s in "ABC"])
    # a bar in the middle of day 5 changes: its own day alone
    got = store.take([days("A", "2026-04-25T11:00:00+00:00", [(5, 9, 99.0)])])
    assert got == {"changed": 1, "made": 1, "moved": 0}
    store.check()
    # the last close of day 5: the next day with a bar as well
    got = store.take([days("A", "2026-04-25T12:00:00+00:00", [(5, 15, 98.0)])])
    assert got == {"changed": 1, "made": 2, "moved": 1}
    store.check()
    # a late day between, in another symbol's gap
    got = store.take([days("B", "2026-04-25T13:00:00+00:00", [(20, 16, 1.0)])])
    assert got == {"changed": 1, "made": 1, "moved": 1}
    store.check()
    # nothing new
    assert gold_changes.advance_gold(spark, store.root, store.dim, store.caps) == {"changed": 0, "made": 0, "moved": 0}


def test_a_day_that_loses_its_bars(spark, tmp_path):
    store = Store(spark, tmp_path)
    store.take([days("A", "2026-04-25T10:00:00+00:00", [(1, 9, 1.0), (2, 9, 2.0), (6, 9, 3.0), (9, 9, 4.0)])])
    store.check()
    # the only close of day 2 becomes null: day 6 follows day 1 now
    got = store.take([days("A", "2026-04-25T11:00:00+00:00", [(2, 9, None)])])
    assert got == {"changed": 1, "made": 2, "moved": 1}
    store.check()
    # and comes back
    store.take([days("A", "2026-04-25T12:00:00+00:00", [(2, 9, 5.0)])])
    store.check()


def test_new_sectors_or_weights_make_every_day(spark, tmp_path):
    store = Store(spark, tmp_path)
    store.take([days(s, "2026-04-25T10:00:00+00:00", [(1, 9, 1.0), (2, 9, 2.0), (3, 9, 4.0)]) for s in "ABCE"])
    store.dim = dim(spark, *SECTORS, ("E", "e", "Tech"))
    got = gold_changes.advance_gold(spark, store.root, store.dim, store.caps)
    assert got["changed"] == got["made"] == 3
    store.check()
    store.caps = weights(spark, A=1, E=4)
    assert gold_changes.advance_gold(spark, store.root, store.dim, store.caps)["changed"] == 3
    store.check()


def test_death_before_the_record_is_repeated(spark, tmp_path, monkeypatch):
    store = Store(spark, tmp_path)
    store.take([days("A", "2026-04-25T10:00:00+00:00", [(1, 9, 1.0), (2, 9, 2.0)])])
    before = rounded(gold_changes.read_gold(spark, store.root))
    monkeypatch.setattr(gold_changes, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.take([days("A", "2026-04-25T11:00:00+00:00", [(1, 9, 5.0), (3, 9, 2.0)])])
    assert rounded(gold_changes.read_gold(spark, store.root)) == before
    monkeypatch.undo()
    assert gold_changes.advance_gold(spark, store.root, store.dim, store.caps)["changed"] == 2
    store.check()


def test_nothing_yet(spark, tmp_path):
    store = Store(spark, tmp_path)
    assert gold_changes.advance_gold(spark, store.root, store.dim, store.caps) == {"changed": 0, "made": 0, "moved": 0}
    assert gold_changes.read_gold(spark, store.root).count() == 0
