"""Data tests from touched days equal those on the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from builders import bar, dim, price_doc, random_price_docs, rows, trade, trades
from orefold import schemas
from orefold.operators import quality
from orefold.sources import bronze
from orefold.streaming import check_changes, incremental

PRICES = (*quality.SILVER_PRICES, quality.NotNull("sector"), quality.AcceptedRange("volume", min=3), quality.Unique("bar_ts"))
TRADES = (*quality.SILVER_TRADES, quality.NotNull("sector"), quality.Unique("ticker", "trade_date"))


def land(raw, path):
    raw.withColumn(bronze.PARTITION, F.to_date("extracted_at")).coalesce(1).write.mode("append").partitionBy(
        bronze.PARTITION
    ).parquet(path)


def test_prices_after_each_batch(spark, tmp_path):
    path, root, sectors = f"{tmp_path}/bronze", f"{tmp_path}/store", dim(spark, ("A", "a", "Tech"), ("B", "b", None))
    docs = random_price_docs(3, 20)
    random.Random(3).shuffle(docs)
    for part in (docs[:10], docs[10:]):
        land(spark.createDataFrame([price_doc(*d) for d in part], schemas.RAW_PRICES), path)
        incremental.advance_prices(spark, path, root)
        check_changes.advance_checks(spark, root, "bars", sectors, PRICES)
        want = quality.report(incremental.read_prices(spark, root, sectors), PRICES)
        assert rows(check_changes.verdict(spark, root, "bars", PRICES)) == rows(want)
    assert check_changes.advance_checks(spark, root, "bars", sectors, PRICES) == {"changed": 0}
    # another test counts every day again
    more = (*PRICES, quality.NotNull("company_name"))
    assert check_changes.advance_checks(spark, root, "bars", sectors, more)["changed"] > 1
    # one bar changes: one day is read
    late = [("A", "2026-04-25T10:00:00+00:00", [bar("2026-04-02T09:30:00-04:00", 1.0, 1)])]
    land(spark.createDataFrame([price_doc(*d) for d in late], schemas.RAW_PRICES), path)
    incremental.advance_prices(spark, path, root)
    assert check_changes.advance_checks(spark, root, "bars", sectors, more) == {"changed": 1}
    want = quality.report(incremental.read_prices(spark, root, sectors), more)
    assert rows(check_changes.verdict(spark, root, "bars", more)) == rows(want)
    with pytest.raises(quality.DataQualityError, match="accepted_range"):
        check_changes.gate(spark, root, "bars", (quality.AcceptedRange("volume", min=3),))


def test_trades_and_refused_tests(spark, tmp_path):
    path, root, sectors = f"{tmp_path}/bronze", f"{tmp_path}/store", dim(spark)
    at = "2026-04-22T10:00:00+00:00"
    records = [trade(politician=p, ticker=t, filed_after_days=n) for p, t, n in (("P", "AAA", 1), ("Q", "AAA", -2), ("Q", "ZZZ", 3))]
    land(trades(spark, (at, records + [trade(trade_date_raw="3 May 2026")])), path)
    incremental.advance_trades(spark, path, root)
    assert check_changes.advance_checks(spark, root, "trades", sectors, TRADES) == {"changed": 2}
    want = quality.report(incremental.read_trades(spark, root, sectors), TRADES)
    got = check_changes.verdict(spark, root, "trades", TRADES)
    assert rows(got) == rows(want) and got.where("failures > 0").count() == 3
    with pytest.raises(ValueError):
        check_changes.advance_checks(spark, root, "trades", sectors, (quality.Unique("member"),))
    check_changes.gate(spark, root, "trades", quality.SILVER_TRADES[:2])


def test_nothing_yet(spark, tmp_path):
    root = str(tmp_path / "none")
    assert check_changes.advance_checks(spark, root, "bars", dim(spark), PRICES) == {"changed": 0}
    assert {r.failures for r in check_changes.verdict(spark, root, "bars", PRICES).collect()} == {0}
