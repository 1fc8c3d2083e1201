"""Physical plans: pruned scans, early top-1, few shuffles, no Python workers."""

import pytest

import __spark_entry__ as contract
from builders import dim, weights
from orefold import adapters
from orefold.operators import joins
from orefold.plans import gold, serving, silver

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver as written files, as the gold layer reads it."""
    path = str(tmp_path_factory.mktemp("silver") / "prices")
    sectors = joins.size_checked(adapters.dim_sectors(spark, SF))
    silver.silver_stock_prices(adapters.raw_prices(spark, SF), sectors).write.parquet(path)
    return path


@pytest.mark.parametrize("name", ["silver_stock_prices", "silver_congress_trades", "sector_hourly_perf"])
def test_no_python_and_early_top_1(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert not any(node in text for node in PYTHON_NODES)
    assert text.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_query_uses_cross_joins(spark):
    for name in ("dashboard_totals", "build_sector_dim", "recent_unknown_tickers"):
        text = plan(contract.queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_gold_shuffles_the_facts_once(spark, stored, no_adaptive):
    caps = joins.size_checked(adapters.weights(spark, SF))
    text = plan(gold.sector_hourly_perf(spark.read.parquet(stored), caps))
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # facts by (symbol, day), once for the lag and the last closes; these by symbol, and back
    # to the facts as carried rows; the sector results
    assert sum("REPARTITION_BY_COL" in s and "Reused" not in s for s in shuffles) == 2
    assert sum("Reused" in s for s in shuffles) == 1
    assert len(shuffles) == 5
    # facts and carried rows meet without a join, and the distinct count runs on the lag's
    # partitioning: nothing but the final (bar, sector) exchange lies above
    above, _ = text.split("Union", 1)
    assert above.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_flagship_computes_silver_once(spark, no_adaptive):
    sectors = joins.size_checked(adapters.dim_sectors(spark, SF))
    prices = silver.silver_stock_prices(adapters.raw_prices(spark, SF), sectors)
    text = plan(gold.sector_hourly_perf(prices, joins.size_checked(adapters.weights(spark, SF))))
    assert text.count("Generate explode") == 1 and "ReusedExchange" in text


def test_gold_reads_four_columns(spark, stored, no_adaptive):
    text = plan(gold.sector_hourly_perf(spark.read.parquet(stored), weights(spark, U1=1)))
    schemas = [s.split("ReadSchema: ")[1] for s in text.splitlines() if "ReadSchema" in s]
    wanted = "struct<symbol:string,sector:string,bar_ts:timestamp_ntz,close:double>"
    assert any(s.startswith(wanted) for s in schemas)
    assert not any("volume" in s for s in schemas)


def test_window_filter_reaches_the_scan(spark, stored, no_adaptive):
    text = plan(serving.stock_daily_perf(spark.read.parquet(stored), "2024-02-10"))
    assert "GreaterThanOrEqual(bar_ts,2024-01-06" in text
    assert "IsNotNull(sector)" in text


def test_daily_close_combines_before_the_shuffle(spark, stored, no_adaptive):
    text = plan(serving.stock_daily_perf(spark.read.parquet(stored), "2024-02-10"))
    assert "partial_max_by" in text and "SortAggregate" not in text


def test_trade_date_filter_prunes_partitions(spark, tmp_path, no_adaptive):
    path = str(tmp_path / "trades")
    sectors = joins.size_checked(dim(spark))
    trades = silver.silver_congress_trades(adapters.raw_trades(spark, SF), sectors)
    recent = trades.filter("trade_date >= date'2001-09-01'")
    recent.write.partitionBy("trade_date").parquet(path)
    text = plan(serving.trades_30d(spark.read.parquet(path), adapters.TRADES_AS_OF))
    assert "PartitionFilters: [isnotnull(trade_date" in text
