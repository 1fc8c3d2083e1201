"""The whole rebuild: silver, gold, their data tests, and the published views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.operators import joins, quality
from orefold.plans import gold, silver
from orefold.sources import tables


def build_all(
    spark: SparkSession,
    raw_prices: DataFrame,
    raw_trades: DataFrame,
    dim: DataFrame,
    weights: DataFrame,
    root: str,
    run_id: str,
    as_of: str | dt.date | None = None,
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Rebuild every table from bronze; the first failing data test stops the run.

    Each table is written once, tested as written, and published only then. The next
    layer reads the written files, so nothing is computed twice and a lost executor costs
    its own tasks only. The dimension's and
    the weights' keys are tested before they are joined: a repeated key would multiply
    facts.
    """
    quality.gate(dim, quality.DIM_SECTORS, "dim_sectors")
    quality.gate(weights, (quality.Unique("ticker"),), "weights")
    dim = joins.size_checked(dim, key="ticker")
    weights = joins.size_checked(weights, key="ticker")
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def publish(df: DataFrame, name: str, checks, by: tuple[str, ...] = ()) -> DataFrame:
        path = tables.run_path(root, name, run_id)
        quality.gate(tables.write_run(df, path, by), checks, name)
        return tables.publish(spark, prefix + name, path, df.schema)

    prices = publish(
        silver.silver_stock_prices(raw_prices, dim).withColumn("bar_date", F.to_date("bar_ts")),
        "silver_stock_prices",
        quality.SILVER_PRICES,
        ("bar_date",),
    )
    trades = publish(
        # few trades a day: a folder for each would be thousands of tiny files, so files are
        # sorted by day instead, and date filters skip their pages
        silver.silver_congress_trades(raw_trades, dim)
        .hint("rebalance").sortWithinPartitions("trade_date"),
        "silver_congress_trades",
        quality.SILVER_TRADES,
    )
    perf = publish(
        gold.sector_hourly_perf(prices, weights),
        "gold_sector_hourly_perf",
        quality.SECTOR_HOURLY_PERF,
    )
    buys = publish(
        gold.sector_buys_30d(trades, as_of),
        "gold_sector_congress_buys_30d",
        quality.SECTOR_BUYS_30D,
    )
    return {
        "silver_stock_prices": prices,
        "silver_congress_trades": trades,
        "gold_sector_hourly_perf": perf,
        "gold_sector_congress_buys_30d": buys,
    }
