"""Sector aggregates. Their order belongs to the serving functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.functions import dates, numeric, text
from orefold.operators import joins, sequence


def bar_returns(silver: DataFrame) -> DataFrame:
    """Return of each bar on the symbol's preceding bar; the first bar has none.

    The predecessor may lie on an earlier day. Needs symbol, bar_ts and close; any
    other column is carried along, plus the start of the day as ``bar_day``.
    """
    with_prev = sequence.previous_value(
        silver, "symbol", "bar_ts", "close", "prev_close", ("day",), bucket="bar_day"
    )
    return with_returns(with_prev)


def with_returns(with_prev: DataFrame) -> DataFrame:
    """``pct_change`` of bars on their ``prev_close``; bars without one go."""
    return with_prev.filter(F.col("prev_close").isNotNull()).withColumn(
        "pct_change", numeric.simple_return(F.col("close"), F.col("prev_close"))
    )


def sector_hourly_perf(silver: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean return and number of symbols per (bar_ts, sector).

    ``weights`` holds one row per ticker. A bar on a zero base has a null return, yet
    its weight and its symbol count.

    Sector and weight depend on the symbol alone, so both restrictions go below the
    lag: fewer rows are shuffled and every symbol keeps its whole history. Grouping by
    the day as well keeps the distinct count on the lag's partitioning, so only
    (bar, sector) partial results are shuffled a second time.
    """
    return perf_of_returns(bar_returns(weighted_bars(silver, weights)))


def weighted_bars(silver: DataFrame, weights: DataFrame) -> DataFrame:
    """Bars of a known sector with a weight: symbol, sector, bar_ts, close, market_cap_b."""
    bars = silver.filter(F.col("sector").isNotNull()).select(
        "symbol", "sector", "bar_ts", "close"
    )
    return joins.attach(
        bars, weights.select("ticker", "market_cap_b"), "symbol", "ticker", "inner"
    )


def perf_of_returns(returns: DataFrame) -> DataFrame:
    """Weighted bars with ``pct_change`` and ``bar_day`` to (bar_ts, sector) results."""
    return (
        returns
        .groupBy("bar_day", "bar_ts", "sector")
        .agg(
            numeric.weighted_mean(F.col("pct_change"), F.col("market_cap_b")).alias(
                "sector_pct_change"
            ),
            F.countDistinct("symbol").alias("n_tickers"),
        )
        .drop("bar_day")
    )


def sector_buys_30d(
    silver: DataFrame, as_of: str | dt.date | None = None, days: int = 30
) -> DataFrame:
    """Buys per sector, unknown sectors under ``Other``.

    Only the two ``30d`` columns look at the trailing window, one by report date and
    one by trade date. The count, the total, the average lag and the late filings
    cover the whole history.
    """
    size = F.col("est_trade_value_usd")
    return (
        silver.filter(F.col("txn_type") == "buy")
        .groupBy(text.sector_or_other(F.col("sector")).alias("sector"))
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            F.sum(size).alias("est_buy_volume_usd"),
            numeric.sum_where(
                dates.on_or_after(F.col("report_date"), days, as_of), size
            ).alias("est_buy_volume_30d_by_report"),
            numeric.sum_where(
                dates.on_or_after(F.col("trade_date"), days, as_of), size
            ).alias("est_buy_volume_30d_by_trade"),
            F.avg("disclosure_lag_days").alias("avg_disclosure_lag_days"),
            numeric.count_where(F.col("is_late_disclosure")).alias("n_late_filings"),
        )
    )
