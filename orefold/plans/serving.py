"""Report queries. Each sort is total, so equal leading keys still spread over tasks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.functions import dates, numeric, text
from orefold.operators import filters, sequence

AsOf = str | dt.date | None
Choice = Sequence[str] | None

TRADE_COLUMNS = (
    "member", "chamber", "party", "ticker", "issuer", "sector", "txn_type", "trade_date",
    "report_date", "est_trade_value_usd", "yahoo_url",
)
LATE_COLUMNS = (
    "member", "chamber", "ticker", "sector", "trade_date", "report_date",
    "disclosure_lag_days",
)


def asc(*columns: str):
    return [F.asc_nulls_last(c) for c in columns]


def desc(*columns: str):
    return [F.desc_nulls_last(c) for c in columns]


def hourly_perf_report(gold: DataFrame) -> DataFrame:
    """``sector_hourly_perf``, latest bar first."""
    return gold.orderBy(*desc("bar_ts"), *asc("sector"))


def buys_report(gold: DataFrame) -> DataFrame:
    """``sector_buys_30d``, largest reported volume first."""
    return gold.orderBy(*desc("est_buy_volume_30d_by_report"), *asc("sector"))


def sector_daily_perf(gold: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Hourly sector returns compounded to days over the trailing window."""
    rate = F.col("sector_pct_change")
    recent = gold.filter(dates.on_or_after(F.col("bar_ts"), days, as_of))
    return (
        recent.filter(numeric.compoundable(rate))
        .groupBy(dates.day_of(F.col("bar_ts")).alias("trade_date"), "sector")
        .agg(numeric.compound(rate).alias("pct_change"))
        .orderBy(*asc("trade_date", "sector"))
    )


def stock_daily_perf(
    silver: DataFrame, as_of: AsOf = None, days: int = 30, read_days: int = 35
) -> DataFrame:
    """Last close of each day and its return on the preceding day, per symbol.

    Reads some days more than it shows, so that the first day shown has a predecessor.
    """
    recent = silver.filter(
        dates.on_or_after(F.col("bar_ts"), read_days, as_of) & F.col("sector").isNotNull()
    )
    closes = sequence.last_per_day(
        recent, ["symbol", "company_name", "sector"], "bar_ts", "close", "trade_date"
    )
    with_prev = sequence.previous_day_value(closes, "symbol", "trade_date", "close", "prev_close")
    shown = with_prev.filter(
        F.col("prev_close").isNotNull() & dates.on_or_after(F.col("trade_date"), days, as_of)
    )
    return shown.select(
        "symbol",
        "company_name",
        "sector",
        "trade_date",
        "close",
        numeric.simple_return(F.col("close"), F.col("prev_close")).alias("pct_change"),
        text.quote_url(F.col("symbol")).alias("yahoo_url"),
    ).orderBy(*desc("trade_date"), *asc("symbol"))


def trades_30d(silver: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Trades executed in the trailing window, latest first."""
    recent = silver.filter(dates.on_or_after(F.col("trade_date"), days, as_of))
    shown = recent.withColumns(
        {
            "sector": text.sector_or_other(F.col("sector")),
            "yahoo_url": text.quote_url_or_null(F.col("ticker")),
        }
    ).select(*TRADE_COLUMNS)
    return shown.orderBy(
        *desc("trade_date"), *asc(*[c for c in TRADE_COLUMNS if c != "trade_date"])
    )


def buys_30d(gold: DataFrame) -> DataFrame:
    """Reported 30-day volume in thousands. ``n_trades`` counts the whole history."""
    return gold.select(
        "sector",
        "n_trades",
        numeric.in_thousands(F.col("est_buy_volume_30d_by_report")).alias("est_buy_volume_30d_k"),
    ).orderBy(*desc("est_buy_volume_30d_k"), *asc("sector"))


def late_filings(silver: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` most recently reported late filings."""
    late = silver.filter(F.col("is_late_disclosure")).select(*LATE_COLUMNS)
    rest = [c for c in LATE_COLUMNS if c != "report_date"]
    return late.orderBy(*desc("report_date"), *asc(*rest)).limit(n)


def dashboard_totals(sector_perf: DataFrame, trades: DataFrame) -> DataFrame:
    """One row: number of sectors shown, and the window's buy volume (null if none)."""
    sectors = sector_perf.agg(F.countDistinct("sector"))
    volume = trades.filter(F.col("txn_type") == "buy").agg(F.sum("est_trade_value_usd"))
    return sector_perf.sparkSession.range(1).select(
        sectors.scalar().alias("sectors_tracked"),
        volume.scalar().alias("total_buy_volume_usd"),
    )


def sector_perf_filtered(sector_perf: DataFrame, sectors: Choice = None) -> DataFrame:
    chosen = filters.selected(sector_perf, "sector", sectors)
    return chosen.orderBy(*asc("trade_date", "sector"))


def tickers_in_sectors(stock_perf: DataFrame, sectors: Choice = None) -> DataFrame:
    chosen = filters.selected(stock_perf, "sector", sectors)
    return chosen.select("symbol", "company_name").distinct().orderBy(
        *asc("symbol", "company_name")
    )


def ticker_perf_filtered(
    stock_perf: DataFrame, sectors: Choice = None, tickers: Choice = None
) -> DataFrame:
    chosen = filters.selected(stock_perf, "sector", sectors)
    chosen = filters.selected(chosen, "symbol", tickers)
    return chosen.select(
        "symbol", "company_name", "sector", "trade_date", "close", "pct_change", "yahoo_url"
    ).orderBy(*desc("trade_date"), *asc("symbol"))


def _chosen_buys(trades: DataFrame, sectors: Choice, min_size: int) -> DataFrame:
    buys = trades.filter(F.col("txn_type") == "buy")
    return filters.at_least(
        filters.selected(buys, "sector", sectors), "est_trade_value_usd", min_size
    )


def buys_by_sector_filtered(
    trades: DataFrame, sectors: Choice = None, min_size: int = 0
) -> DataFrame:
    """Number and volume (thousands) of the window's buys per sector."""
    return (
        _chosen_buys(trades, sectors, min_size)
        .groupBy("sector")
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            numeric.in_thousands(F.sum("est_trade_value_usd")).alias("est_buy_volume_30d_k"),
        )
        .orderBy(*desc("est_buy_volume_30d_k"), *asc("sector"))
    )


def trades_filtered(
    trades: DataFrame, sectors: Choice = None, min_size: int = 0
) -> DataFrame:
    """The window's buys, largest first, unknown sizes last."""
    rest = [c for c in TRADE_COLUMNS if c not in ("est_trade_value_usd", "trade_date")]
    return _chosen_buys(trades, sectors, min_size).orderBy(
        *desc("est_trade_value_usd", "trade_date"), *asc(*rest)
    )


def pass_through(served: DataFrame) -> DataFrame:
    """A served result as it is."""
    return served.select("*")
