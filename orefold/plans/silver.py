"""Landed JSON to tidy, deduplicated facts with their sector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold import schemas
from orefold.functions import dates, text
from orefold.operators import dedup, faults, joins, nested

BAR_KEY = ("symbol", "bar_ts")
TRADE_KEY = ("member", "ticker", "trade_date", "txn_type", "txn_value_band")


def bars(raw: DataFrame, mode: str = "strict", clock: str = "wall") -> DataFrame:
    """Every landed bar of every extraction, typed.

    ``mode`` says what a bad value does: ``strict`` fails, ``lenient`` nulls it, ``split``
    leaves out its bar alone, which ``faults.aside`` reports.
    """
    if mode == "split":
        return faults.good(faults.judged_bars(raw, clock))
    return nested.read_bars(raw, mode, clock)


def trades(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """Every landed trade that has a ticker and a date, typed.

    These filters come before the choice of the latest version. ``mode`` as in ``bars``.
    """
    if mode == "split":
        typed = faults.good(faults.judged_trades(raw))
    else:
        typed = nested.type_trades(nested.explode_trades(raw, mode))
    return with_key(typed)


def with_key(typed: DataFrame) -> DataFrame:
    """Trades that have a ticker and a date."""
    return typed.filter(text.has_ticker(F.col("ticker")) & F.col("trade_date").isNotNull())


def latest_bars(all_bars: DataFrame) -> DataFrame:
    """The latest extraction of each (symbol, bar_ts), null closes included."""
    return dedup.keep_latest(all_bars, BAR_KEY, "extracted_at")


def latest_trades(all_trades: DataFrame) -> DataFrame:
    """The latest extraction of each trade.

    Distinct trades of one member in one ticker, day, type and size band share a key
    and collapse to one.
    """
    return dedup.keep_latest(all_trades, TRADE_KEY, "extracted_at")


def describe_bars(latest: DataFrame, dim: DataFrame) -> DataFrame:
    """Add company and sector; drop bars whose latest close is null.

    The null filter comes after the choice of the latest version: a bar whose latest
    close is null disappears even if an older extraction had a value.
    """
    described = joins.attach(
        latest.filter(F.col("close").isNotNull()),
        dim.select("ticker", "company_name", "sector"),
        "symbol",
        "ticker",
    )
    return described.select(*schemas.SILVER_PRICES)


def describe_trades(latest: DataFrame, dim: DataFrame) -> DataFrame:
    """Add estimated value, report date, late flag and sector."""
    lag = F.col("disclosure_lag_days")
    valued = latest.withColumns(
        {
            "est_trade_value_usd": text.band_midpoint(F.col("txn_value_band")),
            "report_date": dates.report_date(F.col("trade_date"), lag),
            "is_late_disclosure": dates.is_late(lag),
        }
    )
    described = joins.attach(valued, dim.select("ticker", "sector"), "ticker", "ticker")
    return described.select(*schemas.SILVER_TRADES)


def silver_stock_prices(
    raw: DataFrame, dim: DataFrame, mode: str = "strict", clock: str = "wall"
) -> DataFrame:
    """Hourly bars, one row per (symbol, bar_ts), with company and sector."""
    return describe_bars(latest_bars(bars(raw, mode, clock)), dim)


def silver_congress_trades(raw: DataFrame, dim: DataFrame, mode: str = "strict") -> DataFrame:
    """Disclosed trades, one row per natural key, with sector and disclosure lag."""
    return describe_trades(latest_trades(trades(raw, mode)), dim)
