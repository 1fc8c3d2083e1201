"""Maintenance of the ticker -> sector list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.functions import dates, text
from orefold.operators import dedup, joins


def recent_unknown_tickers(
    silver: DataFrame, dim: DataFrame, as_of: str | dt.date | None = None, days: int = 90
) -> DataFrame:
    """Tickers traded in the trailing window that the dimension does not hold, sorted."""
    traded = silver.filter(
        dates.on_or_after(F.col("trade_date"), days, as_of) & text.has_ticker(F.col("ticker"))
    )
    # distinct first: every ticker meets the dimension once
    unknown = joins.keys_missing_from(
        traded.select("ticker").distinct(), dim, "ticker", "ticker"
    )
    return unknown.orderBy(F.asc_nulls_last("ticker"))


def listed(base: DataFrame) -> DataFrame:
    """Published list (symbol, security, gics_sector, position) to dimension rows.

    Rows whose cleaned ticker has no ticker shape are dropped.
    """
    ticker = text.clean_ticker(F.col("symbol"))
    return base.select(
        ticker.alias("ticker"),
        text.commas_to_spaces(text.strip(F.col("security"))).alias("company_name"),
        text.sector_label(F.col("gics_sector")).alias("sector"),
        "position",
    ).filter(text.has_ticker_shape(F.col("ticker")))


def resolved(tickers: DataFrame, company_info: DataFrame) -> DataFrame:
    """Look up tickers in landed company data, keyed by the dashed symbol form.

    A ticker with neither sector nor name is skipped; a missing sector alone becomes
    ``Other``, a missing name alone the empty text.
    """
    info = company_info.select(
        text.share_class_symbol(F.col("ticker")).alias("vendor_symbol"),
        F.nullif(F.col("sector"), F.lit("")).alias("info_sector"),
        text.first_non_empty(F.col("longName"), F.col("shortName")).alias("info_name"),
    )
    found = tickers.withColumn(
        "vendor_symbol", text.share_class_symbol(F.col("ticker"))
    ).join(info, "vendor_symbol")
    return found.filter(F.col("info_sector").isNotNull() | F.col("info_name").isNotNull()).select(
        "ticker",
        text.commas_to_spaces(F.coalesce("info_name", F.lit(""))).alias("company_name"),
        text.sector_or_other(text.sector_label(F.col("info_sector"))).alias("sector"),
    )


def build_sector_dim(
    base: DataFrame,
    silver: DataFrame | None = None,
    company_info: DataFrame | None = None,
    as_of: str | dt.date | None = None,
    days: int = 90,
) -> DataFrame:
    """The dimension from a published list; with ``silver`` and ``company_info`` also
    the traded tickers the list lacks. On a repeated ticker the list wins, and inside
    the list the lowest ``position``."""
    own = dedup.keep_first(listed(base), ["ticker"], ["position"])
    parts = [own]
    if silver is not None and company_info is not None:
        unknown = recent_unknown_tickers(silver, own, as_of, days)
        extra = resolved(unknown, company_info)
        parts.append(extra.withColumn("position", F.lit(None).cast(own.schema["position"].dataType)))
    combined = dedup.union_keep_first(parts, "ticker", "position")
    return combined.select("ticker", "company_name", "sector").orderBy(
        F.asc_nulls_last("ticker")
    )


def sector_counts(dim: DataFrame) -> DataFrame:
    """Tickers per sector, most first."""
    return (
        dim.groupBy("sector")
        .agg(F.count(F.lit(1)).alias("n_tickers"))
        .orderBy(F.desc("n_tickers"), F.asc_nulls_last("sector"))
    )
