"""Landed raw records to bronze documents, with failures kept aside."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orefold import fixed_values as fixed
from orefold.functions import dates, numeric, text
from orefold.operators import joins, nested
from orefold.sources import bronze


def normalise_bars(raw: DataFrame) -> DataFrame:
    """Bars with NaN as null and a whole-number volume, null where there is none.

    Input: symbol, ts (text), open, high, low, close, volume (doubles).
    """
    prices = [
        numeric.nan_to_null(F.col(c).cast("double")).alias(c)
        for c in ("open", "high", "low", "close")
    ]
    volume = numeric.nan_to_null(F.col("volume").cast("double")).try_cast("bigint")
    return raw.select("symbol", "ts", *prices, volume.alias("volume"))


def split_bars(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine). A bar without a symbol or a time, or with a volume that is no
    whole number (infinite, out of range), is set aside with ``reason``."""
    volume = numeric.nan_to_null(F.col("volume").cast("double"))
    reason = (
        F.when(F.col("symbol").isNull(), "no symbol")
        .when(F.col("ts").isNull(), "no time")
        .when(volume.isNotNull() & volume.try_cast("bigint").isNull(), "bad volume")
    )
    judged = raw.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def normalise_trades(raw: DataFrame) -> DataFrame:
    """Cell texts to trade records.

    Input: source, politician, party, chamber, state, issuer, ticker_raw, traded_raw,
    filed_after_raw, owner, tx_type, size, price; all text.
    """

    def cell(name: str) -> Column:
        return text.blank_to_null(F.col(name)).alias(name)

    return raw.select(
        "source",
        cell("politician"),
        cell("party"),
        cell("chamber"),
        cell("state"),
        cell("issuer"),
        text.drop_exchange(text.blank_to_null(F.col("ticker_raw"))).alias("ticker"),
        text.two_line_date(F.col("traded_raw")).alias("trade_date_raw"),
        text.first_integer(F.col("filed_after_raw")).alias("filed_after_days"),
        cell("owner"),
        text.lower_or_empty(F.col("tx_type")).alias("tx_type"),
        cell("size"),
        cell("price"),
    )


def split_cells(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine). A scraped row without a source, without any text, or whose trade
    date is given but is none, is set aside with ``reason``."""
    cells = [c for c in raw.columns if c != "source"]
    given = text.two_line_date(F.col("traded_raw"))
    reason = (
        F.when(F.col("source").isNull(), "no source")
        .when(F.coalesce(*[text.blank_to_null(F.col(c)) for c in cells]).isNull(), "empty row")
        .when(given.isNotNull() & dates.parse_display_date(given).isNull(), "no date")
    )
    judged = raw.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def within_lookback(
    trades: DataFrame, as_of: str | dt.date | None = None, days: int = fixed.LOOKBACK_DAYS
) -> DataFrame:
    """Optional filter on the display date; ingest keeps older rows unless asked."""
    traded = dates.parse_display_date(F.col("trade_date_raw"))
    return trades.filter(dates.on_or_after(traded, days, as_of))


def watched(df: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Rows of watched symbols."""
    return joins.keys_found_in(df, watchlist, "symbol", "symbol")


def without_data(watchlist: DataFrame, bars: DataFrame) -> DataFrame:
    """Watched symbols that delivered nothing, with the reason."""
    delivered = bars.select("symbol").distinct()
    missing = joins.keys_missing_from(watchlist, delivered, "symbol", "symbol")
    return missing.select("symbol", F.lit("no data").alias("reason"))


def ingest_bars(
    raw: DataFrame, watchlist: DataFrame | None = None
) -> DataFrame:
    """Raw bars to (symbol, payload) documents, ready for ``bronze.append_raw``."""
    rows = raw if watchlist is None else watched(raw, watchlist)
    return nested.nest_bars(normalise_bars(rows))


def ingest_trades(raw: DataFrame) -> DataFrame:
    """Raw cells to (source, payload) documents, ready for ``bronze.append_raw``."""
    return nested.nest_trades(normalise_trades(raw))


def land(raw: DataFrame, kind: str, path: str, quarantine: str) -> dict[str, int]:
    """Append landed payloads to bronze and broken ones, with a reason, to a folder beside.

    ``raw`` has a key, ``extracted_at`` and ``payload``; ``kind`` is ``bars`` or ``trades``.
    One bad payload stops nothing. Returns the run's figures, counted while writing:
    ``rows`` landed, ``failed`` rows set aside.
    """
    good, bad = nested.split_raw(raw, kind)
    dated = F.to_date("extracted_at")
    landed, rows = counted(good.withColumn(bronze.PARTITION, dated), "landed")
    landed.write.mode("append").partitionBy(bronze.PARTITION).parquet(path)
    aside, failed = counted(bad.withColumn(bronze.PARTITION, dated), "failed")
    aside.write.mode("append").partitionBy(bronze.PARTITION).parquet(quarantine)
    return {"rows": rows.get["rows"], "failed": failed.get["rows"]}


def land_bars(
    raw: DataFrame, path: str, quarantine: str, run_ts: str, watchlist: DataFrame | None = None
) -> dict[str, int]:
    """Raw bars to documents in bronze; bad bars, with a reason, to a folder beside.

    Returns ``rows`` (documents), ``failed`` (bars set aside) and, with a watchlist,
    ``missing`` (watched symbols without data).
    """
    good, bad = split_bars(raw)
    docs, rows = counted(ingest_bars(good, watchlist), "landed")
    bronze.append_raw(docs, path, run_ts)
    aside, failed = counted(bronze.dated(bad, run_ts), "failed")
    aside.write.mode("append").partitionBy(bronze.PARTITION).parquet(quarantine)
    out = {"rows": rows.get["rows"], "failed": failed.get["rows"]}
    if watchlist is not None:
        out["missing"] = without_data(watchlist, raw).count()
    return out


def counted(df: DataFrame, name: str = "run", **counts: Column) -> tuple[DataFrame, Observation]:
    """Attach the run summary to a DataFrame; read it from the observation after the write.

    ``rows`` is always counted; further figures are aggregates given by keyword.
    """
    summary = Observation(name)
    figures = [c.alias(label) for label, c in counts.items()]
    return df.observe(summary, F.count(F.lit(1)).alias("rows"), *figures), summary
