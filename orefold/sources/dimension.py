"""Reference data: the sector list as CSV, weights and watchlist as values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold import fixed_values as fixed
from orefold import schemas


def read_dim_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted UTF-8 CSV with a header: ticker, company_name, sector."""
    return spark.read.schema(schemas.DIM_SECTORS).csv(
        path, header=True, quote='"', escape='"', encoding="UTF-8", enforceSchema=False
    )


def write_dim_csv(dim: DataFrame, path: str) -> None:
    """Sorted by ticker, every field quoted, ``\\n`` line ends.

    A dimension of ordinary size gives one file. A very large one gives several,
    sorted across files in file-name order, rather than passing through one task.
    """
    dim.select("ticker", "company_name", "sector").orderBy(
        F.asc_nulls_last("ticker")
    ).write.mode("overwrite").csv(
        path, header=True, quoteAll=True, escape='"', encoding="UTF-8", lineSep="\n"
    )


def weights(spark: SparkSession, caps: Mapping[str, int] | None = None) -> DataFrame:
    """(ticker, market_cap_b) from a mapping; default: the fixed watchlist weights."""
    rows = list((fixed.MARKET_CAPS if caps is None else caps).items())
    return spark.createDataFrame(rows, schemas.WEIGHTS)


def watchlist(spark: SparkSession, symbols: Iterable[str] = fixed.WATCHLIST) -> DataFrame:
    """(symbol) of the fixed universe, or of a given one."""
    return spark.createDataFrame([(s,) for s in symbols], "symbol string")
