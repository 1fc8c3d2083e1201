"""One survivor per key, by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.operators import cells


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Spark cuts each key to one row per map task before the shuffle
    (WindowGroupLimit), so a key with very many versions does not pile up.

    The hash of the key leads: sorts compare rows by the first column's eight bytes, which
    names like ``Member 1`` share, and would else compare most rows column by column."""
    hashed = cells.unused(df, "_hash")
    by_key = Window.partitionBy(hashed, *keys).orderBy(*order)
    numbered = df.withColumn(hashed, F.xxhash64(*keys)).withColumn("_rn", F.row_number().over(by_key))
    return numbered.filter(F.col("_rn") == 1).drop("_rn", hashed)


def keep_latest(
    df: DataFrame, keys: Sequence[str], version: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest ``version`` per key. Null keys form one group.

    Rows equal in ``version`` are told apart by ``tiebreak`` (default: all other
    columns), highest first, so the survivor does not depend on the input order.
    """
    rest = tiebreak or [c for c in df.columns if c != version and c not in keys]
    return _first_per_key(df, keys, [F.desc_nulls_last(c) for c in (version, *rest)])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in ascending ``order``, then by the remaining columns."""
    rest = [c for c in df.columns if c not in order and c not in keys]
    return _first_per_key(df, keys, [F.asc_nulls_last(c) for c in (*order, *rest)])


def union_keep_first(parts: Sequence[DataFrame], key: str, position: str) -> DataFrame:
    """Stack by column name; on a repeated key the earlier part wins, inside a part
    the lower ``position``."""
    stacked = None
    for priority, part in enumerate(parts):
        tagged = part.withColumn("_priority", F.lit(priority))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return keep_first(stacked, [key], ["_priority", position]).drop("_priority", position)
