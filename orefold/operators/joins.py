"""Joins to reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


class RepeatedKeyError(Exception):
    """A reference table has a key twice; joining it would multiply facts."""


def measured_size(df: DataFrame, key: str | None = None) -> tuple[int, int, int]:
    """(rows, bytes, rows with a key seen before) of a DataFrame by one aggregate: text by
    length, the rest by width. Without ``key`` the last figure is 0; null keys never join
    and do not count."""
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = 16 * len(df.columns)
    text_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0))
    again = F.count(key) - F.countDistinct(key) if key else F.lit(0)
    return tuple(
        df.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(text_bytes + F.lit(width)), F.lit(0)), again
        ).first()
    )


def size_checked(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    key: str | None = None,
) -> DataFrame:
    """Mark reference data for broadcast if, and only if, it was measured to be small.

    With ``key``, the same pass checks that the key is unique and raises if not.

    Larger data is returned unmarked: the join then shuffles both sides, and adaptive
    execution splits the fact side's hot keys.
    """
    rows, nbytes, again = measured_size(df, key)
    if again:
        raise RepeatedKeyError(f"{key} repeats in {again} rows")
    return F.broadcast(df) if rows <= max_rows and nbytes <= max_bytes else df


def attach(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left"
) -> DataFrame:
    """Equi-join that keeps the fact's key column. ``dim_key`` must be unique, which
    ``size_checked(dim, key=dim_key)`` tests."""
    return fact.join(dim.withColumnRenamed(dim_key, fact_key), fact_key, how)


def attach_large(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "left", hot_share: float = 0.001
) -> DataFrame:
    """As ``attach``, for reference data that is too large to broadcast, whatever the share of
    rows that a few keys have.

    Keys with more than ``hot_share`` of the facts (so at most ``1 / hot_share`` of them) are
    counted first. Their reference rows are few, and are broadcast to the facts of these keys,
    which are not shuffled; all other facts meet the reference data by a shuffle in which no
    key is large. Null keys match nothing, and stay where they are too. ``fact`` is read more
    than once: a written table. ``dim_key`` must be unique.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    counts = fact.where(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("n_rows"))
    total = fact.count()
    hot = [r[0] for r in counts.where(F.col("n_rows") > hot_share * total).select(fact_key).collect()]
    side = dim.withColumnRenamed(dim_key, fact_key)
    is_hot = F.col(fact_key).isin(hot) if hot else F.lit(False)
    rest = fact.where(F.col(fact_key).isNotNull() & ~is_hot).join(side, fact_key, how)
    out = rest
    if hot:
        out = out.unionByName(fact.where(is_hot).join(F.broadcast(side.where(is_hot)), fact_key, how))
    if how == "left":
        empty = {f.name: F.lit(None).cast(f.dataType) for f in side.schema if f.name != fact_key}
        out = out.unionByName(fact.where(F.col(fact_key).isNull()).withColumns(empty).select(*out.columns))
    return out


def keys_missing_from(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Rows whose key the reference data does not hold."""
    known = dim.select(F.col(dim_key).alias(key))
    return df.join(known, key, "left_anti")


def keys_found_in(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Rows whose key the reference data holds, each once."""
    known = dim.select(F.col(dim_key).alias(key))
    return df.join(known, key, "left_semi")
