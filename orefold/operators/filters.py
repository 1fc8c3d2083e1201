"""Row filters driven by report parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def selected(df: DataFrame, column: str, choice: Sequence[str] | None) -> DataFrame:
    """Rows whose value is among ``choice``; ``None`` is everything, ``[]`` nothing."""
    if choice is None:
        return df
    if not choice:
        return df.filter(F.lit(False))
    return df.filter(F.col(column).isin(*choice))


def at_least(df: DataFrame, column: str, minimum: int) -> DataFrame:
    """Unknown sizes count as 0, so they pass only when the minimum is 0."""
    return df.filter(F.coalesce(F.col(column), F.lit(0)) >= minimum)
