"""Data tests: declare checks, report on them, or stop a run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 5


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def violated(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedRange:
    """Null passes."""

    column: str
    min: float | None = None
    max: float | None = None
    inclusive: bool = True

    @property
    def name(self) -> str:
        return f"accepted_range({self.column})"

    def violated(self) -> Column:
        c = F.col(self.column)
        bad = F.lit(False)
        if self.min is not None:
            bad = bad | (c < self.min if self.inclusive else c <= self.min)
        if self.max is not None:
            bad = bad | (c > self.max if self.inclusive else c >= self.max)
        return F.coalesce(bad, F.lit(False))


@dataclass(frozen=True)
class Unique:
    """Each non-null value once; with several columns, each combination once."""

    columns: tuple[str, ...]

    def __init__(self, *columns: str):
        object.__setattr__(self, "columns", columns)

    @property
    def name(self) -> str:
        kind = "unique" if len(self.columns) == 1 else "unique_combination"
        return f"{kind}({', '.join(self.columns)})"

    def repeated(self, df: DataFrame) -> DataFrame:
        if len(self.columns) == 1:
            df = df.filter(F.col(self.columns[0]).isNotNull())
        counted = df.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("n_rows"))
        return counted.filter(F.col("n_rows") > 1)


Check = NotNull | AcceptedRange | Unique


class DataQualityError(Exception):
    """A data test failed; the message names it and shows some failing rows."""


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_name, failures) for every check.

    All row checks of a table are counted in one pass; all uniqueness checks in another,
    as grouping sets of one grouped count, which combines before its shuffle.
    """
    parts = []
    row_checks = [c for c in checks if not isinstance(c, Unique)]
    if row_checks:
        counts = df.agg(
            *[F.count(F.when(c.violated(), 1)).alias(f"c{i}") for i, c in enumerate(row_checks)]
        )
        lines = F.array(
            *[
                F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures"))
                for i, c in enumerate(row_checks)
            ]
        )
        parts.append(counts.select(F.inline(lines)))
    unique = [c for c in checks if isinstance(c, Unique)]
    if unique:
        parts.append(_repeated(df, unique))
    return reduce(DataFrame.unionByName, parts)


def _repeated(df: DataFrame, checks: Sequence[Unique]) -> DataFrame:
    """(check_name, failures) of uniqueness checks, from one read of the rows."""
    columns = sorted({c for check in checks for c in check.columns})
    keys = df.select(*columns)
    counted = keys.groupingSets([list(check.columns) for check in checks], *columns).agg(
        F.count(F.lit(1)).alias("n_rows"), F.grouping_id().alias("of")
    )
    lines = []
    for check in checks:
        # a bit for each column that is left out, the first column highest
        of = sum(1 << i for i, c in enumerate(reversed(columns)) if c not in check.columns)
        failed = (F.col("of") == of) & (F.col("n_rows") > 1)
        if len(check.columns) == 1:
            failed &= F.col(check.columns[0]).isNotNull()
        lines.append((check.name, F.count(F.when(failed, 1))))
    counts = counted.agg(*[n.alias(f"c{i}") for i, (_, n) in enumerate(lines)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("failures"))
        for i, (name, _) in enumerate(lines)
    ])))


def gate(df: DataFrame, checks: Sequence[Check], table: str = "table") -> DataFrame:
    """Return ``df`` unchanged, or raise on the first failing check."""
    failures = {r["check_name"]: r["failures"] for r in report(df, checks).toLocalIterator()}
    for check in checks:
        if failures[check.name]:
            bad = (
                check.repeated(df) if isinstance(check, Unique) else df.filter(check.violated())
            )
            sample = [r.asDict() for r in bad.limit(SAMPLE_ROWS).collect()]
            raise DataQualityError(
                f"{table}: {check.name} has {failures[check.name]} failures, e.g. {sample}"
            )
    return df


# The declared tests of every table.
SILVER_PRICES = (
    NotNull("symbol"), NotNull("bar_ts"), NotNull("close"), Unique("symbol", "bar_ts"),
)
SILVER_TRADES = (
    NotNull("ticker"), NotNull("trade_date"), AcceptedRange("disclosure_lag_days", min=0),
)
SECTOR_HOURLY_PERF = (NotNull("sector"), NotNull("bar_ts"))
SECTOR_BUYS_30D = (NotNull("sector"), Unique("sector"))
DIM_SECTORS = (
    NotNull("ticker"), Unique("ticker"), NotNull("company_name"), NotNull("sector"),
)
