"""Data tests kept up from changes: a verdict on whole silver that reads the touched days only.

The state is a row for each day and test, with the failures of that day and the silver version
they were counted in. A run counts the days whose version is newer and writes one small file;
the newest row of each day counts. Failures of days add up to those of the table, for tests of
rows and for uniqueness whose columns hold the time that places a row in its day: rows that
share such a key share the day. Other uniqueness tests are refused. Runs may be repeated, and
days may come in any order; the verdict equals the report on the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.functions import dates
from orefold.operators import quality
from orefold.plans import silver
from orefold.streaming import incremental

STATE = "day date, source bigint, check_name string, failures bigint, run bigint"
#: For each table of the store: its rows, its day, the column that the day is taken from, and
#: what makes silver of the rows.
TABLES = {
    "bars": (incremental.BARS, "bar_date", "bar_ts", silver.describe_bars),
    "trades": (incremental.TRADES, "trade_date", "trade_date", silver.describe_trades),
}


def _state(spark: SparkSession, root: str, table: str) -> DataFrame:
    try:
        return spark.read.schema(STATE).parquet(f"{root}/_checks_{table}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE)


def failures_by_day(rows: DataFrame, day: str, time: str, checks: Sequence[quality.Check]) -> DataFrame:
    """``day, check_name, failures`` of every day that has rows."""
    parts = []
    of_rows = [c for c in checks if not isinstance(c, quality.Unique)]
    counts = [F.count(F.when(c.violated(), 1)).alias(f"c{i}") for i, c in enumerate(of_rows)]
    if of_rows:
        lines = F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures"))
            for i, c in enumerate(of_rows)
        ])
        parts.append(rows.groupBy(F.col(day).alias("day")).agg(*counts).select("day", F.inline(lines)))
    for check in checks:
        if isinstance(check, quality.Unique):
            if time not in check.columns:
                raise ValueError(f"{check.name} has rows of one key in several days")
            held = rows.where(F.col(time).isNotNull()) if len(check.columns) == 1 else rows
            keys = held.groupBy(F.col(day).alias("day"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(check.columns)])
            repeated = keys.agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                repeated.groupBy("day").agg(F.count(F.when(F.col("n") > 1, 1)).alias("failures"))
                .select("day", F.lit(check.name).alias("check_name"), "failures")
            )
    return reduce(DataFrame.unionByName, parts)


def advance_checks(
    spark: SparkSession, root: str, table: str, dim: DataFrame, checks: Sequence[quality.Check]
) -> dict[str, int]:
    """Count the days of a silver store (see ``incremental``) that are newer than the state.
    Returns how many there were."""
    schema, day, time, describe = TABLES[table]
    state = _state(spark, root, table)
    names = {c.name for c in checks}
    newest = incremental.manifest(spark, f"{root}/{table}")
    # a day is settled once all these tests have been counted in its newest version
    settled = (
        state.where(F.col("check_name").isin(list(names))).groupBy("day", "source")
        .agg(F.count_distinct("check_name").alias("n")).where(F.col("n") == len(names))
        .groupBy(F.col("day").alias("of")).agg(F.max("source").alias("source"))
    )
    joined = newest.join(settled, F.col("day").eqNullSafe(F.col("of")), "left")
    changed = joined.where(F.col("source").isNull() | (F.col("source") < F.col("version"))).select("day", "version")
    n = changed.count()
    if not n:
        return {"changed": 0}
    rows = incremental.rows_of(spark, f"{root}/{table}", schema, day, changed)
    # the table's own columns, and the day, which silver leaves out where it is derived
    described = describe(rows, dim)
    if day not in described.columns:
        described = described.withColumn(day, dates.day_bucket(F.col(time)))
    counted = failures_by_day(described, day, time, checks)
    # a day may have lost all its rows: no failures then
    every = changed.withColumn("check_name", F.explode(F.array(*[F.lit(n) for n in sorted(names)])))
    run = (state.agg(F.max("run")).first()[0] or 0) + 1
    found = counted.select(F.col("day").alias("d"), F.col("check_name").alias("c"), "failures")
    same = F.col("day").eqNullSafe(F.col("d")) & (F.col("check_name") == F.col("c"))
    every.join(found, same, "left").select(
        "day", F.col("version").alias("source"), "check_name",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"), F.lit(run).cast("bigint").alias("run"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{root}/_checks_{table}/made={run}")
    return {"changed": n}


def _names(spark: SparkSession, names: set[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in sorted(names)], "check_name string")


def verdict(spark: SparkSession, root: str, table: str, checks: Sequence[quality.Check]) -> DataFrame:
    """``check_name, failures`` as of the last run, equal to ``quality.report`` on the table."""
    latest = _state(spark, root, table).groupBy("day", "check_name").agg(F.max_by("failures", "run").alias("failures"))
    sums = latest.groupBy("check_name").agg(F.sum("failures").alias("failures"))
    return _names(spark, {c.name for c in checks}).join(sums, "check_name", "left").select(
        "check_name", F.coalesce("failures", F.lit(0)).alias("failures")
    )


def gate(spark: SparkSession, root: str, table: str, checks: Sequence[quality.Check]) -> None:
    """Raise if a test fails anywhere, naming it and the first day with failures."""
    for row in verdict(spark, root, table, checks).where("failures > 0").orderBy("check_name").limit(1).collect():
        state = _state(spark, root, table).where(F.col("check_name") == row["check_name"])
        days = state.groupBy("day").agg(F.max_by("failures", "run").alias("n")).where("n > 0")
        first = days.agg(F.min("day")).first()[0]
        raise quality.DataQualityError(f"{table}: {row['check_name']} has {row['failures']} failures, first on {first}")
