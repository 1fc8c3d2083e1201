"""Gold kept current from changes: only the days that a change can reach are made again.

A changed bar changes its own (bar, sector) result, and that of the symbol's next bar, which
may lie in the next day that has one. Three things are kept beside the silver store of
``incremental``, in folders ``version=<run>/<day>=<date>/`` like it:

* ``closes``: the last close of each symbol and day, where a lag crosses midnight,
* ``gold``: (bar_ts, sector) results by day,
* a record for each run: the days it made, with the silver version each was made from, and a
  digest of sector list and weights. It is written last and makes the run visible.

A run finds the days whose silver version is newer than the one recorded, compares their last
closes with the kept ones, and follows only those that moved to the symbol's next day with a
close. These days and the changed ones are read and made; closes are read from the first such
day on, and one row for each symbol before it. New sectors or weights make every day again.
The outcome equals a full rebuild, in whatever order bronze arrived. One writer at a time; a
run that dies leaves no record and is repeated into the same folders.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefold.functions import dates
from orefold.operators import sequence
from orefold.plans import gold, silver
from orefold.sources import tables
from orefold.streaming import incremental

DAY = "bar_date"
CLOSES = f"symbol string, close double, {DAY} date"
PERF = f"bar_ts timestamp_ntz, sector string, sector_pct_change double, n_tickers bigint, {DAY} date"
RECORD = "kind string, day date, version bigint, source bigint, n_rows bigint, reference bigint, run bigint"


def _records(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(RECORD).parquet(f"{root}/_gold_runs")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD)


def _newest(records: DataFrame, kind: str) -> DataFrame:
    """day, version, source: the newest of each day, without days that have no rows."""
    of = records.where(F.col("kind") == kind).groupBy("day").agg(
        F.max_by(F.struct("version", "source", "n_rows"), "run").alias("r")
    )
    return of.select("day", "r.version", "r.source", "r.n_rows")


def _rows(spark: SparkSession, root: str, kind: str, schema: str, days: DataFrame) -> DataFrame:
    return incremental.rows_of(spark, f"{root}/{kind}", schema, DAY, days.where("n_rows > 0"))


def _digest(dim: DataFrame, weights: DataFrame) -> int:
    """A number that changes with the sectors and the weights, whatever their order."""
    tagged = dim.select(F.xxhash64(F.lit("dim"), "ticker", "sector").alias("h")).unionByName(
        weights.select(F.xxhash64(F.lit("weights"), "ticker", "market_cap_b").alias("h"))
    )
    total = F.sum(F.col("h").cast("decimal(38,0)"))
    return tagged.agg(F.coalesce(F.xxhash64(total, F.count("h")), F.lit(0))).first()[0]


def advance_gold(spark: SparkSession, root: str, dim: DataFrame, weights: DataFrame) -> dict[str, int]:
    """Bring gold up to the silver store at ``root`` (see ``incremental.advance_prices``).

    Returns the number of days whose silver is new (``changed``), of days made again
    (``made``) and of (symbol, day) last closes that moved (``moved``).
    """
    records = _records(spark, root)
    reference = _digest(dim, weights)
    last = records.agg(F.max("run"), F.max_by("reference", "run")).first()
    run = 0 if last[0] is None else last[0] + 1
    bars = incremental.manifest(spark, f"{root}/bars")
    made = _newest(records, "gold").select(F.col("day").alias("of"), "source")
    if last[1] != reference:
        made = made.where("false")
    joined = bars.join(made, F.col("day").eqNullSafe(F.col("of")), "left")
    changed = joined.where(F.col("source").isNull() | (F.col("source") < F.col("version"))).select("day", "version")
    changed = tables.write_run(changed, f"{root}/_gold_changed/run={run}")
    n_changed = changed.count()
    if not n_changed:
        return {"changed": 0, "made": 0, "moved": 0}

    # last closes of the changed days, and which of them moved
    rows = incremental.rows_of(spark, f"{root}/bars", incremental.BARS, DAY, changed)
    closes = (
        rows.where(F.col("close").isNotNull()).groupBy("symbol", DAY)
        .agg(F.max_by("close", "bar_ts").alias("close")).select("symbol", "close", DAY)
    )
    fresh = tables.write_run(closes, f"{root}/closes/version={run}", (DAY,))
    kept = _newest(records, "closes")
    of_changed = kept.join(changed.select(F.col("day").alias("c")), F.col("day").eqNullSafe(F.col("c")), "left_semi")
    before = _rows(spark, root, "closes", CLOSES, of_changed)
    moved = tables.write_run(_moved(before, fresh), f"{root}/_gold_moved/run={run}")

    # the symbol's next day with a close
    untouched = kept.join(changed.select(F.col("day").alias("c")), F.col("day").eqNullSafe(F.col("c")), "left_anti")
    first = moved.agg(F.min("day"), F.count(F.lit(1))).first()
    later = _rows(spark, root, "closes", CLOSES, untouched.where(F.col("day") > F.lit(first[0])))
    after = _next_days(moved, fresh.unionByName(later.select(*fresh.columns)))
    days = changed.select("day").unionByName(after).distinct()
    days = tables.write_run(days, f"{root}/_gold_days/run={run}")

    # bars of these days; before each symbol's first bar of a day, its last close before
    wanted = bars.join(days.select(F.col("day").alias("w")), F.col("day").eqNullSafe(F.col("w")), "left_semi")
    current = incremental.rows_of(spark, f"{root}/bars", incremental.BARS, DAY, wanted)
    weighted = gold.weighted_bars(silver.describe_bars(current, dim), weights).withColumn(
        "bar_day", dates.day_bucket(F.col("bar_ts"))
    )
    all_closes = fresh.unionByName(_rows(spark, root, "closes", CLOSES, untouched).select(*fresh.columns))
    carried = _carried(all_closes, days).withColumnsRenamed({DAY: "bar_day"})
    with_prev = sequence.lag_from(
        weighted.repartition("symbol", "bar_day"), carried, "symbol", "bar_ts", "close", "prev_close", "bar_day"
    )
    # a symbol that is not in the sector list has a carried close, but no bars
    perf = gold.perf_of_returns(gold.with_returns(with_prev)).withColumn(DAY, dates.day_bucket(F.col("bar_ts")))
    results = tables.write_run(perf, f"{root}/gold/version={run}", (DAY,))
    _record(spark, root, run, reference, changed, days, bars, fresh, results)
    return {"changed": n_changed, "made": days.count(), "moved": first[1]}


def _moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """(symbol, day) whose last close is new, gone or another."""
    old = before.select("symbol", F.col(DAY).alias("day"), F.col("close").alias("was"), F.lit(0).alias("kind"))
    new = after.select("symbol", F.col(DAY).alias("day"), F.col("close").alias("was"), F.lit(1).alias("kind"))
    both = old.unionByName(new).groupBy("symbol", "day").agg(
        F.max(F.when(F.col("kind") == 0, F.col("was"))).alias("old"),
        F.max(F.when(F.col("kind") == 1, F.col("was"))).alias("new"),
    )
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("symbol", "day")


def _next_days(moved: DataFrame, closes: DataFrame) -> DataFrame:
    """``day``: for each (symbol, day), the symbol's next day with a close. One pass over each
    symbol's days, which the calendar bounds."""
    marks = moved.select("symbol", "day", F.lit(None).cast("date").alias("held"), F.lit(True).alias("asks"))
    held = closes.select("symbol", F.col(DAY).alias("day"), F.col(DAY).alias("held"), F.lit(False).alias("asks"))
    rows = marks.unionByName(held).withColumn("day_number", F.unix_date("day"))
    after = Window.partitionBy("symbol").orderBy("day_number").rangeBetween(1, Window.unboundedFollowing)
    return rows.withColumn("next", F.min("held").over(after)).where(
        F.col("asks") & F.col("next").isNotNull()
    ).select(F.col("next").alias("day"))


def _carried(closes: DataFrame, days: DataFrame) -> DataFrame:
    """(symbol, day, close): the last close before each of the given days that has one."""
    last = days.agg(F.max("day")).first()[0]
    until = closes.where(F.col(DAY) <= F.lit(last))
    before = sequence.previous_day_value(until, "symbol", DAY, "close", "before")
    return before.join(
        F.broadcast(days.withColumnRenamed("day", "w")), F.col(DAY).eqNullSafe(F.col("w")), "left_semi"
    ).select("symbol", DAY, F.col("before").alias("close"))


def _record(
    spark: SparkSession, root: str, run: int, reference: int, changed: DataFrame, days: DataFrame,
    bars: DataFrame, closes: DataFrame, results: DataFrame,
) -> None:
    """The run's record: one row for each day of closes and of gold it has made."""
    def rows(kind: str, of: DataFrame, made: DataFrame) -> DataFrame:
        counts = made.groupBy(F.col(DAY).alias("c")).agg(F.count(F.lit(1)).alias("n_rows"))
        sources = bars.select(F.col("day").alias("b"), F.col("version").alias("source"))
        return (
            of.select("day").join(counts, F.col("day").eqNullSafe(F.col("c")), "left")
            .join(sources, F.col("day").eqNullSafe(F.col("b")), "left")
            .select(
                F.lit(kind).alias("kind"), "day", F.lit(run).cast("bigint").alias("version"), "source",
                F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                F.lit(reference).cast("bigint").alias("reference"), F.lit(run).cast("bigint").alias("run"),
            )
        )

    both = rows("closes", changed, closes).unionByName(rows("gold", days, results))
    both.coalesce(1).write.mode("overwrite").parquet(f"{root}/_gold_runs/made={run}")


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    """The current (bar_ts, sector) results, equal to a full rebuild from the same bronze."""
    newest = _newest(_records(spark, root), "gold")
    return _rows(spark, root, "gold", PERF, newest).drop(DAY)
