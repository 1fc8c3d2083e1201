"""Previous value and last value in time order."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefold.functions import dates
from orefold.operators import cells
from orefold.session import shared_folder
from orefold.sources import tables


#: Cells of a key whose last values are taken in one task, whatever a cell's own limit.
LAST_VALUES = 1000


def previous_value(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    out: str,
    grains: Sequence[str] = ("day",),
    bucket: str = "bucket",
) -> DataFrame:
    """Add ``out``: ``value`` of the key's preceding row in ``order``, null on the first.

    A plain lag puts a whole key into one task. Here a key is split by the first of
    ``grains`` (a unit of time): the lag runs inside (key, grain), and only the first row
    of a grain looks further back, through a table with the last value of every (key,
    grain). That table is treated likewise with the remaining grains, so no task ever
    holds more than the rows of one key in one unit of time.

    Choose the first grain so that a key has few rows in it: ``day`` for hourly bars,
    ``minute`` and then ``day`` for dense events. The result stays partitioned by (key,
    ``bucket``), where ``bucket`` is the added start of the grain; later aggregates that
    group by both need no further shuffle.

    ``order`` must be unique within the key.
    """
    if not grains:
        in_key = Window.partitionBy(key).orderBy(F.asc_nulls_last(order))
        return df.withColumn(out, F.lag(value).over(in_key))

    def carried(last: DataFrame, value: str, out: str) -> DataFrame:
        return previous_value(last, key, bucket, value, out, grains[1:], f"{bucket}_")

    rows = df.withColumn(bucket, dates.grain_start(F.col(order), grains[0]))
    return _lag_in_buckets(rows, key, order, value, out, bucket, carried)


def previous_in_cells(
    df: DataFrame, key: str, order: str, value: str, out: str, most: int = 200_000, bucket: str = "bucket"
) -> DataFrame:
    """As ``previous_value``, without a unit of time: a key with more than ``most`` rows is
    cut where its rows lie (see ``cells.cut``), however dense they are.

    ``order`` is a time, a date or a whole number, unique within the key. The table of last
    values has a row for each cell, and is treated likewise if a key has too many cells.
    """
    rows = cells.cut(df, [key], cells.position(df, order), F.lit(1), most, bucket)

    def carried(last: DataFrame, value: str, out: str) -> DataFrame:
        # written: its own cuts read it more than once
        path = f"{shared_folder(df.sparkSession)}/carry-{uuid.uuid4().hex}"
        last = tables.write_run(last, path)
        held = max(most, LAST_VALUES)
        if last.groupBy(key).count().where(F.col("count") > held).isEmpty():
            return previous_value(last, key, bucket, value, out, ())
        return previous_in_cells(last, key, bucket, value, out, held, cells.unused(last, "bucket"))

    return _lag_in_buckets(rows, key, order, value, out, bucket, carried)


def _lag_in_buckets(
    df: DataFrame, key: str, order: str, value: str, out: str, bucket: str,
    carried: Callable[[DataFrame, str, str], DataFrame],
) -> DataFrame:
    """The lag inside (key, ``bucket``); the first row of a bucket gets what ``carried`` finds
    for it among the last values of the key's buckets."""
    last, carry = (cells.unused(df, n) for n in ("_last", "_carry"))
    # one exchange for the lag and for the last values, so what lies below runs once
    bucketed = df.repartition(key, bucket)
    # the whole row, not the value alone: with other columns it would be another exchange
    whole = F.max_by(F.struct(*df.columns), order).alias(last)
    lasts = bucketed.groupBy(key, bucket).agg(whole).select(
        key, bucket, F.col(last)[value].alias(last)
    )
    first = carried(lasts, last, carry).select(key, bucket, F.col(carry).alias(value))
    return lag_from(bucketed, first, key, order, value, out, bucket)


def lag_from(
    bucketed: DataFrame, carried: DataFrame, key: str, order: str, value: str, out: str, bucket: str
) -> DataFrame:
    """The lag inside (key, ``bucket``) of rows partitioned by both; the first row of a bucket
    gets ``value`` of its row in ``carried`` (key, bucket, value).

    That value enters its bucket as a row before all others, so there is no join: null keys
    are a key like any other, and facts and carried rows meet on one partitioning.
    """
    real = cells.unused(bucketed, "_real")
    kinds = {f.name: f.dataType for f in bucketed.schema}
    first = carried.select(
        *[F.col(c) if c in (key, bucket, value) else F.lit(None).cast(kinds[c]).alias(c) for c in kinds],
        F.lit(False).alias(real),
    )
    rows = bucketed.withColumn(real, F.lit(True)).unionByName(first.repartition(key, bucket))
    in_bucket = Window.partitionBy(key, bucket).orderBy(real, F.asc_nulls_last(order))
    return rows.withColumn(out, F.lag(value).over(in_bucket)).where(F.col(real)).drop(real)


def last_per_day(
    df: DataFrame, keys: Sequence[str], order: str, value: str, day: str
) -> DataFrame:
    """``value`` at the day's highest ``order``, per key and day.

    An aggregate rather than a window: it combines before the shuffle and sorts nothing.
    """
    return (
        df.withColumn(day, dates.day_of(F.col(order)))
        .groupBy(*keys, day)
        .agg(F.max_by(value, order).alias(value))
    )


def previous_day_value(df: DataFrame, key: str, day: str, value: str, out: str) -> DataFrame:
    """Lag over at most one row per key and day; the calendar bounds each key."""
    by_key = Window.partitionBy(key).orderBy(F.asc_nulls_last(day))
    return df.withColumn(out, F.lag(value).over(by_key))
