"""Keys cut into cells of bounded weight along a position.

A key that holds too much for one task is cut where its rows lie, not by the calendar or by a
fixed number of buckets: a position (a time, a hash) is a whole number, and a cell is an
aligned stretch of positions. The width of a key's cells follows from its weight and the span
of its positions; cells that still hold too much, because rows crowd there, are cut again from
their own span. The cells depend on the rows alone, not on files, partitions or order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.operators import joins
from orefold.session import shared_folder
from orefold.sources import tables

LAST = (1 << 62) - 1


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it none of the columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def position(df: DataFrame, column: str) -> Column:
    """The order of a time, date or whole number as a whole number; null comes last."""
    kind = df.schema[column].dataType.typeName()
    c = F.col(column)
    if kind in ("timestamp", "timestamp_ntz"):
        c = F.unix_micros(c.cast("timestamp"))
    elif kind == "date":
        c = F.unix_date(c)
    elif kind not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{column} is {kind}; a time, a date or a whole number is needed")
    return F.coalesce(c.cast("long"), F.lit(LAST))


def cut(
    df: DataFrame, keys: Sequence[str], at: Column, weight: Column, most: int, out: str = "cell"
) -> DataFrame:
    """Add ``out``, the first position of the row's cell; 0 for keys that are not cut.

    No cell of a key weighs more than ``most``, unless all its rows share one position. Null
    keys are one key. ``at`` is a whole number (see ``position``) and ``weight`` a positive
    one. Keys are cut in rounds, each of which reads the rows of the cells that are still too
    heavy; what it finds is written, and no larger than the cells it makes.
    """
    if most < 1:
        raise ValueError("most must be positive")
    place, load, found = (unused(df, n) for n in ("_place", "_load", "_found"))
    rows = df.withColumns({place: at, load: weight, out: F.lit(None).cast("long")})
    where = [*keys, out]
    heavy = _heavy(rows, where, place, load, most)
    while not heavy.isEmpty():
        rows = _narrowed(rows, heavy, where, place, out, found)
        heavy = _heavy(rows.where(F.col(found)), where, place, load, most)
        rows = rows.drop(found)
    return rows.withColumn(out, F.coalesce(out, F.lit(0))).drop(place, load)


def _heavy(rows: DataFrame, where: Sequence[str], place: str, load: str, most: int) -> DataFrame:
    """The cells above the limit that can be cut, with the width of the next ones as a shift.
    Written: later rounds and the result read it, whatever becomes of executors."""
    low, high = F.min(place), F.max(place)
    # the span for each half of the limit, rounded down to a power of two
    width = (high - low).cast("double") / F.greatest(F.lit(2.0) * F.sum(load) / most, F.lit(2.0))
    shift = F.greatest(F.floor(F.log2(width + F.lit(1e-9))), F.lit(0)).cast("int")
    heavy = (
        rows.groupBy(*where)
        .agg(F.sum(load).alias(load), low.alias(place), high.alias("_high"), shift.alias("_shift"))
        .where((F.col(load) > most) & (F.col(place) < F.col("_high")))
        .select(*where, "_shift")
    )
    return tables.write_run(heavy, f"{shared_folder(rows.sparkSession)}/cells-{uuid.uuid4().hex}")


def _narrowed(
    rows: DataFrame, heavy: DataFrame, where: Sequence[str], place: str, out: str, found: str
) -> DataFrame:
    """Rows of heavy cells in narrower ones; ``found`` says which."""
    cells = heavy.select(
        *[F.col(c).alias(f"{found}_{i}") for i, c in enumerate(where)], F.col("_shift").alias(f"{found}_by")
    )
    same = F.lit(True)
    for i, c in enumerate(where):
        same &= F.col(c).eqNullSafe(F.col(f"{found}_{i}"))
    by = F.col(f"{found}_by")
    # a variable shift, arithmetic: positions below 0 round down as well
    start = F.expr(f"shiftleft(shiftright(`{place}`, `{found}_by`), `{found}_by`)")
    return rows.join(joins.size_checked(cells), same, "left").withColumns(
        {out: F.when(by.isNotNull(), start).otherwise(F.col(out)), found: by.isNotNull()}
    ).drop(*cells.columns)
