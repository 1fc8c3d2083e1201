"""Versions of records with the time they were valid, and tables as of a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.operators import cells, dedup, sequence

FROM, TO = "valid_from", "valid_to"


def versions(
    rows: DataFrame, keys: Sequence[str], version: str, tiebreak: Sequence[str] = (), most: int = 200_000
) -> DataFrame:
    """Each version of each record, valid from its ``version`` time until that of the next one
    (``valid_to`` null: until further notice).

    Rows of one key and time are one version, chosen as by ``dedup.keep_latest``; null keys
    are a key, and a row without a time is none. ``rows`` is read more than once: a written
    table. A key with more than ``most`` versions is cut into cells, so that no task holds all
    versions of a record that is extracted again and again.
    """
    known = rows.where(F.col(version).isNotNull())
    one = dedup.keep_latest(known, [*keys, version], version, tiebreak or [c for c in rows.columns if c not in (*keys, version)])
    key, back, bucket = (cells.unused(one, n) for n in ("_key", "_back", "_bucket"))
    # the next version is the previous one of time reversed
    held = one.withColumns(
        {key: F.struct(*keys), back: -F.unix_micros(F.col(version).cast("timestamp")), FROM: F.col(version)}
    )
    later = sequence.previous_in_cells(held, key, back, FROM, TO, most, bucket)
    return later.select(*rows.columns, FROM, TO)


def as_of(history: DataFrame, at: str | dt.datetime) -> DataFrame:
    """The records as they were known at a time, without the validity columns."""
    time = F.lit(str(at)).cast("timestamp")
    return history.where((F.col(FROM) <= time) & (F.col(TO).isNull() | (F.col(TO) > time))).drop(FROM, TO)


def known_then(
    facts: DataFrame, history: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """``facts`` with ``columns`` of the version of their record that was valid at their own
    time ``at``. A join on the keys, with the interval as its condition: versions of one key do
    not overlap, so a fact meets one at most."""
    names = {c: cells.unused(facts, f"_{i}") for i, c in enumerate((*keys, FROM, TO))}
    side = history.select(*[F.col(c).alias(n) for c, n in names.items()], *columns)
    same = (F.col(at) >= F.col(names[FROM])) & (F.col(names[TO]).isNull() | (F.col(at) < F.col(names[TO])))
    for k in keys:
        same &= facts[k].eqNullSafe(side[names[k]])
    return facts.join(side, same, how).drop(*names.values())
