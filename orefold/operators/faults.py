"""Faults inside documents: good elements go on, each bad one is set aside with its place.

A document is parsed once, into a variant. Its array is opened into elements with text leaves,
and every element is judged by what the strict reading would make of it. So one bad price
costs one bar, not its document and not the build.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold import schemas
from orefold.functions import dates, numeric
from orefold.operators import nested
from orefold.session import require_session

PATH, REASON, ELEMENT = "fault_path", "fault_reason", "element"
FAULT_COLUMNS = (PATH, REASON, ELEMENT)
_PRICES = ("open", "high", "low", "close")


#: For each kind of payload: its array, the array's elements with text leaves, its first sign.
SHAPES = {
    "bars": ("$.bars", "array<" + schemas.BAR_DOC.split("array<", 1)[1][:-1], "{"),
    "trades": ("$", schemas.TRADE_DOC, "["),
}


def _documents(raw: DataFrame, kind: str) -> DataFrame:
    """``raw`` with each payload parsed once: ``_leaves`` and ``_elements`` of its array, and
    ``_reason`` if there is none."""
    require_session(raw.sparkSession)
    array, leaves, top = SHAPES[kind]
    text = nested.payload_text(F.col("payload"))
    # the top level is tested on the text; try_parse_json gives null for what is no JSON
    parsed = F.when(text.startswith(top), F.try_parse_json(text))
    docs = raw.withColumns({"_text": text, "_doc": parsed}).select(
        "*",
        F.try_variant_get("_doc", array, "variant").alias("_array"),
        F.try_variant_get("_doc", array, leaves).alias("_leaves"),
        F.try_variant_get("_doc", array, "array<variant>").alias("_elements"),
    )
    absent = F.col("_array").isNull() | F.is_variant_null("_array")
    reason = (
        F.when(F.col("_text").isNull(), "missing")
        .when(F.col("_doc").isNull(), "malformed")
        .when(absent, "empty")
        .when(F.col("_leaves").isNull(), "malformed")
        .when(F.size("_leaves") == 0, "empty")
    )
    return docs.withColumn("_reason", reason)


def landable(raw: DataFrame, kind: str) -> DataFrame:
    """The payloads with elements inside, faulty ones or not, as they are."""
    return _documents(raw, kind).where(F.col("_reason").isNull()).select(*raw.columns)


def _opened(raw: DataFrame, kind: str) -> DataFrame:
    """One row for each element: place ``_at``, leaves ``_e`` as text, ``_v`` the element; and
    one row, with the reason, for each payload that has none."""
    key = raw.columns[0]
    pairs = F.arrays_zip(F.col("_leaves").alias("e"), F.col("_elements").alias("v"))
    return _documents(raw, kind).select(
        key, "extracted_at", "_reason", "_text", F.posexplode_outer(pairs).alias("_at", "_pair")
    ).select(key, "extracted_at", "_reason", "_text", "_at", F.col("_pair.e").alias("_e"), F.col("_pair.v").alias("_v"))


def _judged(opened: DataFrame, root: str, faults: list[tuple[str, Column, str]], values: list[Column]) -> DataFrame:
    """Type the elements and add the first fault of each; ``faults`` are (leaf, condition on
    leaves and typed values, reason)."""
    key = opened.columns[0]
    typed = opened.select("*", *values)
    names = typed.columns[len(opened.columns) :]
    no_object = F.col("_at").isNotNull() & F.col("_e").isNull()
    # the place of a payload is null, that of an element as a whole is blank
    fault = F.when(F.col("_reason").isNotNull(), _fault(F.lit(None).cast("string"), F.col("_reason")))
    fault = fault.when(no_object, _fault(F.lit(""), F.lit("no object")))
    for leaf, condition, why in faults:
        fault = fault.when(condition, _fault(F.lit(f".{leaf}"), F.lit(why)))
    found = typed.withColumn("_fault", fault)
    place = F.concat(F.lit(f"{root}["), F.col("_at"), F.lit("]"), F.col("_fault.leaf"))
    # what was found, as landed, for faulty rows alone
    element = F.when(F.col("_reason").isNotNull(), F.col("_text")).otherwise(F.to_json("_v"))
    faulty = F.col("_fault").isNotNull()
    return found.select(
        key, *names, "extracted_at",
        F.when(faulty, F.coalesce(place, F.lit("$"))).alias(PATH),
        F.col("_fault.why").alias(REASON),
        F.when(faulty, element).alias(ELEMENT),
    )


def _fault(leaf: Column, why: Column) -> Column:
    return F.struct(leaf.alias("leaf"), why.alias("why"))


def judged_bars(raw: DataFrame, clock: str = "wall") -> DataFrame:
    """Every element of every payload's bars, typed, with ``fault_path``, ``fault_reason`` and
    the ``element`` as JSON if something is wrong with it, else null.

    Faults: the payload is ``missing``, ``malformed`` or ``empty`` (path ``$``); an element is
    ``no object``; its time is ``missing`` or ``no time``; a price is ``no number``; a volume
    is ``no whole number``. An absent or null price or volume is no fault, as before. The
    first fault in this order is named. Typed columns of faulty rows hold what can be read.
    """
    opened = _opened(raw.select("symbol", "extracted_at", "payload"), "bars")

    def leaf(name: str) -> Column:
        return F.col(f"_e.{name}")

    time = F.when(leaf("ts").try_cast("timestamp_ntz").isNotNull(), leaf("ts"))
    values = [
        dates.bar_clock(time, clock).alias("bar_ts"),
        *[numeric.tolerant_double(leaf(c)).alias(c) for c in _PRICES],
        numeric.tolerant_bigint(leaf("volume")).alias("volume"),
    ]
    faults = [
        ("ts", leaf("ts").isNull(), "missing"),
        ("ts", F.col("bar_ts").isNull(), "no time"),
        *[(c, leaf(c).isNotNull() & F.col(c).isNull(), "no number") for c in _PRICES],
        ("volume", leaf("volume").isNotNull() & F.col("volume").isNull(), "no whole number"),
    ]
    return _judged(opened, "$.bars", faults, values)


def judged_trades(raw: DataFrame) -> DataFrame:
    """Every element of every payload's trades, typed as by ``nested.type_trades``, with the
    columns of ``judged_bars``.

    Faults: as there for payloads; an element is ``no object``; a trade date is given but is
    ``no date``. Such a trade is lost to silver in any case; here it is kept for repair. A bad
    lag stays tolerated, and a trade without a ticker or a date is complete, if of no use.
    """
    opened = _opened(raw.select("source", "extracted_at", "payload"), "trades")
    given = F.trim(F.col("_e.trade_date_raw"))
    no_date = given.isNotNull() & (given != "") & F.col("trade_date").isNull()
    typed = nested.trade_values(lambda c: F.col(f"_e.{c}"))
    return _judged(opened, "$", [("trade_date_raw", no_date, "no date")], typed)


def good(judged: DataFrame) -> DataFrame:
    """The elements without a fault."""
    return judged.where(F.col(REASON).isNull()).drop(*FAULT_COLUMNS)


def aside(judged: DataFrame) -> DataFrame:
    """The faulty elements and payloads: key, extracted_at, path, reason, element."""
    return judged.where(F.col(REASON).isNotNull()).select(judged.columns[0], "extracted_at", *FAULT_COLUMNS)
