"""JSON documents to rows and rows to JSON documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold import fixed_values as fixed
from orefold import schemas
from orefold.functions import dates, numeric
from orefold.operators import cells
from orefold.session import require_session

MODES = ("strict", "lenient")
#: Size of a document's records; one larger record is a document of its own.
DOCUMENT_BYTES = 1024 * 1024


def _checked_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return mode


def payload_text(payload: Column) -> Column:
    """The payload without white space around it; a JSON ``null`` is a missing payload."""
    return F.nullif(F.trim(payload, F.lit(" \t\r\n")), F.lit("null"))


def _document(text: Column, schema: str, mode: str) -> Column:
    """Parse one ``payload_text``, a column of its own, since it is named several times and
    trimming is dear; its top level must be an array or an object as in the schema."""
    top_level_fits = text.startswith("[" if schema.startswith("array") else "{")
    if mode == "lenient":
        return F.when(top_level_fits, F.from_json(text, schema))
    parsed = F.from_json(text, schema, {"mode": "FAILFAST"})
    return F.when(text.isNull() | top_level_fits, parsed).otherwise(
        F.raise_error(F.concat(F.lit("payload has the wrong shape: "), F.substring(text, 1, 80)))
    )


def _opened(raw: DataFrame, key: str) -> DataFrame:
    """``key``, ``extracted_at`` and the payload's text as ``_text``."""
    return raw.select(key, "extracted_at", payload_text(F.col("payload")).alias("_text"))


def explode_bars(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """One row per element of ``payload.bars``, leaves as text.

    A missing, null or empty array gives no row. ``strict`` fails on a payload that
    is not an object with an array of bars; ``lenient`` skips it (see ``split_raw``).
    """
    require_session(raw.sparkSession)
    bars = _document(F.col("_text"), schemas.BAR_DOC, _checked_mode(mode))["bars"]
    return _opened(raw, "symbol").select("symbol", "extracted_at", F.explode(bars).alias("bar")).select(
        "symbol", "extracted_at", "bar.*"
    )


def explode_trades(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """One row per element of the payload's top-level array, leaves as text."""
    require_session(raw.sparkSession)
    trades = _document(F.col("_text"), schemas.TRADE_DOC, _checked_mode(mode))
    return _opened(raw, "source").select("source", "extracted_at", F.explode(trades).alias("trade")).select(
        "source", "extracted_at", "trade.*"
    )


def _number_leaves(leaf: Callable[[str], Column], mode: str) -> list[Column]:
    """Prices as double and volume as bigint from text leaves."""
    if mode == "strict":
        to_double, to_bigint = numeric.strict_double, numeric.strict_bigint
    else:
        to_double, to_bigint = numeric.tolerant_double, numeric.tolerant_bigint
    prices = [to_double(leaf(c)).alias(c) for c in ("open", "high", "low", "close")]
    return [*prices, to_bigint(leaf("volume")).alias("volume")]


def _bar_time(ts: Column, mode: str, clock: str) -> Column:
    if mode == "lenient":
        ts = F.when(ts.try_cast("timestamp_ntz").isNotNull(), ts)
    return dates.bar_clock(ts, clock).alias("bar_ts")


def type_bars(bars: DataFrame, mode: str = "strict", clock: str = "wall") -> DataFrame:
    """Text leaves to typed columns. ``strict`` fails on a bad value, ``lenient`` nulls it."""
    _checked_mode(mode)
    return bars.select(
        "symbol",
        _bar_time(F.col("ts"), mode, clock),
        *_number_leaves(F.col, mode),
        "extracted_at",
    )


def read_bars(raw: DataFrame, mode: str = "strict", clock: str = "wall") -> DataFrame:
    """``explode_bars`` and ``type_bars`` in one, with the same result.

    Documents that hold numbers as JSON numbers are parsed straight to numbers, which is
    much faster than by way of text. Only a document in which anything does not fit goes
    through text leaves and casts.
    """
    require_session(raw.sparkSession)
    _checked_mode(mode)
    opened = _opened(raw, "symbol").withColumn(
        "_doc", F.from_json("_text", schemas.NUMBER_BAR_DOC, {"mode": "PERMISSIVE"})
    )
    fits = F.col("_doc").isNotNull() & F.col("_doc._corrupt_record").isNull()
    by_text = F.transform(
        _document(F.col("_text"), schemas.BAR_DOC, mode)["bars"],
        lambda b: F.struct(b["ts"].alias("ts"), *_number_leaves(lambda c: b[c], mode)),
    )
    bars = F.when(F.col("_text").isNull() | fits, F.col("_doc.bars")).otherwise(by_text)
    return opened.select("symbol", "extracted_at", F.explode(bars).alias("bar")).select(
        "symbol",
        _bar_time(F.col("bar.ts"), mode, clock),
        *[F.col(f"bar.{c}").alias(c) for c in ("open", "high", "low", "close", "volume")],
        "extracted_at",
    )


def trade_values(leaf: Callable[[str], Column]) -> list[Column]:
    """Typed, canonical columns of a trade between its source and its extraction, from text
    leaves. A bad date or lag becomes null."""
    return [
        leaf("politician").alias("member"),
        F.lower(leaf("party")).alias("party"),
        F.lower(leaf("chamber")).alias("chamber"),
        leaf("state").alias("state"),
        leaf("issuer").alias("issuer"),
        F.upper(leaf("ticker")).alias("ticker"),
        dates.parse_display_date(leaf("trade_date_raw")).alias("trade_date"),
        numeric.tolerant_int(leaf("filed_after_days")).alias("disclosure_lag_days"),
        leaf("owner").alias("owner"),
        F.lower(leaf("tx_type")).alias("txn_type"),
        leaf("size").alias("txn_value_band"),
        leaf("price").alias("price"),
    ]


def type_trades(trades: DataFrame) -> DataFrame:
    """Text leaves to typed, canonical columns. A bad date or lag becomes null."""
    return trades.select("source", *trade_values(F.col), "extracted_at")


def with_reason(raw: DataFrame, kind: str) -> DataFrame:
    """Add ``reason``: why a landed payload yields no row, null when it does.

    ``missing``: no payload; ``malformed``: not JSON or of the wrong shape;
    ``empty``: no record inside.
    """
    text = payload_text(F.col("payload"))
    if kind == "bars":
        schema = schemas.BAR_DOC[:-1] + ",_corrupt_record:string>"
        # with the mode spelt out, the parser keeps all fields, and so sees every fault
        parsed = F.from_json("_text", schema, {"mode": "PERMISSIVE"})
        records = F.col("_doc.parsed.bars")
        malformed = F.col("_doc.parsed").isNull() | F.col("_doc.parsed._corrupt_record").isNotNull()
    elif kind == "trades":
        parsed = F.from_json("_text", schemas.TRADE_DOC)
        records = F.col("_doc.parsed")
        malformed = records.isNull() | ~F.col("_doc.text").startswith("[")
    else:
        raise ValueError(f"kind must be 'bars' or 'trades', not {kind!r}")
    # one element, exploded: a filter on the reason would else be pushed below, and parse the
    # payload anew, and make it anew, wherever it names the document
    once = F.array(F.struct(F.col("_text").alias("text"), parsed.alias("parsed")))
    judged = raw.withColumn("_text", text).select(*raw.columns, F.explode(once).alias("_doc"))
    return judged.withColumn(
        "reason",
        F.when(F.col("_doc.text").isNull(), "missing")
        .when(malformed, "malformed")
        .when(F.coalesce(F.size(records), F.lit(0)) <= 0, "empty"),
    ).drop("_doc")


def split_raw(raw: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine). Quarantined rows keep their payload and gain ``reason``."""
    judged = with_reason(raw, kind)
    good = judged.filter(F.col("reason").isNull()).drop("reason")
    return good, judged.filter(F.col("reason").isNotNull())


def json_text(c: Column) -> Column:
    """Serialise with explicit nulls."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def nest_bars(bars: DataFrame, most_bytes: int = DOCUMENT_BYTES) -> DataFrame:
    """Bars (symbol, ts, open..volume) to (symbol, payload) documents, bars by time.

    A document holds one symbol's bars of one month; months with more than ``most_bytes`` of
    them are cut (see ``_records``).
    """
    bar = F.struct("ts", "open", "high", "low", "close", "volume")
    docs = _records(bars.select("symbol", F.substring("ts", 1, 7).alias("month"), json_text(bar).alias("record")), most_bytes)
    head = json_text(F.struct("symbol", F.lit(fixed.BAR_INTERVAL).alias("interval")))
    body = F.concat(F.rtrim(head, F.lit("}")), F.lit(',"bars":['), F.array_join("records", ","), F.lit("]}"))
    return docs.select("symbol", body.alias("payload"))


def nest_trades(trades: DataFrame, most_bytes: int = DOCUMENT_BYTES) -> DataFrame:
    """Trade records with a ``source`` to (source, payload) documents, in order of fields.

    A document holds one source's trades of one month (the last two words of the display
    date; blank dates are a month too); months with more than ``most_bytes`` are cut.
    """
    record = json_text(F.struct(*[c for c in trades.columns if c != "source"]))
    month = F.substring_index("trade_date_raw", " ", -2)
    docs = _records(trades.select("source", month.alias("month"), record.alias("record")), most_bytes)
    return docs.select("source", F.concat(F.lit("["), F.array_join("records", ","), F.lit("]")).alias("payload"))


def _records(rows: DataFrame, most_bytes: int) -> DataFrame:
    """Rows (key, month, ``record`` as JSON) to one row for each document with its sorted
    ``records``; no document holds more than ``most_bytes`` of them, unless it is one record.

    The hash of a record is its place on an axis, which is cut where too many bytes fall (see
    ``cells.cut``): a month without a date or a key with a third of all rows becomes many
    documents of like size. Equal records have one place, so they are counted first, and as
    many copies go into a piece as fit. The documents depend on the rows alone.
    """
    by = rows.columns[:2]
    size = F.octet_length("record") + 1
    fit = F.greatest(F.floor(F.lit(most_bytes) / size), F.lit(1))
    pieces = rows.groupBy(*by, "record").agg(F.count(F.lit(1)).alias("copies")).select(
        *by, "record", size.alias("size"), fit.alias("fit"),
        F.posexplode(F.transform(F.sequence(F.lit(1), F.ceil(F.col("copies") / fit)),
                                 lambda i: F.least(fit, F.col("copies") - (i - 1) * fit))).alias("piece", "copies"),
    )
    place = F.shiftrightunsigned(F.xxhash64("record", "piece"), 2)
    held = cells.cut(pieces, by, place, F.col("size") * F.col("copies"), most_bytes)
    repeated = F.flatten(F.collect_list(F.array_repeat("record", F.col("copies").cast("int"))))
    return held.groupBy(*by, "cell").agg(F.array_sort(repeated).alias("records"))
