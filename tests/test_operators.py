import datetime as dt
import itertools
import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from builders import bar, dim, prices, rows, trade, trades
from orefold import schemas
from orefold.operators import dedup, filters, joins, nested, quality, sequence


# some task failures reach Python unconverted
FAILURE = (PySparkException, Py4JJavaError)


# nested

def test_bars_that_give_no_row(spark):
    raw = prices(
        spark,
        ("A", "2026-04-22T10:00:00+00:00", "{}"),
        ("A", "2026-04-22T10:00:00+00:00", '{"bars": null}'),
        ("A", "2026-04-22T10:00:00+00:00", '{"bars": []}'),
        ("A", "2026-04-22T10:00:00+00:00", None),
        ("A", "2026-04-22T10:00:00+00:00", "null"),
    )
    assert nested.explode_bars(raw).count() == 0
    assert nested.explode_bars(raw, "lenient").count() == 0


@pytest.mark.parametrize("payload", ["no json", '{"bars": {"ts": 1}}', "[1]", '{"bars": "x"}', ""])
def test_strict_bars_fail_lenient_skips(spark, payload):
    raw = prices(spark, ("A", "2026-04-22T10:00:00+00:00", payload))
    with pytest.raises(FAILURE):
        nested.explode_bars(raw).collect()
    assert nested.explode_bars(raw, "lenient").count() == 0


@pytest.mark.parametrize("payload", ["no json", '{"ticker": "A"}', '"x"'])
def test_strict_trades_fail(spark, payload):
    raw = trades(spark, ("2026-04-22T10:00:00+00:00", payload))
    with pytest.raises(FAILURE):
        nested.explode_trades(raw).collect()


def test_white_space_around_a_payload(spark):
    at = "2026-04-22T10:00:00+00:00"
    raw = trades(spark, (at, '\n\t [{"ticker": "A"}]\r\n'), (at, "\nnull\n"))
    assert [r.ticker for r in nested.explode_trades(raw).collect()] == ["A"]
    assert sorted(str(r.reason) for r in nested.with_reason(raw, "trades").collect()) == [
        "None", "missing",
    ]
    bars = prices(spark, ("A", at, '\n{"bars": [{"ts": "2026-04-22T09:30:00", "close": 1}]}\n'))
    assert nested.explode_bars(bars).count() == nested.read_bars(bars).count() == 1


def test_lenient_trades_skip_what_quarantine_holds(spark):
    at = "2026-04-22T10:00:00+00:00"
    raw = trades(spark, (at, '{"ticker": "A"}'), (at, "no json"), (at, [trade()]))
    assert nested.explode_trades(raw, "lenient").count() == 1
    assert nested.split_raw(raw, "trades")[1].count() == 2


def test_key_access_as_text(spark):
    raw = trades(
        spark,
        (
            "2026-04-22T10:00:00+00:00",
            '[{"politician": null, "party": "", "state": {"a": [1, 2]}, "filed_after_days": 7}]',
        ),
    )
    got = nested.explode_trades(raw).first()
    assert (got.politician, got.chamber, got.party, got.state, got.filed_after_days) == (
        None, None, "", '{"a":[1,2]}', "7",
    )


def test_bad_leaf_strict_and_lenient(spark):
    raw = prices(
        spark, ("A", "2026-04-22T10:00:00+00:00", [bar("2026-04-22T09:30:00", "abc")])
    )
    with pytest.raises(FAILURE):
        nested.type_bars(nested.explode_bars(raw)).collect()
    typed = nested.type_bars(nested.explode_bars(raw, "lenient"), "lenient").first()
    assert typed.close is None and typed.open == 1.0
    assert typed.bar_ts == dt.datetime(2026, 4, 22, 9, 30)


def test_whole_number_volume(spark):
    doc = [bar("2026-04-22T09:30:00", 1.5, 12.6), bar("2026-04-22T10:30:00", 1.5, 2**40)]
    raw = prices(spark, ("A", "2026-04-22T10:00:00+00:00", doc))
    got = nested.type_bars(nested.explode_bars(raw)).orderBy("bar_ts").collect()
    assert [r.volume for r in got] == [13, 2**40]


ODD_DOCS = [
    '{"bars": [{"ts": "2026-04-22T09:30:00-04:00", "open": "1.5", "close": 2, "volume": 12.6}]}',
    '{"bars": [{"ts": "2026-04-22T09:30:00", "open": 1, "close": 1e2, "volume": "7"}]}',
    '{"bars": [null, {"ts": null}, {"close": 12345678901234567890.123}]}',
    '{"bars": [{"ts": "2026-04-22 10:30:00", "close": null, "volume": 9007199254740993}]}',
    '{"bars": null}', "{}", " null ", None, '{"bars": []}',
    ' {"extra": [1], "bars": [{"ts": "2026-04-23", "close": 0.1}], "more": {}} ',
]
BAD_DOCS = [
    '{"bars": [{"ts": "2026-04-22T09:30:00", "close": "abc", "open": 1.5}]}',
    '{"bars": [{"ts": "2026-04-22T09:30:00", "close": ""}]}',
    '{"bars": [{"ts": "2026-04-22T09:30:00", "close": 1.5, "volume": {"a": 1}}]}',
    '{"bars": [{"ts": "2026-04-22T09:30:00", "close": true}]}',
    '{"bars": [{"ts": "later", "close": 1.5}]}',
    '{"bars": [{"ts": "2026-04-22T09:30:00", "volume": 99999999999999999999}]}',
    '{"bars": {"ts": "x"}}', '{"bars": [1]}', "[]", "no json", "", '{"bars": [{"ts": "x"}',
]


def test_reading_straight_to_numbers_changes_nothing(spark):
    for mode in nested.MODES:
        docs = ODD_DOCS + (BAD_DOCS if mode == "lenient" else [])
        raw = prices(spark, *[("A", "2026-04-22T10:00:00+00:00", d) for d in docs])
        want = nested.type_bars(nested.explode_bars(raw, mode), mode)
        got = nested.read_bars(raw, mode)
        assert got.dtypes == want.dtypes
        assert rows(got) == rows(want) and got.count() >= 7


@pytest.mark.parametrize("payload", BAD_DOCS)
def test_reading_straight_to_numbers_is_as_strict(spark, payload):
    raw = prices(spark, ("A", "2026-04-22T10:00:00+00:00", payload))
    with pytest.raises(FAILURE):
        nested.type_bars(nested.explode_bars(raw)).collect()
    with pytest.raises(FAILURE):
        nested.read_bars(raw).collect()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        nested.explode_bars(prices(spark, ("A", "2026-04-22T10:00:00+00:00", "{}")), "maybe")


def test_quarantine_of_bars(spark):
    at = "2026-04-22T10:00:00+00:00"
    raw = prices(
        spark,
        ("ok", at, [bar("2026-04-22T09:30:00", 1.0)]),
        ("missing", at, None),
        ("missing", at, "null"),
        ("malformed", at, '{"bars": {"ts": 1}}'),
        ("malformed", at, '{"bars": [{"ts": "x"}]'),
        ("malformed", at, "x"),
        ("malformed", at, "[]"),
        ("empty", at, "{}"),
        ("empty", at, '{"bars": []}'),
    )
    good, bad = nested.split_raw(raw, "bars")
    assert good.columns == raw.columns
    assert [r.symbol for r in good.collect()] == ["ok"]
    assert bad.count() == 8
    assert bad.filter(F.col("symbol") != F.col("reason")).count() == 0
    assert bad.filter("payload is null").count() == 1


def test_quarantine_of_trades(spark):
    at = "2026-04-22T10:00:00+00:00"
    raw = trades(spark, (at, [trade()]), (at, "[]"), (at, '{"ticker": "A"}'), (at, "[{"), (at, "null"))
    good, bad = nested.split_raw(raw, "trades")
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["empty", "malformed", "malformed", "missing"]


def twenty_bars(spark):
    schema = "symbol string, ts string, open double, high double, low double, close double, volume bigint"
    data = [
        ("AB"[i % 2], f"2026-{4 + i // 10:02d}-22T{i:02d}:30:00", 1.5 * i, 2.0, None, None if i % 5 == 0 else i / 3, i)
        for i in range(20)
    ]
    return spark.createDataFrame(data, schema)


def test_nesting_is_an_identity(spark):
    bars = twenty_bars(spark)
    docs = nested.nest_bars(bars)
    landed = docs.withColumn("extracted_at", F.lit("2026-04-22 00:00:00").cast("timestamp"))
    back = nested.type_bars(nested.explode_bars(landed)).drop("extracted_at")
    want = bars.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert rows(back) == rows(want)


def test_documents_depend_on_the_rows_alone(spark):
    """One document for a symbol and month, in whatever layout the rows come."""
    bars = twenty_bars(spark)
    want = rows(nested.nest_bars(bars.coalesce(1)))
    assert len(want) == 4
    assert rows(nested.nest_bars(bars.repartition(7).sortWithinPartitions(F.rand(3)))) == want
    trades = spark.range(300).selectExpr(
        "'s' source", "concat('P', id) politician", "concat(id % 28 + 1, ' Apr 2026') trade_date_raw"
    )
    assert nested.nest_trades(trades).count() == 1
    want = rows(nested.nest_trades(trades.coalesce(1), 2000))
    assert 1 < len(want) < 40
    assert rows(nested.nest_trades(trades.repartition(5), 2000)) == want


def test_one_hot_symbol_is_spread_over_documents(spark):
    bars = spark.range(1000).selectExpr(
        "'HOT' symbol", "cast(date_add(date'2020-01-01', cast(id as int)) as string) ts", "1d open",
        "1d high", "1d low", "1d close", "id volume",
    )
    docs = nested.nest_bars(bars).collect()
    assert len(docs) == 33
    assert all(len(json.loads(d.payload)["bars"]) <= 31 for d in docs)


def test_document_keeps_nulls_and_order(spark):
    bars = spark.createDataFrame(
        [("A", "2026-04-2", 1.0, 1.0, 1.0, None, None), ("A", "2026-04-1", 1.0, 1.0, 1.0, 2.0, 3)],
        "symbol string, ts string, open double, high double, low double, close double, volume bigint",
    ).coalesce(1)
    (doc,) = nested.nest_bars(bars).collect()
    payload = json.loads(doc.payload)
    assert (payload["symbol"], payload["interval"]) == ("A", "1h")
    assert [b["ts"] for b in payload["bars"]] == ["2026-04-1", "2026-04-2"]
    assert payload["bars"][1]["close"] is None and "volume" in payload["bars"][1]


# dedup

def test_keep_latest_groups_null_keys(spark):
    df = spark.createDataFrame(
        [(None, 1, "old"), (None, 2, "new"), ("a", 1, "a1")], "k string, v int, x string"
    )
    assert rows(dedup.keep_latest(df, ["k"], "v")) == [("a", 1, "a1"), (None, 2, "new")]


def test_keep_latest_ignores_input_order(spark):
    data = [("a", 1, "x", None), ("a", 1, "y", 1), ("a", 1, "y", None), ("a", None, "z", 9)]
    for order in itertools.permutations(data):
        df = spark.createDataFrame(list(order), "k string, v int, x string, y int")
        assert rows(dedup.keep_latest(df, ["k"], "v")) == [("a", 1, "y", 1)]


def test_union_keep_first(spark):
    schema = "k string, x string, position int"
    base = spark.createDataFrame([("a", "second", 2), ("a", "first", 1), ("b", "b", 3)], schema)
    more = spark.createDataFrame([("a", "later", 0), ("c", "c", 0)], schema).select("x", "position", "k")
    assert rows(dedup.union_keep_first([base, more], "k", "position")) == [
        ("a", "first"), ("b", "b"), ("c", "c"),
    ]


# sequence

@pytest.mark.parametrize("grains", [(), ("day",), ("hour", "day"), ("minute", "week", "year")])
def test_previous_value_equals_plain_lag(spark, grains):
    rng = random.Random(1)
    data = {}
    for _ in range(600):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 5)}"
        ts = dt.datetime(2026, 1, 1) + dt.timedelta(hours=rng.randint(0, 24 * 40))
        data[(key, ts)] = None if rng.random() < 0.1 else rng.random()
    df = spark.createDataFrame(
        [(k, t, v) for (k, t), v in data.items()], "k string, t timestamp_ntz, v double"
    )
    got = {(r.k, r.t): r.p for r in sequence.previous_value(df, "k", "t", "v", "p", grains).collect()}
    want, last = {}, {}
    for key, ts in sorted(data):
        want[(key, ts)] = last.get(key)
        last[key] = data[(key, ts)]
    assert got == want


def test_previous_value_null_time_sorts_last(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2026, 1, 1), 1.0), ("a", None, 2.0)], "k string, t timestamp_ntz, v double"
    )
    got = {r.t: r.p for r in sequence.previous_value(df, "k", "t", "v", "p").collect()}
    assert got == {dt.datetime(2026, 1, 1): None, None: 1.0}


def test_last_per_day(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2026, 1, 1, h), float(h)) for h in (3, 9, 5)]
        + [("a", dt.datetime(2026, 1, 2, 1), 7.0)],
        "k string, t timestamp_ntz, v double",
    )
    assert rows(sequence.last_per_day(df, ["k"], "t", "v", "d")) == [
        ("a", dt.date(2026, 1, 1), 9.0), ("a", dt.date(2026, 1, 2), 7.0),
    ]


# filters and joins

def test_selected(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert filters.selected(df, "x", None).count() == 3
    assert filters.selected(df, "x", []).count() == 0
    assert rows(filters.selected(df, "x", ["b", "z"])) == [("b",)]


def test_at_least(spark):
    df = spark.createDataFrame([(None,), (8000,), (32500,)], "x int")
    assert filters.at_least(df, "x", 0).count() == 3
    assert rows(filters.at_least(df, "x", 15000)) == [(32500,)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_size_check_decides_on_broadcast(spark):
    fact = spark.range(100).selectExpr("cast(id as string) k")
    table = spark.range(50).selectExpr("cast(id as string) ticker", "id x")
    assert joins.measured_size(table) == (50, 50 * 32 + sum(len(str(i)) for i in range(50)), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.attach(fact, joins.size_checked(table), "k", "ticker")
        rows_too_many = joins.attach(fact, joins.size_checked(table, max_rows=49), "k", "ticker")
        bytes_too_many = joins.attach(fact, joins.size_checked(table, max_bytes=99), "k", "ticker")
        assert "BroadcastHashJoin" in plan(small)
        for other in (rows_too_many, bytes_too_many):
            assert "SortMergeJoin" in plan(other) and "Broadcast" not in plan(other)
            assert rows(other) == rows(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_when_the_dimension_is_large(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    kept = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 300_000, 1, 12).selectExpr(
            "if(id % 3 = 0, 'hot', cast(id as string)) symbol", "id", "uuid() x"
        )
        table = spark.range(1000).selectExpr("cast(id as string) ticker", "id sector").union(
            spark.range(1).selectExpr("'hot'", "-1L")
        )
        sized = joins.size_checked(table, max_rows=10)
        joined = joins.attach(fact, sized, "symbol", "ticker")
        assert joined.filter("sector = -1").count() == 100_000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_left_join_keeps_unmatched(spark):
    fact = spark.createDataFrame([("AAA",), ("ZZZ",)], "symbol string")
    got = joins.attach(fact, dim(spark), "symbol", "ticker").select("symbol", "sector")
    assert rows(got) == [("AAA", "Tech"), ("ZZZ", None)]
    assert rows(joins.keys_missing_from(fact, dim(spark), "symbol", "ticker")) == [("ZZZ",)]


# quality

def test_checks_count_failures(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), (None, -1), (None, None), ("b", 46)], "k string, n int"
    )
    checks = (
        quality.NotNull("k"),
        quality.AcceptedRange("n", min=0),
        quality.AcceptedRange("n", min=1, max=46, inclusive=False),
        quality.Unique("k"),
        quality.Unique("k", "n"),
    )
    got = [tuple(r) for r in quality.report(df, checks).collect()]
    assert got == [
        ("not_null(k)", 2), ("accepted_range(n)", 1), ("accepted_range(n)", 3),
        ("unique(k)", 1), ("unique_combination(k, n)", 0),
    ]


def test_gate_stops_on_the_first_failure(spark):
    df = spark.createDataFrame([("a", 1), ("a", -5)], "k string, n int")
    assert quality.gate(df, (quality.NotNull("k"),)) is df
    with pytest.raises(quality.DataQualityError, match=r"t: accepted_range\(n\) has 1 failures.*-5"):
        quality.gate(df, (quality.AcceptedRange("n", min=0), quality.Unique("k")), "t")
    with pytest.raises(quality.DataQualityError, match=r"unique\(k\)"):
        quality.gate(df, (quality.Unique("k"),), "t")


def test_declared_checks():
    tables = (
        quality.SILVER_PRICES, quality.SILVER_TRADES, quality.SECTOR_HOURLY_PERF,
        quality.SECTOR_BUYS_30D, quality.DIM_SECTORS,
    )
    kinds = [type(c).__name__ for t in tables for c in t]
    assert (kinds.count("NotNull"), kinds.count("Unique"), kinds.count("AcceptedRange")) == (11, 3, 1)
    assert schemas.SILVER_PRICES[0] == "symbol"
