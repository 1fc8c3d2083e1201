"""Cells of bounded weight, the lag over them, and documents of bounded size."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from builders import rows
from orefold.operators import cells, nested, sequence


def cut(spark, data, most, schema="k string, at long, w long"):
    df = spark.createDataFrame(data, schema)
    return cells.cut(df, ["k"], F.col("at"), F.col("w"), most)


def check(got, data, most):
    assert sorted((r.k or "", r.at, r.w) for r in got) == sorted((k or "", a, w) for k, a, w in data)
    by = {}
    for r in got:
        by.setdefault((r.k, r.cell), []).append(r)
    for held in by.values():
        assert sum(r.w for r in held) <= most or len({r.at for r in held}) == 1
    # cells do not interleave: in order of position, each cell is one run, in order of its start
    for key in {r.k for r in got}:
        order = [r.cell for r in sorted((r for r in got if r.k == key), key=lambda r: r.at)]
        assert order == sorted(order)


@pytest.mark.parametrize("seed", range(4))
def test_cells_are_bounded(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", None]), rng.choice((1, 10**3, 10**12)) * rng.randrange(-50, 50), rng.randint(1, 3)) for _ in range(400)]
    data += [("c", 7, 1)] * 60 + [("d", i, 1) for i in range(3)]
    got = cut(spark, data, 20).collect()
    check(got, data, 20)
    assert {r.cell for r in got if r.k == "d"} == {0}


def test_crowded_minute_in_a_long_span(spark):
    data = [("a", 0, 1), ("a", 10**15, 1)] + [("a", 5 * 10**14 + i, 1) for i in range(500)]
    got = cut(spark, data, 25).collect()
    check(got, data, 25)
    assert len({r.cell for r in got}) < 150


def test_cells_depend_on_rows_alone(spark):
    rng = random.Random(8)
    data = [("a", rng.randrange(10**9), 1) for _ in range(300)]
    one = {(r.at, r.cell) for r in cut(spark, data, 10).collect()}
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, at long, w long").repartition(7)
    two = {(r.at, r.cell) for r in cells.cut(df, ["k"], F.col("at"), F.col("w"), 10).collect()}
    assert one == two


def test_clashing_names(spark):
    df = spark.createDataFrame([("a", i, 1, 2, 3) for i in range(40)], "k string, _place long, _load long, cells long, _found long")
    got = cells.cut(df, ["k"], F.col("_place"), F.lit(1), 5, out="bucket")
    assert got.columns == [*df.columns, "bucket"]
    assert got.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 5


# lag

def plain(df, key, order, value):
    return df.withColumn("p", F.lag(value).over(Window.partitionBy(key).orderBy(F.asc_nulls_last(order))))


def events(spark, seed, n=600, kind="timestamp"):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    out = {}
    for i in range(n):
        key = rng.choice(["a", "a", "a", "b", "c", None])
        crowded = key == "a" and rng.random() < 0.7
        at = start + (dt.timedelta(microseconds=rng.randrange(10**4)) if crowded else dt.timedelta(minutes=rng.randrange(10**5)))
        out[key, at] = (key, at, rng.choice([None, float(i)]), i)
    out["c", None] = ("c", None, -1.0, n)
    out[None, None] = (None, None, -2.0, n + 1)
    return spark.createDataFrame(list(out.values()), f"k string, at {kind}, v double, i long")


@pytest.mark.parametrize("most", [1, 7, 60, 10**6])
def test_lag_in_cells_equals_lag(spark, most):
    df = events(spark, most)
    got = sequence.previous_in_cells(df, "k", "at", "v", "p", most=most)
    assert rows(got.select("i", "p")) == rows(plain(df, "k", "at", "v").select("i", "p"))


@pytest.mark.parametrize("kind, cast", [("date", "date"), ("int", "int"), ("long", "long")])
def test_lag_in_cells_over_other_orders(spark, kind, cast):
    rng = random.Random(3)
    pairs = {(rng.choice(["a", None]), rng.randrange(20000)) for _ in range(300)}
    df = spark.createDataFrame([(k, d, float(d)) for k, d in pairs], "k string, d int, v double")
    at = F.date_add(F.lit("2000-01-01").cast("date"), F.col("d")) if kind == "date" else F.col("d").cast(cast)
    df = df.select("k", at.alias("at"), "v")
    got = sequence.previous_in_cells(df, "k", "at", "v", "p", most=9)
    assert rows(got.select("k", "v", "p")) == rows(plain(df, "k", "at", "v").select("k", "v", "p"))


def test_lag_needs_an_order_that_can_be_cut(spark):
    df = spark.createDataFrame([("a", "x", 1.0)], "k string, at string, v double")
    with pytest.raises(ValueError):
        sequence.previous_in_cells(df, "k", "at", "v", "p")


def test_null_keys_have_predecessors(spark):
    """Across days as well: a null key is a key like any other."""
    df = spark.createDataFrame(
        [(None, dt.datetime(2024, 1, d, 9, tzinfo=dt.timezone.utc), float(d)) for d in (1, 2, 5)]
        + [("a", dt.datetime(2024, 1, d, 9, tzinfo=dt.timezone.utc), -float(d)) for d in (1, 3)],
        "k string, at timestamp, v double",
    )
    got = sequence.previous_value(df, "k", "at", "v", "p")
    assert {(r.v, r.p) for r in got.collect()} == {(1.0, None), (2.0, 1.0), (5.0, 2.0), (-1.0, None), (-3.0, -1.0)}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_lag_by_grains_with_merged_partitions(spark, parts):
    """Adaptive execution merges partitions of both sides of the union alike."""
    df = events(spark, 50 + parts).repartition(parts)
    for grains in (("day",), ("minute", "day")):
        got = sequence.previous_value(df, "k", "at", "v", "p", grains)
        assert rows(got.select("i", "p")) == rows(plain(df, "k", "at", "v").select("i", "p"))


# documents

TRADE = "source string, politician string, trade_date_raw string, size string"


def documents(spark, data, most):
    docs = nested.nest_trades(spark.createDataFrame(data, TRADE), most).collect()
    back = nested.explode_trades(
        spark.createDataFrame([(r.source, None, r.payload) for r in docs], "source string, extracted_at timestamp, payload string")
    )
    return docs, sorted((r.source, r.politician, r.trade_date_raw, r.size) for r in back.fillna("").collect())


def test_documents_keep_to_their_size(spark):
    rng = random.Random(2)
    data = [("s", f"P{rng.randrange(10**6)}", rng.choice([None, None, "3 Apr 2026", "4 May 2026"]), "x" * rng.randrange(30)) for _ in range(900)]
    data += [("s", "same", None, "y")] * 300 + [("t", "one", "3 Apr 2026", "z" * 3000)]
    docs, back = documents(spark, data, 1000)
    assert back == sorted(tuple(v or "" for v in r) for r in data)
    large = [d for d in docs if len(d.payload.encode()) > 1002]
    assert [d.source for d in large] == ["t"]
    assert len(docs) < 4 * sum(len(d.payload) for d in docs) / 1000


def test_small_months_are_one_document(spark):
    data = [("s", "a", "3 Apr 2026", "x"), ("s", "b", "4 Apr 2026", "x"), ("s", "c", None, "x"), ("t", "d", "4 Apr 2026", "x")]
    docs, _ = documents(spark, data, 10**6)
    assert len(docs) == 3


def test_documents_depend_on_rows_alone(spark):
    rng = random.Random(5)
    data = [("s", f"P{rng.randrange(200)}", None, str(i % 3)) for i in range(500)]
    one = {d.payload for d in documents(spark, data, 700)[0]}
    rng.shuffle(data)
    df = spark.createDataFrame(data, TRADE).repartition(9)
    assert {r.payload for r in nested.nest_trades(df, 700).collect()} == one


def test_bars_by_time_in_documents(spark):
    df = spark.createDataFrame(
        [("A", f"2026-04-{d:02d}T09:30:00", 1.0, 2.0, 0.5, 1.5, d) for d in (9, 3, 21)]
        + [("A", "2026-05-01T09:30:00", 1.0, 2.0, 0.5, None, None), ('q"', None, 1.0, 2.0, 0.5, None, 1)],
        "symbol string, ts string, open double, high double, low double, close double, volume long",
    )
    import json

    docs = [json.loads(r.payload) for r in nested.nest_bars(df).collect()]
    assert sorted((d["symbol"], [b["ts"] for b in d["bars"]]) for d in docs) == [
        ("A", ["2026-04-03T09:30:00", "2026-04-09T09:30:00", "2026-04-21T09:30:00"]), ("A", ["2026-05-01T09:30:00"]),
        ('q"', [None]),
    ]
    assert {d["interval"] for d in docs} == {"1h"}
