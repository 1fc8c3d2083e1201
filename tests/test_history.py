"""Validity of versions, tables as of a time, and reference joins with hot keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from builders import dim, price_doc, random_price_docs, rows, weights
from orefold import schemas
from orefold.operators import history, joins
from orefold.plans import gold, silver

UTC = dt.timezone.utc


def at(hour, day=1):
    return dt.datetime(2026, 4, day, hour, tzinfo=UTC)


def table(spark, data):
    return spark.createDataFrame(data, "k string, j long, at timestamp, v long")


@pytest.mark.parametrize("most", [2, 10**6])
def test_versions_follow_one_another(spark, most):
    data = [("a", 1, at(h), h) for h in (3, 9, 5, 21)] + [("a", 2, at(4), 1), (None, None, at(2), 7), (None, None, at(6), 8)]
    data += [("a", 1, at(9), 1), ("b", 1, None, 9)]  # a tie, and a row without a time
    got = history.versions(table(spark, data), ["k", "j"], "at", most=most)
    utc = lambda x: x and x.replace(tzinfo=UTC) if x and x.tzinfo is None else x
    found = {(r.k, r.j, utc(r.valid_from), utc(r.valid_to), r.v) for r in got.collect()}
    assert found == {
        ("a", 1, at(3), at(5), 3), ("a", 1, at(5), at(9), 5), ("a", 1, at(9), at(21), 9), ("a", 1, at(21), None, 21),
        ("a", 2, at(4), None, 1), (None, None, at(2), at(6), 7), (None, None, at(6), None, 8),
    }


def test_as_of_each_run_equals_a_rebuild(spark):
    """Gold as of every extraction time, and from the bronze of that time."""
    docs = random_price_docs(4, 24)
    raw = spark.createDataFrame([price_doc(*d) for d in docs], schemas.RAW_PRICES)
    sectors, caps = dim(spark, ("A", "a", "Tech"), ("B", "b", "Tech"), ("C", "c", "Energy")), weights(spark, A=3, B=1, C=2)
    versions = history.versions(silver.bars(raw), silver.BAR_KEY, "extracted_at")
    times = sorted({d[1] for d in docs})
    for time in (times[0], times[len(times) // 2], times[-1]):
        then = silver.describe_bars(history.as_of(versions, time), sectors)
        bronze = raw.where(F.col("extracted_at") <= F.lit(time).cast("timestamp"))
        want = silver.silver_stock_prices(bronze, sectors)
        assert rows(then) == rows(want)
        assert rows(gold.sector_hourly_perf(then, caps)) == rows(gold.sector_hourly_perf(want, caps))


def test_facts_meet_the_version_of_their_time(spark):
    versions = history.versions(
        table(spark, [("a", 1, at(3), 30), ("a", 1, at(9), 90), (None, 1, at(1), 10)]), ["k", "j"], "at"
    )
    facts = spark.createDataFrame(
        [("a", 1, at(2), 0), ("a", 1, at(3), 1), ("a", 1, at(8), 2), ("a", 1, at(20), 3), (None, 1, at(5), 4), ("z", 1, at(5), 5)],
        "k string, j long, then timestamp, _0 int",
    )
    got = history.known_then(facts, versions, ["k", "j"], "then", ["v"])
    assert got.columns == ["k", "j", "then", "_0", "v"]
    assert {r["_0"]: r.v for r in got.collect()} == {0: None, 1: 30, 2: 30, 3: 90, 4: 10, 5: None}


# reference joins

@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("share", [0.0, 0.05, 0.4, 2.0])
def test_large_reference_join_equals_a_plain_join(spark, how, share):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 1, 1, 1, 2, 3, rng.randrange(50)]), i) for i in range(300)]
    fact = spark.createDataFrame(data, "k long, i long")
    side = spark.createDataFrame([(k, f"n{k}", k * 2) for k in range(0, 50, 2)] + [(1, "one", 9)], "id long, name string, m long")
    got = joins.attach_large(fact, side, "k", "id", how, share)
    want = joins.attach(fact, side, "k", "id", how)
    assert rows(got.select(*want.columns)) == rows(want)


def test_hot_facts_are_not_shuffled(spark):
    fact = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("long").alias("k"))
    side = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("m"))
    text = joins.attach_large(fact, side, "k", "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    with pytest.raises(ValueError):
        joins.attach_large(fact, side, "k", "key", "full")
