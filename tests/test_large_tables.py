"""Work that grows no faster than its tables: one parse, one trim, cheap comparisons."""

from pyspark.sql import functions as F

from orefold.operators import dedup, nested
from orefold.plans import silver
from orefold.streaming import incremental


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def written(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_payloads_are_judged_and_parsed_once(spark, tmp_path):
    """A filter on the reason neither parses the payload again nor makes it again."""
    rows = [("A", '{"bars": []}'), ("B", None), ("C", "["), ("D", '{"bars": [{"ts": "x"}]}')]
    raw = written(spark, str(tmp_path / "raw"), rows, "symbol string, payload string")
    parts = nested.split_raw(raw.withColumn("payload", F.concat("payload", F.lit(" "))), "bars")
    for part in parts:
        assert optimized(part).count("from_json(") == 1 and optimized(part).count("concat(") == 1
    assert [r.symbol for r in parts[0].collect()] == ["D"]
    assert {r.symbol: r.reason for r in parts[1].collect()} == {"A": "empty", "B": "missing", "C": "malformed"}


def test_payloads_are_trimmed_once(spark, tmp_path):
    rows = [("s", None, ' [{"ticker": "A"}] ')]
    raw = written(spark, str(tmp_path / "raw"), rows, "source string, extracted_at timestamp, payload string")
    trades = nested.explode_trades(raw)
    assert optimized(trades).count("trim(payload") == 1
    assert [r.ticker for r in trades.collect()] == ["A"]


def test_versions_are_sorted_by_a_hash_first(spark):
    """Names that begin alike would be compared column by column."""
    df = spark.range(10).select(F.concat(F.lit("Member 1"), F.col("id") % 3).alias("k"), "id", F.lit(1).alias("_hash"))
    latest = dedup.keep_latest(df, ["k"], "id")
    assert "xxhash64(k" in optimized(latest) and latest.columns == df.columns
    assert sorted(r.id for r in latest.collect()) == [7, 8, 9]


def test_a_first_batch_is_chosen_from_once(spark, tmp_path, monkeypatch):
    """Its rows are the latest already; a batch that meets older rows is chosen from again."""
    chosen = []
    whole = silver.latest_trades
    monkeypatch.setattr(silver, "latest_trades", lambda df: chosen.append(1) or whole(df))
    payload = '[{"politician": "P", "ticker": "A", "trade_date_raw": "2 Jan 2024", "tx_type": "buy", "price": "%s"}]'
    for n, price in enumerate(("$1", "$2"), 1):
        row = spark.createDataFrame([("s", payload % price)], "source string, payload string")
        stamped = row.withColumn("extracted_at", F.lit(f"2024-02-0{n}").cast("timestamp")).withColumn("extraction_date", F.to_date("extracted_at"))
        stamped.write.mode("append").partitionBy("extraction_date").parquet(str(tmp_path / "bronze"))
        incremental.advance_trades(spark, str(tmp_path / "bronze"), str(tmp_path / "root"))
        assert len(chosen) == 2 * n - 1
    dim = spark.createDataFrame([("A", "Tech")], "ticker string, sector string")
    assert [r.price for r in incremental.read_trades(spark, str(tmp_path / "root"), dim).collect()] == ["$2"]
