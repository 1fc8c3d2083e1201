import glob

import pytest
from pyspark.sql import functions as F

from builders import bar, dim, prices, random_price_docs, rows, trade, trades, weights
from orefold import fixed_values as fixed
from orefold import schemas
from orefold.operators import joins, nested, quality
from orefold.plans import build, dimension, ingest, silver
from orefold.sources import bronze, dimension as dim_source, tables
from orefold.streaming import incremental

CELLS = (
    "source string, politician string, party string, chamber string, state string, issuer string, "
    "ticker_raw string, traded_raw string, filed_after_raw string, owner string, tx_type string, "
    "size string, price string"
)
BARS = "symbol string, ts string, open double, high double, low double, close double, volume double"


def cells(spark):
    return spark.createDataFrame(
        [
            ("s", " P One\n", "Blue", "House", "NY", "Aaa", "AAA:US", " 22 Apr \n 2026\n x",
             "filed 35 days", "Self", " BUY", "1K–15K", " "),
            ("s", "", None, None, None, None, None, "\n", "none", None, None, None, None),
        ],
        CELLS,
    )


def test_normalise_trades(spark):
    a, b = sorted(ingest.normalise_trades(cells(spark)).collect(), key=lambda r: r.politician is None)
    assert tuple(a) == (
        "s", "P One", "Blue", "House", "NY", "Aaa", "AAA", "22 Apr 2026", 35, "Self", "buy",
        "1K–15K", None,
    )
    assert tuple(b) == ("s",) + (None,) * 9 + ("",) + (None,) * 2


def test_lookback_is_separate_from_ingest(spark):
    records = ingest.normalise_trades(cells(spark))
    assert ingest.within_lookback(records, "2026-06-06").count() == 1
    assert ingest.within_lookback(records, "2026-06-07").count() == 0


def test_ingest_round_trip_through_bronze(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = spark.createDataFrame(
        [
            ("BRK.B", "2026-04-22T09:30:00-04:00", 1.0, 2.0, 0.5, float("nan"), float("nan")),
            ("BRK.B", "2026-04-22T10:30:00-04:00", 1.0, 2.0, 0.5, 1.5, 70.0),
            ("XXX", "2026-04-22T10:30:00-04:00", 1.0, 2.0, 0.5, 1.5, 70.0),
        ],
        BARS,
    )
    watched = dim_source.watchlist(spark)
    for run in ("2026-04-22 20:00:00", "2026-04-23 20:00:00"):
        docs, summary = ingest.counted(ingest.ingest_bars(raw, watched), docs=F.count("payload"))
        bronze.append_raw(docs, path, run)
        assert summary.get == {"rows": 1, "docs": 1}
    landed = bronze.read_raw_prices(spark, path)
    assert landed.count() == 2
    assert {str(r.extraction_date) for r in landed.collect()} == {"2026-04-22", "2026-04-23"}
    got = silver.silver_stock_prices(landed, dim(spark, ("BRK.B", "Berk", "Fin")))
    assert [(r.symbol, r.sector, r.close, r.volume) for r in got.collect()] == [
        ("BRK.B", "Fin", 1.5, 70)
    ]
    missing = {r.symbol for r in ingest.without_data(watched, raw).collect()}
    assert missing == set(fixed.WATCHLIST) - {"BRK.B"}


def test_ingest_trades_keeps_every_record(spark):
    docs = ingest.ingest_trades(cells(spark)).collect()
    payloads = "".join(d.payload for d in docs)
    assert payloads.count('"politician"') == cells(spark).count()
    assert '{"politician":"P One"' in payloads and '"politician":null' in payloads


def test_an_infinite_volume_goes_to_quarantine(spark, tmp_path):
    path, aside = str(tmp_path / "raw"), str(tmp_path / "aside")
    at = "2026-04-22T09:30:00-04:00"
    raw = spark.createDataFrame(
        [
            ("AAA", at, 1.0, 2.0, 0.5, 1.5, 70.0), ("BBB", at, 1.0, 2.0, 0.5, 1.5, float("inf")),
            ("CCC", at, 1.0, 2.0, 0.5, 1.5, 1e30), (None, at, 1.0, 2.0, 0.5, 1.5, 1.0),
            ("DDD", None, 1.0, 2.0, 0.5, 1.5, float("nan")),
        ],
        BARS,
    )
    assert ingest.normalise_bars(raw).where("volume is null").count() == 3
    watched = dim_source.watchlist(spark, ["AAA", "BBB", "ZZZ"])
    got = ingest.land_bars(raw, path, aside, "2026-04-22 20:00:00", watched)
    assert got == {"rows": 1, "failed": 4, "missing": 1}
    assert [r.symbol for r in bronze.read_raw_prices(spark, path).collect()] == ["AAA"]
    kept = spark.read.parquet(aside)
    assert sorted((r.symbol or "", r.reason) for r in kept.collect()) == [
        ("", "no symbol"), ("BBB", "bad volume"), ("CCC", "bad volume"), ("DDD", "no time"),
    ]
    nothing = ingest.land_bars(raw.where("false"), path, aside, "2026-04-23 20:00:00")
    assert nothing == {"rows": 0, "failed": 0}


def test_broken_payloads_stop_nothing(spark, tmp_path):
    path, aside = str(tmp_path / "raw"), str(tmp_path / "aside")
    at = "2026-04-22T12:00:00+00:00"
    raw = prices(
        spark, ("AAA", at, [bar("2026-04-22T09:30:00", 9.0)]), ("BBB", at, "{oops"), ("CCC", at, None)
    )
    assert ingest.land(raw, "bars", path, aside) == {"rows": 1, "failed": 2}
    assert silver.silver_stock_prices(bronze.read_raw_prices(spark, path), dim(spark)).count() == 1
    assert sorted(r.reason for r in spark.read.parquet(aside).collect()) == ["malformed", "missing"]


def test_raw_tables_are_created_once(spark):
    for _ in range(2):
        bronze.create_raw_tables(spark, "bronze_db")
    docs = spark.createDataFrame([("AAA", "{}")], "symbol string, payload string")
    for run in ("2026-04-22 20:00:00", "2026-04-22 21:00:00"):
        bronze.append_raw_table(docs, "bronze_db.raw_stock_prices", run)
    assert spark.table("bronze_db.raw_stock_prices").count() == 2
    assert spark.table("bronze_db.raw_congress_trades").count() == 0


# dimension

def published(spark, *data):
    return spark.createDataFrame(
        list(data), "symbol string, security string, gics_sector string, position int"
    )


def test_build_from_the_list(spark):
    got = dimension.build_sector_dim(
        published(
            spark,
            (" brk.b\n", " Berkshire, Inc. ", "Financials", 2),
            ("BRK.B", "again", "Energy", 3),
            ("AAPL", "Apple", "Information Technology", 1),
            ("A1", "digit", "Energy", 4),
            ("TOOLONGX", "long", "Energy", 5),
            ("NEW", "New", "Space", 6),
            (None, "none", "Energy", 7),
        )
    )
    assert [tuple(r) for r in got.collect()] == [
        ("AAPL", "Apple", "Tech"), ("BRK.B", "Berkshire  Inc.", "Financials"), ("NEW", "New", "Space"),
    ]
    quality.gate(got, quality.DIM_SECTORS)
    assert rows(dimension.sector_counts(got)) == [("Financials", 1), ("Space", 1), ("Tech", 1)]


def test_backfill_of_traded_tickers(spark):
    records = [
        trade(ticker=t)
        for t in ("AAA", "NEW", "BF.B", "NONAME", "NOSEC", "NOTHING", "ABSENT", "EMPTY")
    ]
    records.append(trade(ticker="OLD", trade_date_raw="1 Jan 2026"))
    traded = silver.silver_congress_trades(
        trades(spark, ("2026-04-23T00:00:00+00:00", records)), dim(spark)
    )
    info = spark.createDataFrame(
        [
            ("AAA", "Energy", "wrong", None), ("NEW", "Information Technology", "", "New, Inc"),
            ("BF-B", "Consumer Staples", "Brown", "x"), ("NONAME", "Space", None, None),
            ("NOSEC", None, "No Sector", None), ("NOTHING", None, None, None),
            ("EMPTY", "", "", ""), ("OLD", "Energy", "Old", None),
        ],
        schemas.COMPANY_INFO,
    )
    base = published(spark, ("AAA", "Aaa", "Energy", 1))
    unknown = dimension.recent_unknown_tickers(
        traded, dimension.build_sector_dim(base), "2026-05-01"
    )
    assert [r.ticker for r in unknown.collect()] == [
        "ABSENT", "BF.B", "EMPTY", "NEW", "NONAME", "NOSEC", "NOTHING",
    ]
    got = dimension.build_sector_dim(base, traded, info, "2026-05-01")
    assert [tuple(r) for r in got.collect()] == [
        ("AAA", "Aaa", "Energy"), ("BF.B", "Brown", "Staples"), ("NEW", "New  Inc", "Tech"),
        ("NONAME", "", "Space"), ("NOSEC", "No Sector", "Other"),
    ]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "dim")
    data = [("B", 'Quote " and, comma', "X"), ("A", "Café – O’Neil", "Y")]
    dim_source.write_dim_csv(dim(spark, *data), path)
    (file,) = glob.glob(f"{path}/part-*.csv")
    with open(file, encoding="utf-8", newline="") as f:
        assert f.read() == (
            '"ticker","company_name","sector"\n"A","Café – O’Neil","Y"\n'
            '"B","Quote "" and, comma","X"\n'
        )
    assert rows(dim_source.read_dim_csv(spark, path)) == sorted(data)


def test_weights(spark):
    assert dim_source.weights(spark).count() == 110
    assert rows(dim_source.weights(spark, {"A": 5})) == [("A", 5)]


# full and incremental builds

def test_full_refresh_swaps_when_complete(spark, tmp_path):
    root = str(tmp_path)
    one = spark.range(3)
    assert tables.full_refresh(one, "swap_me", root, "r1").count() == 3
    reader = spark.table("swap_me")
    tables.full_refresh(spark.range(5), "swap_me", root, "r2")
    assert (reader.count(), spark.table("swap_me").count()) == (3, 5)


def inputs(spark):
    raw_prices = prices(spark, *random_price_docs(8))
    raw_trades = trades(
        spark, ("2026-04-23T00:00:00+00:00", [trade(), trade(ticker="BBB", size="50M+")])
    )
    sectors = dim(spark, *[(s, s, "X") for s in ("A", "B", "C", "AAA")])
    return raw_prices, raw_trades, sectors, weights(spark, A=3, B=5, E=1)


def test_build_all(spark, tmp_path):
    raw_prices, raw_trades, sectors, caps = inputs(spark)
    out = build.build_all(
        spark, raw_prices, raw_trades, sectors, caps, str(tmp_path), "r1", "2026-05-01", "full_db"
    )
    assert set(out) == {
        "silver_stock_prices", "silver_congress_trades", "gold_sector_hourly_perf",
        "gold_sector_congress_buys_30d",
    }
    want = silver.silver_stock_prices(raw_prices, sectors)
    assert rows(spark.table("full_db.silver_stock_prices").select(want.columns)) == rows(want)
    assert spark.table("full_db.gold_sector_hourly_perf").count() > 0
    assert rows(out["gold_sector_congress_buys_30d"].select("sector", "n_trades")) == [
        ("Other", 1), ("X", 1),
    ]


def test_build_stops_on_a_repeated_dimension_key(spark, tmp_path):
    raw_prices, raw_trades, sectors, caps = inputs(spark)
    with pytest.raises(quality.DataQualityError, match=r"dim_sectors: unique\(ticker\)"):
        build.build_all(
            spark, raw_prices, raw_trades, sectors.unionByName(sectors), caps, str(tmp_path), "r1"
        )
    with pytest.raises(quality.DataQualityError, match="disclosure_lag_days"):
        late = trades(spark, ("2026-04-23T00:00:00+00:00", [trade(filed_after_days=-1)]))
        build.build_all(spark, raw_prices, late, sectors, caps, str(tmp_path), "r2")


def test_build_all_of_an_empty_extraction(spark, tmp_path):
    _, _, sectors, caps = inputs(spark)
    raw_prices = prices(spark, ("AAA", "2026-04-23T00:00:00+00:00", []))
    raw_trades = trades(spark, ("2026-04-23T00:00:00+00:00", []))
    out = build.build_all(
        spark, raw_prices, raw_trades, sectors, caps, str(tmp_path), "r1", "2026-05-01", "empty_db"
    )
    assert {name: df.count() for name, df in out.items()} == dict.fromkeys(out, 0)
    assert "close" in spark.table("empty_db.silver_stock_prices").columns


def test_a_repeated_reference_key_is_refused(spark):
    sectors = dim(spark)
    joins.size_checked(sectors, key="ticker")
    with pytest.raises(joins.RepeatedKeyError, match="ticker"):
        joins.size_checked(sectors.unionByName(sectors), key="ticker")


def land(raw, path):
    raw.withColumn("extraction_date", F.to_date("extracted_at")).coalesce(1).write.mode(
        "append"
    ).partitionBy("extraction_date").parquet(path)


@pytest.mark.parametrize("max_files", [None, 2])
def test_incremental_prices_equal_a_full_rebuild(spark, tmp_path, max_files):
    path, root = str(tmp_path / "raw"), str(tmp_path / "store")
    docs = random_price_docs(11, n_docs=45)
    sectors = dim(spark, *[(s, s, "X") for s in "ABC"])
    for start in range(0, 45, 15):  # extraction times are random, so old versions arrive late
        land(prices(spark, *docs[start : start + 15]), path)
        incremental.advance_prices(spark, path, root, max_files=max_files)
        full = silver.silver_stock_prices(bronze.read_raw_prices(spark, path), sectors)
        assert rows(incremental.read_prices(spark, root, sectors)) == rows(full)
    incremental.advance_prices(spark, path, root)  # nothing new
    assert rows(incremental.read_prices(spark, root, sectors)) == rows(full)
    old = incremental.superseded(spark, root).count()
    assert old > 0 and incremental.expire(spark, root) == old
    assert rows(incremental.read_prices(spark, root, sectors)) == rows(full)


def test_incremental_reads_before_the_first_batch(spark, tmp_path):
    root = str(tmp_path / "store")
    assert incremental.read_prices(spark, root, dim(spark)).count() == 0
    assert incremental.read_trades(spark, root, dim(spark)).columns == list(schemas.SILVER_TRADES)
    assert incremental.superseded(spark, root).count() == 0


def test_a_batch_reads_only_the_days_it_touches(spark, tmp_path):
    path, root = str(tmp_path / "raw"), str(tmp_path / "store")
    at = "2026-04-{:02d}T12:00:00+00:00"
    for d in (21, 22, 23):
        land(prices(spark, ("AAA", at.format(d), [bar(f"2026-04-{d}T09:30:00", float(d))])), path)
        incremental.advance_prices(spark, path, root)
    # the days that are not touched may even be gone: nothing opens them
    for d in (21, 22):
        for folder in (tmp_path / "store/bars").glob(f"version=*/bar_date=2026-04-{d}"):
            folder.rename(tmp_path / f"moved-{d}")
    land(prices(spark, ("BBB", at.format(23), [bar("2026-04-23T10:30:00", 1.0)])), path)
    incremental.advance_prices(spark, path, root)
    for d in (21, 22):
        (tmp_path / f"moved-{d}").rename(next((tmp_path / "store/bars").glob(f"version={d - 21}")) / f"bar_date=2026-04-{d}")
    assert incremental.read_prices(spark, root, dim(spark)).count() == 4


def test_incremental_null_close_is_remembered(spark, tmp_path):
    path, root = str(tmp_path / "raw"), str(tmp_path / "store")
    ts = "2026-04-22T09:30:00"
    for at, close in (("2026-04-22T12:00:00+00:00", None), ("2026-04-22T11:00:00+00:00", 9.0)):
        land(prices(spark, ("AAA", at, [bar(ts, close)])), path)
        incremental.advance_prices(spark, path, root)
        assert incremental.read_prices(spark, root, dim(spark)).count() == 0


def test_incremental_batch_can_be_replayed(spark, tmp_path):
    """A version folder left by a batch that died does not reach the result."""
    path, root = str(tmp_path / "raw"), str(tmp_path / "store")
    land(prices(spark, ("AAA", "2026-04-22T11:00:00+00:00", [bar("2026-04-22T09:30:00", 9.0)])), path)
    incremental.advance_prices(spark, path, root)
    left = nested.type_bars(nested.explode_bars(
        prices(spark, ("BAD", "2026-04-22T11:00:00+00:00", [bar("2026-04-22T09:30:00", 1.0)]))
    )).withColumn("bar_date", F.to_date("bar_ts"))
    left.write.partitionBy("bar_date").parquet(f"{root}/bars/version=1")
    land(prices(spark, ("BBB", "2026-04-22T12:00:00+00:00", [bar("2026-04-22T10:30:00", 8.0)])), path)
    incremental.advance_prices(spark, path, root)
    full = silver.silver_stock_prices(bronze.read_raw_prices(spark, path), dim(spark))
    assert rows(incremental.read_prices(spark, root, dim(spark))) == rows(full)


def test_incremental_trades_equal_a_full_rebuild(spark, tmp_path):
    path, root = str(tmp_path / "raw"), str(tmp_path / "store")
    runs = [
        ("2026-04-23T00:00:00+00:00", [trade(price="1"), trade(trade_date_raw="1 Apr 2026")]),
        ("2026-04-25T00:00:00+00:00", [trade(price="3"), trade(ticker="BBB")]),
        ("2026-04-24T00:00:00+00:00", [trade(price="2"), trade(trade_date_raw="x")]),
    ]
    for run in runs:
        land(trades(spark, run), path)
        incremental.advance_trades(spark, path, root)
    full = silver.silver_congress_trades(bronze.read_raw_trades(spark, path), dim(spark))
    got = incremental.read_trades(spark, root, dim(spark))
    assert rows(got) == rows(full) and got.count() == 3


def test_session_is_checked(spark):
    from orefold.session import configure, require_session, shared_folder

    assert shared_folder(spark).endswith("/shared")
    for key, value in (("spark.sql.session.timeZone", "Asia/Tokyo"), ("spark.sql.ansi.enabled", "false")):
        spark.conf.set(key, value)
        with pytest.raises(ValueError):
            require_session(spark)
        configure(spark)
    configure(spark, shuffle_bytes=2**40)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(key) == str(2**40 // 2**27)
    spark.conf.unset(key)
