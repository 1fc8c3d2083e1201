import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from builders import (
    TRADE, bar, dim, prices, random_price_docs, rows, trade, trades, weights,
)
from orefold import schemas
from orefold.operators import quality
from orefold.plans import gold, serving, silver

AT1, AT2 = "2026-04-22T10:00:00+00:00", "2026-04-22T11:00:00+00:00"
AS_OF = "2026-05-01"


# silver prices

def test_latest_extraction_wins(spark):
    raw = prices(
        spark,
        ("AAA", AT2, [bar("2026-04-22T09:30:00-04:00", 11.0)]),
        ("AAA", AT1, [bar("2026-04-22T09:30:00-04:00", 10.0), bar("2026-04-22T10:30:00-04:00", 12.0)]),
        ("ZZZ", AT1, [bar("2026-04-22T09:30:00-04:00", 5.0)]),
    )
    got = silver.silver_stock_prices(raw, dim(spark))
    assert got.columns == list(schemas.SILVER_PRICES)
    assert rows(got.select("symbol", "company_name", "sector", "bar_ts", "close")) == [
        ("AAA", "Aaa Inc", "Tech", dt.datetime(2026, 4, 22, 9, 30), 11.0),
        ("AAA", "Aaa Inc", "Tech", dt.datetime(2026, 4, 22, 10, 30), 12.0),
        ("ZZZ", None, None, dt.datetime(2026, 4, 22, 9, 30), 5.0),
    ]


def test_latest_null_close_hides_an_older_value(spark):
    raw = prices(
        spark,
        ("AAA", AT1, [bar("2026-04-22T09:30:00", 10.0)]),
        ("AAA", AT2, [bar("2026-04-22T09:30:00", None)]),
    )
    assert silver.silver_stock_prices(raw, dim(spark)).count() == 0


def test_silver_does_not_depend_on_the_order_of_bronze(spark):
    docs = random_price_docs(3)
    docs += [(s, at, list(reversed(b))) for s, at, b in docs[:10]]  # ties in extracted_at
    want = rows(silver.silver_stock_prices(prices(spark, *docs), dim(spark)))
    random.Random(5).shuffle(docs)
    got = silver.silver_stock_prices(prices(spark, *docs).repartition(7), dim(spark))
    assert rows(got) == want
    quality.gate(got, quality.SILVER_PRICES)


def test_replay_changes_nothing_in_gold(spark):
    docs = random_price_docs(4)
    later = [(s, at.replace("2026-04", "2026-05"), b) for s, at, b in docs]
    caps = weights(spark, A=3, B=5, C=2)
    sectors = dim(spark, *[(s, s, "X") for s in "ABCD"])

    def perf(raw):
        out = gold.sector_hourly_perf(silver.silver_stock_prices(raw, sectors), caps)
        return rows(out.withColumn("sector_pct_change", F.round("sector_pct_change", 9)))

    once = prices(spark, *docs)
    # ties between extractions are settled by value, so replay the settled state
    assert perf(once.unionByName(prices(spark, *docs))) == perf(once)
    replayed = prices(spark, *later)
    assert perf(replayed.unionByName(once)) == perf(replayed)


# silver trades

def silver_of(spark, *runs):
    return silver.silver_congress_trades(trades(spark, *runs), dim(spark))


def test_trade_columns_and_values(spark):
    got = silver_of(spark, (AT1, [trade(ticker="aaa", filed_after_days=46)]))
    assert got.columns == list(schemas.SILVER_TRADES)
    r = got.first()
    assert (r.member, r.chamber, r.party, r.ticker, r.txn_type) == (
        "P One", "house", "blue", "AAA", "buy",
    )
    assert (r.sector, r.trade_date, r.report_date) == (
        "Tech", dt.date(2026, 4, 22), dt.date(2026, 6, 7),
    )
    assert (r.disclosure_lag_days, r.is_late_disclosure, r.est_trade_value_usd) == (46, True, 8000)


def test_trades_without_ticker_or_date_are_dropped(spark):
    records = [trade(ticker=t) for t in (None, "", "--", "n/a", "N/A")]
    records += [trade(trade_date_raw=t) for t in (None, "Yesterday", "31 Feb 2026")]
    assert silver_of(spark, (AT1, records + [None])).count() == 0


def test_filters_come_before_the_choice_of_the_latest(spark):
    got = silver_of(
        spark, (AT1, [trade(issuer="old")]), (AT2, [trade(issuer="new", trade_date_raw="x")])
    )
    assert [r.issuer for r in got.collect()] == ["old"]


def test_same_key_collapses_and_null_members_group(spark):
    got = silver_of(
        spark,
        (AT1, [trade(owner="Self"), trade(owner="Spouse"), trade(politician=None, price="1")]),
        (AT2, [trade(politician=None, price="2"), trade(size="50M+")]),
    )
    assert rows(got.select("member", "owner", "price", "txn_value_band")) == [
        ("P One", "Self", TRADE["price"], "50M+"),
        ("P One", "Spouse", TRADE["price"], "1K–15K"),
        (None, "Self", "2", "1K–15K"),
    ]


def test_unknown_lag_counts_as_none(spark):
    r = silver_of(spark, (AT1, [trade(filed_after_days=None)])).first()
    assert r.disclosure_lag_days is None and r.report_date == r.trade_date
    assert r.is_late_disclosure is False


# gold

def silver_prices(spark, *bars):
    data = [
        (s, s, sector, dt.datetime.fromisoformat(ts), 1.0, 1.0, 1.0, close, 1,
         dt.datetime(2026, 5, 1))
        for s, sector, ts, close in bars
    ]
    return spark.createDataFrame(
        data,
        "symbol string, company_name string, sector string, bar_ts timestamp_ntz, open double, "
        "high double, low double, close double, volume bigint, extracted_at timestamp",
    )


def test_hourly_perf(spark):
    prices_ = silver_prices(
        spark,
        ("A", "X", "2026-04-21 15:30", 100.0),
        ("A", "X", "2026-04-24 09:30", 110.0),  # predecessor three days back
        ("B", "X", "2026-04-24 09:30", 50.0),   # first bar
        ("B", "X", "2026-04-24 10:30", 0.0),
        ("B", "X", "2026-04-24 11:30", 5.0),    # zero base
        ("A", "X", "2026-04-24 11:30", 121.0),
        ("C", "X", "2026-04-24 09:30", 1.0),
        ("C", "X", "2026-04-24 11:30", 2.0),    # no weight
        ("D", None, "2026-04-24 09:30", 1.0),
        ("D", None, "2026-04-24 11:30", 2.0),   # no sector
    )
    got = gold.sector_hourly_perf(prices_, weights(spark, A=3, B=1, D=9))
    assert [
        (r.bar_ts, r.sector, round(r.sector_pct_change, 9), r.n_tickers)
        for r in serving.hourly_perf_report(got).collect()
    ] == [
        # the null return on a zero base: no numerator, but weight and symbol count
        (dt.datetime(2026, 4, 24, 11, 30), "X", round(0.1 * 3 / 4, 9), 2),
        (dt.datetime(2026, 4, 24, 10, 30), "X", -1.0, 1),
        (dt.datetime(2026, 4, 24, 9, 30), "X", 0.1, 1),
    ]


def silver_trades(spark, *records):
    base = dict(
        source="s", member="m", chamber="house", party="blue", state="NY", issuer="i",
        ticker="AAA", sector="Tech", owner="Self", txn_type="buy",
        trade_date=dt.date(2026, 4, 22), report_date=dt.date(2026, 4, 25),
        disclosure_lag_days=3, is_late_disclosure=False, txn_value_band="1K–15K",
        est_trade_value_usd=8000, price="$1", extracted_at=dt.datetime(2026, 5, 1),
    )
    schema = (
        "source string, member string, chamber string, party string, state string, issuer string, "
        "ticker string, sector string, owner string, txn_type string, trade_date date, "
        "report_date date, disclosure_lag_days int, is_late_disclosure boolean, "
        "txn_value_band string, est_trade_value_usd int, price string, extracted_at timestamp"
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in records], schema)


def test_buys_mix_history_and_window(spark):
    old = dict(trade_date=dt.date(2026, 1, 5), report_date=dt.date(2026, 4, 1))
    got = gold.sector_buys_30d(
        silver_trades(
            spark,
            {},
            {**old, "disclosure_lag_days": 86, "is_late_disclosure": True},
            {"txn_type": "sell"},
            {"sector": None, "trade_date": dt.date(2026, 3, 1), "report_date": dt.date(2026, 3, 31)},
            {"sector": "N", "est_trade_value_usd": None, "disclosure_lag_days": None},
        ),
        AS_OF,
    )
    assert [tuple(r) for r in serving.buys_report(got).collect()] == [
        # the report date 2026-04-01 is the first day of the window
        ("Tech", 2, 16000, 16000, 8000, 44.5, 1),
        ("Other", 1, 8000, 0, 0, 3.0, 0),
        ("N", 1, None, None, None, None, 0),
    ]
    quality.gate(got, quality.SECTOR_BUYS_30D)


# serving

def gold_perf(spark, *data):
    return spark.createDataFrame(
        [(dt.datetime.fromisoformat(t), s, r, 1) for t, s, r in data],
        "bar_ts timestamp_ntz, sector string, sector_pct_change double, n_tickers bigint",
    )


def test_daily_perf(spark):
    got = serving.sector_daily_perf(
        gold_perf(
            spark,
            ("2026-04-01 00:00", "X", 0.1), ("2026-04-01 15:30", "X", 0.2),
            ("2026-04-01 15:30", "X", -0.99), ("2026-04-02 09:30", "X", None),
            ("2026-03-31 23:59", "X", 0.5), ("2026-04-02 09:30", "A", 0.25),
        ),
        AS_OF,
    )
    assert [(r.trade_date, r.sector, round(r.pct_change, 9)) for r in got.collect()] == [
        (dt.date(2026, 4, 1), "X", 0.32), (dt.date(2026, 4, 2), "A", 0.25),
        (dt.date(2026, 4, 2), "X", 0.0),
    ]


def test_stock_daily_perf_reads_further_back_than_it_shows(spark):
    prices_ = silver_prices(
        spark,
        ("BRK.B", "X", "2026-03-27 00:00", 40.0),  # read, not shown
        ("BRK.B", "X", "2026-04-01 10:00", 49.0),
        ("BRK.B", "X", "2026-04-01 15:00", 50.0),
        ("BRK.B", "X", "2026-04-03 15:00", 75.0),
        ("OLD", "X", "2026-03-26 23:00", 1.0),     # not read
        ("OLD", "X", "2026-04-01 10:00", 2.0),     # so this has no predecessor
        ("NOS", None, "2026-04-01 10:00", 2.0),
        ("NOS", None, "2026-04-02 10:00", 2.0),
    )
    got = serving.stock_daily_perf(prices_, AS_OF)
    url = "https://finance.yahoo.com/quote/BRK-B"
    assert [tuple(r) for r in got.collect()] == [
        ("BRK.B", "BRK.B", "X", dt.date(2026, 4, 3), 75.0, 0.5, url),
        ("BRK.B", "BRK.B", "X", dt.date(2026, 4, 1), 50.0, 0.25, url),
    ]


def test_trades_30d(spark):
    got = serving.trades_30d(
        silver_trades(
            spark, {"sector": None}, {"trade_date": dt.date(2026, 3, 31)},
            {"trade_date": dt.date(2026, 4, 1), "ticker": "--"},
        ),
        AS_OF,
    )
    assert got.columns == list(serving.TRADE_COLUMNS)
    assert [(r.sector, r.trade_date.day, r.yahoo_url) for r in got.collect()] == [
        ("Other", 22, "https://finance.yahoo.com/quote/AAA"), ("Tech", 1, None),
    ]


def test_late_filings_is_a_top_k(spark):
    late = [
        {"report_date": dt.date(2026, 1, 1) + dt.timedelta(days=i), "is_late_disclosure": i % 2 == 0}
        for i in range(60)
    ]
    got = serving.late_filings(silver_trades(spark, *late))
    assert got.columns == list(serving.LATE_COLUMNS)
    days = [r.report_date for r in got.collect()]
    assert len(days) == 25 and days == sorted(days, reverse=True)
    assert days[0] == dt.date(2026, 2, 28)
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


def window(spark):
    return serving.trades_30d(
        silver_trades(
            spark,
            {"est_trade_value_usd": None}, {"est_trade_value_usd": 8000},
            {"est_trade_value_usd": 75000, "sector": None}, {"txn_type": "sell"},
            {"est_trade_value_usd": 15000, "sector": "Energy"},
        ),
        AS_OF,
    )


@pytest.mark.parametrize(
    ("sectors", "minimum", "want"),
    [
        (None, 0, [("Other", 1, 75.0), ("Energy", 1, 15.0), ("Tech", 2, 8.0)]),
        (None, 15000, [("Other", 1, 75.0), ("Energy", 1, 15.0)]),
        (["Tech"], 0, [("Tech", 2, 8.0)]),
        ([], 0, []),
    ],
)
def test_buys_by_sector(spark, sectors, minimum, want):
    trades_ = window(spark)
    got = serving.buys_by_sector_filtered(trades_, sectors, minimum)
    assert [tuple(r) for r in got.collect()] == want
    listed = serving.trades_filtered(trades_, sectors, minimum)
    assert listed.count() == sum(n for _, n, _ in want)


def test_trades_filtered_puts_unknown_sizes_last(spark):
    got = serving.trades_filtered(window(spark))
    assert [r.est_trade_value_usd for r in got.collect()] == [75000, 15000, 8000, None]


def test_totals(spark):
    perf = serving.sector_daily_perf(
        gold_perf(spark, ("2026-04-01 10:00", "X", 0.1), ("2026-04-02 10:00", "Y", 0.1)), AS_OF
    )
    assert tuple(serving.dashboard_totals(perf, window(spark)).first()) == (2, 98000)
    none = window(spark).filter("txn_type = 'sell'")
    assert tuple(serving.dashboard_totals(perf, none).first()) == (2, None)


def test_filtered_reports(spark):
    perf = serving.sector_daily_perf(
        gold_perf(spark, ("2026-04-01 10:00", "X", 0.1), ("2026-04-02 10:00", None, 0.1)), AS_OF
    )
    assert serving.sector_perf_filtered(perf, ["X"]).count() == 1
    assert serving.sector_perf_filtered(perf).count() == 2
    assert serving.sector_perf_filtered(perf, []).count() == 0
    assert rows(serving.pass_through(perf)) == rows(perf)
    stocks = serving.stock_daily_perf(
        silver_prices(
            spark, *[(s, "X", f"2026-04-{d:02d} 10:00", float(d)) for s in "AB" for d in (1, 2, 3)]
        ),
        AS_OF,
    )
    assert rows(serving.tickers_in_sectors(stocks, ["X"])) == [("A", "A"), ("B", "B")]
    assert serving.ticker_perf_filtered(stocks, ["X"], ["B"]).count() == 2
    assert serving.ticker_perf_filtered(stocks, ["Y"], ["B"]).count() == 0
    assert serving.ticker_perf_filtered(stocks, None, []).count() == 0


def test_buys_in_thousands(spark):
    report = serving.buys_30d(gold.sector_buys_30d(silver_trades(spark, {}), AS_OF))
    assert [tuple(r) for r in report.collect()] == [("Tech", 1, 8.0)]
    assert dict(report.dtypes)["est_buy_volume_30d_k"] == "double"
