import datetime as dt

from pyspark.sql import functions as F

from orefold import fixed_values as fixed
from orefold.functions import dates, numeric, text


def test_blank_to_null(evaluate):
    got = evaluate(text.blank_to_null, ["  a b ", "\n\t", "", None, " x﻿"])
    assert got == ["a b", None, None, None, "x"]


def test_lower_or_empty(evaluate):
    assert evaluate(text.lower_or_empty, [" BUY", None, ""]) == ["buy", "", ""]


def test_share_class_symbol(evaluate):
    assert evaluate(text.share_class_symbol, ["BRK.B", "A.B.C", "X", None]) == [
        "BRK-B", "A-B-C", "X", None,
    ]


def test_drop_exchange(evaluate):
    assert evaluate(text.drop_exchange, ["NVDA:US", "NVDA", "A:B:C", ""]) == [
        "NVDA", "NVDA", "A", "",
    ]


def test_first_integer(evaluate):
    got = evaluate(text.first_integer, ["35 days", "days", "a1b2", "", None, "9" * 12])
    assert got == [35, None, 1, None, None, None]


def test_two_line_date(evaluate):
    got = evaluate(
        text.two_line_date, [" 22 Apr \n\n 2026 \nNYSE", "22 Apr 2026", " \n ", None]
    )
    assert got == ["22 Apr 2026", "22 Apr 2026", None, None]


def test_ticker_shape(evaluate):
    values = ["A", "BRK.B", "AB-C", "ABCDEF", "ABCDEFG", "A1", "a", ".A", "", None]
    assert evaluate(text.has_ticker_shape, values) == [
        True, True, True, True, False, False, False, False, False, None,
    ]


def test_has_ticker(evaluate):
    assert evaluate(text.has_ticker, ["A", "", "--", "N/A", None]) == [
        True, False, False, False, False,
    ]


def test_clean_up(evaluate):
    assert evaluate(text.clean_ticker, [" brk.b\n"]) == ["BRK.B"]
    assert evaluate(lambda c: text.commas_to_spaces(text.strip(c)), [" A, Inc, "]) == ["A  Inc "]


def test_first_non_empty(spark):
    df = spark.createDataFrame(
        [("", "b"), (None, None), ("a", "b"), ("", "")], "a string, b string"
    )
    got = [r[0] for r in df.select(text.first_non_empty(F.col("a"), F.col("b"))).collect()]
    assert got == ["b", None, "a", None]


def test_sector_label_passes_unknown_through(evaluate):
    got = evaluate(text.sector_label, ["Information Technology", "Space", None])
    assert got == ["Tech", "Space", None]


def test_band_midpoints(evaluate):
    labels = [*fixed.BAND_MIDPOINTS, "1K-15K", "< 1K", None]
    assert evaluate(text.band_midpoint, labels) == [
        8000, 32500, 75000, 175000, 375000, 750000, 3000000, 15000000, 37500000, 50000000,
        None, None, None,
    ]


def test_quote_links(evaluate):
    url = "https://finance.yahoo.com/quote/"
    assert evaluate(text.quote_url, ["BRK.B", "", None]) == [url + "BRK-B", url, None]
    assert evaluate(text.quote_url_or_null, ["BRK.B", "", "--", "N/A", None]) == [
        url + "BRK-B", None, None, None, None,
    ]


def test_display_dates(evaluate):
    values = [
        "2 Apr 2026", "02 APR 2026", " 2  Apr 2026 ", "22 April 2026", "31 Feb 2026",
        "22 Apr 26", "Yesterday", "22 Apr 2026 x", "", None,
    ]
    d = dt.date(2026, 4, 2)
    assert evaluate(dates.parse_display_date, values) == [d, d, d] + [None] * 7
    assert evaluate(dates.iso_date, values[:4]) == ["2026-04-02"] * 3 + [None]


def test_report_date_and_late_flag(evaluate):
    day = F.lit("2026-04-22").cast("date")
    got = evaluate(lambda c: dates.report_date(day, c), [None, 0, 45, -2], "int")
    assert got == [
        dt.date(2026, 4, 22), dt.date(2026, 4, 22), dt.date(2026, 6, 6), dt.date(2026, 4, 20),
    ]
    assert evaluate(dates.is_late, [None, 0, 45, 46, -1], "int") == [
        False, False, False, True, False,
    ]


def test_window_is_inclusive_and_open_ended(evaluate):
    days = [dt.date(2026, 4, 1), dt.date(2026, 3, 31), dt.date(2027, 1, 1), None]
    got = evaluate(lambda c: dates.on_or_after(c, 30, "2026-05-01"), days, "date")
    assert got == [True, False, True, None]


def test_default_report_date_is_today(evaluate):
    today = evaluate(lambda c: dates.as_of_date(), ["x"])[0]
    assert abs((today - dt.datetime.now(dt.timezone.utc).date()).days) <= 1


def test_bar_clock(evaluate):
    ts = ["2026-04-22T09:30:00-04:00"]
    assert evaluate(dates.bar_clock, ts) == [dt.datetime(2026, 4, 22, 9, 30)]
    assert evaluate(lambda c: dates.bar_clock(c, "utc"), ts) == [
        dt.datetime(2026, 4, 22, 13, 30)
    ]


def test_tolerant_int(evaluate):
    values = ["12", "12.7", "1e2", "99999999999", "NaN", "x", " 5 ", None]
    assert evaluate(numeric.tolerant_int, values) == [12, 13, 100, None, None, None, 5, None]


def test_nan_to_null(evaluate):
    assert evaluate(numeric.nan_to_null, [1.0, float("nan"), None], "double") == [1.0, None, None]


def test_simple_return_on_zero_base(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 0.0), (0.0, 2.0), (None, 1.0)], "v double, b double")
    got = [r[0] for r in df.select(numeric.simple_return(F.col("v"), F.col("b"))).collect()]
    assert got == [0.5, None, -1.0, None]


def test_thousands_stay_double(spark):
    df = spark.range(1).select(numeric.in_thousands(F.lit(8500)).alias("k"))
    assert dict(df.dtypes)["k"] == "double"
    assert df.first()["k"] == 8.5


def test_weighted_mean(spark):
    df = spark.createDataFrame(
        [("a", 0.1, 1), ("a", 0.4, 2), ("b", None, 5), ("b", 1.0, 5), ("c", 1.0, 0)],
        "g string, r double, w int",
    )
    mean = numeric.weighted_mean(F.col("r"), F.col("w")).alias("m")
    got = {r["g"]: r["m"] for r in df.groupBy("g").agg(mean).collect()}
    assert round(got["a"], 9) == 0.3
    assert got["b"] == 0.5  # the weight of a null return still counts
    assert got["c"] is None
    scaled = df.withColumn("w", F.col("w") * 8).groupBy("g").agg(mean).collect()
    assert {r["g"]: r["m"] for r in scaled} == got


def test_two_clock_sum_is_zero_or_null(spark):
    df = spark.createDataFrame(
        [("in", True, 5), ("out", False, 5), ("unknown", True, None)], "g string, c boolean, x int"
    )
    got = df.groupBy("g").agg(numeric.sum_where(F.col("c"), F.col("x")).alias("s")).collect()
    assert {r["g"]: r["s"] for r in got} == {"in": 5, "out": 0, "unknown": None}


def test_compound(spark):
    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("one", 0.25), ("n", None), ("x", -0.99), ("x", -1.0)],
        "g string, r double",
    )
    kept = df.filter(numeric.compoundable(F.col("r")))
    got = {
        r["g"]: round(r["c"], 9)
        for r in kept.groupBy("g").agg(numeric.compound(F.col("r")).alias("c")).collect()
    }
    assert got == {"a": 0.32, "one": 0.25, "n": 0.0}


def test_fixed_values():
    assert len(fixed.WATCHLIST) == len(set(fixed.WATCHLIST)) == 110
    assert len(fixed.SECTOR_LABELS) == 11 and len(fixed.BAND_MIDPOINTS) == 10
