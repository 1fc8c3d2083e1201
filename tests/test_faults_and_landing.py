"""Faulty elements set aside, and landing that commits once."""

import json
import os

import pytest

from builders import bar, dim, price_doc, prices, rows, trade, trades
from orefold import schemas
from orefold.operators import faults, nested
from orefold.plans import ingest, landing, silver

AT = "2026-04-22T10:00:00+00:00"
GOOD = bar("2026-04-22T09:30:00-04:00", 10.0)


def judged(spark, *payloads):
    docs = [("A", AT, p if p is None or isinstance(p, str) else json.dumps({"bars": p})) for p in payloads]
    raw = spark.createDataFrame([price_doc(*d) for d in docs], schemas.RAW_PRICES)
    return faults.judged_bars(raw)


def places(df):
    return sorted((r[faults.PATH], r[faults.REASON], r["element"]) for r in faults.aside(df).collect())


def test_one_bad_price_costs_one_bar(spark):
    payload = [GOOD, {**GOOD, "close": "abc"}, {**GOOD, "ts": "2026-04-22T10:30:00-04:00"}]
    found = judged(spark, payload)
    assert sorted(str(r.bar_ts) for r in faults.good(found).collect()) == ["2026-04-22 09:30:00", "2026-04-22 10:30:00"]
    ((path, reason, element),) = places(found)
    assert (path, reason) == ("$.bars[1].close", "no number")
    assert json.loads(element)["close"] == "abc"


@pytest.mark.parametrize(
    "element, path, reason",
    [
        (5, "$.bars[1]", "no object"), (None, "$.bars[1]", "no object"), ([1], "$.bars[1]", "no object"),
        ({**GOOD, "ts": None}, "$.bars[1].ts", "missing"), ({**GOOD, "ts": "soon"}, "$.bars[1].ts", "no time"),
        ({"open": 1}, "$.bars[1].ts", "missing"), ({**GOOD, "open": ""}, "$.bars[1].open", "no number"),
        ({**GOOD, "high": {"a": 1}}, "$.bars[1].high", "no number"), ({**GOOD, "low": [1]}, "$.bars[1].low", "no number"),
        ({**GOOD, "volume": "many"}, "$.bars[1].volume", "no whole number"),
        ({**GOOD, "volume": 1e300}, "$.bars[1].volume", "no whole number"),
        ({**GOOD, "ts": "soon", "close": "abc"}, "$.bars[1].ts", "no time"),
    ],
)
def test_faults_of_elements(spark, element, path, reason):
    found = judged(spark, [GOOD, element, GOOD])
    assert [p[:2] for p in places(found)] == [(path, reason)]
    assert faults.good(found).count() == 2


@pytest.mark.parametrize(
    "payload, reason",
    [
        (None, "missing"), ("null", "missing"), ("", "malformed"), ("no json", "malformed"), ("[1]", "malformed"),
        ('{"bars": 5}', "malformed"), ('{"bars": {"ts": "x"}}', "malformed"), ('{"bars": [', "malformed"),
        ("{}", "empty"), ('{"bars": null}', "empty"), ('{"bars": []}', "empty"),
    ],
)
def test_faults_of_payloads(spark, payload, reason):
    found = judged(spark, payload)
    assert [p[:2] for p in places(found)] == [("$", reason)]
    assert faults.good(found).count() == 0
    raw = prices(spark, ("A", AT, payload))
    assert [r.reason for r in nested.with_reason(raw, "bars").collect()] == [reason]


def test_split_equals_strict_on_good_payloads(spark):
    raw = prices(
        spark, ("A", AT, [GOOD, bar("2026-04-22T11:30:00-04:00", None, None)]), ("B", AT, [bar("2026-04-22T09:30:00", 0.1, 7)])
    )
    assert rows(silver.bars(raw, "split")) == rows(silver.bars(raw))
    assert silver.bars(raw, "split").columns == silver.bars(raw).columns
    assert rows(silver.bars(raw, "split", "utc")) == rows(silver.bars(raw, "strict", "utc"))


def test_nulls_and_text_numbers_are_no_faults(spark):
    found = judged(spark, [{**GOOD, "open": "1.5", "high": None, "volume": "12.7"}, {"ts": GOOD["ts"]}])
    assert not places(found)
    assert {(r.open, r.high, r.volume) for r in faults.good(found).collect()} == {(1.5, None, 13), (None, None, None)}


def test_silver_of_faulty_payloads(spark):
    raw = prices(
        spark,
        ("AAA", AT, [GOOD, {**GOOD, "ts": "2026-04-22T10:30:00-04:00", "close": "x"}]),
        ("AAA", "2026-04-22T11:00:00+00:00", [{**GOOD, "close": "y"}, {**GOOD, "ts": "2026-04-22T10:30:00-04:00", "close": 3.0}]),
    )
    # a faulty later version does not hide the good earlier one
    got = silver.silver_stock_prices(raw, dim(spark), "split")
    assert sorted((str(r.bar_ts), r.close) for r in got.collect()) == [
        ("2026-04-22 09:30:00", 10.0), ("2026-04-22 10:30:00", 3.0),
    ]


def test_trades(spark):
    raw = trades(
        spark,
        (AT, [trade(), trade(trade_date_raw="Yesterday"), 5, trade(filed_after_days="soon"), trade(ticker=None),
              trade(trade_date_raw=None), trade(trade_date_raw=" ")]),
        (AT, '{"ticker": "A"}'), (AT, "[]"),
    )
    found = faults.judged_trades(raw)
    assert sorted((r[faults.PATH], r[faults.REASON]) for r in faults.aside(found).collect()) == [
        ("$", "empty"), ("$", "malformed"), ("$[1].trade_date_raw", "no date"), ("$[2]", "no object"),
    ]
    plain = trades(spark, (AT, [trade(), trade(trade_date_raw="Yesterday"), trade(filed_after_days="soon")]))
    assert rows(silver.trades(plain, "split")) == rows(silver.trades(plain))


def test_one_parse_for_each_document(spark):
    raw = prices(spark, ("A", AT, [GOOD]))
    text = silver.bars(raw, "split")._jdf.queryExecution().executedPlan().toString()
    assert text.count("try_parse_json") + text.count("parseJson") <= 2 and "from_json" not in text


# landing

def payloads(spark):
    return prices(
        spark, ("A", AT, [GOOD, 5]), ("A", AT, [GOOD]), ("B", AT, "no json"), ("B", AT, None),
        ("C", AT, [{**GOOD, "open": "x"}, {**GOOD, "ts": "y"}]),
    )


def test_a_run_lands_once(spark, tmp_path):
    root, raw = str(tmp_path / "landed"), payloads(spark)
    first = landing.land_payloads(raw, "bars", root, "run:1", AT)
    assert first == {"bronze": 3, "quarantine": 5}
    assert landing.land_payloads(raw, "bars", root, "run:1", AT) == first
    # even if what it is given has changed since
    assert landing.land_payloads(raw.limit(1), "bars", root, "run:1", AT) == first
    assert landing.read_prices(spark, root).count() == 3
    assert landing.read_quarantine(spark, root).count() == 5
    assert landing.land_payloads(raw, "bars", root, "run2", AT) == first
    assert landing.read_prices(spark, root).count() == 6
    assert landing.read_prices(spark, root, ["run2"]).count() == 3
    assert [r.run_id for r in landing.runs(spark, root).orderBy("run_id").collect()] == ["run2", "run:1"]
    verbatim = {r.payload for r in raw.collect()}
    assert {r.payload for r in landing.read_prices(spark, root).collect()} <= verbatim


def test_death_before_the_record(spark, tmp_path, monkeypatch):
    root, raw = str(tmp_path / "landed"), payloads(spark)
    counted = ingest.counted

    def dies(df, name="run", **counts):
        if name.startswith("quarantine"):
            raise RuntimeError("executor lost")
        return counted(df, name, **counts)

    monkeypatch.setattr(ingest, "counted", dies)
    with pytest.raises(RuntimeError):
        landing.land_payloads(raw, "bars", root, "r", AT)
    monkeypatch.undo()
    assert landing.read_prices(spark, root).count() == 0
    assert landing.run_figures(spark, root, "r") is None
    assert landing.land_payloads(raw, "bars", root, "r", AT) == {"bronze": 3, "quarantine": 5}
    assert landing.read_prices(spark, root).count() == 3
    assert len(os.listdir(f"{root}/bronze/run=r")) == 2
    assert landing.forget_attempts(spark, root, "bronze") == 1
    assert landing.forget_attempts(spark, root, "bronze") == 0
    assert landing.read_prices(spark, root).count() == 3


def test_two_attempts_commit_at_once(spark, tmp_path):
    """Both records are there; everyone takes the same attempt."""
    root, raw = str(tmp_path / "landed"), payloads(spark)
    landing.land_payloads(raw, "bars", root, "r", AT)
    (record,) = landing.runs(spark, root).collect()
    other = "0" * 32
    for table in ("bronze", "quarantine", "_runs"):
        base = f"{root}/{table}/run=r"
        os.rename(f"{base}/attempt={record.attempt}", f"{base}/attempt={other}")
    text = [f for f in os.listdir(f"{root}/_runs/run=r/attempt={other}") if f.endswith(".json")]
    path = f"{root}/_runs/run=r/attempt={other}"
    body = open(f"{path}/{text[0]}").read().replace(record.attempt, other)
    for f in os.listdir(path):
        os.remove(f"{path}/{f}")
    open(f"{path}/part-0.json", "w").write(body)
    late = {"run_id": "r", "attempt": "f" * 32, "figures": {"bronze": 99}}
    os.makedirs(f"{root}/_runs/run=r/attempt={late['attempt']}")
    open(f"{root}/_runs/run=r/attempt={late['attempt']}/part-0.json", "w").write(json.dumps(late) + "\n")
    assert landing.run_figures(spark, root, "r") == {"bronze": 3, "quarantine": 5}
    assert landing.read_prices(spark, root).count() == 3


def test_nothing_landed_yet(spark, tmp_path):
    root = str(tmp_path / "none")
    assert landing.runs(spark, root).count() == 0
    assert landing.read_prices(spark, root).count() == 0
    with pytest.raises(ValueError):
        landing.commit_once(spark, root, "a/b", AT, {})


RAW_BARS = "symbol string, ts string, open double, high double, low double, close double, volume double"


def test_land_bars(spark, tmp_path):
    root = str(tmp_path / "bars")
    raw = spark.createDataFrame(
        [("A", "2026-04-22T09:30:00", 1.0, 1.0, 1.0, 1.0, 5.0), ("A", None, 1.0, 1.0, 1.0, 1.0, 5.0),
         ("A", "2026-04-22T10:30:00", 1.0, 1.0, 1.0, 1.0, float("inf"))], RAW_BARS,
    )
    watch = spark.createDataFrame([("A",), ("B",)], "symbol string")
    figures = landing.land_bars(raw, root, "r", AT, watch)
    assert figures == {"bronze": 1, "quarantine": 2, "missing": 1}
    assert landing.land_bars(raw, root, "r", AT) == figures
    assert {r[faults.REASON] for r in landing.read_quarantine(spark, root).collect()} == {"no time", "bad volume"}
    assert silver.bars(landing.read_prices(spark, root)).count() == 1


CELLS = (
    "source string, politician string, party string, chamber string, state string, issuer string, ticker_raw string, "
    "traded_raw string, filed_after_raw string, owner string, tx_type string, size string, price string"
)


def cell(**changes):
    row = {
        "source": "site", "politician": "P", "party": "B", "chamber": "House", "state": "NY", "issuer": "I",
        "ticker_raw": "AAA:US", "traded_raw": "22 Apr\n2026", "filed_after_raw": "days\n3", "owner": "Self",
        "tx_type": "buy", "size": "1K–15K", "price": "",
    }
    row.update(changes)
    return tuple(row.values())


def test_land_cells(spark, tmp_path):
    root = str(tmp_path / "cells")
    blank = dict.fromkeys([c.split()[0] for c in CELLS.split(", ")][1:], " \n")
    raw = spark.createDataFrame(
        [cell(), cell(traded_raw="Yesterday\n9:00"), cell(source=None), cell(**blank), cell(traded_raw=" ")], CELLS
    )
    figures = landing.land_cells(raw, root, "r", AT)
    assert figures == {"bronze": 2, "quarantine": 3, "empty": 0}
    reasons = sorted(r[faults.REASON] for r in landing.read_quarantine(spark, root).collect())
    assert reasons == ["empty row", "no date", "no source"]
    assert silver.trades(landing.read_trades(spark, root)).count() == 1
    nothing = landing.land_cells(raw.where("false"), root, "r2", AT)
    assert nothing == {"bronze": 0, "quarantine": 0, "empty": 1}
