"""Small literal inputs."""

import datetime as dt
import json
import random

from orefold import schemas


def utc(text):
    return dt.datetime.fromisoformat(text)


def bar(ts, close, volume=1, open_=1.0):
    return {"ts": ts, "open": open_, "high": 2.0, "low": 0.5, "close": close, "volume": volume}


def price_doc(symbol, at, bars):
    payload = bars if isinstance(bars, str) or bars is None else json.dumps(
        {"symbol": symbol, "interval": "1h", "bars": bars}
    )
    return (symbol, utc(at), payload)


def prices(spark, *docs):
    return spark.createDataFrame([price_doc(*d) for d in docs], schemas.RAW_PRICES)


TRADE = {
    "politician": "P One", "party": "Blue", "chamber": "House", "state": "NY",
    "issuer": "Aaa Inc", "ticker": "AAA", "trade_date_raw": "22 Apr 2026",
    "filed_after_days": 30, "owner": "Self", "tx_type": "Buy", "size": "1K–15K",
    "price": "$10.20",
}


def trade(**changes):
    return {**TRADE, **changes}


def trades(spark, *runs):
    rows = [
        ("site", utc(at), records if isinstance(records, str) else json.dumps(records))
        for at, records in runs
    ]
    return spark.createDataFrame(rows, schemas.RAW_TRADES)


def dim(spark, *rows):
    rows = rows or (("AAA", "Aaa Inc", "Tech"), ("BBB", "Bbb Inc", "Energy"))
    return spark.createDataFrame(list(rows), schemas.DIM_SECTORS)


def weights(spark, **caps):
    return spark.createDataFrame(list(caps.items()), schemas.WEIGHTS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def random_price_docs(seed, n_docs=40, symbols="ABCDE", days=6):
    """Overlapping extractions, repeated bars, null closes, out of order."""
    rng = random.Random(seed)
    docs = []
    for n in range(n_docs):
        at = f"2026-04-{rng.randint(10, 20):02d}T{rng.randint(0, 23):02d}:00:00+00:00"
        bars = [
            bar(
                f"2026-04-{rng.randint(1, days):02d}T{rng.randint(9, 15):02d}:30:00-04:00",
                None if rng.random() < 0.2 else rng.randint(1, 90) / 4,
                rng.randint(1, 9),
            )
            for _ in range(rng.randint(0, 12))
        ]
        docs.append((rng.choice(symbols), at, bars))
    return docs
