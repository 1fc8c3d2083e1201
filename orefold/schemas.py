"""Explicit schemas of every layer. Nothing in the library infers a schema."""

from __future__ import annotations

RAW_PRICES = "symbol string, extracted_at timestamp, payload string"
RAW_TRADES = "source string, extracted_at timestamp, payload string"

DIM_SECTORS = "ticker string, company_name string, sector string"
WEIGHTS = "ticker string, market_cap_b int"
COMPANY_INFO = "ticker string, sector string, longName string, shortName string"

# Leaves are text: casting them afterwards decides between strict and tolerant.
BAR_DOC = (
    "struct<bars:array<struct<ts:string,open:string,high:string,low:string,"
    "close:string,volume:string>>>"
)
# The shape bars have when written by the book: numbers as JSON numbers.
NUMBER_BAR_DOC = (
    "struct<bars:array<struct<ts:string,open:double,high:double,low:double,close:double,"
    "volume:bigint>>,_corrupt_record:string>"
)
TRADE_DOC = (
    "array<struct<politician:string,party:string,chamber:string,state:string,"
    "issuer:string,ticker:string,trade_date_raw:string,filed_after_days:string,"
    "owner:string,tx_type:string,size:string,price:string>>"
)

BARS = (
    "symbol string, bar_ts timestamp_ntz, open double, high double, low double, "
    "close double, volume bigint, extracted_at timestamp"
)
TRADES = (
    "source string, member string, party string, chamber string, state string, "
    "issuer string, ticker string, trade_date date, disclosure_lag_days int, "
    "owner string, txn_type string, txn_value_band string, price string, "
    "extracted_at timestamp"
)

SILVER_PRICES = (
    "symbol", "company_name", "sector", "bar_ts", "open", "high", "low", "close",
    "volume", "extracted_at",
)
SILVER_TRADES = (
    "source", "member", "chamber", "party", "state", "issuer", "ticker", "sector",
    "owner", "txn_type", "trade_date", "report_date", "disclosure_lag_days",
    "is_late_disclosure", "txn_value_band", "est_trade_value_usd", "price",
    "extracted_at",
)
