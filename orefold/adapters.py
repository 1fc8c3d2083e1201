"""Stand-ins: the given star-schema tables in the shape of landed market data.

events -> price bars, lineitem -> disclosed trades, supplier/nation/region -> sector
list, customer -> weights and company data, orders -> scraped cells. Every adapter
maps whole tables row by row; no rows are left out to save work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.operators.nested import json_text

PRICES_AS_OF = "2024-02-10"
TRADES_AS_OF = "2001-11-01"


TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def symbol(key: str) -> Column:
    """A ticker from a key; every seventh one has a share class."""
    share_class = F.when(F.col(key) % 7 == 3, ".B").otherwise("")
    return F.concat(F.lit("U"), F.col(key), share_class)


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per event: hour of the event, a price between 50 and 75 from its value, or 0
    now and then, and no close (NaN) for errors."""
    value = F.when(F.col("event_id") % 97 == 0, 0.0).otherwise(F.lit(50.0) + F.col("value") % 25)
    return table(spark, sf_dir, "events").select(
        symbol("user_id").alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'-04:00'").alias("ts"),
        value.alias("open"),
        (value + 1).alias("high"),
        (value - 1).alias("low"),
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(value).alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.col("ts").cast("timestamp").alias("extracted_at"),
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze prices: one extraction per event, landed when the event happened.

    Later events in the same hour supersede earlier ones.
    """
    bars = raw_bars(spark, sf_dir)
    bar = F.struct(
        "ts",
        "open",
        "high",
        "low",
        F.nanvl("close", F.lit(None).cast("double")).alias("close"),
        F.col("volume").cast("bigint").alias("volume"),
    )
    doc = F.struct("symbol", F.lit("1h").alias("interval"), F.array(bar).alias("bars"))
    return bars.select("symbol", "extracted_at", json_text(doc).alias("payload"))


def damaged_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze prices in which the volume decides whether and how a payload is spoilt."""
    volume = F.get_json_object("payload", "$.bars[0].volume").cast("int")
    return raw_prices(spark, sf_dir).withColumn(
        "payload",
        F.when(volume >= 60, F.col("payload"))
        .when(volume >= 40, '{"bars": []}')
        .when(volume >= 30, '{"bars": {"ts": "x"}}')
        .when(volume >= 20, F.rtrim(F.col("payload"), F.lit("}"))),
    )


def faulty_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze prices with all events of a symbol and day in one document, some of whose bars
    have a bad leaf or are no object."""
    event = F.col("event_id")
    value = F.lit(50.0) + F.col("value") % 25
    leaves = {
        "ts": F.date_format("ts", "yyyy-MM-dd'T'HH:00:00'-04:00'"),
        "open": value, "high": value + 1, "low": value - 1, "close": value,
        "volume": F.get_json_object("props", "$.k").cast("bigint"),
    }

    def bar(**bad: str | None) -> Column:
        return json_text(F.struct(*[(F.lit(bad[c]) if c in bad else v).alias(c) for c, v in leaves.items()]))

    text = (
        F.when(event % 19 == 0, "5")
        .when(event % 17 == 0, bar(volume="many"))
        .when(event % 13 == 0, bar(ts="soon"))
        .when(event % 11 == 0, bar(close="abc"))
        .when(event % 7 == 0, bar(ts=None))
        .otherwise(bar())
    )
    events = table(spark, sf_dir, "events").select(
        symbol("user_id").alias("symbol"), F.to_date("ts").alias("day"), F.col("ts"), text.alias("bar")
    )
    docs = events.groupBy("symbol", "day").agg(
        F.max("ts").cast("timestamp").alias("extracted_at"), F.collect_list("bar").alias("bars")
    )
    body = F.concat(F.lit('{"interval":"1h","bars":['), F.array_join("bars", ","), F.lit("]}"))
    return docs.select("symbol", "extracted_at", body.alias("payload"))


def dim_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector list: suppliers in good standing under their region.

    Nation and region have 25 and 5 rows at every scale.
    """
    nation = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") >= 0)
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            symbol("s_suppkey").alias("ticker"),
            F.col("s_name").alias("company_name"),
            F.col("r_name").alias("sector"),
        )
    )


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights: positive customer balances."""
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select(
            symbol("c_custkey").alias("ticker"),
            F.round("c_acctbal").cast("int").alias("market_cap_b"),
        )
    )


#: Upper ends of all bands but the open one; below the first there is no band.
BAND_ENDS = (
    (1e3, "< 1K"), (15e3, "1K–15K"), (50e3, "15K–50K"), (100e3, "50K–100K"),
    (250e3, "100K–250K"), (500e3, "250K–500K"), (1e6, "500K–1M"), (5e6, "1M–5M"),
    (25e6, "5M–25M"), (50e6, "25M–50M"),
)


def size_band(amount: Column) -> Column:
    band = F.lit("50M+")
    for end, label in reversed(BAND_ENDS):
        band = F.when(amount < end, label).otherwise(band)
    return band


def trade_amount() -> Column:
    """The line's price, up to a thousand times, so that every band occurs."""
    return F.col("l_extendedprice") * F.pow(F.lit(10.0), F.col("l_linenumber") % 4)


def trade_lag() -> Column:
    lag = F.round(F.col("l_quantity") + F.col("l_discount") * 400).cast("int")
    return F.when(F.col("l_tax") > 0, lag)


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze trades: one extraction per order line, landed some days after it shipped.

    Holds null members, all placeholders for "no ticker", unreadable dates, unknown lags
    and unmapped sizes.
    """
    quantity = F.col("l_quantity")
    trade = F.struct(
        F.when(
            F.col("l_discount") > 0, F.concat(F.lit("Member "), F.col("l_linenumber"))
        ).alias("politician"),
        F.when(F.col("l_linestatus") == "O", "Orange").otherwise("Fern").alias("party"),
        F.when(quantity > 25, "House").otherwise("Senate").alias("chamber"),
        F.concat("l_returnflag", "l_linestatus").alias("state"),
        F.concat(F.lit("Part "), F.col("l_partkey")).alias("issuer"),
        F.when(quantity == 1, "")
        .when(quantity == 2, "--")
        .when(quantity == 3, "n/a")
        .when(quantity > 4, F.lower(symbol("l_suppkey")))
        .alias("ticker"),
        F.when((F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.1), "Yesterday")
        .otherwise(F.date_format("l_shipdate", "d MMM yyyy"))
        .alias("trade_date_raw"),
        trade_lag().alias("filed_after_days"),
        F.when(F.col("l_linestatus") == "O", "Self").otherwise("Spouse").alias("owner"),
        F.when(F.col("l_returnflag") == "N", "Buy")
        .when(F.col("l_returnflag") == "A", "Sell")
        .otherwise("Exchange")
        .alias("tx_type"),
        size_band(trade_amount()).alias("size"),
        F.concat(F.lit("$"), quantity.cast("int")).alias("price"),
    )
    landed = F.timestamp_add("DAY", quantity.cast("int"), F.col("l_shipdate").cast("timestamp"))
    return table(spark, sf_dir, "lineitem").select(
        F.lit("filings").alias("source"),
        landed.alias("extracted_at"),
        json_text(F.array(trade)).alias("payload"),
    )


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped cells made from orders: padded, multi-line and with blanks."""
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.lit("cells").alias("source"),
        F.concat(F.lit("\n Clerk "), F.col("o_custkey"), F.lit("\t ")).alias("politician"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("party"),
        F.when(F.col("o_orderstatus") == "P", "  \n").otherwise("House").alias("chamber"),
        F.when(F.col("o_orderstatus") == "F", "NY").alias("state"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("issuer"),
        F.when(
            F.col("o_orderstatus") == "O", F.concat(symbol("o_custkey"), F.lit(":US"))
        ).otherwise(symbol("o_custkey")).alias("ticker_raw"),
        F.when(F.col("o_orderpriority") == "5-LOW", " \n ")
        .otherwise(
            F.concat(
                F.date_format(date, " d MMM"), F.lit(" \n\n "),
                F.date_format(date, "yyyy"), F.lit("\nNYSE"),
            )
        ).alias("traded_raw"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "days")
        .otherwise(F.concat(F.lit("days\n"), F.col("o_totalprice").cast("int"), F.lit(" of 99")))
        .alias("filed_after_raw"),
        F.lit("Self").alias("owner"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" Type "), F.col("o_orderstatus")))
        .alias("tx_type"),
        size_band(F.col("o_totalprice")).alias("size"),
        F.lit("").alias("price"),
    )


def letters(key: str) -> Column:
    """Digits to letters, giving a ticker-shaped code."""
    return F.translate(F.col(key).cast("string"), "0123456789", "ABCDEFGHIJ")


def published_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published list with long sector names: suppliers, then customers, whose codes
    repeat those of the suppliers."""
    region = F.col("n_regionkey")
    long_name = (
        F.when(region == 0, "Information Technology")
        .when(region == 1, "Health Care")
        .when(region == 2, "Consumer Staples")
        .otherwise("Conglomerates")
    )
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    suppliers = table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.concat(F.lit(" "), F.lower(letters("s_suppkey")), F.lit("\n")).alias("symbol"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(", Inc. ")).alias("security"),
        long_name.alias("gics_sector"),
        F.lit(0).alias("position"),
    )
    customers = table(spark, sf_dir, "customer").select(
        letters("c_custkey").alias("symbol"),
        F.col("c_name").alias("security"),
        F.lit("Energy").alias("gics_sector"),
        F.lit(1).alias("position"),
    )
    return suppliers.unionByName(customers)


def company_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company data per symbol, with missing and empty sectors and names."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        symbol("c_custkey").alias("ticker"),
        F.when(segment == "BUILDING", "").when(segment != "MACHINERY", segment).alias("sector"),
        F.when(balance > 5000, F.concat(F.col("c_name"), F.lit(", Ltd"))).alias("longName"),
        F.when(balance > 1000, F.col("c_name")).otherwise("").alias("shortName"),
    )
