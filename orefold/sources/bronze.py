"""The append-only store of raw JSON documents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold import schemas

PARTITION = "extraction_date"


def read_raw_prices(spark: SparkSession, path: str) -> DataFrame:
    """All extractions: symbol, extracted_at, payload (and the partition date)."""
    return spark.read.schema(f"{schemas.RAW_PRICES}, {PARTITION} date").parquet(path)


def read_raw_trades(spark: SparkSession, path: str) -> DataFrame:
    """All extractions: source, extracted_at, payload (and the partition date)."""
    return spark.read.schema(f"{schemas.RAW_TRADES}, {PARTITION} date").parquet(path)


def dated(df: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """Add the run's one timestamp, and its date as the partition column."""
    return df.withColumn("extracted_at", F.lit(str(run_ts)).cast("timestamp")).withColumn(
        PARTITION, F.to_date("extracted_at")
    )


def stamped(docs: DataFrame, run_ts: str | dt.datetime) -> DataFrame:
    """(key, payload) documents as rows of the raw table."""
    return dated(docs, run_ts).select(docs.columns[0], "extracted_at", "payload", PARTITION)


def append_raw(docs: DataFrame, path: str, run_ts: str | dt.datetime) -> None:
    """Add one run's (key, payload) documents to a folder; earlier runs stay untouched.

    A run that is repeated appends its rows again; choosing the latest version of each
    record makes that harmless.
    """
    stamped(docs, run_ts).write.mode("append").partitionBy(PARTITION).parquet(path)


def create_raw_tables(spark: SparkSession, database: str) -> None:
    """Create the database and its two raw tables where they are absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, columns in (
        ("raw_stock_prices", schemas.RAW_PRICES),
        ("raw_congress_trades", schemas.RAW_TRADES),
    ):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}, {PARTITION} date) "
            f"USING parquet PARTITIONED BY ({PARTITION})"
        )


def append_raw_table(docs: DataFrame, table: str, run_ts: str | dt.datetime) -> None:
    """As ``append_raw``, into a table made by ``create_raw_tables``."""
    stamped(docs, run_ts).write.mode("append").insertInto(table)
