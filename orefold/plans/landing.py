"""Landing that commits once.

A run writes its tables (bronze rows, quarantined rows) into folders of its own attempt and
then one small record, which names the attempt and holds the run's figures. Readers go by
records, so rows, quarantine and figures become visible together. A run that has a record
is not landed again: the recorded figures are returned. An attempt that dies before its record
is invisible, and the next one under the same run id starts afresh; ``forget_attempts`` deletes
what is left. If two attempts of a run commit at once, all readers take the same one of them.

    <root>/<table>/run=<run>/attempt=<attempt>/<partitions>/part-...
    <root>/_runs/run=<run>/attempt=<attempt>/part-....json
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold import schemas
from orefold.operators import faults, nested
from orefold.plans import ingest
from orefold.sources import bronze

RUNS = "_runs"
RECORD = "run_id string, attempt string, run_ts timestamp, figures map<string, bigint>"
BRONZE, QUARANTINE = "bronze", "quarantine"
QUARANTINED = f"key string, extracted_at timestamp, {faults.PATH} string, {faults.REASON} string, element string"


def commit_once(
    spark: SparkSession, root: str, run_id: str, run_ts: str | dt.datetime,
    tables: dict[str, DataFrame], figures: dict[str, int] | None = None,
) -> dict[str, int]:
    """Write all ``tables`` of a run and make them visible by one record; returns the figures:
    the rows of each table, counted while writing, and those given. A run that has been
    committed writes nothing and returns what it recorded.

    Each table is partitioned by ``extraction_date``.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.:-]+", run_id):
        raise ValueError(f"run_id {run_id!r} must be letters, digits, and _ . : -")
    recorded = run_figures(spark, root, run_id)
    if recorded is not None:
        return recorded
    attempt, figures = uuid.uuid4().hex, dict(figures or {})
    for name, df in tables.items():
        rows, seen = ingest.counted(df, f"{name}-{attempt}")
        rows.hint("rebalance", bronze.PARTITION).write.partitionBy(bronze.PARTITION).parquet(
            _folder(root, name, run_id, attempt)
        )
        figures[name] = seen.get["rows"]
    record = spark.createDataFrame([(run_id, attempt, None, figures)], RECORD)
    record.withColumn("run_ts", F.lit(str(run_ts)).cast("timestamp")).coalesce(1).write.json(
        _folder(root, RUNS, run_id, attempt)
    )
    return run_figures(spark, root, run_id)


def _folder(root: str, table: str, run_id: str, attempt: str) -> str:
    # a colon is no part of a Hadoop path
    return f"{root}/{table}/run={run_id.replace(':', '%3A')}/attempt={attempt}"


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The committed runs: run_id, attempt, run_ts, figures; one row each."""
    try:
        records = spark.read.schema(RECORD).json(f"{root}/{RUNS}/*/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RECORD)
    named = records.where(F.col("run_id").isNotNull())
    return named.groupBy("run_id").agg(F.min_by(F.struct("attempt", "run_ts", "figures"), "attempt").alias("r")).select(
        "run_id", "r.*"
    )


def run_figures(spark: SparkSession, root: str, run_id: str) -> dict[str, int] | None:
    """The figures of a committed run, else None."""
    row = runs(spark, root).where(F.col("run_id") == run_id).first()
    return None if row is None else row["figures"]


def read_table(
    spark: SparkSession, root: str, table: str, schema: str, run_ids: list[str] | None = None
) -> DataFrame:
    """The rows of a table from committed runs: all, or those named."""
    committed = runs(spark, root)
    if run_ids is not None:
        committed = committed.where(F.col("run_id").isin(run_ids))
    # one name for each run reaches the driver
    return rows_of(spark, root, table, schema, [(r["run_id"], r["attempt"]) for r in committed.collect()])


def rows_of(spark: SparkSession, root: str, table: str, schema: str, attempts: list[tuple[str, str]]) -> DataFrame:
    paths = [_folder(root, table, *a) for a in attempts]
    dated = f"{schema}, {bronze.PARTITION} date"
    if not paths:
        return spark.createDataFrame([], dated)
    whole = f"{dated}, run string, attempt string"
    return spark.read.schema(whole).option("basePath", f"{root}/{table}").parquet(*paths).drop("run", "attempt")


def forget_attempts(spark: SparkSession, root: str, table: str) -> int:
    """Delete the folders of attempts that no record names; returns how many went. Run it
    while nothing is landing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(conf)
    kept = {_folder("", table, r["run_id"], r["attempt"]) for r in runs(spark, root).collect()}
    gone = 0
    for status in files.globStatus(path(f"{root}/{table}/*/*")) or []:
        found = status.getPath()
        if f"/{table}/{found.getParent().getName()}/{found.getName()}" not in kept:
            gone += files.delete(found, True)
    return gone


# what lands

def land_payloads(raw: DataFrame, kind: str, root: str, run_id: str, run_ts: str | dt.datetime) -> dict[str, int]:
    """Land payloads (key, extracted_at, payload; ``kind`` is ``bars`` or ``trades``).

    Payloads with a record inside go to bronze as they are. Broken payloads, and faulty
    elements of good ones, go to quarantine with their path and reason; read bronze with
    ``mode="split"`` to leave the same elements out. ``raw`` is read twice: a written table.
    """
    raw = raw.select(raw.columns[0], "extracted_at", "payload")
    key = raw.columns[0]
    good = faults.landable(raw, kind)
    judged = faults.judged_bars(raw) if kind == "bars" else faults.judged_trades(raw)
    aside = faults.aside(judged).withColumnRenamed(key, "key")
    dated = F.to_date("extracted_at")
    return commit_once(
        raw.sparkSession, root, run_id, run_ts,
        {BRONZE: good.withColumn(bronze.PARTITION, dated), QUARANTINE: aside.withColumn(bronze.PARTITION, dated)},
    )


def land_bars(
    raw: DataFrame, root: str, run_id: str, run_ts: str | dt.datetime, watchlist: DataFrame | None = None
) -> dict[str, int]:
    """Land raw bars as documents; bad bars go to quarantine. With a watchlist, ``missing``
    counts the watched symbols without data."""
    good, bad = ingest.split_bars(raw)
    figures = {}
    if watchlist is not None:
        figures["missing"] = ingest.without_data(watchlist, raw).count()
    docs = bronze.stamped(ingest.ingest_bars(good, watchlist), run_ts)
    return commit_once(
        raw.sparkSession, root, run_id, run_ts, {BRONZE: docs, QUARANTINE: _set_aside(bad, "symbol", run_ts)}, figures
    )


def land_cells(raw: DataFrame, root: str, run_id: str, run_ts: str | dt.datetime) -> dict[str, int]:
    """Land scraped trades as documents; rows that are no trade go to quarantine. A run that
    scraped nothing is recorded with no rows, and ``empty`` 1: it counts as a failure."""
    good, bad = ingest.split_cells(raw)
    docs = bronze.stamped(ingest.ingest_trades(good), run_ts)
    return commit_once(
        raw.sparkSession, root, run_id, run_ts, {BRONZE: docs, QUARANTINE: _set_aside(bad, "source", run_ts)},
        {"empty": int(raw.isEmpty())},
    )


def _set_aside(bad: DataFrame, key: str, run_ts: str | dt.datetime) -> DataFrame:
    """Bad rows in the form of quarantined elements."""
    row = F.struct(*[c for c in bad.columns if c != "reason"])
    out = bronze.dated(bad.select(key, "reason", nested.json_text(row).alias("element")), run_ts)
    return out.select(
        F.col(key).alias("key"), "extracted_at", F.lit("$").alias(faults.PATH),
        F.col("reason").alias(faults.REASON), "element", bronze.PARTITION,
    )


def read_prices(spark: SparkSession, root: str, run_ids: list[str] | None = None) -> DataFrame:
    """Landed price documents of committed runs."""
    return read_table(spark, root, BRONZE, schemas.RAW_PRICES, run_ids)


def read_trades(spark: SparkSession, root: str, run_ids: list[str] | None = None) -> DataFrame:
    """Landed trade documents of committed runs."""
    return read_table(spark, root, BRONZE, schemas.RAW_TRADES, run_ids)


def read_quarantine(spark: SparkSession, root: str, run_ids: list[str] | None = None) -> DataFrame:
    """Quarantined rows of committed runs."""
    return read_table(spark, root, QUARANTINE, QUARANTINED, run_ids)
