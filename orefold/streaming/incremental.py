"""Incremental silver: each run reads only the bronze files that arrived since the last.

The store keeps the latest version of every record, in folders
``version=<batch>/<day>=<date>/``. A batch parses its files once, finds the days they
touch, takes those days' current rows, adds the new ones, chooses the latest again and
writes the result as a new version of just these days. Choosing the latest is associative,
so the outcome equals a full rebuild, in whatever order the files arrive. Null closes stay
in the store (an older value must not come back), and company and sector are joined when
reading.

A manifest names the newest version of each day: a batch adds one small file of (day,
version) after its data. Readers and batches open only the folders that the manifest
names, however many versions there are; ``expire`` deletes the others. A batch that dies
before its manifest is invisible, and is replayed by the stream into the same folders.
Store and stream checkpoint share one root; drop both or none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold import schemas
from orefold.functions import dates
from orefold.plans import silver
from orefold.sources import bronze, tables

VERSION = "version"


BARS = f"{schemas.BARS}, bar_date date"
TRADES = schemas.TRADES


def manifest(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """(day, version): the newest version of each day; no rows before the first batch."""
    schema = f"day date, {VERSION} bigint, batch bigint"
    try:
        named = spark.read.schema(schema).parquet(f"{store}/_manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        named = spark.createDataFrame([], schema)
    if before is not None:
        named = named.where(F.col("batch") < before)
    return named.groupBy("day").agg(F.max(VERSION).alias(VERSION))


def _folder(store: str, day: str, row) -> str:
    value = "__HIVE_DEFAULT_PARTITION__" if row["day"] is None else row["day"].isoformat()
    return f"{store}/{VERSION}={row[VERSION]}/{day}={value}"


def rows_of(spark: SparkSession, store: str, schema: str, day: str, newest: DataFrame) -> DataFrame:
    """The rows of the given versions of days; the driver holds one name for each day."""
    paths = [_folder(store, day, r) for r in newest.collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, {VERSION} bigint").option("basePath", store).parquet(*paths)
    return rows.drop(VERSION)


def _advance(
    raw: DataFrame,
    schema: str,
    store: str,
    checkpoint: str,
    day: str,
    parse: Callable[[DataFrame], DataFrame],
    latest: Callable[[DataFrame], DataFrame],
) -> None:
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = latest(parse(batch))
        fresh = tables.write_run(parsed, f"{store}/_fresh/{VERSION}={batch_id}")
        touched = fresh.select(F.col(day).alias("day")).distinct()
        newest = manifest(spark, store, batch_id)
        wanted = newest.join(touched, newest["day"].eqNullSafe(touched["day"]), "left_semi")
        merged = fresh  # where no touched day has rows yet, the batch's latest are the latest
        if not wanted.isEmpty():
            kept = rows_of(spark, store, schema, day, wanted)
            merged = latest(fresh.unionByName(kept.select(*fresh.columns)))
        merged.hint("rebalance", day).write.mode("overwrite").partitionBy(day).parquet(
            f"{store}/{VERSION}={batch_id}"
        )
        touched.select("day", F.lit(batch_id).cast("bigint").alias(VERSION)).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{store}/_manifest/batch={batch_id}")

    query = (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _stream(spark: SparkSession, path: str, schema: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(f"{schema}, {bronze.PARTITION} date")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _with_bar_date(bars: DataFrame) -> DataFrame:
    return bars.withColumn("bar_date", dates.day_bucket(F.col("bar_ts")))


def advance_prices(
    spark: SparkSession,
    raw_path: str,
    root: str,
    mode: str = "strict",
    clock: str = "wall",
    max_files: int | None = None,
) -> None:
    """Take in all bronze price files not seen yet."""
    _advance(
        _stream(spark, raw_path, schemas.RAW_PRICES, max_files),
        BARS,
        f"{root}/bars",
        f"{root}/_checkpoint_bars",
        "bar_date",
        lambda raw: _with_bar_date(silver.bars(raw, mode, clock)),
        lambda bars: _with_bar_date(silver.latest_bars(bars.drop("bar_date"))),
    )


def advance_trades(
    spark: SparkSession,
    raw_path: str,
    root: str,
    mode: str = "strict",
    max_files: int | None = None,
) -> None:
    """Take in all bronze trade files not seen yet."""
    _advance(
        _stream(spark, raw_path, schemas.RAW_TRADES, max_files),
        TRADES,
        f"{root}/trades",
        f"{root}/_checkpoint_trades",
        "trade_date",
        lambda raw: silver.trades(raw, mode),
        silver.latest_trades,
    )


def read_prices(spark: SparkSession, root: str, dim: DataFrame) -> DataFrame:
    """The current silver prices, equal to a full rebuild from the same bronze; none before
    the first batch."""
    store = f"{root}/bars"
    current = rows_of(spark, store, BARS, "bar_date", manifest(spark, store))
    return silver.describe_bars(current, dim)


def read_trades(spark: SparkSession, root: str, dim: DataFrame) -> DataFrame:
    """The current silver trades, equal to a full rebuild from the same bronze; none before
    the first batch."""
    store = f"{root}/trades"
    current = rows_of(spark, store, TRADES, "trade_date", manifest(spark, store))
    return silver.describe_trades(current, dim)


def superseded(spark: SparkSession, root: str, table: str = "bars") -> DataFrame:
    """(day, version) of the folders no reader needs any more, by the manifest alone."""
    store = f"{root}/{table}"
    newest = manifest(spark, store).withColumnRenamed(VERSION, "newest")
    try:
        named = spark.read.schema(f"day date, {VERSION} bigint").parquet(f"{store}/_manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        named = spark.createDataFrame([], f"day date, {VERSION} bigint")
    joined = named.join(newest.withColumnRenamed("day", "of"), F.col("day").eqNullSafe(F.col("of")))
    return joined.where(F.col(VERSION) < F.col("newest")).select("day", VERSION).distinct()


def expire(spark: SparkSession, root: str, table: str = "bars") -> int:
    """Delete the superseded folders and the parsed batches; returns how many days' folders
    went. Run it while no reader works on older versions."""
    store, day = f"{root}/{table}", "bar_date" if table == "bars" else "trade_date"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(store).getFileSystem(conf)
    gone = 0
    for row in superseded(spark, root, table).toLocalIterator():
        gone += files.delete(path(_folder(store, day, row)), True)
    files.delete(path(f"{store}/_fresh"), True)
    return gone
