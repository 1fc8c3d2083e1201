"""Session settings the library relies on, and the places it may write to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def configure(
    spark: SparkSession, shuffle_bytes: int | None = None, target_bytes: int = TARGET_PARTITION_BYTES
) -> SparkSession:
    """Set the runtime options the results and the plans depend on.

    ``shuffle_bytes`` is the expected size of the largest shuffle. It sets the
    initial number of shuffle partitions, which adaptive execution then merges
    down; without it the cluster's own setting stands. ``target_bytes`` is the size of one
    such partition: beyond some 10 TB take 512 MB or more, since 100 TB at 128 MB would
    make 819,200 partitions and as many map outputs to track.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a hot key is split even where that costs one more shuffle downstream
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    if shuffle_bytes is not None:
        parts = max(1, -(-shuffle_bytes // target_bytes))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(parts)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def require_session(spark: SparkSession) -> None:
    """Fail early when the session would silently change results."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        raise ValueError("set spark.sql.session.timeZone to UTC (orefold.session.configure)")
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled to true (orefold.session.configure)")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A private folder is used only where the setting is missing and Spark runs in
    local mode, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="orefold-")
