"""Silver and gold tables, rebuilt in full on each run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def run_path(root: str, name: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{name}/{run_id}"


def write_run(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write one run's table to a folder of its own and return it as written.

    With ``partition_by``, rows are first brought together by partition: adaptive
    execution splits large partitions and merges small ones, so a partition gets few
    files of even size rather than one from every task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return read_run(df.sparkSession, path, df.schema)


def read_run(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A written run with its declared schema: one without rows may have no file to infer
    it from."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def publish(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """Point the view ``name`` at a written run. Readers see the old run or the new one."""
    body = f"SELECT * FROM parquet.`{path}`"
    if read_run(spark, path, schema).isEmpty():
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
        body = f"SELECT {columns} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")
    return spark.table(name)


def full_refresh(
    df: DataFrame, name: str, root: str, run_id: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write, then publish. A run that dies, or is repeated under the same ``run_id``,
    leaves nothing half-visible."""
    path = run_path(root, name, run_id)
    write_run(df, path, partition_by)
    return publish(df.sparkSession, name, path, df.schema)
