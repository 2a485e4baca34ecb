"""The log as a stored table, partitioned by message kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracelake.model import LOG_DDL


def write_log(log: DataFrame, path: str, mode: str = "append") -> None:
    """Append messages; the fold then reads only the small control partitions."""
    log.write.mode(mode).partitionBy("kind").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_DDL).parquet(path)


def stream_log(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.schema(LOG_DDL).options(**options).parquet(path)
