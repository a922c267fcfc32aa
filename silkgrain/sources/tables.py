"""Tables that a plan stores on its way, in the folder that driver and executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="silkgrain-")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir. Where that is unset, a local one stands in if Spark runs on one machine;
    elsewhere its absence is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(root or _local_dir()).rstrip('/')}/silkgrain-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df's rows, stored and read again: what comes after doesn't repeat what came before."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Log:
    """A table that only grows: rows appended by one job after another, each whole or not at all."""

    def __init__(self, spark: SparkSession, schema: StructType | str, path: str | None = None) -> None:
        """path: where it is, or is to be; else a fresh folder."""
        self.spark, self.schema, self.path = spark, schema, path or shared_dir(spark)
        spark.createDataFrame([], schema).write.mode("append").parquet(self.path)

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        """What has been appended by now."""
        return self.spark.read.schema(self.schema).parquet(self.path)
