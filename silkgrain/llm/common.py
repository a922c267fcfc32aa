"""Shared plumbing of the corpus operators: tables, shared storage, folds."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words everywhere in this subpackage.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a table; others never leave the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="silkgrain-")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir, which driver and executors share.

    Only where that setting is absent and Spark runs on one machine (tests) a local folder stands
    in; elsewhere its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = root or _local_dir()
    return f"{root.rstrip('/')}/silkgrain-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are stored in the shared folder and read again."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(folds)


def stable_rows(df: DataFrame) -> DataFrame:
    """df itself if it only reads files, so that it has the same partitions and rows whenever it
    is read; else its rows, stored. Row numbers given in two branches of a plan then agree."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.children().size() == 1:
        plan = plan.children().apply(0)
    return df if plan.nodeName().startswith(("Relation", "LogicalRelation")) else written(df)
