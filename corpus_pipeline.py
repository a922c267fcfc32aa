"""From documents to a training mix: quality, near duplicates, benchmark copies, secrets, mixing.

Each stage gets what the one before it kept and returns the columns of documents and ROW, a key
that the first stage gives each row and the others carry: ids may be null or repeated, so rows are
told apart by it alone. The last stage takes ROW away and adds the number of copies of each
document that the mix takes; columns of these names that documents had before give way. A null text
counts as empty; empty tables give no rows. STAGES pairs names with functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm import mixing, near_copies, pu_quality, secret_scan, templates
from silkgrain.llm.common import stable_rows, table, written

ROW = "row_key"


def keyed(docs: DataFrame) -> DataFrame:
    """docs with ROW; a table that has it keeps it."""
    return docs if ROW in docs.columns else stable_rows(docs).withColumn(ROW, F.monotonically_increasing_id())


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, each row by its own text's verdict."""
    docs = keyed(docs)
    verdict = pu_quality.classify(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), ROW)
    return docs.join(verdict.where("predicted = 0").select(ROW), ROW, "left_anti").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies; of rows that share it, the first."""
    docs = keyed(docs)
    found = near_copies.near_copies(docs, ROW)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    keep = found.join(docs.select(ROW, "doc_id"), ROW).groupBy("root").agg(F.min(order)[ROW].alias(ROW))
    return docs.join(keep, ROW, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    docs = keyed(docs)
    rows = docs.select(F.col(ROW).alias("doc_id"), "text")
    hit = templates.contaminated(rows, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return docs.join(hit.select(F.col("doc_id").alias(ROW)).distinct(), ROW, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their text replaced."""
    return secret_scan.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with copies and target."""
    docs = keyed(docs)
    plan = mixing.mix(docs.select(F.col(ROW).alias("doc_id"), "source", "text")).where("copies > 0")
    plan = plan.select(F.col("doc_id").alias(ROW), "copies", "target")
    kept = [c for c in docs.columns if c not in ("copies", "target")]
    return docs.select(*kept).join(plan, ROW).select(*(c for c in kept if c != ROW), "copies", "target")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mix),
]
#: Two fitted models stand at the beginning and in the middle: SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's rows are stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
