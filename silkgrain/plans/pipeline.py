"""Stages over all documents, with stored outputs, resume and a run log (O rows).

Each stage writes a batch of rows and then the ids of the documents it has seen, whether or not
they gave rows. Only batches that such a list names are ever read, so a run that stops anywhere
leaves nothing half done: the next one takes up, stage by stage, what that stage has not seen.

A document that a stage can't do doesn't stop the others: a stage made by per_document() returns its error as a row, the document
is listed as failed, and the stages after it list it as blocked. A stage that fails as a whole (not a document's fault) stops the run.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silkgrain import config as c
from silkgrain.functions import text as t
from silkgrain.operators import fusion, labeling, quality, segment

Stage = Callable[[SparkSession, dict[str, DataFrame]], DataFrame]


def chunk_stage(spark: SparkSession, given: dict[str, DataFrame]) -> DataFrame:
    """Cleaned documents (document_id, text) that pass the quality gate, as chunks of any language."""
    clean = given["documents"].select("document_id", t.clean_page_text(F.col("text")).alias("text"))
    kept = quality.text_quality(clean).where("NOT skip").select("document_id", "text")
    return segment.build_chunks(kept, min_ratio=None)


def vote_stage(spark: SparkSession, given: dict[str, DataFrame], terms: dict = c.TERMS, patterns: dict = c.PATTERNS, priors: dict = c.PRIORS) -> DataFrame:
    """Votes of all rule LFs, indicators of tests among them."""
    chunks = given["chunks"].withColumn("section", F.array_join("path", " / "))
    return labeling.apply_rules(chunks, terms, patterns, priors, c.INDICATORS).withColumn("ord", F.lit(0))


def label_stage(spark: SparkSession, given: dict[str, DataFrame]) -> DataFrame:
    """Fused decisions with counts."""
    decisions = fusion.weighted_vote(given["votes"])
    return decisions.join(fusion.count_fusion(given["votes"], decisions), fusion.KEY)


STAGES: tuple[tuple[str, Stage], ...] = (("chunks", chunk_stage), ("votes", vote_stage), ("labels", label_stage))


def _read(spark: SparkSession, *paths: str) -> DataFrame | None:
    """The rows of parquet folders; null if there are none yet."""
    try:
        return spark.read.parquet(*paths) if paths else None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def per_document(work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, source: str = "documents") -> Stage:
    """A stage from a function of one document's rows in `source`. What it raises becomes a row of that document with `error`
    and nothing else; the function's other rows have a null there. A document's rows are a group."""
    names = [f.name for f in StructType.fromDDL(schema)]

    def stage(spark: SparkSession, given: dict[str, DataFrame]) -> DataFrame:
        rows = given[source]
        kind = rows.schema["document_id"].dataType.simpleString()

        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            try:
                out = work(pdf)[names].assign(error=None)
            except Exception as e:  # noqa: BLE001  the reason is kept in the row
                out = pd.DataFrame([dict.fromkeys(names) | {"error": f"{type(e).__name__}: {e}"}])
            return out.assign(document_id=key[0])[["document_id", *names, "error"]]

        return rows.groupBy("document_id").applyInPandas(run, f"document_id {kind}, {schema}, error string")

    return stage


def seen(spark: SparkSession, out: str, stage: str) -> DataFrame | None:
    """document_id, batch, status (ok, failed, blocked) and error of what a stage has done; a document that was tried again
    has several rows."""
    return _read(spark, f"{out}/_seen/{stage}")


def latest(done: DataFrame) -> DataFrame:
    """document_id and status, batch and error of the last try."""
    return done.groupBy("document_id").agg(F.max_by(F.struct("status", "batch", "error"), F.col("batch").cast("long")).alias("s")).select("document_id", "s.*")


def pending(spark: SparkSession, documents: DataFrame, out: str, stage: str, retry: bool = False) -> DataFrame:
    """O2: documents that a stage hasn't seen; with retry also those that failed there or were blocked."""
    done = seen(spark, out, stage)
    if done is None:
        return documents
    done = latest(done)
    return documents.join((done.where("status = 'ok'") if retry else done).select("document_id"), "document_id", "left_anti")


def stored(spark: SparkSession, out: str, stage: str) -> DataFrame | None:
    """All rows of a stage's finished batches. Batches are a partition of one table; which are finished is a join, so nothing
    is listed on the driver, and files of others aren't read."""
    done = seen(spark, out, stage)
    rows = None if done is None else _read(spark, f"{out}/{stage}")
    if rows is None:
        return None
    finished = done.select(F.col("batch").cast("string")).distinct()  # a row for each run
    return rows.withColumn("batch", F.col("batch").cast("string")).join(finished, "batch", "left_semi").drop("batch")


def statuses(spark: SparkSession, out: str, stages: tuple = STAGES) -> DataFrame | None:
    """document_id, stage, status and error of the last try of each document in each stage, in one table."""
    parts = [(name, seen(spark, out, name)) for name, _ in stages]
    parts = [latest(d).select("document_id", F.lit(n).alias("stage"), "status", "error") for n, d in parts if d is not None]
    return functools.reduce(DataFrame.unionByName, parts) if parts else None


def run(spark: SparkSession, documents: DataFrame, out: str, stages: tuple = STAGES, retry: bool = False) -> DataFrame:
    """O1: all stages; each one's rows are stored below `out` and read by the next. Every stage
    works on those of the documents that it hasn't seen (with retry: or that failed there). Returns the run log."""
    ids, log = documents.select("document_id").distinct(), []
    for k, (name, stage) in enumerate(stages):
        began = time.time()
        todo = pending(spark, ids, out, name, retry)
        if todo.isEmpty():
            log.append((name, "nothing to do", 0, 0, 0.0))
            continue
        batch, bad = str(int(began * 1000)), None
        before = seen(spark, out, stages[k - 1][0]) if k else None
        if before is not None:
            bad = todo.join(latest(before).where("status <> 'ok'").select("document_id"), "document_id", "left_semi").withColumns({"status": F.lit("blocked"), "error": F.lit(f"no rows from {stages[k - 1][0]}")})
            todo = todo.join(bad.select("document_id"), "document_id", "left_anti")
        given = {"documents": documents.join(todo, "document_id", "left_semi")}
        for earlier, _ in stages[:k]:
            rows = stored(spark, out, earlier)
            if rows is not None:
                given[earlier] = rows.join(todo, "document_id", "left_semi")
        made = stage(spark, given)
        failing = "error" in made.columns
        path = f"{out}/_tried/{name}/batch={batch}" if failing else f"{out}/{name}/batch={batch}"
        made.write.parquet(path)
        told = todo.withColumns({"status": F.lit("ok"), "error": F.lit(None).cast("string")})
        if failing:  # rows and errors come of one try, so they are stored together before they part
            tried = spark.read.schema(made.schema).parquet(path)
            wrong = tried.where("error IS NOT NULL").groupBy("document_id").agg(F.min("error").alias("error"))
            tried.join(wrong.select("document_id"), "document_id", "left_anti").drop("error").write.parquet(f"{out}/{name}/batch={batch}")
            told = todo.join(wrong, "document_id", "left").withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed"))
        told = told.select("document_id", "status", "error")
        if bad is not None:
            told = told.unionByName(bad.select("document_id", "status", "error"))
        told.select("document_id", F.lit(batch).alias("batch"), "status", "error").write.mode("append").parquet(f"{out}/_seen/{name}")
        mine = seen(spark, out, name).where(F.col("batch") == batch).agg(F.count_if(F.col("status") == "ok"), F.count_if(F.col("status") != "ok")).first()
        log.append((name, "ok", *mine, round(time.time() - began, 3)))
    return spark.createDataFrame(log, "stage string, status string, documents long, not_done long, seconds double")
