"""Readers and writers (S rows). Paths are whatever Spark reads; schemas are mandatory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = "chunk_id string, section_title string, section_path array<string>, text string"
VOTE = "document_id string, chunk_id string, lf string, label string, vote int, confidence double, count int, evidence array<string>"


def read_chunk_json(spark: SparkSession, path: str, chunk: str = CHUNK) -> DataFrame:
    """One JSON document a file, an object with chunks or a bare list; document_id is the
    file's stem."""
    stem = F.regexp_replace(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1), r"(\.chunk)?\.json$", "")
    raw = spark.read.option("wholetext", True).text(path).select(stem.alias("document_id"), F.trim("value").alias("v"))
    wrapped = F.when(F.col("v").startswith("["), F.concat(F.lit('{"chunks": '), "v", F.lit("}"))).otherwise(F.col("v"))
    parsed = raw.select("document_id", F.from_json(wrapped, f"chunks array<struct<{','.join(x.strip().replace(' ', ':', 1) for x in chunk.split(','))}>>").alias("p"))
    return parsed.select("document_id", F.explode("p.chunks").alias("c")).where("c IS NOT NULL").select("document_id", "c.*")


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Lines of JSON; blank lines are skipped, bad ones too unless strict: then reading fails with the line and its file."""
    rows = jsonl_rows(spark, path, schema)
    if strict:
        why = F.concat(F.lit("no JSON of the schema in "), F.col("file"), F.lit(": "), F.substring("line", 1, 200))
        return rows.select(F.when(F.col("bad"), F.raise_error(why)).otherwise(F.col("row")).alias("row")).select("row.*")
    return rows.where("NOT bad").select("row.*")


def jsonl_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S4 with nothing lost: file, line, row and bad (no object, or a value that its field can't hold), blank lines left out."""
    fields = f"{schema}, __bad string"
    x = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line")).where("trim(line) <> ''")
    x = x.withColumn("r", F.from_json("line", fields, {"columnNameOfCorruptRecord": "__bad"}))
    return x.select("file", "line", F.col("r").dropFields("__bad").alias("row"), (F.col("r").isNull() | F.col("r.__bad").isNotNull()).alias("bad"))


def bad_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """How many lines each file has, and how many of them were bad."""
    return jsonl_rows(spark, path, schema).groupBy("file").agg(F.count("*").alias("lines"), F.count_if("bad").alias("bad"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None) -> None:
    """Lines of JSON, appended or not, in a folder for each value of `by`."""
    w = df.write.mode(mode)
    (w.partitionBy(by) if by else w).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """S8."""
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def pair_by_stem(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents that both sides have; a missing partner leaves the document out."""
    return left.join(right.select("document_id").distinct(), "document_id", "left_semi")


def unique_stems(paths: DataFrame) -> DataFrame:
    """O3: paths (path, ord) with stem: the file's name without its ending (a hash of the path where that is blank); of those
    that share one, all but the first in order get a hash of their path on top. The first is found by a sum, not by a window over a stem's files."""
    name = F.trim(F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1))
    x = paths.withColumn("__s", F.when(name == "", F.substring(F.sha1(F.col("path").cast("string")), 1, 12)).otherwise(name))
    first = x.groupBy("__s").agg(F.min(F.struct("ord", "path")).alias("__f"))
    x = x.join(first, "__s")
    is_first = (F.col("ord") == F.col("__f.ord")) & (F.col("path") == F.col("__f.path"))
    return x.withColumn("stem", F.when(is_first, F.col("__s")).otherwise(F.concat("__s", F.lit("."), F.substring(F.sha1("path"), 1, 8)))).drop("__s", "__f")


def read_pdf_pages(spark: SparkSession, path: str, extract: Callable[[bytes], list[tuple[int, str]]]) -> DataFrame:
    """Pages of binary documents by an extractor of the caller's, one document at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for stem, content in zip(pdf["document_id"], pdf["content"], strict=True):
                pages = extract(bytes(content))
                yield pd.DataFrame({"document_id": [stem] * len(pages), "page_number": [n for n, _ in pages], "text": [x for _, x in pages]})

    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.format("binaryFile").load(path).select(stem.alias("document_id"), "content").mapInPandas(run, "document_id string, page_number int, text string")


def call_model(prompts: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """An answer for each prompt row (prompt_id, prompt); errors are data, not failures."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text in pdf["prompt"]:
                try:
                    out.append(("ok", model(text), None))
                except Exception as e:  # noqa: BLE001  the reason is kept in the row
                    out.append(("error", None, str(e)))
            yield pd.DataFrame({"prompt_id": pdf["prompt_id"], "status": [x[0] for x in out], "text": [x[1] for x in out], "reason": [x[2] for x in out]})

    kind = prompts.schema["prompt_id"].dataType.simpleString()
    return prompts.select("prompt_id", "prompt").mapInPandas(run, f"prompt_id {kind}, status string, text string, reason string")


def data_url(content: str = "content", kind: str = "image/png"):  # noqa: ANN201
    """S13."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))


def element_tree(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(document_id, json) element trees to their elements, walked depth first."""
    import json

    first = lambda x, *names: next((x[n] for n in names if x.get(n) is not None), None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, body in zip(pdf["document_id"], pdf["json"], strict=True):
                todo, n = [json.loads(body)], 0
                while todo:
                    x = todo.pop()
                    if isinstance(x, list):
                        todo += reversed(x)
                    elif isinstance(x, dict):
                        out.append((doc, n, str(first(x, "type", "kind") or ""), first(x, "text", "content"), first(x, "page", "page number", "page_number")))
                        n += 1
                        todo += [v for k, v in reversed(x.items()) if isinstance(v, (list, dict))]
            yield pd.DataFrame(out, columns=["document_id", "ord", "type", "text", "page"])

    kind = rows.schema["document_id"].dataType.simpleString()
    return rows.select("document_id", "json").mapInPandas(run, f"document_id {kind}, ord int, type string, text string, page int")
