"""Tables of the engine's kinds derived from the driver's tables, in Spark and in SQL.

Documents play pages, their lines play chunks. Votes, entities and boxes are arithmetic on
doc_id, so that both sides have the same ones; forty documents make one document of entities.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain import config as c

LFS = ("medical_pattern", "prompted_llm", "dictionary", "regex_indicator", "section_prior")
ENTITY_LFS = ("prompt_a", "prompt_b", "prompt_c", "dictionary", "surface")


def table(spark: SparkSession, d: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return df.select(*cols) if cols else df


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select(F.col("doc_id").alias("document_id"), "text")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return lines_of(docs(spark, d))


def lines_of(texts: DataFrame) -> DataFrame:
    """Chunks of rows (document_id, text): their lines."""
    lines = F.split("text", "\n")
    x = texts.select("document_id", lines[0].alias("section"), F.posexplode(lines).alias("chunk_index", "text"))
    return x.select("document_id", "chunk_index", F.format_string("CH%04d", F.col("chunk_index") + 1).alias("chunk_id"), "text", "section")


def _line(k: int) -> Column:
    """A line of the text, empty where there is none."""
    return F.coalesce(F.get(F.split("text", "\n"), F.lit(k)), F.lit(""))


def _each(values: tuple[str, ...], name: str, order: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(v).alias(name), F.lit(i).alias(order)) for i, v in enumerate(values)]))


def _votes(spark: SparkSession, d: str, labels: tuple[str, ...], lfs: tuple[str, ...]) -> DataFrame:
    i = F.col("doc_id")
    x = table(spark, d, "documents", "doc_id").select("doc_id", _each(labels, "label", "lo").alias("l")).select("doc_id", "l.*", _each(lfs, "lf", "fo").alias("f")).select("doc_id", "label", "lo", "f.*")
    m = (i * 7 + F.col("lo") * 3 + F.col("fo") * 5) % 11
    return x.select(
        F.expr("doc_id div 40").alias("document_id"), i.alias("chunk_id"), "label", F.col("lo").alias("label_ord"), "lf", F.when(m < 5, 1).when(m < 9, 0).otherwise(-1).alias("vote"),
        (((i * 13 + F.col("lo") * 17 + F.col("fo") * 19) % 100).cast("double") / 100).alias("confidence"), ((i + F.col("lo") + F.col("fo")) % 4).cast("int").alias("count"),
        F.array(F.concat(F.lit("e"), (i + F.col("lo")) % 3), F.concat(F.lit("e"), (i + F.col("fo")) % 3)).alias("evidence"), F.lit(0).alias("ord"),
    )


def votes(spark: SparkSession, d: str) -> DataFrame:
    return _votes(spark, d, c.LABELS, LFS)


def entity_votes(spark: SparkSession, d: str) -> DataFrame:
    return _votes(spark, d, c.ENTITY_TYPES, ENTITY_LFS).withColumnRenamed("chunk_id", "entity_id")


def entities(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    kind = reduce(lambda a, b: a.when(i % 8 == b[0], b[1]), list(enumerate(c.ENTITY_TYPES))[1:], F.when(i % 8 == 0, c.ENTITY_TYPES[0]))
    status = F.when(i % 5 == 0, "rejected").when(i % 5 == 1, "review").otherwise("accepted")
    return table(spark, d, "documents", "doc_id", "text").select(
        F.expr("doc_id div 40").alias("document_id"), i.alias("entity_id"), kind.alias("entity_type"), ((i % 40) / 4).cast("int").alias("chunk_index"),
        F.concat(F.lit("CH"), ((i % 40) / 4).cast("int")).alias("chunk_id"), _line(0).alias("name"), _line(1).alias("evidence_text"), "text", status.alias("status"),
    )


def boxes(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    x0, top = (i * 7 % 50) * F.lit(10.0), (i * 13 % 70) * F.lit(10.0)
    return table(spark, d, "documents", "doc_id", "text").select(
        F.expr("doc_id div 40").alias("document_id"), (i % 3).cast("int").alias("page"), i.alias("object_id"), x0.alias("x0"), top.alias("top"), (x0 + 100 + (i % 5) * 20).alias("x1"), (top + 12 + (i % 4) * 10).alias("bottom"),
        F.when(i % 2 == 0, "table").otherwise("figure").alias("object_type"), (i % 7).cast("string").alias("number"), _line(0).alias("line"),
    )


_values = lambda xs: ", ".join(f"('{x}', {i})" for i, x in enumerate(xs))


def _votes_sql(name: str, labels: tuple[str, ...], lfs: tuple[str, ...], key: str) -> str:
    return f"""{name} AS (SELECT doc_id // 40 AS document_id, doc_id AS {key}, label, lo AS label_ord, lf, fo,
  CASE WHEN (doc_id * 7 + lo * 3 + fo * 5) % 11 < 5 THEN 1 WHEN (doc_id * 7 + lo * 3 + fo * 5) % 11 < 9 THEN 0 ELSE -1 END AS vote,
  ((doc_id * 13 + lo * 17 + fo * 19) % 100)::DOUBLE / 100 AS confidence, ((doc_id + lo + fo) % 4)::INT AS count,
  ['e' || ((doc_id + lo) % 3), 'e' || ((doc_id + fo) % 3)] AS evidence
  FROM documents, (VALUES {_values(labels)}) l(label, lo), (VALUES {_values(lfs)}) f(lf, fo))"""


#: Latin letters as characters of the lexicon, so that whole texts meet the rules on Chinese ones.
LATIN = "abcdefghijklmnopqrstuvwxyz"
CHINESE = "断表因案发现病疗检查疹疼机诊访制痛热方治率皮随阳高性"


#: Letters that have a small one, each by itself: SQL's lower() knows no final sigma, and of a dotted I it makes an i.
_SMALL = {ch: ch.lower()[0] for ch in map(chr, range(0x110000)) if ch.lower() != ch}
_IN_CHINESE = str.maketrans(LATIN, CHINESE)


def cn(text: Column) -> Column:
    """Every Latin letter as a Chinese character, all others small."""
    return F.translate(text, "".join(_SMALL) + LATIN, ("".join(_SMALL.values()) + LATIN).translate(_IN_CHINESE))


def cn_docs(spark: SparkSession, d: str) -> DataFrame:
    """docs with every Latin letter as a Chinese character."""
    return docs(spark, d).withColumn("text", cn(F.col("text")))


def cn_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).withColumns({k: cn(F.col(k)) for k in ("text", "section")})


DOCS_SQL = "docs AS (SELECT doc_id AS document_id, text FROM documents)"
CHUNKS_SQL = DOCS_SQL + """,
chunks AS (SELECT document_id, (n - 1)::INT AS chunk_index, 'CH' || lpad(n::VARCHAR, 4, '0') AS chunk_id, line AS text, section FROM
  (SELECT document_id, string_split(text, chr(10))[1] AS section, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM docs))"""
CN_DOCS_SQL = f"docs AS (SELECT doc_id AS document_id, translate(lower(text), '{LATIN}', '{CHINESE}') AS text FROM documents)"
CN_CHUNKS_SQL = CN_DOCS_SQL + CHUNKS_SQL.removeprefix(DOCS_SQL)
VOTES_SQL = _votes_sql("votes", c.LABELS, LFS, "chunk_id")
ENTITY_VOTES_SQL = _votes_sql("evotes", c.ENTITY_TYPES, ENTITY_LFS, "entity_id")
ENTITIES_SQL = f"""entities AS (SELECT doc_id // 40 AS document_id, doc_id AS entity_id, [{", ".join(f"'{t}'" for t in c.ENTITY_TYPES)}][(doc_id % 8 + 1)::INT] AS entity_type,
  ((doc_id % 40) // 4)::INT AS chunk_index, 'CH' || ((doc_id % 40) // 4) AS chunk_id, string_split(text, chr(10))[1] AS name, coalesce(string_split(text, chr(10))[2], '') AS evidence_text, text,
  CASE doc_id % 5 WHEN 0 THEN 'rejected' WHEN 1 THEN 'review' ELSE 'accepted' END AS status FROM documents)"""
BOXES_SQL = """boxes AS (SELECT doc_id // 40 AS document_id, (doc_id % 3)::INT AS page, doc_id AS object_id, (doc_id * 7 % 50) * 10::DOUBLE AS x0, (doc_id * 13 % 70) * 10::DOUBLE AS top,
  (doc_id * 7 % 50) * 10::DOUBLE + 100 + (doc_id % 5) * 20 AS x1, (doc_id * 13 % 70) * 10::DOUBLE + 12 + (doc_id % 4) * 10 AS bottom,
  CASE WHEN doc_id % 2 = 0 THEN 'table' ELSE 'figure' END AS object_type, (doc_id % 7)::VARCHAR AS number, string_split(text, chr(10))[1] AS line FROM documents)"""
CONTRACT_SQL = "rel(relation, source_type, target_type, max_distance, quota) AS (VALUES " + ", ".join(
    f"('{r}', '{s}', '{t}', {m}, {'NULL' if q is None else q})" for r, s, t, m, q in c.RELATIONS
) + ")"


def issue_sql(x: str) -> str:
    """The shape rules of a title."""
    tokens = " ".join(f"WHEN contains(lower({x}), '{k}') THEN 'contains_token:{k}'" for k in c.HEADING_TOKENS)
    noise = " ".join(f"WHEN regexp_matches({x}, '(?i){p}') THEN 'noise_section'" for p in c.NOISE_TITLES)
    return f"""CASE WHEN {x} = '' THEN 'empty_title' WHEN length({x}) > 90 THEN 'title_too_long' WHEN regexp_matches({x}, '[，,、]$') THEN 'truncated_line_fragment' WHEN regexp_matches({x}, '[。；;，]') THEN 'paragraph_punctuation'
 WHEN length({x}) - length(replace({x}, '.', '')) >= 5 THEN 'paragraph_like' WHEN regexp_matches({x}, '[：:]') AND length(trim(regexp_replace({x}, '^[^：:]*[：:]', ''))) >= 12 THEN 'colon_body_fragment'
 WHEN regexp_matches({x}, '^\\d{{1,2}}[．.、)].*[，,：:。；;]') THEN 'numbered_body_fragment' {tokens} {noise} WHEN regexp_matches({x}, '^\\d+(\\.\\d+)?\\s*[%~]') THEN 'numeric_measurement' ELSE '' END"""
