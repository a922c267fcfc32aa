"""Relation candidates, context, audit with quotas, records (R rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions import text as t

LEVELS = ("same_chunk", "adjacent_chunk", "near_chunk_window", "document")


def contract(spark: SparkSession, relations: tuple = c.RELATIONS) -> DataFrame:
    """The legal triples: seven rows, so always fit to be sent to every task."""
    return spark.createDataFrame(list(relations), "relation string, source_type string, target_type string, max_distance int, quota int")


def search_level(relation: Column, distance: Column) -> Column:
    """R2."""
    return F.when((relation == "has_sub_disease") & (distance > 0), "document").when(distance == 0, "same_chunk").when(distance == 1, "adjacent_chunk").when(distance <= c.MAX_DISTANCE, "near_chunk_window").otherwise("document")


def has_trigger(relation: Column, text: Column, triggers: dict[str, tuple[str, ...]]) -> Column:
    """Whether any trigger word of the relation stands in the text."""
    out = F.lit(True)
    for name, words in triggers.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(text, F.lit(w))
        out = F.when(relation == name, hit).otherwise(out)
    return out


def earlier_chunk(a: Column, b: Column, a_index: Column, b_index: Column) -> Column:
    """The chunk that stands earlier in its document; one without a place counts as last."""
    far = F.lit(10**9)
    return F.when(F.coalesce(a_index, far) <= F.coalesce(b_index, far), a).otherwise(b)


def chunk_header(chunk_id: Column, path: Column, title: Column, text: Column) -> Column:
    """A chunk as a prompt shows it: its id, path and title, then its text."""
    head = F.trim(F.concat(F.lit("["), chunk_id, F.lit("] "), F.array_join(F.coalesce(path, F.array().cast("array<string>")), " > "), F.lit(" "), F.coalesce(title, F.lit(""))))
    return F.trim(F.concat(head, F.lit("\n"), F.coalesce(text, F.lit(""))))


AUDIT = (
    "Say whether the text supports the relation, in its direction. Answer with a JSON object: approved (boolean),\n"
    "evidence (the shortest passage that says so, empty if none does) and confidence (0 to 1)."
)


def asked(relation: Column, start: Column, end: Column) -> Column:
    """A candidate as a question names it."""
    return F.concat(F.lit("Relation: "), start, F.lit(" -"), relation, F.lit("-> "), end)


def audit_prompts(cands: DataFrame, contexts: DataFrame) -> DataFrame:
    """A prompt for each candidate; contexts: candidate_id, context_level, context."""
    prompt = F.concat_ws("\n", F.lit(AUDIT), asked(F.col("relation"), F.col("start_name"), F.col("end_name")), F.concat(F.lit("Context level: "), "context_level"), F.col("context"))
    return cands.join(contexts, "candidate_id").select("candidate_id", "context_level", prompt.alias("prompt"))


def batch_audit_prompts(cands: DataFrame, contexts: DataFrame, size: int = 8) -> DataFrame:
    """A prompt for up to `size` candidates of one document and context level, in order of id."""
    w = Window.partitionBy("document_id", "context_level").orderBy("candidate_id")
    item = F.concat(F.lit("["), "candidate_id", F.lit("] "), asked(F.col("relation"), F.col("start_name"), F.col("end_name")), F.lit("\n"), "context")
    x = cands.join(contexts, "candidate_id").select("document_id", "context_level", "candidate_id", item.alias("item"), F.floor((F.row_number().over(w) - 1) / size).cast("int").alias("batch"))
    g = x.groupBy("document_id", "context_level", "batch").agg(F.array_sort(F.collect_list(F.struct("candidate_id", "item"))).alias("i"))
    body = F.array_join(F.transform("i", lambda r: r["item"]), "\n")
    rule = F.lit(AUDIT + " One object for each candidate, with its candidate_id, in a list named results.")
    return g.select("document_id", "context_level", "batch", F.transform("i", lambda r: r["candidate_id"]).alias("candidate_ids"), F.concat_ws("\n", rule, body).alias("prompt"))


def candidates(entities: DataFrame, chunks: DataFrame, triggers: dict[str, tuple[str, ...]] | None = c.TRIGGERS, same_chunk_only: bool = False, most: int = c.MAX_DISTANCE) -> DataFrame:
    """Pairs of one document whose types some relation allows, at most its distance apart.

    Chunks are dealt into bands as wide as the greatest distance, and equality on (document, target type, band) carries the
    join: a start meets the ends of its band and of the two beside it, so pairs grow with a document's length, not with its square. Only a
    relation that holds over a whole document is joined without bands. Entities: document_id, chunk_id, chunk_index,
    entity_id, entity_type, name; without a chunk_index only the latter. In different chunks a trigger must stand in one of them; None skips
    that, and then no chunk text is fetched.
    """
    whole = F.col("relation") == "has_sub_disease"
    rel = contract(entities.sparkSession)
    side = lambda p: entities.select("document_id", *[F.col(x).alias(f"{p}_{x}") for x in ("entity_id", "entity_type", "name", "chunk_id", "chunk_index")])
    start = lambda kept: side("start").join(F.broadcast(rel.where(kept)), F.col("start_entity_type") == F.col("source_type"))  # noqa: E731  seven rows
    band = lambda x: F.floor(x / (most + 1))
    end = side("end").withColumnRenamed("end_entity_type", "target_type")
    near = start(~whole).withColumn("band", F.explode(F.array(*(band(F.col("start_chunk_index")) + k for k in (-1, 0, 1)))))
    near = near.join(end.withColumn("band", band(F.col("end_chunk_index"))), ["document_id", "target_type", "band"]).drop("band")
    j = near.unionByName(start(whole).join(end, ["document_id", "target_type"]))
    d = F.coalesce(F.abs(F.col("start_chunk_index") - F.col("end_chunk_index")), F.lit(most + 1))
    j = j.where((F.coalesce(F.col("start_entity_id").cast("string"), F.lit("")) != "") & (F.coalesce(F.col("end_entity_id").cast("string"), F.lit("")) != "") & (F.col("start_entity_id") != F.col("end_entity_id")))
    j = j.withColumn("chunk_distance", d).where(whole | (F.col("chunk_distance") <= F.least(F.lit(most), "max_distance")))
    if same_chunk_only:
        j = j.where("chunk_distance = 0")
    if triggers:
        text = chunks.select("document_id", "chunk_id", "text")
        for p in ("start", "end"):
            j = j.join(text.select("document_id", F.col("chunk_id").alias(f"{p}_chunk_id"), F.col("text").alias(f"{p}_text")), ["document_id", f"{p}_chunk_id"], "left")
        both = F.concat_ws("\n", "start_text", "end_text")
        j = j.where(whole | (F.col("chunk_distance") == 0) | has_trigger(F.col("relation"), both, triggers)).drop("start_text", "end_text")
    j = j.withColumn("search_level", search_level(F.col("relation"), F.col("chunk_distance"))).withColumn("candidate_id", t.short_id("REL_CAND_", F.col("document_id"), F.col("start_entity_id"), F.col("relation"), F.col("end_entity_id")))
    return j.dropDuplicates(["document_id", "start_entity_id", "relation", "end_entity_id"])


def ordered(cands: DataFrame) -> DataFrame:
    """Pos, the rank inside the document by distance, relation, chunks and ids."""
    w = Window.partitionBy("document_id").orderBy("chunk_distance", "relation", "start_chunk_index", "end_chunk_index", "start_entity_id", "end_entity_id")
    return cands.withColumn("pos", F.row_number().over(w))


def limited(cands: DataFrame, most: int) -> DataFrame:
    """The first `most` of each document in that order; 0 keeps all."""
    return ordered(cands).where(F.col("pos") <= most) if most else ordered(cands)


def neighbour_context(chunks: DataFrame) -> DataFrame:
    """Each chunk's text with the ones before and after it."""
    w = Window.partitionBy("document_id").orderBy("chunk_index")
    return chunks.withColumn("context", F.concat_ws("\n\n", F.lag("text").over(w), "text", F.lead("text").over(w)))


def audit_results(cands: DataFrame, responses: DataFrame) -> DataFrame:
    """Approved, evidence, confidence of each candidate; missing answers are refusals."""
    j = cands.join(responses, "candidate_id", "left")
    return j.withColumn("approved", F.coalesce("approved", F.lit(False)) & (F.coalesce("evidence", F.lit("")) != "")).withColumn("confidence", t.bounded(F.col("confidence")))


def with_quotas(audited: DataFrame) -> DataFrame:
    """R10 with batches of one: approved candidates in order of level and place until a
    sub-disease has its quota of a relation; plans only for treatments that were confirmed."""
    anchor = F.when(F.col("relation") == "causes", F.col("end_entity_id")).otherwise(F.col("start_entity_id"))
    level = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("search_level"))
    w = Window.partitionBy("document_id", "relation", "anchor").orderBy("level", "pos")
    ok = audited.where("approved").withColumn("anchor", anchor).withColumn("level", level).withColumn("nth", F.row_number().over(w))
    ok = ok.where(F.col("quota").isNull() | (F.col("nth") <= F.col("quota")))
    main = ok.where("relation <> 'implements_by'")
    sure = main.where("relation = 'follows_treatment'").groupBy("document_id", F.col("end_entity_id").alias("start_entity_id")).agg(F.min("level").alias("since"))
    plans = ok.where("relation = 'implements_by'").join(sure, ["document_id", "start_entity_id"]).where("since <= level").drop("since")
    return main.unionByName(plans)


def escalate(responses: DataFrame) -> DataFrame:
    """Properties of the first context level that says anything, else of the last."""
    return responses.groupBy("candidate_id").agg(F.coalesce(F.min_by("properties", F.when(F.col("signal"), F.col("level"))), F.max_by("properties", "level")).alias("properties"), F.min(F.when(F.col("signal"), F.col("level"))).alias("level"))


def records(approved: DataFrame) -> DataFrame:
    """One record for each (start, relation, end) of a document."""
    r = approved.withColumn("relation_id", t.short_id("REL_", F.col("document_id"), F.col("start_entity_id"), F.col("relation"), F.col("end_entity_id")))
    return r.select("relation_id", "document_id", "start_entity_id", "relation", "end_entity_id", "confidence", "search_level", "chunk_distance").dropDuplicates(["relation_id"])


def summary(found: DataFrame) -> DataFrame:
    """Records by relation and level."""
    return found.groupBy("relation", "search_level").agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("documents"))
