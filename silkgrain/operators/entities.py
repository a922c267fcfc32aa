"""Entities (E rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkgrain.functions import text as t


def prompt_modes(chunks: DataFrame, labels: DataFrame, decisions: DataFrame, full: bool = False) -> DataFrame:
    """Extract where the first layer found the label (or everywhere), else check only."""
    j = chunks.select("document_id", "chunk_id").crossJoin(F.broadcast(labels.select("label"))).join(decisions.select("document_id", "chunk_id", "label", "present"), ["document_id", "chunk_id", "label"], "left")
    return j.withColumn("mode", F.when(F.lit(full) | F.coalesce("present", F.lit(False)), "extract").otherwise("check_only")).drop("present")


def parse_responses(responses: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Model answers to entity rows: one list a type, names and evidence not empty, the first
    of each (type, name) of a chunk."""
    item = "array<struct<name:string,evidence:string,confidence:double>>"
    parsed = responses.withColumn("__p", F.from_json(t.json_object(F.col("text")), "struct<" + ",".join(f"{k}:{item}" for k in kinds) + ">"))

    def of(kind: str) -> Column:
        shape = lambda x: F.struct(F.lit(kind).alias("entity_type"), t.strip(x["name"]).alias("name"), x["evidence"].alias("evidence_text"), t.bounded(x["confidence"]).alias("confidence"))
        return F.transform(F.coalesce(F.col(f"__p.{kind}"), F.array().cast(item)), shape)

    lists = [of(k) for k in kinds]
    rows = parsed.where("status = 'ok'").select("document_id", "chunk_id", F.posexplode(F.flatten(F.array(*lists))).alias("ord", "e")).select("document_id", "chunk_id", "ord", "e.*")
    return first_of_each(rows.where("coalesce(name, '') <> '' AND coalesce(evidence_text, '') <> ''"))


def first_of_each(rows: DataFrame) -> DataFrame:
    """E6, first half: the first row of each (document, chunk, type, name)."""
    w = Window.partitionBy("document_id", "chunk_id", "entity_type", "name").orderBy("ord")
    return rows.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def override_flags(entities: DataFrame, decisions: DataFrame) -> DataFrame:
    """Whether the first layer had rejected the entity's type in its chunk."""
    d = decisions.select("document_id", "chunk_id", F.col("label").alias("entity_type"), F.col("status").alias("lv1"))
    return entities.join(d, ["document_id", "chunk_id", "entity_type"], "left").withColumn("override_lv1", F.coalesce(F.col("lv1") == "rejected", F.lit(False))).drop("lv1")


def entity_base(rows: DataFrame) -> DataFrame:
    """Distinct entities with ids."""
    named = rows.withColumn("name", t.strip(F.col("name"))).where("name <> ''")
    return first_of_each(named).withColumn("entity_id", t.short_id("TEMP_", F.col("document_id"), F.col("chunk_id"), F.col("entity_type"), F.col("name")))


def default_properties(entities: DataFrame, fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """Each type's properties with defaults, given ones from the whitelist on top."""
    base = F.create_map().cast("map<string,string>")
    allowed = F.array().cast("array<string>")
    for kind, names in fields.items():
        at = F.col("entity_type") == kind
        base = F.when(at, F.create_map(*[x for n in names for x in (F.lit(n), F.lit(""))])).otherwise(base)
        allowed = F.when(at, F.array(*map(F.lit, names))).otherwise(allowed)
    given = F.map_filter(F.coalesce("candidate_properties", F.create_map().cast("map<string,string>")), lambda k, v: F.array_contains(allowed, k))
    rest = F.map_filter(base, lambda k, v: ~F.map_contains_key(given, k))
    return entities.withColumn("properties", F.map_concat(rest, given))


def split_nodes(entities: DataFrame, with_review: bool = False) -> tuple[DataFrame, DataFrame]:
    """Graph nodes with the way their properties came about, and conflicts."""
    ok = F.col("status").isin(*(["accepted", "review"] if with_review else ["accepted"]))
    how = F.when(F.col("status") == "review", "review_defaults").when(F.col("response_status") == "ok", "ok").otherwise("fallback_defaults")
    nodes = entities.where(ok).withColumn("property_status", how).withColumn("confidence", F.greatest("probability", F.least(F.lit(1.0), F.coalesce("property_confidence", F.lit(0.0)))))
    return nodes, entities.where(~ok | F.col("status").isNull())


#: What each type is, for prompts.
GUIDANCE = {
    "diseases": "the disease that the whole document is about", "sub_diseases": "forms, stages and kinds of it that are diagnosed on their own",
    "symptoms": "what patients feel or what is seen on them", "tests": "examinations, measurements and their findings", "treatments": "aims and principles of treatment",
    "plans": "orders that can be carried out: drugs with dose and duration, operations, follow-up", "etiologies": "causes, triggers and risk factors", "pathogeneses": "mechanisms by which it comes about",
}


def prompts(chunks: DataFrame, modes: DataFrame, fields: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """A prompt for each chunk with labels to extract: what to look for, in which form to
    answer, and the chunk. modes: prompt_modes(); labels stand in order of name."""
    fields = fields or {}
    block = lambda k: f"- {k}: {GUIDANCE.get(k, k)}" + (f"; properties: {', '.join(fields[k])}" if k in fields else "")
    line = F.lit(None).cast("string")
    for kind in GUIDANCE:
        line = F.when(F.col("label") == kind, block(kind)).otherwise(line)
    line = F.when(F.col("mode") == "extract", line).otherwise(F.concat(line, F.lit(" (only if the text names it)")))
    g = modes.withColumn("line", line).where("line IS NOT NULL").groupBy("document_id", "chunk_id").agg(
        F.array_sort(F.collect_list(F.struct("label", "line"))).alias("l"), F.max(F.col("mode") == "extract").alias("any"))
    shape = F.concat(F.lit('{"'), F.array_join(F.transform("l", lambda x: x["label"]), '": [], "'), F.lit('": []}'))
    text = F.concat_ws("\n", F.lit("Find in the text:"), F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("Each item: name, evidence, confidence. Answer with one JSON object:"), shape, F.lit("Text:"), F.col("text"))
    return chunks.join(g.where("any"), ["document_id", "chunk_id"]).select("document_id", "chunk_id", text.alias("prompt"))


def extract(responses: DataFrame, decisions: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """E5: the entities of model answers (document_id, chunk_id, status, text), with ids and with
    flags where the first layer had rejected the type; answers that failed give none."""
    return override_flags(entity_base(parse_responses(responses, kinds)), decisions)


def extraction_report(chunks: DataFrame, responses: DataFrame, found: DataFrame) -> DataFrame:
    """Of each document the chunks, answers by outcome, and entities."""
    base = chunks.groupBy("document_id").agg(F.count("*").alias("chunks"))
    said = responses.groupBy("document_id").agg(F.count_if(F.col("status") == "ok").alias("answered"), F.count_if(F.col("status") != "ok").alias("failed"))
    got = found.groupBy("document_id").agg(F.count("*").alias("entities"))
    return base.join(said, "document_id", "left").join(got, "document_id", "left").na.fill(0)


def core_entity(docs: DataFrame) -> DataFrame:
    """H4: the disease that a document's title names, as an entity; titles without one give none."""
    named = docs.select("document_id", "title", t.core_disease_name(F.col("title")).alias("name")).where("name <> ''")
    ident = t.short_id("TEMP_", F.col("document_id"), F.lit("diseases"), F.col("name"))
    return named.select("document_id", ident.alias("entity_id"), F.lit("diseases").alias("entity_type"), "name", F.col("title").alias("evidence_text"), F.lit(0.98).alias("confidence"))


def labels_by_chunk(labels: DataFrame) -> DataFrame:
    """The labels of each chunk as an array; rows without a chunk go."""
    keep = labels.where("coalesce(cast(chunk_id AS string), '') <> ''")
    return keep.groupBy("document_id", "chunk_id").agg(F.array_sort(F.collect_list(F.struct("label", "present", "status"))).alias("labels"))


def batches(items: DataFrame, size: int, chars: int) -> DataFrame:
    """H7: the batch of each item (document_id, ord, text): one closes when it has `size` items or
    another would take it past `chars`."""
    def step(s: Column, x: Column) -> Column:
        full = (s["n"] >= size) | ((s["n"] > 0) & (s["chars"] + x["chars"] > chars))
        batch = s["batch"] + full.cast("int")
        return F.struct(batch.alias("batch"), F.when(full, 1).otherwise(s["n"] + 1).alias("n"), F.when(full, x["chars"]).otherwise(s["chars"] + x["chars"]).alias("chars"),
                        F.concat(s["out"], F.array(F.struct(x["ord"].alias("ord"), batch.alias("batch")))).alias("out"))

    kind = items.schema["ord"].dataType.simpleString()
    begin = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("n"), F.lit(0).alias("chars"), F.array().cast(f"array<struct<ord:{kind},batch:int>>").alias("out"))
    g = items.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("ord", F.length("text").alias("chars")))).alias("i"))
    return g.select("document_id", F.inline(F.aggregate("i", begin, step, lambda s: s["out"])))


def display_name(name: Column, *fallbacks: Column) -> Column:
    """The name, or the first of other fields that says something, else empty."""
    return F.coalesce(*[F.nullif(t.strip(F.coalesce(x, F.lit(""))), F.lit("")) for x in (name, *fallbacks)], F.lit(""))
