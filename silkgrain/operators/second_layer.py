"""The second layer: from candidate entities to typed ones, and on to nodes.

An entity's votes are an array in its row from beginning to end: rule LFs write it in the projection that reads the
chunk, answers of prompts are appended by one join, and scores, ranking, protection and override read it where it is.
Only the label model, which needs counts over all entities, takes the array apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions import text as t
from silkgrain.operators import fusion
from silkgrain.operators import labeling as lab
from silkgrain.sources.tables import written

ENTITY = ("document_id", "entity_id")
VOTE = "array<struct<lf:string,label:string,vote:int,confidence:double>>"
RULES = ("suggested", "surface", "context", "section")


def is_located(text: Column, evidence: Column, name: Column) -> Column:
    """Whether evidence or name stands in the text, as it is or without blanks, case and width; false without a text."""
    parts = [t.strip(F.coalesce(x, F.lit(""))) for x in (evidence, name)]
    exact = [(p != "") & F.contains(text, p) for p in parts]
    # Spark works out ahead what two sides of an "or" share, but not what stands in a branch.
    loose = F.exists(F.array(t.anchor(text)), lambda a: reduce(lambda x, y: x | y, [(p != "") & F.contains(a, t.anchor(p)) for p in parts]))
    return F.coalesce(F.when(reduce(lambda a, b: a | b, exact), True).otherwise(loose), F.lit(False))


def _struct(lf: str, label: str, vote: Column, confidence: Column) -> Column:
    return F.struct(F.lit(lf).alias("lf"), F.lit(label).alias("label"), vote.cast("int").alias("vote"), confidence.cast("double").alias("confidence"))


def rule_votes(kinds: tuple[str, ...], lfs: tuple[str, ...] = RULES) -> Column:
    """The votes of the named rule LFs on every type, as an array in order of LF and type.

    Columns: entity_type, __section and what labeling.searched() makes, as traced() has them.
    """
    table = lambda patterns, kind: patterns.get(kind, ())
    made = {
        "suggested": lambda k: lab.suggested_type_vote(F.lit(k), F.col("entity_type")),
        "surface": lambda k: lab.surface_said(F.col(f"__surface_{k}")),
        "context": lambda k: lab.context_said(F.col(f"__context_{k}")),
        "section": lambda k: lab.section_prior_vote(F.col("__section"), table(c.SECTION_TERMS, k)),
    }
    votes = [_struct(lf, k, *made[lf](k)) for lf in lfs for k in kinds]
    return F.array(*votes) if votes else F.array().cast(VOTE)


def answer_votes(answers: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """document_id, entity_id and votes, from answers (document_id, entity_id, lf, label, status, present, confidence,
    count, evidence); the last of two answers by an LF on one type counts, if they have an ord, else the surest."""
    by = ["ord"] if "ord" in answers.columns else []
    known = answers.where(F.col("label").isin(*kinds))
    last = known.groupBy(*ENTITY, "lf", "label").agg(F.max_by(F.struct("status", "present", "confidence", "count", "evidence"), F.struct(*by, "confidence", "present")).alias("a"))
    v = lab.response_vote("", "", F.col("a.present"), F.col("a.confidence"), F.col("a.count"), F.col("a.evidence"), F.col("a.status"))
    return last.select(*ENTITY, F.struct("lf", "label", v["vote"].alias("vote"), v["confidence"].alias("confidence")).alias("v")).groupBy(*ENTITY).agg(F.array_sort(F.collect_list("v")).cast(VOTE).alias("__said"))


def traced(entities: DataFrame, chunks: DataFrame, answers: DataFrame | None = None, kinds: tuple[str, ...] = c.ENTITY_TYPES, lfs: tuple[str, ...] = RULES) -> DataFrame:
    """entities with chunk text, section, located and trace: all votes on all types.

    entities: document_id, entity_id, chunk_id, entity_type, name, evidence_text and whatever else; chunks: document_id,
    chunk_id, text, section. An entity whose chunk is missing has no text and isn't located.
    """
    known = chunks.select("document_id", "chunk_id", F.col("text").alias("__text"), F.col("section").alias("__section"))
    x = entities.join(known, ["document_id", "chunk_id"], "left")
    name, evidence = F.coalesce("name", F.lit("")), F.coalesce("evidence_text", F.lit(""))
    x = x.withColumns({
        "located": is_located(F.col("__text"), evidence, name), "__surface": F.concat_ws(" ", name, evidence),
        "__window": lab.evidence_window(F.coalesce("__text", F.lit("")), evidence), "__section": F.coalesce("__section", F.lit("")),
    })
    found = lab.searched(F.col("__surface"), F.col("__window"), kinds)
    x = x.withColumns(found).withColumn("trace", rule_votes(kinds, lfs)).drop("__text", "__surface", "__window", "__section", *found)
    if answers is None:
        return x
    return x.join(answer_votes(answers, kinds), list(ENTITY), "left").withColumn("trace", F.concat("trace", F.coalesce("__said", F.array().cast(VOTE)))).drop("__said")


def _folded(kinds: tuple[str, ...]) -> Column:
    """Each type's score: what the trace says for it, less 0.6 of what it says against it."""

    def score(kind: str) -> Column:
        own = F.filter("trace", lambda v: v["label"] == kind)
        gain = lambda v: F.when(v["vote"] > 0, 1.0).when(v["vote"] < 0, -0.6).otherwise(0.0) * F.greatest(F.lit(0.0), v["confidence"])
        return F.aggregate(own, F.lit(0.0), lambda a, v: a + gain(v))

    return F.array(*map(score, kinds))


def _ranked(values: Column, kinds: tuple[str, ...]) -> Column:
    """Types with their values, best first, equals (to twelve digits) in the order of the types."""
    pairs = F.transform(values, lambda p, i: F.struct((-F.round(p, 12)).alias("down"), i.alias("place"), F.get(F.array(*map(F.lit, kinds)), i).alias("label"), p.alias("probability")))
    return F.array_sort(pairs)


def fused(trace: DataFrame, kinds: tuple[str, ...] = c.ENTITY_TYPES, model: DataFrame | None = None) -> DataFrame:
    """Trace with probabilities, final_type, probability, gap and backend.

    model: document_id, entity_id and one_vs_rest (label -> probability), as label_models() gives them; what it has takes
    the softmax's place, normalised to a sum of one (all equal to 0: to 0).
    """
    x = trace.withColumn("__s", _folded(kinds)).withColumn("__m", F.array_max("__s"))
    x = x.withColumn("__e", F.transform("__s", lambda s: F.exp(s - F.col("__m")))).withColumn("__t", F.aggregate("__e", F.lit(0.0), lambda a, e: a + e))
    x = x.withColumn("__p", F.transform("__e", lambda e: e / F.col("__t"))).withColumn("backend", F.lit("local_fusion"))
    if model is not None:
        x = x.join(model, list(ENTITY), "left")
        raw = F.array(*(F.coalesce(F.col("one_vs_rest")[k], F.lit(0.0)) for k in kinds))
        x = x.withColumn("__o", raw).withColumn("__t", F.aggregate("__o", F.lit(0.0), lambda a, e: a + e))
        made = F.transform("__o", lambda e: e / F.when(F.col("__t") == 0, 1.0).otherwise(F.col("__t")))
        x = x.withColumn("__p", F.when(F.col("one_vs_rest").isNotNull(), made).otherwise(F.col("__p"))).withColumn("backend", F.when(F.col("one_vs_rest").isNotNull(), "label_model").otherwise(F.col("backend")))
    x = x.withColumn("__r", _ranked(F.col("__p"), kinds))
    first, second = F.get("__r", F.lit(0)), F.get("__r", F.lit(1))
    x = x.withColumns({
        "probabilities": F.map_from_arrays(F.array(*map(F.lit, kinds)), F.transform("__p", lambda p: F.round(p, 6))), "final_type": first["label"],
        "probability": first["probability"], "gap": first["probability"] - F.coalesce(second["probability"], F.lit(0.0)),
    })
    return x.drop("__s", "__m", "__e", "__t", "__p", "__o", "__r")


def label_models(trace: DataFrame, accept: float = c.ACCEPT) -> DataFrame:
    """A9 for entities: a label model for each type over all votes: document_id, entity_id and one_vs_rest."""
    votes = trace.select(*ENTITY, F.inline("trace")).withColumnRenamed("entity_id", "chunk_id")
    made = fusion.label_model(votes, dict.fromkeys(c.ENTITY_TYPES, accept))
    by = made.groupBy("document_id", F.col("chunk_id").alias("entity_id"))
    return by.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "probability")))).alias("one_vs_rest"))


def _voters(label: Column) -> Column:
    """Names of the LFs that vote for or against the label."""
    return F.transform(F.filter("trace", lambda v: (v["label"] == label) & (v["vote"] != 0)), lambda v: v["lf"])


def protected(triaged: DataFrame, prompts: int = 3, sure: float = 0.8, prefix: str = "prompt", kinds: tuple[str, ...] = c.ENTITY_TYPES) -> DataFrame:
    """A19 on the trace: where that many prompts are sure of the candidate type and none is of another, it is accepted."""
    own = F.filter("trace", lambda v: (v["vote"] > 0) & (v["confidence"] >= sure) & v["lf"].startswith(prefix) & (v["label"] == F.col("entity_type")))
    other = F.exists("trace", lambda v: (v["vote"] > 0) & (v["confidence"] >= sure) & v["lf"].startswith(prefix) & (v["label"] != F.col("entity_type")))
    x = triaged.withColumn("__own", own)
    names = F.array_distinct(F.transform("__own", lambda v: v["lf"]))
    hit = F.coalesce(F.col("entity_type").isin(*kinds) & F.col("located") & (F.size(names) >= prompts) & ~other, F.lit(False))
    mean = F.aggregate("__own", F.lit(0.0), lambda a, v: a + v["confidence"]) / F.greatest(F.size("__own"), F.lit(1))
    x = x.withColumns({"protected": hit, "__mean": mean, "__names": F.transform("__own", lambda v: v["lf"])})
    then = lambda a, b: F.when(F.col("protected"), a).otherwise(F.col(b))
    return x.withColumns({
        "final_type": then(F.col("entity_type"), "final_type"), "probability": then(F.greatest("__mean", "probability"), "probability"), "gap": then(F.greatest("gap", F.lit(0.2)), "gap"),
        "status": then(F.lit("accepted"), "status"), "reasons": then(F.array().cast("array<string>"), "reasons"), "source_lfs": then(F.col("__names"), "source_lfs"),
        "backend": then(F.concat("backend", F.lit("_with_protection")), "backend"),
    }).drop("__own", "__mean", "__names")


def overridden(triaged: DataFrame, patterns: tuple[str, ...] = c.PLAN_PATTERNS) -> DataFrame:
    """A20 with what it records: treatments that give an order become plans; plan_patterns names what says so (five at most)."""
    text = F.concat_ws("\n", F.coalesce("name", F.lit("")), F.coalesce("evidence_text", F.lit("")))
    found = F.array_compact(F.array(*(F.when(F.rlike(text, F.lit(f"(?iU){p}")), F.lit(p)) for p in patterns)))
    kind = F.col("final_type").isin("treatments", "plans") | F.coalesce(F.col("entity_type").isin("treatments", "plans"), F.lit(False))
    x = triaged.withColumn("plan_patterns", F.when(kind, F.slice(found, 1, 5)).otherwise(F.array().cast("array<string>"))).withColumn("overridden", F.size("plan_patterns") > 0)
    then = lambda a, b: F.when(F.col("overridden"), a).otherwise(F.col(b))
    sure = F.col("overridden") & F.col("located")
    return x.withColumns({
        "final_type": then(F.lit("plans"), "final_type"), "probability": then(F.greatest("probability", F.lit(0.72)), "probability"), "gap": then(F.greatest("gap", F.lit(0.2)), "gap"),
        "status": F.when(sure, "accepted").otherwise(F.col("status")), "reasons": F.when(sure, F.array().cast("array<string>")).otherwise(F.col("reasons")),
        "source_lfs": then(F.concat("source_lfs", F.array(F.lit("plan_boundary"))), "source_lfs"), "backend": then(F.concat("backend", F.lit("_with_plan_override")), "backend"),
    })


def label_entities(
    entities: DataFrame, chunks: DataFrame, answers: DataFrame | None = None, with_model: bool = True, kinds: tuple[str, ...] = c.ENTITY_TYPES,
    accept: float = c.ACCEPT, review: float = c.REVIEW, gap: float = c.MIN_GAP, lfs: tuple[str, ...] = RULES,
) -> DataFrame:
    """A row for each entity: its columns, located, trace, probabilities, final_type, probability, gap, status,
    reasons, source_lfs, backend, protected, overridden, plan_patterns (and one_vs_rest).

    Votes of rules and prompts are fused by label models over all entities (with_model) or by each entity's own softmax;
    protection and override hold on both ways. Entities with a null in document_id or entity_id keep the softmax, since nothing can
    be joined to them. Where no type has votes all are equally probable, and the first of the types is named.
    """
    trace = traced(entities, chunks, answers, kinds, lfs)
    if with_model:
        trace = written(trace)
    x = fused(trace, kinds, label_models(trace, accept) if with_model else None)
    x = x.withColumn("candidate_type", F.col("entity_type"))
    x = fusion.triage(x, accept, review, gap, kinds).withColumn("source_lfs", _voters(F.col("final_type")))
    x = overridden(protected(x, kinds=kinds))
    return x.withColumns({"probability": F.round("probability", 6), "gap": F.round("gap", 6)})


def conflicts(results: DataFrame) -> DataFrame:
    """What wasn't accepted, and why."""
    return results.where("status <> 'accepted'").select(*ENTITY, "chunk_id", "name", F.col("entity_type").alias("candidate_type"), "final_type", "status", "reasons", "probability", "gap")


def entity_nodes(results: DataFrame, fields: dict[str, dict[str, str]], answers: DataFrame | None = None, with_review: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes of accepted entities and of those in review, and the conflicts on the way.

    fields: type -> property -> default; "@id" and "@name" stand for the entity's own. answers: document_id, entity_id,
    status, properties (map), confidence, reason; they are used for accepted entities, and for review ones with_review. A
    type's properties are its defaults with what answers say on top, and no others; status and type stay. property_status is ok,
    fallback_defaults or review_defaults; the last two are conflicts as well, as is every entity without a node.
    Results are stored first: a filter on status would else be pushed below the votes, each of which it would repeat many times.
    """
    results = written(results.select(*ENTITY, "chunk_id", "name", "evidence_text", "final_type", "probability", "gap", "status", "reasons", "source_lfs"))
    none = results.select(*ENTITY).where("false").withColumns({"__ok": F.lit(True), "__p": F.lit(None).cast("map<string,string>"), "__c": F.lit(0.0), "__why": F.lit("")})
    said = none if answers is None else answers.groupBy(*ENTITY).agg(F.max_by(F.struct("status", "properties", "confidence", "reason"), F.struct(F.col("status") == "ok", "confidence")).alias("a")).select(
        *ENTITY, ((F.col("a.status") == "ok") & F.col("a.properties").isNotNull()).alias("__ok"), F.col("a.properties").alias("__p"), F.col("a.confidence").alias("__c"), F.col("a.reason").alias("__why")
    )
    x = results.join(said, list(ENTITY), "left")
    node = F.col("status").isin("accepted", "review")
    asked = (F.col("status") == "accepted") | (F.lit(with_review) & (F.col("status") == "review"))
    ok = asked & F.coalesce("__ok", F.lit(False))
    how = F.when(~asked, "review_defaults").when(ok, "ok").otherwise("fallback_defaults")
    own = {"@id": F.col("entity_id").cast("string"), "@name": F.coalesce("name", F.lit(""))}
    base = F.create_map().cast("map<string,string>")
    for kind, defaults in fields.items():
        cells = [y for k, v in defaults.items() for y in (F.lit(k), own.get(v, F.lit(v)))]
        base = F.when(F.col("final_type") == kind, F.create_map(*cells)).otherwise(base)
    sure = F.when(ok & F.col("__c").isNotNull(), F.greatest("probability", F.least(F.lit(1.0), "__c"))).otherwise(F.col("probability"))
    x = x.withColumns({"property_status": how, "confidence": sure, "__base": base})
    given = F.map_filter(F.when(ok, F.coalesce("__p", F.create_map().cast("map<string,string>"))).otherwise(F.create_map().cast("map<string,string>")), lambda k, v: F.map_contains_key("__base", k))
    x = x.withColumn("properties", F.map_zip_with("__base", given, lambda k, a, b: F.coalesce(b, a)))
    nodes = x.where(node).select(*ENTITY, "chunk_id", F.col("final_type").alias("entity_type"), "name", "evidence_text", "properties", "confidence", "status", "property_status", "source_lfs", "probability", "gap")
    why = F.when(~node, F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit("not_selected")))).when(~asked, F.array(F.lit("review_not_asked"))).otherwise(F.array(F.coalesce("__why", F.lit("no_answer"))))
    bad = x.where(~node | (F.col("property_status") != "ok")).select(*ENTITY, "name", "final_type", F.when(~node, F.col("status")).otherwise("property_incomplete").alias("status"), why.alias("reasons"))
    return nodes, bad
