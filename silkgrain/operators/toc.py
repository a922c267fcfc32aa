"""Tables of contents from two sources, and a judge between them.

A document's candidates are an array beside its full text, so a text is read once for all of them and goes nowhere.
Candidates: document_id, ord (their order), title, level, start, page, source, evidence_text, confidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkgrain.functions import text as t
from silkgrain.operators import quality, segment

FIELDS = ("ord", "title", "level", "start", "page", "source", "evidence_text", "confidence")
SPACE = r"(?U)\s+"


def spaced(x: Column) -> Column:
    """One blank for many, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), SPACE, " "))


def place_of(text: Column, title: Column) -> Column:
    """Where a title stands first: as it is, else with any blanks for its blanks; code points from 0, null if nowhere.

    The second search is a pattern of the title's words, so what it finds is a place in the text as it is."""
    words = F.concat(F.lit(r"(?U)\Q"), F.replace(F.replace(spaced(title), F.lit(r"\E"), F.lit("")), F.lit(" "), F.lit(r"\E\s+\Q")), F.lit(r"\E"))
    exact = F.instr(text, title)
    return F.when(F.coalesce(title, F.lit("")) == "", None).when(exact > 0, exact - 1).when(spaced(title) != "", F.nullif(F.regexp_instr(text, words), F.lit(0)) - 1).cast("int")


def parsed_sections(answers: DataFrame, texts: DataFrame, source: str, confidence: float = 0.70) -> tuple[DataFrame, DataFrame]:
    """Candidates that answers (document_id, status, text, reason) name, and a report: document_id, status (ok, failed),
    reason (why: the answer's own, invalid_json, missing_sections). Levels are held to 1..4, null where they are no number."""
    item = "struct<title:string,level:string,page:string,evidence_text:string>"  # read one by one: what is no object names nothing
    body = t.json_object_strict(F.col("text"))
    x = answers.select("document_id", "status", F.coalesce("reason", F.lit("")).alias("reason"), body.alias("__j"))
    x = x.withColumn("__s", F.transform(F.from_json("__j", "struct<sections:array<string>>")["sections"], lambda e: F.from_json(e, item)))
    why = F.when(F.coalesce(F.col("status") != "ok", F.lit(True)), F.col("reason")).when(F.col("__j").isNull(), "invalid_json").when(F.col("__s").isNull(), "missing_sections")
    x = x.withColumn("__why", why).withColumn("status", F.when(why.isNull(), "ok").otherwise("failed"))
    made = x.where("status = 'ok'").select("document_id", F.posexplode("__s").alias("ord", "s")).withColumn("title", spaced(F.col("s.title"))).where("title <> ''")
    number = lambda c: F.expr(f"try_cast(try_cast({c} AS double) AS int)")
    made = made.select("document_id", F.struct("ord", "title", F.when(number("s.level").isNotNull(), F.greatest(F.lit(1), F.least(F.lit(4), number("s.level")))).alias("level"), number("s.page").alias("page"), F.coalesce("s.evidence_text", "title").alias("evidence_text")).alias("c"))
    g = made.groupBy("document_id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    out = texts.select("document_id", "full_text").join(g, "document_id").select("document_id", F.inline(F.transform("cs", lambda c: F.struct(
        c["ord"].alias("ord"), c["title"].alias("title"), c["level"].alias("level"), place_of(F.col("full_text"), c["evidence_text"]).alias("start"), c["page"].alias("page"),
        F.lit(source).alias("source"), c["evidence_text"].alias("evidence_text"), F.lit(confidence).alias("confidence")))))
    return out, x.select("document_id", "status", F.coalesce("__why", F.lit("")).alias("reason"))


def rule_source(texts: DataFrame) -> DataFrame:
    """C13 as candidates, in order of their places."""
    found = segment.rule_candidates(texts)
    return found.withColumn("ord", F.row_number().over(Window.partitionBy("document_id").orderBy("start"))).select("document_id", *FIELDS)


def validated(cands: DataFrame, texts: DataFrame) -> DataFrame:
    """C14: candidates with exact (their evidence, or title, stands in the text), start (found where it is missing),
    shape_issue and valid. Candidates of documents without a text go."""
    g = cands.select("document_id", F.struct(*FIELDS).alias("c")).groupBy("document_id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    evidence = lambda c: F.coalesce(F.nullif(c["evidence_text"], F.lit("")), c["title"], F.lit(""))
    x = texts.select("document_id", "full_text").join(g, "document_id").select("document_id", F.inline(F.transform("cs", lambda c: F.struct(
        *(c[f].alias(f) for f in FIELDS if f != "start"), F.coalesce(c["start"], place_of(F.col("full_text"), evidence(c))).alias("start"),
        ((evidence(c) != "") & F.contains(F.col("full_text"), evidence(c))).alias("exact")))))
    x = x.withColumn("shape_issue", quality.title_shape_issue(F.col("title")))
    return x.withColumn("valid", F.coalesce(F.col("exact") & F.col("start").isNotNull() & (F.col("shape_issue") == ""), F.lit(False)))


def decided(checked: DataFrame) -> DataFrame:
    """C14: the valid candidates of one place and title as one: sources, level (the first that is known, else 1; held to 1..4),
    page and evidence of the first, confidence (the greatest, 0.90 at least with two sources) and reason."""
    g = checked.where("valid").withColumn("title", spaced(F.col("title"))).groupBy("document_id", "start", "title").agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.min_by("level", F.when(F.col("level").isNotNull(), F.struct(F.col("source") != "rule", F.col("ord")))).alias("level"),
        F.min_by("page", F.struct(F.col("source") != "rule", F.col("ord"))).alias("page"), F.min_by("evidence_text", F.struct(F.col("source") != "rule", F.col("ord"))).alias("evidence_text"), F.max("confidence").alias("confidence"),
    )
    two = F.size("sources") > 1
    return g.withColumns({
        "level": F.greatest(F.lit(1), F.least(F.lit(4), F.coalesce("level", F.lit(1)))), "confidence": F.round(F.when(two, F.greatest("confidence", F.lit(0.90))).otherwise(F.col("confidence")), 4),
        "reason": F.when(two, "sources_agree").otherwise("local_validated"),
    })


def local_metrics(checked: DataFrame, decisions: DataFrame, texts: DataFrame) -> DataFrame:
    """C16 for both layers: one row for each text: candidates, accepted titles, shares of valid and of misshapen candidates,
    titles a page (and whether that is suspicious), share of places in order and jumps of more than one level."""
    w = Window.partitionBy("document_id").orderBy("start", "title")
    seen = checked.groupBy("document_id").agg(F.count("*").alias("candidates"), F.count_if("valid").alias("good"), F.count_if(F.col("shape_issue") != "").alias("odd"))
    nxt = decisions.withColumns({"up": F.lead("start").over(w) > F.col("start"), "jump": F.lead("level").over(w) - F.col("level") > 1})
    kept = nxt.groupBy("document_id").agg(F.count("*").alias("titles"), F.count_if("up").alias("up"), F.count_if("jump").alias("level_jumps"))
    x = texts.select("document_id", F.greatest(F.lit(1), F.size("pages")).alias("n_pages")).join(seen, "document_id", "left").join(kept, "document_id", "left").na.fill(0)
    share = lambda a, b: F.coalesce(F.round(F.try_divide(F.col(a), F.col(b)), 4), F.lit(0.0))
    density = F.col("titles") / F.col("n_pages")
    return x.select(
        "document_id", "candidates", "titles", share("good", "candidates").alias("match_rate"), share("odd", "candidates").alias("noise_rate"), F.round(density, 4).alias("page_density"),
        ((density < 0.15) | (density > 6.0)).alias("suspicious_density"), F.when(F.col("titles") == 0, 0.0).otherwise(F.round(F.col("up") / F.greatest(F.lit(1), F.col("titles") - 1), 4)).alias("in_order"), "level_jumps",
    )


def dual_toc(texts: DataFrame, first: DataFrame | None = None, judge: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sections with text, decisions and a report for each text (document_id, full_text, pages: segment.full_text()).

    Headings that the rules find and those that `first` answers name are checked and merged. `judge` answers, where they
    can be read and name at least one valid section, take the place of what was merged; else that stands, and judge_status and
    judge_reason say why. Answers: document_id, status, text, reason; None: that model wasn't asked (skipped).
    """
    cands, told = rule_source(texts), None
    if first is not None:
        named, told = parsed_sections(first, texts, "model")
        cands = cands.unionByName(named)
    checked = validated(cands, texts)
    local = decided(checked)
    final = local.withColumn("judged", F.lit(False))
    report = texts.select("document_id")
    asked = lambda r, name: report.join(r.select("document_id", F.col("status").alias(f"{name}_status"), F.col("reason").alias(f"{name}_reason")), "document_id", "left").withColumns({f"{name}_status": F.coalesce(f"{name}_status", F.lit("skipped")), f"{name}_reason": F.coalesce(f"{name}_reason", F.lit(""))})
    skipped = texts.select("document_id", F.lit("skipped").alias("status"), F.lit("").alias("reason"))
    report = asked(told if told is not None else skipped, "model")
    verdict = skipped
    if judge is not None:
        named, said = parsed_sections(judge, texts, "judge")
        better = decided(validated(named, texts))
        has = better.select("document_id").distinct().withColumn("has", F.lit(True))
        final = local.join(has, "document_id", "left_anti").withColumn("judged", F.lit(False)).unionByName(better.withColumn("judged", F.lit(True)))
        said = said.join(has, "document_id", "left")
        none = (F.col("status") == "ok") & F.col("has").isNull()
        verdict = said.select("document_id", F.when(none, "failed").otherwise(F.col("status")).alias("status"), F.when(none, "no_valid_sections").otherwise(F.col("reason")).alias("reason"))
    report = asked(verdict, "judge").join(local_metrics(checked, local, texts), "document_id", "left")
    n = final.groupBy("document_id").agg(F.count("*").alias("final_titles"))
    report = report.join(n, "document_id", "left").na.fill(0, ["final_titles"])
    heads = final.join(texts.select("document_id", F.length("full_text").alias("n_chars")), "document_id").select("document_id", "start", "title", "level", "n_chars")
    return segment.cut_at(texts.select("document_id", "full_text"), segment.sections(heads), "full_text"), final, report
