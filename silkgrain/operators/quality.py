"""Gates and validation (F rows): flags are columns, so both outputs come from one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions import text as t

_CJK = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{2ceaf}]"
_READABLE = r"[A-Za-z，。；：、（）《》“”‘’！？\-—/%‰±=+<>≤≥~～·,.!?;:()\[\]{}]"


def text_quality(docs: DataFrame, text: str = "text", limits: dict | None = None) -> DataFrame:
    """counts by character class, ratios at four places, reasons and skip."""
    cfg = c.QUALITY | (limits or {})
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), t.BLANK, "")
    n = lambda p: F.regexp_count(F.col("__b"), F.lit(p))
    counted = docs.withColumn("__b", body).withColumns({
        "total_chars": F.length("__b"), "cjk_chars": n(_CJK), "ascii_letter_chars": n("[A-Za-z]"), "digit_chars": n(r"\p{Nd}"),
        "readable_chars": n(_CJK) + n(_READABLE) + n(r"\p{Nd}"), "replacement_chars": n(r"\x{fffd}"), "question_mark_chars": n(r"\?"),
        "control_chars": n(r"\p{C}"), "symbol_chars": n(r"\p{S}"), "private_use_chars": n(r"\p{Co}"),
    })
    ratio = lambda x: F.coalesce(F.round(F.try_divide(x, F.col("total_chars")), 4), F.lit(0.0))
    weird = F.col("replacement_chars") + F.greatest(F.lit(0), F.col("question_mark_chars") - 3) + F.col("control_chars") + F.col("symbol_chars") + F.col("private_use_chars")
    rated = counted.withColumns({
        "cjk_ratio": ratio(F.col("cjk_chars")), "ascii_letter_ratio": ratio(F.col("ascii_letter_chars")),
        "readable_ratio": ratio(F.col("readable_chars")), "weird_ratio": ratio(weird),
    })
    poor = (F.col("cjk_ratio") <= cfg["max_cjk_ratio"]) & (F.col("ascii_letter_ratio") < cfg["min_ascii_letter_ratio"])
    reasons = F.array_compact(F.array(
        F.when(F.col("total_chars") < cfg["min_text_chars"], F.lit("too_little_extracted_text")),
        F.when(poor & (F.col("readable_ratio") < cfg["min_readable_ratio"]), F.lit("low_chinese_and_low_readable_text")),
        F.when(poor & (F.col("weird_ratio") >= cfg["max_weird_ratio"]), F.lit("high_symbol_or_control_ratio")),
    ))
    return rated.drop("__b").withColumn("reasons", reasons).withColumn("skip", F.size("reasons") > 0)


def skipped_reports(rated: DataFrame) -> DataFrame:
    """a failing report for each skipped document."""
    return rated.where("skip").select("document_id", F.lit("skipped_garbled_text").alias("status"), F.array_join("reasons", ",").alias("reasons"), F.lit(0).alias("n_chunks"))


def language_drop(chunks: DataFrame, min_chars: int = 80, min_ratio: float = 0.2) -> DataFrame:
    """drop_reason for chunks of min_chars and more with too few CJK characters."""
    ratio = t.cjk_ratio(F.col("text"))
    return chunks.withColumn("cjk_ratio", ratio).withColumn("drop_reason", F.when((F.length(t.strip(F.col("text"))) >= min_chars) & (ratio < min_ratio), "low_cjk_ratio"))


#: What every chunk must have.
CHUNK_FIELDS = ("chunk_id", "path", "title", "page_start", "page_end", "start", "end", "text")


def validate_chunks(chunks: DataFrame, max_chars: int = 1200, min_chars: int = 200, required: tuple[str, ...] = CHUNK_FIELDS, noise: tuple[tuple[str, str], ...] = c.CHUNK_NOISE) -> DataFrame:
    """issues and warnings of each chunk as arrays; a chunk passes without issues.

    Issues: missing_field:<name> (null, or no such column), bad_page_range, bad_text_span, empty_text, too_long, noise:<name>,
    bad_page_region, and of linked_tables and linked_figures (arrays of object_id, object_type, bbox) bad_linked_type, missing_linked_id and bad_linked_bbox with the column's name,
    each once. Warning: too_short, where the document has more than one chunk. page_regions: array of (page, bbox).
    """
    has = chunks.columns
    text, n = F.coalesce(F.col("text"), F.lit("")), F.length(F.coalesce(F.col("text"), F.lit("")))
    tests = [(F.col(f).isNull() if f in has else F.lit(True), f"missing_field:{f}") for f in required]
    if {"page_start", "page_end"} <= set(has):
        tests.append((F.coalesce("page_start", F.lit(0)) > F.coalesce("page_end", F.lit(0)), "bad_page_range"))
    if {"start", "end"} <= set(has):
        tests.append((F.coalesce("start", F.lit(0)) >= F.coalesce("end", F.lit(0)), "bad_text_span"))
    tests += [(t.strip(text) == "", "empty_text"), (n > max_chars, "too_long"), *((F.rlike(text, F.lit(f"(?imU){p}")), f"noise:{k}") for k, p in noise)]
    if "page_regions" in has:
        tests.append((F.exists("page_regions", lambda r: r["page"].isNull() | r["bbox"].isNull() | (F.size(r["bbox"]) != 4)), "bad_page_region"))
    for name, kind in (("linked_tables", "table"), ("linked_figures", "figure")):
        if name in has:
            tests += [
                (F.exists(name, lambda x: ~x["object_type"].eqNullSafe(kind)), f"bad_linked_type:{name}"),  # noqa: B023
                (F.exists(name, lambda x: F.coalesce(x["object_id"], F.lit("")) == ""), f"missing_linked_id:{name}"),
                (F.exists(name, lambda x: (F.size(F.coalesce(x["bbox"], F.array())) > 0) & (F.size(x["bbox"]) != 4)), f"bad_linked_bbox:{name}"),
            ]
    several = F.count("*").over(Window.partitionBy("document_id")) > 1
    issues = F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in tests)))
    warnings = F.when((n < min_chars) & several, F.array(F.lit("too_short"))).otherwise(F.array().cast("array<string>"))
    return chunks.withColumns({"issues": issues, "warnings": warnings}).withColumn("passed", F.size("issues") == 0)


def suspicious_title(title: Column, tokens: tuple[str, ...] = c.SUSPICIOUS_TOKENS) -> Column:
    """why a title is suspicious, '' if it isn't."""
    x = t.strip(F.coalesce(title, F.lit("")))
    out = F.when(x == "", "empty_title").when(F.length(x) > 80, "title_too_long")
    for token in tokens:
        out = out.when(F.contains(F.lower(x), F.lit(token.lower())), f"contains_token:{token}")
    return out.when((F.regexp_count(x, F.lit("[0-9]")) >= 4) & (F.length(x) <= 12), "dense_digits_short_title").otherwise("")


def title_shape_issue(title: Column, longest: int = 90, tokens: tuple[str, ...] = c.HEADING_TOKENS, noise: tuple[str, ...] = c.NOISE_TITLES) -> Column:
    """F8: the first of the shape rules that a title breaks, '' if none."""
    x = F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)\s+", " "))
    tail = F.trim(F.regexp_extract(x, r"^[^：:]*[：:](.*)$", 1))
    out = (
        F.when(x == "", "empty_title").when(F.length(x) > longest, "title_too_long").when(F.rlike(x, F.lit("[，,、]$")), "truncated_line_fragment")
        .when(F.rlike(x, F.lit("[。；;，]")), "paragraph_punctuation").when(F.regexp_count(x, F.lit(r"\.")) >= 5, "paragraph_like")
        .when(F.length(tail) >= 12, "colon_body_fragment").when(F.rlike(x, F.lit(r"^\d{1,2}[．.、)].*[，,：:。；;]")), "numbered_body_fragment")
    )
    for token in tokens:
        out = out.when(F.contains(F.lower(x), F.lit(token)), f"contains_token:{token}")
    for p in noise:
        out = out.when(F.rlike(x, F.lit(f"(?iU){p}")), "noise_section")
    return out.when(F.rlike(x, F.lit(r"^\d+(?:\.\d+)?\s*[%~]")), "numeric_measurement").otherwise("")


def extractable(chunks: DataFrame, labels: DataFrame) -> DataFrame:
    """chunks with a label that is present and accepted or weak."""
    good = labels.where("present AND status IN ('accepted', 'weak')").select("document_id", "chunk_id").distinct()
    return chunks.join(good, ["document_id", "chunk_id"], "left_semi")


def usable_entities(entities: DataFrame, accepted_only: bool = False) -> DataFrame:
    """accepted entities (and those in review, diseases at least); documents without any
    status keep all."""
    known = F.max(F.col("status").isin("accepted", "review", "rejected")).over(Window.partitionBy("document_id"))
    review = (F.col("status") == "review") & (F.lit(not accepted_only) | (F.col("entity_type") == "diseases"))
    return entities.withColumn("__k", F.coalesce(known, F.lit(False))).where(~F.col("__k") | (F.col("status") == "accepted") | review).drop("__k")


def missing_hub(entities: DataFrame) -> DataFrame:
    """documents without a sub-disease, as error rows."""
    hubs = entities.where("entity_type = 'sub_diseases'").select("document_id").distinct()
    return entities.select("document_id").distinct().join(hubs, "document_id", "left_anti").withColumn("error", F.lit("no_sub_diseases"))


def usable_bbox(x0: Column, y0: Column, x1: Column, y1: Column, least: float = 2.0) -> Column:
    """positive area, sides of at least `least`, inside 0..5000."""
    return (x1 - x0 >= least) & (y1 - y0 >= least) & (F.least(x0, y0) >= 0) & (F.greatest(x1, y1) <= 5000)


def valid_edits(edits: DataFrame) -> DataFrame:
    """valid for all edits of a document or for none: inside bounds and pairwise disjoint."""
    w = Window.partitionBy("document_id").orderBy("start", "end")
    bad = (F.col("start") < 0) | (F.col("end") > F.col("n_chars")) | (F.col("start") >= F.col("end")) | F.coalesce(F.lead("start").over(w) < F.col("end"), F.lit(False))
    return edits.withColumn("__bad", bad).withColumn("valid", ~F.max("__bad").over(Window.partitionBy("document_id"))).drop("__bad")
