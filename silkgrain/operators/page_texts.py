"""Texts of pages completed by what models and OCR give: translated paragraphs (T9), recognised blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions import text as t


def english_paragraphs(pages: DataFrame) -> DataFrame:
    """document_id, page, n and paragraph of what is to be translated."""
    each = pages.select("document_id", "page", F.posexplode(F.split("text", "\n\n")).alias("n", "paragraph"))
    return each.where(t.is_english_paragraph(F.col("paragraph")))


def with_translations(pages: DataFrame, answers: DataFrame) -> DataFrame:
    """Pages (document_id, page, text) with each English paragraph replaced by its translation, translated (some was) and
    pending (some wasn't). answers: document_id, page, n, status, text; an answer that isn't ok, or is empty, counts as none.

    A page's answers meet it as one map, so the page's text is split where it is and put together again in place."""
    good = answers.where("status = 'ok' AND text <> ''").groupBy("document_id", "page").agg(F.map_from_entries(F.collect_list(F.struct(F.col("n").cast("int"), "text"))).alias("__a"))
    x = pages.join(good, ["document_id", "page"], "left")
    given = F.coalesce("__a", F.create_map().cast("map<int,string>"))
    parts = F.transform(F.split("text", "\n\n"), lambda p, n: F.struct(p.alias("old"), F.when(t.is_english_paragraph(p), F.coalesce(F.try_element_at(given, n), F.lit(""))).alias("new")))
    x = x.withColumn("__p", parts)
    done = F.coalesce(F.exists("__p", lambda p: F.coalesce(p["new"], F.lit("")) != ""), F.lit(False))
    left = F.coalesce(F.exists("__p", lambda p: p["new"].isNotNull() & (p["new"] == "")), F.lit(False))
    text = F.array_join(F.transform("__p", lambda p: F.when(F.coalesce(p["new"], F.lit("")) != "", p["new"]).otherwise(p["old"])), "\n\n")
    return x.withColumns({"text": text, "translated": done, "pending": left}).drop("__a", "__p")


# ---- recognised blocks
def _bare(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s+", "")


def _found(x: Column, pattern: str) -> Column:
    return F.rlike(x, F.lit(f"(?U){pattern}"))


def block_quality(block: Column) -> Column:
    """Chinese characters, less three for each short run of Latin letters or repeated marks."""
    return F.regexp_count(block, F.lit(t.CJK)) - 3 * F.regexp_count(block, F.lit(c.OCR_NOISE))


def ocr_blocks(lines: DataFrame) -> DataFrame:
    """T23, first half: lines (document_id, page, ord, line) that OCR read, to blocks: headings and recommendations.

    A block begins where a line shows its pattern, and ends before three blanks; a known heading stands for itself. A recommendation takes
    in up to three lines, what follows their last quotation mark, until the next block begins or its strength is told, where it ends.
    """
    x = lines.withColumn("line", t.normalize_whitespace(F.col("line"))).where((F.col("line") != "") & ~F.rlike("line", F.lit(c.OCR_FOOTER)))
    w = Window.partitionBy("document_id", "page").orderBy("ord")
    x = x.withColumns({f"__{k}": F.coalesce(F.lead("line", k).over(w), F.lit("")) for k in (1, 2, 3)})
    x = x.where(_found(F.col("line"), c.OCR_BLOCK))
    start = F.regexp_instr("line", F.lit(f"(?U){c.OCR_BLOCK}"))
    block = F.split(t.strip(F.substring("line", start, F.length("line"))), r"(?U)\s{3,}", 2)[0]
    heading = F.coalesce(*(F.when(F.contains(_bare(block), F.lit(h.replace(" ", ""))), F.lit(h)) for h in c.OCR_HEADINGS), block)
    x = x.withColumns({"block": heading, "open": _found(heading, c.OCR_ADVICE)})
    for k in (1, 2, 3):
        line = F.col(f"__{k}")
        go = F.col("open") & (line != "") & ~(_found(line, c.OCR_BLOCK) & ~_found(line, c.OCR_STRENGTH_MARK))
        taken = F.concat("block", t.strip(F.element_at(F.split(line, "”"), -1)))
        ends = F.contains(line, F.lit("推荐强度")) | F.contains(line, F.lit("强)")) | F.contains(line, F.lit("强）"))
        x = x.withColumns({"block": F.when(go, taken).otherwise(F.col("block")), "open": go & ~ends})
    cut = F.regexp_extract("block", f"(?sU)^(.*?{c.OCR_STRENGTH})", 1)
    block = F.when(_found(F.col("block"), c.OCR_ADVICE) & (cut != ""), cut).otherwise(F.col("block"))
    return x.select("document_id", "page", "ord", block.alias("block"))


def best_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks (document_id, page, ord, block) without repeats: of the recommendations of one number the best (the first of equals), of
    blocks that are equal but for blanks the first; rank puts them in order, recommendations last, by their number's first place."""
    number = F.nullif(F.regexp_extract("block", f"(?U){c.OCR_ADVICE}", 1), F.lit(""))
    x = blocks.withColumns({"number": number, "bare": _bare(F.col("block"))})
    of = Window.partitionBy("document_id", "page", "number")
    x = x.withColumn("__k", F.when(F.col("number").isNull(), 1).otherwise(F.row_number().over(of.orderBy(F.desc(block_quality(F.col("block"))), "ord"))))
    x = x.withColumn("__at", F.when(F.col("number").isNull(), F.col("ord")).otherwise(F.min("ord").over(of))).where("__k = 1")
    order = [F.col("number").isNotNull(), "__at"]
    x = x.withColumn("__r", F.row_number().over(Window.partitionBy("document_id", "page", "bare").orderBy(*order))).where("__r = 1")
    return x.withColumn("rank", F.row_number().over(Window.partitionBy("document_id", "page").orderBy(*order))).select("document_id", "page", "rank", "number", "block")


def advice_form(block: Column) -> Column:
    """A recommendation without blanks, with full-width marks."""
    x = F.regexp_replace(t.normalize_whitespace(block), f"(?U){c.OCR_ADVICE}\\s*", "推荐$1：")
    return F.regexp_replace(_bare(F.translate(x, "();", "（）；")), "(证据等级|推荐强度)[:：]", "$1：")


def with_blocks(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pages (document_id, page, text) with the blocks (as best_blocks() gives them) that they lack.

    A recommendation goes before the heading that its number is known to precede, else to the end; what the text has already (its first
    twelve characters, or all of it but for blanks) isn't put in. Other blocks follow at the end, known headings but not.
    A page's blocks are an array beside its text."""
    b = blocks.groupBy("document_id", "page").agg(F.array_sort(F.collect_list(F.struct("rank", "number", "block"))).alias("__b"))
    none = F.array().cast("array<struct<rank:int,number:string,block:string>>")
    x = pages.join(b, ["document_id", "page"], "left").withColumns({"text": F.coalesce("text", F.lit("")), "__b": F.coalesce("__b", none)})
    known = F.array(*(F.lit(h.replace(" ", "")) for h in c.OCR_HEADINGS))
    more = F.filter("__b", lambda v: v["number"].isNull() & ~F.array_contains(known, _bare(v["block"])) & ~F.contains(F.col("text"), F.substring(v["block"], 1, 12)))

    def put(text: Column, v: Column) -> Column:
        made = advice_form(v["block"])
        has = F.contains(text, F.substring(made, 1, 12)) | F.contains(_bare(text), made)
        at = F.lit(0)
        for number, pattern in c.OCR_BEFORE.items():
            at = F.when(v["number"] == number, F.regexp_instr(text, F.lit(f"(?mU){pattern}"))).otherwise(at)
        end = t.normalize_whitespace(F.concat(text, F.lit("\n\n"), made))
        inside = t.normalize_whitespace(F.concat(F.regexp_replace(F.substring(text, F.lit(1), at - 1), rf"{t.BLANK}+$", ""), F.lit("\n"), made, F.lit("\n\n"), F.regexp_replace(F.substring(text, at, F.length(text)), rf"^{t.BLANK}+", "")))
        return F.when(has, text).when(at > 0, inside).otherwise(end)

    text = F.aggregate(F.filter("__b", lambda v: v["number"].isNotNull()), F.col("text"), put)
    x = x.withColumns({"__more": F.transform(more, lambda v: v["block"]), "text": text})
    added = t.normalize_whitespace(F.concat("text", F.lit("\n\n"), F.array_join("__more", "\n")))
    return x.withColumn("text", F.when(F.size("__more") > 0, added).otherwise(F.col("text"))).drop("__b", "__more")
