"""Segmentation (C rows). Documents are rows; what runs in order inside one document is a fold
over its array, so nothing but document keys is shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions import text as t
from silkgrain.operators import quality

CN = "一二三四五六七八九十"


def full_text(pages: DataFrame) -> DataFrame:
    """Pages in order joined by empty lines, with each page's start."""
    w = Window.partitionBy("document_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    placed = pages.withColumn("start", F.coalesce(F.sum(F.length("text") + 2).over(w), F.lit(0)).cast("int"))
    g = placed.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("page_number", "start", "text"))).alias("p"))
    return g.select("document_id", F.rtrim(F.array_join(F.transform("p", lambda x: x["text"]), "\n\n")).alias("full_text"), F.transform("p", lambda x: F.struct(x["page_number"].alias("page"), x["start"].alias("start"))).alias("pages"))


def page_of(pages: Column, pos: Column) -> Column:
    """The last page that starts at or before a position, with the offset inside it."""
    best = F.get(F.filter(pages, lambda p: p["start"] <= pos), F.greatest(F.size(F.filter(pages, lambda p: p["start"] <= pos)) - 1, F.lit(0)))
    return F.struct(best["page"].alias("page"), (pos - best["start"]).alias("offset"))


def heading_level(title: Column, common: tuple[str, ...] = ("摘要", "引言", "概述", "临床表现", "诊断", "鉴别诊断", "检查", "治疗", "治疗原则", "治疗方案", "推荐意见", "共识建议", "病理生理机制", "预后", "参考文献"),
                  english: tuple[str, ...] = ("abstract", "introduction", "background", "methods", "materials and methods", "results", "discussion", "conclusion", "conclusions", "references")) -> Column:
    """1 to 4, or null for lines that are no heading. Rules in order; the first decides."""
    x = F.trim(F.regexp_replace(title, r"\s+", " "))
    x = F.when(F.rlike(x, F.lit(r"^\[.+\]$|^【.+】$")), F.trim(F.substring(x, F.lit(2), F.length(x) - 2))).otherwise(x)
    m = lambda p: F.rlike(x, F.lit(p))
    blocked = F.lit(False)
    for token in ("vs.", "rr", "ci", "p<", "p=", "g/d", "mg", "mmol", "%"):
        blocked = blocked | F.contains(F.lower(x), F.lit(token))
    numeric = m(r"^\d{1,2}(?:\.\d{1,2}){1,3}\s*(?![%~])\S+")
    depth = F.regexp_count(F.regexp_extract(x, r"^(\d{1,2}(?:\.\d{1,2}){1,3})", 1), F.lit(r"\."))
    return (
        F.when((x == "") | (F.length(x) > 90) | (F.regexp_count(x, F.lit("。")) >= 2), F.lit(None).cast("int"))
        .when(x.isin(*common) | F.lower(x).isin(*english), 1)
        .when(m(rf"^第[{CN}\d]+[章节篇部分]"), 1).when(m(r"^\d{1,2}\s+[\x{4e00}-\x{9fff}]\S+"), 1).when(m(r"^\d{1,2}\.\d{1,2}\s*[\x{4e00}-\x{9fff}]\S+"), 2)
        .when(m(rf"^[{CN}]{{1,3}}[、.．\s]\s*\S+"), 1).when(m(rf"^[（(][{CN}]{{1,3}}[）)]\s*\S+"), 2).when(m(r"^\d{1,2}[）)]\s*\S+"), 3)
        .when(numeric & ((F.length(x) > 60) | ~m(r"[\x{4e00}-\x{9fff}]") | blocked | m("[，,。；;/]")), F.lit(None).cast("int"))
        .when(numeric, F.least(depth + 3, F.lit(4)))
        .when(m(r"^\d{1,2}[.．、]\s*(?!\d|%)\S+"), 2).when(m(r"^\d{1,2}(?=\d{4}年).{0,40}(比较|解读)$"), 2)
        .when(m("(比较|解读|概述|总论|小结|总结)$") & (F.length(x) <= 40) & m("指南|共识"), 2)
    )


def lines(docs: DataFrame, text: str = "full_text") -> DataFrame:
    """document_id, line_no, line, start (code points before it), n_chars of the document."""
    parts = F.split(F.col(text), "\n")
    # Not posexplode: its condition on the text would go below a shuffle that is to be used again.
    exploded = docs.select("document_id", F.length(text).alias("n_chars"), F.posexplode_outer(parts).alias("line_no", "line")).where("line_no IS NOT NULL")
    w = Window.partitionBy("document_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return exploded.withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)).cast("int"))


def anchors(lined: DataFrame, level: Column | None = None) -> DataFrame:
    """C4: lines that are headings, with level; one for each start."""
    if level is None:  # a line that stays longer than any heading needs no further look
        lined = lined.where(F.length(F.translate("line", " \t", "")) <= 90)
        level = heading_level(F.col("line"))
    return lined.withColumn("level", level).where("level IS NOT NULL").withColumn("title", F.trim(F.regexp_replace("line", r"\s+", " ")))


DEEPEST = 6


def sections(found: DataFrame) -> DataFrame:
    """Each anchor reaches to the next; its path is the stack cut to its level and extended.

    An anchor's depth is the least of its place in the document and, over it and all anchors before,
    of (their level - their place + its place); on each lesser depth the last anchor is its parent.
    """
    w = Window.partitionBy("document_id").orderBy("start", "title")
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    base = F.min("level").over(Window.partitionBy("document_id"))
    a = found.withColumn("end", F.coalesce(F.lead("start").over(w), F.col("n_chars"))).withColumn("i", F.row_number().over(w))
    a = a.withColumn("eff", F.least(F.lit(DEEPEST), F.greatest(F.lit(1), F.col("level") - base + 1)))
    a = a.withColumn("depth", F.least("i", F.min(F.col("eff") - F.col("i")).over(before) + F.col("i")))
    parents = F.array(*[F.last(F.when(F.col("depth") == k, F.col("title")), True).over(before) for k in range(1, DEEPEST + 1)])
    path = F.concat(F.array(F.lit(c.WHOLE_SECTION)), F.slice(parents, F.lit(1), F.col("depth")))
    return a.select("document_id", "start", "end", "title", path.alias("path"), "level")


def document_sections(docs: DataFrame, text: str = "text", level: Column | None = None) -> DataFrame:
    """C5 of whole documents, by their headings."""
    return cut_at(docs, sections(anchors(lines(docs, text), level)), text)


def cut_at(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """Documents as sections (start, end, title, path, level) with their text; what stands before the first of them is a
    section of its own, and a document without any is one section."""
    found = found.withColumn("head", F.struct("start", "end", "title", "path", "level"))
    # The id as an aggregate: "is not null" of the join stays above it, so that lines and texts come from one shuffle.
    g = found.groupBy("document_id").agg(F.array_sort(F.collect_list("head")).alias("s"), F.max("document_id").alias("__of")).select("__of", "s").withColumnRenamed("__of", "document_id")
    body, none = F.col(text), F.lit(None).cast("int")
    one = lambda end, title, path: F.struct(F.lit(0).alias("start"), end.alias("end"), F.lit(title).alias("title"), F.array(*map(F.lit, path)).alias("path"), none.alias("level"))
    first = F.col("s")[0]["start"]
    preface = F.when((first > 0) & (t.strip(F.substring(body, F.lit(1), first)) != ""), F.array(one(first, c.PREFACE, (c.WHOLE_SECTION, c.PREFACE))))
    whole = F.array(one(F.length(body), c.WHOLE_SECTION, (c.WHOLE_SECTION,)))
    all_ = F.when(F.col("s").isNull(), whole).otherwise(F.concat(F.coalesce(preface, F.slice(whole, 1, 0)), "s"))
    x = docs.join(g, "document_id", "left").select("document_id", body.alias("__t"), F.inline(all_))
    return x.withColumn("text", F.substring(F.col("__t"), F.col("start") + 1, F.col("end") - F.col("start"))).drop("__t")


def subsections(found: DataFrame) -> DataFrame:
    """Places of headings of level 2 and below inside a section's stripped text, with the end
    of each; sections that end at the next heading have only their own."""
    body = t.strip(F.col("text"))
    return found.where((F.col("level") >= 2) & (body != "")).select("document_id", "start", F.lit(0).alias("from"), F.length(body).alias("to"))


def paragraphs(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("document_id",)) -> DataFrame:
    """Blocks between empty lines that aren't blank, with their place."""
    w = Window.partitionBy(*keys).orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    b = docs.select(*keys, F.posexplode(F.split(F.col(text), "\n\n")).alias("block_no", "block"))
    b = b.withColumn("start", F.coalesce(F.sum(F.length("block") + 2).over(w), F.lit(0)).cast("int"))
    return b.withColumn("end", F.col("start") + F.length("block")).where(t.strip(F.col("block")) != "")


def paragraph_spans(text: Column) -> Column:
    """C7 inside a row: start and end of the blocks that aren't blank."""
    def step(s: Column, block: Column) -> Column:
        end = s["at"] + F.length(block)
        span = F.struct(s["at"].alias("start"), end.alias("end"))
        return F.struct(F.when(t.strip(block) == "", s["out"]).otherwise(F.concat(s["out"], F.array(span))).alias("out"), (end + 2).alias("at"))

    begin = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(F.split(text, "\n\n"), begin, step, lambda s: s["out"])


def sentence_cut(text: Column, most: int, ends: str = c.SENTENCE_ENDS) -> Column:
    """The last sentence end in (0.65 * most, most], else most; whole if short."""
    least = max(0, int(most * 0.65))
    head = F.regexp_extract(F.substring(text, 1, most), rf"(?s)^(.{{{least},{most - 1}}}[{ends}])", 1)
    return F.when(F.length(text) <= most, F.length(text)).when(F.length(head) > 0, F.length(head)).otherwise(F.lit(most))


_GROUP = "struct<path:array<string>,first:int,last:int,chars:int,start:int,end:int>"


def _folded(pieces: Column, joins: Callable[[Column, Column], Column], path: Callable[[Column, Column], Column]) -> Column:
    """Pieces (path, text, start, end) in order to joined ones. The fold sees lengths and places
    only; texts are put together once, at the end."""
    whole = lambda x, k: F.struct(x["path"].alias("path"), k.alias("first"), k.alias("last"), F.length(x["text"]).alias("chars"), x["start"].alias("start"), x["end"].alias("end"))

    def step(s: Column, x: Column) -> Column:
        p = s["now"]
        more = F.struct(path(p, x).alias("path"), p["first"].alias("first"), x["last"].alias("last"), (p["chars"] + 2 + x["chars"]).alias("chars"), p["start"].alias("start"), x["end"].alias("end"))
        join = p.isNotNull() & joins(p, x)
        done = F.when(p.isNull() | join, s["out"]).otherwise(F.concat(s["out"], F.array(p)))
        return F.struct(done.alias("out"), F.when(join, more).otherwise(x).alias("now"))

    begin = F.struct(F.array().cast(f"array<{_GROUP}>").alias("out"), F.lit(None).cast(_GROUP).alias("now"))

    def joined(made: Column) -> Column:
        groups = F.aggregate(F.transform(made, whole), begin, step, lambda s: F.when(s["now"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(s["now"]))))
        text = lambda g: F.array_join(F.transform(F.slice(made, g["first"] + 1, g["last"] - g["first"] + 1), lambda x: x["text"]), "\n\n")
        return F.transform(groups, lambda g: F.struct(g["path"].alias("path"), text(g).alias("text"), g["start"].alias("start"), g["end"].alias("end")))

    # The pieces are bound to a variable: as an expression they would be made again for each group.
    return F.get(F.transform(F.array(pieces), joined), F.lit(0))


def pack(pieces: Column, least: int, most: int) -> Column:
    """Pieces (arrays of path, text, start, end) joined until one would pass `most` and the
    buffer has `least` characters."""
    return _folded(pieces, lambda p, x: (p["chars"] + 2 + x["chars"] <= most) | (p["chars"] < least), lambda p, x: p["path"])


def recut(text: Column, most: int, ends: str = c.SENTENCE_ENDS) -> Column:
    """A text of more than `most` characters in pieces by C8, one after the other."""
    least = max(0, int(most * 0.65))
    piece = rf"(?s)(.{{1,{most}}}\z|.{{{least},{most - 1}}}[{ends}]|.{{{most}}})[\s\p{{Z}}]*"
    return F.when(F.length(text) <= most, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(piece), 1))


def merge_small(chunks: Column, least: int, most: int) -> Column:
    """C11: neighbours of one section, siblings under a named parent, or parent and child are
    joined where one is short and both fit; siblings get the parent's path."""
    parent = lambda p: F.slice(p, F.lit(1), F.size(p) - 1)
    sibling = lambda a, b: (F.size(a) == F.size(b)) & (parent(a) == parent(b)) & (F.size(a) >= 3)

    def joins(p: Column, x: Column) -> Column:
        a, b = p["path"], x["path"]
        child = (F.size(a) < F.size(b)) & (F.slice(b, F.lit(1), F.size(a)) == a) & (F.size(a) >= 2)
        return ((p["chars"] < least) | (x["chars"] < least)) & (p["chars"] + x["chars"] + 2 <= most) & ((a == b) | sibling(a, b) | child)

    path = lambda p, x: F.when((p["path"] != x["path"]) & sibling(p["path"], x["path"]), parent(p["path"])).otherwise(p["path"])
    shown = F.filter(chunks, lambda x: t.strip(x["text"]) != "")
    return _folded(shown, joins, path)


def section_chunks(found: DataFrame, least: int, most: int) -> DataFrame:
    """A section (text, start, end, path, level) whole if it fits; else its subsections, or
    its paragraphs, packed, and what is still too long cut at sentences. Blank sections go."""
    x = found.withColumns({"text": t.strip(F.col("text")), "sid": F.col("start")}).where("text <> ''")
    long = F.length("text") > most
    local = lambda s: F.struct(F.col("path").alias("path"), t.strip(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])).alias("text"), (F.col("sid") + s["start"]).alias("start"), (F.col("sid") + s["end"]).alias("end"))
    one = F.struct("path", "text", "start", F.when(long, F.col("sid") + F.length("text")).otherwise(F.col("end")).alias("end"))
    pieces = F.when(long & (F.coalesce("level", F.lit(0)) < 2), F.transform(paragraph_spans(F.col("text")), local)).otherwise(F.array(one))
    packed = x.select("document_id", F.inline(pack(pieces, least, most)))
    cuts = packed.withColumn("cuts", recut(F.col("text"), most)).withColumn("sizes", F.transform("cuts", F.length))
    before = lambda k: F.aggregate(F.slice(F.col("sizes"), F.lit(1), k), F.lit(0), lambda a, n: a + n)
    cut = lambda x, k: F.struct(F.col("path").alias("path"), t.strip(x).alias("text"), (F.col("start") + before(k)).alias("start"), (F.col("start") + before(k) + F.length(t.strip(x))).alias("end"))
    whole = F.array(F.struct("path", "text", "start", "end"))
    out = F.when(F.size("cuts") == 1, whole).otherwise(F.filter(F.transform("cuts", cut), lambda x: x["text"] != ""))
    return cuts.select("document_id", F.inline(out))


def chunk_ids(chunks: DataFrame) -> DataFrame:
    """chunk_id CH0001.. in order of start, inside each document, with the chunk's anchors."""
    w = Window.partitionBy("document_id").orderBy("start", "end")
    return chunks.withColumn("chunk_index", F.row_number().over(w)).withColumns({
        "chunk_id": F.format_string("CH%04d", F.col("chunk_index")), "sha1_12": F.substring(F.sha1(F.substring("text", 1, 400)), 1, 12), "head_80": F.substring("text", 1, 80),
    })


def build_chunks(docs: DataFrame, least: int = 200, most: int = 1200, merge: int | None = None, min_ratio: float | None = 0.2, level: Column | None = None) -> DataFrame:
    """Documents (document_id, text) to chunks (path, text, start, end, ids): tail removed,
    sections, subsections or paragraphs packed and cut, small ones merged; chunks in other
    languages go, unless min_ratio is None. Places are code points of the text without its tail.
    """
    # Dealt by document once: lines, sections and texts meet again without another shuffle of texts.
    body = docs.select("document_id", t.remove_tail(F.col("text")).alias("text")).repartition("document_id")
    made = section_chunks(document_sections(body, "text", level), least, most)
    order = F.struct("start", "end", "path", "text")
    g = made.groupBy("document_id").agg(F.array_sort(F.collect_list(order)).alias("s"))
    shaped = F.transform("s", lambda x: F.struct(x["path"].alias("path"), x["text"].alias("text"), x["start"].alias("start"), x["end"].alias("end")))
    out = g.select("document_id", F.inline(merge_small(shaped, least if merge is None else merge, most)))
    if min_ratio is not None:
        out = quality.language_drop(out, min_ratio=min_ratio).where("drop_reason IS NULL").drop("drop_reason", "cjk_ratio")
    return chunk_ids(out)


def with_pages(chunks: DataFrame, texts: DataFrame) -> DataFrame:
    """The first and last page of each chunk; texts are those of full_text()."""
    j = chunks.join(texts.select("document_id", "pages"), "document_id")
    first, last = page_of(F.col("pages"), F.col("start")), page_of(F.col("pages"), F.greatest(F.col("end") - 1, F.col("start")))
    return j.withColumns({"page_start": first["page"], "page_end": last["page"], "offset_start": first["offset"], "offset_end": last["offset"]}).drop("pages")


def rule_candidates(texts: DataFrame) -> DataFrame:
    """The headings of full texts (full_text, pages) with their pages, confidence 0.80."""
    found = anchors(lines(texts)).join(texts.select("document_id", "pages"), "document_id")
    return found.select("document_id", "title", "level", "start", page_of(F.col("pages"), F.col("start"))["page"].alias("page"), F.lit("rule").alias("source"), F.col("title").alias("evidence_text"), F.lit(0.80).alias("confidence"))


def toc_candidates(rule: DataFrame, model: DataFrame) -> DataFrame:
    """Both sources' candidates by (document, start, title): sources, confidence (0.90
    at least with two), first level."""
    both = rule.select("document_id", "start", "title", "level", "confidence", F.lit("rule").alias("source")).unionByName(model.select("document_id", "start", "title", "level", "confidence", F.lit("model").alias("source")))
    g = both.groupBy("document_id", "start", "title").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.max("confidence").alias("c"), F.min_by("level", F.when(F.col("level").isNotNull(), F.col("source"))).alias("level"))
    return g.select("document_id", "start", "title", "sources", "level", F.when(F.size("sources") > 1, F.greatest("c", F.lit(0.9))).otherwise(F.col("c")).alias("confidence"))


def model_candidates(answers: DataFrame) -> DataFrame:
    """Headings that a model's answers (document_id, status, text; full_text) name: level from
    1 to 4, the place of the first verbatim occurrence, confidence 0.70; others go."""
    item = "struct<headings:array<struct<title:string,level:int>>>"
    x = answers.where("status = 'ok'").select("document_id", "full_text", F.inline(F.from_json(t.json_object(F.col("text")), item)["headings"]))
    title = t.strip(F.coalesce("title", F.lit("")))
    x = x.withColumns({"title": title, "start": F.instr("full_text", title) - 1}).where("title <> '' AND start >= 0")
    level = F.greatest(F.lit(1), F.least(F.lit(4), F.coalesce("level", F.lit(1))))
    return x.select("document_id", "title", level.alias("level"), "start", F.lit("model").alias("source"), F.lit(0.70).alias("confidence"))


def noise_report(text: Column, spans: Column, most: int = 200) -> Column:
    """Spans (start, end) inside the text, with at most `most` characters of each."""
    n = F.length(text)
    lo = lambda s: F.greatest(F.lit(0), F.least(s["start"], n))
    hi = lambda s: F.greatest(lo(s), F.least(s["end"], n))
    return F.transform(spans, lambda s: F.struct(lo(s).alias("start"), hi(s).alias("end"), F.substring(text, lo(s) + 1, F.least(hi(s) - lo(s), F.lit(most))).alias("excerpt")))


def toc_metrics(found: DataFrame) -> DataFrame:
    """Candidates, starts in order, level jumps above one, headings a thousand characters."""
    w = Window.partitionBy("document_id").orderBy("start")
    j = found.withColumn("jump", (F.lead("level").over(w) - F.col("level") > 1).cast("int"))
    g = j.groupBy("document_id").agg(F.count("*").alias("n"), F.coalesce(F.sum("jump"), F.lit(0)).alias("level_jumps"), F.max("n_chars").alias("n_chars"))
    density = F.col("n") * 1000 / F.greatest("n_chars", F.lit(1))
    return g.withColumn("density", density).withColumn("density_flag", (density < 0.15) | (density > 6))


def apply_edits(text: Column, edits: Column) -> Column:
    """Edits (start, end, replacement) applied from the last to the first."""
    order = F.reverse(F.array_sort(edits))
    return F.aggregate(order, text, lambda s, e: F.concat(F.substring(s, F.lit(1), e["start"]), e["replacement"], F.substring(s, e["end"] + 1, F.length(s))))


def bounded_body(pages: DataFrame, most: int) -> DataFrame:
    """Pages in order while their characters fit, the last one cut."""
    w = Window.partitionBy("document_id").orderBy("page_number").rowsBetween(Window.unboundedPreceding, -1)
    p = pages.withColumn("before", F.coalesce(F.sum(F.length("text")).over(w), F.lit(0))).where(F.col("before") < most)
    return p.withColumn("text", F.substring("text", F.lit(1), (most - F.col("before")).cast("int")))
