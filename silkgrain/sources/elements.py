"""Element trees of a structure pre-parser as tables (S2, H24): elements, pages of lines, objects and a report.

A tree is walked level by level, all documents at once: a level's nodes are variants with the way to them (an array of places,
whose order is that of a walk depth first) and the page they inherit; their children are the next level. WALK levels are one pass over
the rows; then elements are stored, and of nodes those whose children are still to come. So a tree is stored once in every WALK levels
that it has below it, whatever the number of documents, and no document is a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkgrain.functions import text as t
from silkgrain.sources.tables import written

#: Names under which a tree keeps things, in the order in which they count.
TYPE = ("type", "category", "element_type", "role")
TEXT = ("text", "content", "markdown", "html")
ROWS = ("table", "rows", "cells")
CELLS = ("cells", "values")
PAGE = ("page_number", "page number", "page", "pageIndex", "page_index")
INDEX = ("pageIndex", "page_index")
BOX = ("bbox", "bounding_box", "bounding box", "box")
SIDES = (("x0", "top", "x1", "bottom"), ("left", "top", "right", "bottom"))
LEVEL = ("heading_level", "heading level", "level", "depth")
CHILDREN = ("elements", "children", "kids", "blocks", "items", "list items")
HEADINGS, TABLES, IMAGES = ("heading", "title", "section_header"), ("table",), ("image", "picture", "figure")

ELEMENT = ("document_id", "way", "type", "text", "page", "box", "level", "caption", "body")
#: Levels walked before anything is stored.
WALK = 6


def _at(node: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(node, f'$["{name}"]', kind)


def _number(node: Column, names: tuple[str, ...]) -> Column:
    """The first of the names that has a whole number, as a number or as digits; counts from 0 begin with 1."""
    def of(name: str) -> Column:
        x = F.when(F.rlike(_at(node, name, "string"), F.lit(r"^\d{1,9}$")), _at(node, name, "string").cast("int"))
        return F.when(x == 0, 1).otherwise(x) if name in INDEX else x

    return F.coalesce(*map(of, names))


def _said(node: Column, names: tuple[str, ...]) -> Column:
    """The first of the names whose value is a text that isn't blank, with blanks normalised."""
    texts = [t.normalize_whitespace(_at(node, n, "string")) for n in names]
    return F.coalesce(*(F.when(F.schema_of_variant(F.variant_get(node, f'$["{n}"]', "variant")).eqNullSafe("STRING") & (x != ""), x) for n, x in zip(names, texts, strict=True)))


def _list(node: Column, names: tuple[str, ...]) -> Column:
    """The first of the names that has a list that isn't empty."""
    lists = [_at(node, n, "array<variant>") for n in names]
    return F.coalesce(*(F.when(F.size(x) > 0, x) for x in lists))


def _cell(cell: Column) -> Column:
    return F.coalesce(_said(cell, TEXT), F.when(F.schema_of_variant(cell).startswith("OBJECT"), "").otherwise(t.normalize_whitespace(F.try_variant_get(cell, "$", "string"))), F.lit(""))


def element_text(node: Column) -> Column:
    """An element's text, else its table: a line for each row, cells parted by bars, empty cells of named rows left out."""
    def line(row: Column) -> Column:
        plain = F.array_join(F.transform(F.try_variant_get(row, "$", "array<variant>"), _cell), " | ")
        named = F.coalesce(_list(row, CELLS), F.map_values(F.try_variant_get(row, "$", "map<string,variant>")))
        return F.coalesce(plain, F.array_join(F.filter(F.transform(named, _cell), lambda c: c != ""), " | "), F.lit(""))

    rows = F.filter(F.transform(_list(node, ROWS), line), lambda r: t.strip(r) != "")
    return F.coalesce(_said(node, TEXT), t.normalize_whitespace(F.array_join(rows, "\n")), F.lit(""))


def element_box(node: Column) -> Column:
    """x0, top, x1, bottom of an element, from a list of four numbers or by the names of sides; null without."""
    def of(name: str) -> Column:
        four = _at(node, name, "array<double>")
        sides = [F.array(*(F.try_variant_get(node, f'$["{name}"]["{s}"]', "double") for s in names)) for names in SIDES]
        whole = lambda a: F.when((F.size(a) == 4) & F.forall(a, lambda v: v.isNotNull()), a)
        return F.coalesce(whole(four), *map(whole, sides))

    return F.coalesce(*map(of, BOX))


def _deeper(level: DataFrame, inherit: bool) -> DataFrame:
    """Rows (document_id, way, page, done, node): what isn't done gives its children, and itself as done if it is no list of nodes or pages."""
    node, way, above = F.col("node"), F.col("way"), F.col("page")
    x = level.withColumns({"pages": F.when(~F.col("done"), _at(node, "pages", "array<variant>")), "items": F.when(~F.col("done"), F.try_variant_get(node, "$", "array<variant>"))})
    x = x.withColumn("own", F.when(F.col("done"), above).otherwise(F.coalesce(_number(node, PAGE), above if inherit else F.lit(1))))

    def row(place: Column | None, page: Column, done: bool, node: Column) -> Column:
        there = way if place is None else F.concat(way, F.array(place.cast("int")))
        return F.struct(there.alias("way"), page.cast("int").alias("page"), F.lit(done).alias("done"), node.alias("node"))

    self = F.array(row(None, F.col("own"), True, node))
    below = F.filter(F.array(*(row(F.lit(k), F.col("own"), False, _at(node, n, "variant")) for k, n in enumerate(CHILDREN))), lambda b: b["node"].isNotNull())
    rows = (
        F.when(F.col("done"), self)
        .when(F.col("items").isNotNull(), F.transform("items", lambda n, k: row(k, above, False, n)))
        .when(F.col("pages").isNotNull(), F.transform("pages", lambda n, k: row(k, k + 1, False, n)))
        .otherwise(F.concat(self, below))
    )
    return x.select("document_id", F.inline(rows))


def elements(trees: DataFrame, inherit: bool = True) -> DataFrame:
    """trees (document_id, json) to ELEMENT rows: every node with a type or a text; way orders them as a walk depth first does.

    A node's page is its own number, else (inherit) that of the nearest node above it that has one, else 1; pages in a list count
    from 1. body is the JSON of a table's rows. What is no JSON, no tree or empty gives no rows.
    """
    level = trees.select("document_id", F.array().cast("array<int>").alias("way"), F.lit(1).alias("page"), F.lit(False).alias("done"), F.try_parse_json("json").alias("node")).where("node IS NOT NULL")
    node, found = F.col("node"), []
    kind = F.replace(F.lower(t.strip(F.coalesce(*(F.nullif(_at(node, n, "string"), F.lit("")) for n in TYPE), F.lit("")))), F.lit("-"), F.lit("_"))
    made = {
        "type": kind, "text": element_text(node), "box": element_box(node), "level": _number(node, LEVEL), "caption": F.coalesce(_at(node, "caption", "string"), F.lit("")),
        "body": F.to_json(F.coalesce(*(_at(node, n, "variant") for n in ("rows", "table")))),
    }
    while True:
        for _ in range(WALK):
            level = _deeper(level, inherit)
        columns = (F.when(F.col("done"), v).alias(k) for k, v in made.items())
        store = written(level.select("document_id", "way", "page", "done", *columns, F.when(~F.col("done"), node).alias("node")))
        found.append(store.where("done AND (type <> '' OR text <> '')").select(*ELEMENT))
        level = store.where("NOT done").select("document_id", "way", "page", "done", "node")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


def element_pages(found: DataFrame, clean: bool = True) -> DataFrame:
    """document_id, page, text, raw_text, lines (text with its heading marks, box, type, level, start, end), n_elements, n_tables, has_images."""
    heading = F.col("type").isin(*HEADINGS) & F.col("level").isNotNull()
    marks = F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(F.lit(6), "level")))
    shown = F.when(F.col("text") == "", None).when(heading, F.concat(marks, F.lit(" "), "text")).otherwise(F.col("text"))
    line = F.struct("way", F.col("shown").alias("text"), "box", "type", "level")
    g = found.withColumn("shown", shown).groupBy("document_id", "page").agg(
        F.array_sort(F.collect_list(F.when(F.col("shown").isNotNull(), line))).alias("l"), F.count("*").alias("n_elements"), F.count_if(F.col("type").isin(*TABLES)).alias("n_tables"), F.max(F.col("type").isin(*IMAGES)).alias("has_images")
    )
    raw = t.normalize_whitespace(F.array_join(F.transform("l", lambda x: x["text"]), "\n"))
    before = lambda i: F.aggregate(F.slice("l", F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x["text"]) + 1)
    lines = F.transform("l", lambda x, i: F.struct(x["text"].alias("text"), x["box"].alias("box"), x["type"].alias("type"), x["level"].alias("level"), before(i).alias("start"), (before(i) + F.length(x["text"])).alias("end")))
    return g.select("document_id", "page", (t.clean_page_text(raw) if clean else raw).alias("text"), raw.alias("raw_text"), lines.alias("lines"), "n_elements", "n_tables", "has_images")


def element_objects(found: DataFrame, wide: float = 30.0, high: float = 20.0) -> DataFrame:
    """Tables and figures of at least that size inside 0..5000: object_id (numbered on its page, in order), object_type, page, caption, body, box."""
    from pyspark.sql import Window

    kind = F.when(F.col("type").isin(*TABLES), "table").when(F.col("type").isin(*IMAGES), "figure")
    b = [F.get("box", F.lit(i)) for i in range(4)]
    usable = F.coalesce((b[2] - b[0] >= wide) & (b[3] - b[1] >= high) & (F.least(b[0], b[1]) >= 0) & (F.greatest(b[2], b[3]) <= 5000), F.lit(False))
    x = found.withColumn("object_type", kind).where(F.col("object_type").isNotNull() & usable)
    n = F.row_number().over(Window.partitionBy("document_id", "object_type", "page").orderBy("way"))
    name = F.format_string("%s_p%03d_tree_%03d", F.when(F.col("object_type") == "table", "T").otherwise("F"), "page", n)
    table = F.col("object_type") == "table"
    return x.select("document_id", name.alias("object_id"), "object_type", "page", F.when(table, F.substring("text", 1, 200)).otherwise(F.col("caption")).alias("caption"), F.coalesce("body", F.lit("[]")).alias("body"), "box", F.when(table, "not_required").otherwise("pending").alias("ocr_status"))


def element_report(found: DataFrame, objects: DataFrame) -> DataFrame:
    """document_id with its numbers of elements, objects and pages."""
    n = objects.groupBy("document_id").agg(F.count("*").alias("objects"))
    return found.groupBy("document_id").agg(F.count("*").alias("elements"), F.count_distinct("page").alias("pages")).join(n, "document_id", "left").na.fill(0, ["objects"])
