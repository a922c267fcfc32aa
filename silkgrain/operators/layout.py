"""Boxes, captions and links (G rows). Boxes are x0, top, x1, bottom; equality on document and
page carries every join, the geometric condition is checked on what meets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkgrain import config as c


def vertical_distance(a: str, b: str) -> Column:
    """Gap between two boxes' rows, 0 where they overlap."""
    return F.greatest(F.lit(0.0), F.col(f"{a}_top") - F.col(f"{b}_bottom"), F.col(f"{b}_top") - F.col(f"{a}_bottom"))


def horizontal_overlap(a: str, b: str) -> Column:
    """Shared width over the smaller width."""
    shared = F.least(f"{a}_x1", f"{b}_x1") - F.greatest(f"{a}_x0", f"{b}_x0")
    return F.greatest(F.lit(0.0), shared) / F.greatest(F.lit(1e-9), F.least(F.col(f"{a}_x1") - F.col(f"{a}_x0"), F.col(f"{b}_x1") - F.col(f"{b}_x0")))


def union_boxes(boxes: DataFrame, *keys: str) -> DataFrame:
    """The box around all boxes of a key."""
    return boxes.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"))


def cluster_rows(words: DataFrame, gap: float = 3.0) -> DataFrame:
    """G1: rows of words (document_id, page, text, x0, x1, top, bottom) by a running mean of top.

    A fold over one page's words, so pages are the groups; a page bounds its size."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["top", "x0", "text"], kind="stable").reset_index(drop=True)
        row, mean, n, out = -1, 0.0, 0, []
        for top in pdf["top"]:
            if row < 0 or abs(top - mean) > gap:
                row, mean, n = row + 1, top, 1
            else:
                mean, n = (mean * n + top) / (n + 1), n + 1
            out.append(row)
        return pdf.assign(row=out)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    return words.groupBy("document_id", "page").applyInPandas(run, f"{kinds}, row int")


def row_lines(rows: DataFrame, gap: float = 10.0) -> DataFrame:
    """Each row's words in order of x0, a blank where the gap is wide."""
    w = Window.partitionBy("document_id", "page", "row").orderBy("x0")
    r = rows.withColumn("piece", F.concat(F.when(F.col("x0") - F.lag("x1").over(w) >= gap, " ").otherwise(""), "text"))
    return r.groupBy("document_id", "page", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "piece"))), lambda x: x["piece"]), "").alias("line"), F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"))


def body_words(words: DataFrame, low: float = 0.06, high: float = 0.94) -> DataFrame:
    """words between header and footer."""
    return words.where((F.col("top") > low * F.col("page_height")) & (F.col("top") < high * F.col("page_height")))


def covered(line: Column, table: Column, share: float = 0.35) -> Column:
    """F6 on two boxes as structs: whether the table covers `share` of the line."""
    wide = F.greatest(F.lit(0.0), F.least(line["x1"], table["x1"]) - F.greatest(line["x0"], table["x0"]))
    tall = F.greatest(F.lit(0.0), F.least(line["bottom"], table["bottom"]) - F.greatest(line["top"], table["top"]))
    return wide * tall / F.greatest(F.lit(1.0), (line["x1"] - line["x0"]) * (line["bottom"] - line["top"])) >= share


def outside_tables(lines: DataFrame, tables: DataFrame, share: float = 0.35) -> DataFrame:
    """lines whose box isn't covered by `share` by any table of the page."""
    b = tables.select("document_id", "page", F.col("x0").alias("tx0"), F.col("top").alias("tt"), F.col("x1").alias("tx1"), F.col("bottom").alias("tb"))
    w = F.greatest(F.lit(0.0), F.least("x1", "tx1") - F.greatest("x0", "tx0")) * F.greatest(F.lit(0.0), F.least("bottom", "tb") - F.greatest("top", "tt"))
    area = F.greatest(F.lit(1.0), (F.col("x1") - F.col("x0")) * (F.col("bottom") - F.col("top")))
    on = (lines["document_id"] == b["document_id"]) & (lines["page"] == b["page"]) & (w / area >= share)
    return lines.join(b, on, "left_anti")


def chunk_regions(chunks: DataFrame, lines: DataFrame, head: int = 12) -> DataFrame:
    """For each chunk and page of its range, the box around the lines it holds, or around
    all lines of the page if it holds none. A chunk meets the lines of its own pages alone."""
    sq = lambda x: F.regexp_replace(x, r"\s+", "")
    pages = F.explode(F.sequence("page_start", "page_end")).alias("page")
    k = chunks.where("page_start <= page_end").select("document_id", "chunk_id", sq(F.col("text")).alias("body"), pages)
    j = k.join(lines.select("document_id", "page", sq(F.col("line")).alias("own_line"), "x0", "top", "x1", "bottom"), ["document_id", "page"])
    j = j.withColumn("own", F.contains("body", F.substring("own_line", 1, head)) & (F.col("own_line") != ""))
    pick = lambda f, x: F.coalesce(f(F.when(F.col("own"), F.col(x))), f(x)).alias(x)
    return j.groupBy("document_id", "chunk_id", "page").agg(pick(F.min, "x0"), pick(F.min, "top"), pick(F.max, "x1"), pick(F.max, "bottom"), F.max("own").alias("matched"))


def nearest_caption(objects: DataFrame, captions: DataFrame, most: float = 90.0, above: bool = True) -> DataFrame:
    """Each object's nearest caption above (or note below), at most `most` away."""
    k = captions.select("document_id", "page", F.col("caption_id"), F.col("top").alias("ct"), F.col("bottom").alias("cb"))
    d = (F.col("top") - F.col("cb")) if above else (F.col("ct") - F.col("bottom"))
    near = objects.join(k, ["document_id", "page"]).withColumn("distance", d).where((F.col("distance") >= 0) & (F.col("distance") <= most))
    best = near.groupBy("document_id", "object_id").agg(F.min(F.struct("distance", "caption_id")).alias("m")).select("document_id", "object_id", "m.caption_id", "m.distance")
    return objects.join(best, ["document_id", "object_id"], "left")


def explicit_links(chunks: DataFrame, objects: DataFrame, pattern: str = r"(?i)(表|图|Table|Figure)\s*(\d+)") -> DataFrame:
    """References by kind and number, joined by equality; confidence 0.95."""
    kind = F.when(F.lower("k").isin("表", "table"), "table").otherwise("figure")
    ref = chunks.select("document_id", "chunk_id", F.explode(F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), 1).alias("k"), F.regexp_extract_all("text", F.lit(pattern), 2).alias("n"))).alias("r")).select("document_id", "chunk_id", F.col("r.k").alias("k"), F.col("r.n").alias("number"))
    ref = ref.select("document_id", "chunk_id", kind.alias("object_type"), "number").distinct()
    return ref.join(objects, ["document_id", "object_type", "number"]).select("document_id", "chunk_id", "object_id", F.lit("explicit_reference").alias("reason"), F.lit(0.95).alias("confidence"))


def proximity_links(regions: DataFrame, objects: DataFrame, most: float = 120.0, overlap: float = 0.3) -> DataFrame:
    """Objects on a region's page, near it and under it; confidence 0.65."""
    r = regions.select("document_id", "chunk_id", "page", *[F.col(x).alias(f"r_{x}") for x in ("x0", "top", "x1", "bottom")])
    o = objects.select("document_id", "object_id", "page", *[F.col(x).alias(f"o_{x}") for x in ("x0", "top", "x1", "bottom")])
    j = r.join(o, ["document_id", "page"]).withColumn("d", vertical_distance("r", "o")).withColumn("h", horizontal_overlap("r", "o"))
    return j.where((F.col("d") <= most) & (F.col("h") >= overlap)).select("document_id", "chunk_id", "object_id", F.lit("layout_proximity").alias("reason"), F.lit(0.65).alias("confidence"))


def merge_links(links: DataFrame, most: int = 3) -> DataFrame:
    """Reasons and best confidence by object, the first `most` of each chunk."""
    g = links.groupBy("document_id", "chunk_id", "object_id").agg(F.array_sort(F.collect_set("reason")).alias("reasons"), F.max("confidence").alias("confidence"))
    w = Window.partitionBy("document_id", "chunk_id").orderBy(F.desc("confidence"), "object_id")
    return g.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).drop("k")


def attach_links(chunks: DataFrame, links: DataFrame, objects: DataFrame) -> DataFrame:
    """Linked tables and figures of each chunk as arrays."""
    j = links.join(objects.select("document_id", "object_id", "object_type"), ["document_id", "object_id"])
    pick = lambda k: F.array_sort(F.collect_list(F.when(F.col("object_type") == k, F.struct("confidence", "object_id"))))
    g = j.groupBy("document_id", "chunk_id").agg(pick("table").alias("linked_tables"), pick("figure").alias("linked_figures"))
    return chunks.join(g, ["document_id", "chunk_id"], "left")


def best_chunk(links: DataFrame) -> DataFrame:
    """Each object's chunk of greatest confidence, the first chunk on ties."""
    return links.groupBy("document_id", "object_id").agg(F.max("confidence").alias("confidence"), F.min(F.struct((-F.col("confidence")).alias("c"), "chunk_id")).alias("m")).select("document_id", "object_id", "m.chunk_id", "confidence")


def two_columns(words: DataFrame, least_words: int = 80, side: float = 0.2, apart: float = 0.28, rounds: int = 15, begin: float = 0.2) -> DataFrame:
    """two_column and split_x of each page by two means of the words' centres, from their 30th and 70th
    percentile on; not where these are less than `begin` of the width apart, a column holds less than `side` of the words or the
    means end less than `apart` of the width from each other. A page's centres are one array."""
    found = words.groupBy("document_id", "page").agg(F.collect_list((F.col("x0") + F.col("x1")) / 2).alias("centres"), F.max("page_width").alias("page_width"))
    return page_splits(found, least_words, side, apart, rounds, begin)


def page_splits(pages: DataFrame, least_words: int = 80, side: float = 0.2, apart: float = 0.28, rounds: int = 15, begin: float = 0.2) -> DataFrame:
    """G4 on pages with centres (an array) and page_width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False))])
            made = [split(np.sort(x[a:b]), w, least_words, side, apart, rounds, begin) for a, b, w in zip(at[:-1], at[1:], batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([m is not None for m in made], pa.bool_()), pa.array(made, pa.float64())], names=["document_id", "page", "two_column", "split_x"])

    kinds = ", ".join(f"{k} {pages.schema[k].dataType.simpleString()}" for k in ("document_id", "page"))
    return pages.select("document_id", "page", "centres", F.col("page_width").cast("double")).mapInArrow(run, f"{kinds}, two_column boolean, split_x double")


def split(x: np.ndarray, width: float | None, least_words: int = 80, side: float = 0.2, apart: float = 0.28, rounds: int = 15, begin: float = 0.2) -> float | None:
    """Where a page of so many words, given their sorted centres, parts; None if there is one column."""
    return _split(x, width, side, apart, rounds, begin) if len(x) >= max(1, least_words) and width is not None and width > 0 else None


def _split(x: np.ndarray, width: float, side: float, apart: float, rounds: int, begin: float) -> float | None:
    """Where two columns part, given sorted centres; None if there is one."""
    a, b = float(x[int(len(x) * 0.3)]), float(x[int(len(x) * 0.7)])
    if b - a < width * begin:
        return None
    for _ in range(rounds):
        left = abs(x - a) <= abs(x - b)
        if left.all() or not left.any():
            return None
        to = float(x[left].mean()), float(x[~left].mean())
        if abs(to[0] - a) < 0.5 and abs(to[1] - b) < 0.5:
            break
        a, b = to
    share = float((abs(x - a) <= abs(x - b)).mean())
    return (a + b) / 2 if min(share, 1 - share) >= side and abs(b - a) >= apart * width else None


def caption_lines(lines: DataFrame) -> DataFrame:
    """Lines (document_id, page, object_id, line, box) that begin like a caption or a note, with
    kind, the captioned type and its number."""
    caption, note = F.rlike("line", F.lit(c.CAPTION)), F.rlike("line", F.lit(c.NOTE))
    kind = F.when(caption, "caption").when(note, "note")
    of = F.when(caption & F.rlike("line", F.lit(r"(?i)^\s*(表|Table)")), "table").when(caption, "figure")
    number = F.nullif(F.regexp_extract("line", r"(?i)^\s*(?:表|图|Table|Figure)\s*(\d+)", 1), F.lit(""))
    return lines.withColumns({"kind": kind, "of": of, "number": number}).where("kind IS NOT NULL")


_BOX = ("x0", "top", "x1", "bottom")


def _with_nearest(objects: DataFrame, found: DataFrame, name: str, most: float, above: bool) -> DataFrame:
    """objects with the text, number and box of the nearest of the found lines, null without one."""
    near = nearest_caption(objects.select("document_id", "page", "object_id", *_BOX), found.withColumnRenamed("object_id", "caption_id"), most, above)
    text = found.select("document_id", "page", F.col("object_id").alias("caption_id"), F.struct("line", "number", *_BOX).alias(name))
    picked = near.select("document_id", "page", "object_id", "caption_id").join(text, ["document_id", "page", "caption_id"], "left")
    return objects.join(picked.select("document_id", "object_id", name), ["document_id", "object_id"])


def table_objects(bodies: DataFrame, lines: DataFrame, caption_most: float = 90.0, note_most: float = 120.0) -> DataFrame:
    """Table bodies with the nearest caption above, the nearest note below, and the box around all."""
    found = caption_lines(lines)
    x = _with_nearest(bodies, found.where("kind = 'caption'"), "caption", caption_most, True)
    x = _with_nearest(x, found.where("kind = 'note'"), "note", note_most, False)
    side = lambda f, k: f(k, f"caption.{k}", f"note.{k}")  # noqa: E731  nulls are skipped
    union = {f"all_{k}": side(F.least if k in ("x0", "top") else F.greatest, k) for k in _BOX}
    return x.withColumns({**union, "table_number": F.when(F.rlike("caption.line", F.lit(r"(?i)^\s*(表|Table)")), F.col("caption.number"))})


def figure_objects(images: DataFrame, lines: DataFrame, least: float = 80.0, most: float = 90.0) -> DataFrame:
    """Images of `least` or more on both sides with the nearest numbered figure caption."""
    big = images.where((F.col("x1") - F.col("x0") >= least) & (F.col("bottom") - F.col("top") >= least))
    return _with_nearest(big, caption_lines(lines).where("of = 'figure' AND number IS NOT NULL"), "caption", most, True)


def clipped(box: tuple[Column, Column, Column, Column], width: Column, height: Column, least: float = 0.5) -> Column:
    """A box inside its page, null if less than `least` of a side is left."""
    x0, y0 = F.greatest(box[0], F.lit(0.0)), F.greatest(box[1], F.lit(0.0))
    x1, y1 = F.least(box[2], width), F.least(box[3], height)
    return F.when((x1 - x0 >= least) & (y1 - y0 >= least), F.struct(x0.alias("x0"), y0.alias("top"), x1.alias("x1"), y1.alias("bottom")))
