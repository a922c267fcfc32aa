"""Edits of marked page texts that leave the page breaks alone.

A document's edits are an array beside its text: start, end (code points, exclusive) and replacement; null replacement
deletes. Either all of a document's edits are applied or none, and the reason is told.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silkgrain.functions import text as t
from silkgrain.operators.segment import apply_edits

EDIT = "array<struct<start:int,end:int,replacement:string>>"
BREAK = r"\n<<<PAGE_BREAK:(\d+)>>>\n"


def break_spans(marked: Column, pages: Column) -> Column:
    """C17: (start, end) of each break in front of one of the pages but the first, in order."""
    texts, marks = F.split(marked, BREAK, -1), F.regexp_extract_all(marked, F.lit(f"({BREAK})"), 1)
    expected = F.slice(F.array_sort(pages), 2, F.greatest(F.size(pages) - 1, F.lit(0)))
    parts = F.zip_with(marks, F.slice(texts, F.lit(1), F.size(marks)), lambda m, x: F.struct(F.length(x).alias("before"), F.length(m).alias("long"), F.regexp_extract(m, r"(\d+)", 1).cast("int").alias("page")))
    empty = F.array().cast("array<struct<start:int,end:int,page:int>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    step = lambda s, p: F.struct((s["at"] + p["before"] + p["long"]).alias("at"), F.concat(s["out"], F.array(F.struct((s["at"] + p["before"]).alias("start"), (s["at"] + p["before"] + p["long"]).alias("end"), p["page"].alias("page")))).alias("out"))
    found = F.aggregate(parts, begin, step)["out"]
    return F.transform(F.filter(found, lambda b: F.array_contains(expected, b["page"])), lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))


def edit_issue(marked: Column, edits: Column, guarded: Column) -> Column:
    """why a document's edits can't be made, '' if they can: the first of
    no_place (start or end null), out_of_text, page_break (an edit meets a guarded span), cut_word (a deletion whose neighbours
    aren't blanks or the text's ends), empty_replacement, overlap (two edits meet).

    Meetings are found by one sweep: edits and guarded spans in order of their starts, against the greatest end so far of each kind.
    """
    n = F.length(marked)
    blank = lambda x: F.rlike(x, F.lit(rf"^{t.BLANK}$"))
    beyond = lambda e: (e["start"] < 0) | (e["start"] >= e["end"]) | (e["end"] > n)
    left = lambda e: (e["start"] == 0) | blank(F.substring(marked, e["start"], F.lit(1)))
    right = lambda e: (e["end"] == n) | blank(F.substring(marked, e["end"] + 1, F.lit(1)))
    kinds = F.concat(F.transform(edits, lambda e: F.struct(e["start"].alias("s"), e["end"].alias("e"), F.lit(1).alias("kind"))), F.transform(guarded, lambda g: F.struct(g["start"].alias("s"), g["end"].alias("e"), F.lit(0).alias("kind"))))
    begin = F.struct(F.lit(0).alias("own"), F.lit(0).alias("other"), F.lit(False).alias("hits"), F.lit(False).alias("meets"))
    own = lambda x: x["kind"] == 1
    step = lambda s, x: F.struct(
        F.when(own(x), F.greatest(s["own"], x["e"])).otherwise(s["own"]).alias("own"), F.when(own(x), s["other"]).otherwise(F.greatest(s["other"], x["e"])).alias("other"),
        (s["hits"] | (x["s"] < F.when(own(x), s["other"]).otherwise(s["own"]))).alias("hits"), (s["meets"] | (own(x) & (x["s"] < s["own"]))).alias("meets"),
    )
    swept = F.aggregate(F.array_sort(kinds), begin, step)
    return (
        F.when(F.exists(edits, lambda e: e["start"].isNull() | e["end"].isNull()), "no_place").when(F.exists(edits, beyond), "out_of_text").when(swept["hits"], "page_break")
        .when(F.exists(edits, lambda e: e["replacement"].isNull() & ~(left(e) & right(e))), "cut_word").when(F.exists(edits, lambda e: e["replacement"].isNotNull() & (t.strip(e["replacement"]) == "")), "empty_replacement")
        .when(swept["meets"], "overlap").otherwise("")
    )


def edited(marked: Column, edits: Column, issue: Column) -> Column:
    """C18 for edits that were checked: the text with all of them, or as it was."""
    whole = F.transform(edits, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), F.coalesce(e["replacement"], F.lit("")).alias("replacement")))
    return F.when(issue == "", apply_edits(marked, whole)).otherwise(marked)
