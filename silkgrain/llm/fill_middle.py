"""Fill-in-the-middle by run-length class encoding.

A text is stored as its maximal runs of separators and of other characters, with the number of units
(lines, words or characters) that have ended when a run ends. A cut after c units is found by binary
search for the first run that has c ends; its offset follows from the run's start by arithmetic. So no
list of units is ever made: a text of a million equal lines of one newline is a single run.

The encoding and the two searches are numpy in Arrow batches, which hand back three numbers a document;
hashes, pieces, output and restored text are Spark functions.

Defined cases: a null text counts as empty and is plain; a null id counts as empty text in the hash;
rows that repeat are cut alike; texts of any length are encoded whole; columns other than the id and the text are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm.common import table

#: Unit -> code points of its separators, and whether each separator ends a unit or a whole run of them does.
#: As patterns: line [^\n]*\n|[^\n]+, word [^ws]*[ws]+|[^ws]+; no separators: every character is a unit.
UNITS = {"line": ((10,), True), "word": ((9, 10, 11, 12, 13, 32), False), "char": ((), True)}
MARKERS = ("<P>", "<S>", "<M>")


class Runs(NamedTuple):
    """start: offset of each run; ends: units that have ended by its end; single: a unit ends at each of its characters."""

    start: np.ndarray
    ends: np.ndarray
    single: np.ndarray
    length: int


def encode(text: str, unit: str = "line") -> Runs:
    """The class runs of a text, over code points."""
    separators, each = UNITS[unit]
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(points):
        return Runs(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), 0)
    ends_unit = np.isin(points, separators) if separators else np.ones(len(points), bool)
    start = np.concatenate([[0], np.flatnonzero(ends_unit[1:] != ends_unit[:-1]) + 1])
    closing = ends_unit[start]
    length = np.diff(start, append=len(points))
    ended = np.where(closing, length if each else 1, 0)
    ended[-1] += not closing[-1]  # what is left without a separator is a unit too
    return Runs(start, np.cumsum(ended), closing & each, len(points))


def offset(runs: Runs, units: int) -> int:
    """Where the first `units` units end, in code points."""
    if units == 0:
        return 0
    at = int(np.searchsorted(runs.ends, units))
    if runs.single[at]:
        before = runs.ends[at - 1] if at else 0
        return int(runs.start[at] + units - before)
    return int(runs.start[at + 1]) if at + 1 < len(runs.start) else runs.length


def _cutter(unit: str):
    @F.pandas_udf("n long, first long, second long")
    def cuts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, one, two in batches:
            rows = []
            for text, a, b in zip(texts, one, two, strict=True):
                runs = encode(text, unit)
                n = int(runs.ends[-1]) if runs.length else 0
                low, high = sorted((a % (n + 1), b % (n + 1)))
                rows.append((n, offset(runs, low), offset(runs, high)))
            yield pd.DataFrame(rows, columns=["n", "first", "second"])

    return cuts


def _hash_words(key: Column, seed: int) -> list[Column]:
    """Four unsigned integers of 32 bits from the sha256 of seed:key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _check(markers: tuple[str, str, str]) -> None:
    """No marker's first character occurs inside one, so none can arise where pieces meet."""
    pairs = [(a, b) for i, a in enumerate(markers) for j, b in enumerate(markers) if i != j]
    if not all(markers) or any(a[0] in b[1:] for a in markers for b in markers) or any(b.startswith(a) for a, b in pairs):
        raise ValueError("no marker may begin another, nor may its first character occur inside one")


def fill_in_middle(
    docs: DataFrame, unit: str = "line", seed: int = 7, percent: int = 100, spm_percent: int = 50, markers: tuple[str, str, str] = MARKERS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n (units), form, prefix, middle, suffix (null if plain) and output of every row.

    The sha256 of seed and id deals the cuts, whether the text stays plain (all but `percent`) and which of the
    two orders it gets (spm for `spm_percent`). A text that holds a marker stays plain, as does an empty one.
    """
    _check(markers)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    h1, h2, h3, h4 = _hash_words(F.col(f"`{doc_id}`"), seed)
    read = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("text"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    cut = read.withColumn("cut", _cutter(unit)("text", "h1", "h2"))
    plain = (F.col("text") == "") | (F.col("h3") % 100 >= percent)
    for m in markers:
        plain = plain | F.contains("text", F.lit(m))
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    first, second = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    pieces = cut.select("doc_id", "text", F.col("cut.n").alias("n"), form.alias("form"), first.alias("first"), second.alias("second")).select(
        "doc_id", "text", "n", "form",
        F.when(F.col("form") != "plain", F.substring("text", F.lit(1), F.col("first"))).alias("prefix"),
        F.when(F.col("form") != "plain", F.substring("text", F.col("first") + 1, F.col("second") - F.col("first"))).alias("middle"),
        F.when(F.col("form") != "plain", F.substring("text", F.col("second") + 1, F.length("text"))).alias("suffix"),
    )
    p, s, m = map(F.lit, markers)
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "spm", F.concat(s, "suffix", p, "prefix", m, "middle"))
        .otherwise(F.concat(p, "prefix", s, "suffix", m, "middle"))
    )
    return pieces.select("doc_id", "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restored(made: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """made with restored: the text again, from output and form alone."""
    p, s, m = markers
    spm = F.col("form") == "spm"
    after = F.substring("output", F.when(spm, len(s)).otherwise(len(p)) + 1, F.length("output"))
    cut = made.withColumn("__a", after)
    cut = cut.withColumn("__1", F.when(spm, F.substring_index("__a", p, 1)).otherwise(F.substring_index("__a", s, 1)))
    rest = F.substring("__a", F.length("__1") + F.when(spm, len(p)).otherwise(len(s)) + 1, F.length("__a"))
    cut = cut.withColumn("__a", rest).withColumn("__2", F.substring_index("__a", m, 1))
    middle = F.substring("__a", F.length("__2") + len(m) + 1, F.length("__a"))
    whole = F.when(F.col("form") == "plain", F.col("output")).when(spm, F.concat("__2", middle, "__1")).otherwise(F.concat("__1", middle, "__2"))
    return cut.withColumn("restored", whole).drop("__a", "__1", "__2")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuts of every document, and digests of its output and of the text restored from that."""
    made = restored(fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text")))
    return made.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
  ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
  ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END AS output FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""
