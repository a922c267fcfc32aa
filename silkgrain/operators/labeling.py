"""Labeling functions (L rows): builders of Columns, so a chunk's votes come from one scan."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silkgrain import config as c

VOTE = "struct<lf:string,label:string,vote:int,confidence:double,count:int,evidence:array<string>>"


def _vote(lf: str, label: str, hit: Column, confidence: Column, count: Column, evidence: Column) -> Column:
    """A vote or an abstention, confidence in 0..1 and count not negative."""
    return F.struct(
        F.lit(lf).alias("lf"), F.lit(label).alias("label"), F.when(hit, 1).otherwise(0).alias("vote"),
        F.when(hit, F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence))).otherwise(0.0).alias("confidence"),
        F.when(hit, F.greatest(count, F.lit(0))).otherwise(0).cast("int").alias("count"), F.when(hit, evidence).otherwise(F.array().cast("array<string>")).alias("evidence"),
    )


def occurrences(text: Column, term: str, most: int) -> Column:
    """How often a literal occurs without overlap, at most `most`; ASCII in either case."""
    body, needle = (F.lower(text), term.lower()) if term.isascii() else (text, term)
    gone = F.length(body) - F.length(F.replace(body, F.lit(needle), F.lit("")))
    return F.least((gone / len(needle)).cast("int"), F.lit(most))


def regex_spans(text: Column, pattern: str, most: int = 8) -> Column:
    """The first `most` matches in either case, each with start and end (code points) and text; none for a null text or a
    pattern that isn't one.

    Spark gives matches but not their places: these are the lengths of what stands between them, from a split by the same pattern."""
    try:
        re.compile(pattern)
    except re.error:
        return F.array().cast("array<struct<start:int,end:int,text:string>>")
    rule = f"(?iU)(?:{pattern})"
    found = F.filter(F.regexp_extract_all(text, F.lit(f"({rule})"), 1), lambda m: m != "")
    pairs = F.zip_with(F.split(text, rule, -1), found, lambda b, m: F.struct(F.length(b).alias("before"), m.alias("text")))
    pairs = F.slice(F.filter(pairs, lambda p: p["text"].isNotNull()), 1, most)
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")
    step = lambda s, p: F.struct((s["at"] + p["before"] + F.length(p["text"])).alias("at"), F.concat(s["out"], F.array(F.struct((s["at"] + p["before"]).alias("start"), (s["at"] + p["before"] + F.length(p["text"])).alias("end"), p["text"].alias("text")))).alias("out"))
    return F.coalesce(F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"], none)


def term_counts(text: Column, terms: tuple[str, ...]) -> Column:
    """Occurrences of each term, at most four: an array in order of terms."""
    return F.array(*[occurrences(text, x, 4) for x in terms])


def dictionary_vote(label: str, terms: tuple[str, ...], counts: Column) -> Column:
    """L3: confidence from the number of terms found, count from their occurrences."""
    found = F.size(F.filter(counts, lambda n: n > 0))
    total = F.least(F.aggregate(counts, F.lit(0), lambda a, n: a + n), F.lit(12))
    evidence = F.filter(F.array(*map(F.lit, terms)), lambda x, k: F.get(counts, k) > 0)
    return _vote("dictionary", label, found > 0, F.least(F.lit(0.92), 0.58 + 0.08 * F.least(found, F.lit(4))), total, evidence)


#: A class with its count at the beginning of a pattern.
_COUNTED = re.compile(r"^\[[^\[\]\\]+\]\{\d+,\d+\}(?![?+])")


def pattern_groups(text: Column, patterns: tuple[tuple[str, str, float], ...]) -> Column:
    """At most six matches of each pattern: an array in order of patterns.

    A pattern that begins with a counted class tries every place and length of it, so it is only used on texts that the rest of it matches."""

    def found(p: str) -> Column:
        some, rest = F.slice(F.regexp_extract_all(text, F.lit(f"({p})"), 1), 1, 6), _COUNTED.sub("", p)
        return some if rest in ("", p) else F.when(~F.rlike(text, F.lit(rest)), F.array().cast("array<string>")).otherwise(some)

    return F.array(*[found(p) for _, p, _ in patterns])


def pattern_vote(label: str, patterns: tuple[tuple[str, str, float], ...], groups: Column, lf: str = "medical_pattern", cap: float = 1.0) -> Column:
    """L4 (and L5 with a cap): the greatest confidence of the patterns that match; evidence is at
    most six matches of each and twelve in all."""
    evidence = F.slice(F.flatten(groups), 1, 12)
    best = F.greatest(*[F.when(F.size(F.get(groups, i)) > 0, F.lit(k)).otherwise(0.0) for i, (_, _, k) in enumerate(patterns)], F.lit(0.0))
    return _vote(lf, label, F.size(evidence) > 0, F.least(best, F.lit(cap)), F.size(evidence), evidence)


def section_vote(label: str, priors: tuple[tuple[str, float], ...], surface: Column, generic: tuple[str, ...] = c.GENERIC_SECTIONS) -> Column:
    """The greatest prior of the terms in a section's title and path."""
    hit = [F.contains(surface, F.lit(x)) for x, _ in priors]
    best = F.greatest(*[F.when(h, F.lit(p)).otherwise(0.0) for h, (_, p) in zip(hit, priors, strict=True)], F.lit(0.0))
    n = reduce(lambda a, b: a + b, [h.cast("int") for h in hit])
    usable = (F.coalesce(surface, F.lit("")) != "") & ~F.trim(surface).isin(*generic)
    terms = F.filter(F.array(*[F.when(h, F.lit(x)) for h, (x, _) in zip(hit, priors, strict=True)]), lambda x: x.isNotNull())
    return _vote("section_prior", label, usable & (best > 0), best, F.greatest(n, F.lit(1)), terms)


def response_vote(lf: str, label: str, present: Column, confidence: Column, count: Column, evidence: Column, status: Column) -> Column:
    """A model's answer as a vote; anything but status ok abstains, as does doubt below 0.5."""
    e = F.coalesce(evidence, F.array().cast("array<string>"))
    hit = F.coalesce((status == "ok") & present & (confidence >= 0.5), F.lit(False))
    return _vote(lf, label, hit, confidence, F.greatest(F.coalesce(count, F.lit(0)), F.size(e)), e)


RULE_LFS = ("dictionary", "medical_pattern", "section_prior")


def apply_rules(
    chunks: DataFrame, terms: dict = c.TERMS, patterns: dict = c.PATTERNS, priors: dict = c.PRIORS, tests: tuple = (), labels: tuple[str, ...] = c.LABELS, lfs: tuple[str, ...] = RULE_LFS
) -> DataFrame:
    """The named rule LFs on every (chunk, label): document_id, chunk_id and the vote.
    Only what these LFs look for is searched. tests: patterns of an LF on tests alone (L5: config.INDICATORS)."""
    # Matches are columns of their own, so that each text is searched once, not once a use.
    text, columns, votes = F.col("text"), [], []
    for label in labels:
        if "dictionary" in lfs:
            columns.append(term_counts(text, terms[label]).alias(f"d_{label}"))
            votes.append(dictionary_vote(label, terms[label], F.col(f"d_{label}")))
        if "medical_pattern" in lfs:
            columns.append(pattern_groups(text, patterns[label]).alias(f"p_{label}"))
            votes.append(pattern_vote(label, patterns[label], F.col(f"p_{label}")))
        if "section_prior" in lfs:
            votes.append(section_vote(label, priors[label], F.col("section")))
        if label == "tests" and tests:
            columns.append(pattern_groups(text, tuple((n, f"(?U){p}", k) for n, p, k in tests)).alias("t_tests"))  # word boundaries of any script
            votes.append(pattern_vote(label, tests, F.col("t_tests"), "regex_indicator", 0.64))
    return chunks.select("document_id", "chunk_id", "section", *columns).select("document_id", "chunk_id", F.inline(F.array(*votes)))


def traced(votes: DataFrame, chunks: DataFrame) -> DataFrame:
    """Votes with the section of their chunk."""
    return votes.join(chunks.select("document_id", "chunk_id", "section"), ["document_id", "chunk_id"], "left")


def apply_entity_rules(paired: DataFrame, kinds: tuple[str, ...] = c.ENTITY_TYPES) -> DataFrame:
    """The surface and the context LF on every entity (name, evidence_text, chunk_text) and
    type: document_id, entity_id, lf, label, vote, confidence."""
    surface = F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("evidence_text", F.lit("")))
    x = paired.withColumns({"__s": surface, "__w": evidence_window(F.coalesce("chunk_text", F.lit("")), F.coalesce("evidence_text", F.lit("")))})
    x = x.select("document_id", "entity_id", "__s", "__w").withColumns(searched(F.col("__s"), F.col("__w"), kinds))
    votes = []
    for kind in kinds:
        for lf, made in (("surface", surface_said(F.col(f"__surface_{kind}"))), ("context", context_said(F.col(f"__context_{kind}")))):
            votes.append(F.struct(F.lit(lf).alias("lf"), F.lit(kind).alias("label"), made[0].cast("int").alias("vote"), made[1].cast("double").alias("confidence")))
    return x.select("document_id", "entity_id", F.inline(F.array(*votes)))


def pair_with_chunks(entities: DataFrame, chunks: DataFrame) -> DataFrame:
    """Entities with their chunk's text and section, empty where the chunk is missing."""
    j = entities.join(chunks.select("document_id", "chunk_id", F.col("text").alias("chunk_text"), F.col("section").alias("chunk_section")), ["document_id", "chunk_id"], "left")
    return j.na.fill("", ["chunk_text", "chunk_section"])


def suggested_type_vote(label: Column, kind: Column) -> tuple[Column, Column]:
    """Vote and confidence for the suggested type, against another, none without one."""
    return (F.when(F.coalesce(kind, F.lit("")) == "", 0).when(kind == label, 1).otherwise(-1), F.when(F.coalesce(kind, F.lit("")) == "", 0.0).when(kind == label, 0.72).otherwise(0.25))


def surface_vote(text: Column, plain: tuple[str, ...], structural: tuple[str, ...] = (), negative: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Negative patterns decide first; confidence grows with the patterns found."""
    return surface_said(pattern_counts(text, plain, structural, negative))


def surface_said(counts: Column) -> tuple[Column, Column]:
    """L13 on what pattern_counts() found."""
    return _counted(counts, 0.62, lambda n, s: F.when(s > 0, F.greatest(F.lit(0.86), F.least(F.lit(0.9), 0.55 + 0.05 * n))).otherwise(F.least(F.lit(0.9), 0.55 + 0.05 * n)))


def context_vote(window: Column, plain: tuple[str, ...], structural: tuple[str, ...] = (), negative: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """The same over the text around the evidence."""
    return context_said(pattern_counts(window, plain, structural, negative))


def context_said(counts: Column) -> tuple[Column, Column]:
    """L14 on what pattern_counts() found."""
    return _counted(counts, 0.58, lambda n, s: F.when(s > 0, F.greatest(F.least(F.lit(0.78), 0.5 + 0.06 * (n - s)), F.least(F.lit(0.88), 0.70 + 0.06 * s))).otherwise(F.least(F.lit(0.78), 0.5 + 0.06 * n)))


def searched(surface: Column, window: Column, kinds: tuple[str, ...] = c.ENTITY_TYPES) -> dict[str, Column]:
    """Columns surface_K and context_K: the counts of each type's patterns."""
    tables = {"surface": (surface, c.SURFACE, c.SURFACE_STRUCTURAL, c.SURFACE_NEGATIVE), "context": (window, c.CONTEXT, c.CONTEXT_STRUCTURAL, c.CONTEXT_NEGATIVE)}
    return {f"__{lf}_{k}": pattern_counts(x, *(p.get(k, ()) for p in ps)) for lf, (x, *ps) in tables.items() for k in kinds}


#: Alternatives without a letter of ASCII or a sign of patterns.
_LITERAL = re.compile(r"^[^\x00-\x7f]+(?:\|[^\x00-\x7f]+)*$")


def _holds(text: Column, pattern: str) -> Column:
    """Whether a pattern is found, in either case of ASCII letters; alternatives that are plain text are looked up as such."""
    inner = pattern[1:-1] if pattern.startswith("(") and pattern.endswith(")") else pattern
    if not _LITERAL.match(inner):
        return F.rlike(text, F.lit(f"(?i){pattern}"))
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in inner.split("|")])


def pattern_counts(text: Column, plain: tuple[str, ...], structural: tuple[str, ...] = (), negative: tuple[str, ...] = ()) -> Column:
    """How many negative, structural and (plain or structural) patterns a text holds, as an array; stored as a column, it is searched once."""
    count = lambda ps: reduce(lambda a, b: a + b, [_holds(text, p).cast("int") for p in ps], F.lit(0))
    return F.array(count(negative), count(structural), count((*plain, *structural)))


def _counted(counts: Column, against: float, confidence) -> tuple[Column, Column]:  # noqa: ANN001
    bad, s, n = (F.get(counts, F.lit(k)) for k in range(3))
    return F.when(bad > 0, -1).when(n > 0, 1).otherwise(0), F.when(bad > 0, against).when(n > 0, confidence(n, s)).otherwise(0.0)


def evidence_window(text: Column, evidence: Column, margin: int = 80, fallback: int = 200) -> Column:
    """The text around the first hit of the evidence, else its beginning."""
    pos = F.instr(text, evidence)
    start = F.greatest(pos - margin, F.lit(1))
    return F.when((pos > 0) & (F.length(evidence) > 0), F.substring(text, start, pos + F.length(evidence) + margin - start)).otherwise(F.substring(text, 1, fallback))


def section_prior_vote(surface: Column, terms: tuple[str, ...]) -> tuple[Column, Column]:
    """A weak vote where the section names the type."""
    hit = reduce(lambda a, b: a | b, [F.contains(surface, F.lit(x)) for x in terms], F.lit(False))
    return F.when(hit, 1).otherwise(0), F.when(hit, 0.42).otherwise(0.0)


def label_matrix(votes: DataFrame, lfs: list[str]) -> DataFrame:
    """A column a LF with its last vote, 0 where there is none."""
    return votes.groupBy("document_id", "chunk_id", "label").pivot("lf", lfs).agg(F.max_by("vote", "ord")).na.fill(0)
