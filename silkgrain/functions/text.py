"""Column functions for cleaning and measuring text (T rows of the inventory) and ids."""

from __future__ import annotations

import functools
import json
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from silkgrain import config as c

BLANK = r"[\s\p{Z}]"
CJK = r"[\x{4e00}-\x{9fff}]"


def strip(text: Column, blank: str = BLANK) -> Column:
    """Blanks (Unicode's, or those of a class) removed at both ends."""
    return F.regexp_replace(text, rf"^{blank}+|{blank}+\z", "")


def normalize_whitespace(text: Column) -> Column:
    """One blank for many, at most one empty line, none between CJK characters."""
    t = F.translate(F.coalesce(text, F.lit("")), " ​‌‍﻿", " ")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(t, rf"(?<={CJK})[ \t]+(?={CJK})", ""))


def remove_noise_lines(text: Column, patterns: tuple[str, ...] = c.NOISE_LINES) -> Column:
    """Empty lines and lines that match a pattern go."""
    def noisy(line: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.rlike(strip(line), F.lit(f"(?U){p}")) for p in patterns])

    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085  ]"), lambda x: (strip(x) != "") & ~noisy(x))
    return normalize_whitespace(F.array_join(lines, "\n"))


def _first(text: Column, pattern: str) -> Column:
    """Code points before the first match, null if there is none."""
    return F.when(F.rlike(text, F.lit(pattern)), F.length(F.split(text, pattern, 2)[0]))


def remove_front_matter(text: Column, markers: tuple[str, ...] = c.FRONT_MARKERS, starts: tuple[str, ...] = c.BODY_STARTS) -> Column:
    """Text before the earliest body start goes if a marker stands in the first 1200."""
    t = F.coalesce(text, F.lit(""))
    marked = reduce(lambda a, b: a | b, [F.contains(F.substring(t, 1, 1200), F.lit(m)) for m in markers])
    cut = F.array_min(F.array(*[_first(t, p) for p in starts]))
    return normalize_whitespace(F.when(marked & cut.between(1, 1600), F.substring(t, cut + 1, F.length(t))).otherwise(t))


def clean_page_text(text: Column) -> Column:
    """T4: T3 of T2 of T1."""
    return remove_front_matter(remove_noise_lines(normalize_whitespace(text)))


def remove_tail(text: Column, patterns: tuple[str, ...] = c.TAILS) -> Column:
    """T5: text from the earliest tail pattern on goes."""
    t = F.coalesce(text, F.lit(""))
    cut = F.array_min(F.array(*[_first(t, p) for p in patterns]))
    some = F.rlike(t, F.lit("|".join(f"(?:{p})" for p in patterns)))  # one pass over texts without a tail
    return normalize_whitespace(F.when(some, F.substring(t, F.lit(1), cut)).otherwise(t))


def chinese_ratio(text: Column) -> Column:
    """CJK characters over all characters."""
    return F.regexp_count(text, F.lit(CJK)) / F.greatest(F.length(text), F.lit(1))


def cjk_ratio(text: Column) -> Column:
    """CJK characters over characters that aren't blank."""
    return F.regexp_count(text, F.lit(CJK)) / F.greatest(F.length(F.regexp_replace(text, BLANK, "")), F.lit(1))


def is_english_paragraph(text: Column) -> Column:
    """80 characters or more, letters above 45 %, CJK below 20 %."""
    return (F.length(text) >= 80) & (F.regexp_count(text, F.lit("[A-Za-z]")) / F.greatest(F.length(text), F.lit(1)) > 0.45) & (chinese_ratio(text) < 0.2)


def format_table(body: Column) -> Column:
    """Rows after the first as ``header: value`` pairs; less than two rows give ''."""
    head = body[0]
    pair = lambda row: F.array_join(F.transform(row, lambda v, i: F.concat(F.coalesce(F.nullif(F.get(head, i), F.lit("")), F.concat(F.lit("列"), (i + 1).cast("string"))), F.lit(": "), F.coalesce(v, F.lit("")))), " | ")
    return F.when(F.size(body) < 2, F.lit("")).otherwise(F.array_join(F.transform(F.slice(body, F.lit(2), F.size(body)), pair), "\n"))


@functools.cache
def compatible_forms() -> tuple[str, str, dict[str, str]]:
    """Characters that NFKC makes one other character of, those characters, and those that it makes several of."""
    one, many = {}, {}
    for k in range(0x80, 0x2FA1E):
        ch = chr(k)
        to = unicodedata.normalize("NFKC", ch) if not 0xD800 <= k < 0xE000 else ch
        if to != ch:
            (one if len(to) == 1 else many)[ch] = to
    return "".join(one), "".join(one.values()), many


def compatible(text: Column) -> Column:
    """Each character in its NFKC form. Letters followed by combining marks aren't put together."""
    one, to, many = compatible_forms()
    x = F.translate(text, one, to)
    codes, ranges = sorted(map(ord, many)), []
    for k in codes:
        if ranges and k == ranges[-1][1] + 1:
            ranges[-1][1] = k
        else:
            ranges.append([k, k])
    known = F.lit("[" + "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in ranges) + "]")
    table = F.from_json(F.lit(json.dumps(many)), "map<string,string>")
    spelled = F.array_join(F.transform(F.split(x, ""), lambda ch: F.when(F.rlike(ch, known), F.try_element_at(table, ch)).otherwise(ch)), "")
    return F.when(F.rlike(x, known), spelled).otherwise(x)  # few texts have any


def anchor(text: Column) -> Column:
    """Lower case without blanks, compatible forms and three Greek letters as ASCII."""
    return F.lower(F.regexp_replace(F.translate(compatible(text), "αβγΑΒΓ", "abrABR"), BLANK, ""))


def merge_evidence(*groups: Column, limit: int = 12) -> Column:
    """Distinct items in order of first appearance, at most limit."""
    return F.slice(F.array_distinct(F.concat(*groups)), 1, limit)


def find_window(text: Column, needles: list[Column], margin: int = 180) -> Column:
    """The first needle found, with margin characters on both sides; null if none is."""
    def at(n: Column) -> Column:
        pos = F.instr(text, n)
        start = F.greatest(pos - margin, F.lit(1))
        return F.when((F.length(n) > 0) & (pos > 0), F.substring(text, start, pos + F.length(n) + margin - start))

    return F.coalesce(*map(at, needles))


def json_object(text: Column) -> Column:
    """The fenced block, else the first brace to the last; null unless it is an object."""
    fenced = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.lit(""))
    braces = F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
    found = F.coalesce(fenced, braces)
    return F.when(F.try_parse_json(found).isNotNull() & found.startswith("{"), found)


def bounded(value: Column) -> Column:
    """A number clamped to 0..1; what isn't one is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(value.try_cast("double"), F.lit(0.0))))


def core_disease_name(title: Column, markers: tuple[str, ...] = c.TITLE_MARKERS, prefixes: tuple[str, ...] = c.SCOPE_PREFIXES) -> Column:
    """The title's part before the first listed marker, without years, scope and society."""
    t = F.regexp_replace(F.regexp_replace(title, r"^[《》\s]+|[《》\s]+$", ""), r"[（(]\s*(?:19|20)\d{2}(?:\s*版)?\s*[）)]|[（(]\s*\d{4}\s*[）)]", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", ""), r"^[ ：:，,。.]+|[ ：:，,。.]+$", "")
    name = F.coalesce(*[F.when(F.contains(t, F.lit(m)), F.substring_index(t, m, 1)) for m in markers], F.lit(""))
    bare = F.coalesce(*[F.when(name.startswith(p) & (F.length(name) > len(p) + 2), F.substring(name, F.lit(len(p) + 1), F.length(name))) for p in prefixes], name)
    return F.regexp_replace(bare, r"^[\x{4e00}-\x{9fff}]{0,12}(?:学会|协会|分会|学组)", "")


def short_id(prefix: str, *parts: Column) -> Column:
    """Prefix and twelve hexadecimal digits of SHA-1 over the parts joined by a bar."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha1(joined), 1, 12))


def sigmoid(x: Column) -> Column:
    """A1."""
    return 1 / (1 + F.exp(-x))


def append_blocks(text: Column, blocks: Column, blank: str = BLANK, head: bool = True) -> Column:
    """Blocks (caption, text) that say something, marked and set below the page's text, whose end loses its blanks.
    head: so does the beginning of all."""
    said = F.filter(blocks, lambda b: strip(F.coalesce(b["text"], F.lit(""))) != "")
    name = lambda b: F.coalesce(F.nullif(b["caption"], F.lit("")), F.lit("图"))
    shown = F.transform(said, lambda b: F.concat(name(b), F.lit("\n[FIGURE_CONTENT]\n"), strip(b["text"]), F.lit("\n[/FIGURE_CONTENT]")))
    body = F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?<!{blank}){blank}+\z", "")
    whole = F.concat(body, F.lit("\n\n"), F.array_join(shown, "\n\n"))
    return F.when(F.size(said) > 0, strip(whole, blank) if head else whole).otherwise(text)


def json_object_strict(text: Column) -> Column:
    """The whole text without fence lines; null unless it is an object."""
    x = strip(text)
    inner = F.regexp_replace(F.regexp_replace(x, r"(?s)^```[^\n]*(\n|$)", ""), r"(?s)(^|\n)\s*```[^\n]*$", "")
    x = F.when(x.startswith("```"), strip(inner)).otherwise(x)
    return F.when(F.try_parse_json(x).isNotNull() & x.startswith("{"), x)


def coerce_bool(value: Column, default: bool) -> Column:
    """Words and numbers as a boolean; what is neither gives the default."""
    x = F.lower(strip(value.cast("string")))
    return F.when(x.isin(*c.YES), True).when(x.isin(*c.NO), False).otherwise(F.coalesce(x.try_cast("double").cast("boolean"), F.lit(default)))


def core_anchors(name: Column, modifiers: tuple[str, ...] = c.DISEASE_MODIFIERS) -> Column:
    """The name, the name without its first modifier, and that one's organ."""
    x = strip(F.coalesce(name, F.lit("")))
    base = F.coalesce(*[F.when(x.startswith(m) & (F.length(x) > len(m) + 1), F.substring(x, F.lit(len(m) + 1), F.length(x))) for m in modifiers])
    organ = F.regexp_extract(base, c.ORGAN_ENDING, 1)
    return F.array_distinct(F.filter(F.array(x, base, organ), lambda a: F.length(a) >= 2))


def is_child_name(name: Column, core: Column) -> Column:
    """Whether a name holds an anchor of the core disease and isn't its name."""
    return is_child_of(name, strip(F.coalesce(core, F.lit(""))), core_anchors(core))


def is_child_of(name: Column, whole: Column, anchors: Column) -> Column:
    """T21 for many names of one core disease, whose stripped name and anchors are columns of their own."""
    x = strip(F.coalesce(name, F.lit("")))
    return F.when((x == "") | (whole == ""), True).when(x == whole, False).otherwise(F.exists(anchors, lambda a: F.contains(x, a)))


def recover_exponents(line: Column, ocr: Column) -> Column:
    """Powers of ten that a line lost, from readings of its picture: status (none, corrected
    or unresolved) and text. A line on both sexes needs both sexes' exponents."""
    suspect = rf"(?i)([>≥=])\s*10\s*({c.UNIT})"
    found = F.regexp_extract_all(line, F.lit(suspect), 0)
    plain = F.transform(ocr, lambda x: F.translate(x, "⁰¹²³⁴⁵⁶⁷⁸⁹／", "0123456789/"))
    tight = F.transform(plain, lambda x: F.regexp_replace(x, r"\s+", ""))
    squeezed = F.regexp_replace(line, r"\s+", "")
    sexes = squeezed.contains("女性") & squeezed.contains("男性")
    first = lambda sex: F.get(F.filter(F.transform(tight, lambda x: F.regexp_extract(x, sex + c.BY_SEX, 1)), lambda v: v != ""), F.lit(0))
    pair = F.array(first("女性"), first("男性"))
    empty = F.array().cast("array<string>")
    by_sex = F.when(F.exists(pair, lambda v: v.isNull()), empty).otherwise(pair)
    exponents = F.when(sexes, by_sex).otherwise(F.flatten(F.transform(plain, lambda x: F.regexp_extract_all(x, F.lit(c.UNIT_IN_OCR), 1))))
    between = F.split(line, suspect, -1)
    put = lambda m, k: F.concat(F.regexp_extract(m, suspect, 1), F.lit("10^"), F.get(exponents, k), F.regexp_replace(F.regexp_extract(m, suspect, 2), r"\s+", ""))
    pieces = F.zip_with(between, F.transform(found, put), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    status = F.when(F.size(found) == 0, "none").when(F.size(exponents) < F.size(found), "unresolved").otherwise("corrected")
    return F.struct(status.alias("status"), F.when(status == "corrected", F.array_join(pieces, "")).otherwise(line).alias("text"))


def contract_issue(raw: Column, marked_chars: Column, most: int) -> Column:
    """why a model's answer breaks the contract of giving spans only, '' if it doesn't."""
    n = F.length(raw)
    return (
        F.when(n > most, "too_long").when(F.contains(raw, F.lit("cleaned_text")), "echoed_text")
        .when((marked_chars > 0) & (n > F.greatest(F.lit(8000), (marked_chars * 1.2).cast("int"))), "unusual_length").otherwise("")
    )


def extra_keys(json: Column, allowed: tuple[str, ...] = c.EDIT_KEYS) -> Column:
    """keys of an object beyond the allowed ones, in order."""
    return F.array_sort(F.array_except(F.json_object_keys(json), F.array(*map(F.lit, allowed))))


def join_pages(pages: Column) -> Column:
    """C17: pages (page, text) in order as one text, with a marked break before each but the first."""
    p = F.array_sort(pages)
    mark = lambda x, k: F.when(k == 0, x["text"]).otherwise(F.concat(F.lit("\n<<<PAGE_BREAK:"), x["page"].cast("string"), F.lit(">>>\n"), x["text"]))
    return F.array_join(F.transform(p, mark), "")


def split_pages(marked: Column, pages: Column) -> Column:
    """C17: the pages again, stripped; null if the breaks are not those of the expected pages."""
    p = F.array_sort(pages)
    found = F.transform(F.regexp_extract_all(marked, F.lit(r"\n<<<PAGE_BREAK:(\d+)>>>\n"), 1), lambda x: x.cast("int"))
    bodies = F.split(marked, r"\n<<<PAGE_BREAK:\d+>>>\n", -1)
    ok = F.array_sort(F.array_distinct(F.concat(F.slice(p, 1, 1), found))) == p
    both = F.zip_with(F.concat(F.slice(p, 1, 1), found), bodies, lambda a, b: F.struct(a.alias("page"), strip(b).alias("text")))
    return F.when(F.size(p) == 0, F.slice(both, 1, 0)).when(ok, both)


def shorten(text: Column, most: int = 80) -> Column:
    """One line of at most `most` characters."""
    x = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most), F.lit("..."))).otherwise(x)
