"""The registered queries of the document-to-graph engine, with their SQL.

Keys are <row of the inventory>_<name>. Each query applies an operator to tables derived from
the driver's; floating results are rounded where the order of a sum could show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions import text as t
from silkgrain.operators import entities as ent
from silkgrain.operators import fusion as fu
from silkgrain.operators import labeling as lab
from silkgrain.operators import layout as lay
from silkgrain.operators import metrics as met
from silkgrain.operators import quality as qu
from silkgrain.operators import relations as rel
from silkgrain.operators import segment as seg
from silkgrain.plans import inputs as i
from silkgrain.sources import io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "A5_weighted_vote"


def query(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


r6 = lambda x: F.round(x, 6)
D, C, V, EV, E, B, REL = i.DOCS_SQL, i.CHUNKS_SQL, i.VOTES_SQL, i.ENTITY_VOTES_SQL, i.ENTITIES_SQL, i.BOXES_SQL, i.CONTRACT_SQL
NORM = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '[ \t]+', ' ', 'g'), '\n{{3,}}', e'\n\n', 'g'), '^\s+', ''), '\s+$', '')"
norm = lambda x: NORM.format(x=x)
NOT_SPACE = r"length(regexp_replace({x}, '\s', '', 'g'))"


# ---- text
@query("T1_normalize", f"WITH {D} SELECT document_id, {norm('text')} AS text FROM docs")
def _(s, d):
    return i.docs(s, d).select("document_id", t.normalize_whitespace(F.col("text")).alias("text"))


@query("T2_noise_lines", rf"""WITH {D}, l AS (SELECT document_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '' AND NOT regexp_matches(trim(x), '^\s*[·•・]?\s*\d+\s*[·•・]?\s*$')
 AND NOT regexp_matches(trim(x), '^\s*\d+(?:\s+\d+)+\s*$') AND NOT regexp_matches(trim(x), '(?i)DOI[:：]?\s*10\.\d{{4,9}}/[^\s]+') AND NOT regexp_matches(trim(x), '(?i)\b10\.\d{{4,9}}/[^\s]+')), chr(10)) AS x FROM docs)
 SELECT document_id, {norm('x')} AS text FROM l""")
def _(s, d):
    return i.docs(s, d).select("document_id", t.remove_noise_lines(F.col("text")).alias("text"))


@query("T4_clean_page", None)
def _(s, d):
    return i.docs(s, d).select("document_id", t.clean_page_text(F.col("text")).alias("text"))


@query("T5_tail", rf"""WITH {D}, x AS (SELECT document_id, text, [length(string_split_regex(text, p)[1]) FOR p IN ['(?m)^\s*[［\[]\s*1\s*[］\]]', '(?im)^\s*(?:[0-9０-９]+[\.．、\s]*)?references\s*$'] IF regexp_matches(text, p)] AS cut FROM docs)
 SELECT document_id, {norm("CASE WHEN len(cut) > 0 THEN text[1:list_min(cut)] ELSE text END")} AS text FROM x""")
def _(s, d):
    return i.docs(s, d).select("document_id", t.remove_tail(F.col("text")).alias("text"))


@query("T6_chinese_ratio", f"WITH {D} SELECT document_id, len(regexp_extract_all(text, '[一-鿿]')) / greatest(length(text), 1)::DOUBLE AS ratio FROM docs")
def _(s, d):
    return i.docs(s, d).select("document_id", t.chinese_ratio(F.col("text")).alias("ratio"))


@query("T7_cjk_ratio", f"WITH {D} SELECT document_id, len(regexp_extract_all(text, '[一-鿿]')) / greatest({NOT_SPACE.format(x='text')}, 1)::DOUBLE AS ratio FROM docs")
def _(s, d):
    return i.docs(s, d).select("document_id", t.cjk_ratio(F.col("text")).alias("ratio"))


@query("T8_english_paragraph", f"WITH {C} SELECT document_id, chunk_index, length(text) >= 80 AND len(regexp_extract_all(text, '[A-Za-z]')) / greatest(length(text), 1)::DOUBLE > 0.45 AS english FROM chunks")
def _(s, d):
    return i.chunks(s, d).select("document_id", "chunk_index", t.is_english_paragraph(F.col("text")).alias("english"))


@query("T9_paragraph_join", f"WITH {C} SELECT document_id, string_agg(CASE WHEN chunk_index % 2 = 0 THEN '> ' || text ELSE text END, chr(10) || chr(10) ORDER BY chunk_index) AS text, count(*) FILTER (chunk_index % 2 = 0) AS translated FROM chunks GROUP BY document_id")
def _(s, d):
    x = i.chunks(s, d)
    answers = x.where("chunk_index % 2 = 0").select("document_id", "chunk_index", F.concat(F.lit("> "), "text").alias("answer"))
    j = x.join(answers, ["document_id", "chunk_index"], "left").withColumn("t", F.coalesce("answer", "text"))
    return j.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "t"))), lambda v: v["t"]), "\n\n").alias("text"), F.count("answer").alias("translated"))


@query("T11_format_table", f"WITH {D} SELECT document_id, 'a: ' || coalesce(string_split(text, ' ')[1], '') || ' | 列2: ' || document_id AS cell FROM docs")
def _(s, d):
    body = F.array(F.array(F.lit("a"), F.lit("")), F.array(F.split("text", " ")[0], F.col("document_id").cast("string")))
    return i.docs(s, d).select("document_id", t.format_table(body).alias("cell"))


@query("T12_anchor", rf"WITH {C} SELECT document_id, chunk_index, regexp_replace(lower(text), '\s', '', 'g') AS anchor FROM chunks")
def _(s, d):
    return i.chunks(s, d).select("document_id", "chunk_index", t.anchor(F.col("text")).alias("anchor"))


@query("T13_literal_counts", f"WITH {C} SELECT document_id, chunk_index, least((length(text) - length(replace(lower(text), 'the', ''))) // 3, 4)::INT AS n FROM chunks")
def _(s, d):
    return i.chunks(s, d).select("document_id", "chunk_index", lab.occurrences(F.col("text"), "the", 4).alias("n"))


@query("T14_regex_matches", f"WITH {C} SELECT document_id, chunk_index, array_to_string(regexp_extract_all(text, '[0-9]{{4,}}')[1:6], ',') AS found FROM chunks")
def _(s, d):
    return i.chunks(s, d).select("document_id", "chunk_index", F.array_join(F.slice(F.regexp_extract_all("text", F.lit("([0-9]{4,})"), 1), 1, 6), ",").alias("found"))


@query("T15_merge_evidence", f"""WITH {D}, g AS (SELECT document_id, list_concat(string_split(text, ' '), string_split(text, chr(10))) AS g FROM docs),
 w AS (SELECT document_id, unnest(g) AS x, generate_subscripts(g, 1) AS k FROM g), f AS (SELECT document_id, x, min(k) AS k FROM w GROUP BY ALL),
 n AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY k) AS r FROM f) SELECT document_id, string_agg(x, '|' ORDER BY r) AS evidence FROM n WHERE r <= 12 GROUP BY document_id""")
def _(s, d):
    return i.docs(s, d).select("document_id", F.array_join(t.merge_evidence(F.split("text", " "), F.split("text", "\n")), "|").alias("evidence"))


@query("T16_find_window", f"WITH {D}, p AS (SELECT *, instr(text, 'ing') AS a, instr(text, 'eau') AS b FROM docs), q AS (SELECT *, CASE WHEN a > 0 THEN a WHEN b > 0 THEN b END AS k FROM p) SELECT document_id, text[greatest(k - 180, 1):(k + 3 + 180 - 1)] AS w FROM q")
def _(s, d):
    return i.docs(s, d).select("document_id", t.find_window(F.col("text"), [F.lit("ing"), F.lit("eau")]).alias("w"))


@query("T17_json_object", "SELECT doc_id AS document_id, CASE doc_id % 3 WHEN 2 THEN NULL ELSE '{\"a\": ' || doc_id || '}' END AS json FROM documents")
def _(s, d):
    k = F.col("document_id")
    body = F.concat(F.lit('{"a": '), k.cast("string"), F.lit("}"))
    text = F.when(k % 3 == 0, F.concat(F.lit("So:\n```json\n"), body, F.lit("\n```"))).when(k % 3 == 1, F.concat(F.lit("It is "), body, F.lit(" then"))).otherwise(F.lit("none [1, 2]"))
    return i.docs(s, d).select("document_id", t.json_object(text).alias("json"))


@query("T18_bounded", "SELECT doc_id AS document_id, CASE doc_id % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 ELSE 0.0 END::DOUBLE AS v FROM documents")
def _(s, d):
    k = F.col("document_id") % 4
    return i.docs(s, d).select("document_id", t.bounded(F.when(k == 0, "-3").when(k == 1, "7.5").when(k == 2, "0.5").otherwise("x")).alias("v"))


@query("T20_core_disease", "SELECT doc_id AS document_id, CASE doc_id % 3 WHEN 0 THEN '急性胰腺炎' WHEN 1 THEN '白塞综合征' ELSE '' END AS name FROM documents")
def _(s, d):
    k = F.col("document_id") % 3
    return i.docs(s, d).select("document_id", t.core_disease_name(F.when(k == 0, "《中国急性胰腺炎诊治指南（2021）》").when(k == 1, "白塞综合征诊疗规范").otherwise("other")).alias("name"))


@query("T23_best_block", f"WITH {C}, q AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY length(text) DESC, chunk_index) AS k FROM chunks) SELECT document_id, chunk_index FROM q WHERE k = 1")
def _(s, d):
    w = Window.partitionBy("document_id").orderBy(F.desc(F.length("text")), "chunk_index")
    return i.chunks(s, d).withColumn("k", F.row_number().over(w)).where("k = 1").select("document_id", "chunk_index")


@query("T24_ids", "SELECT doc_id AS document_id, 'TEMP_' || sha1(doc_id || '|' || source || '|')[1:12] AS id FROM documents")
def _(s, d):
    return i.table(s, d, "documents", "doc_id", "source").select(F.col("doc_id").alias("document_id"), t.short_id("TEMP_", F.col("doc_id"), F.col("source"), F.lit(None)).alias("id"))


# ---- gates
@query("F1_text_quality", rf"""WITH {D}, b AS (SELECT document_id, regexp_replace(text, '\s', '', 'g') AS b FROM docs),
 n AS (SELECT document_id, length(b) AS total_chars, len(regexp_extract_all(b, '[A-Za-z]')) AS letters, len(regexp_extract_all(b, '\p{{Nd}}')) AS digits, len(regexp_extract_all(b, '\p{{S}}')) AS symbols, len(regexp_extract_all(b, '\?')) AS q FROM b)
 SELECT document_id, total_chars::INT AS total_chars, letters::INT AS ascii_letter_chars, digits::INT AS digit_chars, symbols::INT AS symbol_chars, total_chars < 80 AS short FROM n""")
def _(s, d):
    return qu.text_quality(i.docs(s, d)).select("document_id", "total_chars", "ascii_letter_chars", "digit_chars", "symbol_chars", F.array_contains("reasons", "too_little_extracted_text").alias("short"))


@query("F2_skipped_reports", None)
def _(s, d):
    return qu.skipped_reports(qu.text_quality(i.docs(s, d)))


@query("F3_language_drop", rf"WITH {C} SELECT document_id, chunk_index, CASE WHEN length(trim(text)) >= 80 THEN 'low_cjk_ratio' END AS drop_reason FROM chunks")
def _(s, d):
    return qu.language_drop(i.chunks(s, d)).select("document_id", "chunk_index", "drop_reason")


_NOISE = ", ".join(f"CASE WHEN regexp_matches(text, '(?im){p}') THEN 'noise:{k}' END" for k, p in c.CHUNK_NOISE)


@query("F4_validation", f"""WITH {C}, x AS (SELECT *, chunk_index % 9 AS a, chunk_index % 7 AS b, CASE WHEN chunk_index % 5 <> 4 THEN section END AS title FROM chunks)
 SELECT document_id, chunk_index, array_to_string([x FOR x IN [CASE WHEN title IS NULL THEN 'missing_field:title' END, CASE WHEN a > 5 THEN 'bad_page_range' END, CASE WHEN b >= 5 THEN 'bad_text_span' END, CASE WHEN {NOT_SPACE.format(x="text")} = 0 THEN 'empty_text' END, CASE WHEN length(text) > 300 THEN 'too_long' END, {_NOISE},
 CASE WHEN a = 2 THEN 'bad_page_region' END, CASE WHEN a = 3 THEN 'bad_linked_type:linked_tables' END, CASE WHEN b = 2 THEN 'missing_linked_id:linked_tables' END, CASE WHEN b = 1 THEN 'bad_linked_bbox:linked_tables' END] IF x IS NOT NULL], ',') AS issues,
 CASE WHEN length(text) < 200 AND count(*) OVER (PARTITION BY document_id) > 1 THEN 'too_short' ELSE '' END AS warnings FROM x""")
def _(s, d):
    a, b = F.col("chunk_index") % 9, F.col("chunk_index") % 7
    box = lambda short: F.when(short, F.array(F.lit(1.0))).otherwise(F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0))))
    linked = F.struct(F.when(b == 2, "").otherwise("T1").alias("object_id"), F.when(a == 3, "figure").otherwise("table").alias("object_type"), box(b == 1).alias("bbox"))
    x = i.chunks(s, d).withColumns({
        "path": F.array("section"), "title": F.when(F.col("chunk_index") % 5 != 4, F.col("section")), "page_start": a, "page_end": F.lit(5), "start": b, "end": F.lit(5),
        "page_regions": F.array(F.struct(F.lit(1).alias("page"), box(a == 2).alias("bbox"))), "linked_tables": F.array(linked),
    })
    v = qu.validate_chunks(x, 300)
    return v.select("document_id", "chunk_index", F.array_join("issues", ",").alias("issues"), F.array_join("warnings", ",").alias("warnings"))


@query("F7_suspicious_title", rf"""WITH {D}, x AS (SELECT document_id, trim(text) AS x FROM docs) SELECT document_id, CASE WHEN x = '' THEN 'empty_title' WHEN length(x) > 80 THEN 'title_too_long'
 {" ".join(f"WHEN contains(lower(x), '{k.lower()}') THEN 'contains_token:{k}'" for k in c.SUSPICIOUS_TOKENS)} WHEN len(regexp_extract_all(x, '[0-9]')) >= 4 AND length(x) <= 12 THEN 'dense_digits_short_title' ELSE '' END AS why
 FROM (SELECT document_id, regexp_replace(regexp_replace(x, '^\s+', ''), '\s+$', '') AS x FROM x)""")
def _(s, d):
    return i.docs(s, d).select("document_id", qu.suspicious_title(F.col("text")).alias("why"))


@query("F8_title_shape", f"WITH {C}, x AS (SELECT document_id, chunk_index, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS x FROM chunks) SELECT document_id, chunk_index, {i.issue_sql('x')} AS issue FROM x")
def _(s, d):
    return i.chunks(s, d).select("document_id", "chunk_index", qu.title_shape_issue(F.col("text")).alias("issue"))


@query("F12_usable_bbox", f"WITH {B} SELECT object_id, bottom - top >= 20 AND x1 - x0 >= 20 AND least(x0, top) >= 0 AND greatest(x1, bottom) <= 5000 AS usable FROM boxes")
def _(s, d):
    return i.boxes(s, d).select("object_id", qu.usable_bbox(F.col("x0"), F.col("top"), F.col("x1"), F.col("bottom"), 20.0).alias("usable"))


@query("F13_valid_edits", f"WITH {B}, w AS (SELECT *, (x0 / 10)::INT AS a, (x0 / 10)::INT + 1 + (object_id % 3)::INT AS b, lead((x0 / 10)::INT) OVER (PARTITION BY document_id, page ORDER BY (x0 / 10)::INT, (x0 / 10)::INT + 1 + (object_id % 3)::INT) AS nx FROM boxes) SELECT object_id, NOT bool_or(coalesce(nx < b, false) OR b > 55) OVER (PARTITION BY document_id, page) AS valid FROM w")
def _(s, d):
    x = i.boxes(s, d).select("object_id", F.struct("document_id", "page").alias("document_id"), (F.col("x0") / 10).cast("int").alias("start"), ((F.col("x0") / 10).cast("int") + 1 + (F.col("object_id") % 3).cast("int")).alias("end"), F.lit(55).alias("n_chars"))
    return qu.valid_edits(x).select("object_id", "valid")


@query("F5_body_words", f"WITH {B} SELECT object_id FROM boxes WHERE top > 0.06 * 700 AND top < 0.94 * 700")
def _(s, d):
    return lay.body_words(i.boxes(s, d).withColumn("page_height", F.lit(700.0))).select("object_id")


@query("F6_outside_tables", f"WITH {B} SELECT l.object_id FROM boxes l WHERE NOT EXISTS (SELECT 1 FROM boxes t WHERE t.object_type = 'table' AND t.document_id = l.document_id AND t.page = l.page AND greatest(0, least(l.x1, t.x1) - greatest(l.x0, t.x0)) * greatest(0, least(l.bottom, t.bottom) - greatest(l.top, t.top)) / greatest(1e-9, (l.x1 - l.x0) * (l.bottom - l.top)) >= 0.35)")
def _(s, d):
    return lay.outside_tables(i.boxes(s, d), i.boxes(s, d).where("object_type = 'table'")).select("object_id")


# ---- segmentation
@query("C1_full_text", f"WITH {C}, s AS (SELECT document_id, chunk_index, text, coalesce(sum(length(text) + 2) OVER (PARTITION BY document_id ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS st FROM chunks) SELECT document_id, rtrim(string_agg(text, chr(10) || chr(10) ORDER BY chunk_index), ' ') AS full_text, string_agg(st::VARCHAR, ',' ORDER BY chunk_index) AS starts FROM s GROUP BY document_id")
def _(s, d):
    g = seg.full_text(i.chunks(s, d).select("document_id", F.col("chunk_index").alias("page_number"), "text"))
    return g.select("document_id", "full_text", F.array_join(F.transform("pages", lambda p: p["start"].cast("string")), ",").alias("starts"))


@query("C2_page_of", f"WITH {C}, s AS (SELECT document_id, chunk_index, coalesce(sum(length(text) + 2) OVER (PARTITION BY document_id ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS st FROM chunks) SELECT document_id, max(chunk_index) FILTER (st <= 500) AS page, 500 - max(st) FILTER (st <= 500) AS \"offset\" FROM s GROUP BY document_id")
def _(s, d):
    g = seg.full_text(i.chunks(s, d).select("document_id", F.col("chunk_index").alias("page_number"), "text"))
    return g.select("document_id", seg.page_of(F.col("pages"), F.lit(500)).alias("p")).select("document_id", "p.*")


@query("C3_heading_level", "SELECT doc_id AS document_id, [1, 1, 2, 2, 3, NULL, 2, 4, 1, NULL][(doc_id % 10 + 1)::INT]::INT AS level FROM documents")
def _(s, d):
    titles = ["一、 临床表现", "诊断", "（二） 检查", "1.1 诊断路径", "1）分型", "发生率95%以上，持续2周或6周", "2. Methods of work", "2.1.2检查", "References", "plain words here"]
    return i.docs(s, d).select("document_id", seg.heading_level(F.element_at(F.array(*map(F.lit, titles)), (F.col("document_id") % 10 + 1).cast("int"))).alias("level"))


_SHORT = "length(text) < 60 AND length(text) > 0"


@query("C4_anchors", f"WITH {C}, s AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY document_id ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS start FROM chunks) SELECT document_id, start, CASE WHEN length(text) < 30 THEN 1 ELSE 2 END AS level FROM s WHERE {_SHORT}")
def _(s, d):
    return _demo_anchors(s, d).select("document_id", "start", "level")


def _demo_anchors(s, d):
    n = F.length("line")
    return seg.anchors(seg.lines(i.docs(s, d), "text"), F.when((n < 60) & (n > 0), F.when(n < 30, 1).otherwise(2)))


@query("C5_sections", None)
def _(s, d):
    return seg.sections(_demo_anchors(s, d)).select("document_id", "start", "end", F.array_join("path", " > ").alias("path"))


@query("C7_paragraphs", rf"WITH {D}, p AS (SELECT document_id, unnest(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10))) AS b, generate_subscripts(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), 1) AS k FROM docs), q AS (SELECT *, coalesce(sum(length(b) + 2) OVER (PARTITION BY document_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS start FROM p) SELECT document_id, start, (start + length(b))::INT AS finish FROM q WHERE trim(b) <> ''")
def _(s, d):
    x = i.docs(s, d).select("document_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return seg.paragraphs(x).select("document_id", "start", F.col("end").alias("finish"))


@query("C8_sentence_cut", rf"WITH {D}, x AS (SELECT document_id, text, length(regexp_extract(text[1:200], '(?s)^(.{{130,199}}[。！？；;.!?])', 1)) AS h FROM docs) SELECT document_id, (CASE WHEN length(text) <= 200 THEN length(text) WHEN h > 0 THEN h ELSE 200 END)::INT AS cut FROM x")
def _(s, d):
    return i.docs(s, d).select("document_id", seg.sentence_cut(F.col("text"), 200).alias("cut"))


@query("C12_chunks", None)
def _(s, d):
    return seg.build_chunks(i.docs(s, d), min_ratio=None).select("document_id", "chunk_id", "start", "end", "sha1_12", F.length("text").alias("n_chars"))


@query("C14_toc_candidates", f"""WITH {C}, r AS (SELECT document_id, chunk_index AS start, text AS title, 0.8::DOUBLE AS c, 'rule' AS src FROM chunks WHERE text <> ''),
 m AS (SELECT document_id, chunk_index, text, 0.7::DOUBLE, 'model' FROM chunks WHERE length(text) >= 20), b AS (SELECT * FROM r UNION ALL SELECT * FROM m)
 SELECT document_id, start, title, string_agg(src, ',' ORDER BY src) AS sources, CASE WHEN count(*) > 1 THEN greatest(max(c), 0.9) ELSE max(c) END::DOUBLE AS confidence FROM b GROUP BY ALL""")
def _(s, d):
    x = i.chunks(s, d).select("document_id", F.col("chunk_index").alias("start"), F.col("text").alias("title"), F.lit(1).alias("level"))
    g = seg.toc_candidates(x.where("title <> ''").withColumn("confidence", F.lit(0.8)), x.where("length(title) >= 20").withColumn("confidence", F.lit(0.7)))
    return g.select("document_id", "start", "title", F.array_join("sources", ",").alias("sources"), "confidence")


@query("C16_toc_metrics", f"WITH {C}, s AS (SELECT document_id, text, sum(length(text) + 1) OVER (PARTITION BY document_id ORDER BY chunk_index) AS start, sum(length(text) + 1) OVER (PARTITION BY document_id) - 1 AS n_chars FROM chunks), a AS (SELECT document_id, start, n_chars, CASE WHEN length(text) < 30 THEN 1 ELSE 3 END AS lv FROM s WHERE {_SHORT}), j AS (SELECT *, lead(lv) OVER (PARTITION BY document_id ORDER BY start) - lv > 1 AS jump FROM a) SELECT document_id, count(*) AS n, count(*) FILTER (jump) AS level_jumps, round(count(*) * 1000 / max(n_chars)::DOUBLE, 6) AS density FROM j GROUP BY document_id")
def _(s, d):
    a = _demo_anchors(s, d).withColumn("level", F.when(F.col("level") == 1, 1).otherwise(3))
    return seg.toc_metrics(a).select("document_id", "n", "level_jumps", r6(F.col("density")).alias("density"))


@query("C18_apply_edits", "SELECT doc_id AS document_id, '<a>' || text[3:5] || '<b>' || text[8:] AS text FROM documents")
def _(s, d):
    e = F.array(F.struct(F.lit(0).alias("start"), F.lit(2).alias("end"), F.lit("<a>").alias("replacement")), F.struct(F.lit(5).alias("start"), F.lit(7).alias("end"), F.lit("<b>").alias("replacement")))
    return i.docs(s, d).select("document_id", seg.apply_edits(F.col("text"), e).alias("text"))


@query("C19_bounded_body", f"WITH {C}, s AS (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY document_id ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS b FROM chunks) SELECT document_id, chunk_index AS page_number, text[1:(300 - b)] AS text FROM s WHERE b < 300")
def _(s, d):
    return seg.bounded_body(i.chunks(s, d).select("document_id", F.col("chunk_index").alias("page_number"), "text"), 300).select("document_id", "page_number", "text")


# ---- labeling functions
def _dictionary_sql(label: str) -> str:
    n = {x: f"least((length(text) - length(replace(lower(text), '{x}', ''))) // {len(x)}, 4)" for x in c.DEMO_TERMS[label]}
    found = " + ".join(f"({v} > 0)::INT" for v in n.values())
    return f"SELECT document_id, chunk_id, '{label}' AS label, ({found} > 0)::INT AS vote, CASE WHEN {found} > 0 THEN least(0.92, 0.58 + 0.08 * least({found}, 4)) ELSE 0 END::DOUBLE AS confidence, least({' + '.join(n.values())}, 12)::INT AS count FROM chunks"


@query("L3_dictionary", f"WITH {C} " + " UNION ALL ".join(map(_dictionary_sql, c.LABELS)))
def _(s, d):
    return _rules(s, d, "dictionary").select("document_id", "chunk_id", "label", "vote", r6(F.col("confidence")).alias("confidence"), "count")


def _rules(s, d, *lfs):
    return lab.apply_rules(i.chunks(s, d), c.DEMO_TERMS, c.DEMO_PATTERNS, c.DEMO_PRIORS, lfs=lfs or lab.RULE_LFS)


def _pattern_sql(label: str) -> str:
    ps = c.DEMO_PATTERNS[label]
    n = [f"least(len(regexp_extract_all(text, '{p}')), 6)" for _, p, _ in ps]
    best = ", ".join(f"CASE WHEN {v} > 0 THEN {k} ELSE 0 END" for v, (_, _, k) in zip(n, ps, strict=True))
    return f"SELECT document_id, chunk_id, '{label}' AS label, ({' + '.join(n)} > 0)::INT AS vote, greatest({best}, 0)::DOUBLE AS confidence, least({' + '.join(n)}, 12)::INT AS count FROM chunks"


@query("L4_patterns", f"WITH {C} " + " UNION ALL ".join(map(_pattern_sql, c.LABELS)))
def _(s, d):
    return _rules(s, d, "medical_pattern").select("document_id", "chunk_id", "label", "vote", "confidence", "count")


@query("L5_regex_indicator", f"WITH {C} SELECT document_id, chunk_id, (len(regexp_extract_all(text, '[0-9]{{4,}}')) > 0)::INT AS vote, CASE WHEN len(regexp_extract_all(text, '[0-9]{{4,}}')) > 0 THEN 0.64 ELSE 0 END::DOUBLE AS confidence FROM chunks")
def _(s, d):
    tests = (("digits", "[0-9]{4,}", 0.84),)
    x = i.chunks(s, d).select("document_id", "chunk_id", lab.pattern_groups(F.col("text"), tests).alias("g"))
    v = lab.pattern_vote("tests", tests, F.col("g"), "regex_indicator", 0.64)
    return x.select("document_id", "chunk_id", v.alias("v")).select("document_id", "chunk_id", "v.vote", "v.confidence")


def _section_sql(label: str) -> str:
    hit = {x: p for x, p in c.DEMO_PRIORS[label]}
    best = ", ".join(f"CASE WHEN contains(section, '{x}') THEN {p} ELSE 0 END" for x, p in hit.items())
    return f"SELECT document_id, chunk_id, '{label}' AS label, (greatest({best}, 0) > 0)::INT AS vote, greatest({best}, 0)::DOUBLE AS confidence FROM chunks"


@query("L6_section_prior", f"WITH {C} " + " UNION ALL ".join(map(_section_sql, c.LABELS)))
def _(s, d):
    return _rules(s, d, "section_prior").select("document_id", "chunk_id", "label", "vote", "confidence")


@query("L1_votes", None)
def _(s, d):
    return _rules(s, d).groupBy("lf", "label").agg(F.count("*").alias("n"), F.sum("vote").alias("votes"), F.sum("count").alias("found"))


@query("L7_response_votes", f"WITH {C} SELECT document_id, chunk_id, CASE WHEN chunk_index % 3 <> 0 AND chunk_index % 10 >= 5 THEN 1 ELSE 0 END AS vote, CASE WHEN chunk_index % 3 <> 0 AND chunk_index % 10 >= 5 THEN (chunk_index % 4)::INT ELSE 0 END AS count FROM chunks")
def _(s, d):
    k = F.col("chunk_index")
    v = lab.response_vote("prompted_llm", "tests", F.lit(True), (k % 10) / 10.0, (k % 4).cast("int"), F.array().cast("array<string>"), F.when(k % 3 == 0, "disabled").otherwise("ok"))
    return i.chunks(s, d).select("document_id", "chunk_id", v.alias("v")).select("document_id", "chunk_id", "v.vote", "v.count")


@query("L11_pairing", f"WITH {E} SELECT e.entity_id, coalesce(length(k.text), 0)::INT AS n FROM entities e LEFT JOIN (SELECT document_id, chunk_id, max(text) AS text FROM entities GROUP BY ALL) k USING (document_id, chunk_id)")
def _(s, d):
    e = i.entities(s, d)
    ch = e.groupBy("document_id", "chunk_id").agg(F.max("text").alias("text")).withColumn("section", F.lit(""))
    return lab.pair_with_chunks(e.drop("text"), ch).select("entity_id", F.length("chunk_text").alias("n"))


@query("L12_suggested_type", f"WITH {E} SELECT entity_id, CASE WHEN entity_type = 'tests' THEN 1 ELSE -1 END AS vote, CASE WHEN entity_type = 'tests' THEN 0.72 ELSE 0.25 END::DOUBLE AS confidence FROM entities")
def _(s, d):
    v, k = lab.suggested_type_vote(F.lit("tests"), F.col("entity_type"))
    return i.entities(s, d).select("entity_id", v.alias("vote"), k.alias("confidence"))


_SURF = "regexp_matches(x, '(?i)ing')::INT + regexp_matches(x, '(?i)er')::INT"


@query("L13_surface", f"WITH {E}, s AS (SELECT entity_id, name || ' ' || evidence_text AS x FROM entities), n AS (SELECT entity_id, regexp_matches(x, '(?i)der') AS bad, {_SURF} AS p, regexp_matches(x, '(?i)th.{{0,4}}on')::INT AS st FROM s) SELECT entity_id, CASE WHEN bad THEN -1 WHEN p + st > 0 THEN 1 ELSE 0 END AS vote, round(CASE WHEN bad THEN 0.62 WHEN st > 0 THEN greatest(0.86, least(0.9, 0.55 + 0.05 * (p + st))) WHEN p > 0 THEN least(0.9, 0.55 + 0.05 * p) ELSE 0 END::DOUBLE, 6) AS confidence FROM n")
def _(s, d):
    v, k = lab.surface_vote(F.concat_ws(" ", "name", "evidence_text"), ("ing", "er"), ("th.{0,4}on",), ("der",))
    return i.entities(s, d).select("entity_id", v.alias("vote"), r6(k).alias("confidence"))


@query("L14_context", f"WITH {E}, w AS (SELECT entity_id, CASE WHEN instr(text, evidence_text) > 0 AND length(evidence_text) > 0 THEN text[greatest(instr(text, evidence_text) - 80, 1):(instr(text, evidence_text) + length(evidence_text) + 79)] ELSE text[1:200] END AS x FROM entities), n AS (SELECT entity_id, {_SURF} AS p FROM w) SELECT entity_id, (p > 0)::INT AS vote, round(CASE WHEN p > 0 THEN least(0.78, 0.5 + 0.06 * p) ELSE 0 END::DOUBLE, 6) AS confidence FROM n")
def _(s, d):
    v, k = lab.context_vote(lab.evidence_window(F.col("text"), F.col("evidence_text")), ("ing", "er"))
    return i.entities(s, d).select("entity_id", v.alias("vote"), r6(k).alias("confidence"))


@query("L15_section", f"WITH {E} SELECT entity_id, (contains(name, 'er') OR contains(name, 'th'))::INT AS vote FROM entities")
def _(s, d):
    return i.entities(s, d).select("entity_id", lab.section_prior_vote(F.col("name"), ("er", "th"))[0].alias("vote"))


@query("L18_label_matrix", f"WITH {V} SELECT document_id, chunk_id, label, {', '.join(f'max(vote) FILTER (lf = {chr(39)}{x}{chr(39)}) AS {x}' for x in i.LFS)} FROM votes GROUP BY ALL")
def _(s, d):
    return lab.label_matrix(i.votes(s, d), list(i.LFS))


# ---- fusion
_W = "CASE lf " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in c.VOTE_WEIGHTS.items()) + " END"
_O = "CASE lf " + " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(c.VOTE_WEIGHTS)) + " END"
_T = "CASE label " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in c.THRESHOLDS.items()) + " END"
_A5 = f"""a5 AS (SELECT document_id, chunk_id, label, {_T} AS threshold, round(sum(vote * confidence * w) / sum(w), 6) AS vote_score, list(lf ORDER BY o) FILTER (vote > 0) AS sup, coalesce(max(count) FILTER (vote > 0), 0) AS count FROM (SELECT *, {_W} AS w, {_O} AS o FROM votes) GROUP BY ALL),
d AS (SELECT *, coalesce(len(sup), 0) > 0 AND vote_score >= threshold AS present, CASE WHEN coalesce(len(sup), 0) > 0 THEN round(1 / (1 + exp(-5.0 * (vote_score - threshold))), 4) ELSE 0 END::DOUBLE AS confidence FROM a5),
dec AS (SELECT *, CASE WHEN present AND list_has_any(sup, ['medical_pattern', 'prompted_llm', 'dictionary']) THEN 'accepted' WHEN present THEN 'weak' ELSE 'rejected' END AS status FROM d)"""


def decisions(s, d):
    """A5 with scores rounded, so that sums of any order give the same decisions."""
    x = fu.weighted_vote(i.votes(s, d)).withColumn("vote_score", r6(F.col("vote_score")))
    has = F.size("supporting_lfs") > 0
    x = x.withColumn("present", has & (F.col("vote_score") >= F.col("threshold"))).withColumn("confidence", F.when(has, F.round(t.sigmoid(5.0 * (F.col("vote_score") - F.col("threshold"))), 4)).otherwise(0.0))
    main = F.exists("supporting_lfs", lambda v: v.isin(*c.PRIMARY))
    return x.withColumn("status", F.when(F.col("present") & main, "accepted").when(F.col("present"), "weak").otherwise("rejected"))


@query("A5_weighted_vote", f"WITH {V}, {_A5} SELECT document_id, chunk_id, label, vote_score, present, confidence, status, count, coalesce(array_to_string(sup, ','), '') AS supporting FROM dec")
def _(s, d):
    return decisions(s, d).select("document_id", "chunk_id", "label", "vote_score", "present", "confidence", "status", "count", F.array_join("supporting_lfs", ",").alias("supporting"))


@query("A2_normalized_vote", f"WITH {V} SELECT document_id, chunk_id, label, round(coalesce(sum(vote * confidence * {_W}) / nullif(sum(abs(vote * confidence * {_W})), 0), 0), 6) AS score FROM votes GROUP BY ALL")
def _(s, d):
    return fu.normalized_weighted_vote(i.votes(s, d)).withColumn("score", r6(F.col("score")))


@query("A1_sigmoid", f"WITH {V} SELECT chunk_id, label, lf, round(1 / (1 + exp(-vote * confidence)), 6) AS p FROM votes")
def _(s, d):
    return i.votes(s, d).select("chunk_id", "label", "lf", r6(t.sigmoid(F.col("vote") * F.col("confidence"))).alias("p"))


@query("A3_majority", f"WITH {V} SELECT document_id, chunk_id, label, count(*) FILTER (vote > 0) > count(*) FILTER (vote < 0) AS present, round(coalesce(count(*) FILTER (vote > 0) / nullif(count(*) FILTER (vote <> 0), 0), 0), 6) AS confidence FROM votes GROUP BY ALL")
def _(s, d):
    return fu.majority(i.votes(s, d)).withColumn("confidence", r6(F.col("confidence")))


@query("A4_binary_vote", f"WITH {V}, x AS (SELECT document_id, chunk_id, label, round(coalesce(sum(vote * confidence * {_W}) / nullif(sum(abs(vote * confidence * {_W})), 0), 0), 6) AS score FROM votes GROUP BY ALL) SELECT *, score >= 0.35 AS present, round(1 / (1 + exp(-5.0 * score)), 4) AS confidence FROM x")
def _(s, d):
    return fu.binary_weighted_vote(fu.normalized_weighted_vote(i.votes(s, d)).withColumn("score", r6(F.col("score")))).withColumn("confidence", F.round("confidence", 4))


_M = "CASE lf " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in c.COUNT_WEIGHTS.items()) + " END * confidence"
_MAX = "CASE label " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in c.MAX_COUNT.items()) + " END"


@query("A6_count_fusion", f"WITH {V}, {_A5}, g AS (SELECT document_id, chunk_id, label, round(coalesce(sum({_M} * count) FILTER (vote > 0 AND count > 0 AND {_M} > 0) / sum({_M}) FILTER (vote > 0 AND count > 0 AND {_M} > 0), 0), 6) AS m, coalesce(len(list_distinct(flatten(list(evidence) FILTER (vote > 0 AND lf IN ('medical_pattern', 'dictionary', 'regex_indicator'))))), 0)::INT AS evidence_floor FROM votes GROUP BY ALL) SELECT document_id, chunk_id, label, CASE WHEN present THEN least(round_even(greatest(m, evidence_floor, 1), 0), {_MAX}) ELSE 0 END::INT AS predicted_count, evidence_floor, m AS weighted_count FROM g JOIN dec USING (document_id, chunk_id, label)")
def _(s, d):
    return fu.count_fusion(i.votes(s, d), decisions(s, d)).select("document_id", "chunk_id", "label", "predicted_count", "evidence_floor", r6(F.col("weighted_count")).alias("weighted_count"))


@query("A9_moments", f"WITH {V} SELECT a.label, a.lf AS lf_i, a.vote AS vote_i, b.lf AS lf_j, b.vote AS vote_j, count(*) AS n FROM votes a JOIN votes b USING (document_id, chunk_id, label) WHERE a.vote <> 0 AND b.vote <> 0 GROUP BY ALL")
def _(s, d):
    return fu.moments(i.votes(s, d))


@query("A9_label_model", None)
def _(s, d):
    return fu.label_model(i.votes(s, d))


@query("A10_majority_probability", f"WITH {V} SELECT document_id, chunk_id, label, CASE WHEN sum(vote) > 0 THEN 1.0 WHEN sum(vote) < 0 THEN 0.0 ELSE 0.5 END::DOUBLE AS probability FROM votes GROUP BY ALL")
def _(s, d):
    return fu.majority_probability(i.votes(s, d))


@query("A12_last_votes", f"WITH {V} SELECT document_id, chunk_id, label, lf, -vote AS vote FROM votes")
def _(s, d):
    v = i.votes(s, d)
    return fu.last_votes(v.unionByName(v.withColumn("vote", -F.col("vote")).withColumn("ord", F.lit(1)))).select("document_id", "chunk_id", "label", "lf", "vote")


@query("A13_merge_model", f"WITH {V}, {_A5}, m AS (SELECT document_id, chunk_id, label, CASE WHEN sum(vote) > 0 THEN 'accepted' ELSE 'rejected' END AS s FROM votes WHERE chunk_id % 2 = 0 GROUP BY ALL) SELECT document_id, chunk_id, label, coalesce(s, status) AS status, coalesce(s = 'accepted', present) AS present FROM dec LEFT JOIN m USING (document_id, chunk_id, label)")
def _(s, d):
    dec, v = decisions(s, d), i.votes(s, d)
    model = v.where("chunk_id % 2 = 0").groupBy(*fu.KEY).agg(F.when(F.sum("vote") > 0, "accepted").otherwise("rejected").alias("status"), F.lit(0.5).alias("probability"))
    return fu.merge_model(dec, model, fu.count_fusion(v, dec)).select(*fu.KEY, "status", "present")


_A14 = """s AS (SELECT document_id, entity_id, label, label_ord, round(sum(CASE WHEN vote > 0 THEN confidence WHEN vote < 0 THEN -0.6 * confidence ELSE 0 END), 6) AS score FROM evotes GROUP BY ALL),
p AS (SELECT *, round(exp(score - max(score) OVER w) / sum(exp(score)) OVER w * exp(max(score) OVER w), 6) AS probability FROM s WINDOW w AS (PARTITION BY entity_id)),
b AS (SELECT entity_id, label AS final_type, probability, round(probability - coalesce(lead(probability) OVER v, 0), 6) AS gap, row_number() OVER v AS k FROM p WINDOW v AS (PARTITION BY entity_id ORDER BY probability DESC, label_ord)),
best AS (SELECT entity_id, final_type, probability, gap FROM b WHERE k = 1)"""


def _softmax(s, d):
    return fu.softmax_scores(i.entity_votes(s, d)).withColumn("probability", r6(F.col("probability")))


def _best(s, d):
    return fu.top_two(_softmax(s, d)).withColumn("gap", r6(F.col("gap")))


@query("A14_softmax", f"WITH {EV}, {_A14} SELECT entity_id, label, probability FROM p")
def _(s, d):
    return _softmax(s, d).select("entity_id", "label", "probability")


@query("A15_top2", f"WITH {EV}, {_A14} SELECT * FROM best")
def _(s, d):
    return _best(s, d)


@query("A16_one_vs_rest", f"WITH {EV}, x AS (SELECT entity_id, label, label_ord, CASE WHEN sum(vote) > 0 THEN 1.0 WHEN sum(vote) < 0 THEN 0.0 ELSE 0.5 END::DOUBLE AS p FROM evotes GROUP BY ALL) SELECT entity_id, label, round(p / coalesce(nullif(sum(p) OVER (PARTITION BY entity_id), 0), 1), 6) AS normalized FROM x")
def _(s, d):
    v = i.entity_votes(s, d)
    p = v.groupBy("entity_id", "label").agg(F.when(F.sum("vote") > 0, 1.0).when(F.sum("vote") < 0, 0.0).otherwise(0.5).alias("probability"))
    return fu.one_vs_rest(p).select("entity_id", "label", r6(F.col("normalized")).alias("normalized"))


_A17 = f"""tri AS (SELECT e.document_id, e.entity_id, e.entity_type AS candidate_type, name, evidence_text, final_type, probability, gap, contains(text, evidence_text) AS located,
 CASE WHEN name = '' OR evidence_text = '' OR NOT contains(text, evidence_text) THEN 'rejected' WHEN probability >= {{a}} AND gap >= {{g}} THEN 'accepted' WHEN probability < {{r}} THEN 'rejected' ELSE 'review' END AS status FROM best JOIN entities e USING (entity_id))"""
_TRI = _A17.format(a=0.3, g=0.1, r=0.2)


def _triaged(s, d):
    e = i.entities(s, d).select("document_id", "entity_id", F.col("entity_type").alias("candidate_type"), "name", "evidence_text", F.contains("text", "evidence_text").alias("located"))
    return fu.triage(_best(s, d).join(e, "entity_id"), 0.3, 0.2, 0.1)


@query("A17_triage", f"WITH {EV}, {E}, {_A14}, {_TRI} SELECT entity_id, final_type, status FROM tri")
def _(s, d):
    return _triaged(s, d).select("entity_id", "final_type", "status")


@query("A18_located", f"WITH {E} SELECT entity_id, contains(text, evidence_text) AS located FROM entities")
def _(s, d):
    x = F.contains("text", "evidence_text") | F.contains(t.anchor(F.col("text")), t.anchor(F.col("evidence_text")))
    return i.entities(s, d).select("entity_id", x.alias("located"))


_A19 = """pv AS (SELECT v.entity_id, count(DISTINCT lf) FILTER (vote > 0 AND confidence >= 0.5 AND lf LIKE 'prompt%' AND label = candidate_type) AS agree, count(*) FILTER (vote > 0 AND confidence >= 0.9 AND lf LIKE 'nothing%') AS z,
 count(*) FILTER (vote > 0 AND confidence >= 0.5 AND lf LIKE 'prompt%' AND label <> candidate_type) AS against FROM evotes v JOIN tri USING (entity_id) GROUP BY ALL)"""


@query("A19_protect", f"WITH {EV}, {E}, {_A14}, {_TRI}, {_A19} SELECT entity_id, agree >= 1 AND against = 0 AND located AS protected, CASE WHEN agree >= 1 AND against = 0 AND located THEN 'accepted' ELSE status END AS status FROM tri JOIN pv USING (entity_id)")
def _(s, d):
    return fu.protect(_triaged(s, d), i.entity_votes(s, d), 1, 0.5).select("entity_id", "protected", "status")


@query("A20_override", f"WITH {EV}, {E}, {_A14}, {_TRI}, o AS (SELECT *, (final_type IN ('treatments', 'plans') OR candidate_type IN ('treatments', 'plans')) AND regexp_matches(name || chr(10) || evidence_text, '(?i)er') AS hit FROM tri) SELECT entity_id, hit AS overridden, CASE WHEN hit THEN 'plans' ELSE final_type END AS final_type, CASE WHEN hit AND located THEN 'accepted' ELSE status END AS status FROM o")
def _(s, d):
    return fu.plan_override(_triaged(s, d), ("er",)).select("entity_id", "overridden", "final_type", "status")


@query("A22_recall", f"WITH {EV}, {E}, {_A14}, {_TRI}, k AS (SELECT candidate_type AS label, count(*) AS candidates FROM tri GROUP BY 1), o AS (SELECT final_type AS label, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'rejected') AS rejected FROM tri GROUP BY 1) SELECT label, coalesce(candidates, 0) AS candidates, coalesce(accepted, 0) AS accepted, coalesce(review, 0) AS review, coalesce(rejected, 0) AS rejected FROM k FULL JOIN o USING (label)")
def _(s, d):
    return fu.recall_report(_triaged(s, d)).select("label", "candidates", "accepted", "review", "rejected")


# ---- entities
@query("E1_prompt_modes", f"WITH {V}, {_A5} SELECT document_id, chunk_id, label, CASE WHEN present THEN 'extract' ELSE 'check_only' END AS mode FROM dec")
def _(s, d):
    dec = decisions(s, d)
    labels = s.createDataFrame([(x,) for x in c.LABELS], "label string")
    return ent.prompt_modes(dec.select("document_id", "chunk_id").distinct(), labels, dec)


@query("E3_parse_responses", f"WITH {E} SELECT document_id, chunk_id, 'tests' AS entity_type, 'T' || entity_id AS name, 0.5::DOUBLE AS confidence FROM entities WHERE entity_id % 3 <> 2")
def _(s, d):
    k = F.col("entity_id").cast("string")
    item = lambda n, e: F.concat(F.lit('{"name": "'), n, F.lit('", "evidence": "'), F.lit(e), F.lit('", "confidence": 0.5}'))
    name = F.concat(F.lit("T"), k)
    body = F.concat(F.lit('```json\n{"tests": ['), item(name, "e"), F.lit(", "), item(name, "f"), F.lit(", "), item(F.lit(""), "g"), F.lit("]}\n```"))
    r = i.entities(s, d).select("document_id", "chunk_id", body.alias("text"), F.when(F.col("entity_id") % 3 == 2, "disabled").otherwise("ok").alias("status"))
    return ent.parse_responses(r, c.ENTITY_TYPES).select("document_id", "chunk_id", "entity_type", "name", "confidence")


@query("E6_entity_base", f"WITH {E} SELECT DISTINCT document_id, chunk_id, entity_type, trim(name) AS name, 'TEMP_' || sha1(document_id || '|' || chunk_id || '|' || entity_type || '|' || trim(name))[1:12] AS entity_id FROM entities WHERE trim(name) <> ''")
def _(s, d):
    x = i.entities(s, d).select("document_id", "chunk_id", "entity_type", "name", F.col("entity_id").alias("ord"))
    return ent.entity_base(x).select("document_id", "chunk_id", "entity_type", "name", "entity_id")


@query("E4_override_flags", f"WITH {E}, k AS (SELECT DISTINCT document_id, chunk_id, entity_type FROM entities WHERE status = 'rejected') SELECT entity_id, EXISTS (SELECT 1 FROM k WHERE k.document_id = e.document_id AND k.chunk_id = e.chunk_id AND k.entity_type = e.entity_type) AS override_lv1 FROM entities e")
def _(s, d):
    e = i.entities(s, d)
    dec = e.where("status = 'rejected'").select("document_id", "chunk_id", F.col("entity_type").alias("label"), "status").distinct()
    return ent.override_flags(e, dec).select("entity_id", "override_lv1")


@query("E8_default_properties", f"WITH {E} SELECT entity_id, CASE entity_type WHEN 'tests' THEN 'normal=,unit=mg' ELSE '' END AS properties FROM entities")
def _(s, d):
    e = i.entities(s, d).withColumn("candidate_properties", F.create_map(F.lit("unit"), F.lit("mg"), F.lit("other"), F.lit("x")))
    p = ent.default_properties(e, {"tests": ("unit", "normal")})
    return p.select("entity_id", F.array_join(F.transform(F.array_sort(F.map_entries("properties")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",").alias("properties"))


@query("E10_nodes", f"WITH {E} SELECT entity_id, CASE WHEN status = 'review' THEN 'review_defaults' WHEN entity_id % 2 = 0 THEN 'ok' ELSE 'fallback_defaults' END AS property_status FROM entities WHERE status <> 'rejected'")
def _(s, d):
    e = i.entities(s, d).withColumns({"response_status": F.when(F.col("entity_id") % 2 == 0, "ok").otherwise("disabled"), "probability": F.lit(0.5), "property_confidence": F.lit(0.7)})
    return ent.split_nodes(e, True)[0].select("entity_id", "property_status")


@query("F10_usable_entities", f"WITH {E} SELECT entity_id FROM entities WHERE status = 'accepted' OR (status = 'review' AND entity_type = 'diseases')")
def _(s, d):
    return qu.usable_entities(i.entities(s, d), True).select("entity_id")


@query("F11_missing_hub", f"WITH {E} SELECT document_id, 'no_sub_diseases' AS error FROM entities GROUP BY 1 HAVING count(*) FILTER (entity_type = 'sub_diseases' AND document_id % 2 = 0) = 0")
def _(s, d):
    return qu.missing_hub(i.entities(s, d).where("NOT (entity_type = 'sub_diseases' AND document_id % 2 = 1)"))


@query("F9_extractable", f"WITH {V}, {_A5} SELECT DISTINCT document_id, chunk_id FROM dec WHERE present AND status IN ('accepted', 'weak')")
def _(s, d):
    dec = decisions(s, d)
    return qu.extractable(dec.select("document_id", "chunk_id").distinct(), dec)


# ---- relations
_R1 = f"""cand AS (SELECT a.document_id, relation, a.entity_id AS start_entity_id, b.entity_id AS end_entity_id, a.chunk_index AS sc, b.chunk_index AS ec, abs(a.chunk_index - b.chunk_index) AS chunk_distance, quota
 FROM entities a JOIN rel ON a.entity_type = source_type JOIN entities b ON b.document_id = a.document_id AND b.entity_type = target_type AND a.entity_id <> b.entity_id
 WHERE relation = 'has_sub_disease' OR abs(a.chunk_index - b.chunk_index) <= least(6, max_distance)),
lvl AS (SELECT *, CASE WHEN relation = 'has_sub_disease' AND chunk_distance > 0 THEN 'document' WHEN chunk_distance = 0 THEN 'same_chunk' WHEN chunk_distance = 1 THEN 'adjacent_chunk' WHEN chunk_distance <= 6 THEN 'near_chunk_window' ELSE 'document' END AS search_level,
 row_number() OVER (PARTITION BY document_id ORDER BY chunk_distance, relation, sc, ec, start_entity_id, end_entity_id) AS pos FROM cand)"""


def _cands(s, d):
    e = i.entities(s, d)
    return rel.ordered(rel.candidates(e.drop("text"), e, None))


@query("R1_candidates", f"WITH {E}, {REL}, {_R1} SELECT document_id, start_entity_id, relation, end_entity_id, chunk_distance, search_level, pos FROM lvl")
def _(s, d):
    return _cands(s, d).select("document_id", "start_entity_id", "relation", "end_entity_id", "chunk_distance", "search_level", "pos")


@query("R3_triggers", f"WITH {E}, {REL}, {_R1} SELECT l.document_id, l.start_entity_id, l.relation, l.end_entity_id FROM lvl l JOIN entities a ON a.entity_id = l.start_entity_id JOIN entities b ON b.entity_id = l.end_entity_id WHERE relation = 'has_sub_disease' OR chunk_distance = 0 OR relation <> 'causes' OR contains(a.evidence_text, 'th') OR contains(b.evidence_text, 'th')")
def _(s, d):
    e = i.entities(s, d)
    own = e.withColumn("chunk_id", F.col("entity_id").cast("string"))
    ch = own.select("document_id", "chunk_id", F.col("evidence_text").alias("text"))
    return rel.candidates(own.drop("text"), ch, {"causes": ("th",)}).select("document_id", "start_entity_id", "relation", "end_entity_id")


@query("R5_topk", f"WITH {E}, {REL}, {_R1} SELECT document_id, start_entity_id, relation, end_entity_id FROM lvl WHERE pos <= 5")
def _(s, d):
    e = i.entities(s, d)
    return rel.limited(rel.candidates(e.drop("text"), e, None), 5).select("document_id", "start_entity_id", "relation", "end_entity_id")


@query("R7_context", f"WITH {C} SELECT document_id, chunk_index, concat_ws(chr(10) || chr(10), lag(text) OVER w, text, lead(text) OVER w) AS context FROM chunks WINDOW w AS (PARTITION BY document_id ORDER BY chunk_index)")
def _(s, d):
    return rel.neighbour_context(i.chunks(s, d)).select("document_id", "chunk_index", "context")


_AUD = "aud AS (SELECT *, (start_entity_id + end_entity_id) % 3 <> 0 AS approved, CASE WHEN relation = 'causes' THEN end_entity_id ELSE start_entity_id END AS anchor, list_position(['same_chunk', 'adjacent_chunk', 'near_chunk_window', 'document'], search_level) AS level FROM lvl)"
_R10 = f"""{_AUD}, nth AS (SELECT *, row_number() OVER (PARTITION BY document_id, relation, anchor ORDER BY level, pos) AS nth FROM aud WHERE approved),
ok AS (SELECT * FROM nth WHERE quota IS NULL OR nth <= quota), sure AS (SELECT document_id, end_entity_id AS tr, min(level) AS since FROM ok WHERE relation = 'follows_treatment' GROUP BY ALL),
r10 AS (SELECT * FROM ok WHERE relation <> 'implements_by' UNION ALL SELECT ok.* FROM ok JOIN sure ON sure.document_id = ok.document_id AND tr = start_entity_id AND since <= level WHERE relation = 'implements_by')"""


def _audited(s, d):
    return _cands(s, d).withColumn("approved", (F.col("start_entity_id") + F.col("end_entity_id")) % 3 != 0).withColumn("confidence", F.lit(0.8))


@query("R10_quota", f"WITH {E}, {REL}, {_R1}, {_R10} SELECT document_id, start_entity_id, relation, end_entity_id, search_level FROM r10")
def _(s, d):
    return rel.with_quotas(_audited(s, d)).select("document_id", "start_entity_id", "relation", "end_entity_id", "search_level")


@query("R9_audit_results", f"WITH {E}, {REL}, {_R1} SELECT document_id, start_entity_id, relation, end_entity_id, pos % 2 = 0 AND pos % 3 <> 0 AS approved FROM lvl")
def _(s, d):
    x = _cands(s, d)
    answers = x.where("pos % 2 = 0").select("candidate_id", F.lit(True).alias("approved"), F.when(F.col("pos") % 3 == 0, "").otherwise("e").alias("evidence"), F.lit("0.9").alias("confidence"))
    return rel.audit_results(x, answers).select("document_id", "start_entity_id", "relation", "end_entity_id", "approved")


@query("R11_escalate", f"WITH {E}, x AS (SELECT entity_id AS candidate_id, k AS level, k >= entity_id % 4 AND entity_id % 4 > 0 AS signal FROM entities, (VALUES (1), (2), (3)) t(k)) SELECT candidate_id, coalesce(min(level) FILTER (signal), 3)::VARCHAR AS properties, min(level) FILTER (signal) AS level FROM x GROUP BY ALL")
def _(s, d):
    x = i.entities(s, d).select(F.col("entity_id").alias("candidate_id"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("level"))
    x = x.withColumn("signal", (F.col("level") >= F.col("candidate_id") % 4) & (F.col("candidate_id") % 4 > 0)).withColumn("properties", F.col("level").cast("string"))
    return rel.escalate(x)


@query("R12_records", f"WITH {E}, {REL}, {_R1}, {_R10} SELECT 'REL_' || sha1(document_id || '|' || start_entity_id || '|' || relation || '|' || end_entity_id)[1:12] AS relation_id, relation, search_level FROM r10")
def _(s, d):
    return rel.records(rel.with_quotas(_audited(s, d))).select("relation_id", "relation", "search_level")


@query("R13_summary", f"WITH {E}, {REL}, {_R1}, {_R10} SELECT relation, search_level, count(*) AS n, count(DISTINCT document_id) AS documents FROM r10 GROUP BY ALL")
def _(s, d):
    return rel.summary(rel.records(rel.with_quotas(_audited(s, d))))


# ---- layout
@query("G6_union_boxes", f"WITH {B} SELECT document_id, page, min(x0) AS x0, min(top) AS top, max(x1) AS x1, max(bottom) AS bottom FROM boxes GROUP BY ALL")
def _(s, d):
    return lay.union_boxes(i.boxes(s, d), "document_id", "page")


@query("G1_rows", None)
def _(s, d):
    words = i.boxes(s, d).select("document_id", "page", F.col("line").alias("text"), "x0", "x1", "top", "bottom")
    return lay.row_lines(lay.cluster_rows(words)).select("document_id", "page", "row", "line")


@query("G4_two_columns", None)
def _(s, d):
    words = i.boxes(s, d).select("document_id", "page", "x0", "x1", F.lit(700.0).alias("page_width"))
    return lay.two_columns(words, least_words=8).withColumn("split_x", r6(F.col("split_x")))


@query("G7_regions", f"WITH {B}, j AS (SELECT k.document_id, k.object_id AS chunk_id, l.page, l.x0, l.top, l.x1, l.bottom, contains(regexp_replace(k.line, '\\s+', '', 'g'), regexp_replace(l.line, '\\s+', '', 'g')[1:12]) AND regexp_replace(l.line, '\\s+', '', 'g') <> '' AS own FROM boxes k JOIN boxes l ON k.document_id = l.document_id AND l.page BETWEEN k.page AND k.page + 1) SELECT document_id, chunk_id, page, coalesce(min(x0) FILTER (own), min(x0)) AS x0, coalesce(max(bottom) FILTER (own), max(bottom)) AS bottom, bool_or(own) AS matched FROM j GROUP BY ALL")
def _(s, d):
    b = i.boxes(s, d)
    k = b.select("document_id", F.col("object_id").alias("chunk_id"), F.col("line").alias("text"), F.col("page").alias("page_start"), (F.col("page") + 1).alias("page_end"))
    return lay.chunk_regions(k, b.select("document_id", "page", "line", "x0", "top", "x1", "bottom")).select("document_id", "chunk_id", "page", "x0", "bottom", "matched")


@query("G9_nearest_caption", f"WITH {B}, n AS (SELECT o.object_id, k.object_id AS caption_id, o.top - k.bottom AS distance, row_number() OVER (PARTITION BY o.object_id ORDER BY o.top - k.bottom, k.object_id) AS r FROM boxes o JOIN boxes k ON o.document_id = k.document_id AND o.page = k.page AND o.top - k.bottom BETWEEN 0 AND 90) SELECT o.object_id, caption_id, distance FROM boxes o LEFT JOIN n ON n.object_id = o.object_id AND r = 1")
def _(s, d):
    b = i.boxes(s, d)
    return lay.nearest_caption(b, b.withColumnRenamed("object_id", "caption_id")).select("object_id", "caption_id", "distance")


@query("G12_explicit", f"WITH {B}, k AS (SELECT DISTINCT document_id, object_id AS chunk_id, CASE WHEN object_id % 2 = 0 THEN 'table' ELSE 'figure' END AS ty, (object_id % 11)::VARCHAR AS n FROM boxes) SELECT k.document_id, chunk_id, o.object_id FROM k JOIN boxes o ON o.document_id = k.document_id AND o.object_type = ty AND o.number = n")
def _(s, d):
    b, k = i.boxes(s, d), F.col("object_id")
    text = F.concat(F.lit("see "), F.when(k % 2 == 0, "Table ").otherwise("图"), (k % 11).cast("string"), F.lit(" above"))
    return lay.explicit_links(b.select("document_id", k.alias("chunk_id"), text.alias("text")), b).select("document_id", "chunk_id", "object_id")


_G13 = """prox AS (SELECT r.document_id, r.object_id AS chunk_id, o.object_id FROM boxes r JOIN boxes o ON r.document_id = o.document_id AND r.page = o.page WHERE greatest(0, r.top - o.bottom, o.top - r.bottom) <= 120 AND greatest(0, least(r.x1, o.x1) - greatest(r.x0, o.x0)) / greatest(1e-9, least(r.x1 - r.x0, o.x1 - o.x0)) >= 0.3)"""


def _proximity(s, d):
    b = i.boxes(s, d)
    return lay.proximity_links(b.withColumnRenamed("object_id", "chunk_id"), b)


@query("G13_proximity", f"WITH {B}, {_G13} SELECT * FROM prox")
def _(s, d):
    return _proximity(s, d).select("document_id", "chunk_id", "object_id")


_G14 = f"""{_G13}, links AS (SELECT *, 0.65::DOUBLE AS confidence, 'layout_proximity' AS reason FROM prox UNION ALL SELECT document_id, chunk_id, object_id, 0.95, 'explicit_reference' FROM prox WHERE object_id % 2 = 0),
m AS (SELECT document_id, chunk_id, object_id, string_agg(reason, ',' ORDER BY reason) AS reasons, max(confidence) AS confidence FROM links GROUP BY ALL), mm AS (SELECT *, row_number() OVER (PARTITION BY document_id, chunk_id ORDER BY confidence DESC, object_id) AS k FROM m)"""


def _merged(s, d):
    p = _proximity(s, d)
    both = p.unionByName(p.where("object_id % 2 = 0").withColumn("confidence", F.lit(0.95)).withColumn("reason", F.lit("explicit_reference")))
    return lay.merge_links(both)


@query("G14_merge_links", f"WITH {B}, {_G14} SELECT document_id, chunk_id, object_id, reasons, confidence FROM mm WHERE k <= 3")
def _(s, d):
    return _merged(s, d).withColumn("reasons", F.array_join("reasons", ","))


@query("G16_best_chunk", f"WITH {B}, {_G14} SELECT document_id, object_id, arg_min(chunk_id, (-confidence, chunk_id)) AS chunk_id, max(confidence) AS confidence FROM mm WHERE k <= 3 GROUP BY ALL")
def _(s, d):
    return lay.best_chunk(_merged(s, d))


# ---- metrics
_ROWS = "rw AS (SELECT document_id, chunk_id, label, count(*) FILTER (vote <> 0) AS a, count(*) FILTER (vote > 0) AS p, count(*) FILTER (vote < 0) AS n FROM votes GROUP BY ALL)"


@query("M1_lf_summary", f"WITH {V}, {_ROWS} SELECT lf, round(count(*) FILTER (vote <> 0) / (SELECT count(*) FROM rw), 6) AS coverage, round(count(*) FILTER (vote > 0) / (SELECT count(*) FROM rw), 6) AS positive_rate, round(count(*) FILTER (vote <> 0 AND a > 1) / (SELECT count(*) FROM rw), 6) AS overlap_rate, round(count(*) FILTER ((vote > 0 AND n > 0) OR (vote < 0 AND p > 0)) / (SELECT count(*) FROM rw), 6) AS conflict_rate, round(avg(confidence) FILTER (vote > 0), 6) AS mean_confidence, round(avg(count) FILTER (vote > 0), 6) AS mean_count FROM votes JOIN rw USING (document_id, chunk_id, label) GROUP BY lf")
def _(s, d):
    x = met.lf_summary(i.votes(s, d))
    return x.select("lf", *[r6(F.col(k)).alias(k) for k in x.columns if k != "lf"])


@query("M3_label_summary", f"WITH {V}, {_A5} SELECT label, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'weak') AS weak, count(*) FILTER (status = 'rejected') AS rejected, round(count(*) FILTER (status = 'accepted') / count(*), 6) AS accepted_rate, round(avg(confidence) FILTER (status = 'accepted'), 6) AS mean_confidence FROM dec GROUP BY label")
def _(s, d):
    return met.label_summary(decisions(s, d)).select("label", "accepted", "weak", "rejected", r6(F.col("accepted_rate")).alias("accepted_rate"), r6(F.col("mean_confidence")).alias("mean_confidence"))


_M4 = "m4 AS (SELECT document_id, count(DISTINCT chunk_id) AS chunks, count(*) AS rows, count(*) FILTER (status = 'accepted') AS accepted, count(DISTINCT label) FILTER (status = 'accepted') AS label_types FROM dec GROUP BY 1)"


@query("M4_document_summary", f"WITH {V}, {_A5}, {_M4} SELECT document_id, chunks, rows, accepted, label_types, round(accepted / rows, 6) AS accepted_rate FROM m4")
def _(s, d):
    dec = decisions(s, d)
    return met.document_summary(dec.select("document_id").distinct(), dec).select("document_id", "chunks", "rows", "accepted", "label_types", r6(F.col("accepted_rate")).alias("accepted_rate"))


@query("M5_heat_map", f"WITH {V} SELECT lf, {', '.join(f'round(avg((vote > 0)::INT) FILTER (label = {chr(39)}{x}{chr(39)}), 6) AS {x}' for x in c.LABELS)} FROM votes GROUP BY lf")
def _(s, d):
    return met.heat_map(i.votes(s, d), c.LABELS).select("lf", *[r6(F.col(x)).alias(x) for x in c.LABELS])


@query("M6_top_documents", f"WITH {V}, {_A5}, {_M4} SELECT document_id, accepted, 'D' || lpad((row_number() OVER (ORDER BY accepted DESC, document_id))::VARCHAR, 2, '0') AS code FROM m4 ORDER BY accepted DESC, document_id LIMIT 12")
def _(s, d):
    dec = decisions(s, d)
    return met.top_documents(met.document_summary(dec.select("document_id").distinct(), dec)).select("document_id", "accepted", "code")


@query("M7_global", f"WITH {V}, {_A5} SELECT count(DISTINCT (document_id, chunk_id)) AS chunks, round(count(*) FILTER (status = 'accepted') / count(*), 6) AS accepted_rate FROM dec")
def _(s, d):
    return met.global_metrics(decisions(s, d)).withColumn("accepted_rate", r6(F.col("accepted_rate")))


@query("M8_entity_lfs", f"WITH {EV}, pt AS (SELECT entity_id, label, count(*) FILTER (vote <> 0) AS a, count(*) FILTER (vote > 0) AS p, count(*) FILTER (vote < 0) AS n FROM evotes GROUP BY ALL) SELECT lf, round(count(*) FILTER (vote <> 0) / count(*), 4) AS coverage, (SELECT count(*) FILTER (a >= 2) FROM pt) AS overlap_points, (SELECT count(*) FILTER (p > 0 AND n > 0) FROM pt) AS conflict_points FROM evotes GROUP BY lf")
def _(s, d):
    return met.entity_lf_analysis(i.entity_votes(s, d))


@query("M9_lengths", f"WITH {C} SELECT document_id, min(length(text))::INT AS min, max(length(text))::INT AS max, round(avg(length(text)), 6) AS avg, quantile_disc(length(text), 0.5)::INT AS p50, quantile_disc(length(text), 0.9)::INT AS p90 FROM chunks GROUP BY document_id")
def _(s, d):
    return met.length_stats(i.chunks(s, d)).withColumn("avg", r6(F.col("avg")))


@query("M10_headings", f"WITH {C}, h AS (SELECT document_id, chunk_index % 3 <> 0 AS hit, chunk_index % 3 = 2 AS deep FROM chunks) SELECT document_id, count(*) AS n, round(count(*) FILTER (hit) / count(*), 4) AS heading_hit_rate, round(count(*) FILTER (deep) / count(*), 4) AS hierarchical_hit_rate FROM h GROUP BY document_id")
def _(s, d):
    k = F.col("chunk_index") % 3
    x = i.chunks(s, d).select("document_id", F.when(k == 0, "正文").otherwise("T").alias("title"), F.when(k == 2, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a"))).alias("path"))
    return met.heading_report(x, ("正文",)).select("document_id", "n", "heading_hit_rate", "hierarchical_hit_rate")


@query("M11_batch_headings", f"WITH {C}, h AS (SELECT document_id, count(*) FILTER (chunk_index % 3 <> 0) / count(*) AS r FROM chunks GROUP BY 1) SELECT round(avg(round(r, 4)), 6) AS mean_rate, count(*) AS documents FROM h")
def _(s, d):
    return QUERIES["M10_headings"](s, d).agg(r6(F.avg("heading_hit_rate")).alias("mean_rate"), F.count("*").alias("documents"))


@query("M12_run_summary", f"WITH {V}, {_A5} SELECT label, count(DISTINCT (document_id, chunk_id)) FILTER (present) AS chunks, count(*) FILTER (present) AS present FROM dec GROUP BY label")
def _(s, d):
    return met.run_summary(decisions(s, d))


# ---- orchestration and helpers
@query("O2_resume", "SELECT doc_id AS document_id FROM documents WHERE doc_id % 3 <> 0")
def _(s, d):
    x = i.docs(s, d).select("document_id")
    return x.join(x.where("document_id % 3 = 0"), "document_id", "left_anti")


@query("O3_unique_stems", "WITH x AS (SELECT doc_id AS document_id, source AS stem, '/' || doc_id || '/' || source || '.pdf' AS path, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) SELECT document_id, CASE WHEN k = 1 THEN stem ELSE stem || '.' || sha1(path)[1:8] END AS stem FROM x")
def _(s, d):
    x = i.table(s, d, "documents", "doc_id", "source")
    paths = x.select(F.col("doc_id").alias("ord"), F.concat(F.lit("/"), "doc_id", F.lit("/"), "source", F.lit(".pdf")).alias("path"))
    return io.unique_stems(paths).select(F.col("ord").alias("document_id"), "stem")


@query("H7_batches", None)
def _(s, d):
    return ent.batches(i.chunks(s, d).select("document_id", F.col("chunk_index").alias("ord"), "text"), 20, 2500)


@query("H17_first_images", f"WITH {B}, x AS (SELECT *, row_number() OVER (PARTITION BY document_id, page ORDER BY object_id) AS k FROM boxes) SELECT document_id, page, object_id FROM x WHERE k <= 2")
def _(s, d):
    w = Window.partitionBy("document_id", "page").orderBy("object_id")
    return i.boxes(s, d).withColumn("k", F.row_number().over(w)).where("k <= 2").select("document_id", "page", "object_id")


from silkgrain.plans import guidelines  # noqa: E402,F401  registers its queries
from silkgrain.plans import layers  # noqa: E402,F401  so do these
