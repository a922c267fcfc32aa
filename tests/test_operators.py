"""Worked cases of the engine's operators."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions import text as t
from silkgrain.operators import entities, fusion, layout, metrics, quality, relations, segment
from silkgrain.plans import pipeline
from silkgrain.sources import io

VOTE = "document_id int, chunk_id string, label string, lf string, vote int, confidence double, count int, evidence array<string>, ord int"


def value(spark, column, **given):
    rows = spark.createDataFrame([tuple(given.values()) or (1,)], list(given) or ["x"])
    return rows.select(column.alias("v")).first()["v"]


def votes(spark, *rows):
    return spark.createDataFrame([(1, "CH0001", "symptoms", lf, v, k, n, e, 0) for lf, v, k, n, e in rows], VOTE)


def test_normalize_whitespace(spark):
    assert value(spark, t.normalize_whitespace(F.col("x")), x="  a \t b​\n\n\n\nc 患 者 ") == "a b\n\nc 患者"
    assert value(spark, t.normalize_whitespace(F.lit(None).cast("string"))) == ""


def test_noise_lines_and_tail(spark):
    assert value(spark, t.remove_noise_lines(F.col("x")), x="text\n· 12 ·\n\nDOI: 10.1234/abc\nmore") == "text\nmore"
    assert value(spark, t.remove_tail(F.col("x")), x="body\n参考文献\n[1] a") == "body"


def test_core_disease_and_json(spark):
    assert value(spark, t.core_disease_name(F.col("x")), x="《中国急性胰腺炎诊治指南（2021）》") == "急性胰腺炎"
    assert value(spark, t.json_object(F.col("x")), x='see ```json\n{"a": 1}\n``` end') == '{"a": 1}'
    assert value(spark, t.json_object(F.col("x")), x="[1, 2]") is None


def test_quality_gate(spark):
    d = spark.createDataFrame([(1, "¤§¶▓▒▣★◆" * 20), (2, "Readable English text of some length. " * 4), (3, None)], "document_id int, text string")
    got = {r["document_id"]: r for r in quality.text_quality(d).collect()}
    assert got[1]["skip"] and "high_symbol_or_control_ratio" in got[1]["reasons"]
    assert not got[2]["skip"]
    assert got[3]["skip"] and got[3]["reasons"][0] == "too_little_extracted_text"


@pytest.mark.parametrize(("title", "level"), [("一、 临床表现", 1), ("（二）检查", 2), ("1）分型", 3), ("1.1 诊断路径", 2), ("发生率95%以上", None), ("References", 1), ("plain", None), ("【诊断】", 1)])
def test_heading_level(spark, title, level):
    assert value(spark, segment.heading_level(F.col("x")), x=title) == level


def test_sections_follow_the_stack(spark):
    a = spark.createDataFrame([(1, 0, "A", 1, 30), (1, 10, "B", 4, 30), (1, 20, "C", 3, 30)], "document_id int, start int, title string, level int, n_chars int")
    got = [(r["start"], r["end"], r["path"]) for r in segment.sections(a).orderBy("start").collect()]
    assert got == [(0, 10, ["正文", "A"]), (10, 20, ["正文", "A", "B"]), (20, 30, ["正文", "A", "B", "C"])]


def test_packing_against_a_fold(spark):
    rng = np.random.default_rng(3)
    docs = [(k, "\n".join("x" * int(n) for n in rng.integers(1, 90, 25))) for k in range(12)]
    pieces = F.transform(F.split("text", "\n"), lambda x, i: F.struct(F.array(F.lit("r")).alias("path"), x.alias("text"), i.cast("int").alias("start"), (i + 1).cast("int").alias("end")))
    got = {r["document_id"]: [x["text"] for x in r["p"]] for r in spark.createDataFrame(docs, "document_id int, text string").select("document_id", segment.pack(pieces, 40, 120).alias("p")).collect()}
    for k, text in docs:
        want: list[str] = []
        for piece in text.split("\n"):
            if not want or (len(want[-1]) + 2 + len(piece) > 120 and len(want[-1]) >= 40):
                want.append(piece)
            else:
                want[-1] += "\n\n" + piece
        assert got[k] == want


def test_merge_small_moves_siblings_to_the_parent(spark):
    s = [(["r", "p", "a"], "aa", 0, 2), (["r", "p", "b"], "bb", 2, 4), (["r", "q"], "c" * 50, 4, 54)]
    d = spark.createDataFrame([(1, s)], "id int, s array<struct<path:array<string>,text:string,start:int,end:int>>")
    got = d.select(F.inline(segment.merge_small(F.col("s"), 20, 100))).collect()
    assert [(r["path"], r["text"]) for r in got] == [(["r", "p"], "aa\n\nbb"), (["r", "q"], "c" * 50)]


def test_page_lookup(spark):
    p = spark.createDataFrame([(1, 1, "abc"), (1, 2, "defg")], "document_id int, page_number int, text string")
    row = segment.full_text(p).select("full_text", "pages", segment.page_of(F.col("pages"), F.lit(6)).alias("at")).first()
    assert row["full_text"] == "abc\n\ndefg" and [x["start"] for x in row["pages"]] == [0, 5]
    assert (row["at"]["page"], row["at"]["offset"]) == (2, 1)


def test_weighted_vote_vectors(spark):
    support = votes(spark, ("medical_pattern", 1, 0.8, 2, ["口干"]), ("dictionary", 1, 0.7, 1, []), ("section_prior", 0, 0.0, 0, []))
    r = fusion.weighted_vote(support).first()
    assert r["vote_score"] == pytest.approx(0.636) and r["confidence"] == pytest.approx(0.842904, abs=1e-5)
    assert (r["status"], r["count"], r["supporting_lfs"]) == ("accepted", 2, ["medical_pattern", "dictionary"])
    weak = votes(spark, ("regex_indicator", 1, 0.64, 1, []), ("medical_pattern", 0, 0.0, 0, []), ("prompted_llm", 0, 0.0, 0, []), ("dictionary", 0, 0.0, 0, []), ("section_prior", 0, 0.0, 0, []))
    r = fusion.weighted_vote(weak, thresholds={"symptoms": 0.08}).first()
    assert r["vote_score"] == pytest.approx(0.0914286, abs=1e-6) and (r["present"], r["status"]) == (True, "weak")
    low = votes(spark, ("section_prior", 1, 0.45, 1, []), ("medical_pattern", 0, 0.0, 0, []), ("dictionary", 0, 0.0, 0, []), ("prompted_llm", 0, 0.0, 0, []))
    r = fusion.weighted_vote(low).first()
    assert r["status"] == "rejected" and r["confidence"] == pytest.approx(0.2227, abs=1e-4)


def test_count_fusion_vector(spark):
    v = votes(spark, ("medical_pattern", 1, 0.8, 2, ["口干", "眼干"]), ("dictionary", 1, 0.7, 1, ["口干"]), ("prompted_llm", 1, 0.9, 5, []))
    d = spark.createDataFrame([(1, "CH0001", "symptoms", True, 0.8)], "document_id int, chunk_id string, label string, present boolean, confidence double")
    r = fusion.count_fusion(v, d).first()
    assert r["weighted_count"] == pytest.approx(6.53 / 2.33) and (r["predicted_count"], r["evidence_floor"]) == (3, 2) and r["count_confidence"] == pytest.approx(0.8)


def test_label_model_invariants(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(300):
        y = 1 if rng.random() < 0.5 else -1
        for j, lf in enumerate(("a", "b", "c", "d")):
            v = 0 if rng.random() < 0.2 else (y if rng.random() < 0.85 - 0.05 * j else -y)
            rows.append((k, "CH0001", "tests", lf, v, 0.5, 0, [], 0))
    rows += [(1000, "CH0001", "tests", lf, 0, 0.0, 0, [], 0) for lf in "abcd"] + [(1001, "CH0001", "tests", lf, 1, 0.5, 0, [], 0) for lf in "abc"] + [(1001, "CH0001", "tests", "d", 0, 0.5, 0, [], 0)] + [(1002, "CH0001", "tests", lf, 1, 0.5, 0, [], 0) for lf in "abcd"]
    got = {r["document_id"]: r for r in fusion.label_model(spark.createDataFrame(rows, VOTE)).collect()}
    assert got[1000]["probability"] == 0.5 and got[1000]["status"] == "rejected"
    assert got[1002]["probability"] >= got[1001]["probability"] > 0.5


def test_softmax_and_triage(spark):
    v = spark.createDataFrame([("e", "tests", 0, "x", 1, 1.0), ("e", "plans", 1, "x", 0, 0.0), ("f", "tests", 0, "x", 1, 1.0), ("f", "plans", 1, "x", 1, 0.95)], "entity_id string, label string, label_ord int, lf string, vote int, confidence double")
    best = fusion.top_two(fusion.softmax_scores(v)).withColumns({"name": F.lit("n"), "evidence_text": F.lit("e"), "located": F.lit(True)})
    got = {r["entity_id"]: r for r in fusion.triage(best).collect()}
    assert got["e"]["probability"] == pytest.approx(0.731059, abs=1e-6) and got["e"]["status"] == "accepted"
    assert got["f"]["gap"] == pytest.approx(0.024995, abs=1e-6) and got["f"]["status"] == "review" and got["f"]["reasons"] == ["type_conflict_top2_gap", "review_probability_band"]


def test_relation_candidates_and_levels(spark):
    e = spark.createDataFrame([(1, "a", "sub_diseases", "n", "CH2", 2), (1, "b", "tests", "n", "CH4", 4), (1, "z", "tests", "n", "CH9", 9), (2, "q", "tests", "n", "CH2", 2)], "document_id int, entity_id string, entity_type string, name string, chunk_id string, chunk_index int")
    ch = spark.createDataFrame([(1, "CH2", ""), (1, "CH4", "检查")], "document_id int, chunk_id string, text string")
    got = relations.candidates(e, ch, {"requires_test": ("检查",)}).collect()
    assert [(r["relation"], r["end_entity_id"], r["chunk_distance"], r["search_level"]) for r in got] == [("requires_test", "b", 2, "near_chunk_window")]
    assert relations.candidates(e, ch, {"requires_test": ("nothing",)}).count() == 0


def test_links_merge(spark):
    x = spark.createDataFrame([(1, "c", "o", "layout_proximity", 0.65), (1, "c", "o", "explicit_reference", 0.95)], "document_id int, chunk_id string, object_id string, reason string, confidence double")
    r = layout.merge_links(x).collect()
    assert len(r) == 1 and r[0]["reasons"] == ["explicit_reference", "layout_proximity"] and r[0]["confidence"] == 0.95


def test_length_percentiles(spark):
    d = spark.createDataFrame([(1, "x" * n) for n in (1, 2, 3, 4)], "document_id int, text string")
    r = metrics.length_stats(d).first()
    assert (r["p50"], r["p90"]) == (2, 4)


def test_entities_parse_and_dedupe(spark):
    body = '{"tests": [{"name": " CRP ", "evidence": "e", "confidence": 2}, {"name": "CRP", "evidence": "f"}, {"name": "", "evidence": "g"}]}'
    r = spark.createDataFrame([(1, "CH1", "ok", body), (1, "CH2", "disabled", body), (1, "CH3", "ok", "no json")], "document_id int, chunk_id string, status string, text string")
    got = entities.parse_responses(r, c.ENTITY_TYPES).collect()
    assert [(x["chunk_id"], x["name"], x["evidence_text"], x["confidence"]) for x in got] == [("CH1", "CRP", "e", 1.0)]


def test_stages_resume(spark, tmp_path):
    docs = spark.createDataFrame([(k, "\n".join(["the anthion of thing " * 12] * 4)) for k in range(6)], "document_id int, text string")
    log = pipeline.run(spark, docs, str(tmp_path / "out"))
    assert [r["stage"] for r in log.collect()] == ["chunks", "votes", "labels"]
    assert pipeline.pending(spark, docs, str(tmp_path / "out"), "chunks").count() == 0


def test_streaming_adds_nothing_twice(spark, tmp_path):
    from silkgrain.streaming.files import follow

    spark.createDataFrame([(k, "\n".join(["some the text of thing " * 12] * 3)) for k in range(4)], "document_id long, text string").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/labels")).select("document_id").distinct().count() == 4


def test_readers(spark, tmp_path):
    (tmp_path / "a.chunk.json").write_text('{"chunks": [{"chunk_id": "CH0001", "text": "x"}]}')
    (tmp_path / "b.chunk.json").write_text('[{"chunk_id": "CH0001", "text": "y"}]')
    got = io.read_chunk_json(spark, str(tmp_path / "*.json")).orderBy("document_id").collect()
    assert [(r["document_id"], r["text"]) for r in got] == [("a", "x"), ("b", "y")]
    (tmp_path / "v.jsonl").write_text('{"lf": "a", "vote": 1}\n\nnot json\n{"lf": "b", "vote": 0}\n')
    assert io.read_jsonl(spark, str(tmp_path / "v.jsonl"), "lf string, vote int").count() == 2
    answers = io.call_model(spark.createDataFrame([(1, "p"), (2, "")], "prompt_id int, prompt string"), lambda p: str(1 // len(p)))
    assert {r["prompt_id"]: r["status"] for r in answers.collect()} == {1: "ok", 2: "error"}


def plain_sections(text):
    """Headings are lines of hashes; (start, end, path, level)."""
    heads, at = [], 0
    for line in text.split("\n"):
        if m := re.match("(#{1,4}) ", line):
            heads.append((at, len(m[1]), " ".join(line.split())))
        at += len(line) + 1
    if not heads:
        return [(0, len(text), ["正文"], 0)]
    out = [(0, heads[0][0], ["正文", "前言/概述"], 0)] if text[: heads[0][0]].strip() else []
    stack, base = [], min(h[1] for h in heads)
    for k, (start, level, title) in enumerate(heads):
        stack = [*stack[: max(1, level - base + 1) - 1], title]
        out.append((start, heads[k + 1][0] if k + 1 < len(heads) else len(text), ["正文", *stack], level))
    return out


def plain_chunks(text, least, most, merge):
    chunks = []
    for start, end, path, level in plain_sections(text):
        body = text[start:end].strip()
        if not body:
            continue
        if len(body) <= most:
            chunks.append((path, body, start, end))
            continue
        spans, at = [], 0
        for block in body.split("\n\n"):
            if block.strip():
                spans.append((at, at + len(block)))
            at += len(block) + 2
        spans = [(0, len(body))] if level >= 2 else spans
        packed = []
        for a, b in spans:
            piece = body[a:b].strip()
            if packed and not (len(packed[-1][0]) + 2 + len(piece) > most and len(packed[-1][0]) >= least):
                packed[-1] = (packed[-1][0] + "\n\n" + piece, packed[-1][1], b)
            else:
                packed.append((piece, a, b))
        for piece, a, b in packed:
            if len(piece) <= most:
                chunks.append((path, piece, start + a, start + b))
                continue
            rest, off = piece, 0
            while rest:
                cut = next((k for k in range(most, int(most * 0.65), -1) if rest[k - 1] in "。！？；;.!?"), most) if len(rest) > most else len(rest)
                if rest[:cut].strip():
                    chunks.append((path, rest[:cut].strip(), start + a + off, start + a + off + len(rest[:cut].strip())))
                off, rest = off + cut, rest[cut:].lstrip()
    out = []
    for path, body, start, end in chunks:
        if out:
            p, q, s, e = out[-1]
            short = (len(q) < merge or len(body) < merge) and len(q) + len(body) + 2 <= most
            sibling = len(p) == len(path) and p[:-1] == path[:-1] and len(p) >= 3
            if short and (p == path or sibling or (len(p) < len(path) and path[: len(p)] == p and len(p) >= 2)):
                out[-1] = (p[:-1] if p != path and sibling else p, q + "\n\n" + body, s, end)
                continue
        out.append((path, body, start, end))
    return out


def test_chunks_against_a_plain_version(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcd"), rng.integers(1, 8)))

    def paragraph():
        return " ".join(word() + str(rng.choice(["", "", "", ".", "；"])) for _ in range(rng.integers(1, 70)))

    def document(k):
        out = []
        for _ in range(rng.integers(1, 14)):
            if rng.random() < 0.45 and k % 5:
                out.append("#" * int(rng.integers(1, 5)) + " " + word())
            out.append(paragraph())
        return "\n\n".join(out) if k % 2 else "\n".join(out)

    docs = [(k, document(k)) for k in range(60)] + [(100, ""), (101, None), (102, "# only"), (103, "x" * 900)]
    level = F.when(F.rlike("line", F.lit("^#{1,4} ")), F.length(F.regexp_extract("line", "^(#+)", 1)))
    df = spark.createDataFrame(docs, "document_id int, text string")
    for least, most, merge in ((80, 300, 80), (20, 120, 200)):
        got = segment.build_chunks(df, least, most, merge, None, level).collect()
        for k, text in docs:
            rows = [(r["path"], r["text"], r["start"], r["end"]) for r in sorted(got, key=lambda r: r["chunk_index"]) if r["document_id"] == k]
            assert rows == plain_chunks(text or "", least, most, merge), k


def test_subsections_and_pages(spark):
    df = spark.createDataFrame([(1, 0, 10, ["正文", "a"], 2, "# a\nbody"), (1, 10, 20, ["正文", "b"], 1, "b")], "document_id int, start int, end int, path array<string>, level int, text string")
    assert [tuple(r) for r in segment.subsections(df).collect()] == [(1, 0, 0, 8)]
    pages = spark.createDataFrame([(1, 1, "诊断\nfirst page"), (1, 2, "治疗\nsecond")], "document_id int, page_number int, text string")
    full = segment.full_text(pages)
    assert [(r["title"], r["page"], r["level"]) for r in segment.rule_candidates(full).orderBy("start").collect()] == [("诊断", 1, 1), ("治疗", 2, 1)]
    made = segment.with_pages(segment.build_chunks(full.select("document_id", F.col("full_text").alias("text")), min_ratio=None), full).orderBy("start").collect()
    assert [(r["page_start"], r["page_end"]) for r in made] == [(1, 1), (2, 2)]


def test_page_breaks(spark):
    pages = "array<struct<page:int,text:string>>"
    df = spark.createDataFrame([([(2, " b "), (1, "a")],), ([(1, "one")],), ([],)], f"p {pages}")
    marked = df.select("p", t.join_pages(F.col("p")).alias("m"))
    got = marked.select("m", t.split_pages(F.col("m"), F.transform("p", lambda x: x["page"])).alias("s")).collect()
    assert got[0]["m"] == "a\n<<<PAGE_BREAK:2>>>\n b " and [tuple(x) for x in got[0]["s"]] == [(1, "a"), (2, "b")]
    assert [tuple(x) for x in got[1]["s"]] == [(1, "one")] and got[2]["s"] == []
    assert value(spark, t.split_pages(F.col("x"), F.array(F.lit(1), F.lit(2))), x="no break") is None


def test_small_text_functions(spark):
    assert value(spark, t.json_object_strict(F.col("x")), x='```json\n{"a": 1}\n```') == '{"a": 1}'
    assert value(spark, t.json_object_strict(F.col("x")), x='so {"a": 1}') is None and value(spark, t.json_object_strict(F.col("x")), x="[1]") is None
    assert [value(spark, t.coerce_bool(F.col("x"), True), x=v) for v in (" Yes", "off", "2", "0.0", "what", "")] == [True, False, True, False, True, True]
    assert value(spark, t.core_anchors(F.col("x")), x="急性胰腺炎") == ["急性胰腺炎", "胰腺炎", "胰腺"]
    child = lambda name: value(spark, t.is_child_name(F.col("x"), F.lit("急性胰腺炎")), x=name)
    assert [child("重症胰腺炎"), child("急性胰腺炎"), child("肺炎"), child("")] == [True, False, False, True]
    blocks = F.array(F.struct(F.lit("图1").alias("caption"), F.lit(" x ").alias("text")), F.struct(F.lit("").alias("caption"), F.lit("y").alias("text")), F.struct(F.lit("c").alias("caption"), F.lit(" ").alias("text")))
    assert value(spark, t.append_blocks(F.col("x"), blocks), x="page \n") == "page\n\n图1\n[FIGURE_CONTENT]\nx\n[/FIGURE_CONTENT]\n\n图\n[FIGURE_CONTENT]\ny\n[/FIGURE_CONTENT]"
    assert value(spark, t.contract_issue(F.col("x"), F.lit(10), 20), x="x" * 21) == "too_long" and value(spark, t.contract_issue(F.col("x"), F.lit(10), 90), x="cleaned_text") == "echoed_text"
    assert value(spark, t.extra_keys(F.col("x")), x='{"noise_spans": [], "b": 1, "a": 2}') == ["a", "b"]
    assert value(spark, t.shorten(F.col("x"), 5), x="ab\n cdefg") == "ab cd..."


@pytest.mark.parametrize(("line", "ocr", "status", "text"), [
    ("菌落 >10 cfu/ml 有意义", [">10⁵cfu/ml"], "corrected", "菌落 >10^5cfu/ml 有意义"),
    ("女性>10cfu/ml，男性 ≥ 10 c f u／ml", ["女性>10⁵cfu/ml 男性>10⁴cfu/ml"], "corrected", "女性>10^5cfu/ml，男性 ≥10^4cfu／ml"),
    ("女性>10cfu/ml，男性>10cfu/ml", ["女性>10⁵cfu/ml"], "unresolved", "女性>10cfu/ml，男性>10cfu/ml"),
    (">10cfu/ml 和 >10cfu/ml", ["10^3cfu/ml"], "unresolved", ">10cfu/ml 和 >10cfu/ml"),
    ("no unit here", ["10^3cfu/ml"], "none", "no unit here"),
])
def test_unit_exponents(spark, line, ocr, status, text):
    got = value(spark, t.recover_exponents(F.col("x"), F.array(*map(F.lit, ocr))), x=line)
    assert (got["status"], got["text"]) == (status, text)


def test_resume_after_each_stage(spark, tmp_path):
    docs = spark.createDataFrame([(k, "\n".join(["患者发热，诊断为急性胰腺炎，治疗方案给予药物治疗。" * 6] * 3) if k != 5 else "") for k in range(6)], "document_id int, text string")

    def broken(spark, given):
        raise RuntimeError("stop")

    whole = str(tmp_path / "whole")
    pipeline.run(spark, docs, whole)
    want = {n: pipeline.stored(spark, whole, n).count() for n, _ in pipeline.STAGES}
    assert all(want.values())
    for stop in range(3):
        out = str(tmp_path / f"stop{stop}")
        stages = tuple((n, broken if k == stop else f) for k, (n, f) in enumerate(pipeline.STAGES))
        with pytest.raises(RuntimeError):
            pipeline.run(spark, docs, out, stages)
        pipeline.run(spark, docs, out)
        assert {n: pipeline.stored(spark, out, n).count() for n, _ in pipeline.STAGES} == want
        log = pipeline.run(spark, docs, out).collect()  # the document without chunks doesn't stay pending
        assert {r["status"] for r in log} == {"nothing to do"}


def test_lexicon_votes(spark):
    text = "诊断为急性胰腺炎，分型明确。患者发热、腹痛，CRP升高，治疗方案：口服药物治疗，每3周随访。"
    df = spark.createDataFrame([(1, "CH0001", text, "临床表现 / 症状"), (1, "CH0002", "nothing", "正文")], "document_id int, chunk_id string, text string, section string")
    from silkgrain.operators import labeling

    got = {(r["chunk_id"], r["lf"], r["label"]): r for r in labeling.apply_rules(df).collect()}
    assert len(got) == 2 * 3 * 5
    d = got["CH0001", "dictionary", "symptoms"]
    assert d["vote"] == 1 and d["evidence"] == ["发热", "腹痛"] and d["confidence"] == pytest.approx(0.74)
    assert got["CH0001", "medical_pattern", "plans"]["confidence"] == 0.76 and got["CH0001", "section_prior", "symptoms"]["confidence"] == 0.45
    assert all(r["vote"] == 0 for k, r in got.items() if k[0] == "CH0002")
    e = spark.createDataFrame([(1, 1, "甲泼尼龙每日口服", "疗程", text), (1, 2, "发热", None, None)], "document_id int, entity_id int, name string, evidence_text string, chunk_text string")
    ent = {(r["entity_id"], r["lf"], r["label"]): (r["vote"], r["confidence"]) for r in labeling.apply_entity_rules(e).collect()}
    assert ent[1, "surface", "plans"][0] == 1 and ent[1, "surface", "plans"][1] >= 0.86 and ent[2, "surface", "symptoms"] == (1, pytest.approx(0.6))
    assert ent[1, "surface", "symptoms"] == (-1, 0.62)


def test_table_and_figure_objects(spark):
    box = "document_id int, page int, object_id int, line string, x0 double, top double, x1 double, bottom double"
    lines = spark.createDataFrame([(1, 1, 1, "表 2 结果", 10., 80., 90., 95.), (1, 1, 2, "Table 1 far", 10., 0., 90., 5.), (1, 1, 3, "注：说明", 10., 210., 90., 220.), (1, 1, 4, "Figure 3 x", 10., 300., 90., 310.), (1, 1, 5, "text", 0., 0., 1., 1.)], box)
    bodies = spark.createDataFrame([(1, 1, 50, "", 0., 100., 100., 200.), (1, 2, 51, "", 0., 100., 100., 200.)], box).drop("line")
    got = {r["object_id"]: r for r in layout.table_objects(bodies, lines).collect()}
    assert got[50]["table_number"] == "2" and got[50]["note"]["line"] == "注：说明" and (got[50]["all_top"], got[50]["all_bottom"]) == (80.0, 220.0)
    assert got[51]["caption"] is None and got[51]["all_top"] == 100.0
    images = spark.createDataFrame([(1, 1, 60, "", 0., 320., 100., 420.), (1, 1, 61, "", 0., 320., 50., 420.)], box).drop("line")
    assert [(r["object_id"], r["caption"]["number"]) for r in layout.figure_objects(images, lines).collect()] == [(60, "3")]


def test_batches_against_a_fold(spark):
    rng = np.random.default_rng(6)
    items = [(d, k, "x" * int(rng.integers(0, 60))) for d in range(5) for k in range(30)]
    got = {(r["document_id"], r["ord"]): r["batch"] for r in entities.batches(spark.createDataFrame(items, "document_id int, ord int, text string"), 4, 100).collect()}
    for d in range(5):
        batch, n, chars = 0, 0, 0
        for _, k, x in [i for i in items if i[0] == d]:
            if n >= 4 or (n and chars + len(x) > 100):
                batch, n, chars = batch + 1, 0, 0
            n, chars = n + 1, chars + len(x)
            assert got[d, k] == batch


def test_multiclass_model_follows_the_better_lf(spark):
    rng = np.random.default_rng(7)
    labels, rows = ("tests", "plans", "symptoms"), []
    truth = [labels[int(x)] for x in rng.integers(0, 3, 300)]
    for k, y in enumerate(truth):
        for lf, right in (("a", 0.95), ("b", 0.9), ("c", 0.4)):
            said = y if rng.random() < right else str(rng.choice([x for x in labels if x != y]))
            rows.append((1, k, lf, said, 1, 0.9))
            rows.append((1, k, lf, "none", 0, 0.99))
    votes_ = fusion.multiclass_votes(spark.createDataFrame(rows, "document_id int, entity_id int, lf string, label string, vote int, confidence double"))
    got = {r["entity_id"]: r for r in fusion.multiclass_model(votes_, labels).collect()}
    assert np.mean([got[k]["label"] == y for k, y in enumerate(truth)]) > 0.93 and all(1 / 3 <= r["probability"] <= 1 for r in got.values())
    assert fusion.multiclass_model(votes_.limit(0), labels).count() == 0


def test_prompts_and_reports(spark):
    chunks = spark.createDataFrame([(1, "CH0001", "text one"), (1, "CH0002", "text two")], "document_id int, chunk_id string, text string")
    modes = spark.createDataFrame([(1, "CH0001", "tests", "extract"), (1, "CH0001", "plans", "check_only"), (1, "CH0002", "tests", "check_only")], "document_id int, chunk_id string, label string, mode string")
    got = entities.prompts(chunks, modes, {"tests": ("method", "value")}).collect()
    assert [r["chunk_id"] for r in got] == ["CH0001"] and "properties: method, value" in got[0]["prompt"] and got[0]["prompt"].endswith("text one") and '{"plans": [], "tests": []}' in got[0]["prompt"]
    cands = spark.createDataFrame([("c1", 1, "causes", "A", "B"), ("c2", 1, "causes", "C", "B"), ("c3", 1, "causes", "D", "B")], "candidate_id string, document_id int, relation string, start_name string, end_name string")
    ctx = spark.createDataFrame([(k, "same_chunk", f"ctx {k}") for k in ("c1", "c2", "c3")], "candidate_id string, context_level string, context string")
    assert "A -causes-> B" in relations.audit_prompts(cands, ctx).where("candidate_id = 'c1'").first()["prompt"]
    assert sorted(r["candidate_ids"] for r in relations.batch_audit_prompts(cands, ctx, 2).collect()) == [["c1", "c2"], ["c3"]]
    assert value(spark, relations.chunk_header(F.col("x"), F.array(F.lit("正文"), F.lit("a")), F.lit("a"), F.lit("t")), x="CH0001") == "[CH0001] 正文 > a a\nt"
    assert value(spark, relations.earlier_chunk(F.lit("a"), F.lit("b"), F.lit(None).cast("int"), F.lit(3))) == "b"
    titles = spark.createDataFrame([(1, "急性胰腺炎诊治指南"), (2, "x")], "document_id int, title string")
    assert [(r["name"], r["confidence"]) for r in entities.core_entity(titles).collect()] == [("急性胰腺炎", 0.98)]


def test_restored_tail_and_front_values(spark):
    for tail in ("执笔：张", "考 文 献", "（收稿日期：2020-01-01）", "（本文编辑 李）", "12．参考文献", "（按姓氏汉语拼音排\n序）："):
        assert value(spark, t.remove_tail(F.col("x")), x=f"正文内容\n{tail}\n后面") == "正文内容", tail
    assert value(spark, t.remove_front_matter(F.col("x")), x="关键词 a\n急性胰腺炎指胰腺炎症") == "急性胰腺炎指胰腺炎症"
    row = spark.createDataFrame([("treatments", "treatments", "冲击治疗", "", 0.5, True, "review"), ("treatments", "treatments", "10 MG daily", "", 0.5, False, "review"), ("tests", "tests", "口服", "", 0.5, True, "review")], "final_type string, candidate_type string, name string, evidence_text string, probability double, located boolean, status string")
    assert [(r["final_type"], r["status"], r["overridden"]) for r in fusion.plan_override(row).collect()] == [("plans", "accepted", True), ("plans", "review", True), ("tests", "review", False)]
