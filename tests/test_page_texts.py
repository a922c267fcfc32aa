"""Translations, recognised blocks, regex spans and stems against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.operators import labeling, page_texts
from silkgrain.sources import io

ENGLISH = "This is a paragraph of English text that is long enough to be one of those that are translated here."


def test_translations(spark):
    pages = spark.createDataFrame([("d", 1, f"中文\n\n{ENGLISH}\n\n{ENGLISH} two"), ("d", 2, "只有中文"), ("d", 3, ENGLISH), ("d", 4, None)], "document_id string, page int, text string")
    asked = [(r["page"], r["n"]) for r in page_texts.english_paragraphs(pages).orderBy("page", "n").collect()]
    assert asked == [(1, 1), (1, 2), (3, 0)]
    answers = spark.createDataFrame([("d", 1, 1, "ok", "译文"), ("d", 1, 2, "error", "x"), ("d", 3, 0, "ok", ""), ("d", 1, 0, "ok", "never")], "document_id string, page int, n int, status string, text string")
    got = {r["page"]: r for r in page_texts.with_translations(pages, answers).collect()}
    assert got[1]["text"] == f"中文\n\n译文\n\n{ENGLISH} two" and got[1]["translated"] and got[1]["pending"]
    assert got[2]["text"] == "只有中文" and not got[2]["translated"] and not got[2]["pending"] and got[3]["pending"] and not got[3]["translated"] and got[4]["text"] is None


def plain_blocks(lines):
    out = []
    for k, line in enumerate(lines):
        m = re.search(c.OCR_BLOCK, line)
        if not m:
            continue
        block = re.split(r"\s{3,}", line[m.start() :].strip(), maxsplit=1)[0]
        block = next((h for h in c.OCR_HEADINGS if h.replace(" ", "") in re.sub(r"\s+", "", block)), block)
        if re.match(c.OCR_ADVICE, block):
            for following in lines[k + 1 : k + 4]:
                if re.search(c.OCR_BLOCK, following) and not re.search(c.OCR_STRENGTH_MARK, following):
                    break
                block += following.rsplit("”", 1)[-1].strip()
                if any(x in following for x in ("推荐强度", "强)", "强）")):
                    break
            if m := re.search(c.OCR_STRENGTH, block):
                block = block[: m.end()]
        out.append(block)
    return out


def test_blocks(spark):
    rng, rows, plain = random.Random(2), [], {}
    kinds = ("推荐 1：应尽早治疗", "推荐2: bad ab 治疗", "1 急性胰腺炎的诊断", "证据”等级高，推荐强度：强）后文", "正文一段", "推荐1：应", "后续(强)", "21 急性胰腺炎", "3急性胰腺炎病人")
    for page in range(30):
        lines = [rng.choice(kinds) for _ in range(rng.randrange(8))]
        plain[page] = plain_blocks(lines)
        rows += [("d", page, k, f" {x} ") for k, x in enumerate(lines)] + [("d", page, 100, "www.CNKI.net 推荐 9：x")]
    got = {}
    df = spark.createDataFrame(rows, "document_id string, page int, ord int, line string")
    for r in page_texts.ocr_blocks(df).orderBy("page", "ord").collect():
        got.setdefault(r["page"], []).append(r["block"])
    assert {k: v for k, v in plain.items() if v} == got
    best = {}
    for r in page_texts.best_blocks(page_texts.ocr_blocks(df)).orderBy("page", "rank").collect():
        best.setdefault(r["page"], []).append(r["block"])
    quality = lambda b: len(re.findall("[一-鿿]", b)) - 3 * len(re.findall(c.OCR_NOISE, b))
    for page, blocks in plain.items():
        others, advice = [], {}
        for b in blocks:
            if m := re.match(c.OCR_ADVICE, b):
                if m[1] not in advice or quality(b) > quality(advice[m[1]]):
                    advice[m[1]] = b
            else:
                others.append(b)
        want = list({re.sub(r"\s+", "", b): b for b in reversed([*others, *advice.values()])}.values())[::-1]
        assert best.get(page, []) == want


def test_blocks_put_in(spark):
    rows = [("d", 1, "前文\n1.4 急性胰腺炎的影像学检查\n后文"), ("d", 2, "推荐2：已有的推荐意见在此，推荐强度：强"), ("d", 3, "正文"), ("d", 4, None)]
    pages = spark.createDataFrame(rows, "document_id string, page int, text string")
    blocks = spark.createDataFrame([("d", 1, 1, None, "1 急性胰腺炎的诊断"), ("d", 1, 2, "1", "推荐 1 : 尽早 (证据等级:高;推荐强度:强)"), ("d", 2, 1, "2", "推荐2：已有的推荐意见在此"), ("d", 3, 1, None, "3 急性胰腺炎病人随访"), ("d", 3, 2, "5", "推荐5：补充"), ("d", 4, 1, "1", "推荐1：有")],
                                   "document_id string, page int, rank int, number string, block string")
    got = {r["page"]: r["text"] for r in page_texts.with_blocks(pages, blocks).collect()}
    assert got[1] == "前文\n推荐1：尽早（证据等级：高；推荐强度：强）\n\n1.4 急性胰腺炎的影像学检查\n后文"
    assert got[2] == rows[1][2] and got[3] == "正文\n\n推荐5：补充\n\n3 急性胰腺炎病人随访" and got[4] == "推荐1：有"


def test_regex_spans(spark):
    texts = ["CRP 12, crp 7", "", None, "é𝄞12 x3y45", "none"]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    for pattern, most in ((r"\d+", 8), ("crp", 8), (r"\d", 2), (r"(a|x)?\d", 8), ("(", 8)):
        got = [[tuple(s) for s in r[0]] for r in df.select(labeling.regex_spans(F.col("t"), pattern, most)).collect()]
        try:
            want = [[(m.start(), m.end(), m[0]) for m in re.finditer(pattern, x or "", re.I)][:most] for x in texts]
        except re.error:
            want = [[]] * len(texts)
        assert got == want


def test_stems(spark):
    sha = lambda x: hashlib.sha1(x.encode()).hexdigest()
    paths = ["/a/x.pdf", "/b/x.pdf", "/b/y.tar.gz", "/c/ .pdf", "/c/x.PDF", "z"]
    got = {r["path"]: r["stem"] for r in io.unique_stems(spark.createDataFrame([(p, k) for k, p in enumerate(paths)], "path string, ord int")).collect()}
    assert got == {"/a/x.pdf": "x", "/b/x.pdf": "x." + sha("/b/x.pdf")[:8], "/b/y.tar.gz": "y.tar", "/c/ .pdf": sha("/c/ .pdf")[:12], "/c/x.PDF": "x." + sha("/c/x.PDF")[:8], "z": "z"}
