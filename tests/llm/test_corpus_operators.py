"""Corpus operators against plain versions, on small tables with nulls, ties and repeats."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from silkgrain.llm import common, mixing, near_copies, ppm, pu_quality, secret_scan, simhash, suffix_dedup, templates, text_density, warc, weak_rules

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def make_docs(seed=1, n=60):
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("abcdeéxyz"), rng.integers(1, 7))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocab, k)).capitalize() + "."
    out = [(i, "\n".join(text(int(rng.integers(3, 60))) for _ in range(int(rng.integers(1, 8))))) for i in range(n)]
    base = out[3][1] + " " + text(120)
    out += [(1000, base), (1001, base), (1002, base.replace(" a", " b", 1)), (1003, "x" + base), (1004, base[50:] + text(40))]
    out += [(1010, None), (1011, ""), (1012, " \n\t "), (1013, "one two"), (1014, "ab " * 400), (1015, text(5) + " word" * 300), (1016, "é" * 500), (1000, base), (None, "null id text here")]
    out.append((1020, "!! ".join(text(3).upper() for _ in range(60))))
    return [(i, t, "en", None if k % 7 == 0 else f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = make_docs()
    # more columns, some of whose names clash with the operators' own
    return rows, spark.createDataFrame(rows, DOC).repartition(3).withColumns({"rid": F.lit(1), "key": F.lit("k"), "size": F.lit(2), "score": F.lit(0.1), "fp": F.lit(3)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def words(text):
    return SPACE.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/\r\nX: y", "<p>one é</p>\r\n\r\nWARC/1.1\r\n"), (2, None, "<p>one é</p>\r\n\r\nWARC/1.1\r\n"), (5, "u", None), (3, "u", ""), (None, "u", ""), (7, "u", "x" * 100_000), (7, "v", "other")]
    warc.write_archives(warc.captures(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)), str(tmp_path / "w"), 4)
    got = warc.assemble(warc.read_records(spark, str(tmp_path / "w"))).collect()
    assert len(got) == len(rows) and all(r["request"]["method"] == "GET" for r in got)
    by = {(r["metadata"]["page_id"], r["main"]["target_uri"]): r for r in got}
    one = by[1, "http://a/%0D%0AX: y"]
    assert one["main"]["type"] == "response" and bytes(one["main"]["payload"]).decode() == rows[0][2]
    assert one["main"]["payload_digest"] == one["main"]["header_digest"] == base64.b32encode(hashlib.sha1(rows[0][2].encode()).digest()).decode()
    assert by[2, None]["main"]["type"] == "revisit" and ":1:" in by[2, None]["main"]["refers_to"]
    assert by[3, "u"]["main"]["type"] == "response" and by[5, "u"]["main"]["type"] == by[None, "u"]["main"]["type"] == "revisit"
    assert by[7, "u"]["main"]["type"] == by[7, "v"]["main"]["type"] == "response"


def test_warc_empty(spark, tmp_path):
    warc.write_archives(warc.captures(spark.createDataFrame([], "page_id long, url string, html string")), str(tmp_path / "e"))
    assert list(warc.parse_archive(b"")) == []


def plain_spans(texts, span=200):
    seen = Counter()
    for t in texts:
        for k in range(len(t) - span + 1):
            seen[t[k : k + span]] += 1
    out = []
    for t in texts:
        m = bytearray(len(t))
        for k in range(len(t) - span + 1):
            if seen[t[k : k + span]] > 1:
                m[k : k + span] = b"\1" * span
        out.append((bytes(b for b, x in zip(t, m, strict=True) if not x), len(re.findall(b"\1+", bytes(m)))))
    return out


@pytest.mark.parametrize("wide", [20_000, 2])
def test_suffix_dedup(docs, wide):
    rows, df = docs
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.deduplicate(df, wide).collect())
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter((r[0], len(t), len(t) - len(k), n, hashlib.sha256(k).hexdigest()) for r, t, (k, n) in zip(rows, texts, plain_spans(texts), strict=True))
    assert got == want


def test_deep_shallow_sort_against_a_set():
    rng = np.random.default_rng(5)
    data = np.frombuffer(b"".join(bytes(rng.choice(list(b"ab"), 260)) + b"a" * 250 + b"ab" * 150 for _ in range(6)) * 2, np.uint8)
    pos = np.sort(rng.choice(len(data) - 200, 900, replace=False))
    group = rng.integers(0, 2, len(pos))
    keys = Counter((int(g), data[p : p + 200].tobytes()) for p, g in zip(pos, group, strict=True))
    want = [keys[int(g), data[p : p + 200].tobytes()] > 1 for p, g in zip(pos, group, strict=True)]
    assert suffix_dedup.repeated_suffixes(data, pos, group).tolist() == want


def test_stretches_of_long_text_cover_all_windows(monkeypatch):
    text = make_docs(9)[5][1].encode() * 30
    whole = sorted((int(s), int(n)) for cols in suffix_dedup.stretches(text) for s, n in zip(cols[0], cols[1], strict=True))
    monkeypatch.setattr(suffix_dedup, "_PIECE", 1500)
    cut = sorted((int(s), int(n)) for cols in suffix_dedup.stretches(text) for s, n in zip(cols[0], cols[1], strict=True))
    cover = lambda x: [k for s, n in x for k in range(s, s + n)]
    assert cover(whole) == cover(cut) == list(range(len(text) - 199))


def test_pu_quality(spark):
    rng = np.random.default_rng(2)
    good = lambda: " ".join("".join(rng.choice(list("abcdef"), 5)) for _ in range(80)) + "."
    rows = [(i, good() if i % 5 else " ".join(w.upper() + "!!" for w in good().split())) for i in range(400)] + [(401, None), (402, ""), (None, good()), (1, good())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(400)] + [(3, None), (None, 1), (6, 0)], "doc_id long, quality int")
    got = pu_quality.classify(df, lab).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["predicted"] == int(r["doc_id"] % 5 > 0) for r in held if r["doc_id"] is not None and r["doc_id"] < 400]) > 0.97
    assert pu_quality.classify(df.limit(0), lab).count() == 0
    assert pu_quality.classify(df, lab.limit(0)).select("score").distinct().count() == 1


def test_secrets_base_and_network(spark, docs, empty):
    rows = [(1, 'é password = "hunter2hunter2" token: abc'), (2, "AKIA" + "A1" * 10), (3, "x " + "0af" * 12 + "z"), (4, "key: " + "aB3dE5gH7jK9mN1pQ3sT5vW7yZ"), (5, "card 4226020900891 4226020900891122 end"), (6, None), (6, ""), (7, "SECRET:aaaaaaaa tokenſ=12345678")]
    got = {(r["doc_id"], r["spans"]): r for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (1, "assign:2:28") in got and (2, "access:0:24") in got and (3, "hex:2:38") in got and (6, "") in got and (5, "") in got
    assert (4, "cnn:5:31") in got and (7, "assign:0:15") in got
    assert got[1, "assign:2:28"]["base_sha256"] == hashlib.sha256(b"assign:2:28").hexdigest()
    found, label = secret_scan.make_findings(600, 77)
    p = secret_scan.default_net().probability(np.array([secret_scan.encode(*x) for x in found])) >= secret_scan.default_net().threshold
    assert p[np.array(label) == 1].mean() > 0.95 and p[np.array(label) == 0].mean() < 0.05
    assert secret_scan.find_secrets(empty).count() == 0
    red = {r["doc_id"]: r["text"] for r in secret_scan.redacted(spark.createDataFrame([(1, rows[0][1]), (2, None)], "doc_id long, text string")).collect()}
    assert red == {1: 'é [SECRET]" token: abc', 2: None}


def plain_measures(text):
    w = words(text)
    sh = list(zip(w, w[1:], w[2:], strict=False))
    n, cover = Counter(sh), set()
    for k, s in enumerate(sh):
        if n[s] > 1:
            cover |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return (len(w), sum(map(len, w)), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(cover))


@pytest.mark.parametrize("bits", [24, 60])
def test_weak_rules(docs, empty, monkeypatch, bits):
    monkeypatch.setattr(weak_rules, "_INDEX_BITS", bits)  # 60 bits leave 4 for the hash: words decide
    rows, df = docs
    m = weak_rules.text_measures(df.select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r["doc_id"], *(r[k] for k in names)) for r in m.collect()) == Counter((r[0], *plain_measures(r[1])) for r in rows)
    assert weak_rules.weak_quality(weak_rules.text_measures(empty.select("doc_id", "text"))).count() == 0


def test_rule_fit_separates_kinds_of_junk():
    patterns = [((1, 1, 1, 1, 1), 800), ((1, 1, -1, 1, 1), 60), ((1, 1, 1, -1, -1), 50), ((0, 1, 1, 1, 1), 30)]
    good, like = weak_rules.fit_rules(patterns, 5)
    p = [weak_rules.posterior(v, good, like) for v, _ in patterns]
    assert p[0] > 0.9 and p[3] > 0.8 and p[1] < 0.5 and p[2] < 0.5


def plain_fingerprint(text):
    w = words(lower(text))
    sh = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    return [find(x) for x in range(len(fps))]


def test_simhash(docs, empty):
    rows, df = docs
    fps = [plain_fingerprint(r[1]) for r in rows]
    comp = plain_components(fps)
    low = {c: min((r[0] for r, d in zip(rows, comp, strict=True) if d == c and r[0] is not None), default=None) for c in set(comp)}
    want = Counter((r[0], format(f, "016x"), low[c]) for r, f, c in zip(rows, fps, comp, strict=True))
    got = simhash.near_duplicates(df).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("f"), "component_id").collect()
    assert Counter(map(tuple, got)) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("split", [10, 20_000])
def test_links_lose_no_component(spark, split):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = set()
    for b in base:  # crowds around a base that share a half, and strangers
        for _ in range(120):
            x = b
            for bit in rng.integers(0, 32, rng.integers(0, 7)):
                x ^= np.uint64(1) << np.uint64(bit)
            fps.add(int(x))
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 100, dtype=np.uint64)}
    fps = sorted(fps)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), split).collect()
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    ours, plain = [find(f) for f in fps], plain_components(fps)
    assert len(set(zip(ours, plain, strict=True))) == len(set(ours)) == len(set(plain))


def test_ppm_base_and_model(docs, empty):
    rows, df = docs
    got = sorted(map(tuple, ppm.score(df).collect()), key=repr)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    n = Counter()
    for r in rows:
        if not held(r[0]):
            n.update([*words(lower(r[1])), None])
    total, v = sum(n.values()), len(n)
    want = []
    for r in rows:
        t = [*words(lower(r[1])), None]
        want.append((r[0], held(r[0]), len(t), sum(n[x] > 0 for x in t), total, sum(math.log10((n[x] + 0.1) / (total + 0.1 * (v + 1))) for x in t)))
    assert [x[:5] for x in got] == [x[:5] for x in sorted(want, key=repr)]
    assert np.allclose(sorted(x[5] for x in got), sorted(x[5] for x in want))
    assert all(x[6] < 0 for x in got)
    assert ppm.score(empty).count() == 0


def plain_ppm(train, texts, order):
    """log10 probability of each text by textbook PPM with method D and full exclusion."""
    symbols = lambda t: b"".join(w.encode() + b" " for w in words(lower(t))) + b"\xff"
    seen = {}
    for t in train:
        s = b" " * order + symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                seen.setdefault(s[i - k : i], Counter())[s[i]] += 1

    def one(context, symbol):
        gone, p = set(), 1.0
        for k in range(order, -1, -1):
            here = {x: n for x, n in seen.get(context[order - k :], {}).items() if x not in gone}
            n = sum(here.values())
            if not n:
                continue
            if symbol in here:
                return p * (2 * here[symbol] - 1) / (2 * n)
            p, gone = p * len(here) / (2 * n), gone | set(here)
        return p / (256 - len(gone))

    out = []
    for t in texts:
        s = b" " * order + symbols(t)
        out.append(sum(math.log10(one(s[i - order : i], s[i])) for i in range(order, len(s))))
    return out


def test_ppm_against_a_plain_model(spark, docs, monkeypatch):
    rows, df = docs
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    want = plain_ppm([r[1] for r in rows if not held(r[0])], [r[1] for r in rows], ppm.ORDER)
    for block, piece in ((ppm._BLOCK, ppm._PIECE), (3000, 700)):
        monkeypatch.setattr(ppm, "_BLOCK", block)
        monkeypatch.setattr(ppm, "_PIECE", piece)
        got = ppm.score(df).collect()
        assert np.allclose(sorted(r["score"] for r in got), sorted(want), rtol=1e-6)
        by = {r["doc_id"]: r["score"] for r in got}
        assert all(by[r[0]] == pytest.approx(w, rel=1e-6) for r, w in zip(rows, want, strict=True))


def test_ppm_without_training_and_with_other_ids(spark):
    alone = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    df = spark.createDataFrame([(k, "Ab c") for k in alone], "doc_id long, text string")
    got = ppm.score(df).collect()
    assert [round(r["score"], 4) for r in got] == [round(-6 * math.log10(256), 4)] * 3 and {(r["n_known"], r["train_tokens"]) for r in got} == {(0, 0)}
    text = spark.createDataFrame([("x", "a b"), (None, None), ("x", "a b")], "doc_id string, text string")
    assert sorted((r["doc_id"] or "", r["n_tokens"]) for r in ppm.score(text).collect()) == [("", 1), ("x", 3), ("x", 3)]
    dates = text.select(F.lit("2024-01-01").cast("date").alias("doc_id"), "text")
    assert ppm.score(dates).count() == 3


def test_ppm_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    texts = [ppm.Block.symbols(bytes(rng.choice(list(b"abc "), 400))) for _ in range(3)]
    grams, n = ppm.Block([], [False] * 3, texts).tally(ppm.GRAMS)
    every = np.unique(grams >> np.uint64(8))[:40]
    full = ((every[:, None] << np.uint64(8)) | np.arange(256, dtype=np.uint64)).ravel()
    keys, count = ppm.counted(np.concatenate([grams, full]), np.concatenate([n, np.zeros(len(full), np.int64)]))
    low = ppm.low_levels(*ppm.entries(keys, count, ppm.LOW))
    p = 10.0 ** ppm.log_probabilities(keys, count, low)
    where = np.searchsorted(keys, full)
    assert np.allclose(p[where].reshape(-1, 256).sum(axis=1), 1)


def test_templates(spark, empty):
    words_ = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda omicron".split()
    item = "A train with 40 wagons leaves for the coast at noon and travels 300 km before Anna meets Bob and Anna waves to him there"
    copy = "Text before. A train with 55 wagons leaves for the coast at noon, and travels 410 km before Carla meets Dan and Carla waves to him there. After."
    mixed = copy.replace("Carla waves", "Dora waves")
    rows = [(1, copy), (2, "nothing of the kind " * 20), (3, item.lower()), (4, None), (5, ""), (6, item), (6, item), (7, " ".join(words_)), (8, mixed)]
    bench = spark.createDataFrame([(10, item), (11, "alpha beta gamma"), (12, "hi"), (13, None), (None, item)], "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for sent in (1_000_000, 0):
        got = {(r["doc_id"], r["item_id"]): r for r in templates.contaminated(df, bench, sent).collect()}
        assert {(1, 10), (6, 10), (7, 11)} <= set(got) and not {2, 4, 5} & {d for d, _ in got}
        assert got[1, 10]["n_changed"] >= 4 and got[6, 10]["n_changed"] == 0 and got[6, 10]["coverage"] == 1
        assert (8, 10) not in got  # one name of the item would be two in the document
    assert templates.contaminated(empty, bench).count() == 0
    assert templates.contaminated(df, bench.limit(0)).count() == 0


def test_templates_in_capitals():
    a, b = (templates.Template(x.encode()) for x in ("la acción é única y el niño está aquí hoy İ", "LA ACCIÓN É ÚNICA Y EL NIÑO ESTÁ AQUÍ HOY İ"))
    assert a.h.tolist() == b.h.tolist()


def test_template_windows_of_long_text(monkeypatch):
    text = " ".join(f"word{k} and text{k * 7 % 97}" for k in range(3000)).encode()
    whole = {(h, p) for h, _, p, _, _ in templates._rows(text, [8], None)}
    monkeypatch.setattr(templates, "_PIECE", 2000)
    assert {(h, p) for h, _, p, _, _ in templates._rows(text, [8], None)} == whole


def test_mixing(spark, docs, empty):
    rows, df = docs
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and sum(r["size"] for r in got) == sum(len(words(r[1])) for r in rows)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3 and r["source_size"] >= r["size"]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    assert all(target[s] <= 3 * size[s] + 1e-6 and taken[s] == pytest.approx(target[s], rel=0.05) for s in size)
    again = mixing.mix(df).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix(empty).count() == 0


def test_mixing_caps_and_redeals(spark):
    s = spark.createDataFrame([("1a", 10), ("1b", 1000), ("1c", 1000), ("2", 0)], "src string, size long")
    got = {r["src"]: r["target"] for r in mixing.source_targets(s).collect()}
    assert got["1a"] == 30 and got["2"] == 0 and got["1b"] + got["1c"] == pytest.approx(1980) and got["1c"] == pytest.approx(1.5 * got["1b"])


PAGE = """<html><head><title>t</title><script>var x="<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies on this site and more of them</div><div id=main><article><header><h1>The &amp; title</h1></header><p>First  para<b>graph</b> is
long enough to count.<p>Second one&nbsp;has <a href="x">a link</a> inside.<ul><li>item one<li>item two</ul><form>Name <input></form><aside>related</aside><div class="ad">Buy now</div><p>Third &lt;b&gt; paragraph.</article>
<section class="comments"><p>I like this very much, what a long comment it is, longer than all.</p></section></div><footer>&copy; us</footer></body></html>"""


def test_text_density(spark):
    want = "The & title\n\nFirst paragraph is long enough to count.\n\nSecond one has a link inside.\n\nitem one\n\nitem two\n\nThird <b> paragraph."
    assert text_density.main_text(PAGE) == want
    plain = PAGE.replace("<article>", "<div>").replace("</article>", "</div>").replace("<header><h1>The &amp; title</h1></header>", "<h1>The &amp; title</h1>")
    assert text_density.main_text(plain) == want
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "just text & more"), (None, "u", "<p>a<p>b</div>"), (6, "u", "<" * 50), (7, "u", "<script>only")]
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in text_density.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got[1, want, len(want)] == 2 and got[2, "", 0] == got[3, "", 0] == got[7, "", 0] == 1
    assert got[4, "just text & more", 16] == 1 and got[None, "a\n\nb", 4] == 1


def test_shared_dir_follows_the_setting(spark):
    assert common.shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_pipeline(spark, tmp_path, docs):
    import corpus_pipeline

    rows, df = docs
    d = tmp_path / "sf"
    spark.createDataFrame(rows, DOC).write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame([(r[0], int(r[0] != 1020)) for r in rows if r[0] is not None], "doc_id long, quality int").write.parquet(str(d / "labels.parquet"))
    spark.createDataFrame([(1, rows[9][1])], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(d)).collect()
    ids = [r["doc_id"] for r in got]
    assert len(ids) == len(set(ids)) and 9 not in ids and not {1001, 1020} & set(ids) and {"copies", "text", "n_chars"} <= set(got[0].asDict())


def plain_near(texts):
    """Roots by brute force: five-word shingles, Jaccard of at least 0.8."""
    sets = []
    for t in texts:
        w = words(lower(t))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    return [find(x) for x in range(len(texts))]


def edited_docs():
    rng = np.random.default_rng(3)
    vocab = [f"w{k}" for k in range(500)]
    out = []
    for c in range(12):  # chains of edits, crowds around one text, and halves that only look alike
        now = base = list(rng.choice(vocab, 150))
        for _ in range(60 if c == 0 else 6):
            if c % 3 == 0:
                now = list(base)
            for k in rng.integers(0, 150, 1 if c % 3 < 2 else 4):
                now = [*now[:k], str(rng.choice(vocab)), *now[k + 1 :]]
            out.append(" ".join(now))
    return [*out, out[0].upper(), None, "", " \n", "one two", "One  two", "one two three"]


def test_near_copies_have_candidates_by_fingerprints(spark):
    """SimHash and its deletion variants find sets that differ in few bits, and sets of one fingerprint, without min-hashes."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in rng.integers(0, 5000, 600)]
    texts = [" ".join(base), " ".join([*base[:-1], "other"]), " ".join(f"v{k}" for k in rng.integers(0, 5000, 600)), "", "a b"]
    prints = near_copies._prints(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text").cache()
    sid = {r["id"]: r["sid"] for r in prints.collect()}
    assert 0 <= np.bitwise_count(np.bitwise_xor(*(np.uint64(near_copies.fingerprint(near_copies.shingles(x.encode()))) for x in texts[:2]))) <= simhash.BITS
    assert {frozenset((r["a"], r["b"])) for r in near_copies.simhash_pairs(prints).collect()} == {frozenset((sid[0], sid[1]))}
    one = prints.withColumn("fp", F.lit(7).cast("long"))
    assert {r["b"] for r in near_copies.simhash_pairs(one).collect()} == {sid[k] for k in (0, 1, 2, 4)} - {min(sid[k] for k in (0, 1, 2, 4))}


def test_near_copies_against_brute_force(spark):
    texts = edited_docs()
    plain = plain_near(texts)
    assert 12 < len(set(plain)) < len(texts) - 80
    got = {r["id"]: r["root"] for r in near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3), "id").collect()}
    assert len(got) == len(texts) == len(set(got))
    assert len({(got[k], plain[k]) for k in got}) == len(set(got.values())) == len(set(plain))
    assert near_copies.near_copies(spark.createDataFrame([], "id long, text string"), "id").count() == 0


def test_near_duplicates_stage_drops_edited_copies(spark):
    import corpus_pipeline

    texts = edited_docs()
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOC), "").collect()}
    least = {}
    for k, r in enumerate(plain_near(texts)):
        least.setdefault(r, k)
    assert kept == set(least.values())


def test_stages_decide_by_row(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(6)
    good = lambda: " ".join("".join(rng.choice(list("abcdef"), 5)) for _ in range(80)) + "."
    bad = lambda: " ".join(w.upper() + "!!" for w in good().split())
    d, item = str(tmp_path), good()
    rows = [(i, good() if i % 5 else bad(), "en", "s", 0) for i in range(400)]
    spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(400)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    clean = [good() for _ in range(8)]
    rows += [(None if k % 2 else 1000, t, "en", "s", 0) for k, t in enumerate([*clean, bad(), bad(), item, item, clean[0], clean[1]])]
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{d}/documents.parquet")
    kept = spark.read.parquet(f"{d}/documents.parquet")
    at = lambda df: Counter(r["text"] for r in df.where("doc_id IS NULL OR doc_id = 1000").collect())
    kept = common.written(corpus_pipeline.quality(spark, kept, d))
    assert at(kept) == Counter([*clean, *clean[:2], item, item])
    kept = common.written(corpus_pipeline.near_duplicates(spark, kept, d))
    assert at(kept) == Counter([*clean, item])
    kept = common.written(corpus_pipeline.decontamination(spark, kept, d))
    assert at(kept) == Counter(clean)
    mixed = corpus_pipeline.mix(spark, kept, d)
    assert at(mixed) == Counter(clean) and mixed.columns == [*DOC.replace(" long", "").replace(" string", "").split(", "), "copies", "target"]


def test_templates_dense_in_slots(spark):
    numbers = "a shop sells 12 red apples to each child and later a farmer brings back 12 green pears for the old teacher"
    items = [(1, "What is 12 + 7 * 3 - 5 / 9"), (2, "Compute 12 plus 7"), (3, numbers), (4, "Find 3 4 5 6 7 8 9 10 11 12 for every one of the given small odd values"), (5, "42")]
    rows = [(k, f"Some words first. {t} And more of them.") for k, t in items[:4]] + [(13, numbers.replace("12 red", "15 red").replace("12 green", "20 green"))]
    rows += [(14, items[3][1].replace("3 4 5 6 7 8", "9 8 3 1 2 2")), (20, "What is 1 + 2 * 3 - 4 / 5"), (21, "Compute 1 plus 2"), (22, "1 2 3 4 5 6 7 8 9 10 11 12 " * 5), (23, "42"), (24, "it was 42 then"), (25, "41")]
    bench, df = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string")
    for sent in (1_000_000, 0):
        got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in templates.contaminated(df, bench, sent).collect()}
        assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (13, 3), (14, 4), (23, 5)}
        assert got[1, 1] == got[2, 2] == got[3, 3] == got[4, 4] == 1 and got[13, 3] < 1


def test_text_density_judges_hinted_wrappers():
    text = "".join(f"<p>Paragraph {k} of the article says something that is long enough to count.</p>" for k in range(6))
    want = "\n\n".join(f"Paragraph {k} of the article says something that is long enough to count." for k in range(6))
    small = '<div class="sidebar"><p>Other pages of this site.</p></div><section class="comments"><article><p>I like this.</p></article></section>'
    for page in ('<div class="content has-sidebar">%s</div>', '<div id="page-side">%s</div>', '<article class="post no-comments">%s</article>', '<form id="aspnetForm"><div>%s</div></form>'):
        assert text_density.main_text(f"<body>{page % text}</body>") == want
        if "article" in page:
            assert text_density.main_text(f"<body>{small}{page % text}</body>") == want
        assert text_density.main_text(f"<body>{page % (text + small.partition('<section')[0])}</body>") == want
    assert text_density.main_text(f'<body><div class="content has-sidebar"><article>{text}</article>{small}</div></body>') == want
    assert text_density.main_text(f'<body><div>{text}</div><div class="sidebar"><p>Other pages of this site.</p></div></body>') == want


def test_text_density_is_linear_in_time():
    text = "<p>Words of the article that are long enough to count here.</p>" * 3
    want = "\n\n".join(["Words of the article that are long enough to count here."] * 3)
    n = 200_000
    began = time.monotonic()
    for bad in ("<a " + "x" * n, "<a " * n, "<a href='" + "x" * n, '<a b="' * n, "<!" * n, "<![CDATA[" * n, "<!--" * n, "</b" * n, "<p " + '"\'' * n, "<x=" * n):
        assert text_density.main_text(f"<body><div>{text}</div>{bad}").startswith(want)
    deep = 30_000
    assert text_density.main_text("<div>" * deep + text + "</span></i>" * deep + "</div>" * deep) == want
    assert text_density.main_text("<b>" * deep + "<td>" * deep + text) == want
    assert time.monotonic() - began < 20


def test_text_density_against_a_plain_version():
    rng = np.random.default_rng(12)

    def tree(depth):
        kids = [tree(depth - 1) if depth and rng.random() < 0.75 else "t" * int(rng.integers(1, 60)) for _ in range(rng.integers(1, 6))]
        return (str(rng.choice(["div", "section", "a", "b"])), kids)

    show = lambda x: x if isinstance(x, str) else f"<{x[0]}>{''.join(map(show, x[1]))}</{x[0]}>"

    def count(x):  # characters, tags, characters in links, link tags
        if isinstance(x, str):
            return np.array([len(x), 0, 0, 0])
        c = sum((count(k) + [0, not isinstance(k, str), 0, 0] for k in x[1]), np.zeros(4, int))
        c[2:] = (c[0], c[1] + 1) if x[0] == "a" else c[2:]
        return c

    for _ in range(40):
        kids = [tree(4) for _ in range(4)]
        root = ("body", kids)
        body = count(root)

        def density(x, body=body):
            c, t, lc, lt = count(x)
            base = math.log(c / max(c - lc, 1) * lc + body[2] / body[0] * c + math.e)
            return c / max(t, 1) * (math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / math.log(base) if base > 1 else 1)

        def every(x):
            return [] if isinstance(x, str) else [x, *(y for k in x[1] for y in every(k))]

        nodes = every(root)
        got = text_density.densities(text_density.parse("".join(map(show, kids))))
        assert [n.tag for n in got] == [x[0] for x in nodes]
        assert np.allclose([n.density for n in got], [density(x) for x in nodes])
        total = [sum(density(k) for k in x[1] if not isinstance(k, str)) if x[0] not in "ab" else -1 for x in nodes]
        assert text_density.seed_of(got) is got[int(np.argmax(total))]


def test_text_density_chooses_by_density():
    p = lambda k, words: f"<p>{' '.join(f'word{k}x{j}' for j in range(words))}.</p>"
    teasers = "".join(f"<article><h2><a href=x>Teaser {k}</a></h2>{p(k, 6)}</article>" for k in range(3))
    body = "".join(p(k, 40) for k in range(10, 16))
    want = "\n\n".join(re.findall("<p>(.*?)</p>", body))
    for page in (f"{teasers}<div><div>{body}</div></div>", f"<div>{body}</div><section>{teasers}</section>", f"<div>{body}</div><div class=comments>{p(1, 60) * 9}</div>"):
        assert text_density.main_text(f"<body>{page}</body>") == want
    clash = "<main><h1>Title</h1><div>%s</div><ul><li><a href=a>one</a><li><a href=b>two</a></ul></main>"
    assert text_density.main_text(clash % body) == "Title\n\n" + want


def test_text_density_ignores_other_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>one text</p>", "t", 3)], "page_id long, url string, html string, text string, n_chars int")
    assert [tuple(r) for r in text_density.extract(df).collect()] == [(1, "u", "one text", 8)]


def test_templates_keep_whole_fillers(spark):
    item = "The first train leaves the station at 10:45 and the second train leaves the station at 12:45 on the same day"
    rows = [(1, item.replace("10:45", "10:20").replace("12:45", "13:50")), (2, item.replace("10:45", "9:00").replace("12:45", "2:1"))]
    got = templates.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["coverage"], r["n_changed"]) for r in got} == {(1, 1.0, 2), (2, 1.0, 2)}


def plain_template_words(text):
    """(plain form, typed form, typed form with opening names, filler, kind) of each word."""
    out, ends, last, number_before = [], 0, None, False
    for m in SPACE.finditer(text or ""):
        kept = [k for k in range(m.start(), m.end()) if text[k].isascii() is False or text[k].isalnum()]
        if not kept:
            continue
        ends = sum(c in ".!?:\n" for c in text[: kept[0]])
        word = "".join(text[k] for k in kept)
        number = word[0] in "0123456789" or word.lower() in templates.NUMBER_WORDS
        unit = number_before and not number and word.lower() in templates.UNITS
        proper = word[0].isupper() and any(c.islower() for c in word) and len(word) > 1 and not number and not unit
        inside = last is not None and ends == last
        typed = "#n" if number else "#u" if unit else "#m" if proper and inside else word.lower()
        kind = 1 if proper and inside else 2 if proper else 0
        out.append((word.lower(), typed, "#m" if proper else typed, text[kept[0] : kept[-1] + 1], kind))
        last, number_before = ends, number
    return out


def plain_contaminated(docs_, items):
    """(doc, item): coverage, by comparing every window of an item with every place of a document."""
    out = {}
    for i, item in items:
        w = plain_template_words(item)
        n = min(8, len(w))
        for d, text in docs_:
            x = plain_template_words(text)
            hit = set()
            if 0 < n <= 2 and [y[0] for y in w] == [y[0] for y in x]:
                hit = {0}
            for shift in range(1 - len(w), len(x)) if n > 2 else ():
                found = []  # place, evidence, pairs of fillers
                for p in range(len(w) - n + 1):
                    if not 0 <= p + shift <= len(x) - n:
                        continue
                    a, b = w[p : p + n], x[p + shift : p + shift + n]
                    slots = lambda z: sum(y[1].startswith("#") for y in z)
                    fill = lambda z, more: [(y[4], y[3]) for y in z if y[1].startswith("#") or (more and y[4] == 2)]
                    least = max(min(3, n), n - 3)
                    few = [n - slots(z) >= least for z in (a, b)]
                    opening = [any(y[4] == 2 for y in z) for z in (a, b)]
                    if all(few) and [y[1] for y in a] == [y[1] for y in b]:
                        found.append((p, True, set(zip(fill(a, False), fill(b, False), strict=True))))
                    if not any(few) and [y[0] for y in a] == [y[0] for y in b] and len(fill(a, False)) == len(fill(b, False)):
                        found.append((p, True, set(zip(fill(a, False), fill(b, False), strict=True))))
                    if all(not f or o for f, o in zip(few, opening, strict=True)) and [y[2] for y in a] == [y[2] for y in b]:
                        found.append((p, False, set(zip(fill(a, True), fill(b, True), strict=True))))
                times = Counter(pair for _, _, pairs in found for pair in pairs)
                best = {}
                for (a, b), m in sorted(times.items(), key=lambda z: (-z[1], z[0][1][1])):
                    best.setdefault(a, b)
                if any(a[0] == 1 and best[a] != b for a, b in times):
                    continue
                found = [z for z in found if all(best[a] == b for a, b in z[2])]
                if any(z[1] for z in found):
                    hit |= {z[0] for z in found}
            if w and len(hit) / (len(w) - n + 1) >= 0.5:
                out[d, i] = len(hit) / (len(w) - n + 1)
    return out


def test_templates_against_brute_force(spark):
    rng = np.random.default_rng(14)
    vocab = "the farmer sells some red apples to each old child in town before lunch and then walks back home with bread".split()
    names, units = ["Anna", "Émile", "McDonald", "Bob", "Zoë"], ["km", "kg", "hours"]

    def question():
        out = []
        for _ in range(int(rng.integers(2, 30))):
            r = rng.random()
            out += [str(rng.choice(names))] if r < 0.12 else [str(rng.integers(1, 30)), *([str(rng.choice(units))] if rng.random() < 0.5 else [])] if r < 0.3 else ["twelve:"] if r < 0.33 else [str(rng.choice(vocab)) + str(rng.choice(["", "", "", ".", ","]))]
        return " ".join(out).capitalize() if rng.random() < 0.5 else " ".join(out)

    items = [(k, question()) for k in range(40)]

    def changed(text):
        swap = {n: str(rng.choice(names)) for n in names}
        out = [swap.get(w, w) if rng.random() < 0.97 else str(rng.choice(vocab)) for w in text.split(" ")]
        out = [str(rng.integers(1, 30)) if w.isdigit() and rng.random() < 0.7 else w for w in out]
        return " ".join(out)

    docs_ = [(k, " ".join([question(), changed(items[k % 40][1]), question()]) if k % 3 else changed(items[k % 40][1])) for k in range(120)]
    want = plain_contaminated(docs_, items)
    assert len(want) > 60
    df, bench = spark.createDataFrame(docs_, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for sent in (1_000_000, 0):
        got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in templates.contaminated(df.withColumns({"n": F.lit(1), "h": F.lit("x"), "pos": F.lit(0)}), bench.withColumn("fill", F.lit(1)), sent).collect()}
        assert got == pytest.approx(want)


def plain_em(votes, priors, rounds=200, prior=0.75):
    """Most probable model by expectation-maximisation over rows, in numpy; each row's posterior."""
    votes = np.array(votes) + 1
    n = len(votes)
    start = np.array([[p[0], p[1]] for p in priors]).transpose(1, 0, 2)  # class, rule, vote
    weight = n * np.array([p[2] for p in priors]).T[:, :, None]
    hot = np.eye(3)[votes]
    like, good = start, prior
    for _ in range(rounds + 1):
        logs = np.einsum("nrv,crv->nc", hot, np.log(like)) + np.log([1 - good, good])
        p = 1 / (1 + np.exp(logs[:, 0] - logs[:, 1]))
        if _ < rounds:
            r = np.stack([1 - p, p])
            like = (np.einsum("cn,nrv->crv", r, hot) + weight * start) / (r.sum(axis=1)[:, None, None] + weight)
            good = (p.sum() + prior) / (n + 1)
    return p


def test_rule_fit_against_plain_em():
    rng = np.random.default_rng(15)
    priors = tuple(weak_rules.RULES.values())
    votes = [tuple(int(v) for v in rng.choice([-1, 0, 1], len(priors), p=[0.3, 0.2, 0.5] if k % 4 == 0 else [0.03, 0.12, 0.85])) for k in range(500)]
    good, like = weak_rules.fit_rules(sorted(Counter(votes).items()), len(priors), priors=priors)
    assert np.allclose([weak_rules.posterior(v, good, like) for v in votes], plain_em(votes, priors), atol=1e-6)
    assert all(abs(sum(x[v][y] for v in x) - 1) < 1e-9 for x in like for y in (0, 1))


def test_one_weak_reject_need_not_lose(spark):
    rng = np.random.default_rng(16)
    prose = lambda k: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(3, 9))) + ("." if j % 12 == 11 else "") for j in range(k))
    good = [prose(120) for _ in range(80)]
    weak = prose(120).replace(".", "")  # no sentence ends: the rule on sentences rejects
    strong = [" ".join(w + "$$" for w in prose(80).split()) for _ in range(8)]
    shout = [" ".join(w.upper() + "!!!" for w in (prose(10) + " ") .split() * 9) for _ in range(8)]
    rows = [(k, x) for k, x in enumerate([*good, weak, *strong, *shout, None, ""])]
    scored = weak_rules.weak_quality(weak_rules.text_measures(spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_words": F.lit(-1), "n_stops": F.lit("x")}))).collect()
    by = {r["doc_id"]: r for r in scored}
    print([(k, round(by[k]["quality"], 3), [by[k][f"vote_{r}"] for r in weak_rules.RULES]) for k in range(80, 99)])
    assert by[80]["vote_sentences"] == -1 and by[80]["quality"] > 0.5
    assert all(by[k]["quality"] > 0.9 for k in range(80)) and all(by[k]["quality"] < 0.5 for k in range(81, 97))
    votes = [tuple(by[k][f"vote_{r}"] for r in weak_rules.RULES) for k, _ in rows]
    assert np.allclose([by[k]["quality"] for k, _ in rows], plain_em(votes, tuple(weak_rules.RULES.values())), atol=1e-6)


def test_weak_rules_query(spark, docs, tmp_path):
    rows, df = docs
    df.write.parquet(str(tmp_path / "documents.parquet"))
    for r in weak_rules.op5_weak_quality_rules(spark, str(tmp_path)).collect():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["posterior"] >= 0.5)


def test_pu_fit_against_gradient_descent():
    rng = np.random.default_rng(17)
    good = lambda n: np.hstack([rng.normal(1, 1, (n, 2)), rng.random((n, pu_quality.N_FEATURES - 2))])
    bad = lambda n: np.hstack([rng.normal(-2, 1, (n, 2)), rng.random((n, pu_quality.N_FEATURES - 2))])
    pos, unl = good(800), np.vstack([good(2100), bad(900)])
    sums = lambda f: sum(f(x) for x in np.array_split(unl, 7))
    model = pu_quality.fit_pu(pos, sums)
    assert model.prior == pytest.approx(0.7, abs=0.06)  # neither given nor counted
    truth = np.array([1] * 2100 + [0] * 900)
    assert ((model.score(unl) > 0.5) == truth).mean() > 0.93
    assert abs(model.score(unl).mean() - 0.7) < 0.06  # scores are probabilities
    mean, scale = unl.mean(axis=0), unl.std(axis=0) + 1e-3
    z = lambda x: np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    p, u, w = z(pos), z(unl), np.zeros(pu_quality.N_FEATURES + 1)
    keep = 0.03 * np.append(np.ones(pu_quality.N_FEATURES), 0)
    for _ in range(4000):
        w -= 0.2 * (u.T @ (1 / (1 + np.exp(-(u @ w)))) / len(u) - model.prior * p.mean(axis=0) + keep * w)
    assert np.allclose(model.score(unl), 1 / (1 + np.exp(-(u @ w))), atol=0.01)


def test_pu_quality_never_reads_negative_labels(spark, docs):
    rows, df = docs
    rng = np.random.default_rng(18)
    ids = [r[0] for r in rows if r[0] is not None]
    lab = [(i, int(rng.random() < 0.6)) for i in dict.fromkeys(ids)]
    shape = "doc_id long, quality int, toxic int, text string"
    with_both = spark.createDataFrame([(i, q, 0, "x") for i, q in lab], shape)
    without = spark.createDataFrame([(i, q, 1, "y") for i, q in lab if q], shape)
    one, two = (sorted(map(repr, pu_quality.classify(df, x).collect())) for x in (with_both, without))
    assert one == two
    held = spark.createDataFrame([(i, 1, 0, "x") for i in dict.fromkeys(ids) if zlib.crc32(str(i).encode()) % 4 == 2], shape)
    assert {r["score"] for r in pu_quality.classify(df, held).collect()} == {0.5}
    long = spark.createDataFrame([(5000, "word and more " * 40_000), (5001, None)], "doc_id long, text string")
    assert pu_quality.classify(df.select("doc_id", "text").unionByName(long), with_both).where("score BETWEEN 0 AND 1").count() == len(rows) + 2


def test_secrets_are_found_anywhere_in_long_runs():
    net = secret_scan.default_net()
    rng = np.random.default_rng(20)
    key = "".join(rng.choice(list("ABCDEFGHJKLMabcdefghjkmnpqrstuvwxyz23456789"), 72))
    path = "/".join(["usr", "share", "holdenang", "marketing", "reports", "garchon", "delman"] * 9)
    for at in (0, 100, 217, 350):
        text = f"see {path[:at]}/{key}/{path[at:]} there"
        spans = [s for s in secret_scan.scan(text.encode(), net) if s[2] == "cnn"]
        lo = text.index(key)
        assert any(s < lo + 72 and lo < e for s, e, _ in spans)
        assert all(e - s < len(text) - 40 for s, e, _ in spans)  # the key's windows, not the whole run
    assert secret_scan.scan(f"see {path} there".encode(), net) == []
    for text in ("pwd = x7Kq9ZpL2m", "auth: 'QwErTyUiOpAsDfGhJkLz'", "bearer = aB3xK9mQ"):
        assert any(s[2] == "cnn" for s in secret_scan.scan(text.encode(), net)), text
    for text in ("the word unbelievablenesses and internationalization is long", "x7Kq9ZpL2m alone", "key: holdenang", "-" * 300, "Donaudampfschifffahrtsgesellschaft"):
        assert secret_scan.scan(text.encode(), net) == [], text


def plain_scan(text, net):
    """All spans, by one pass over every run and every window of it."""
    base = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
    base += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    base += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 32]
    covered = lambda s, e: len(set(range(s, e)) - {k for a, b, _ in base for k in range(a, b)}) < 8
    out = list(base)
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        s, e = m.span()
        before = re.search("(" + "|".join(secret_scan.KEYS) + r""")["']?\x20*[:=]\x20*["']?$""", text[:s], re.I | re.A)
        if (e - s >= 16 or (e - s >= 8 and before)) and not covered(s, e):
            cuts = [(s, e)] if e - s <= 72 else [*((a, a + 72) for a in range(s, e - 72, 36)), (e - 72, e)]
            marks = set()
            for a, b in cuts:
                if net.probability(secret_scan.encode(text, a, b)[None])[0] >= net.threshold:
                    marks |= set(range(a, b))
            for k in sorted(marks):
                if k - 1 not in marks:
                    out.append((k, next(j for j in range(k, e + 1) if j not in marks), "cnn"))
    return sorted(out, key=lambda x: (x[0], ("assign", "access", "hex", "cnn").index(x[2]), x[1]))


def test_secrets_against_a_plain_scan(spark):
    net = secret_scan.default_net()
    rng = np.random.default_rng(21)
    found, _ = secret_scan.make_findings(300, 91)
    texts = [" é ".join(found[k][0] for k in rng.integers(0, 300, 6)) for _ in range(60)]
    texts += ["password=" + "a" * 20 + "/" + "Zx9" * 40 + " AKIA" + "Q7" * 8 + "/abcDEF123456ghiJKL " + "0af" * 30 + "zzZ", "key=" + "Ab3" * 300, "", "key: \"abc12345\" auth=0123456789abcdef"]
    rows = [(k, t, "spans", 1) for k, t in enumerate(texts)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_hex int").repartition(2)
    got = {r["doc_id"]: r for r in secret_scan.find_secrets(df).collect()}
    for k, t in enumerate(texts):
        want = plain_scan(t, net)
        show = lambda some: ",".join(f"{k}:{s}:{e}" for s, e, k in some)
        assert got[k]["spans"] == show(want)
        base = [s for s in want if s[2] != "cnn"]
        assert got[k]["base_sha256"] == hashlib.sha256(show(base).encode()).hexdigest()
        assert [got[k][f"n_{x}"] for x in ("assign", "access", "hex")] == [sum(s[2] == x for s in base) for x in ("assign", "access", "hex")]
    assert got[None]["spans"] == "" and got[None]["n_hex"] == 0


def test_mixing_with_other_ids_and_columns(spark):
    rows = [(f"d{k}", "word " * (k % 300), f"s{k % 4}", 7, 0.5, 1) for k in range(400)] + [(None, None, None, 0, 0.0, 0)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string, copies int, target double, k int").repartition(3)
    one, two = (sorted(map(repr, mixing.mix(x).collect())) for x in (df, df.repartition(5)))
    assert one == two and len(one) == len(rows)


def test_mixing_numbers_along_sizes(spark):
    sizes = spark.createDataFrame([(k, "s", "1s", (k * 37) % 500) for k in range(900)], "doc_id long, source string, src string, size long")
    rates = spark.createDataFrame([("1s", 10, 1, 4.0, 0.0, 0.4)], "src string, source_size long, weight long, target double, dual double, rate double")
    got = sorted(mixing.round_to_copies(sizes, rates).collect(), key=lambda r: (r["size"], r["doc_id"] % mixing.SALTS, r["doc_id"]))
    assert [r["k"] for r in got] == list(range(1, 901))


def test_sources_are_weighed_in_order(spark):
    names = [f"1n{k:04}" for k in range(500)]
    df = spark.createDataFrame([(n, 10) for n in reversed(names)], "src string, size long").repartition(7)
    got = {r["src"]: r["weight"] for r in mixing.source_targets(df).collect()}
    assert [got[n] for n in names] == [k % 3 + 1 for k in range(500)]


def test_pipeline_with_clashing_columns_and_empty_tables(spark, tmp_path, docs):
    import corpus_pipeline

    rows, _ = docs
    more = spark.createDataFrame(rows, DOC).withColumns({"copies": F.lit("x"), "target": F.lit(1), "root": F.lit(2), "score": F.lit(3)})
    for name, df in (("full", more), ("none", more.limit(0))):
        d = str(tmp_path / name)
        df.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(r[0], 1) for r in rows if r[0] is not None], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, rows[9][1])], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        got = corpus_pipeline.run(spark, d)
        assert got.columns == [*DOC.replace(" long", "").replace(" string", "").split(", "), "root", "score", "copies", "target"]
        assert (got.count() > 0) == (name == "full")
