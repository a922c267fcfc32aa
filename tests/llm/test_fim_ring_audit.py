"""Fill-in-the-middle, hash ring and filter audit against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silkgrain.llm import fill_middle, filter_audit, hash_ring

UNIT = {"line": re.compile(r"[^\n]*\n|[^\n]+"), "word": re.compile(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+"), "char": re.compile(r"(?s:.)")}
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

TEXTS = [
    (1, "one\ntwo\n\n\nthree"), (2, "\n\n"), (3, "no newline"), (4, "é𝄞\n\U0001f600 x\n"), (5, ""), (6, None), (7, "has <S> in it\nand more"), (7, "one\ntwo\n\n\nthree"),
    (None, "a\nb\nc\nd"), (9, "x\n" * 5000), (10, "y" * 70_000 + "\nz"), (11, "<P\n<\nS>\n<M\n>"), (12, " \t\n \r\n"),
]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\té𝄞", max_size=40), st.sampled_from(sorted(UNIT)))
def test_offsets(text, unit):
    runs, units = fill_middle.encode(text, unit), UNIT[unit].findall(text)
    assert (int(runs.ends[-1]) if runs.length else 0) == len(units)
    assert [fill_middle.offset(runs, c) for c in range(len(units) + 1)] == [len("".join(units[:c])) for c in range(len(units) + 1)]
    kinds = [x in "\n" if unit == "line" else x.isspace() if unit == "word" else True for x in text]
    assert len(runs.start) == len(list(itertools.groupby(kinds)))  # maximal runs


def plain_fim(doc_id, text, unit, percent, spm):
    text, h = text or "", sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNIT[unit].findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return doc_id, len(units), "plain", None, None, None, text
    if h4 % 100 < spm:
        return doc_id, len(units), "spm", pre, mid, suf, f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, len(units), "psm", pre, mid, suf, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize(("unit", "percent", "spm"), [("line", 100, 50), ("word", 60, 50), ("char", 100, 0)])
def test_fill_in_middle(spark, unit, percent, spm):
    rows = TEXTS + [(100 + i, f"a{i}\nb\n\nc d\n" * (i % 5 + 1)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "output": F.lit(1), "h1": F.lit(2), "cut": F.lit(3)})
    made = fill_middle.fill_in_middle(docs, unit, percent=percent, spm_percent=spm)
    got = fill_middle.restored(made).collect()
    key = lambda r: (repr(r[0]), r[-1])
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted((plain_fim(*r, unit, percent, spm) for r in rows), key=key)
    assert sorted((repr(r["doc_id"]), r["restored"]) for r in got) == sorted((repr(i), t or "") for i, t in rows)
    assert len({r["form"] for r in got}) == (3 if spm else 2)


def test_fill_in_middle_markers_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.restored(fill_middle.fill_in_middle(none)).count() == 0
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("<P>", "x<S>", "<M>")):
        with pytest.raises(ValueError, match="marker"):
            fill_middle.fill_in_middle(none, markers=bad)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_ring(rows, shards, nodes, caps):
    """Deal the rows one by one; each: (sort key, ring place, load)."""
    nodes_at = hash_ring.ring_nodes(shards, nodes)
    places, have, out = [p for p, _ in nodes_at], [0] * shards, []
    for row, place, load in rows:
        i = bisect_right(places, place)
        for k in range(len(nodes_at)):
            s = nodes_at[(i + k) % len(nodes_at)][1]
            if have[s] < caps[s]:
                break
        else:
            s = nodes_at[i % len(nodes_at)][1]
        out.append((*row, s, nodes_at[i % len(nodes_at)][1]))
        have[s] += load
    return out


def plain_order(rows):
    key = lambda r: "" if r[0] is None else str(r[0])
    order = lambda r: signed(xxhash.xxh64(key(r).encode(), seed=xxhash.xxh64(b"order", seed=42).intdigest()).intdigest())
    return [(r, xxhash.xxh64(key(r).encode(), seed=42).intdigest() >> 1) for r in sorted(rows, key=lambda r: (order(r), r[0] is not None, r[0] or 0, r[1:]))]


@pytest.fixture(scope="module")
def rows():
    texts = [(i, "x" * (i * 37 % 211)) for i in range(400)]
    texts += [(i, "the same text") for i in range(1000, 1300)] + [(5000, "again")] * 150 + [(None, None)] * 9 + [(6000, ""), (7000, "é" * 3000), (6000, None)]
    return texts


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_hash_ring(spark, rows, law):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sized = hash_ring.document_rows(docs).withColumns({"range": F.lit(1), "n": F.lit(2)})
    got = hash_ring.shard_by_ring(sized, 8, law, 0.05, "doc_id", None if law == "rows" else "size", 16)
    assert got.columns == ["doc_id", "size", "text_crc32", "range", "n", "shard", "slot", "home"]
    got = got.collect()
    plain = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    total = sum(1 if law == "rows" else r[1] for r in plain)
    caps = [total // 8 + (s < total % 8) for s in range(8)] if law == "rows" else [int(-(-total * 1.05 // 8))] * 8
    dealt = plain_ring([(r, p, 1 if law == "rows" else r[1]) for r, p in plain_order(plain)], 8, 16, caps)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["home"]) for r in got) == Counter(dealt)
    slots, loads = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += 1 if law == "rows" else r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    if law == "rows":
        assert max(loads.values()) - min(loads.values()) <= 1
    else:
        assert max(loads.values()) <= caps[0] + max(r[1] for r in plain)
    assert any(r["shard"] != r["home"] for r in got)


def test_hash_ring_small_and_moves(spark):
    few = spark.createDataFrame([(i, "a") for i in range(3)], "doc_id long, text string")
    got = hash_ring.shard_by_ring(hash_ring.document_rows(few)).collect()
    assert len(got) == 3 and {r["slot"] for r in got} == {0} and {r["shard"] for r in got} == {0, 1, 2}
    assert hash_ring.shard_by_ring(hash_ring.document_rows(few.limit(0))).collect() == []
    # One shard more moves not much more than its share; without the ring nearly all would move.
    many = spark.createDataFrame([(i, "a") for i in range(4000)], "doc_id long, text string")
    eight, nine = ({r["doc_id"]: r["shard"] for r in hash_ring.shard_by_ring(hash_ring.document_rows(many), k).collect()} for k in (8, 9))
    assert 4000 / 9 * 0.8 < sum(eight[i] != nine[i] for i in eight) < 4000 * 0.4


def test_ring_cells(spark):
    cells = {r[0]: (r[1], r[2]) for r in hash_ring.ring_cells(spark, 8, 64).collect()}
    places = [p for p, _ in hash_ring.ring_nodes(8, 64)]
    assert len(cells) == 1 << hash_ring.CELL_BITS and sum(len(x) for _, x in cells.values()) == len(places) == 512
    for p in [0, (1 << 63) - 1, *places, *(p - 1 for p in places)]:
        first, inside = cells[p >> (63 - hash_ring.CELL_BITS)]
        assert first + sum(x <= p for x in inside) == bisect_right(places, p)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_audit(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    flags = []
    for i, source, text in docs:
        text = text or ""
        w = WORD.findall(text)
        caps = sum("A" <= c <= "Z" for c in text)
        smaller = i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in docs)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * caps > 2 * len(text), "D": any(c in "#$%&*|" for c in text), "E": smaller}
        flags.append((source or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in flags}:
        mine = [f for f in flags if f[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = [x for x in mine if not x[1] & set(order[: step - 1])]
                gone = [x for x in before if f in x[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(before) - len(gone), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows():
    long = " ".join(f"w{i}" for i in range(250))
    made = [(i, f"s{i % 3}", t) for i, t in enumerate([long, long, "short", "SHOUT " * 300, "a b " * 150, long + " #", None, "", "A", "short", long.upper(), "x | y"] * 3)]
    return made + [(3, "s1", long), (3, "s1", long), (None, None, long), (None, "s0", None), (100, None, "short"), (-1, "", long), (0, "s0", long)]


def test_filter_audit(spark):
    docs, labels = audit_rows(), [(0, 1, 0), (0, 0, 1), (1, 1, 1), (5, 0, 1), (100, 1, None), (None, 1, 1), (3, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumns({"part": F.lit("z"), "n": F.lit(5), "good": F.lit(1), "A": F.lit(1)}).repartition(4)
    failed = filter_audit.failures(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = filter_audit.interaction_audit(filter_audit.joint_failures(failed, "ABCDE"), "ABCDE").collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == plain_audit(docs, labels)
    assert len(got) == 600 * len({s or "" for _, s, _ in docs})


def test_filter_audit_empty(spark):
    failed = filter_audit.failures(spark.createDataFrame([], "doc_id long, source string, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert filter_audit.interaction_audit(filter_audit.joint_failures(failed, "ABCDE"), "ABCDE").count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sets(st.integers(0, 2)), max_size=12))
def test_dividends(fails):
    """Shapley by dividends equals the mean over all orders, in plain numbers."""
    joint = [sum(all(i in f for i in range(3) if t >> i & 1) for f in fails) for t in range(8)]
    for i in range(3):
        dividends = sum(Fraction((-1) ** (t.bit_count() + 1) * joint[t], t.bit_count()) for t in range(1, 8) if t >> i & 1)
        removed = sum(sum(i in f and not f & set(o[: o.index(i)]) for f in fails) for o in itertools.permutations(range(3)))
        assert dividends * 6 == removed


@pytest.mark.parametrize(("query", "sql"), [(fill_middle.op11_fill_in_middle, fill_middle.SQL), (filter_audit.op13_filter_audit, filter_audit.SQL)])
def test_against_sql(spark, query, sql):
    duckdb = pytest.importorskip("duckdb")
    at, db = "/root/testdata/sf0.001", duckdb.connect()
    pytest.importorskip("pathlib").Path(at).is_dir() or pytest.skip("the driver's tables aren't here")
    for t in ("documents", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    q = db.execute(sql)
    cols = [c[0] for c in q.description]
    assert sorted(map(repr, q.fetchall())) == sorted(repr(tuple(r)) for r in query(spark, at).select(cols).collect())
