"""Removal of byte strings of SPAN bytes that start more than once, by sorted suffixes.

Which suffixes can meet is found by content: of the K-byte grams of each SPAN-byte window the
one with the least hash is its anchor, leftmost of equals; equal windows have equal anchors at
the same place. Neighbouring windows with one anchor form a stretch of at most
2 * SPAN - K bytes. Stretches travel as hashes; where all stretches with an anchor's gram are
equal, or there is just one, the answer is known without their bytes. For the rest the bytes of
each different stretch are fetched once, and the suffixes at its windows are sorted deep-shallow:
multikey quicksort, eight bytes a step, down to SHALLOW bytes; what still agrees goes to blind
tries, whose nodes hold the length their members share and branch on the word after it, built a
level at a time for all groups at once. Suffixes that agree over SPAN bytes are repeats.

A gram with more than PART stretches is dealt into parts by the stretches' hashes. Each part is
sorted alone, and sends a 128-bit hash of each different window it holds; equal hashes of two
parts are repeats that no part saw alone. A key with more than one row in HOT_SHARE is joined by
broadcast (there are fewer than HOT_SHARE of them), so no task gets all rows of one key.

Stretches of equal gram and hash (64 bits each) are taken for equal, as are windows of two parts
by their 128 bits; all other equalities are of bytes.

Defined cases: null and empty texts have nothing to remove; matches never cross documents;
repeated rows are documents of their own; a null id keeps its row; an empty table gives no
rows; long texts are read in overlapping pieces, so arrays stay small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm import bytesops
from silkgrain.llm.common import stable_rows, table, written

SPAN, K = 200, 64
SHALLOW = 32
PART = 8_000
HOT_SHARE = 4_096
_PIECE = 1 << 19
_KEEP = np.uint64((1 << 64) - (1 << 28))
_LOW = np.uint64((1 << 28) - 1)


def stretches(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """start, n (windows), at (anchor after start), key (the gram's hash), h (the stretch's) of a text."""
    step = _PIECE - SPAN
    for base in range(0, max(len(text) - SPAN + 1, 0), step):
        data = np.frombuffer(text, np.uint8, min(_PIECE - 1, len(text) - base), base)
        n = len(data) - SPAN + 1  # windows; the next piece goes on with the one after
        p1 = bytesops.prefix_sums(data)
        m = len(data) - K + 1
        grams = bytesops.mixed((p1[K:] - p1[:m]) * bytesops.powers(len(p1))[1][:m])
        packed = (grams & _KEEP) | np.arange(m, dtype=np.uint64)
        w = SPAN - K + 1  # the least of w neighbours, by prefix and suffix minima of blocks
        pad = np.full(-m % w, ~np.uint64(0))
        blocks = np.concatenate([packed, pad]).reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(back[:n], ahead[w - 1 : w - 1 + n]) & _LOW).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        count = np.diff(np.append(start, n))
        end = start + count + SPAN - 1
        at = anchor[start]
        yield start + base, count, at - start, grams[at], bytesops.hashes(p1, start, end)


def _stretch_rows(docs: DataFrame) -> DataFrame:
    """rid, place, key, h of every text's stretches (docs: rid, text). place packs start, n and at
    in a long, as each column of a shuffled row takes eight bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0

            def out() -> pa.RecordBatch:
                cols = [np.concatenate(c) for c in zip(*held, strict=True)]  # noqa: B023
                rid, start, n, at, key, h = cols
                place = (start << 16) | (n << 8) | at  # n and at are at most SPAN - K + 1
                return pa.RecordBatch.from_arrays([pa.array(rid), pa.array(place), pa.array(key.view(np.int64)), pa.array(h.view(np.int64))], names=["rid", "place", "key", "h"])

            for rid, text in zip(batch.column(0).to_numpy(zero_copy_only=False), bytesops.texts(batch.column(1)), strict=True):
                for cols in stretches(text):
                    held.append((np.full(len(cols[0]), rid, np.int64), *cols))
                    size += len(cols[0])
                if size > 100_000:
                    yield out()
                    held, size = [], 0
            if held:
                yield out()

    return docs.select("rid", "text").mapInArrow(run, "rid long, place long, key long, h long")


def _words_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as a number in sort order; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(SPAN + 16, np.uint8)]).astype(np.uint64)
    n = len(padded) - 8
    out = padded[:n].copy()
    for k in range(1, 8):
        out = (out << np.uint64(8)) | padded[k : k + n]
    return out


def _regroup(group: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (group, word), and the number of each member's new group in that order."""
    order = np.lexsort((word, group))
    g, w = group[order], word[order]
    return order, np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]) | (w[1:] != w[:-1])]))


def _crowded(group: np.ndarray) -> np.ndarray:
    """Members of groups of two or more; groups are in order."""
    same = group[1:] == group[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same])


def repeated_suffixes(data: np.ndarray, pos: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """For suffixes at pos, of which only those of one group are compared: whether another one
    agrees over SPAN bytes."""
    words = _words_of(data)
    out = np.zeros(len(pos), bool)
    if not len(pos):
        return out
    ident = np.argsort(group, kind="stable")
    group = group[ident]
    for depth in range(0, shallow, 8):  # multikey quicksort on eight bytes
        keep = _crowded(group)
        ident, group = ident[keep], group[keep]
        if not len(ident):
            return out
        order, group = _regroup(group, words[pos[ident] + depth])
        ident = ident[order]
    keep = _crowded(group)
    ident, group = ident[keep], group[keep]
    depths = np.arange(shallow, SPAN, 8)
    while len(ident):  # one level of the blind tries
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(first, len(group)))
        leader = np.repeat(first, size)
        common = np.empty(len(ident), np.int64)
        for k in range(0, len(ident), 1 << 15):
            some = slice(k, k + (1 << 15))
            differ = words[pos[ident[some], None] + depths] != words[pos[ident[leader[some]], None] + depths]
            common[some] = np.where(differ.any(axis=1), differ.argmax(axis=1), len(depths))
        skip = np.repeat(np.minimum.reduceat(common, first), size)
        done = skip == len(depths)
        out[ident[done]] = True
        ident, group, skip = ident[~done], group[~done], skip[~done]
        if not len(ident):
            break
        order, group = _regroup(group, words[pos[ident] + depths[skip]])
        ident = ident[order]
        keep = _crowded(group)
        ident, group = ident[keep], group[keep]
    return out


def _sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, part, h, place, c, split, body) in order of key and part to the windows that repeat: as
    runs (far false; lo, hi) of a stretch's windows. Of a gram with several parts also every
    different window of the part (far true; lo, the window, and its hash in hi and more)."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, part, h, place, c, split, body = zip(*rows, strict=True)
        data = np.frombuffer(b"".join(body), np.uint8)
        packed, key, part, h, c = (np.array(x, np.int64) for x in (place, key, part, h, c))
        n, at = (packed >> 8) & 255, packed & 255
        size = np.fromiter(map(len, body), np.int64, len(body))
        base = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(n)), n)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        kid = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
        group = kid[owner] * SPAN + (at[owner] - place)  # one part of a gram, at one place of the window
        hit = repeated_suffixes(data, base[owner] + place, group) | (c[owner] > 1)
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        cut = np.concatenate([[0], (owner[1:] != owner[:-1]) & hit[1:] & hit[:-1]]).astype(bool) if len(hit) else hit
        lo = np.sort(np.concatenate([np.flatnonzero(edge == 1), np.flatnonzero(cut)]))
        hi = np.sort(np.concatenate([np.flatnonzero(edge == -1), np.flatnonzero(cut)]))
        off = np.cumsum(n) - n
        yield out(key, h, c, owner[lo], False, lo - off[owner[lo]], hi - off[owner[lo]], np.zeros(len(lo), np.int64))
        some = np.flatnonzero(np.array(split)[owner])
        if len(some):
            begin = base[owner[some]] + place[some]
            w = np.stack([bytesops.hashes(bytesops.prefix_sums(data, code), begin, begin + SPAN) for code in (bytesops.CODE, bytesops.CODE_2)])
            order = np.lexsort((w[1], w[0], kid[owner[some]]))
            x = np.stack([kid[owner[some]].astype(np.uint64), *w])[:, order]
            one = order[np.concatenate([[True], (x[:, 1:] != x[:, :-1]).any(axis=0)])]
            yield out(key, h, c, owner[some[one]], True, place[some[one]], w[0][one].view(np.int64), w[1][one].view(np.int64))

    def out(key: np.ndarray, h: np.ndarray, c: np.ndarray, who: np.ndarray, far: bool, *cols: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(who), far)), *(pa.array(x[who]) for x in (key, h, c)), *map(pa.array, cols)], names=["far", "key", "h", "c", "lo", "hi", "more"]
        )

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(rows) >= 3000 and row[:2] != rows[-1][:2]:
                yield from solve(rows)
                rows = []
            rows.append(row)
    if rows:
        yield from solve(rows)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted) to each wanted stretch with its bytes."""
    for batch in batches:
        rows = []
        for text, wanted in zip(bytesops.texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            for w in wanted:
                start, n = w["place"] >> 16, (w["place"] >> 8) & 255
                rows.append((w["key"], w["part"], w["h"], w["place"], w["c"], w["split"], text[start : start + n + SPAN - 1]))
        for k in range(0, len(rows), 10_000):
            cols = zip(*rows[k : k + 10_000], strict=True)
            kinds = (*[pa.int64()] * 5, pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["key", "part", "h", "place", "c", "split", "body"])


def _joined(rows: DataFrame, side: DataFrame, on: list[str], many: str, total: int) -> DataFrame:
    """rows with the columns of side, which holds each key once and, in many, its number of rows."""
    hot, cold = side.where(F.col(many) * HOT_SHARE > total), side.where(F.col(many) * HOT_SHARE <= total)
    if hot.isEmpty():
        return rows.join(cold.drop(many), on)
    rest = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold.drop(many), on)
    return rows.join(F.broadcast(hot.drop(many)), on).unionByName(rest)


def repeated_spans(docs: DataFrame, part: int = PART) -> DataFrame:
    """rid and spans (lo, hi): byte ranges of repeated strings, overlapping and unordered, of the
    texts that have any (docs: rid, text)."""
    rows = written(_stretch_rows(docs))
    total = rows.count()
    grams = rows.groupBy("key").agg(F.count("*").alias("m"), (F.min("h") != F.max("h")).alias("mixed")).where("m > 1")
    grams = written(grams.withColumn("parts", F.ceil(F.col("m") / part)))
    met = written(_joined(rows, grams, ["key"], "m", total))
    start, n = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255)
    whole = met.where("NOT mixed").select("rid", F.array(F.struct(start.alias("lo"), (start + n + SPAN - 1).alias("hi"))).alias("spans"))
    mixed = met.where("mixed").select("rid", "place", "key", "h", "parts")
    kinds = mixed.groupBy("key", "h").agg(F.count("*").alias("c"), F.min(F.struct("rid", "place", "parts")).alias("r"))
    one = F.struct("key", F.pmod("h", "r.parts").alias("part"), "h", F.col("r.place").alias("place"), "c", (F.col("r.parts") > 1).alias("split"))
    wanted = kinds.groupBy("r.rid").agg(F.collect_list(one).alias("wanted"))
    bodies = docs.join(wanted, "rid").select("text", "wanted").mapInArrow(_fetch, "key long, part long, h long, place long, c long, split boolean, body binary")
    found = written(bodies.repartition("key", "part").sortWithinPartitions("key", "part", "h").mapInArrow(_sort_groups, "far boolean, key long, h long, c long, lo long, hi long, more long"))
    far = found.where("far").withColumnsRenamed({"hi": "w1", "more": "w2"})
    often = far.groupBy("w1", "w2").agg(F.count("*").alias("t")).where("t > 1").select("w1", "w2")
    across = far.join(often, ["w1", "w2"]).select("key", "h", "c", "lo", (F.col("lo") + 1).alias("hi"))
    runs = found.where("NOT far").select("key", "h", "c", "lo", "hi").unionByName(across)
    runs = written(runs.groupBy("key", "h").agg(F.first("c").alias("c"), F.collect_list(F.struct("lo", "hi")).alias("runs")))
    held = F.transform("runs", lambda r: F.struct((start + r["lo"]).alias("lo"), (start + r["hi"] + SPAN - 1).alias("hi")))
    return whole.unionByName(_joined(mixed, runs, ["key", "h"], "c", total).select("rid", held.alias("spans")))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the ranges cover."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def deduplicate(docs: DataFrame, part: int = PART, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; kept, the bytes, on request."""
    base = stable_rows(docs.select("doc_id", "text")).select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("text").cast("string").alias("text"))
    found = repeated_spans(base.select("rid", "text"), part).groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for text, spans in zip(bytesops.texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                cut = merged([(s["lo"], s["hi"]) for s in spans or ()])
                kept, at = [], 0
                for lo, hi in cut:
                    kept.append(text[at:lo])
                    at = hi
                rest = b"".join([*kept, text[at:]])
                for col, x in zip(cols, (len(text), len(text) - len(rest), len(cut), hashlib.sha256(rest).hexdigest(), rest if with_text else None), strict=True):
                    col.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = base.join(found, "rid", "left").select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats of 200 bytes leave of every document."""
    return deduplicate(table(spark, sf_dir, "documents", "doc_id", "text"))
