"""SimHash fingerprints and their links by one-wildcard variants of two segments.

Fingerprints that differ in at most three bits differ in at most one bit of either their
upper or their lower half. Each distinct fingerprint is therefore indexed under the 2 * 32
values that arise when one bit of one half is left open; equal values meet, and every pair
that meets is compared. A pair is reported under the first value it shares, so once.

In a value with many fingerprints only a spanning forest of its links is reported, which
loses no component. Beyond SPLIT_ABOVE fingerprints a value is split again in the same way
by the halves of the other half; then at most 2 ** 18 fingerprints can share a value.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and link
like any other; equal texts share a fingerprint; a null id keeps its row and is never a
component's id unless it is alone there; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm import bytesops
from silkgrain.llm.common import table, written
from silkgrain.llm.graph import components

SEED, WORDS, BITS = 42, 3, 3
SPLIT_ABOVE = 20_000
_FOREST_ABOVE = 48


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(j) for j in np.flatnonzero(2 * ones > len(h))))


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a whole text, unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < WORDS:
        slices = [line]
    else:
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
        starts = [0, *(x + 1 for x in ends[: -WORDS])]
        slices = map(line.__getitem__, map(slice, starts, ends[WORDS - 1 :]))
    n = max(1, len(words) - WORDS + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(SEED)), np.uint64, n)
    return majority(h)


def fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and fp, the fingerprint as a signed long, of every row."""
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(x) for x in bytesops.texts(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["id", "fp"])

    out = docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long")
    return out.withColumnRenamed("id", ident)


def _variants(distinct: DataFrame) -> DataFrame:
    """key, fp: the 64 indexed values of each distinct fingerprint, packed in a long."""
    half = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)]
    keys = [F.lit((32 * s + p) << 32).bitwiseOR(half[s].bitwiseAND(0xFFFFFFFF ^ (1 << p))) for s in (0, 1) for p in range(32)]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("key"))


def _split(rows: DataFrame) -> DataFrame:
    """rows of full values under the variants of the other half's halves, in 59 bits."""
    other = F.when(F.shiftrightunsigned("key", 37) == 0, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
    quarter = [F.shiftrightunsigned(other, 16), other.bitwiseAND(0xFFFF)]
    subs = [F.lit((16 * s + p) << 16).bitwiseOR(quarter[s].bitwiseAND(0xFFFF ^ (1 << p))) for s in (0, 1) for p in range(16)]
    return rows.select("fp", F.explode(F.array(*subs)).alias("sub"), "key").select("fp", F.shiftleft("key", 21).bitwiseOR(F.col("sub")).alias("key"))


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    left, a, b = fps, [], []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            found = np.zeros(len(left), bool)
            parent = np.zeros(len(left), np.int64)
            for i, x in enumerate(front):
                near = np.bitwise_count(left ^ x) <= BITS
                parent[near & ~found] = i
                found |= near
            a.append(front[parent[found]])
            b.append(left[found])
            front, left = left[found], left[~found]
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def _link(batches: Iterator[pa.RecordBatch], limit: int | None, first_only: bool) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) in order of key to edges (a, b) and, above limit, rows to split (key, fp)."""

    def edges(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(start, len(keys)))
        of = np.repeat(size, size)
        a, b = [], []
        small = of <= _FOREST_ABOVE
        k, f = keys[small], fps[small]
        for step in range(1, min(_FOREST_ABOVE, len(k))):
            same = np.flatnonzero(k[step:] == k[:-step])
            if not len(same):
                break
            x, y = f[same], f[same + step]
            diff = x ^ y
            ok = np.bitwise_count(diff) <= BITS
            if first_only:
                at = (k[same] >> 32).astype(np.int64)
                upper, lower = diff >> np.uint64(32), diff & np.uint64(0xFFFFFFFF)
                place = lambda d: np.where(d == 0, 0, np.bitwise_count(np.maximum(d, 1) - np.uint64(1)))
                first = np.where(np.bitwise_count(upper) <= 1, place(upper), 32 + place(lower))
                ok &= first == at
            a.append(x[ok])
            b.append(y[ok])
        for s, n in zip(start[size > _FOREST_ABOVE], size[size > _FOREST_ABOVE], strict=True):
            x, y = _forest(fps[s : s + n])
            a.append(x)
            b.append(y)
        if a and len(x := np.concatenate(a)):
            yield out(np.zeros(len(x), np.int8), x, np.concatenate(b))

    def out(kind: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "a", "b"])

    keys, fps, full = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
    for batch in batches:
        k = batch.column(0).to_numpy(zero_copy_only=False)
        f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if full is not None:  # the value that is being passed on goes on
            n = int(np.searchsorted(k, full, "right"))
            if n:
                yield out(np.ones(n, np.int8), k[:n], f[:n])
            k, f = k[n:], f[n:]
            if not len(k):
                continue
            full = None
        keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if last:
            yield from edges(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
        if limit and len(keys) > limit:
            yield out(np.ones(len(keys), np.int8), keys, fps)
            full, keys, fps = keys[0], keys[:0], fps[:0]
    if len(keys):
        yield from edges(keys, fps)


def links(distinct: DataFrame, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough of them for every component."""
    shape = "kind byte, a long, b long"
    by_key = lambda rows: rows.select("key", "fp").repartition("key").sortWithinPartitions("key")
    met = written(by_key(_variants(distinct)).mapInArrow(lambda x: _link(x, split_above, True), shape))
    again = met.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    found = by_key(_split(again)).mapInArrow(lambda x: _link(x, None, False), shape)
    return met.where("kind = 0").unionByName(found).select("a", "b")


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """id, fp and component_id, the smallest id that links reach."""
    prints = written(fingerprints(docs, ident, text))
    distinct = written(prints.groupBy("fp").agg(F.min(ident).alias("low")))
    comp = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    rooted = distinct.join(comp, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "component_id"), "fp")


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
