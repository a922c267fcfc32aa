"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Equal sets are one node. Candidates are found by op6's method, SimHash fingerprints of the sets
linked by deletion variants at simhash.BITS bits or fewer. A pair at 0.8 differs in some ten of 64
bits, which that index can't reach, so candidates also meet in BANDS bands of ROWS min-hashes;
there a pair at 0.8 shares a band with probability 1 - (1 - 0.8 ** 4) ** 20 = 0.99997, a nearer one
still more surely. Every link that is reported was checked on the whole shingle sets. First each
member of a bucket is checked against the bucket's least one; in buckets that still hold several components the rest of
the pairs are checked too, so that no component is lost however large a bucket is.

Defined cases: texts of 1 to WORDS - 1 words have one shingle, all their words; null, empty and
blank texts have the empty set and are copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silkgrain.llm import bytesops, simhash
from silkgrain.llm.common import written
from silkgrain.llm.graph import components

WORDS, BANDS, ROWS = 5, 20, 4
#: Least similarity, as a fraction.
LEAST = (4, 5)
_FACTORS = np.random.default_rng(21).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = bytesops.mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).reshape(BANDS, ROWS)


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingles of a whole text, as sorted hashes."""
    line = np.frombuffer(b" ".join(text.lower().split()), np.uint8)
    start, end = bytesops.word_bounds(line)
    if not len(start):
        return np.zeros(0, np.uint64)
    n = min(WORDS, len(start))
    return np.unique(bytesops.hashes(bytesops.prefix_sums(line), start[: len(start) - n + 1], end[n - 1 :]))


def bands(h: np.ndarray) -> np.ndarray:
    """One key for each band of a set of shingles."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(h), 2048):
        np.minimum(low, (h[k : k + 2048, None] * _FACTORS).min(axis=0), out=low)
    return bytesops.mixed(bytesops.mixed(low.reshape(BANDS, ROWS) ^ _PLACES).sum(axis=1, dtype=np.uint64))


def fingerprint(h: np.ndarray) -> int:
    """The SimHash of a set of shingles: bits that over half of the hashes have."""
    return simhash.majority(bytesops.mixed(h))


def _prints(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """ident, sid (a hash of the set), n, fp (the fingerprint) and keys of every row."""
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, size, fp, keys = [], [], [], []
            for x in bytesops.texts(batch.column(1)):
                h = shingles(x)
                sid.append(xxhash.xxh64_intdigest(h.tobytes()) if len(h) else 0)
                size.append(len(h))
                fp.append(fingerprint(h))
                keys.append(bands(h).view(np.int64) if len(h) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(sid, np.uint64).view(np.int64)), pa.array(size, pa.int64()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], names=["id", "sid", "n", "fp", "keys"])

    out = docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text"))
    return out.mapInArrow(run, f"id {kind}, sid long, n long, fp long, keys array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    """sid and h, the shingles, of rows (sid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x in enumerate(bytesops.texts(batch.column(1))):
                h = pa.array([shingles(x).view(np.int64)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), h], names=["sid", "h"])

    return texts.select("sid", "text").mapInArrow(run, "sid long, h array<long>")


def alike(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return LEAST[1] * inter >= LEAST[0] * (a + b - inter)


def bridges(roots: np.ndarray, at: np.ndarray, flat: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of members (sets flat[at[i]:at[i + 1]]) of different roots that are near copies,
    one at least for each member and other root. The largest root's members are only looked up."""
    cols = np.unique(flat, return_inverse=True)[1].reshape(-1)
    mark, n, out = np.zeros(len(flat), bool), np.diff(at), []
    group, size = np.unique(roots, return_inverse=True, return_counts=True)[1:]
    for i in np.flatnonzero(group != size.argmax()):
        mine = cols[at[i] : at[i + 1]]
        mark[mine] = True
        near = alike(np.add.reduceat(mark[cols].astype(np.int64), at[:-1]), n[i], n) & (group != group[i])
        mark[mine] = False
        found = np.flatnonzero(near)
        out += [(int(i), int(found[k])) for k in np.unique(group[found], return_index=True)[1]]
    return out


def _bridged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, sid, root, h) in order of key to edges (a, b) inside each key."""

    def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        sid, root = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
        if len(sid) > 1 and (root != root[0]).any():
            at = np.concatenate([[0], np.cumsum(np.concatenate([r[2] for r in rows]))])
            pairs = np.array(bridges(root, at, np.concatenate([r[3] for r in rows])), np.int64).reshape(-1, 2)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(sid[pairs[:, 0]]), pa.array(sid[pairs[:, 1]])], names=["a", "b"])

    last, rows = None, []
    for batch in batches:
        key, sid, root = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        size = np.array(batch.column(3).value_lengths().to_numpy(zero_copy_only=False), np.int64)
        flat, ends = batch.column(3).flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if rows and key[s] != last:
                yield from out(rows)
                rows = []
            last = key[s]
            rows.append((sid[s:e].copy(), root[s:e].copy(), size[s:e], flat[ends[s] : ends[e]].copy()))
    if rows:
        yield from out(rows)


def simhash_pairs(prints: DataFrame) -> DataFrame:
    """Candidates a, an, b, bn by fingerprints: sets of one fingerprint with its least set, and least sets of linked fingerprints."""
    sets = prints.where("n > 0").groupBy("sid").agg(F.min("n").alias("n"), F.min("fp").alias("fp"))
    sets = written(sets)
    least = sets.groupBy("fp").agg(F.min(F.struct("sid", "n")).alias("low"))
    low = least.select("fp", F.col("low.sid").alias("sid"), F.col("low.n").alias("n"))
    same = sets.join(low.select("fp", F.col("sid").alias("a"), F.col("n").alias("an")), "fp").where("sid <> a").select("a", "an", F.col("sid").alias("b"), F.col("n").alias("bn"))
    side = lambda k: low.select(F.col("fp").alias(k), F.col("sid").alias(f"{k}sid"), F.col("n").alias(f"{k}n"))
    linked = simhash.links(least.select("fp")).join(side("a"), "a").join(side("b"), "b").select(F.col("asid").alias("a"), "an", F.col("bsid").alias("b"), "bn")
    return same.unionByName(linked)


def near_copies(docs: DataFrame, ident: str, text: str = "text") -> DataFrame:
    """ident and root, equal for the rows of one component; ident must tell rows apart."""
    prints = written(_prints(docs, ident, text))
    met = prints.select("sid", "n", F.explode("keys").alias("key")).distinct()
    many = met.groupBy("key").agg(F.count("*").alias("members"), F.min(F.struct("sid", "n")).alias("low")).where("members > 1")
    met = written(met.join(many, "key").select("key", "members", "sid", "n", F.col("low.sid").alias("a"), F.col("low.n").alias("an")))

    by_print = simhash_pairs(prints)
    near = lambda p: p.where(LEAST[1] * F.least("an", "bn") >= LEAST[0] * F.greatest("an", "bn"))
    by_print = written(near(by_print))
    wanted = met.select("sid").unionByName(by_print.select(F.col("a").alias("sid"))).unionByName(by_print.select(F.col("b").alias("sid")))

    first = prints.join(wanted.distinct(), "sid", "left_semi").groupBy("sid").agg(F.min("id").alias("id"))
    sets = written(_sets(docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text")).join(first, "id")))

    stars = met.where(F.col("a") != F.col("sid")).select("a", "an", F.col("sid").alias("b"), F.col("n").alias("bn"))
    stars = near(stars).unionByName(by_print).distinct()
    pairs = stars.join(sets.select(F.col("sid").alias("a"), F.col("h").alias("ah")), "a").join(sets.select(F.col("sid").alias("b"), F.col("h").alias("bh")), "b")
    inter = F.size(F.array_intersect("ah", "bh")).cast("long")
    edges = written(pairs.where(LEAST[1] * inter >= LEAST[0] * (F.col("an") + F.col("bn") - inter)).select("a", "b"))

    rooted = met.where("members > 2").select("key", "sid").join(components(edges).withColumnRenamed("node", "sid"), "sid", "left")
    rooted = rooted.select("key", "sid", F.coalesce("root", "sid").alias("root"))
    torn = rooted.groupBy("key").agg((F.min("root") != F.max("root")).alias("torn")).where("torn").select("key")
    rest = rooted.join(torn, "key").join(sets, "sid").select("key", "sid", "root", "h")
    more = written(rest.repartition("key").sortWithinPartitions("key").mapInArrow(_bridged, "a long, b long"))

    comp = components(edges.unionByName(more)).withColumnRenamed("node", "sid")
    return prints.join(comp, "sid", "left").select(F.col("id").alias(ident), F.coalesce("root", "sid").alias("root"))
