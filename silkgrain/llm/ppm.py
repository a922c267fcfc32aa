"""Language-model scores: word counts as a base, prediction by partial matching as the model.

A text is read as the bytes of its lower-cased words, a STOP after each, and an END. The model is
a trie of byte contexts of up to ORDER bytes, across words, pretrained on the training documents.
In the longest context that training has, a symbol seen c times of n has probability
(2c - 1) / 2n, and the d different symbols leave d / 2n for an escape to the context one byte
shorter, where symbols of the longer context no longer count (symbol exclusion). Below the empty
context all bytes that were never seen are equal. A text's score is the sum over its symbols.

All contexts of all training documents are kept. The probability of a symbol depends on the ORDER
bytes before it alone, so blocks of documents send their distinct grams (context and symbol) and
their distinct words, cut into parts; a task for each part adds up the counts, in constant memory
beyond its distinct keys. Grams with the same last LOW + 1 context bytes share a part, so a part
holds every count that its longer contexts need; contexts of up to LOW bytes, at most 2 ** 24
entries whatever the corpus, go to all tasks. Then a block's keys meet the parts' results by
equality, and its texts are summed up where these come back.

Defined cases: a null text counts as empty, and has only its end; a null id counts as empty
text for the folds; repeated rows count again; an empty table gives no rows; without training
documents every count is zero and bytes are uniform. Words and texts of any length are read whole.
Other columns are ignored. Word hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm import bytesops
from silkgrain.llm.common import fold_of, stable_rows, table, written

FOLDS, HELD_OUT = 10, 0
ORDER, LOW = 5, 2
ALPHA = 0.1
STOP, END = b" ", b"\xff"  # no UTF-8 text holds the byte of END
WORDS, GRAMS = 0, 1
_BLOCK = 16 << 20
_PIECE = 2 << 20
SHAPE = "block long, part int, kind int, keys binary, more binary"


def counted(x: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often (or with what total weight) they occur."""
    if not len(x):
        return x, np.zeros(0, np.int64)
    order = None if weight is None else np.argsort(x, kind="stable")
    x = np.sort(x) if order is None else x[order]
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    n = np.diff(np.append(first, len(x))) if weight is None else np.add.reduceat(weight[order], first)
    return x[first], n.astype(np.int64)


class Block:
    """Some documents' symbols in one string; before each text stand ORDER stops, its first context."""

    def __init__(self, ids: list, held: list[bool], texts: list[bytes]) -> None:
        self.ids, self.held = ids, np.array(held, bool)
        self.data = b"".join(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.start = np.cumsum(size) - size

    @staticmethod
    def symbols(text: bytes) -> bytes:
        words = text.lower().split()
        return STOP * ORDER + STOP.join(words) + (STOP if words else b"") + END

    def pieces(self) -> Iterator[tuple[int, int]]:
        """Ranges that end after a stop or an end, of about _PIECE bytes."""
        at, size = 0, len(self.data)
        while at < size:
            to = size
            if size - at > _PIECE:
                to = self.data.rfind(STOP, at, at + _PIECE) + 1
                if to <= at:
                    to = (self.data.find(STOP, at + _PIECE) + 1) or size
            yield at, to
            at = to

    def spread(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents in which places in order lie, and where each one's places begin."""
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo, hi = np.searchsorted(self.start, [at[0], at[-1]], "right")
        begin = np.concatenate([[0], np.searchsorted(at, self.start[lo:hi])]).astype(np.int64)
        return np.arange(lo - 1, hi), begin

    def docs_of(self, at: np.ndarray) -> np.ndarray:
        doc, begin = self.spread(at)
        return np.repeat(doc, np.diff(np.append(begin, len(at))))

    def words(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of a piece's words (ends are words too) and their places."""
        data = np.frombuffer(self.data, np.uint8, b - a, a)
        start, end = bytesops.word_bounds(data)
        return bytesops.hashes(bytesops.prefix_sums(data), start, end), start + a

    def grams(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """A piece's grams, the nearest context byte highest and the symbol lowest, and their places."""
        lo = max(a, ORDER)
        data = np.frombuffer(self.data, np.uint8, b - lo + ORDER, lo - ORDER).astype(np.uint64)
        n = b - lo
        out = data[ORDER:].copy()
        for k in range(1, ORDER + 1):
            out |= data[ORDER - k : ORDER - k + n] << np.uint64(8 * (ORDER + 1 - k))
        some = self.start[np.searchsorted(self.start, lo - ORDER) : np.searchsorted(self.start, b)]
        pad = (some[:, None] + np.arange(ORDER)).ravel() - lo
        real = np.ones(n, bool)
        real[pad[(pad >= 0) & (pad < n)]] = False
        at = np.flatnonzero(real)
        return out[at], at + lo

    def tally(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's distinct keys in order, with their counts in training documents."""
        keys, counts = [], []
        for a, b in self.pieces():
            x, where = self.symbols_of(kind, a, b)
            train = ~self.held[self.docs_of(where)] if self.held.any() else np.ones(len(x), bool)
            seen, n = counted(x[train])
            other = np.unique(x[~train])
            keys += [seen, other]
            counts += [n, np.zeros(len(other), np.int64)]
        return counted(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def symbols_of(self, kind: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        return self.words(a, b) if kind == WORDS else self.grams(a, b)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    """Documents in blocks of about _BLOCK bytes; the block's number holds the partition's. A
    partition is cut into the same blocks whenever it is read."""
    number, now, size = None, ([], [], []), 0
    for batch in batches:
        if number is None and batch.num_rows:
            number = batch.column(3)[0].as_py() << 24
        ids, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for i, h, text in zip(ids, held, bytesops.texts(batch.column(1)), strict=True):
            for column, x in zip(now, (i, h, Block.symbols(text)), strict=True):
                column.append(x)
            size += len(now[2][-1])
            if size >= _BLOCK:
                yield number, Block(*now)
                number, now, size = number + 1, ([], [], []), 0
    if now[0]:
        yield number, Block(*now)


def numbered(docs: DataFrame) -> DataFrame:
    """What blocks() reads; the number is the scan's partition, also below a union."""
    return docs.select("doc_id", "text", "held_out", F.spark_partition_id().alias("number"))


def parted(keys: np.ndarray, kind: int, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that keys in order have, with their places; words go by hash, grams by the hash
    of their last LOW + 1 context bytes."""
    if not len(keys):
        return
    spread = keys if kind == WORDS else bytesops.mixed(keys >> np.uint64(8 * (ORDER - LOW)))
    part = ((spread >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    cut = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    for p in range(parts):
        if cut[p] < cut[p + 1]:
            yield p, order[cut[p] : cut[p + 1]]


def _row(block: int, part: int, kind: int, keys: bytes, more: bytes) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((block, part, kind, keys, more), kinds, strict=True)], names=["block", "part", "kind", "keys", "more"])


def send(docs: DataFrame, parts: int) -> DataFrame:
    """SHAPE: the distinct keys of each block with their counts, a row for each kind and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in blocks(batches):
            for kind in (WORDS, GRAMS):
                keys, n = block.tally(kind)
                for p, at in parted(keys, kind, parts):
                    yield _row(number, p, kind, keys[at].tobytes(), n[at].astype(np.int32).tobytes())

    return numbered(docs).mapInArrow(run, SHAPE)


def merge(sent: DataFrame, parts: int) -> DataFrame:
    """SHAPE with block -1: the distinct keys of each kind and part with the sums of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, waiting = None, [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0

        def joined() -> tuple[np.ndarray, np.ndarray]:
            return counted(*map(np.concatenate, zip(*held, strict=True)))

        for batch in batches:
            for part, kind, keys, more in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True):
                if now is not None and (part, kind) != now:
                    yield _row(-1, *now, *(x.tobytes() for x in joined()))
                    held, waiting = held[:0], 0
                now = (part, kind)
                held.append((np.frombuffer(keys, np.uint64), np.frombuffer(more, np.int32).astype(np.int64)))
                waiting += len(held[-1][0])
                if waiting > 2_000_000 and waiting > len(held[0][0]):  # then sums take the place of rows
                    held, waiting = [joined()], 0
        if now is not None:
            yield _row(-1, *now, *(x.tobytes() for x in joined()))

    return sent.repartition(parts, "part", "kind").sortWithinPartitions("part", "kind").mapInArrow(run, SHAPE)


@dataclass
class Level:
    """All (context, symbol) entries of one order: packed keys in order, counts, the number n and
    kinds d of symbols seen in each entry's context, the symbol's probability p there, and past,
    its probability once the context was left by an escape."""

    keys: np.ndarray
    count: np.ndarray
    n: np.ndarray
    d: np.ndarray
    p: np.ndarray
    past: np.ndarray


def level(keys: np.ndarray, count: np.ndarray, below: Level | None, order: int) -> Level:
    """The entries of an order, from those of the order below, which has all that these need."""
    symbol, seen = keys & np.uint64(255), count > 0
    context = keys >> np.uint64(8)
    cid = np.cumsum(np.concatenate([[0], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
    many = int(cid[-1]) + 1 if len(keys) else 0
    n = np.bincount(cid, count, many)[cid].astype(np.int64)
    d = np.bincount(cid, seen, many)[cid].astype(np.int64)
    if below is None:
        past = np.full(len(keys), 1.0 / max(256 - int(seen.sum()), 1))
    else:
        # the shorter context lacks its furthest byte, which is the lowest of the packed context
        up = np.searchsorted(below.keys, ((keys >> np.uint64(16)) << np.uint64(8)) | symbol)
        c, left_d = below.count[up], below.d[up] - d
        left_n = below.n[up] - np.bincount(cid, np.where(seen, c, 0), many)[cid].astype(np.int64)
        some = np.maximum(2 * left_n, 1)
        past = np.where(left_n == 0, below.past[up], np.where(c > 0, (2 * c - 1) / some, left_d / some * below.past[up]))
    some = np.maximum(2 * n, 1)
    p = np.where(seen, (2 * count - 1) / some, np.where(n > 0, d / some * past, past))
    return Level(keys, count, n, d, p, past)


def entries(grams: np.ndarray, count: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams in order to the entries of a lower order, with sums."""
    if order == ORDER:
        return grams, count
    context = grams >> np.uint64(8 * (ORDER - order + 1))
    return counted((context << np.uint64(8)) | (grams & np.uint64(255)), count)


def low_levels(keys: np.ndarray, count: np.ndarray) -> Level:
    """The level of order LOW, from all its entries."""
    now = None
    for order in range(LOW + 1):
        short = ((keys >> np.uint64(8 * (LOW - order + 1))) << np.uint64(8)) | (keys & np.uint64(255))
        now = level(*counted(short, count), now, order)
    return now


def log_probabilities(grams: np.ndarray, count: np.ndarray, low: Level) -> np.ndarray:
    """log10 of each gram's probability; grams in order, all those of a part."""
    now = low
    for order in range(LOW + 1, ORDER + 1):
        now = level(*entries(grams, count, order), now, order)
    return np.log10(now.p)


def _low_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, n = entries(np.frombuffer(keys, np.uint64), np.frombuffer(more, np.int64), LOW)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)), pa.array(n)], names=["low", "n"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in n], pa.int64()), pa.array([int((x > 0).sum()) for x in n], pa.int64())], names=["n", "v"])


def look_up(merged: DataFrame, asked: DataFrame, low: object, parts: int) -> DataFrame:
    """SHAPE: each row asked with the values of its keys (in more): counts of words, log10
    probabilities of grams. low: a broadcast Level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = value = None
        for batch in batches:
            for block, part, kind, k, more in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if block < 0:  # stands before the rows that ask
                    keys, value = np.frombuffer(k, np.uint64), np.frombuffer(more, np.int64)
                    if kind == GRAMS:
                        value = log_probabilities(keys, value, low.value).astype(np.float32)
                else:
                    yield _row(block, part, kind, k, value[np.searchsorted(keys, np.frombuffer(k, np.uint64))].tobytes())

    return merged.unionByName(asked).repartition(parts, "part", "kind").sortWithinPartitions("part", "kind", "block").mapInArrow(run, SHAPE)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark, kind_of = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    held = (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    docs = stable_rows(docs.select("doc_id", "text")).select("doc_id", F.col("text").cast("string").alias("text"), held)
    # Parts follow the input: there are as many tasks at least as it has splits.
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    sent = written(send(docs, parts))
    merged = written(merge(sent, parts))
    sums = merged.where(F.col("kind") == WORDS).select("more").mapInArrow(_sums, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n, v = int(sums[0] or 0), int(sums[1] or 0)
    rows = merged.where(F.col("kind") == GRAMS).select("keys", "more").mapInArrow(_low_rows, "low long, n long")
    rows = rows.groupBy("low").agg(F.sum("n").alias("n")).toArrow()  # at most 2 ** 24 rows
    order = np.argsort(rows["low"].to_numpy())
    low = spark.sparkContext.broadcast(low_levels(rows["low"].to_numpy()[order].astype(np.uint64), rows["n"].to_numpy()[order]))
    values = look_up(merged, sent.withColumn("more", F.lit(b"")), low, parts)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's documents, to where its values go."""
        for number, block in blocks(batches):
            lengths = np.diff(np.append(block.start, len(block.data)))
            t = pa.table({"id": pa.array(block.ids, id_type), "held": pa.array(block.held), "size": pa.array(lengths)})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema) as w:
                w.write_table(t)
            yield _row(number, -1, -1, pa.compress(block.data, "zstd", asbytes=True), sink.getvalue().to_pybytes())

    id_type = docs.limit(0).toArrow().schema.field("doc_id").type
    floor = np.log10(n + ALPHA * (v + 1)) if n else 0.0

    def summed(info: bytes, body: bytes, got: dict[int, list[tuple[bytes, bytes]]]) -> pa.RecordBatch:
        t = pa.ipc.open_stream(info).read_all()
        size = t["size"].to_numpy()
        data = pa.decompress(body, int(size.sum()), "zstd", asbytes=True)
        at = np.cumsum(size) - size
        block = Block([], t["held"].to_pylist(), [data[a : a + k] for a, k in zip(at, size, strict=True)])
        value = {}
        for kind, dtype in ((WORDS, np.int64), (GRAMS, np.float32)):
            keys, found = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*got[kind], strict=True), (np.uint64, dtype), strict=True))
            order = np.argsort(keys)
            value[kind] = keys[order], found[order].astype(np.float64)
        many = len(size)
        total, base, tokens, known = (np.zeros(many) for _ in range(4))
        for a, b in block.pieces():
            h, where = block.words(a, b)
            c = value[WORDS][1][np.searchsorted(value[WORDS][0], h)]
            doc, begin = block.spread(where)
            tokens[doc] += np.diff(np.append(begin, len(h)))
            known[doc] += np.add.reduceat((c > 0).astype(np.int64), begin)
            base[doc] += np.add.reduceat(np.log10(c + ALPHA), begin)
            g, where = block.grams(a, b)
            order = np.argsort(g)
            x = g[order]
            first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            p = np.empty(len(g))
            p[order] = np.repeat(value[GRAMS][1][np.searchsorted(value[GRAMS][0], x[first])], np.diff(np.append(first, len(x))))
            doc, begin = block.spread(where)
            total[doc] += np.add.reduceat(p, begin)
        whole = lambda x: pa.array(x.astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [t["id"].combine_chunks(), t["held"].combine_chunks(), whole(tokens), whole(known), whole(np.full(many, n)), pa.array(base - tokens * floor), pa.array(total)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block: first its documents (part -1), then values by part."""
        now, text, got = None, None, {}
        for batch in batches:
            for block, part, kind, keys, more in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if part < 0:
                    if now is not None:
                        yield summed(*text, got)
                    now, text, got = block, (more, keys), {WORDS: [], GRAMS: []}
                else:
                    got[kind].append((keys, more))
        if now is not None:
            yield summed(*text, got)

    both = numbered(docs).mapInArrow(own, SHAPE).unionByName(values)
    shape = f"doc_id {kind_of}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return both.repartition(4 * parts, "block").sortWithinPartitions("block", "part").mapInArrow(answer, shape)


def op7_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return score(table(spark, sf_dir, "documents", "doc_id", "text"))
