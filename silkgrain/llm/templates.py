"""Benchmark decontamination by windows of templates.

Words are canonicalised: numbers (digits or NUMBER_WORDS), names (capitalised inside a sentence,
with a small letter) and units (after a number) become typed slots, other words lose case and
punctuation. Windows of WINDOW words
are hashed and equality-joined between documents and benchmark items. Windows of one document
and item that lie in the same shift form an alignment; in it a name of the item must stand for
one name of the document, else the likeness is chance and its windows don't count. Of a number
or unit that stands for several the most frequent counts, and windows with the others don't.
What remains is the share of the item's windows that the document holds; from COVERAGE on it
counts as a copy, re-parameterised or not.

A window with more than SLOTS slots (or under three plain words) is indexed twice: with its
fillers, which alone is evidence, and with typed slots, which counts only in an alignment that
has evidence besides. So number-dense items are found as exact copies at least. A capitalised word
that begins a sentence may be a name or not: its windows are also indexed with a name in its
place, as supporting windows of that sort; such a word doesn't rule a place out.

The windows of all items go to every task only while there are at most MAX_SENT of them, of at
most MAX_BYTES with their fillers; beyond that both sides' windows are shuffled and joined.

Defined cases: null and empty texts have no windows; items with a null id are left out; columns
other than the id and text are ignored; items of 3 to WINDOW - 1 words have one
window of their own length; of one or two words, a document is a copy if it has just these words; repeated rows of one id are one document, of
null id too; empty tables give no rows. Whole texts are read, in overlapping pieces if long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silkgrain.llm import bytesops
from silkgrain.llm.common import table, written

WINDOW, SLOTS, COVERAGE = 8, 3, 0.5
MAX_SENT, MAX_BYTES = 1_000_000, 64 << 20
_PIECE = 1 << 20
UNITS = (
    "mm cm m km in ft mile miles meter meters metre metres g kg mg t ton tons lb lbs oz l ml liter liters litre litres "
    "s ms h hr hrs min second seconds minute minutes hour hours day days week weeks month months year years "
    "percent degree degrees c f k w kw v hz khz mhz ghz b kb mb gb tb usd eur dollar dollars euro euros cent cents"
).split()
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()

_KEEP = np.zeros(256, bool)
_KEEP[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_KEEP[128:] = True
_ENDS = np.zeros(256, np.int32)
_ENDS[list(b".!?:\n")] = 1
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x1F3D5B79, 0x2E4C6A88, 0x3D5B7997))
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Kinds of fillers: numbers and units, names, and words that begin a sentence.
PLAIN, NAMED, OPENING = 0, 1, 2
#: Kinds of windows, kept above the size in n: with its fillers, with typed slots only, and a whole short text.
EXACT, DENSE, WHOLE = 1 << 8, 2 << 8, 3 << 8


def _word_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return bytesops.hashes(bytesops.prefix_sums(data), *bytesops.word_bounds(data))


_UNIT_HASHES, _NUMBER_HASHES = np.sort(_word_hashes(UNITS)), np.sort(_word_hashes(NUMBER_WORDS))


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where bytes begin a capital, and where they begin or end a small letter; ASCII and Latin-1."""
    latin = np.zeros(len(data), np.uint8)  # the second byte after 0xC3
    latin[:-1] = np.where(data[:-1] == 0xC3, data[1:], 0)
    capital = ((data >= 65) & (data <= 90)) | ((latin >= 0x80) & (latin <= 0x9E) & (latin != 0x97))
    return capital, ((data >= 97) & (data <= 122)) | ((latin >= 0x9F) & (latin != 0xB7))


def _among(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(len(x), bool)
    at = np.searchsorted(found, x)
    return found[np.minimum(at, len(found) - 1)] == x


def _lowered(text: bytes) -> bytes:
    """The text in lower case, byte for byte in place: letters whose lower case has another
    length stay as they are."""
    chars = text.decode("utf-8", "surrogateescape")
    low = chars.lower().encode("utf-8", "surrogateescape")
    if len(low) != len(text):
        same = lambda c: c.lower() if len(c.lower().encode("utf-8", "surrogateescape")) == len(c.encode("utf-8", "surrogateescape")) else c
        low = "".join(map(same, chars)).encode("utf-8", "surrogateescape")
    return low


class Template:
    """The canonical words of some bytes: h (hash or slot), slot flags, and where they are."""

    def __init__(self, text: bytes) -> None:
        raw = np.frombuffer(text, np.uint8)
        space = bytesops.IS_SPACE[raw]
        kept = np.flatnonzero(_KEEP[raw] | space)
        data = raw[kept]
        start, end = bytesops.word_bounds(data)
        low = np.frombuffer(_lowered(text), np.uint8)[kept]
        h = bytesops.hashes(bytesops.prefix_sums(low), start, end)
        capital, small = _letters(data)
        small = np.concatenate([[0], np.cumsum(small, dtype=np.int32)])
        self.at, self.to = (kept[start], kept[end - 1] + 1) if len(start) else (start, end)
        ends = np.concatenate([[0], np.cumsum(_ENDS[raw], dtype=np.int32)])[self.at]
        inside = np.concatenate([[False], ends[1:] == ends[:-1]])[: len(start)]
        first = data[start]
        number = ((first >= 48) & (first <= 57)) | _among(h, _NUMBER_HASHES)
        proper = capital[start] & (small[end] > small[start]) & (end - start > 1) & ~number
        name, opening = proper & inside, proper & ~inside
        unit = np.concatenate([[False], number[:-1]])[: len(start)] & ~number & _among(h, _UNIT_HASHES)
        opening &= ~unit
        self.text, self.slot, self.raw, self.opening = text, number | name | unit, h, opening
        self.kind = np.where(opening, OPENING, np.where(name & ~unit, NAMED, PLAIN))
        self.h = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, h)))

    def windows(self, n: int, slots: int = SLOTS) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(n and kind, hashes, first words) of all windows: those with at least n - slots plain
        words (3 at least), the others as EXACT and as DENSE, and those with opening words as DENSE."""
        m = len(self.h) - n + 1
        if m <= 0:
            return []
        many = np.concatenate([[0], np.cumsum(self.slot)])
        plain = n - (many[n:] - many[:-n]) >= max(min(3, n), n - slots)
        opened = np.concatenate([[0], np.cumsum(self.opening)])
        good, dense = np.flatnonzero(plain), np.flatnonzero(~plain)
        open_ = np.flatnonzero(~plain | (opened[n:] > opened[:-n]))
        typed = self._hashed(np.where(self.opening, NAME, self.h), n)
        return [(n, self._hashed(self.h, n)[good], good), (n | EXACT, self._hashed(self.raw, n)[dense], dense), (n | DENSE, typed[open_], open_)]

    @staticmethod
    def _hashed(h: np.ndarray, n: int) -> np.ndarray:
        w = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            w = (w ^ h[k : k + len(w)]) * _MIX
            w ^= w >> np.uint64(29)
        return w

    def fillers(self, first: int, n: int) -> list[tuple[int, str]]:
        """Kind and text of a window's slots, in order; opening words are slots in DENSE windows."""
        dense = n & ~255 == DENSE
        return [
            (int(self.kind[k]), self.text[self.at[k] : self.to[k]].decode("utf-8", "replace"))
            for k in range(first, first + (n & 255)) if self.slot[k] or (dense and self.opening[k])
        ]


SHAPE = "h long, n int, pos long, words long, fill array<struct<k int, t string>>"


def _rows(text: bytes, sizes: list[int], sent: dict[int, np.ndarray] | None) -> Iterator[tuple]:
    """(h, n with kind, pos, words, fill) of a text's windows; only of those in sent, where that is given."""
    before, base = b"", 0
    cut = list(bytesops.pieces(text, _PIECE)) if len(text) > _PIECE else [text]
    for piece in cut:
        t = Template(before + piece)
        found = [x for n in sizes if n > 2 for x in t.windows(n)]
        if len(cut) == 1 and len(t.h) in sizes and len(t.h) <= 2:
            n = len(t.h)
            found.append((n | WHOLE, t._hashed(t.raw, n), np.zeros(1, np.int64)))
        if sent is not None:
            kept = []
            for n, h, first in found:
                hit = _among(h, sent.get(n, h[:0]))
                kept.append((n, h[hit], first[hit]))
            evidence = len(cut) > 1 or any(len(h) for n, h, _ in kept if n & ~255 != DENSE)
            found = [x for x in kept if evidence or x[0] & ~255 != DENSE]
        for n, h, first in found:
            for x, p in zip(h.view(np.int64).tolist(), first.tolist(), strict=True):
                yield x, n, base + p, len(t.h), t.fillers(p, n)
        if len(cut) > 1:
            back = max(0, len(t.h) - max(sizes) + 1)
            before = t.text[t.at[back] :] if len(t.h) else b""
            base += back


def _windows(df: DataFrame, ident: str, sizes: list[int] | None, sent: dict[int, np.ndarray] | None = None) -> DataFrame:
    """ident and SHAPE. sizes None: each text's own size, at most WINDOW."""
    kind = df.schema[ident].dataType.simpleString()
    fields = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct([("k", pa.int32()), ("t", pa.string())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []

            def out() -> pa.RecordBatch:
                cols = zip(*rows, strict=True)
                return pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), *(pa.array(c, t) for c, t in zip(cols, fields, strict=True))], names=[ident, "h", "n", "pos", "words", "fill"])  # noqa: B023

            for i, text in zip(batch.column(0).to_pylist(), bytesops.texts(batch.column(1)), strict=True):
                own = sizes
                if own is None:
                    count = len(Template(text).h)
                    own = [min(WINDOW, count)] if count else []
                for row in _rows(text, own, sent) if own else ():
                    ids.append(i)
                    rows.append(row)
                    if len(rows) >= 20_000:
                        yield out()
                        ids, rows = [], []
            if rows:
                yield out()

    return df.select(ident, F.col("text").cast("string").alias("text")).mapInArrow(run, f"{ident} {kind}, {SHAPE}")


def contaminated(docs: DataFrame, benchmark: DataFrame, max_sent: int = MAX_SENT, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, n_windows, item_windows, coverage, n_slots, n_changed of every copy found."""
    items = written(_windows(benchmark.where("item_id IS NOT NULL"), "item_id", None))
    many = items.groupBy("item_id").agg(F.countDistinct("pos").alias("item_windows"))
    kinds = [r[0] for r in items.select("n").distinct().collect()]  # at most three for each size
    sizes = sorted({n & 255 for n in kinds})
    sent = None
    held = F.aggregate("fill", F.lit(64).cast("long"), lambda s, f: s + 32 + F.octet_length(f["t"]))
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    if count <= max_sent and size <= MAX_BYTES:
        rows = items.select("n", "h").distinct().toPandas()
        sent = {n: np.sort(rows["h"][rows["n"] == n].to_numpy(np.int64).view(np.uint64)) for n in kinds}
    docs = docs if sizes else docs.limit(0)
    found = _windows(docs, "doc_id", sizes or [WINDOW], sent if sizes else None)
    right = items.select("item_id", "h", "n", F.col("pos").alias("item_pos"), F.col("fill").alias("item_fill"))
    pairs = found.join(F.broadcast(right) if sent is not None else right, ["h", "n"]).withColumn("shift", F.col("pos") - F.col("item_pos"))
    pairs = pairs.withColumn("held", F.array_distinct(F.arrays_zip(F.col("item_fill").alias("item"), F.col("fill").alias("doc"))))
    place = ["doc_id", "item_id", "shift"]
    pairs = pairs.select(*place, "item_pos", "n", "held").distinct()
    # Fillers by name, not place: one name of the item must be one name in the document.
    each = pairs.withColumn("s", F.explode_outer("held")).withColumns({"mine": F.col("s.item"), "its": F.col("s.doc")})
    times = F.count("*").over(Window.partitionBy(*place, "mine", "its"))
    likely = Window.partitionBy(*place, "mine").orderBy(F.desc("times"), "its.t")
    each = each.withColumn("times", times).withColumn("best", F.first("its").over(likely))
    each = each.withColumn("bad", F.coalesce(F.col("its") != F.col("best"), F.lit(False)))
    each = each.withColumn("ok", ~F.max("bad").over(Window.partitionBy(*place, "item_pos", "n", "held")))
    one = each.groupBy(*place).agg(
        F.max(F.col("bad") & (F.col("mine.k") == NAMED)).alias("clash"),
        F.max(F.col("ok") & (F.col("n").bitwiseAND(~255) != DENSE)).alias("evidence"),
        F.collect_set(F.when(F.col("ok"), F.col("item_pos"))).alias("at"),
        F.collect_set(F.when(F.col("s").isNotNull(), F.struct("mine", "best"))).alias("named"),
    ).where("evidence AND NOT coalesce(clash, false)")
    per = one.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("at")))).cast("long").alias("n_windows"),
        F.max(F.size("named")).cast("long").alias("n_slots"),
        F.max(F.size(F.filter("named", lambda s: s["mine"]["t"] != s["best"]["t"]))).cast("long").alias("n_changed"),
    )
    share = F.col("n_windows") / F.col("item_windows")
    return per.join(many, "item_id").select(
        "doc_id", "item_id", "n_windows", "item_windows", share.alias("coverage"), "n_slots", "n_changed"
    ).where(F.col("coverage") >= coverage)


def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
