"""Sharding by a consistent-hash ring with virtual nodes and bounded loads. DataFrame functions only.

Every shard has virtual nodes on a ring of 2^63 places; a document's key falls on the ring, and the
document goes to the next shard clockwise that has room. Who finds room is settled by one order of all
documents, hashed from the key apart from its place: the result is that of dealing out the documents one
by one in that order, and doesn't depend on how the table is split. A shard is full from the document on
that fills it, so of the whole process only those documents need to be found, one for each shard at most:

1. documents are ranged by the order and stored, each with its place's arc (the nodes' order from there on);
2. loads are summed by range and arc, once;
3. a shard's running load over the ranges tells the range in which it fills, and the rows of that range
   alone tell the document; what is left goes on with one shard less, until no other fills;
4. a document's shard is the first of its arc that isn't full at its place in the order.

Between versions of a table, or with another shard count, only documents move whose next shard has
changed or whose room has: about 1/shards of them, and what overflows.

Capacities: `rows` are dealt so that counts differ by one at most (each shard takes the mean, rounded down or
up); `bytes` let a shard take (1 + slack) times the mean and the rest of the document that reaches it.

Defined cases: a null text has no bytes; a null id is a key like any other (the empty text); rows that
repeat are placed each for itself, next to each other in the order; columns other than those named are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silkgrain.llm.common import stable_rows, table, written

SHARDS = 8
NODES = 64  # virtual nodes of each shard
CELL_BITS = 12  # the ring is looked up by its 2^12 cells
RING_BITS = 63
ORDER_SEED = "order"


def ring_nodes(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise. A shard's nodes don't depend on how many shards there are."""
    place = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") >> (64 - RING_BITS)
    return sorted((place(s, v), s) for s in range(shards) for v in range(nodes))


def arcs(shards: int, nodes: int = NODES) -> list[tuple[int, ...]]:
    """For each arc, which ends before the node of its number (the last wraps round), all shards clockwise."""
    ring = [s for _, s in ring_nodes(shards, nodes)]
    return [tuple(dict.fromkeys(ring[i:] + ring[:i])) for i in range(len(ring))]


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of constants, made in the JVM."""
    names = [x.split()[0] for x in schema.split(", ")]
    body = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(body), f"array<struct<{schema}>>")))


def ring_cells(spark: SparkSession, shards: int, nodes: int = NODES) -> DataFrame:
    """Cell, arc at its beginning, places of the nodes inside: 2^CELL_BITS rows whatever the data."""
    places = [p for p, _ in ring_nodes(shards, nodes)]
    width = RING_BITS - CELL_BITS
    starts = [bisect_right(places, c << width) for c in range((1 << CELL_BITS) + 1)]
    rows = [(c, starts[c], places[starts[c] : starts[c + 1]]) for c in range(1 << CELL_BITS)]
    return _small(spark, rows, "__cell long, __first int, __nodes array<long>")


def ring_place(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - RING_BITS)


def ordered(rows: DataFrame, shards: int, nodes: int = NODES, key: str = "doc_id", load: Column | None = None) -> DataFrame:
    """rows with key, load, arc and at: stored, at is their place in the order of dealing (with gaps, no two alike).

    Rows of one key lie next to each other, in the order of their other columns, and may go to several ranges.
    """
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    ties = [F.col(f"`{c}`") for c in rows.columns if c != key]
    placed = stable_rows(rows).select("*", ring_place(text).alias("__place"), F.xxhash64(F.lit(ORDER_SEED), text).alias("__order"))
    placed = placed.withColumns({"__row": F.monotonically_increasing_id(), "__load": (F.lit(1) if load is None else load).cast("long")})
    cell = F.shiftright("__place", RING_BITS - CELL_BITS)
    found = placed.withColumn("__cell", cell).join(F.broadcast(ring_cells(rows.sparkSession, shards, nodes)), "__cell")
    arc = (F.col("__first") + F.size(F.filter("__nodes", lambda p: p <= F.col("__place")))) % (shards * nodes)
    ranged = found.withColumn("__arc", arc).drop("__cell", "__first", "__nodes", "__place")
    order = ["__order", F.col(f"`{key}`"), *ties, "__row"]
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.withColumn("__at", F.monotonically_increasing_id()).drop("__order", "__row"))


def capacities(loads: DataFrame, shards: int, law: str, slack: float) -> list[int]:
    """What each shard takes."""
    total = int(loads.agg(F.sum("load")).first()[0] or 0)
    if law == "rows":
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [int(-(-total * (1 + slack) // shards))] * shards


def _range(at: Column) -> Column:
    return F.shiftright(at, 33)  # monotonically_increasing_id has the partition there


def _first_free(order: Column, full: list[int]) -> Column:
    return F.get(F.filter(order, lambda s: ~s.isin(full)) if full else order, F.lit(0))


def fill_points(dealt: DataFrame, shards: int, nodes: int, law: str, slack: float) -> dict[int, int]:
    """Shard -> place in the order of the document that fills it, for the shards that become full.

    The driver holds a load and a place for each shard; sums by range and arc are stored.
    """
    spark = dealt.sparkSession
    clockwise = _small(spark, [(i, a) for i, a in enumerate(arcs(shards, nodes))], "__arc int, clockwise array<int>")
    with_arc = lambda df: df.join(F.broadcast(clockwise), "__arc")  # noqa: E731  shards * nodes rows
    loads = written(dealt.groupBy(_range(F.col("__at")).alias("range"), "__arc").agg(F.sum("__load").alias("load")))
    caps, have, done = capacities(loads, shards, law, slack), [0] * shards, -1
    full = {s: -1 for s in range(shards) if not caps[s]}
    inside = lambda r: dealt.where((F.col("__at") > max(done, (r << 33) - 1)) & (F.col("__at") < (r + 1) << 33))  # noqa: E731  reaches the scan
    room = lambda: F.element_at(F.array(*(F.lit(c - h) for c, h in zip(caps, have, strict=True))).cast("array<long>"), F.col("shard") + 1)
    while len(full) < shards:
        shard = _first_free(F.col("clockwise"), list(full)).alias("shard")
        now = done >> 33
        rest = inside(now).groupBy(F.lit(now).alias("range"), "__arc").agg(F.sum("__load").alias("load"))
        later = loads.where(F.col("range") > now) if done >= 0 else loads
        sums = with_arc(later.unionByName(rest) if done >= 0 else later).groupBy("range", shard).agg(F.sum("load").alias("load"))
        running = sums.withColumn("running", F.sum("load").over(Window.partitionBy("shard").orderBy("range"))).where(F.col("running") >= room())
        at_range = running.agg(F.min("range")).first()[0]
        if at_range is None:
            break
        before = sums.where(F.col("range") < at_range).groupBy("shard").agg(F.sum("load").alias("load"))
        for s, n in before.collect():  # a row for each shard
            have[s] += n
        rows = with_arc(inside(at_range).select("__at", "__load", "__arc")).select("__at", "__load", shard)
        rows = rows.withColumn("running", F.sum("__load").over(Window.partitionBy("shard").orderBy("__at")))
        done, filled = rows.where(F.col("running") >= room()).agg(F.min_by(F.struct("__at", "shard"), "__at")).first()[0]
        for s, n in rows.where(F.col("__at") <= done).groupBy("shard").agg(F.sum("__load")).collect():  # a row for each shard
            have[s] += n
        full[filled] = done
    return full


def shard_by_ring(
    rows: DataFrame, shards: int = SHARDS, law: str = "rows", slack: float = 0.05, key: str = "doc_id", load: str | None = None, nodes: int = NODES
) -> DataFrame:
    """rows with shard, home, and slot: their place in the shard, gapless from 0 and in the order of dealing.

    law: rows, or bytes with the column `load`. home is the shard that the key has without bounds.
    Columns of rows that have one of these three names give way.
    """
    dealt = ordered(rows, shards, nodes, key, None if law == "rows" else F.col(f"`{load}`"))
    full = fill_points(dealt, shards, nodes, law, slack)
    spark = rows.sparkSession
    clockwise = _small(spark, [(i, a) for i, a in enumerate(arcs(shards, nodes))], "__arc int, __clockwise array<int>")
    last = F.array(*(F.lit(full.get(s, (1 << 63) - 1)) for s in range(shards))).cast("array<long>")
    free = F.filter("__clockwise", lambda s: F.element_at(last, s + 1) >= F.col("__at"))
    # Rounded capacities add up to the total, so someone has room; a last document may find none where loads are estimates.
    shard = F.coalesce(F.get(free, F.lit(0)), F.get("__clockwise", F.lit(0)))
    placed = dealt.join(F.broadcast(clockwise), "__arc").withColumns({"shard": shard, "home": F.get("__clockwise", F.lit(0)), "__range": _range(F.col("__at"))})
    counts = placed.groupBy("__range", "shard").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__range", "shard", F.coalesce(before, F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__range", "shard").orderBy("__at"))
    slotted = placed.withColumn("__inside", inside).join(starts, ["__range", "shard"])
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "slot", "home")]
    return slotted.select(*kept, "shard", (F.col("__start") + F.col("__inside") - 1).cast("long").alias("slot"), "home")


def document_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size (bytes of the text and one for the row) and text_crc32."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def op12_hash_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards whose counts are one apart at most."""
    rows = document_rows(table(spark, sf_dir, "documents", "doc_id", "text"))
    return shard_by_ring(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home"
    )
