"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Among all rates of documents whose words meet every source's target, the one that changes
the corpus least (in Kullback-Leibler divergence over words) is an exponential tilt of the
source's dual variable. Newton's method solves the convex dual on sums made where the rows
are; each iteration is one job and its state is stored in the shared folder. Rates become
whole copies by systematic rounding along each source's documents in order of size, so a
source's words miss its target by about one document; then, three times over, the one document
whose size is nearest to what is still missing (or too much) gains (or loses) a copy.

All documents of a source share its dual variable, so the sums over them that a Newton step needs are
the source's size times exp(dual). Numbers along an order are put together from a window inside a
bounded range and the sum of the ranges before it; no window spans a source's rows or all sources.

Defined cases: a null text has size 0; a null source is a source of its own, last in order;
a source without words has target 0 and rate 1; repeated rows are separate documents; a null
id counts as 0 in the order of rounding, and an id that is no number by a hash; columns other than
doc_id, source and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silkgrain.llm.common import table, written

CAP = 3
SALTS = 64
BAND = 3  # sizes that differ above these bits alone are in different bands


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, src (a key that tells null from empty) and size in words."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0))
    return docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("2")).alias("src"), size.alias("size")
    )


def source_targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row a source: src, source_size, weight, target. The excess above cap times a
    source's size is dealt again by weight until no target is above. Sums are whole numbers,
    so the result doesn't depend on their order. What is ordered here is sources, not rows."""
    ranged = sizes.groupBy("src").agg(F.sum("size").alias("source_size")).repartitionByRange("src")
    ranged = written(ranged.withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = ranged.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    k = F.col("start") + F.row_number().over(Window.partitionBy("range").orderBy("src")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (k % len(weights)).cast("int") + 1)
    src = written(ranged.join(starts, "range").select("src", "source_size", weight.cast("long").alias("weight")))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    row = src.agg(F.sum("source_size"), F.sum("weight")).first()
    total = num = int(row[0] or 0)
    den = int(row[1] or 0)
    while den:
        above = cap * big("source_size") * F.lit(Decimal(den)) < F.lit(Decimal(num)) * big("weight")
        full, free = src.agg(F.sum(F.when(above, F.col("source_size") * cap)), F.sum(F.when(~above, F.col("weight")))).first()
        now = (total - int(full or 0), int(free or 0))
        if now == (num, den):
            break
        num, den = now
    if den:
        above = cap * big("source_size") * F.lit(Decimal(den)) < F.lit(Decimal(num)) * big("weight")
        share = F.lit(float(num)) * F.col("weight") / F.lit(float(den))
        target = F.when(above, F.col("source_size") * float(cap)).otherwise(share)
    else:
        target = F.col("source_size") * float(cap)
    return src.withColumn("target", target.cast("double"))


def entropy_rates(targets: DataFrame, cap: int = CAP, rounds: int = 60, tolerance: float = 1e-13) -> DataFrame:
    """targets with rate = min(cap, exp(dual)), the dual found by Newton's method."""
    at = written(targets.withColumn("dual", F.lit(0.0)))
    mass = F.col("source_size") * F.exp("dual")  # the gradient's first part, and the curvature
    for _ in range(rounds):
        gap = at.agg(F.max(F.when(F.col("source_size") > 0, F.abs(F.col("target") - mass) / F.col("source_size")))).first()[0]
        if gap is None or gap <= tolerance:
            break
        step = F.when((F.col("source_size") > 0) & (F.col("target") > 0), (F.col("target") - mass) / mass).otherwise(0.0)
        # A step is at most 2 either way: far from the solution the quadratic model is poor.
        at = written(at.withColumn("dual", F.col("dual") + F.greatest(F.lit(-2.0), F.least(F.lit(2.0), step))))
    rate = F.when(F.col("source_size") == 0, 1.0).when(F.col("target") == 0, 0.0).otherwise(F.least(F.lit(float(cap)), F.exp("dual")))
    return at.withColumn("rate", F.round(rate, 9))


def round_to_copies(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """sizes with the columns of rates and copies, a whole number within one of the rate.

    The k-th document of a source in order of (size, id modulo SALTS, id) gets
    floor(k * f + 1/2) - floor((k - 1) * f + 1/2) copies beyond the whole part of its
    rate, f being the fraction. k is the sum of a group's offset and a rank inside a group
    of equal size and remainder. An offset adds up bands of sizes, then the groups inside a band.
    """
    whole_id = sizes.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    number = F.col("doc_id").cast("long") if whole_id else F.crc32(F.col("doc_id").cast("string"))
    salted = sizes.withColumn("salt", F.pmod(F.coalesce(number, F.lit(0)), F.lit(SALTS)))
    group = ["src", "size", "salt"]
    sums = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by[:-1]).orderBy(*by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = salted.groupBy(*group).agg(F.count("*").alias("n")).withColumn("band", F.shiftright("size", BAND))
    bands = counts.groupBy("src", "band").agg(F.sum("n").alias("n")).select("src", "band", sums("src", ["band"]).alias("below"))
    inside = counts.withColumn("inside", sums("src", "band", ["size", "salt"]))
    offsets = inside.join(bands, ["src", "band"]).select(*group, (F.col("below") + F.col("inside")).alias("offset"))
    ranked = salted.withColumn("inner", F.row_number().over(Window.partitionBy(*group).orderBy("doc_id")))
    placed = ranked.join(offsets.select(*group, "offset"), group).join(rates, "src")
    k, whole = F.col("offset") + F.col("inner"), F.floor("rate")
    part = F.col("rate") - whole
    extra = F.floor(k * part + 0.5) - F.floor((k - 1) * part + 0.5)
    return placed.withColumn("copies", (whole + extra).cast("long")).withColumn("k", k)


ROUNDS = 3


def settle(placed: DataFrame, cap: int = CAP, rounds: int = ROUNDS) -> DataFrame:
    """placed with up to rounds copies a source added or taken, to come nearer to the target.

    The search runs over counts by (source, size, copies); a source's rows never meet. A size
    is used once, on the first document in order of rounding, and only if that helps.
    """
    kinds = written(placed.groupBy("src", "size", "copies").agg(F.min("k").alias("k"), F.count("*").alias("n")))
    taken = kinds.groupBy("src").agg(F.sum(F.col("size") * F.col("copies") * F.col("n")).alias("taken"))
    targets = placed.groupBy("src").agg(F.first("target").alias("target"))
    state = taken.join(targets, "src").select(
        "src", (F.col("target") - F.col("taken")).alias("gap"), F.array().cast("array<bigint>").alias("used")
    )
    picks = None
    for _ in range(rounds):
        far = F.abs(F.abs("gap") - F.col("size"))
        fits = ((F.col("gap") > 0) & (F.col("copies") < cap)) | ((F.col("gap") < 0) & (F.col("copies") > 0))
        found = (
            kinds.join(state, "src")
            .where(fits & (F.col("size") > 0) & (far < F.abs("gap")) & ~F.array_contains("used", F.col("size")))
            .groupBy("src")
            .agg(F.min(F.struct(far.alias("far"), "size", "copies", "k")).alias("p"))
            .select("src", "p.size", "p.k")
        )
        step = F.signum("gap") * F.coalesce("size", F.lit(0))
        state = written(
            state.join(found, "src", "left").select(
                "src", (F.col("gap") - step).alias("gap"), F.concat("used", F.when(F.col("size").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("size"))).alias("used"),
                "k", F.signum("gap").cast("long").alias("delta"),
            )
        )
        now = state.where("k IS NOT NULL").select("src", "k", "delta")
        picks = now if picks is None else picks.unionByName(now)
        state = state.select("src", "gap", "used")
    return placed.join(picks, ["src", "k"], "left").withColumn("copies", F.col("copies") + F.coalesce("delta", F.lit(0)))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies of every document."""
    sizes = written(document_sizes(docs))
    placed = written(round_to_copies(sizes, entropy_rates(source_targets(sizes))))
    return settle(placed).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies"
    )


def op9_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents; taken is size times copies."""
    return mix(table(spark, sf_dir, "documents", "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mixing_sql(docs: str = "documents") -> str:
    """The same mix by SQL: capped shares by sorting, rate as a ratio, ranks by one window."""
    rounds = ",\n".join(
        f"""f{i} AS (SELECT g.source, min(struct_pack(far := abs(abs(gap) - size), size := size, copies := copies, k := p.k)) AS m
  FROM p JOIN g{i - 1} g ON p.source IS NOT DISTINCT FROM g.source
  WHERE ((gap > 0 AND copies < {CAP}) OR (gap < 0 AND copies > 0)) AND size > 0 AND abs(abs(gap) - size) < abs(gap) AND NOT list_contains(used, size)
  GROUP BY g.source),
g{i} AS (SELECT g.source, gap - sign(gap) * coalesce(m.size, 0) AS gap, CASE WHEN m IS NULL THEN used ELSE list_append(used, m.size) END AS used, m.k AS k, sign(gap)::BIGINT AS delta
  FROM g{i - 1} g LEFT JOIN f{i} f ON g.source IS NOT DISTINCT FROM f.source)"""
        for i in range(1, ROUNDS + 1)
    )
    picks = " UNION ALL ".join(f"SELECT source, k, delta FROM g{i} WHERE k IS NOT NULL" for i in range(1, ROUNDS + 1))
    return f"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM {docs}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s),
o AS (SELECT *, {CAP} * source_size AS most, sum(source_size) OVER () AS total,
  coalesce(sum({CAP} * source_size) OVER (ORDER BY {CAP} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
  sum(weight) OVER (ORDER BY {CAP} * source_size / weight DESC, source DESC NULLS FIRST) AS free FROM w),
c AS (SELECT *, most * free >= (total - capped) * weight AS ok FROM o),
f AS (SELECT total - capped AS num, free AS den FROM c WHERE ok ORDER BY most / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN den IS NULL OR most::HUGEINT * den < num * weight THEN most::DOUBLE ELSE num::DOUBLE * weight / den::DOUBLE END AS target FROM c LEFT JOIN f ON true),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 1.0::DOUBLE ELSE least({CAP}.0::DOUBLE, round(target / source_size, 9)) END AS rate FROM t),
k AS (SELECT doc_id, size, source_size, target, rate, floor(rate) AS whole, rate - floor(rate) AS part,
  row_number() OVER (PARTITION BY d.source ORDER BY size, coalesce(doc_id, 0) % {SALTS}, doc_id) AS k, d.source
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
p AS (SELECT * EXCLUDE (whole, part), (whole + floor(k * part + 0.5) - floor((k - 1) * part + 0.5))::BIGINT AS copies FROM k),
g0 AS (SELECT source, any_value(target) - sum(size * copies) AS gap, []::BIGINT[] AS used FROM p GROUP BY source),
{rounds},
x AS ({picks})
SELECT doc_id, size, source_size, target, (size * (copies + coalesce(delta, 0)))::BIGINT AS taken, (copies + coalesce(delta, 0))::BIGINT AS copies
FROM p LEFT JOIN x ON p.source IS NOT DISTINCT FROM x.source AND p.k = x.k
"""


SQL = mixing_sql()
