"""Audit of how filters interact, by inclusion and exclusion.

Every document carries one flag a filter (1: it fails). For each of the 2^k sets of filters the product of the
set's flags is summed: the joint failures, for all documents, for good ones and for toxic ones. These sums alone
answer all questions, part by part and for every order of the filters:

- survivors of a set of filters: sum over its subsets T of (-1)^|T| * joint(T) (Moebius inversion);
- what a step removes: survivors before it less survivors after it; redundant: its failures less that;
- what fails one filter only: the same inversion over the sets that hold it;
- Shapley: of the game "documents that a set of filters removes" the Harsanyi dividend of T is
  (-1)^(|T| + 1) * joint(T), and each filter of T gets an equal share of it.

DataFrame functions only. Rows of equal text, id and part are counted before they are shuffled, so a hot source,
a text with very many copies or a repeated id is a few rows of counts; the first id of each text finds its row by text
and id together. The result has a fixed number of rows for each part.

Defined cases: a null text counts as empty (it fails length alone, and repetition if it isn't the first empty one);
a null source is the part of the empty string; a null id has no smaller id and is smaller than none, and has no label; rows that share the
smallest id of a text are all first; repeated labels count as good or toxic if one of them says so; columns other
than those named are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm.common import SPACE_CLASS, table, written

#: The filters by letter: a text's own failures; E is that an equal text has a smaller id.
OWN, COPY = "ABCD", "E"
WEIGHTS = ("all", "good", "toxic")


def own_failures(text: Column) -> list[Column]:
    """Failures that depend on the text alone, in the order of OWN."""
    words = F.array_remove(F.split(text, f"{SPACE_CLASS}+"), "")
    n, chars = F.size(words), F.length(text)
    return [
        n < 200,
        F.lit(100) * F.size(F.array_distinct(words)) < F.lit(50) * n,
        F.lit(100) * (chars - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > F.lit(2) * chars,
        text.rlike(r"[#$%&*|]"),
    ]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, one int column for each filter, good, toxic and n: how many documents are alike in all these and in id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    flags = dict(zip(OWN, own_failures(F.col("text")), strict=True))
    read = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    seen = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *(c.cast("int").alias(f) for f, c in flags.items()))
    counted = written(seen.groupBy("doc_id", "part", "digest", *OWN).agg(F.count("*").alias("n")))
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(1))
    later = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 1).otherwise(0)
    told = counted.join(first, ["doc_id", "digest"], "left").select("doc_id", "part", *OWN, later.alias(COPY), "n")
    told = told.groupBy("doc_id", "part", *OWN, COPY).agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = told.join(marks, "doc_id", "left")
    return marked.select("part", *OWN, COPY, *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in WEIGHTS[1:]), "n")


def joint_failures(failed: DataFrame, filters: str) -> DataFrame:
    """A row for each part: arrays all, good and toxic with the joint failures of each set of filters.

    Bit i of an index is filter i; the empty set's entry counts the documents.
    """
    sets = [[f for i, f in enumerate(filters) if held >> i & 1] for held in range(1 << len(filters))]
    sums = [F.expr(f"sum({' * '.join(['n', *([] if w == 'all' else [w]), *held])})").alias(f"{w}_{i}") for w in WEIGHTS for i, held in enumerate(sets)]
    arrays = [F.array(*(f"{w}_{i}" for i in range(len(sets)))).alias(w) for w in WEIGHTS]
    return failed.groupBy("part").agg(*sums).select("part", *arrays)


def _subsets(held: int) -> list[int]:
    return [t for t in range(held + 1) if t & held == t]


def _array(joint: str, sums: list[dict[int, int]]) -> Column:
    """An array of sums over joint failures, each given as set -> factor."""
    return F.expr(f"array({', '.join(' + '.join(f'{x} * {joint}[{t}]' for t, x in terms.items()) for terms in sums)})")


def survivors(joint: str, k: int) -> Column:
    """For each set of filters how many documents fail none of it."""
    return _array(joint, [{t: (-1) ** t.bit_count() for t in _subsets(held)} for held in range(1 << k)])


def only(joint: str, k: int) -> Column:
    """For each filter how many documents fail it and no other."""
    rest = [((1 << k) - 1) & ~(1 << i) for i in range(k)]
    return _array(joint, [{t | 1 << i: (-1) ** t.bit_count() for t in _subsets(rest[i])} for i in range(k)])


def shapley(joint: str, k: int) -> Column:
    """For each filter its Shapley value times k factorial: what it removes, summed over all orders."""
    share = lambda t: (-1) ** (t.bit_count() + 1) * factorial(k) // t.bit_count()  # noqa: E731  k! is a multiple of every set's size
    return _array(joint, [{t: share(t) for t in range(1 << k) if t >> i & 1} for i in range(k)])


def interaction_audit(joint: DataFrame, filters: str, orders: list[str] | None = None) -> DataFrame:
    """part, filter_order, step and the counts of that step, for each of orders (all of them, if not given)."""
    k = len(filters)
    orders = orders if orders is not None else ["".join(p) for p in permutations(filters)]
    known = joint.select(
        "part", *(survivors(f"`{w}`", k).alias(f"left_{w}") for w in WEIGHTS), _array("`all`", [{1 << i: 1} for i in range(k)]).alias("fail"),
        only("`all`", k).alias("only"), shapley("`all`", k).alias("shapley"),
    )
    steps = []
    for order in orders:
        held = 0
        for step, letter in enumerate(order, 1):
            i = filters.index(letter)
            steps.append({"filter_order": order, "step": step, "i": i, "before": held, "after": held | 1 << i})
            held |= 1 << i
    made = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, i int, before int, after int>>")
    each = known.withColumn("at", F.explode(made))
    left = lambda w, when: F.get(f"left_{w}", F.col(f"at.{when}"))
    gone = lambda w: left(w, "before") - left(w, "after")
    return each.select(
        "part", "at.filter_order", "at.step", left("all", "after").alias("kept"), gone("all").alias("removed"), (F.get("fail", F.col("at.i")) - gone("all")).alias("redundant"),
        F.get("only", F.col("at.i")).alias("unique_fails"), gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.get("shapley", F.col("at.i")).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 120 orders of the five filters, for each source of the documents."""
    failed = failures(table(spark, sf_dir, "documents", "doc_id", "source", "text"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return interaction_audit(joint_failures(failed, OWN + COPY), OWN + COPY)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d),
f AS (SELECT doc_id, part, (len(words) < 200)::INT AS A, (100 * len(list_distinct(words)) < 50 * len(words))::INT AS B,
  (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT AS C, regexp_matches(text, '[#$%&*|]')::INT AS D, coalesce(first_id < doc_id, false)::INT AS E FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, [A, B, C, D, E] AS fails, A + B + C + D + E AS n_fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(range(5)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS ord FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT ord, unnest(range(1, 6)) AS step FROM o),
r AS (SELECT part, ord, step, ord[step] AS filter, fails[ord[step] + 1] = 1 AS fails_it, n_fails, n, good, toxic,
  len(list_filter(ord[1:step - 1], lambda j: fails[j + 1] = 1)) > 0 AS gone FROM g, s),
c AS (SELECT part, ord, step, filter, sum(n) FILTER (NOT gone AND NOT fails_it) AS kept, sum(n) FILTER (NOT gone AND fails_it) AS removed, sum(n) FILTER (gone AND fails_it) AS redundant,
  sum(n) FILTER (fails_it AND n_fails = 1) AS unique_fails, sum(n * good) FILTER (NOT gone AND fails_it) AS good_lost, sum(n * toxic) FILTER (NOT gone AND fails_it) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, array_to_string(list_transform(ord, lambda j: chr((65 + j)::INT)), '') AS filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM c
"""
