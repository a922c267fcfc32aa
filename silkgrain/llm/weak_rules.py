"""Quality rules that vote, fused by expectation-maximisation. DataFrame functions only.

Every rule votes keep (1), reject (-1) or abstains (0). Rows are counted by their pattern of
votes, of which there are at most 3 ** len(RULES); expectation-maximisation over those counts
gives the share of good rows and, for each rule and class, the probability of each vote, abstention
included; the posterior probability of quality replaces the rule that all must pass. Each rule has a
prior, STRONG or WEAK, whose weight grows with the rows: without it the kind of junk that one rule
alone sees would be fitted as good. One reject of a weak rule, with nothing else against the row,
leaves it good; several make it bad.

Defined cases: a null or empty text has no words, fails the base rules and is not kept; rows
that repeat count again; an empty table gives no rows; texts of any length are read whole; columns
of the input that have a measure's name are not carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silkgrain.llm.common import SPACE_CLASS, table, written

_INDEX_BITS = 24
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_exclaim", "n_digits", "n_stops", "n_lines", "n_dup_lines", "n_distinct", "n_repeat_words")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts that the rules look at, beside the columns of docs other than the text.

    Windows of three words are found again by sorting 40 hash bits and the window's index,
    packed in one long; equal neighbours are compared word for word. Where a comparison
    fails, or the index needs more bits, the row's windows are sorted by the words themselves.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keep = [c for c in docs.columns if c != text and c not in MEASURES]
    kept = [F.col(f"`{c}`") for c in keep]
    one = docs.select(
        *kept, body.alias("__t"),
        F.array_remove(F.split(body, f"{SPACE_CLASS}+"), "").alias("__w"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
    )
    low = F.lit((1 << _INDEX_BITS) - 1)
    high = F.lit(-(1 << _INDEX_BITS))
    packed = F.transform(
        F.slice(F.col("__w"), F.lit(1), F.greatest(F.size("__w") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("__w", i + 1), F.get("__w", i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long")),
    )
    two = one.select(
        *kept, "__w",
        F.size("__w").cast("long").alias("n_words"),
        F.length(_without(F.col("__t"), " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(_without(F.col("__t"), _SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("__t") - F.length(_without(F.col("__t"), _UPPER))).cast("long").alias("n_upper"),
        (F.length("__t") - F.length(_without(F.col("__t"), "!"))).cast("long").alias("n_exclaim"),
        (F.length("__t") - F.length(_without(F.col("__t"), "0123456789"))).cast("long").alias("n_digits"),
        (F.length("__t") - F.length(_without(F.col("__t"), ".?!"))).cast("long").alias("n_stops"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct"),
        F.sort_array(packed).alias("__p"),
    )
    rest = [*keep, *MEASURES[:-1]]
    rest = [F.col(f"`{c}`") for c in rest]
    same = lambda x, y: F.shiftright(x, _INDEX_BITS) == F.shiftright(y, _INDEX_BITS)
    at = lambda p: p.bitwiseAND(low).cast("int")
    prev, nxt = (lambda i: F.get("__p", i - 1)), (lambda i: F.get("__p", i + 1))
    three = two.select(
        *rest, "__w",
        F.filter("__p", lambda p, i: F.coalesce(same(p, prev(i)), F.lit(False)) | F.coalesce(same(p, nxt(i)), F.lit(False))).alias("__d"),
    )
    word = lambda i, k: F.get("__w", i + k)
    differ = lambda x, y: (word(x, 0) != word(y, 0)) | (word(x, 1) != word(y, 1)) | (word(x, 2) != word(y, 2))
    neighbour = lambda i: F.get("__d", i - 1)
    clash = F.size(
        F.filter("__d", lambda p, i: F.coalesce(same(p, neighbour(i)) & differ(at(p), at(neighbour(i))), F.lit(False)))
    ) > 0
    four = three.select(
        *rest, "__w", F.array_sort(F.transform("__d", at)).alias("__at"),
        (clash | (F.size("__w") > (1 << _INDEX_BITS))).alias("__clash"),
    )
    windows = F.when(
        F.col("__clash"),
        F.array_sort(F.transform(F.slice(F.col("__w"), F.lit(1), F.greatest(F.size("__w") - 2, F.lit(0))), lambda w, i: F.struct(w.alias("a"), word(i, 1).alias("b"), word(i, 2).alias("c"), i.alias("i")))),
    )
    five = four.select(*rest, "__at", windows.alias("__s"))
    eq = lambda x, y: F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
    slow = F.array_sort(
        F.transform(F.filter("__s", lambda s, i: eq(s, F.get("__s", i - 1)) | eq(s, F.get("__s", i + 1))), lambda s: s["i"])
    )
    six = five.select(*rest, F.when(F.col("__s").isNotNull(), slow).otherwise(F.col("__at")).alias("__at"))
    steps = F.transform("__at", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("__at", i + 1) - x, F.lit(3))))
    return six.select(*rest, F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x).alias("n_repeat_words"))


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(reject: Column, keep: Column) -> Column:
    return F.when(reject, -1).when(keep, 1).otherwise(0)


#: Priors: probabilities of (reject, abstain, keep) for bad and for good rows, and the weight of
#: each in multiples of all rows. One kind of junk sets off few rules, so bad rows get most keeps.
#: That a strong rule hardly ever rejects a good row is held to firmly; the rest is learnt.
STRONG = ((0.3, 0.05, 0.65), (0.0003, 0.05, 0.9497), (0.2, 20.0))
WEAK = ((0.2, 0.15, 0.65), (0.05, 0.15, 0.8), (0.2, 0.5))
#: The rules with their priors, in the order of rule_votes().
RULES = {
    "length": STRONG, "word_length": STRONG, "symbols": STRONG, "repetition": STRONG, "shouting": STRONG,
    "digits": WEAK, "lines": WEAK, "sentences": WEAK, "variety": WEAK,
}


def rule_votes() -> dict[str, Column]:
    """Measures that rise and fall together share a rule, since fusion takes the rules'
    votes for independent once the class is known. Ratios are per word but for dup (per
    line) and up (per character)."""
    n = F.col("n_words")
    mean, sym = _ratio("word_chars", "n_words"), _ratio("n_symbols", "n_words")
    dup, rep = _ratio("n_dup_lines", "n_lines"), _ratio("n_repeat_words", "n_words")
    up, exc, var = _ratio("n_upper", "word_chars"), _ratio("n_exclaim", "n_words"), _ratio("n_distinct", "n_words")
    digits, per_line, stops = _ratio("n_digits", "word_chars"), _ratio("n_words", "n_lines"), _ratio("n_stops", "n_words")
    votes = [
        _vote(n < 5, n >= 60),
        _vote((mean < 2.5) | (mean > 12), mean.between(3.5, 9)),
        _vote(sym > 0.15, sym < 0.05),
        _vote(((dup > 0.3) & (F.col("n_dup_lines") > 2)) | (rep > 0.4) | ((var < 0.1) & (n >= 50)), (dup == 0) & (rep < 0.2) & (var > 0.25)),
        _vote((up > 0.4) | (exc > 0.25), (up < 0.15) & (exc < 0.05)),
        _vote(digits > 0.3, digits < 0.1),
        _vote((per_line < 3) & (F.col("n_lines") > 5), per_line > 8),
        _vote((stops < 0.004) & (n >= 50), stops > 0.02),
        _vote((var < 0.2) & (n >= 50), var > 0.4),
    ]
    return dict(zip(RULES, votes, strict=True))


VOTES = (-1, 0, 1)


def fit_rules(
    patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 200, prior: float = 0.75, priors: tuple = ()
) -> tuple[float, list[dict[int, list[float]]]]:
    """Expectation-maximisation over counted vote patterns.

    Returns the share of good rows and, for each rule, vote -> [P(vote | bad), P(vote | good)].
    priors: one a rule, STRONG if not given; they start the fit and count as rows of their weight, in the
    most probable model that expectation-maximisation finds.
    """
    priors = priors or (STRONG,) * n_rules
    start = [{v: [p[0][k], p[1][k]] for k, v in enumerate(VOTES)} for p in priors]
    good, like, total = prior, start, sum(n for _, n in patterns)
    weight = [[total * x for x in p[2]] for p in priors]
    for _ in range(rounds if patterns else 0):
        share, seen = 0.0, [{v: [0.0, 0.0] for v in VOTES} for _ in range(n_rules)]
        for votes, n in patterns:
            p = posterior(votes, good, like)
            share += n * p
            for j, v in enumerate(votes):
                seen[j][v][1] += n * p
                seen[j][v][0] += n * (1 - p)
        before, good = good, (share + prior) / (total + 1)
        size = (total - share, share)
        like = [{v: [(seen[j][v][y] + weight[j][y] * start[j][v][y]) / (size[y] + weight[j][y]) for y in (0, 1)] for v in VOTES} for j in range(n_rules)]
        if abs(good - before) < 1e-12:
            break
    return good, like


def posterior(votes: tuple[int, ...], good: float, like: list[dict[int, list[float]]]) -> float:
    odds = math.log(good / (1 - good)) + sum(math.log(like[j][v][1] / like[j][v][0]) for j, v in enumerate(votes))
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def weak_quality(measures: DataFrame) -> DataFrame:
    """measures with one vote_<rule> column each, and quality, the posterior probability."""
    names = [f"vote_{r}" for r in RULES]
    voted = measures.withColumns(dict(zip(names, rule_votes().values(), strict=True)))
    counted = voted.groupBy(*names).count().collect()  # at most 3 ** len(RULES) rows
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in counted)
    good, like = fit_rules(patterns, len(names), priors=tuple(RULES.values()))
    odds = F.lit(math.log(good / (1 - good)))
    for name, p in zip(names, like, strict=True):
        gain = [math.log(p[v][1] / p[v][0]) for v in VOTES]
        odds = odds + F.when(F.col(name) < 0, gain[0]).when(F.col(name) > 0, gain[2]).otherwise(gain[1])
    return voted.withColumn("quality", 1 / (1 + F.exp(-odds)))


def op5_weak_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base verdict and fused verdict of every document."""
    scored = weak_quality(written(text_measures(table(spark, sf_dir, "documents", "doc_id", "text"))))
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("quality") >= 0.5)).alias("kept"), F.col("quality").alias("posterior"),
    )
