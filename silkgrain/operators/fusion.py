"""Fusion of votes (A rows): votes are long (document_id, chunk_id, label, lf, vote, confidence,
count, evidence, ord); all sums are partial aggregates by (document, chunk, label)."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silkgrain import config as c
from silkgrain.functions.text import sigmoid

KEY = ["document_id", "chunk_id", "label"]


def lookup(values: dict, key: Column, default: object = None) -> Column:
    """A value of a small constant table."""
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def last_votes(votes: DataFrame) -> DataFrame:
    """Of repeated (row, label, LF) votes the one with the greatest ord."""
    rest = [x for x in votes.columns if x not in (*KEY, "lf")]
    return votes.groupBy(*KEY, "lf").agg(F.max_by(F.struct(*rest), "ord").alias("v")).select(*KEY, "lf", "v.*")


def normalized_weighted_vote(votes: DataFrame, weights: dict = c.VOTE_WEIGHTS) -> DataFrame:
    """A2: sum of v*c*w over sum of |c*w|, abstentions apart; 0 without votes."""
    w = F.col("confidence") * lookup(weights, F.col("lf"), 0.0)
    return votes.groupBy(*KEY).agg(F.coalesce(F.try_divide(F.sum(F.col("vote") * w), F.sum(F.when(F.col("vote") != 0, F.abs(w)).otherwise(0.0))), F.lit(0.0)).alias("score"))


def majority(votes: DataFrame) -> DataFrame:
    """A3: more positive than negative votes, and the positive share."""
    pos, neg = F.count_if(F.col("vote") > 0), F.count_if(F.col("vote") < 0)
    return votes.groupBy(*KEY).agg((pos > neg).alias("present"), F.coalesce(F.try_divide(pos, pos + neg), F.lit(0.0)).alias("confidence"))


def majority_probability(votes: DataFrame) -> DataFrame:
    """A10: probability 1 for the class with more votes, equal parts on ties."""
    pos, neg = F.count_if(F.col("vote") > 0), F.count_if(F.col("vote") < 0)
    return votes.groupBy(*KEY).agg(F.when(pos > neg, 1.0).when(pos < neg, 0.0).otherwise(0.5).alias("probability"))


def weighted_vote(votes: DataFrame, weights: dict = c.VOTE_WEIGHTS, primary: tuple = c.PRIMARY, thresholds: dict = c.THRESHOLDS, alpha: float = c.ALPHA) -> DataFrame:
    """A5: score over the weights of all known LFs that answered, status, count, supporters in
    order of the weight table, first 20 evidence texts."""
    order = {k: i for i, k in enumerate(weights)}
    w = lookup(weights, F.col("lf"))
    v = votes.withColumn("w", w).where("w IS NOT NULL").withColumn("c", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "confidence")))
    side = lambda s: F.transform(F.array_sort(F.collect_list(F.when(s, F.struct(lookup(order, F.col("lf")).alias("o"), "lf")))), lambda x: x["lf"])
    pos, neg = F.col("vote") > 0, F.col("vote") < 0
    g = v.groupBy(*KEY).agg(
        (F.sum(F.col("vote") * F.col("c") * F.col("w")) / F.sum(F.abs("w"))).alias("vote_score"), side(pos).alias("supporting_lfs"), side(neg).alias("opposing_lfs"),
        side(F.col("vote") == 0).alias("abstained_lfs"), F.coalesce(F.max(F.when(pos, F.col("count"))), F.lit(0)).alias("count"),
        F.slice(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(pos, F.struct(lookup(order, F.col("lf")).alias("o"), "evidence")))), lambda x: x["evidence"]))), 1, 20).alias("evidence_texts"),
    )
    thr = lookup(thresholds, F.col("label"), 0.35)
    support = F.size("supporting_lfs") > 0
    present = support & (F.col("vote_score") >= thr)
    main = F.exists("supporting_lfs", lambda x: x.isin(*primary))
    return g.withColumn("threshold", thr).withColumn("present", present).withColumn("confidence", F.when(support, sigmoid(alpha * (F.col("vote_score") - thr))).otherwise(0.0)).withColumn(
        "status", F.when(present & main, "accepted").when(present, "weak").otherwise("rejected")
    )


def binary_weighted_vote(scores: DataFrame, threshold: float = 0.35, alpha: float = c.ALPHA) -> DataFrame:
    """A4: present from the normalised score, confidence from its logistic."""
    return scores.withColumn("present", F.col("score") >= threshold).withColumn("confidence", sigmoid(alpha * F.col("score")))


def count_fusion(votes: DataFrame, decisions: DataFrame, weights: dict = c.COUNT_WEIGHTS, floors: tuple = c.FLOOR_LFS, most: dict = c.MAX_COUNT) -> DataFrame:
    """Weighted mean of positive counts, at least the number of different evidence texts
    of three LFs, clamped; absent labels count 0."""
    mass = lookup(weights, F.col("lf"), 0.0) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), "confidence"))
    use = (mass > 0) & (F.col("count") > 0) & (F.col("vote") > 0)
    g = votes.groupBy(*KEY).agg(
        F.coalesce(F.sum(F.when(use, mass * F.col("count"))), F.lit(0.0)).alias("s"), F.coalesce(F.sum(F.when(use, mass)), F.lit(0.0)).alias("m"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.when((F.col("vote") > 0) & F.col("lf").isin(*floors), F.col("evidence")))))).alias("evidence_floor"),
    )
    d = decisions.select(*KEY, "present", F.col("confidence").alias("vote_confidence")).join(g, KEY)
    mean = F.when(F.col("m") > 0, F.col("s") / F.col("m")).otherwise(0.0)
    raw = F.bround(F.greatest(mean, F.col("evidence_floor").cast("double"), F.lit(1.0)), 0)
    count = F.when(~F.col("present"), 0).otherwise(F.least(raw, lookup(most, F.col("label"), 20).cast("double"))).cast("int")
    conf = F.when(~F.col("present"), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("vote_confidence") * (0.6 + 0.4 * F.least(F.lit(1.0), "m")))))
    return d.select(*KEY, count.alias("predicted_count"), conf.alias("count_confidence"), "evidence_floor", mean.alias("weighted_count"))


def moments(votes: DataFrame) -> DataFrame:
    """A9, what the data give: for each label and pair of (LF, vote) the rows that have both.
    At most (LFs * 2) ** 2 rows a label, so the fit's input is bounded."""
    active = votes.where("vote <> 0").groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("lf", "vote"))).alias("a"))
    return active.select("label", F.explode("a").alias("i"), "a").select("label", "i", F.explode("a").alias("j")).groupBy(
        "label", F.col("i.lf").alias("lf_i"), F.col("i.vote").alias("vote_i"), F.col("j.lf").alias("lf_j"), F.col("j.vote").alias("vote_j")
    ).agg(F.count("*").alias("n"))


def fit_label_model(o: np.ndarray, p: np.ndarray, rounds: int = 200, rate: float = 0.01, precision: float = 0.7) -> np.ndarray:
    """mu[(lf, vote), class] of overlap moments o (LF blocks of two votes: -1, 1), by gradient
    descent on the masked matrix-completion loss."""
    n, k = len(o), len(p)
    mask = (np.arange(n)[:, None] // k != np.arange(n)[None] // k).astype(float)
    mu = np.full((n, k), 0.0)
    for i in range(n):
        for y in range(k):
            mu[i, y] = min(0.99, o[i, i] * (precision if i % k == y else 1 - precision) / max(p[y], 1e-9))
    for _ in range(rounds):
        gap = mask * (o - mu @ np.diag(p) @ mu.T)
        own = np.diag(o) - mu @ p
        mu = np.clip(mu + rate * (4 * gap @ mu @ np.diag(p) + 2 * own[:, None] * p[None]), 0.01, 0.99)
    return mu


def label_model(votes: DataFrame, thresholds: dict = c.THRESHOLDS, rounds: int = 200) -> DataFrame:
    """One model a label over all documents: probability of presence of each row.

    Fewer than three LFs with votes: majority. Rows without any vote keep the prior one half
    and, unlike others, are never accepted."""
    total = {r["label"]: r["n"] for r in votes.groupBy("label").agg(F.countDistinct("document_id", "chunk_id").alias("n")).collect()}
    rows = moments(votes).collect()
    odds = F.lit(0.0)
    for label in sorted(total):
        own = [r for r in rows if r["label"] == label]
        lfs = sorted({r["lf_i"] for r in own})
        if len(lfs) < 3:
            for lf in lfs:
                odds = odds + F.when((F.col("label") == label) & (F.col("lf") == lf), F.col("vote") * 2.0).otherwise(0.0)
            continue
        at = {(lf, v): 2 * i + (v > 0) for i, lf in enumerate(lfs) for v in (-1, 1)}
        o = np.zeros((2 * len(lfs), 2 * len(lfs)))
        for r in own:
            o[at[r["lf_i"], r["vote_i"]], at[r["lf_j"], r["vote_j"]]] = r["n"] / total[label]
        mu = fit_label_model(o, np.array([0.5, 0.5]), rounds)
        for (lf, v), i in at.items():
            odds = odds + F.when((F.col("label") == label) & (F.col("lf") == lf) & (F.col("vote") == v), float(np.log(mu[i, 1] / mu[i, 0]))).otherwise(0.0)
    g = votes.withColumn("__o", odds).groupBy(*KEY).agg(F.sum("__o").alias("o"), F.count_if(F.col("vote") != 0).alias("active"))
    thr = lookup(thresholds, F.col("label"), 0.35)
    p = F.round(sigmoid(F.col("o")), 6)
    status = F.when(F.col("active") == 0, "rejected").when(F.col("probability") >= thr, "accepted").when(F.col("probability") >= F.greatest(F.lit(0.05), 0.75 * thr), "weak").otherwise("rejected")
    return g.withColumn("probability", p).withColumn("status", status).select(*KEY, "probability", "status")


def merge_model(decisions: DataFrame, model: DataFrame, counts: DataFrame) -> DataFrame:
    """The model's status and probability replace the local ones where they exist."""
    d = decisions.join(model.select(*KEY, F.col("probability").alias("p"), F.col("status").alias("s")), KEY, "left").join(counts.select(*KEY, "predicted_count"), KEY, "left")
    status, n = F.coalesce("s", "status"), F.coalesce("predicted_count", F.lit(0))
    present = F.when(F.col("s").isNull(), F.col("present")).otherwise(F.col("s") == "accepted")
    return d.select(*KEY, present.alias("present"), status.alias("status"), F.coalesce("p", "confidence").alias("confidence"), F.when(~present, 0).when(n <= 0, F.greatest(F.lit(1), "count")).otherwise(n).alias("count"))


def softmax_scores(votes: DataFrame, entity: tuple[str, ...] = ("entity_id",)) -> DataFrame:
    """+c for a vote, -0.6c against it; softmax over an entity's labels."""
    s = votes.groupBy(*entity, "label", "label_ord").agg(F.sum(F.when(F.col("vote") > 0, F.col("confidence")).when(F.col("vote") < 0, -0.6 * F.col("confidence")).otherwise(0.0)).alias("score"))
    w = Window.partitionBy(*entity)
    e = F.exp(F.col("score") - F.max("score").over(w))
    return s.withColumn("e", e).withColumn("probability", F.col("e") / F.sum("e").over(w)).drop("e")


def top_two(scores: DataFrame, entity: tuple[str, ...] = ("entity_id",)) -> DataFrame:
    """Best label of an entity and its lead over the second; ties in order of labels."""
    w = Window.partitionBy(*entity).orderBy(F.desc("probability"), "label_ord")
    ranked = scores.withColumn("k", F.row_number().over(w)).withColumn("gap", F.col("probability") - F.coalesce(F.lead("probability").over(w), F.lit(0.0)))
    return ranked.where("k = 1").select(*entity, F.col("label").alias("final_type"), "probability", "gap")


def one_vs_rest(scores: DataFrame, entity: tuple[str, ...] = ("entity_id",)) -> DataFrame:
    """Probabilities over their sum, a sum of 0 counting as 1."""
    total = F.sum("probability").over(Window.partitionBy(*entity))
    return scores.withColumn("normalized", F.col("probability") / F.when(total == 0, 1.0).otherwise(total))


def triage(best: DataFrame, accept: float = c.ACCEPT, review: float = c.REVIEW, gap: float = c.MIN_GAP, scope: tuple[str, ...] = c.ENTITY_TYPES) -> DataFrame:
    """Status and reasons from name, evidence, location, scope, probability and lead."""
    p, g = F.col("probability"), F.col("gap")
    status = (
        F.when(F.coalesce("name", F.lit("")) == "", "rejected").when(F.coalesce("evidence_text", F.lit("")) == "", "rejected").when(~F.col("located"), "rejected")
        .when(~F.col("final_type").isin(*scope), "rejected").when((p >= accept) & (g >= gap), "accepted").when(p < review, "rejected").otherwise("review")
    )
    band = F.array_compact(F.array(F.when(g < gap, F.lit("type_conflict_top2_gap")), F.when((p >= review) & (p < accept), F.lit("review_probability_band"))))
    reasons = (
        F.when(F.coalesce("name", F.lit("")) == "", F.array(F.lit("empty_name"))).when(F.coalesce("evidence_text", F.lit("")) == "", F.array(F.lit("empty_evidence")))
        .when(~F.col("located"), F.array(F.lit("evidence_not_located"))).when(~F.col("final_type").isin(*scope), F.array(F.lit("schema_out_of_scope")))
        .when((p >= accept) & (g >= gap), F.array().cast("array<string>")).when(p < review, F.array(F.lit("low_probability"))).otherwise(band)
    )
    return best.withColumn("status", status).withColumn("reasons", reasons)


def protect(triaged: DataFrame, votes: DataFrame, prompts: int = 3, confidence: float = 0.8) -> DataFrame:
    """Three prompts that agree on the candidate type, and none on another, force acceptance."""
    sure = (F.col("vote") > 0) & (F.col("confidence") >= confidence) & F.col("lf").startswith("prompt")
    own = F.col("label") == F.col("candidate_type")
    v = votes.join(triaged.select("entity_id", "candidate_type"), "entity_id").groupBy("entity_id").agg(
        F.count_distinct(F.when(sure & own, F.col("lf"))).alias("agree"), F.count_if(sure & ~own).alias("against"), F.avg(F.when(sure & own, F.col("confidence"))).alias("mean")
    )
    hit = F.coalesce((F.col("agree") >= prompts) & (F.col("against") == 0) & F.col("located"), F.lit(False))
    j = triaged.join(v, "entity_id", "left")
    return j.select(*[x for x in triaged.columns if x not in ("final_type", "probability", "gap", "status")],
        F.when(hit, F.col("candidate_type")).otherwise(F.col("final_type")).alias("final_type"), F.when(hit, F.greatest("mean", "probability")).otherwise(F.col("probability")).alias("probability"),
        F.when(hit, F.greatest("gap", F.lit(0.2))).otherwise(F.col("gap")).alias("gap"), F.when(hit, "accepted").otherwise(F.col("status")).alias("status"), hit.alias("protected"))


def plan_override(triaged: DataFrame, patterns: tuple[str, ...] = c.PLAN_PATTERNS) -> DataFrame:
    """Treatments whose name or evidence gives an order become plans."""
    text = F.concat_ws("\n", F.coalesce("name", F.lit("")), F.coalesce("evidence_text", F.lit("")))
    kinds = F.col("final_type").isin("treatments", "plans") | F.col("candidate_type").isin("treatments", "plans")
    found = reduce(lambda a, b: a | b, [F.rlike(text, F.lit(f"(?iU){p}")) for p in patterns])
    hit = F.coalesce(kinds, F.lit(False)) & found
    return triaged.withColumn("overridden", hit).withColumn("probability", F.when(hit, F.greatest("probability", F.lit(0.72))).otherwise(F.col("probability"))).withColumn(
        "status", F.when(hit & F.col("located"), "accepted").otherwise(F.col("status"))
    ).withColumn("final_type", F.when(hit, "plans").otherwise(F.col("final_type")))


def fallback_count(counts: Column, most: int = 20) -> Column:
    """The greatest count, from 0 to `most`; 0 where there is none."""
    return F.greatest(F.lit(0), F.least(F.lit(most), F.coalesce(F.array_max(counts), F.lit(0))))


def chunk_results(chunks: DataFrame, votes: DataFrame, labels: tuple[str, ...] = c.LABELS) -> DataFrame:
    """A fused record with counts for every chunk and label; chunks without votes have
    rejected ones."""
    label = F.explode(F.array(*map(F.lit, labels))).alias("label")
    every = chunks.select("document_id", "chunk_id", *[x for x in ("section_title", "section_path") if x in chunks.columns], label)
    decisions = weighted_vote(votes)
    made = decisions.join(count_fusion(votes, decisions), KEY)
    out = every.join(made, KEY, "left")
    defaults = {"present": F.lit(False), "status": F.lit("rejected"), "confidence": F.lit(0.0), "vote_score": F.lit(0.0), "count": F.lit(0), "predicted_count": F.lit(0)}
    return out.withColumns({k: F.coalesce(k, v) for k, v in defaults.items() if k in made.columns})


def multiclass_votes(votes: DataFrame) -> DataFrame:
    """Each LF's class of an entity: the label of its most confident positive vote, the last
    of equals by name."""
    best = F.max_by("label", F.struct("confidence", "label"))
    return votes.where("vote > 0").groupBy("document_id", "entity_id", "lf").agg(best.alias("label"))


def multiclass_model(votes: DataFrame, labels: tuple[str, ...], rounds: int = 100, start: float = 0.7) -> DataFrame:
    """document_id, entity_id, label, probability of the most probable class, by
    expectation-maximisation over counted vote patterns, in which each LF has one accuracy.

    votes: multiclass_votes(); a pattern is the LFs' classes, of which there are at most
    (labels + 1) ** LFs, and only those that occur are counted and sent to the driver.
    """
    lfs = sorted(r[0] for r in votes.select("lf").distinct().collect())  # LFs are configured, so few
    rows = votes.groupBy("document_id", "entity_id").pivot("lf", lfs).agg(F.first("label"))
    names = [f"`{x}`" for x in lfs]
    patterns = [(tuple(r[:-1]), r[-1]) for r in rows.groupBy(*names).count().collect()] if lfs else []
    prior, accuracy = dict.fromkeys(labels, 1 / len(labels)), dict.fromkeys(lfs, start)

    def scores(pattern: tuple) -> dict[str, float]:
        s = dict(prior)
        for lf, said in zip(lfs, pattern, strict=True):
            if said is not None:
                for k in labels:
                    s[k] *= accuracy[lf] if said == k else (1 - accuracy[lf]) / (len(labels) - 1)
        total = sum(s.values())
        return {k: v / total for k, v in s.items()}

    for _ in range(rounds if patterns else 0):
        mass, right, said = dict.fromkeys(labels, 1.0), dict.fromkeys(lfs, start), dict.fromkeys(lfs, 1.0)
        for pattern, n in patterns:
            p = scores(pattern)
            for k in labels:
                mass[k] += n * p[k]
            for lf, x in zip(lfs, pattern, strict=True):
                if x is not None:
                    right[lf], said[lf] = right[lf] + n * p[x], said[lf] + n
        prior = {k: v / sum(mass.values()) for k, v in mass.items()}
        accuracy = {k: min(max(right[k] / said[k], 0.05), 0.99) for k in lfs}
    logs = []
    for k in labels:
        parts = [F.when(F.col(f"`{x}`") == k, math.log(accuracy[x])).when(F.col(f"`{x}`").isNotNull(), math.log((1 - accuracy[x]) / (len(labels) - 1))).otherwise(0.0) for x in lfs]
        logs.append(F.struct((reduce(lambda a, b: a + b, parts, F.lit(math.log(prior[k])))).alias("s"), F.lit(k).alias("label")))
    ranked = rows.withColumn("__s", F.array(*logs)).withColumn("__m", F.array_max("__s"))
    share = 1 / F.aggregate("__s", F.lit(0.0), lambda a, x: a + F.exp(x["s"] - F.col("__m.s")))
    return ranked.select("document_id", "entity_id", F.col("__m.label").alias("label"), share.alias("probability"))


def recall_report(triaged: DataFrame, low: float = c.LOW_RECALL) -> DataFrame:
    """Candidates by candidate type, outcomes by final type, joined in full."""
    cand = triaged.groupBy(F.col("candidate_type").alias("label")).agg(F.count("*").alias("candidates"))
    out = triaged.groupBy(F.col("final_type").alias("label")).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "review", "rejected")])
    j = cand.join(out, "label", "full").na.fill(0)
    rate = F.coalesce(F.round(F.try_divide("accepted", "candidates"), 4), F.lit(0.0))
    return j.withColumn("accepted_rate", rate).withColumn("low_recall", F.col("accepted_rate") < low)
