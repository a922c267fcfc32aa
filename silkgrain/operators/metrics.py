"""Reports (M rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROW = ["document_id", "chunk_id", "label"]


def lf_summary(votes: DataFrame) -> DataFrame:
    """M1: coverage, positive rate, overlap, conflict of each LF over all (chunk, label) rows.

    A row's votes are counted once, in one aggregation, and joined back to its votes."""
    rows = votes.groupBy(*ROW).agg(F.count_if(F.col("vote") != 0).alias("active"), F.count_if(F.col("vote") > 0).alias("pos"), F.count_if(F.col("vote") < 0).alias("neg"))
    total = rows.agg(F.count("*").alias("rows"))
    j = votes.join(rows, ROW)
    on, vote = F.col("vote") != 0, F.col("vote")
    against = (on & (vote > 0) & (F.col("neg") > 0)) | (on & (vote < 0) & (F.col("pos") > 0))
    g = j.groupBy("lf").agg(
        F.count_if(on).alias("covered"), F.count_if(vote > 0).alias("positive"), F.count_if(on & (F.col("active") > 1)).alias("overlap"), F.count_if(against).alias("conflict"),
        F.avg(F.when(vote > 0, F.col("confidence"))).alias("mean_confidence"), F.avg(F.when(vote > 0, F.col("count"))).alias("mean_count"),
    )
    share = lambda x: F.col(x) / F.col("rows")
    return g.crossJoin(F.broadcast(total)).select("lf", share("covered").alias("coverage"), share("positive").alias("positive_rate"), share("overlap").alias("overlap_rate"), share("conflict").alias("conflict_rate"), "mean_confidence", "mean_count")


def lf_analysis(votes: DataFrame) -> DataFrame:
    """M2: of each LF the polarities it uses, and the shares of (chunk, label) rows that it covers,
    where another LF answers too, and where another one answers otherwise."""
    rows = votes.groupBy(*ROW).agg(F.count_if(F.col("vote") > 0).alias("pos"), F.count_if(F.col("vote") < 0).alias("neg"))
    total = rows.agg(F.count("*").alias("rows"))
    j = votes.join(rows, ROW)
    on, against = F.col("vote") != 0, F.when(F.col("vote") > 0, F.col("neg")).otherwise(F.col("pos"))
    g = j.groupBy("lf").agg(
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("vote") > 0, "positive").when(F.col("vote") < 0, "negative"))), ", ").alias("polarity"),
        F.count_if(on).alias("c"), F.count_if(on & (F.col("pos") + F.col("neg") > 1)).alias("o"), F.count_if(on & (against > 0)).alias("k"),
    )
    share = lambda x, name: (F.col(x) / F.col("rows")).alias(name)
    return g.crossJoin(F.broadcast(total)).select("lf", "polarity", share("c", "coverage"), share("o", "overlaps"), share("k", "conflicts"))


def label_summary(decisions: DataFrame) -> DataFrame:
    """M3: outcomes, rate and means of each label."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    ok = F.col("status") == "accepted"
    return decisions.groupBy("label").agg(is_("accepted").alias("accepted"), is_("weak").alias("weak"), is_("rejected").alias("rejected"), (is_("accepted") / F.count("*")).alias("accepted_rate"), F.avg(F.when(ok, F.col("confidence"))).alias("mean_confidence"), F.count_if(ok & (F.size("supporting_lfs") == 0)).alias("accepted_without_support"))


def document_summary(documents: DataFrame, decisions: DataFrame) -> DataFrame:
    """M4: chunks, accepted rows, their confidence and labels of each document."""
    ok = F.col("status") == "accepted"
    g = decisions.groupBy("document_id").agg(F.count_distinct("chunk_id").alias("chunks"), F.count("*").alias("rows"), F.count_if(ok).alias("accepted"), F.avg(F.when(ok, F.col("confidence"))).alias("mean_confidence"), F.count_distinct(F.when(ok, F.col("label"))).alias("label_types"))
    j = documents.select("document_id").join(g, "document_id", "left").na.fill(0)
    return j.withColumn("accepted_rate", F.coalesce(F.try_divide("accepted", "rows"), F.lit(0.0)))


def heat_map(votes: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """M5: share of positive votes by LF and label, a column a label."""
    return votes.groupBy("lf").pivot("label", list(labels)).agg(F.avg((F.col("vote") > 0).cast("double"))).na.fill(0.0)


def top_documents(report: DataFrame, n: int = 12) -> DataFrame:
    """M6: the n documents with most accepted rows, with codes."""
    top = report.where("rows > 0").orderBy(F.desc("accepted"), "document_id").limit(n)
    return top.withColumn("code", F.format_string("D%02d", F.row_number().over(Window.orderBy(F.desc("accepted"), "document_id"))))


def global_metrics(decisions: DataFrame) -> DataFrame:
    """M7."""
    return decisions.agg(F.count_distinct("document_id", "chunk_id").alias("chunks"), F.coalesce(F.try_divide(F.count_if(F.col("status") == "accepted"), F.count("*")), F.lit(0.0)).alias("accepted_rate"))


def entity_lf_analysis(votes: DataFrame) -> DataFrame:
    """M8: coverage of each LF; points (entity, label) with two active and with opposed votes."""
    points = votes.groupBy("entity_id", "label").agg(F.count_if(F.col("vote") != 0).alias("a"), F.count_if(F.col("vote") > 0).alias("p"), F.count_if(F.col("vote") < 0).alias("n"))
    g = points.agg(F.count_if(F.col("a") >= 2).alias("overlap_points"), F.count_if((F.col("p") > 0) & (F.col("n") > 0)).alias("conflict_points"))
    return votes.groupBy("lf").agg(F.round(F.count_if(F.col("vote") != 0) / F.count("*"), 4).alias("coverage")).crossJoin(F.broadcast(g))


def length_stats(chunks: DataFrame) -> DataFrame:
    """M9: chunk lengths by document, percentiles by nearest rank."""
    n = F.length("text")
    return chunks.groupBy("document_id").agg(F.min(n).alias("min"), F.max(n).alias("max"), F.avg(n).alias("avg"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY length(text))").cast("int").alias("p50"), F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY length(text))").cast("int").alias("p90"))


def heading_report(chunks: DataFrame, generic: tuple[str, ...]) -> DataFrame:
    """Share of chunks with a real title, with a path below it, and their weighted score."""
    hit = ~F.coalesce("title", F.lit("")).isin("", *generic)
    deep = hit & (F.size("path") > 2)
    g = chunks.groupBy("document_id").agg(F.count("*").alias("n"), (F.count_if(hit) / F.count("*")).alias("h"), (F.count_if(deep) / F.count("*")).alias("d"))
    return g.select("document_id", "n", F.round("h", 4).alias("heading_hit_rate"), F.round("d", 4).alias("hierarchical_hit_rate"), F.round(0.7 * F.col("h") + 0.3 * F.col("d"), 4).alias("weighted_hit_score"))


def top_titles(chunks: DataFrame, n: int = 15) -> DataFrame:
    """The n most frequent titles, the first seen first on ties."""
    return chunks.groupBy("title").agg(F.count("*").alias("n"), F.min("ord").alias("first")).orderBy(F.desc("n"), "first").limit(n).drop("first")


def run_summary(decisions: DataFrame) -> DataFrame:
    """Chunks with any present label, and present rows by label."""
    return decisions.groupBy("label").agg(F.count_distinct(F.when(F.col("present"), F.struct("document_id", "chunk_id"))).alias("chunks"), F.count_if("present").alias("present"))
