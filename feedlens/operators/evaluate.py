"""Evaluation of predicted labels against ground truth.

Everything is a small aggregate over (true, predicted) pairs: one shuffle with a
map-side partial aggregation, whatever the number of rows.  Per-label metrics come
from the confusion counts, never from collecting labels.  Global and per-course
reports are one ``GROUPING SETS`` pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def truth_label(df: DataFrame, col: str = "actual_sentiment") -> DataFrame:
    """Truth: null -> 'neutral', lower-cased (not trimmed)."""
    return df.withColumn("true_label", F.lower(F.coalesce(F.col(col), F.lit("neutral"))))


def label_union(ev: DataFrame) -> DataFrame:
    """Sorted distinct union of true and predicted labels."""
    pairs = ev.groupBy("true_label", "predicted_sentiment").count()
    return pairs.select(F.explode(F.array("true_label", "predicted_sentiment")).alias("label")).distinct().orderBy("label")


def confusion_matrix(ev: DataFrame) -> DataFrame:
    """Long-form matrix over label x label (zero cells included)."""
    counts = ev.groupBy("true_label", "predicted_sentiment").agg(F.count(F.lit(1)).alias("n"))
    # one row of all pair counts (at most labels squared of them), so the input is read once
    row = counts.agg(F.collect_list(F.struct("true_label", "predicted_sentiment", "n")).alias("cells"))
    labels = F.array_distinct(F.concat(F.col("cells.true_label"), F.col("cells.predicted_sentiment")))
    grid = (row.select("cells", labels.alias("labels")).select("cells", "labels", F.explode("labels").alias("true_label"))
            .select("cells", "true_label", F.explode("labels").alias("predicted_label")))
    n = F.expr("aggregate(filter(cells, c -> c.true_label = true_label and c.predicted_sentiment = predicted_label), 0L, (a, c) -> a + c.n)")
    return grid.select("true_label", "predicted_label", n.alias("count"))


def classification_report(ev: DataFrame, per_course: bool = True) -> DataFrame:
    """Precision / recall / F1 / support per label plus macro and weighted averages,
    zero division -> 0, globally (content_id null) and per course.

    One pass: the (true, predicted) pair counts of every scope (GROUPING SETS) are
    exploded into per-label contributions (support from the true side, predictions from
    the predicted side, true positives where they agree) and summed; the averages are
    windows over each scope's few label rows, and the two average rows per scope come
    from the same rows through an explode, so the scored input is read once.
    """
    if per_course:
        pairs = (ev.groupingSets([["content_id", "true_label", "predicted_sentiment"],
                                  ["true_label", "predicted_sentiment"]],
                                 "content_id", "true_label", "predicted_sentiment")
                 .agg(F.count(F.lit(1)).alias("n"), F.grouping("content_id").alias("gid")))
    else:
        pairs = (ev.groupBy("true_label", "predicted_sentiment").agg(F.count(F.lit(1)).alias("n"))
                 .withColumn("content_id", F.lit(None).cast("string")).withColumn("gid", F.lit(1)))
    scope = ["gid", "content_id"]
    n, agree = F.col("n"), (F.col("true_label") == F.col("predicted_sentiment"))
    contrib = F.array(
        F.struct(F.col("true_label").alias("label"), n.alias("support"), F.lit(0).cast("long").alias("pred"),
                 F.when(agree, n).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col("predicted_sentiment").alias("label"), F.lit(0).cast("long").alias("support"),
                 n.alias("pred"), F.lit(0).cast("long").alias("tp")))
    per = (pairs.select(*scope, F.explode(contrib).alias("c"))
           .groupBy(*scope, F.col("c.label").alias("label"))
           .agg(F.sum("c.tp").alias("tp"), F.sum("c.support").alias("support"), F.sum("c.pred").alias("pred")))
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.withColumn("precision", p).withColumn("recall", r)
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    w = Window.partitionBy(*scope)
    tot = F.sum("support").over(w).cast("double")

    def wavg(c):
        return F.try_divide(F.sum(F.col(c) * F.col("support")).over(w), tot)
    first = F.row_number().over(Window.partitionBy(*scope).orderBy("label")) == 1
    rows = per.select(
        *scope, first.alias("_first"),
        F.struct(F.col("label"), F.col("precision"), F.col("recall"), F.col("f1"), F.col("support")).alias("own"),
        F.struct(F.lit("macro avg").alias("label"), F.avg("precision").over(w).alias("precision"),
                 F.avg("recall").over(w).alias("recall"), F.avg("f1").over(w).alias("f1"),
                 F.sum("support").over(w).alias("support")).alias("macro"),
        F.struct(F.lit("weighted avg").alias("label"), wavg("precision").alias("precision"),
                 wavg("recall").alias("recall"), wavg("f1").alias("f1"),
                 F.sum("support").over(w).alias("support")).alias("weighted"))
    out = rows.select(*scope, F.explode(F.when(F.col("_first"), F.array("own", "macro", "weighted"))
                                        .otherwise(F.array("own"))).alias("r"))
    # Averages are sums of a few doubles whose last bit depends on summation order;
    # reported at 12 decimals so every engine gives the same value.
    return out.select(F.when(F.col("gid") == 1, F.lit(None)).otherwise(F.col("content_id")).cast("string")
                      .alias("content_id"), "r.label", *[F.round(f"r.{m}", 12).alias(m)
                                                         for m in ("precision", "recall", "f1")], "r.support")


def accuracy(ev: DataFrame, per_course: bool = False) -> DataFrame:
    """Correct / total."""
    hit = (F.col("true_label") == F.col("predicted_sentiment")).cast("double")
    g = ev.groupBy("content_id") if per_course else ev
    return g.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))
