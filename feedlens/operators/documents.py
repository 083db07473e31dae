"""Category summary documents (E5), their contract (W16) and their attachment.

One negative and one positive document per course, in the upstream JSON shape.  Everything
that can be counted is computed from the tiered categories (at most 15 per course and
sentiment); prose that only a model can write is left to the hook, and bullets name the
category with its count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import AMPLIFY_TOP, SAMPLE_ACTIONS, TOP_PRIORITY_ACTIONS, TOP_STRENGTH_AREAS
from ..schemas import ACTION_ITEM, NEGATIVE_SUMMARY_SCHEMA, POSITIVE_SUMMARY_SCHEMA
from .taxonomy import priority_rank

# Themes of categories without detail.
LOW_SIGNAL_NEGATIVE = "low-signal — no specific detail"
LOW_SIGNAL_POSITIVE = "low-signal — general appreciation only"
KEY = ["content_id", "category"]


def _items(actions: Column) -> Column:
    return F.transform(F.slice(actions, 1, SAMPLE_ACTIONS), lambda a: F.struct(
        a.alias("action"), F.col("owner").alias("owner"), F.col("priority").alias("priority"),
        F.lit(None).cast("string").alias("expected_impact")))


def _none() -> Column:
    return F.array().cast(T.ArrayType(ACTION_ITEM))


def _listed(rank: str, value: Column, when: Column | None = None) -> Column:
    """The values of a group's rows in the order of ``rank``."""
    kept = F.struct(F.col(rank).alias("r"), value.alias("v"))
    return F.transform(F.array_sort(F.collect_list(kept if when is None else F.when(when, kept))), lambda x: x["v"])


def _bullet() -> Column:
    return F.concat(F.col("category"), F.lit(": "), F.col("count").cast("string"), F.lit(" comments"))


def own_actions(negative: DataFrame) -> DataFrame:
    """(content_id, category, own): the actions that no category of higher priority has."""
    ex = negative.filter((F.col("tier") != "excluded") & ~F.col("noise")).select(
        *KEY, "rank", priority_rank(F.col("priority")).alias("p"), F.posexplode("actions").alias("pos", "action"))
    first = Window.partitionBy("content_id", "action").orderBy("p", "rank", "pos")
    return (ex.withColumn("n", F.row_number().over(first)).filter("n = 1").groupBy(*KEY)
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "action"))), lambda x: x["action"]).alias("own")))


def negative_documents(tiered: DataFrame, actions: DataFrame) -> DataFrame:
    """One negative document per course (columns of NEGATIVE_SUMMARY_SCHEMA and content_id)."""
    neg = tiered.filter(F.col("sentiment") == "negative").join(own_actions(tiered.filter(F.col("sentiment") == "negative")), KEY, "left")
    item = F.struct(
        "category", "count", (F.col("share") * 100.0).alias("percent_of_negative"), "tier",
        F.when(F.col("noise"), F.array(F.lit(LOW_SIGNAL_NEGATIVE))).alias("key_themes"), "urgency",
        F.coalesce(_items(F.col("own")), _none()).alias("action_items"))
    minor = _listed("rank", _bullet(), F.col("tier") == "minor")
    docs = neg.groupBy("content_id").agg(
        F.max("total").alias("total_negative_comments"),
        F.struct(_listed("rank", _bullet(), F.col("tier") == "major").alias("major_issues_summary"),
                 F.when(F.size(minor) > 0, minor).alias("minor_issues_summary")).alias("grouped_summary"),
        _listed("rank", item).alias("category_summaries"))
    tops = actions.groupBy("content_id").agg(_listed("action_rank", F.struct("action", "category", "owner", "priority")).alias("top_priority_actions"))
    return docs.join(tops, "content_id", "left").select("content_id", *NEGATIVE_SUMMARY_SCHEMA.fieldNames())


def positive_documents(tiered: DataFrame) -> DataFrame:
    """One positive document per course (columns of POSITIVE_SUMMARY_SCHEMA and content_id)."""
    pos = tiered.filter(F.col("sentiment") == "positive")
    shown = F.col("tier") != "excluded"
    item = F.struct(
        "category", "count", (F.col("share") * 100.0).alias("percent_of_positive"), "tier",
        F.when(F.col("noise"), F.array(F.lit(LOW_SIGNAL_POSITIVE))).alias("key_themes"),
        F.when((F.col("rank") <= AMPLIFY_TOP) & ~F.col("noise"), F.element_at("actions", 1)).alias("amplification_suggestion"),
        F.when(shown, _items(F.col("actions"))).otherwise(_none()).alias("action_items"))
    return pos.groupBy("content_id").agg(
        F.max("total").alias("total_positive_comments"),
        F.struct(_listed("rank", _bullet(), shown).alias("strengths_summary")).alias("grouped_summary"),
        F.slice(_listed("rank", F.col("category"), shown), 1, TOP_STRENGTH_AREAS).alias("top_strengths"),
        _listed("rank", item).alias("category_summaries")).select("content_id", *POSITIVE_SUMMARY_SCHEMA.fieldNames())


def contract(negative: DataFrame, positive: DataFrame, tiered: DataFrame) -> DataFrame:
    """One row (content_id, sentiment, category, rule) for each rule that a document breaks,
    judged against the recomputed categories; none for documents that keep the contract."""
    flat = [docs.select("content_id", F.lit(sentiment).alias("sentiment"), F.posexplode("category_summaries").alias("pos", "i")).select(
        "content_id", "sentiment", "pos", "i.category", "i.count", F.col(f"i.percent_of_{sentiment}").alias("percent"), "i.tier", "i.key_themes",
        (F.col("i.urgency") if sentiment == "negative" else F.lit(None).cast("string")).alias("urgency"),
        (F.col("i.amplification_suggestion") if sentiment == "positive" else F.lit(None).cast("string")).alias("suggestion"),
        F.col("i.action_items.action").alias("acts")) for sentiment, docs in (("negative", negative), ("positive", positive))]
    items = flat[0].unionByName(flat[1]).alias("d")
    ref = tiered.alias("r")
    same = [F.col(f"d.{c}") == F.col(f"r.{c}") for c in ("content_id", "sentiment", "category")]
    j = items.join(ref, same[0] & same[1] & same[2], "left")
    is_neg, is_pos, n = F.col("d.sentiment") == "negative", F.col("d.sentiment") == "positive", F.size("d.acts")
    others = Window.partitionBy("d.content_id", "d.sentiment")
    shared = F.size(F.filter("d.acts", lambda a: F.size(F.filter(F.col("all_acts"), lambda b: b == a)) > 1)) > 0
    j = j.withColumn("all_acts", F.flatten(F.collect_list("d.acts").over(others)))  # at most 15 lists of 3
    rules = [
        (F.col("r.rank").isNull(), "unknown category"),
        (F.col("d.pos") + 1 != F.col("r.rank"), "not ordered by count"),
        (F.col("d.count") != F.col("r.count"), "count differs"),
        (F.abs(F.col("d.percent") - F.col("r.share") * 100.0) > 1e-9, "share differs"),
        (F.col("d.tier") != F.col("r.tier"), "tier differs"),
        (is_neg & ~F.col("d.urgency").eqNullSafe(F.col("r.urgency")), "urgency differs"),
        ((F.col("r.tier") == "excluded") & (n > 0), "actions on excluded category"),
        (is_neg & F.col("r.noise") & (n > 0), "actions on noise category"),
        (F.col("r.noise") & F.col("d.key_themes").isNull(), "noise without its theme"),
        (is_pos & (F.col("r.tier") != "excluded") & (n < 2), "too few actions"),
        (is_pos & ((F.col("r.rank") > AMPLIFY_TOP) | F.col("r.noise")) & F.col("d.suggestion").isNotNull(), "suggestion not due"),
        (is_neg & shared, "action repeated"),
    ]
    broken = F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in rules]), lambda r: r.isNotNull())
    per_item = j.select(F.col("d.content_id").alias("content_id"), F.col("d.sentiment").alias("sentiment"), F.col("d.category").alias("category"), F.explode(broken).alias("rule"))
    totals = tiered.groupBy("content_id", "sentiment").agg(
        F.max("total").alias("ref_total"), F.count_if(F.col("tier") == "minor").alias("minors"), F.count_if(F.col("tier") != "excluded").alias("shown"))
    neg = negative.join(totals.filter("sentiment = 'negative'"), "content_id", "left").select("content_id", F.lit("negative").alias("sentiment"), F.array(
        F.when(F.col("total_negative_comments") != F.col("ref_total"), F.lit("total differs")),
        F.when(F.size(F.coalesce("top_priority_actions", F.array())) != TOP_PRIORITY_ACTIONS, F.lit("top actions not exactly 3")),
        F.when(F.size(F.array_distinct("top_priority_actions.action")) != F.size("top_priority_actions"), F.lit("top actions repeated")),
        F.when((F.col("minors") == 0) != F.col("grouped_summary.minor_issues_summary").isNull(), F.lit("minor list not null exactly without minors"))).alias("b"))
    pos = positive.join(totals.filter("sentiment = 'positive'"), "content_id", "left").select("content_id", F.lit("positive").alias("sentiment"), F.array(
        F.when(F.col("total_positive_comments") != F.col("ref_total"), F.lit("total differs")),
        F.when(F.size("top_strengths") != F.least(F.lit(TOP_STRENGTH_AREAS), F.col("shown")), F.lit("top strengths not the first three"))).alias("b"))
    whole = neg.unionByName(pos).select("content_id", "sentiment", F.lit(None).cast("string").alias("category"),
                                        F.explode(F.filter("b", lambda r: r.isNotNull())).alias("rule"))
    return per_item.unionByName(whole)


def attach(courses: DataFrame, negative: DataFrame, positive: DataFrame) -> DataFrame:
    """Courses with neg_category_summary and pos_category_summary as JSON, {} by default."""
    out = courses
    for docs, name in ((negative, "neg_category_summary"), (positive, "pos_category_summary")):
        fields = [c for c in docs.columns if c != "content_id"]
        out = out.join(docs.select("content_id", F.to_json(F.struct(*fields)).alias(name)), "content_id", "left") \
            .withColumn(name, F.coalesce(name, F.lit("{}")))
    return out
