"""The standard flow, composed once from the operators.

Functions return lazy DataFrames, but for the fact tables (``scored_full`` and what is built
on it): these are written to the shared folder when the function is called, because
several branches of one plan read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import text_key
from ..operators import category, clean, dashboard, language, sentiment
from ..operators.taxonomy import join_taxonomy
from ..session import materialize
from ..sources.tables import mapped_category_no, mapped_latency, mapped_sentiment, raw_comments

EDIT = " edited"
RESUME_CUTOFF = "2024-03-01"   # the earlier run saw comments dated before this day


def split(spark: SparkSession, sf_dir: str, with_labels: bool = False) -> DataFrame:
    return clean.split_comments(raw_comments(spark, sf_dir, with_labels))


def tagged(spark: SparkSession, sf_dir: str, with_labels: bool = False) -> DataFrame:
    """Cleaned comments (both buckets) with the predicted sentiment."""
    return sentiment.score_sentiment(clean.clean_comments(raw_comments(spark, sf_dir, with_labels)))


def full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(spark, sf_dir).filter(F.col("bucket") == "full")


def tagged_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full comments with the stored sentiment label (a mapped input)."""
    c = clean.clean_comments(raw_comments(spark, sf_dir)).filter(F.col("bucket") == "full")
    return c.withColumn("predicted_sentiment", mapped_sentiment(F.col("comment"), F.col("ordinal")))


def detected(spark: SparkSession, sf_dir: str, lenient: bool = False) -> DataFrame:
    prof = language.LENIENT_DETECTION if lenient else language.STRICT_DETECTION
    return language.detect_language(full(spark, sf_dir), prof=prof)


def detection_input(spark: SparkSession, sf_dir: str, lenient: bool = False) -> DataFrame:
    """Stored detection rows (a mapped input): the detector's, with a service latency, and one
    in thirteen a failed call."""
    d = detected(spark, sf_dir, lenient)
    failed = F.col("ordinal") % 13 == 0
    return (d.withColumn("latency", F.when(failed, 0.0).otherwise(mapped_latency(F.col("comment"))))
            .withColumn("predicted_language", F.when(failed, "ERROR").otherwise(F.col("predicted_language"))))


def categorized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The built-in categoriser (E3) on the comments routed to it."""
    return category.categorize(tagged_input(spark, sf_dir))


def analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored analysis records (a mapped input): negative and positive full comments with
    their category number, joined to the taxonomy."""
    t = tagged_input(spark, sf_dir).withColumn("sentiment", F.col("predicted_sentiment"))
    t = t.filter(F.col("sentiment").isin("negative", "positive"))
    return category.analysis_records(t.withColumn("category_no", mapped_category_no(F.col("ordinal"))))


def earlier_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run had analysed: comments dated before the cutoff."""
    return analysis(spark, sf_dir).filter(F.col("comment_date") < RESUME_CUTOFF)


def scored_full(spark: SparkSession, sf_dir: str, profile: dashboard.Profile = dashboard.STRICT,
                with_language: bool = False, texts: bool = True) -> DataFrame:
    """The dashboard fact table, computed in one row-wise pass and written once.

    Full comments + sentiment key + stored category (negative / positive rows only) + the digest
    of the normalised comment (+ detected language, + the digest of the edited comment).  It feeds two or three join branches, so it
    is written to the shared folder as Parquet, and every branch reads the columns it needs.
    Without ``texts`` the comments are read, normalised, hashed and told by language as ever, but not written again.
    """
    t = tagged_input(spark, sf_dir).withColumn("sentiment", sentiment.sentiment_key(F.col("predicted_sentiment")))
    no = F.when(F.col("sentiment").isin("negative", "positive"), mapped_category_no(F.col("ordinal")))
    t = join_taxonomy(t.withColumn("category_no", no)).withColumn("error", F.lit(None).cast("string"))
    t = t.withColumn("_norm", profile.norm(F.col("comment"))).withColumn("norm_key", text_key(F.col("_norm")))
    if with_language:
        t = t.withColumn("edited_key", F.when(was_edited(), text_key(F.concat("_norm", F.lit(EDIT)))))
        prof = language.LENIENT_DETECTION if profile.lenient else language.STRICT_DETECTION
        t = language.detect_language(t, prof=prof)
    # no reader of the facts asks for the words of a whole text: they are not counted
    return materialize(t.drop("_norm", "word_count", *([] if texts else ["comment"])), "facts")


def analysis_of(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("sentiment").isin("negative", "positive"))


def enriched(spark: SparkSession, sf_dir: str, profile: dashboard.Profile = dashboard.STRICT) -> DataFrame:
    s = scored_full(spark, sf_dir, profile)
    return dashboard.enrich(s, analysis_of(s), profile)


def was_edited() -> Column:
    return F.col("ordinal") % 17 == 0


def language_side(scored: DataFrame) -> DataFrame:
    """The stored language rows (a mapped input): one comment in seventeen was edited after its
    detection, so it matches no comment of the analysis side."""
    rows = scored.withColumn("norm_key", F.when(was_edited(), F.col("edited_key")).otherwise(F.col("norm_key")))
    if "comment" not in rows.columns:
        return rows
    return rows.withColumn("comment", F.when(was_edited(), F.concat("comment", F.lit(EDIT))).otherwise(F.col("comment")))


def language_facts(spark: SparkSession, sf_dir: str, profile: dashboard.Profile = dashboard.STRICT, texts: bool = True) -> DataFrame:
    """The language facts; without ``texts`` for queries that ask for no comment."""
    s = scored_full(spark, sf_dir, profile, with_language=True, texts=texts)
    enr = dashboard.enrich(s, analysis_of(s), profile)
    return dashboard.language_facts(language_side(s), enr, profile)


def dashboard_facts(spark: SparkSession, sf_dir: str, profile: dashboard.Profile = dashboard.STRICT,
                    scored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(enriched, language facts) from one scored table, both materialised: the dashboard
    bundle reads each of them in several aggregates.  Texts are kept by the language facts alone."""
    s = scored_full(spark, sf_dir, profile, with_language=True) if scored is None else scored
    enr = materialize(dashboard.enrich(s, analysis_of(s), profile).drop("comment", "norm"))
    return enr, materialize(dashboard.language_facts(language_side(s), enr, profile))


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category.tiers(category.category_groups(analysis(spark, sf_dir)))
