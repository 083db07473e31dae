"""Cleaning and splitting raw comments (P1-P6) and the per-course split counts (A1).

One pass assigns every row a ``bucket`` (``short`` <= 3 words, ``full`` > 3 words,
``skipped`` blank comment) instead of filtering the input several times.  Rows whose
course id is blank are dropped before anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import SHORT_MAX_WORDS
from ..functions.text import more_words_than, normalize_date, utrim, word_count


def split_comments(raw: DataFrame) -> DataFrame:
    """P1-P6 as one narrow projection; keeps any extra columns (ordinal, labels)."""
    extra = [c for c in raw.columns if c not in ("content_id", "content_name", "comment", "comment_date")]
    cid = utrim(F.coalesce(F.col("content_id"), F.lit("")))
    comment = utrim(F.coalesce(F.col("comment"), F.lit("")))
    wc = word_count(comment)
    return (raw
            .withColumn("content_id", cid)
            .filter(F.col("content_id") != "")                                   # P1
            .select(F.col("content_id"),
                    utrim(F.coalesce(F.col("content_name"), F.lit(""))).alias("content_name"),  # P3
                    comment.alias("comment"),
                    normalize_date(F.coalesce(F.col("comment_date"), F.lit(""))).alias("comment_date"),  # P4
                    wc.alias("word_count"),                                         # P5
                    *[F.col(c) for c in extra])
            .withColumn("bucket",                                                   # P2 / P6
                        F.when(F.col("comment") == "", "skipped")
                        # the first words tell: a filter by bucket counts no whole text
                        .when(~more_words_than(F.col("comment"), SHORT_MAX_WORDS), "short")
                        .otherwise("full")))


def clean_comments(raw: DataFrame) -> DataFrame:
    """Split rows without the skipped (blank) ones."""
    return split_comments(raw).filter(F.col("bucket") != "skipped")


def course_length_counts(split: DataFrame) -> DataFrame:
    """A1: short / full / skipped per course plus a grand-total row (content_id null).

    ``rollup`` keeps this one aggregation with a map-side partial step; the per-course
    key is low cardinality, so the shuffle carries one row per course per task.
    """
    return (split.rollup("content_id")
            .agg(F.count_if(F.col("bucket") == "short").alias("short_count"),
                 F.count_if(F.col("bucket") == "full").alias("full_count"),
                 F.count_if(F.col("bucket") == "skipped").alias("skipped_count")))
