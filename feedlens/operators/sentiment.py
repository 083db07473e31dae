"""Sentiment labelling (E1, P7-P10) and sentiment counts (A2, A3).

The built-in scorer is a polarity lexicon applied to the whole text as one
higher-order expression: tokens -> lexicon weight -> sum -> sign.  It is a narrow,
row-wise projection (no explode, no join, no shuffle), so it scales with the scan.
A model plugs in through ``operators.enrich.model_udf`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import SENTIMENT_LEXICON
from ..functions.text import extract_words, is_blank, utrim

LABELS = ["positive", "neutral", "negative"]
PLACEHOLDER = "neutral statement"


def lexicon_map(lexicon: dict[str, int]) -> Column:
    keys, vals = zip(*sorted(lexicon.items()))
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(int(v)) for v in vals]))


def scoring_text(col: Column) -> Column:
    """Null or blank text is scored as a neutral placeholder."""
    return F.when(is_blank(col), F.lit(PLACEHOLDER)).otherwise(col)


def lexicon_score(col: Column, lexicon: dict[str, int] = SENTIMENT_LEXICON) -> Column:
    """Sum of lexicon weights over the whole text's tokens.

    One compiled regex pass pulls out only the lexicon tokens (few per text); the
    weight lookup then runs over that short array, not over every token.
    """
    m = lexicon_map(lexicon)
    hits = extract_words(F.lower(F.coalesce(col, F.lit(""))), lexicon.keys())
    return F.aggregate(hits, F.lit(0), lambda acc, t: acc + F.coalesce(F.try_element_at(m, t), F.lit(0)))


def polarity(score: Column) -> Column:
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


def label_map(label: Column) -> Column:
    """A model's label to lower case; missing -> neutral."""
    return F.lower(F.coalesce(label, F.lit("neutral")))


def score_sentiment(df: DataFrame, text_col: str = "comment", out: str = "predicted_sentiment",
                    lexicon: dict[str, int] = SENTIMENT_LEXICON) -> DataFrame:
    """E1 default scorer."""
    return df.withColumn(out, label_map(polarity(lexicon_score(scoring_text(F.col(text_col)), lexicon))))


def sentiment_key(col: Column) -> Column:
    """Label as used for routing (strip + lower); anything unexpected is neutral."""
    s = F.lower(utrim(F.coalesce(col, F.lit("neutral"))))
    return F.when(s.isin("positive", "negative"), s).otherwise(F.lit("neutral"))


def sentiment_filter(df: DataFrame, sentiment: str, col: str = "predicted_sentiment") -> DataFrame:
    """Rows of one sentiment (stripped, lower-cased label)."""
    return df.filter(F.lower(utrim(F.col(col))) == sentiment)


def course_sentiment_counts(tagged: DataFrame, by=("content_id", "bucket")) -> DataFrame:
    """A2: positive / neutral / negative per course file (course x bucket)."""
    s = F.col("predicted_sentiment")
    return (tagged.groupBy(*by)
            .agg(F.count_if(s == "positive").alias("positive"),
                 F.count_if(s == "neutral").alias("neutral"),
                 F.count_if(s == "negative").alias("negative")))


def overall_sentiment(tagged: DataFrame) -> DataFrame:
    """A3 (+A19): totals and shares over all comments; one row.

    Anything that is not positive/negative counts as neutral; shares divide by
    max(1, total) and stay raw doubles (formatting happens only at export).
    """
    s = sentiment_key(F.col("predicted_sentiment"))
    agg = tagged.agg(F.count(F.lit(1)).alias("total_comments"),
                     F.countDistinct("content_id").alias("course_count"),
                     F.count_if(s == "positive").alias("positive_count"),
                     F.count_if(s == "negative").alias("negative_count"),
                     F.count_if(s == "neutral").alias("neutral_count"))
    tot = F.greatest(F.lit(1), F.col("total_comments")).cast("double")
    return agg.select("*", *[(F.col(f"{k}_count") / tot * 100.0).alias(f"{k}_percent")
                             for k in ("positive", "negative", "neutral")])
