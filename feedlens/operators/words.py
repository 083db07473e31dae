"""Word frequencies per sentiment (A18) and the stopword set.

Word count at scale: tokens are filtered inside the row (stopwords, length) before the
explode, so the shuffle only carries useful tokens, and the (sentiment, word) count has
a map-side partial aggregation, which absorbs hot words ("the" may be a third of all
tokens) before the shuffle.  The top-k per sentiment is a row_number <= k that Spark
plans with a partial WindowGroupLimit below the exchange, so each sentiment's final
task sees at most k rows per upstream partition, never the whole vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fixed import STOPWORDS_DEFAULT, STOPWORDS_EXTRA, WORDS_MIN_LENGTH, WORDS_TOP_K
from ..functions.text import tokens


def stopword_list() -> list[str]:
    return sorted(set(STOPWORDS_DEFAULT) | set(STOPWORDS_EXTRA))


def stopwords(spark: SparkSession) -> DataFrame:
    """Default stopwords union the extras, distinct."""
    d = spark.createDataFrame([(w,) for w in STOPWORDS_DEFAULT], "word string")
    e = spark.createDataFrame([(w,) for w in STOPWORDS_EXTRA], "word string")
    return d.union(e).distinct()


def word_frequency(tagged: DataFrame, k: int = WORDS_TOP_K, sentiment_col: str = "predicted_sentiment") -> DataFrame:
    """Top-k words per sentiment with count and weight relative to the top word.

    Input: comments with a sentiment label (lower-cased, null comments dropped, P10).
    Ties: word ascending.  Pure-digit tokens never appear (tokens are letter runs).
    """
    src = (tagged.filter(F.col("comment").isNotNull())
           .select(F.lower(F.col(sentiment_col)).alias("sentiment"), F.explode(tokens(F.col("comment"))).alias("word"))
           # hash-set membership and length test on the exploded rows, inside codegen
           .filter((F.length("word") >= WORDS_MIN_LENGTH) & ~F.col("word").isin(*stopword_list())))
    counts = src.groupBy("sentiment", "word").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("sentiment").orderBy(F.desc("count"), F.asc("word"))
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    # rank 1 is in the same window partition; max over the (<= k rows) partition
    mx = F.max("count").over(Window.partitionBy("sentiment"))
    return top.select("sentiment", "rank", "word", "count", (F.col("count") / mx.cast("double")).alias("weight"))
