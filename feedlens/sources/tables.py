"""Sources: the driver's parquet tables and the comment tables derived from them.

``raw_comments`` maps the ``documents`` table (joined to ``labels`` only when ground
truth is asked for) onto the raw comment schema:

    content_id, content_name, comment, comment_date, ordinal[, actual_sentiment, true_lang]

``ordinal`` (= doc_id) is the explicit input order every "first seen" / "last wins"
rule breaks ties on, so results never depend on file or partition order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_COURSES = 5
DATE_BASE = "2024-01-01"
DATE_SUFFIXES = ["", "T10:00:00", " 10:00:00"]

# Columns each table must provide for the comment flow.
REQUIRED = {
    "documents": ["doc_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    missing = [c for c in REQUIRED.get(name, []) if c not in df.columns]
    if missing:
        raise ValueError(f"table {name} lacks required columns {missing}")
    return df


#: A task that reads more rows than this, and more than twice its share, is too long; rows of a task after that.
LONG_TASK, SHORT_TASK = 4096, 16_384


def spread(df: DataFrame) -> DataFrame:
    """``df``, rewritten as more files where a few tasks would read most of it.

    A row group is read by one task, so an input of few row groups leaves most cores idle; footers tell the
    rows of each task.  ``spark.feedlens.inputPartitions`` sets the number of files, whatever the input is.
    The rewritten table also keeps Catalyst from moving the text work below the exchange, back into the few
    scan tasks.  An input with enough row groups is not shuffled or copied.
    """
    n = df.sparkSession.conf.get("spark.feedlens.inputPartitions", None) or _parts_needed(df)
    if not n:
        return df
    from ..session import materialize
    # dealt out by a number, not round robin: that would sort whole rows first
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartition(int(n), "_row")
    return materialize(dealt.drop("_row"), "spread")


def _parts_needed(df: DataFrame) -> int | None:
    """The number of parts that ``df`` should have, if a task of it holds far more rows than its share."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    most, rows = tasks.agg(F.max("n"), F.sum("n")).first()
    if not rows or most <= max(LONG_TASK, 2 * rows / slots):
        return None
    return max(3 * slots, -(-rows // SHORT_TASK))


def actual_sentiment(quality: Column, toxic: Column) -> Column:
    """Ground truth from the labels table: toxic -> negative, quality 1/0 -> positive/neutral."""
    return (F.when(toxic == 1, "negative")
            .when(quality == 1, "positive")
            .when(quality == 0, "neutral"))


def comment_date_of(ordinal: Column) -> Column:
    """A raw date-time text in one of three shapes: date, date'T'time, date' 'time."""
    day = F.date_add(F.lit(DATE_BASE).cast("date"), (ordinal % 365).cast("int"))
    suffix = F.element_at(F.array(*[F.lit(s) for s in DATE_SUFFIXES]), (ordinal % 3 + 1).cast("int"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), suffix)


def raw_comments(spark: SparkSession, sf_dir: str, with_labels: bool = False) -> DataFrame:
    """Raw comment rows derived from ``documents`` (whole texts, all rows)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = spread(docs)
    cols = [
        F.concat(F.lit("course_"), (F.col("doc_id") % N_COURSES).cast("string")).alias("content_id"),
        F.concat(F.lit("Course "), (F.col("doc_id") % N_COURSES).cast("string")).alias("content_name"),
        F.col("text").alias("comment"),
        comment_date_of(F.col("doc_id")).alias("comment_date"),
        F.col("doc_id").alias("ordinal"),
        F.col("lang").alias("true_lang"),
    ]
    if not with_labels:
        return docs.select(*cols)
    # labels is a large table at scale (a share of documents): a shuffled equi join on
    # doc_id; AQE turns it into a broadcast only when the runtime size allows.
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return (docs.join(labels, "doc_id", "left")
            .select(*cols, actual_sentiment(F.col("quality"), F.col("toxic")).alias("actual_sentiment")))


def conversation_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of ``conversations`` as a second comment source (same schema)."""
    conv = spark.read.parquet(table_path(sf_dir, "conversations"))
    return conv.select(F.concat(F.lit("course_"), (F.col("conv_id") % N_COURSES).cast("string")).alias("content_id"),
                       F.concat(F.lit("Course "), (F.col("conv_id") % N_COURSES).cast("string")).alias("content_name"),
                       F.col("text").alias("comment"),
                       comment_date_of(F.col("conv_id")).alias("comment_date"),
                       (F.col("conv_id") * 1000 + F.col("turn")).alias("ordinal"),
                       F.lit(None).cast("string").alias("true_lang"))


# ----------------------------------------------------------------------------- mapped inputs
# The driver's tables hold no labelled or analysed comments.  These columns stand for what a
# sentiment model and an analysis service had stored beforehand: inputs, not operators.
def mapped_sentiment(comment: Column, ordinal: Column) -> Column:
    """Input: the stored sentiment label; the negative share rises with the course number."""
    n = F.length(comment)
    return (F.when(n % 20 < 2 + 3 * (ordinal % N_COURSES), "negative").when(n % 3 == 0, "neutral").otherwise("positive"))


def mapped_category_no(ordinal: Column) -> Column:
    """Input: the stored category number, skewed to 1, so that all tiers occur."""
    k = F.floor(ordinal / N_COURSES)
    return (1 + ((k % 9) * (k % 4)) % 15).cast("int")


def mapped_latency(comment: Column) -> Column:
    """Input: the stored service latency in seconds."""
    return (F.length(comment) % 50).cast("double") / 1000.0
