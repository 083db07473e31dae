"""Sinks (K1-K7).

Parquet is the format between steps; CSV / JSON / text are edge formats.  Layouts are
partitioned by course (and bucket / sentiment) so a later read of one course prunes
every other folder.  Writes go through Spark's committer (task-level commit, so a lost
executor's partial output is never visible).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..fixed import ANALYSIS_RECORD_FIELD, ANALYSIS_SENTIMENT_FIELD
from ..operators.enrich import token_usage
from ..session import materialize


def _csv(df: DataFrame, mode: str = "overwrite"):
    return (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
            .option("encoding", "UTF-8"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain CSV export (quoted newlines survive a multi-line read)."""
    _csv(df, mode).csv(path)


def write_course_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: one folder per course.  The rebalance gathers small courses and splits a large one,
    so a hot course is written by several tasks."""
    _csv(df.hint("rebalance", F.col("content_id")), mode).partitionBy("content_id").csv(path)


def write_split(split: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: short and full comments per course, blank ones left out."""
    out = split.filter(F.col("bucket") != "skipped").select(
        "bucket", "content_id", "content_name", "comment", "comment_date", "ordinal")
    _csv(out.hint("rebalance", F.col("bucket"), F.col("content_id")), mode).partitionBy("bucket", "content_id").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def analysis_records(analysis: DataFrame) -> DataFrame:
    """The analysis table in the upstream on-disk shape (key names with spaces)."""
    ga = F.struct(
        F.when(F.col("sentiment") == "negative", F.col("category")).alias("Issue Category"),
        F.when(F.col("sentiment") == "positive", F.col("category")).alias("Strength Category"),
        F.col("root_cause").alias("Root Cause"), F.col("actions").alias("Recommended Actions"),
        F.col("owner").alias("Owner"), F.col("priority").alias("Priority"),
        F.col("error").alias("Error"), F.col("raw_output").alias("Raw Output"))
    return analysis.select("sentiment", "content_id", "content_name", "comment", "comment_date", "ordinal",
                           F.col("sentiment").alias(ANALYSIS_SENTIMENT_FIELD), ga.alias(ANALYSIS_RECORD_FIELD))


def write_analysis_json(analysis: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: JSON lines per sentiment and course; non-ASCII text kept as is."""
    (analysis_records(analysis).hint("rebalance", F.col("sentiment"), F.col("content_id")).write.mode(mode)
     .partitionBy("sentiment", "content_id").json(path))


def write_analysis_arrays(analysis: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3 in the upstream layout: one indented JSON array for each sentiment and course, in input order.  Such a file
    is one task's output, whatever its size; ``write_analysis_json`` has no such bound."""
    key = ["sentiment", "content_id"]
    w = Window.partitionBy(*key).orderBy("ordinal")
    rows = analysis_records(analysis).select(*key, F.to_json(F.struct(*[c for c in analysis_records(analysis).columns if c not in key[:1]]), {"pretty": "true"}).alias("record"), "ordinal")
    first, last = F.lag("ordinal").over(w).isNull(), F.lead("ordinal").over(w).isNull()
    text = F.concat(F.when(first, "[\n").otherwise(""), "record", F.when(last, "\n]").otherwise(","))
    rows = rows.select(*key, "ordinal", text.alias("value")).sortWithinPartitions(*key, "ordinal")
    rows.select(*key, "value").write.mode(mode).partitionBy(*key).text(path)


def write_summary_json(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: one summary document per course, in a folder of the course."""
    documents.repartition("content_id").write.mode(mode).partitionBy("content_id").json(path)


def write_bucket_rows(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5 / A10: the comments of all buckets in order of (bucket, sentiment, rank).  The rows are dealt out by
    ranges of that order, so a bucket with most of them is written by several tasks, and a read of some ranks skips the other files."""
    by = ["content_id", "lang_name", "sentiment", "rank"]
    # stored: a range sort looks at its input twice, for the ranges and for the rows
    rows = materialize(rows, "bucket-rows")
    rows.repartitionByRange(*by).sortWithinPartitions(*by).write.mode(mode).parquet(path)


def append_usage(analysis: DataFrame, path: str, run_id: str) -> None:
    """K6: this run's token usage (per course x prompt kind) as the folder of its run in a usage table.

    The folder is replaced as a whole when the job commits, so a run that is repeated, or failed midway
    and starts again, counts once; runs of other ids, also those that write at the same time, stay.
    """
    usage = token_usage(analysis).withColumn("run_id", F.lit(run_id))
    # a few rows for each course: the rollup's tasks need not each leave a file
    (usage.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def count_report_lines(counts: DataFrame, label: str) -> DataFrame:
    """K7: the per-file count report as text lines ('<course>.csv: n', a rule, 'Total: n').

    ``counts``: content_id, n.  The report is small (one line per course).
    """
    body = counts.select(F.concat(F.col("content_id"), F.lit(".csv: "), F.col("n").cast("string")).alias("line"),
                         F.lit(1).alias("part"), F.col("content_id").alias("k"))
    total = counts.agg(F.sum("n").alias("n")).select(
        F.concat(F.lit("Total: "), F.coalesce(F.col("n"), F.lit(0)).cast("string")).alias("line"),
        F.lit(3).alias("part"), F.lit("").alias("k"))
    head = counts.sparkSession.createDataFrame(
        [(f"{label} count summary:", 0, ""), ("-" * 40, 0, "~"), ("-" * 40, 2, "")], "line string, part int, k string")
    return head.unionByName(body).unionByName(total)


def _lines(rows: DataFrame, part: int, key, line) -> DataFrame:
    return rows.select(line.alias("line"), F.lit(part).alias("part"), key.alias("k"))


def _fixed_lines(like: DataFrame, lines: list[tuple[str, int]]) -> DataFrame:
    return like.sparkSession.createDataFrame([(t, p, "") for t, p in lines], "line string, part int, k string")


def detection_report_lines(summary: DataFrame, counts: DataFrame, failed_codes: tuple[str, ...] = ("ERROR",)) -> DataFrame:
    """K7: the detection report.  ``summary`` is the one-row A13 table, ``counts`` the rows per code;
    codes are listed by count (the key sorts them), failed ones left out."""
    text = F.format_string
    n = F.col("total_samples")
    out = _fixed_lines(summary, [("--- DETECTION ---", 0), ("Language Breakdown:", 4), ("Overall Benchmark Results:", 6)])
    for part, line in (
        (1, F.concat(F.lit("Total Comments Processed: "), n.cast("string"))),
        (2, text("Blank/Failed Detections: %d (%s%%)", "failed", F.format_number("failed_pct", 2))),
        (3, text("Successful Detections: %d (%s%%)", "successful", F.format_number("success_pct", 2))),
        (7, F.concat(F.lit("  • Total Files Processed: "), F.col("files").cast("string"))),
        (8, F.concat(F.lit("  • Total Samples Processed: "), n.cast("string"))),
        (9, F.concat(F.lit("  • Overall Average Latency: "), text("%.4f", "mean_latency"), F.lit(" sec/sample"))),
        (10, F.concat(F.lit("  • Overall Throughput: "), text("%.2f", "throughput"), F.lit(" samples/sec"))),
    ):
        out = out.unionByName(_lines(summary, part, F.lit(""), line))
    share = F.format_number(F.col("n") * 100.0 / F.col("total_samples"), 2)
    codes = counts.filter(~F.col("predicted_language").isin(*failed_codes)).crossJoin(F.broadcast(summary.select("total_samples")))
    key = F.concat(F.lpad((F.lit(10 ** 15) - F.col("n")).cast("string"), 16, "0"), F.col("predicted_language"))
    return out.unionByName(_lines(codes, 5, key, text("  %s: %d (%s%%)", "predicted_language", "n", share)))


def usage_report_lines(usage: DataFrame) -> DataFrame:
    """K7: the token usage report from the A14 rollup: a block per course and prompt kind, the grand total."""
    kinds = ("input", "output", "thinking", "total")
    name = F.when(F.col("content_id").isNull(), "  GRAND TOTAL").otherwise(F.concat_ws(" ", F.lit(" "), "content_id", "prompt_kind"))
    body = [name, *[F.concat(F.rpad(F.lit(f"    {k}:"), 14, " "), F.format_number(f"{k}_tokens", 0)) for k in kinds]]
    rows = usage.filter("prompt_kind is not null or content_id is null").select(
        F.when(F.col("content_id").isNull(), 2).otherwise(1).alias("part"), F.concat_ws("/", "content_id", "prompt_kind").alias("c"),
        F.posexplode(F.array(*body)).alias("i", "line"))
    rows = rows.select("line", "part", F.concat(F.col("c"), F.lit("#"), F.col("i").cast("string")).alias("k"))
    return _fixed_lines(usage, [("Token Usage Summary", 0), ("=" * 52, 3)]).unionByName(rows)


def evaluation_report_lines(accuracy: DataFrame, matrix: DataFrame) -> DataFrame:
    """K7: overall accuracy and the confusion matrix, a line per true label."""
    cells = matrix.groupBy("true_label").agg(F.array_sort(F.collect_list(F.struct("predicted_label", "count"))).alias("c"))
    row = F.concat(F.lit("["), F.array_join(F.transform("c", lambda x: x["count"].cast("string")), " "), F.lit("]"))
    labels = matrix.agg(F.array_join(F.array_sort(F.collect_set("true_label")), ", ").alias("l"))
    return (_fixed_lines(accuracy, [("Sentiment Analysis Classification Report", 0), ("Confusion Matrix:", 2)])
            .unionByName(_lines(accuracy, 1, F.lit(""), F.format_string("Overall Accuracy: %.4f", "accuracy")))
            .unionByName(_lines(labels, 3, F.lit(""), F.concat(F.lit("Labels: "), F.col("l"))))
            .unionByName(_lines(cells, 4, F.col("true_label"), row)))
