"""Incremental categorisation as a Structured Streaming job.

New comment files land in a folder (parquet, the tagged schema).  Each micro-batch:
    pending = batch LEFT ANTI analysis-table on (content_id, ordinal) with a success
    -> categorise (built-in rules, or the per-partition hook)
    -> append to the analysis table (parquet, partitioned by sentiment / course).
This is the resume logic (J5) run continuously, one record per comment row.  The table is
created empty before the stream starts, so each batch simply reads it; a replayed
micro-batch finds its own rows there and appends nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import category
from ..schemas import TAGGED_FILE_SCHEMA
from ..session import scratch_path

TABLE_COLUMNS = ["content_id", "content_name", "comment", "comment_date", "ordinal", "sentiment", "category_no",
                 "category", "root_cause", "owner", "priority", "actions", "error", "batch_id"]


def _analysed(batch: DataFrame, batch_id: int) -> DataFrame:
    return category.categorize(batch).withColumn("batch_id", F.lit(batch_id).cast("long")).select(*TABLE_COLUMNS)


def _append(rows: DataFrame, table_path: str) -> None:
    rows.write.mode("append").partitionBy("sentiment", "content_id").parquet(table_path)


def process_batch(batch: DataFrame, batch_id: int, table_path: str, schema) -> None:
    todo = batch.filter(F.col("predicted_sentiment").isin("negative", "positive"))
    done = batch.sparkSession.read.schema(schema).parquet(table_path)
    ok = done.filter(F.col("error").isNull() & F.col("category").isNotNull()).select("content_id", "ordinal")
    _append(_analysed(todo.join(ok.distinct(), ["content_id", "ordinal"], "left_anti"), batch_id), table_path)


def start(spark: SparkSession, source_dir: str, table_path: str, name: str = "categorise",
          max_files_per_trigger: int = 100, once: bool = False) -> StreamingQuery:
    empty = _analysed(spark.createDataFrame([], TAGGED_FILE_SCHEMA), 0)
    empty.write.mode("append").parquet(table_path)
    schema = empty.schema
    stream = (spark.readStream.schema(TAGGED_FILE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    w = (stream.writeStream.foreachBatch(lambda df, bid: process_batch(df, bid, table_path, schema))
         .option("checkpointLocation", scratch_path(spark, f"stream-{name}")).queryName(name))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")
    return w.start()
