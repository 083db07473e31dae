"""The incremental categorisation stream: two drops, the second repeating old rows."""
from pyspark.sql import functions as F

from feedlens.plans import flows
from feedlens.streaming import incremental
from conftest import SF_SMALL


def test_stream_appends_only_pending(spark, tmp_path):
    src_dir, table = str(tmp_path / "incoming"), str(tmp_path / "analysis")
    full = flows.full(spark, SF_SMALL).select("content_id", "content_name", "comment", "comment_date", "ordinal",
                                              "predicted_sentiment", F.lit(None).cast("string").alias("actual_sentiment"))
    first = full.filter(F.col("comment_date") < "2024-06-01")
    first.write.mode("append").parquet(src_dir)
    incremental.start(spark, src_dir, table, name="t1", once=True).awaitTermination()
    n1 = spark.read.parquet(table).count()
    full.write.mode("append").parquet(src_dir)          # everything again: old rows must not repeat
    incremental.start(spark, src_dir, table, name="t1", once=True).awaitTermination()
    out = spark.read.parquet(table)
    expected = full.filter(F.col("predicted_sentiment").isin("negative", "positive")).count()
    assert out.count() == expected and n1 <= expected
    assert out.groupBy("content_id", "comment").count().filter("count > 1").count() == \
        full.filter(F.col("predicted_sentiment").isin("negative", "positive")) \
            .groupBy("content_id", "comment").count().filter("count > 1").count()
