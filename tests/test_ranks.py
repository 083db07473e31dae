"""Ranks without a window by group, joins by a missing number, bucket rows, comment keys."""
import json

import pytest
from pyspark.sql import functions as F

from feedlens.operators import dashboard, enrich
from feedlens.operators.ranks import ranked, spread_left_join
from feedlens.sinks import files as sinks
from feedlens.sources import files as src


@pytest.fixture
def many_tasks(spark):
    """No coalescing of small shuffle partitions, so the tests see how rows are dealt out."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(keep, ("false", "16", "-1")):
        spark.conf.set(k, v)
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_ranks_are_gapless_in_hot_small_and_null_groups(many_tasks):
    rows = [("hot" if i % 10 else (None if i % 20 else f"k{i % 7}"), "a" if i % 3 else None, i * 37 % 5000) for i in range(5000)]
    df = many_tasks.createDataFrame(rows, "k string, s string, o long").repartition(5)
    got = ranked(df, ["k", "s"], [F.desc("o")])
    by = {}
    for r in got.collect():
        by.setdefault((r.k, r.s), []).append((r["rank"], r.o))
    want = {}
    for k, s, o in rows:
        want.setdefault((k, s), []).append(o)
    assert set(by) == set(want) and len(by) > 5
    for key, found in by.items():
        assert sorted(found) == list(enumerate(sorted(want[key], reverse=True), start=1))
    assert ranked(df.limit(0), ["k"], [F.asc("o")]).count() == 0


def test_rows_without_a_number_are_dealt_out(many_tasks):
    left = many_tasks.range(20000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("n"))          # 90 % match nothing
    right = many_tasks.range(0, 20000, 20).select(F.col("id").alias("n"), F.concat(F.lit("v"), "id").alias("v"))
    out = spread_left_join(left, right, "n", "id").withColumn("task", F.spark_partition_id())
    sizes = sorted(r["count"] for r in out.groupBy("task").count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    rows = out.collect()
    assert len(rows) == 20000 and out.columns[:3] == ["n", "id", "v"]
    assert all(r.v == (f"v{r.id}" if r.id % 20 == 0 else None) and r.n == (r.id if r.id % 10 == 0 else None) for r in rows)


def _facts(spark, n=3000):
    """90 % of the comments in one bucket; every tenth text twice, every third without a record."""
    record = F.when(F.col("id") % 3 != 0, F.struct(F.lit("Engagement").alias("category"), F.lit("r\"c").alias("root_cause"), F.lit("Team").alias("owner"),
                                                   F.lit("High").alias("priority"), F.array(F.lit("a1"), F.lit("a2")).alias("actions")))
    hot = F.col("id") % 10 != 0
    return spark.range(n).select(
        F.when(hot, "c1").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("content_id"), F.lit("English").alias("lang_name"),
        F.lit("negative").alias("sentiment"), F.col("id").alias("ordinal"), F.concat(F.lit(" text \"é\" "), F.floor(F.col("id") / 2 if n < 0 else F.col("id") * 9 / 10).cast("string"), F.lit("\n")).alias("comment"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")).alias("date"), F.lit("Engagement").alias("issue"), F.lit("").alias("strength"), record.alias("record"))


def test_bucket_rows_of_a_hot_bucket_are_written_by_many_tasks_in_order(many_tasks, tmp_path):
    facts = _facts(many_tasks)
    path = str(tmp_path / "rows")
    sinks.write_bucket_rows(dashboard.bucket_rows(facts), path)
    back = src.scan_bucket_rows(many_tasks, path).withColumn("file", F.input_file_name())
    hot = back.filter("content_id = 'c1'")
    assert hot.select("file").distinct().count() > 5
    ranges = sorted((r.low, r.high) for r in hot.groupBy("file").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))                    # each file holds a range of ranks
    best = {}
    for r in sorted(facts.collect(), key=lambda r: r.ordinal):
        k = (r.content_id, r.comment.strip())
        if k not in best or r.date > best[k].date:
            best[k] = r
    want = {}
    for r in best.values():
        want.setdefault(r.content_id, []).append(r)
    for content_id, rows in want.items():
        rows.sort(key=lambda r: r.ordinal)
        rows.sort(key=lambda r: r.date, reverse=True)
        got = [json.loads(r.payload) for r in back.filter(F.col("content_id") == content_id).orderBy("rank").collect()]
        assert [(g["comment"], g["date"]) for g in got] == [(r.comment.strip(), r.date) for r in rows]
        assert [g["analysis"] for g in got] == [{} if r.record is None else {"Issue Category": "Engagement", "Root Cause": "r\"c", "Recommended Actions": ["a1", "a2"],
                                                                            "Owner": "Team", "Priority": "High"} for r in rows]


def test_comments_meet_by_digest_and_no_text_is_shuffled_to_match(spark):
    texts = ["Good  course", "good course", "“quoted”", '"quoted"', "back\\slash", "backslash", "", None, "other"]
    ddl = "content_id string, comment string, ordinal long, category string, error string"
    rows = [("c", t, i) for i, t in enumerate(texts)]
    comments = spark.createDataFrame(rows, "content_id string, comment string, ordinal long")
    earlier = spark.createDataFrame([("c", "GOOD course ", 1, "X", None), ("c", '"quoted" ', 2, "X", None), ("d", "other", 3, "X", None)], ddl)
    tagged = comments.withColumn("content_name", F.lit("n")).withColumn("comment_date", F.lit("")).withColumn("predicted_sentiment", F.lit("negative"))
    found = dashboard.enrich(tagged, earlier.withColumn("sentiment", F.lit("negative")).withColumn("root_cause", F.lit("r")).withColumn("owner", F.lit("o"))
                             .withColumn("priority", F.lit("p")).withColumn("actions", F.array(F.lit("a"))))
    assert {r.ordinal for r in found.collect() if r.issue == "X"} == {0, 1, 2, 3}
    lookup = dashboard.analysis_lookup(earlier.withColumn("sentiment", F.lit("negative")))
    p = lookup._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert exchange and all("comment" not in line and "norm#" not in line for line in exchange)
