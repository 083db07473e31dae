"""Inputs of few row groups are dealt over more tasks; text helpers that look at a character once."""
import random

import pytest
from pyspark.sql import functions as F

from feedlens.functions import text as tx
from feedlens.plans import catalog
from feedlens.sources import tables


def _rows_of_tasks(df):
    return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


@pytest.fixture
def one_group(spark, tmp_path):
    docs = spark.range(9000).selectExpr("if(id % 7 = 0, null, id) AS doc_id", "if(id % 5 = 0, null, concat('some text of a few words ', id % 50)) AS text", "'en' AS lang")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_one_large_row_group_is_read_by_many_tasks(spark, one_group):
    raw = tables.raw_comments(spark, one_group)
    most = max(_rows_of_tasks(raw))
    assert most <= 9000 // 2
    plain = spark.read.parquet(f"{one_group}/documents.parquet").select("doc_id", "text")
    got = raw.select("ordinal", "comment")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_small_and_evenly_dealt_inputs_stay(spark, one_group):
    docs = spark.read.parquet(f"{one_group}/documents.parquet")
    assert tables.spread(docs.limit(100)).columns == docs.columns and tables._parts_needed(docs.limit(100)) is None
    assert tables._parts_needed(docs.repartition(64)) is None and tables._parts_needed(docs.filter("false")) is None
    assert tables._parts_needed(docs) >= spark.sparkContext.defaultParallelism


def test_whitespace_and_quotes_of_any_text(spark):
    rng = random.Random(3)
    pool = [*map(chr, [*range(9, 14), 32, 32, 32, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, 0x2003, 0x200B, 0x2028, 0x3000, 0xFEFF])] + list("ab‘’“”\\'\"é\U0001F600")
    texts = ["".join(rng.choices(pool, k=rng.randrange(12))) for _ in range(2000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.collapse_ws("t").alias("c"), tx.norm_comment("t", False).alias("n")).collect()
    quotes = str.maketrans("‘’“”", "''\"\"", "\\")
    assert all(r.c == " ".join(r.t.split()) and r.n == " ".join(r.t.translate(quotes).lower().split()) for r in rows)
    plan = spark.createDataFrame([("a",)], "t string").select(tx.norm_comment("t", False))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan


def test_words_in_any_case(spark):
    assert tx.any_case("login|access") == "(?=[ALal])(?iu:login|access)" and tx.any_case("a+b") == "(?iu)a+b"
    texts = ["xLOGIN", "acceſs", "ACCEſS", "logı n", "Acces", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    same = rows.filter(F.col("t").rlike("(?iu)login|access") == F.col("t").rlike(tx.any_case("login|access"))).count()
    assert same == len(texts)


def test_the_usage_of_three_runs_is_worked_out_once(spark, one_group, monkeypatch):
    calls, rows = [], catalog._usage_rows
    monkeypatch.setattr(catalog, "_usage_rows", lambda *a: calls.append(1) or rows(*a))
    got = catalog.q_append_usage(spark, one_group)
    assert len(calls) == 1 and {r.run_id for r in got.select("run_id").distinct().collect()} == {"run-1", "run-2"}
