"""Plan-shape checks: the properties the scale design relies on."""
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from feedlens.operators import enrich
from feedlens.plans import flows
from conftest import SF_SMALL


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_is_limited_below_the_shuffle(spark):
    p = plan(E.queries()["word_frequency"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "partial_count" in p                                 # map-side combine before the word shuffle


def scans(p: str) -> list[str]:
    """The read schemas of the Parquet scans in a final plan."""
    return re.findall(r"FileScan parquet.*?ReadSchema: (\S+)", p)


def test_scan_reads_only_needed_columns(spark):
    found = scans(plan(E.queries()["score_sentiment"](spark, SF_SMALL)))
    assert found and all("text" in f and "n_chars" not in f and "source" not in f for f in found)


@pytest.mark.parametrize("key", ["join_analysis", "join_language_inner", "join_language_left", "last_wins", "course_stats", "flat_buckets"])
def test_no_aggregate_sorts_the_texts(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert "HashAggregate" in p and "SortAggregate" not in p


@pytest.mark.parametrize("key", ["confusion_matrix", "label_union", "classification_report"])
def test_evaluation_reads_each_table_once(spark, key):
    found = scans(plan(E.queries()[key](spark, SF_SMALL)).split("== Initial Plan ==")[0])
    assert len(found) == 2                                      # documents and labels


def test_comment_joins_broadcast_nothing_by_hint(spark):
    df = E.queries()["join_analysis"](spark, SF_SMALL)
    assert "broadcast" not in df._jdf.queryExecution().logical().toString().lower()


def test_rerun_of_pending_step_yields_nothing(spark):
    """After the pending rows are analysed and appended, nothing is pending any more."""
    t = flows.full(spark, SF_SMALL).filter(F.col("predicted_sentiment").isin("negative", "positive"))
    earlier = flows.earlier_analysis(spark, SF_SMALL)
    pending = enrich.pending_anti(t, earlier)
    from feedlens.operators import category
    now = earlier.unionByName(category.categorize(pending), allowMissingColumns=True)
    assert pending.count() > 0 and enrich.pending_anti(t, now).count() == 0
