"""Operator semantics on small hand-made frames, plus invariants."""
import pytest
from pyspark.sql import functions as F

from feedlens.operators import category, clean, dashboard, enrich, evaluate, language, sentiment
from feedlens.schemas import NEGATIVE_SUMMARY_SCHEMA
from feedlens.sinks import files as sinks
from feedlens.sources import files as src

RAW = [
    ("c1", "Course One", "very good course indeed", "2024-01-02T03:04:05", 1),
    (" c1 ", "Course One", "good one sir", "2024-01-03 10:00:00", 2),
    ("c1", "Course One", "   ", "2024-01-04", 3),
    ("", "x", "lost row here now", "2024-01-04", 4),
    ("c2", "Course Two", "a b c d", "Tue 2 Jan", 5),
    ("c2", "Course Two", 'line one\nline two, "ok"', "", 6),
]
RAW_DDL = "content_id string, content_name string, comment string, comment_date string, ordinal long"


def test_split_rules_and_counts(spark):
    raw = spark.createDataFrame(RAW, RAW_DDL)
    s = {r["ordinal"]: r for r in clean.split_comments(raw).collect()}
    assert 4 not in s                                   # blank course dropped
    assert s[1]["bucket"] == "full" and s[2]["bucket"] == "short"   # exactly 3 words is short
    assert s[2]["content_id"] == "c1"
    assert s[3]["bucket"] == "skipped"
    assert s[5]["word_count"] == 4 and s[5]["comment_date"] == ""
    counts = {r["content_id"]: r for r in clean.course_length_counts(clean.split_comments(raw)).collect()}
    tot = counts[None]
    assert (tot["short_count"], tot["full_count"], tot["skipped_count"]) == (1, 3, 1)
    assert tot["short_count"] + tot["full_count"] + tot["skipped_count"] == 5


def test_sentiment_lexicon_and_placeholder(spark):
    df = spark.createDataFrame([("This was the best, great!",), ("stupid and useless",), ("",), (None,),
                                ("bestseller",)], "comment string")
    got = [r[0] for r in sentiment.score_sentiment(df).select("predicted_sentiment").collect()]
    assert got == ["positive", "negative", "neutral", "neutral", "neutral"]   # whole tokens only


def test_language_detection_and_defaults(spark):
    df = spark.createDataFrame([("the cat and the dog of the house",), ("der Hund und die Katze",), ("   ",),
                                ("zzz qqq",)], "comment string")
    rows = language.detect_language(df).collect()
    assert rows[0]["predicted_language"] == "en" and rows[0]["top_predicted_labels"].startswith("en:1.0000")
    assert rows[1]["predicted_language"] == "de"
    assert (rows[2]["predicted_language"], rows[2]["top_predicted_labels"], rows[2]["confidence_score"]) == \
        ("en", "UNKNOWN", 0.0)
    assert rows[3]["predicted_language"] == "en" and rows[3]["top_predicted_labels"] == "UNKNOWN"
    le = language.detect_language(df, prof=language.LENIENT_DETECTION).collect()
    assert le[2]["predicted_language"] == "UNKNOWN" and le[0]["top_predicted_labels"] == "en:1.0000"


def test_last_wins_and_joins(spark):
    tagged = spark.createDataFrame([
        ("c1", "n", "Great video quality", "2024-01-01", 1, "negative"),
        ("c1", "n", "great  VIDEO quality", "2024-01-05", 2, "negative"),
        ("c1", "n", "nice", "2024-01-02", 3, "neutral"),
    ], "content_id string, content_name string, comment string, comment_date string, ordinal long, "
       "predicted_sentiment string")
    analysis = spark.createDataFrame([
        ("c1", "great video quality", 1, "negative", "Video & Audio Quality", None),
        ("c1", "great video quality", 2, "negative", "Engagement", None),
        ("c1", "great video quality", 9, "negative", None, "boom"),        # failed: never overwrites
    ], "content_id string, comment string, ordinal long, sentiment string, category string, error string") \
        .withColumn("root_cause", F.lit("r")).withColumn("owner", F.lit("o")).withColumn("priority", F.lit("High")) \
        .withColumn("actions", F.array(F.lit("a")))
    enr = dashboard.enrich(tagged, analysis)
    issues = {r["ordinal"]: r["issue"] for r in enr.collect()}
    assert issues == {1: "Engagement", 2: "Engagement", 3: "Other Issue"}
    lang = spark.createDataFrame([("c1", "great video quality", "2024-01-01", 7, "EN "),
                                  ("c1", "unmatched text", "2024-01-09", 8, "hi")],
                                 "content_id string, comment string, comment_date string, ordinal long, "
                                 "predicted_language string")
    strict = dashboard.language_facts(lang, enr).collect()
    assert len(strict) == 1 and strict[0]["lang_name"] == "English" and strict[0]["date"] == "2024-01-05"
    lenient = {r["ordinal"]: r for r in dashboard.language_facts(lang, enr, dashboard.LENIENT).collect()}
    assert len(lenient) == 2 and lenient[8]["sentiment"] == "neutral" and lenient[8]["date"] == "2024-01-09"


def test_hidden_course_rule(spark):
    enr = spark.createDataFrame([("a", "A", 1, "neutral"), ("b", "B", 2, "negative"), ("c", "", 3, "neutral"),
                                 ("c", "C", 4, "neutral")],
                                "content_id string, content_name string, ordinal long, sentiment string")
    cs = {r["content_id"]: r for r in dashboard.course_stats(enr).collect()}
    assert cs["a"]["hidden"] and not cs["b"]["hidden"] and not cs["c"]["hidden"]
    assert cs["c"]["name"] == "C"            # first non-empty name
    assert cs["b"]["alert_label"] == "High" and cs["b"]["negative_width"] == 120


def test_tier_and_urgency_rules(spark):
    rows = [("c", "negative", f"cat{i}", n, i) for i, n in enumerate([40, 8, 6, 4, 3, 1, 1, 1, 1, 1], start=1)]
    analysis = spark.createDataFrame(
        [(c, s, cat, f"comment about certificate {k}" if cat == "cat1" else f"comment words here {k}", o * 1000 + k)
         for c, s, cat, n, o in rows for k in range(n)],
        "content_id string, sentiment string, category string, comment string, ordinal long") \
        .withColumn("root_cause", F.lit("r")).withColumn("owner", F.lit("o")) \
        .withColumn("priority", F.lit("High")).withColumn("actions", F.array(F.lit("x"), F.lit("y")))
    t = {r["category"]: r for r in category.tiers(category.category_groups(analysis)).collect()}
    assert t["cat1"]["tier"] == "major" and t["cat1"]["urgency"] == "Critical"      # top + blocking
    assert t["cat2"]["tier"] == "major" and t["cat2"]["urgency"] == "High"          # 8/66 >= 10 %
    assert t["cat3"]["tier"] == "minor" and t["cat3"]["urgency"] == "Medium"        # 6/66 in [5 %, 10 %)
    assert t["cat4"]["tier"] == "excluded" and t["cat4"]["urgency"] == "Medium"     # < 5 comments, capped
    assert t["cat6"]["tier"] == "excluded" and t["cat6"]["urgency"] == "Low"
    acts = category.top_priority_actions(category.tiers(category.category_groups(analysis))).collect()
    assert [a["action"] for a in acts] == ["x", "y"]      # de-duplicated across categories


def test_evaluation_invariants(spark):
    ev = evaluate.truth_label(spark.createDataFrame(
        [("c1", "positive", "positive"), ("c1", "Negative", "negative"), ("c2", None, "neutral"),
         ("c2", "neutral", "positive"), ("c2", "positive", "negative")],
        "content_id string, actual_sentiment string, predicted_sentiment string"))
    cm = evaluate.confusion_matrix(ev).collect()
    assert sum(r["count"] for r in cm) == 5 and len(cm) == 9
    rep = {(r["content_id"], r["label"]): r for r in evaluate.classification_report(ev).collect()}
    acc = evaluate.accuracy(ev).first()["accuracy"]
    assert rep[(None, "weighted avg")]["recall"] == pytest.approx(acc) == pytest.approx(3 / 5)
    assert rep[("c1", "positive")]["precision"] == 1.0


def test_retry_policy():
    calls, waits = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise enrich.RateLimited("429")
        return {"v": x}
    res, err, n, _ = enrich.call_with_retry(flaky, "t", sleep=waits.append)
    assert res == {"v": "t"} and err is None and n == 3 and waits == [2.0, 4.0]

    def broken(x):
        raise ValueError("bad")
    waits.clear()
    res, err, n, _ = enrich.call_with_retry(broken, "t", sleep=waits.append)
    assert res is None and err.startswith("ERROR") and n == 5 and waits == [1.0] * 4


def test_enrich_partitions_errors_are_data(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "id long, comment string")

    def fn(text):
        if text == "text 7":
            raise RuntimeError("nope")
        return {"label": text.upper()}
    out = enrich.enrich_partitions(df, fn, "comment", T.StructType([T.StructField("label", T.StringType())]),
                                   partitions=3, max_tries=2, other_delay=0.0).collect()
    assert len(out) == 20
    bad = [r for r in out if r["error"]]
    assert [r["id"] for r in bad] == [7] and bad[0]["attempts"] == 2


def test_parse_analysis_invalid(spark):
    df = spark.createDataFrame([('{"Issue Category": "Engagement", "Priority": "High"}',), ("not json",)],
                               "raw string")
    rows = df.select(enrich.parse_analysis(F.col("raw")).alias("a")).collect()
    assert rows[0]["a"]["Issue Category"] == "Engagement" and rows[0]["a"]["Error"] is None
    assert rows[1]["a"]["Error"] == "Failed to parse JSON" and rows[1]["a"]["Raw Output"] == "not json"


def test_csv_round_trip_keeps_quoted_newlines(spark, tmp_path):
    raw = spark.createDataFrame(RAW, RAW_DDL).drop("ordinal")
    sinks.write_csv(raw, str(tmp_path / "raw"))
    back = src.scan_comments(spark, str(tmp_path / "raw"))
    assert back.count() == len(RAW)
    assert back.filter(F.col("comment").contains("\n")).count() == 1


def test_category_summary_files(spark, tmp_path):
    import json
    (tmp_path / "c1_category_summary.json").write_text(json.dumps({"total_negative_comments": 7}))
    (tmp_path / "c2_category_summary.json").write_text("{broken")
    (tmp_path / "c3.json").write_text(json.dumps([{"comment": "x"}]))
    df = src.scan_category_summaries(spark, str(tmp_path), NEGATIVE_SUMMARY_SCHEMA)
    rows = {r["summary_course"]: r for r in df.collect()}
    assert set(rows) == {"c1", "c2"}
    assert rows["c1"]["total_negative_comments"] == 7 and rows["c2"]["_corrupt_record"] is not None


def test_resume_operators(spark):
    comments = spark.createDataFrame([("c", "a", 1), ("c", "b", 2), ("c", "b", 3), ("c", " ", 4)],
                                     "content_id string, comment string, ordinal long")
    earlier = spark.createDataFrame([("c", "a", 1, "X", None), ("c", "b", 2, None, "ERROR: boom")],
                                    "content_id string, comment string, ordinal long, category string, error string")
    assert comments.transform(lambda d: enrich.join_resume(d, earlier)).count() == 4      # no fan-out
    assert sorted(r["ordinal"] for r in enrich.pending_anti(comments, earlier).collect()) == [2, 3]
    assert enrich.pending_anti(comments, earlier, parity=True).count() == 0
    lang = spark.createDataFrame([("c", 1, "en"), ("c", 2, None), ("c", 3, "en"), ("c", 4, None)],
                                 "content_id string, ordinal long, predicted_language string")
    assert sorted(r["ordinal"] for r in enrich.pending_language(lang).collect()) == [2, 4]
    assert sorted(r["ordinal"] for r in enrich.pending_language(lang, parity=True).collect()) == [2, 3, 4]


def test_permutation_invariance(spark):
    """Shuffled input partitions give the same last-wins map (ordinal tie-breaks)."""
    rows = [("c", f"text {i % 7}", i, "negative" if i % 3 else "neutral", f"2024-01-{1 + i % 20:02d}")
            for i in range(200)]
    ddl = "content_id string, norm string, ordinal long, sentiment string, comment_date string"
    base = spark.createDataFrame(rows, ddl).withColumn("issue", F.lit("i")).withColumn("strength", F.lit(""))
    a = sorted(map(tuple, dashboard.comment_map(base).collect()))
    b = sorted(map(tuple, dashboard.comment_map(base.repartition(7).sortWithinPartitions(F.rand(3))).collect()))
    assert a == b


def test_enrich_threads_keep_order(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "id long, comment string")
    out = enrich.enrich_partitions(df, lambda x: {"u": x.upper()}, "comment",
                                   T.StructType([T.StructField("u", T.StringType())]), partitions=2,
                                   threads=4).collect()
    assert all(r["u"] == r["comment"].upper() for r in out) and len(out) == 50


def test_model_udf_loads_once_per_task(spark):
    def load():
        return {"great": "positive", "bad": "negative"}

    def predict(model, s):
        return s.map(lambda t: next((v for k, v in model.items() if k in t.lower()), "Neutral"))
    df = spark.createDataFrame([("Great course",), ("bad audio",), ("ok",)], "comment string")
    got = [r[0] for r in df.select(sentiment.label_map(enrich.model_udf(load, predict)("comment"))).collect()]
    assert got == ["positive", "negative", "neutral"]
