"""Rules that the driver's data never shows: hand-made rows for each."""
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions import text as tx
from feedlens.operators import category, documents, enrich, language
from feedlens.sinks import files as sinks
from feedlens.sources import files as src


def _analysis(spark):
    rows, n = [], 0

    def add(course, sentiment, cat, k, comment, prio="High", actions=("do a", "do b", "do c")):
        nonlocal n
        for _ in range(k):
            n += 1
            rows.append((course, sentiment, cat, comment, n, "rc", "team", prio, list(actions)))
    add("c1", "negative", "Login", 40, "cannot login to finish the exam")
    add("c1", "negative", "Video", 30, "the video of this module is dark", "Medium", ("do a", "do v"))
    add("c1", "negative", "Noise", 14, "bad", "Low", ("do n",))
    add("c1", "negative", "Pace", 8, "this course is rather long for me", "Critical", ("do p",))
    add("c1", "negative", "Rare", 3, "some rare thing happened here", "Low", ("do r",))
    add("c1", "positive", "Thanks", 20, "thanks")
    add("c1", "positive", "Teacher", 12, "the teacher explains very well")
    add("c1", "positive", "Few", 2, "a few liked the menu")
    add("c2", "negative", "Only", 3, "one action here and nothing else", "Low", ("x1", "x2", "x3", "x4"))
    schema = ("content_id string, sentiment string, category string, comment string, ordinal long, root_cause string, owner string, "
              "priority string, actions array<string>")
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def docs(spark):
    t = category.tiers(category.category_groups(_analysis(spark))).cache()
    a = category.top_priority_actions(t)
    return t, documents.negative_documents(t, a), documents.positive_documents(t)


def test_every_level_of_tier_urgency_and_noise(docs):
    rows = {(r.content_id, r.sentiment, r.category): (r.tier, r.urgency, r.noise) for r in docs[0].collect()}
    assert rows["c1", "negative", "Login"] == ("major", "Critical", False)
    assert rows["c1", "negative", "Video"] == ("major", "High", False)
    assert rows["c1", "negative", "Noise"] == ("major", "Low", True)
    assert rows["c1", "negative", "Pace"] == ("minor", "Medium", False)
    assert rows["c1", "negative", "Rare"] == ("excluded", "Low", False)
    assert rows["c1", "positive", "Thanks"] == ("primary", "Low", True)
    assert rows["c2", "negative", "Only"][0] == "excluded"


def test_documents_follow_the_rules(docs):
    neg = {r.content_id: r for r in docs[1].collect()}
    c1 = {i.category: i for i in neg["c1"].category_summaries}
    assert [i.category for i in neg["c1"].category_summaries] == ["Login", "Video", "Noise", "Pace", "Rare"]
    assert [x.action for x in c1["Video"].action_items] == ["do v"]          # "do a" belongs to Login
    assert c1["Noise"].action_items == [] and c1["Noise"].key_themes == [documents.LOW_SIGNAL_NEGATIVE]
    assert c1["Rare"].action_items == [] and neg["c1"].grouped_summary.minor_issues_summary == ["Pace: 8 comments"]
    assert [x.action for x in neg["c1"].top_priority_actions] == ["do p", "do a", "do b"]
    assert len(neg["c2"].top_priority_actions) == 3 and neg["c2"].grouped_summary.minor_issues_summary is None
    pos = docs[2].collect()[0]
    p = {i.category: i for i in pos.category_summaries}
    assert pos.top_strengths == ["Thanks", "Teacher"] and p["Thanks"].amplification_suggestion is None
    assert len(p["Thanks"].action_items) >= 2 and p["Few"].action_items == [] and p["Teacher"].amplification_suggestion == "do a"


def test_contract_is_empty_on_own_documents_and_names_each_planted_fault(docs):
    t, neg, pos = docs
    assert documents.contract(neg, pos, t).count() == 0

    def item(name, value, where="Login"):
        return F.transform("category_summaries", lambda i: F.when(i["category"] == where, i.withField(name, value(i))).otherwise(i))

    found = lambda n, p: {r.rule for r in documents.contract(n, p, t).collect()}
    change = lambda d, **kw: d.withColumns(kw)
    one = F.array(F.struct(F.lit("do b").alias("action"), F.lit("o").alias("owner"), F.lit("p").alias("priority"), F.lit(None).cast("string").alias("expected_impact")))
    cases = {
        "unknown category": (change(neg, category_summaries=item("category", lambda i: F.lit("Nope"))), pos),
        "not ordered by count": (change(neg, category_summaries=F.reverse("category_summaries")), pos),
        "count differs": (change(neg, category_summaries=item("count", lambda i: i["count"] + 1)), pos),
        "share differs": (change(neg, category_summaries=item("percent_of_negative", lambda i: F.lit(1.0))), pos),
        "tier differs": (change(neg, category_summaries=item("tier", lambda i: F.lit("minor"))), pos),
        "urgency differs": (change(neg, category_summaries=item("urgency", lambda i: F.lit("Low"))), pos),
        "actions on excluded category": (change(neg, category_summaries=item("action_items", lambda i: one, "Rare")), pos),
        "actions on noise category": (change(neg, category_summaries=item("action_items", lambda i: one, "Noise")), pos),
        "noise without its theme": (change(neg, category_summaries=item("key_themes", lambda i: F.lit(None).cast("array<string>"), "Noise")), pos),
        "action repeated": (change(neg, category_summaries=item("action_items", lambda i: one, "Pace")), pos),
        "top actions not exactly 3": (change(neg, top_priority_actions=F.slice("top_priority_actions", 1, 2)), pos),
        "total differs": (change(neg, total_negative_comments=F.lit(0).cast("long")), pos),
        "minor list not null exactly without minors": (change(neg, grouped_summary=F.col("grouped_summary").withField(
            "minor_issues_summary", F.lit(None).cast("array<string>"))), pos),
        "too few actions": (neg, change(pos, category_summaries=item("action_items", lambda i: one, "Teacher"))),
        "suggestion not due": (neg, change(pos, category_summaries=item("amplification_suggestion", lambda i: F.lit("s"), "Thanks"))),
        "top strengths not the first three": (neg, change(pos, top_strengths=F.array(F.lit("Thanks")))),
    }
    for rule, (n, p) in cases.items():
        assert rule in found(n, p), rule


def test_courses_without_documents_get_empty_ones(spark, docs):
    courses = spark.createDataFrame([("c1",), ("c2",), ("c9",)], "content_id string")
    got = {r.content_id: r for r in documents.attach(courses, docs[1], docs[2]).collect()}
    assert got["c9"].neg_category_summary == "{}" and got["c2"].pos_category_summary == "{}"
    assert json.loads(got["c1"].neg_category_summary)["total_negative_comments"] == 95


def test_text_rules_that_need_special_characters(spark):
    df = spark.createDataFrame([("ÉCOLE",), ("ecole",)], "c string")
    assert [r[0] for r in df.select(tx.regex_search("c", "école")).collect()] == [True, False]
    assert [r[0] for r in spark.range(1).select(language.score_text(F.lit(0.03125))).collect()] == ["0.0312"]
    out = spark.createDataFrame([("a { b }", "x")], "comment string, n string").select(
        enrich.prompt_text("{comment} {{ \"k\": 1 }} {n}", {"comment": F.col("comment"), "n": F.col("n")})).first()[0]
    assert out == 'a { b } { "k": 1 } x'


def test_detection_rows_of_blank_unknown_and_failed_calls(spark):
    cand = "array<struct<langCode:string,langScore:double>>"
    rows = [("hi there", [Row("unknown", 0.9), Row("en", 0.1)], None, 1, 0.5), ("x", [], None, 1, 0.5), (" ", [], None, 1, 0.5),
            ("y", None, "ERROR: no", 5, 0.0), ("z", None, "RATE_LIMIT_ERROR: 429", 5, 0.0)]
    df = spark.createDataFrame(rows, f"comment string, candidates {cand}, error string, attempts int, latency double")
    strict = [tuple(r)[1:] for r in language.detection_from_calls(df).collect()]
    assert strict == [("hinglish", 0.9, "unknown:0.9000; en:0.1000", 0.5), ("en", 0.0, "UNKNOWN", 0.5), ("en", 0.0, "UNKNOWN", 0.0),
                      ("ERROR", 0.0, "ERROR", 0.0), ("ERROR", 0.0, "RATE_LIMIT_ERROR", 0.0)]
    lenient = [tuple(r)[1:3 + 1] for r in language.detection_from_calls(df, prof=language.LENIENT_DETECTION).collect()]
    assert lenient[1] == ("UNKNOWN", 0.0, "UNKNOWN:1.0000") and lenient[2] == ("UNKNOWN", 0.0, "UNKNOWN")


def test_strict_json(spark):
    raw = ['{"Owner": "x"}', ' {"Owner": "x"}\n', '{"Owner": "x"}}', '{"a":1},{"b":2}', "", "[1]]", "nope"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, r string")
    got = [r[0] for r in df.orderBy("i").select(enrich.parse_analysis(F.col("r")).getField("Error")).collect()]
    assert got == [None, None] + ["Failed to parse JSON"] * 5


def test_refusals_known_by_their_message_wait_longer_and_calls_are_paced():
    waits = []

    def refuse(_):
        raise ValueError("HTTP 429 too many")

    _, err, tries, _ = enrich.call_with_retry(refuse, 1, max_tries=3, sleep=waits.append)
    assert waits == [2.0, 4.0] and err.startswith("RATE_LIMIT_ERROR") and tries == 3
    paused = []
    pace = enrich.Pacer(0.05, 2, 1.5, sleep=paused.append)
    for _ in range(4):
        pace()
    assert paused == [0.05, 0.05, 1.5, 0.05, 0.05, 1.5]


def test_nfkc_sends_only_texts_that_can_change(spark):
    df = spark.createDataFrame([("plain",), ("Ａｂｃ",), (None,)], "c string")
    assert [r[0] for r in df.select(tx.nfkc("c")).collect()] == ["plain", "Abc", None]
    plan = df.select(tx.nfkc("c").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan.split("_nfkc(")[1]


def test_a_hot_course_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(40_000).select(
            F.when(F.col("id") % 10 == 0, F.concat(F.lit("c"), F.col("id") % 7)).otherwise("hot").alias("content_id"),
            F.lit("n").alias("content_name"), F.sha2(F.col("id").cast("string"), 512).alias("comment"), F.lit("2024-01-01").alias("comment_date"),
            F.col("id").alias("ordinal"), F.lit("full").alias("bucket")).repartition(8)
        sinks.write_course_files(df, str(tmp_path / "o"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "o" / "content_id=hot").glob("*.csv"))) > 1
    back = src.scan_course_files(spark, str(tmp_path / "o"), T.StructType([T.StructField(c, T.StringType()) for c in ("content_name", "comment", "comment_date", "ordinal", "bucket")]), recursive=True)
    assert back.count() == 40_000


def test_reject_tables_and_json_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    good, bad = src.split_rejects(src.required_columns(df, ["doc_id", "text"]))
    assert [r.doc_id for r in good.collect()] == [1] and [tuple(r) for r in bad.collect()] == [(2, None, "null required field")]
    (tmp_path / "c1.json").write_text('[{"comment": "a"}, {"comment": "b"}]')
    assert src.scan_analysis_json(spark, str(tmp_path)).count() == 2
