"""Text steps that run once for each row and test each character a few times; the payload's comment lists."""
import re

import pytest
from pyspark.sql import functions as F

from feedlens.functions import text as tx
from feedlens.operators import clean, dashboard, language
from feedlens.plans import catalog, flows
from feedlens.sources.tables import raw_comments

SPACES = "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0       　"


@pytest.fixture
def folder(spark, tmp_path):
    """Negative and positive comments in two languages; every third text occurs in several documents."""
    words = ["the video was good and clear", "der Kurs ist nicht gut und zu lang", "the sound of it is bad", "das ist für mich zu viel"]
    rows = [(i, f"{words[i % 4]} {'again' if i % 3 == 0 else 'x' * (i % 23)}", "en") for i in range(400)]
    rows += rows[:50]        # repeated rows
    rows += [(400, None, None), (401, "  ", "en"), (402, "one two three", "en"), (403, " one two　three\nfour ", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_payload_holds_the_comment_lists_of_the_buckets(spark, folder):
    got = {r.key: r.value for r in catalog.REGISTRY["dashboard_payload"][0](spark, folder).filter("part = 'bucket' and field = 'negative_comments'").collect()}
    want = {}
    for r in flows.language_facts(spark, folder).collect():
        if r.sentiment == "negative":
            want.setdefault(f"{r.content_id}/{r.lang_name}", set()).add(r.comment.strip())
    assert got == {k: str(len(v)) for k, v in want.items()} and len(got) > 3
    assert "'negative_comments'" in catalog.oracle_sql()["dashboard_payload"]


def test_a_character_is_told_by_few_tests():
    classes = re.findall(r"\[((?:\\x\{[0-9A-F]+\}-\\x\{[0-9A-F]+\})+)\]", tx.nfkc_may_change())
    assert len(classes) > 50 and max(c.count("}-") for c in classes) <= 8


def test_detection_finds_the_tokens_once(spark, capsys):
    df = language.detect_language(spark.createDataFrame([("the cat and the dog",), ("",), (None,)], "comment string"))
    df.explain()
    assert capsys.readouterr().out.count("regexp_extract_all") == 1
    assert [r.predicted_language for r in df.collect()] == ["en", "en", "en"]


def test_buckets_are_filtered_without_counting_words(spark, folder, capsys):
    full = clean.clean_comments(raw_comments(spark, folder)).filter("bucket = 'full'")
    full.select("ordinal").explain()
    assert "regexp_replace(translate" not in capsys.readouterr().out
    rows = {r.ordinal: r.bucket for r in clean.split_comments(raw_comments(spark, folder)).collect()}
    assert (rows[400], rows[401], rows[402], rows[403]) == ("skipped", "skipped", "short", "full")


def test_more_words_agree_with_the_count(spark):
    texts = ["", " ", "a", " a b ", "a b c", "a　b\x1cc d", *[f"{s}a{s}b{s}{s}c{s}d{s}" for s in SPACES], "a b c d" * 9]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", tx.word_count("s").alias("n"), tx.collapse_ws("s").alias("c"), *(tx.more_words_than("s", k).alias(f"m{k}") for k in (0, 1, 3))).collect()
    for r in rows:
        assert (r.n, r.c, r.m0, r.m1, r.m3) == (n := len(r.s.split()), " ".join(r.s.split()), n > 0, n > 1, n > 3)


def test_words_of_a_set_are_whole_tokens(spark):
    text = "the them théthe the's नहीं नही the-end well-made"
    df = spark.createDataFrame([(text,)], "s string")
    found = lambda words: df.select(tx.extract_words(F.col("s"), words).alias("x")).first().x
    assert found(["the", "नहीं", "end"]) == ["the", "the", "नहीं", "the", "end"]
    assert found(["the", "well-made"]) == ["the", "the", "the", "well-made"]


def test_pending_language_detects_once(spark, folder, capsys):
    df = catalog.REGISTRY["pending_language"][0](spark, folder)
    df.explain()
    assert "regexp_extract_all" not in capsys.readouterr().out
    assert {r["mode"] for r in df.collect()} == {"default", "parity"}


def _text_exchanges(df, capsys) -> int:
    capsys.readouterr()
    df.explain("formatted")
    nodes = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\n.*?\n\n", capsys.readouterr().out, re.S)
    return sum(bool(re.search(r"\b(comment|norm|_norm)#", n)) for n in nodes)


def test_texts_are_shuffled_once_to_meet_their_records(spark, folder, capsys):
    s = flows.scored_full(spark, folder, with_language=True)
    assert "word_count" not in s.columns
    enr = dashboard.enrich(s, flows.analysis_of(s))
    assert _text_exchanges(enr.select("ordinal", "norm", "issue", "actions"), capsys) == 1
    facts, _ = flows.dashboard_facts(spark, folder, scored=s)
    assert not {"comment", "norm"} & set(facts.columns)
    assert _text_exchanges(dashboard.language_facts(flows.language_side(s), facts), capsys) == 1
