"""Facts for queries that ask for no comment are written without the texts; text of ASCII alone takes a shorter way to its key."""
import random

import pytest
from pyspark.sql import functions as F

from feedlens.functions import text as tx
from feedlens.operators import dashboard
from feedlens.plans import catalog, flows

LEAN = ["join_language_inner", "language_counts", "language_sentiment", "flat_buckets"]


@pytest.fixture
def folder(spark, tmp_path):
    words = ["the video was good and clear", "der Kurs ist nicht gut und zu lang", "le son “est” mauvais pour la vidéo", "THE\tsound of\\ it is  bad"]
    rows = [(i, f"{words[i % 4]} {'again' if i % 3 == 0 else 'x' * (i % 23)}", "en") for i in range(400)]
    rows += rows[:50] + [(400, None, None), (None, "one two three four five", "en"), (402, "one two three", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def _with_texts(spark, folder):
    facts = flows.language_facts(spark, folder)
    counted = dashboard.language_rows_counted(facts)
    return {"join_language_inner": facts.select(*catalog._FACT_COLS), "language_counts": dashboard.language_counts(counted),
            "language_sentiment": dashboard.language_sentiment(facts), "flat_buckets": dashboard.flat_buckets(facts)}


def test_no_text_is_written_where_none_is_asked_for(spark, folder, monkeypatch):
    want = {k: sorted(map(str, df.collect())) for k, df in _with_texts(spark, folder).items()}
    written, write = [], flows.materialize
    monkeypatch.setattr(flows, "materialize", lambda df, *a: written.append(df.columns) or write(df, *a))
    for name in LEAN:
        got = catalog.REGISTRY[name][0](spark, folder)
        assert sorted(map(str, got.collect())) == want[name] and want[name]
    assert len(written) == len(LEAN) and not any({"comment", "_norm", "norm"} & set(columns) for columns in written)
    # who asks for the comments gets them
    assert all(r.comment for r in catalog.REGISTRY["dedup_latest"][0](spark, folder).collect())


def test_only_edited_comments_are_hashed_again(spark, folder):
    rows = flows.scored_full(spark, folder, with_language=True).select("ordinal", "comment", "edited_key").collect()
    assert {r.ordinal % 17 == 0 for r in rows} == {True, False}
    assert all((r.edited_key is not None) == (r.ordinal % 17 == 0) for r in rows)


def test_ascii_text_takes_no_pattern_of_normal_forms(spark):
    rng = random.Random(5)
    pools = [[*map(chr, range(9, 14)), *map(chr, range(0x1C, 0x21)), " ", " ", *"aB\\'\"\0"],
             [*"aB\\ ", "\t", "\x85", "\xa0", "　", "‘", "”", "É", "ﬁ", "é", "\U0001F600"]]
    texts = [None, ""] + ["".join(rng.choices(pools[i % 2], k=rng.randrange(12))) for i in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def want(t):
        import unicodedata
        t = unicodedata.normalize("NFKC", t or "").translate(str.maketrans("‘’“”", "''\"\"", "\\"))
        return " ".join(t.lower().split())
    rows = df.select("t", tx.norm_comment("t").alias("n"), tx.is_ascii("t").alias("a")).collect()
    assert all(r.n == want(r.t) and (r.t is None or r.a == r.t.isascii()) for r in rows)
    plan = df.select(tx.nfkc("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and "RLIKE [^\\x00-\\x7F]" not in plan
