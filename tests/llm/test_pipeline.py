import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline as cp  # noqa: E402
import numpy as np  # noqa: E402
from span_brute import PII, base  # noqa: E402
from test_decontaminate import _fast_brute  # noqa: E402

from feedlens.llm import quality, simhash  # noqa: E402

SF = "/root/testdata/sf0.01"


def _stage(spark, name, docs):
    return dict(cp.STAGES)[name](spark, docs, SF)


def test_stages_equal_brute_force_on_their_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = cp.stored(_stage(spark, "quality", docs), "t")
    assert kept.columns == docs.columns
    verdict = {r.doc_id: r.keep for r in quality.score(docs, labels).collect()}
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {d for d, k in verdict.items() if k} and 0 < len(ids) < len(verdict)

    one = cp.stored(_stage(spark, "simhash", kept), "t")
    texts = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
    order = sorted(texts)
    codes = np.array([simhash.fingerprint(texts[d].encode()) for d in order], np.uint64)
    group = {d: d for d in order}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for i, d in enumerate(order):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1:] ^ codes[i]) <= 4):
            a, b = root(d), root(order[i + 1 + j])
            group[max(a, b)] = min(a, b)
    single = {r.doc_id: r.text for r in one.select("doc_id", "text").collect()}
    assert one.columns == docs.columns and single == {d: texts[d] for d in order if root(d) == d}

    clean = cp.stored(_stage(spark, "decontaminate", one), "t")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = _fast_brute(list(single.items()), items)
    left = {r.doc_id: r.text for r in clean.select("doc_id", "text").collect()}
    assert clean.columns == docs.columns and left == {d: t for d, t in single.items() if not hit[d][4]} and len(left) < len(single)

    safe = cp.stored(_stage(spark, "pii", clean), "t")
    now = {r.doc_id: r for r in safe.collect()}
    assert safe.columns == docs.columns and set(now) == set(left)
    for d, t in left.items():
        if not base(t, PII):
            assert now[d].text == t
        else:
            assert not base(now[d].text, PII) and re.search("<(EMAIL|IP|CARD|PHONE)>", now[d].text) and now[d].n_chars == len(now[d].text)

    tokens = _stage(spark, "tokens", safe).collect()
    assert len(tokens) == len(now) and all(r.round_trip and r.n_tokens == len(r.ids) for r in tokens)


def test_nulls_repeated_rows_clashing_columns_and_empty_tables(spark):
    text = "the quick brown fox walks over the green hills of a far country " * 4
    rows = [(1, text, "en", "s", 3, 9), (1, text, "en", "s", 3, 9), (2, text, None, None, None, 9), (None, text, "en", "s", 3, 9), (None, None, None, None, None, None),
            (3, None, "en", "s", 0, 9), (4, "", "en", "s", 0, 9), (5, "mail a.b@c.de now", "en", "s", 3, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, first_of_group int")
    for empty in (False, True):
        out = docs.limit(0) if empty else docs
        for name, stage in cp.STAGES:
            before = out.columns
            out = cp.stored(stage(spark, out, SF), "t")
            assert name == "tokens" or out.columns == before
        got = sorted((r.doc_id or 0, r.n_tokens > 0) for r in out.collect())
        assert got == ([] if empty else [(0, False), (0, True), (1, True), (3, False), (5, True)])


def test_run_returns_the_last_stage(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "round_trip"] and 0 < out.count() < 200


def test_one_id_with_different_texts_loses_none(spark):
    a, b, c = ("the quick brown fox walks over green hills " * 4, "numbers of a far country are counted by hand " * 4, "rain falls on gardens at night without end " * 4)
    docs = spark.createDataFrame([(2, a, "x"), (1, a, "x"), (1, b, "x"), (3, c, "x"), (3, c, "x"), (3, b, "x"), (1, c, "y")], "doc_id long, text string, first_id string")
    out = cp.drop_near_copies(spark, docs, SF)
    assert out.columns == docs.columns and sorted(tuple(r) for r in out.collect()) == sorted([(1, a, "x"), (1, b, "x"), (1, c, "y")])
