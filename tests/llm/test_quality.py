import random

import numpy as np
import pytest

from feedlens.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_estimation_finds_the_accuracies_of_overlapping_labellers():
    rng = np.random.default_rng(4)
    n, share = 40_000, 0.2
    bad = rng.random(n) < share
    hit = [(0.9, 0.02), (0.7, 0.05), (0.8, 0.1), (0.95, 0.01)]  # chance to reject a bad, a good one
    votes = np.stack([np.where(rng.random(n) < 0.3, -1, (rng.random(n) < np.where(bad, b, g)).astype(int)) for b, g in hit], axis=1)
    patterns, index = np.unique(votes, axis=0, return_inverse=True)
    index = index.ravel()
    chance = q.estimate(patterns, np.bincount(index).astype(float))[index]
    heard = (votes >= 0).sum(axis=1) >= 3
    assert abs(chance.mean() - share) < 0.03
    assert ((chance > 0.5) == bad)[heard].mean() > 0.97


def test_scorer_learns_words_that_no_labeller_knows():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(200)]
    rows, texts, label = [], [], []
    for i in range(3000):
        bad = i % 4 == 0
        words = rng.choices(vocab, k=60) + (["blargh"] if bad else [])
        text = " ".join(words).encode()
        texts.append(text)
        label.append(bad)
        rows.append((np.unique([q.slot(f) for f in q.features(*q.measure(text))]), 0.97 if bad else 0.02))
    scores = q.Scorer(q.fit(rows[:2400]))(texts[2400:])
    assert np.mean([(s > 0) == b for s, b in zip(scores, label[2400:])]) > 0.97


def _prose(rng, n=80):
    vocab = "the of house garden rain and walks slowly over green hills".split() + [a + b for a in ("win", "som", "hart", "bel", "clar") for b in ("ter", "mer", "en", "low", "ity", "ing", "wood")]
    return " ".join(rng.choice(vocab) for _ in range(n)) + "."


def test_abuse_and_noise_are_rejected_and_prose_is_kept(spark):
    rng = random.Random(3)
    rows = [(i, _prose(rng), 1, "x") for i in range(200)]
    rows += [(1000 + i, _prose(rng, 40) + " you worthless idiot and stupid scum", 1, "x") for i in range(20)]
    rows += [(2000 + i, " ".join(w + "%%%" for w in _prose(rng).split()), 1, "x") for i in range(20)]
    rows += [(3000 + i, "word " * 80, 1, "x") for i in range(20)]
    rows += [(5000, None, 1, None), (5001, "", 1, "x"), (5002, "hi", 1, "x"), (None, _prose(rng), 1, "x"), (7, rows[7][1], 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep int, bad_score string")
    kept = q.filter_quality(docs)
    got = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns
    assert all(i in got for i in range(200)) and got.count(7) == 2
    assert not [i for i in got if i is not None and 1000 <= i < 5000]
    assert None in got
    assert q.filter_quality(docs.limit(0)).count() == 0


def test_held_out_labels(spark):
    """Accuracy on annotated documents whose annotation the training never saw."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = labels.filter("doc_id % 3 <> 0")
    rows = q.score(docs, seen).join(labels.filter("doc_id % 3 = 0"), "doc_id").select("keep", "quality", "toxic").collect()
    clean = [r.keep for r in rows if r.quality == 1 and r.toxic == 0]
    poor = [r.keep for r in rows if r.quality == 0]
    assert len(rows) > 100 and np.mean(clean) > 0.98 and np.mean(poor) < 0.15
    toxic = [r.keep for r in rows if r.toxic == 1]
    assert np.mean(toxic) < 0.5


def test_held_out_toxic_documents_of_a_larger_corpus(spark):
    """Words of abuse that no list holds are learned from the annotations; recall of at least 0.9, no clean document lost."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = labels.filter("doc_id % 3 = 0").withColumnRenamed("doc_id", "held")
    scorer = q.train(docs, labels.filter("doc_id % 3 <> 0"))
    rows = docs.join(held, docs.doc_id == held.held).select("text", "quality", "toxic").collect()
    bad = [s >= 0 for s in scorer([(r.text or "").encode() for r in rows])]
    toxic = [b for b, r in zip(bad, rows) if r.toxic == 1]
    clean = [b for b, r in zip(bad, rows) if r.quality == 1 and r.toxic == 0]
    assert len(toxic) > 100 and np.mean(toxic) >= 0.9 and len(clean) > 900 and np.mean(clean) < 0.005


def test_query_covers_every_document_and_repeats(spark):
    first = sorted(map(tuple, q.op6_quality(spark, "/root/testdata/sf0.001").collect()))
    again = sorted(map(tuple, q.op6_quality(spark, "/root/testdata/sf0.001").collect()))
    assert first == again and len(first) == 200
    assert first[0][1] == pytest.approx(again[0][1])


def test_labels_of_absent_documents_do_not_crowd_out_the_others(spark, monkeypatch):
    rng, seen = random.Random(8), []
    docs = spark.createDataFrame([(i, _prose(rng)) for i in range(300)], "doc_id long, text string")
    labels = spark.range(200_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    monkeypatch.setattr(q, "fit", lambda rows: seen.append(len(rows)) or np.zeros(10))
    q.train(docs, labels, train_docs=100)
    assert seen and 60 <= seen[0] <= 150
