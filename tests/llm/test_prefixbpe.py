import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlens.llm import prefixbpe as pb

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "   ", "\n\n ", "don't we'll I'm", "日本語のテキスト", "\U0001F600\U0001F468‍\U0001F469", "a" * 5000, "=" * 3001, " " * 2000 + "x", "\x00\x01",
       "ab<|endoftext|>cd <|endoftext|><|endoftext|> ", "<|endoftext", "é  　z", "՘࢏1₏ a՘ b", "\r\n\t 12345 1/2", "�"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def _noise(n=400):
    rng = random.Random(5)
    bits = ["a", "aa", "the", " ", "  ", "\n", "é", "ing", "tion", "Z", "-", "==", "'s", "12", "<|endoftext|>", "日", "x" * 40, " ", "\x85"]
    letters = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 120))) for _ in range(n)]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 50))) for _ in range(n)] + letters


def _want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_ids_and_texts_equal_the_library(spark, library):
    texts = [None, *ODD, *_noise()]
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, _ids string, _n_tokens long")
    got = pb.decode(pb.encode(docs, PATH), PATH, "_ids_").collect()
    assert len(got) == len(texts)
    for r in got:
        ids, ids_sha, decoded_sha = _want(library, texts[r.doc_id])
        assert (r._ids_, r._n_tokens_, r._ids_sha256, r._decoded_sha256) == (ids, len(ids), ids_sha, decoded_sha)
        assert r._decoded == (texts[r.doc_id] or "") and r._ids == "x" and r._n_tokens == r.doc_id


def test_every_prefix_has_the_last_token_of_its_own_encoding():
    bpe, library = pb.loaded(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(8)
    for _ in range(60):
        word = "".join(rng.choice("aabcdehinostrt") for _ in range(40))
        ids = [bpe.ids(word[:n].encode()) for n in range(1, 41)]
        assert [i[-1] for i in ids] == [library.encode(word[:n], add_special_tokens=False).ids[-1] for n in range(1, 41)]


def test_very_long_text_in_runs_and_small_caches(library, monkeypatch):
    text = " ".join(f"word{i} é=={i % 7}" for i in range(30000))
    ids, ids_sha, decoded_sha = _want(library, text)
    monkeypatch.setattr(pb, "RUN", 1000)
    monkeypatch.setattr(pb, "CACHE_BYTES", 50_000)
    monkeypatch.setattr(pb, "PAIRS", 500)
    bpe = pb.PrefixBpe(PATH)
    for _ in range(2):
        n, runs, *digests = bpe.encode(text)
        assert (n, sum(runs, []), digests) == (len(ids), ids, [ids_sha, decoded_sha]) and len(runs) > 30
    assert len(bpe.young) + len(bpe.old) < 1000


def test_decoding_foreign_and_broken_ids(spark, library):
    cases = [None, [], [50256], [447], [447, 247], [100000, 64], [64, -1, 64]]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "k int, _ids array<int>")
    got = {r.k: r._decoded for r in pb.decode(rows, PATH).collect()}
    assert got[0] is None and got[1] == "" and got[5] == library.decode([64]) and got[6] == library.decode([64, 64])
    assert all(got[k] == library.decode(cases[k], skip_special_tokens=False) for k in (2, 3, 4))


def test_tables_without_rows_repeated_rows_and_files_of_other_kinds(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    rows = pb.encode(docs, PATH).collect()
    assert sorted((r.doc_id or 0, r._n_tokens) for r in rows) == [(0, 0), (1, 2), (1, 2)]
    assert pb.encode(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        pb.PrefixBpe(public_tokenizers.path("word_bpe_49k.json"))


def test_query_equals_the_library_on_the_given_tables(spark, library):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.col("text")).collect()}
    got = pb.op11_prefixbpe(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        ids, ids_sha, decoded_sha = _want(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), ids_sha, decoded_sha)
