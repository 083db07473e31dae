import base64
import hashlib

import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from feedlens.llm import bpe

PATH, PATTERN = bpe.public_vocabulary()
TEXTS = [None, "", " ", "the " * 50, " " * 5000, "a" * 30000, "ab" * 1000 + "é" * 500, "x" * 199, "x" * 201, "!?" * 400, "日本語テキスト" * 100,
         "\n\n  \t x", "I'll we've 's'S 're 12345 \U0001F600\u0000  z", "Ünïcödé  straße", "the " * 50]


@pytest.fixture(scope="module")
def tik():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _want(tik, text):
    ids = tik.encode_ordinary(text or "")
    return (len(ids), ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_encodes_as_tiktoken_and_decodes_back(spark, tik):
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    encoded = bpe.encode(docs, PATH, PATTERN)
    rows = bpe.decode(encoded, PATH, PATTERN).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r._n_tokens, r._ids, r._ids_sha256, r._decoded_sha256) == _want(tik, r.text)
        assert bytes(r._decoded) == (r.text or "").encode()
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0
    clash = bpe.encode(docs.selectExpr("doc_id as _ids", "text"), PATH, PATTERN)
    assert clash.columns == ["_ids", "text", "_n_tokens", "_ids_sha256", "_decoded_sha256", "_ids_"] and clash.count() == len(TEXTS)


def test_segments_of_a_long_text_join_to_the_same_ids(tik, monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", 40)
    monkeypatch.setattr(bpe, "RUN_CHARS", 100)
    monkeypatch.setattr(bpe, "CACHE", 20)
    own = bpe.Bpe(PATH, PATTERN)
    texts = ["Some words, and  more\n words 12 to go's on " * 30, "x" * 500, "a b c " * 90, ""]
    n, ids, ids_sha, decoded_sha = own.encode(texts)
    for k, t in enumerate(texts):
        w = _want(tik, t)
        assert (n[k], ids_sha[k], decoded_sha[k]) == (w[0], w[2], w[3])
        assert b"".join(p.encode() for s in own.segments(t) for p in s) == t.encode()


def test_heap_and_recursive_query_agree(tik):
    own = bpe.loaded(PATH, PATTERN)
    pieces = [p.encode() for t in TEXTS if t for p in regex.findall(PATTERN, t) if len(p.encode()) <= 300]
    pieces = sorted({p for p in pieces if p not in own.ranks})
    assert own.contract(pieces) == [own.contract_long(p) for p in pieces]


def test_query_equals_tiktoken_on_the_given_tables(spark, tik):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    got = bpe.op3_bpe(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        w = _want(tik, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (w[0], w[2], w[3])


def test_pieces_are_cut_as_regex_cuts_them_and_contracted_in_blocks(tik, monkeypatch):
    quick, whole = bpe.plain_pattern(PATTERN), regex.compile(PATTERN)
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000)]):
        text = f"a{c}1{c}{c} {c}'{c}"
        assert quick.findall(text) == whole.findall(text)
    assert bpe.plain_pattern(r"(?i:'s|'t)|\p{L}+") is None and bpe.plain_pattern(r"\P{L}") is None
    texts = ["Quick \U0001F600\U0001D400b  1\U0001D7D8", "plain ascii, 12 x", "", "Ünï\u2003\u2003x"]
    assert [bpe.splitter(PATTERN)(t) for t in texts] == [whole.findall(t) for t in texts]
    monkeypatch.setattr(bpe, "BLOCK", 3)
    own, rows = bpe.loaded(PATH, PATTERN), []
    block = own.contract_block
    monkeypatch.setattr(own, "contract_block", lambda pieces: rows.append(len(pieces)) or block(pieces))
    pieces = sorted({w.encode() for t in TEXTS if t for w in whole.findall(t) if len(w.encode()) <= 200})
    got = own.contract(pieces)
    assert max(rows) == 3 and sum(rows) == len(pieces)
    assert got == [(",".join(map(str, tik.encode_ordinary(p.decode()))).encode(), p) for p in pieces]
