import hashlib

import regex

from feedlens.llm import spotsigs as ss

COMMON = set(ss.COMMON_WORDS)


def sigs(text):
    """The signature tuples of the definition, without hashing."""
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    content = [(words[i - 1] if i and words[i - 1] in COMMON else "", w) for i, w in enumerate(words) if w not in COMMON]
    chain = lambda i: tuple(w for _, w in content[i:i + ss.CHAIN])
    spots = {(a, *chain(i)) for i, (a, _) in enumerate(content) if a}
    return spots or {("", *chain(i)) for i in range(len(content))} or ({("words", *words)} if words else {("text", text)} if text else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def expect(docs):
    docs = sorted(docs)
    out = {}
    for i, (d, t) in enumerate(docs):
        t, nxt = t or "", docs[(i + 1) % len(docs)][1] or ""
        k = len(t) // 4
        edited = t[:len(t) - k] + nxt[:k]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(sigs(t), sigs(edited)), jaccard(sigs(t), sigs(nxt)))
    return out


TEXTS = ["The cat of my house ate a red fish and the big dog slept on the sofa", "the of and", "", None, "!!! ???", "red fish blue fish", "été à la plage de la mer bleue",
         "The cat of my house ate a red fish and the big dog slept on the sofa", "\U0001F600" * 9, "x" * 40000, "the end of line " * 4000, "Der Hund und die Katze des Nachbarn sind im Garten der Stadt"]


def _run(spark, tmp_path, docs):
    path = str(tmp_path / "t")
    spark.createDataFrame(docs, "doc_id long, text string, n_chars int, guest int").write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return ss.op5_fingerprints(spark, path).collect()


def test_equals_the_definition(spark, tmp_path):
    docs = [(i * 7 - 20, t, None, 1) for i, t in enumerate(TEXTS * 60)]
    rows = _run(spark, tmp_path, docs)
    got = {r.doc_id: (r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in rows}
    want = {d: (*v[:2], round(v[2], 12), round(v[3], 12)) for d, v in expect([(d, t) for d, t, _, _ in docs]).items()}
    assert len(rows) == len(docs) and got == want
    prints = {}
    for r in rows:
        prints.setdefault(docs[(r.doc_id + 20) // 7][1], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and prints[TEXTS[0]] != prints[TEXTS[1]]


def test_successors_across_blocks_and_gaps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ss, "BLOCK_ROWS", 3)
    ids = [1, 2, 3, 50, 51, 1000, 1001, 1002, 1003, 10**12]
    docs = [(d, f"the word{d} of text number{d} and more words{d}", 0, 0) for d in ids]
    got = {r.doc_id: r.edited_sha256 for r in _run(spark, tmp_path, docs)}
    assert got == {d: v[1] for d, v in expect([(d, t) for d, t, _, _ in docs]).items()}


def test_one_document_repeated_and_null_ids_and_an_empty_table(spark, tmp_path):
    one = _run(spark, tmp_path, [(5, "the cat sat here", 0, 0)])
    assert len(one) == 1 and one[0].near_next == 1.0
    rows = _run(spark, tmp_path, [(5, "the cat sat", 0, 0), (5, "the cat sat", 0, 0), (None, "x", 0, 0), (None, None, 0, 0), (6, "y", 0, 0)])
    assert len(rows) == 5 and all(0 <= r.near_next <= 1 for r in rows)
    assert _run(spark, tmp_path, []) == []


def test_compare_prunes_by_size_only_what_cannot_reach_the_limit(spark):
    pairs = spark.createDataFrame([(1, TEXTS[0], TEXTS[0]), (2, TEXTS[0], "the cat"), (3, None, ""), (4, TEXTS[0], TEXTS[11])], "k int, a string, b string")
    assert [r.likeness for r in ss.compare(pairs, "a", "b").orderBy("k").collect()] == [1.0, 0.0, 1.0, 0.0]
