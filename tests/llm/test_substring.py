import hashlib
import random

from feedlens.llm import substring as sb


def brute(docs, k):
    first = {}
    split = {d: (t or "").encode().split() for d, t in docs if d is not None}
    for d in sorted(split):
        w = split[d]
        for a in range(len(w) - k + 1):
            first.setdefault(tuple(w[a:a + k]), d)
    out = {}
    for d, w in split.items():
        hit = set()
        for a in range(len(w) - k + 1):
            if first[tuple(w[a:a + k])] < d:
                hit.update(range(a, a + k))
        kept = b" ".join(x for i, x in enumerate(w) if i not in hit)
        out[d] = (len(w), len(hit), hashlib.sha256(kept).hexdigest())
    return out


def _docs(k):
    rng = random.Random(8)
    vocab = ["a", "b", "ça", "D", "e."]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared = [say(rng.choice([k - 1, k, k + 1, 2 * k, 4 * k])) for _ in range(12)]
    docs = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts += say(rng.randint(0, 2 * k)) if rng.random() < .5 else rng.choice(shared)
        docs.append(rng.choice([" ", "\n", "\t "]).join(parts))
    docs += [docs[7], docs[7], None, "", "  \n", "é" * 100000, "x " * 5000, "x " * 200, " ".join(shared[3])]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return list(zip(ids, docs))


def test_equals_brute_force(spark):
    for k, phrase in ((6, 3), (12, 4)):
        docs = _docs(k)
        df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, values string")
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sb.dedup_substrings(df, k, phrase).collect()}
        want = brute(docs, k)
        assert got == want
        assert sum(v[1] for v in want.values()) > 100


def test_ids_that_are_null_or_repeated_and_an_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(8))
    rows = [(1, text), (1, text), (None, text), (2, text + " z"), (2, "other text"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in sb.dedup_substrings(df, 6, 3).collect())
    assert got == [(0, 0, 0), (0, 8, 0), (1, 8, 0), (1, 8, 0), (2, 2, 0), (2, 9, 8)]
    assert sb.dedup_substrings(df.limit(0), 6, 3).count() == 0


def test_query_equals_brute_force_on_the_given_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in sb.op8_substring(spark, d).collect()}
    assert got == brute(docs, 50)
