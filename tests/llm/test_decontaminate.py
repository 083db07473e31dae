import hashlib
import random
import re

from feedlens.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    out = {}
    wins = [(i, tuple(w[a:a + k])) for i, t in items for w in [words(t)] if w for a in range(max(1, len(w) - k + 1))]
    for d, t in docs:
        w, hit, got = words(t), set(), set()
        for i, x in wins:
            for a in range(len(w) - len(x) + 1):
                if tuple(w[a:a + len(x)]) == x:
                    hit.update(range(a, a + len(x)))
                    got.add(str(i))
        out[d] = (len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit))
    return out


def _case():
    rng = random.Random(5)
    vocab = ["the", "of", "A", "été", "x1", "7", "ÉTÉ", "b"]
    say = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "-", "!! "]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 9, 10, 11, 25, 40]))) for i in range(30)] + [(50, None), (51, " .!"), (52, "the the the"), (None, "b b b b")]
    items += [(60, items[8][1])]
    docs = [(i, say(rng.randint(0, 80))) for i in range(60)]
    docs += [(100 + i, say(7) + " " + (rng.choice(items[:30])[1]) + " " + say(5)) for i in range(40)]
    docs += [(200, None), (201, ""), (202, "the " * 3000), (203, (items[20][1] or "").upper())]
    return docs, items


def _run(spark, docs, items, **kw):
    d = spark.createDataFrame([(a, b, "z") for a, b in docs], "doc_id long, text string, _n string")
    b = spark.createDataFrame(items, "item_id long, text string")
    m = dc.matches(d, b, **kw)
    from pyspark.sql import functions as F
    items_ = F.array_sort(F.array_distinct("_items"))
    rows = m.select("doc_id", "_n_words", dc._covered().alias("h"), F.size(items_).alias("n"),
                    F.sha2(F.array_join(items_, ","), 256).alias("s"), (F.size("_spans") > 0).alias("c")).collect()
    return {r[0]: tuple(r[1:]) for r in rows}


def test_equals_brute_force(spark):
    docs, items = _case()
    want = brute(docs, [("" if i is None else i, t) for i, t in items])
    assert _run(spark, docs, items) == want
    assert any(v[4] for v in want.values()) and not all(v[4] for v in want.values())


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, items = _case()
    assert _run(spark, docs, items, block_bytes=900) == brute(docs, [("" if i is None else i, t) for i, t in items])


def test_empty_tables(spark):
    docs, items = _case()
    assert _run(spark, [(1, "the of")], items[:0] or [(1, None)])[1][1] == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(docs[:3], "doc_id long, text string")
    assert dc.decontaminate(some, empty).count() == 3
    clash = some.selectExpr("doc_id", "text", "1 as _spans", "2 as c0", "3 as _n_words_k")
    assert dc.decontaminate(clash, spark.createDataFrame(items, "item_id long, text string")).columns == clash.columns
    assert dc.decontaminate(some.limit(0), empty).count() == 0


def test_query_equals_brute_force_on_the_given_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in dc.op7_decontaminate(spark, d).collect()}
    short = {i: t for i, t in docs}
    want = _fast_brute(docs, items)
    assert got == want and len(got) == len(short)


def _fast_brute(docs, items, k=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - k + 1) if w else 0):
            wins.setdefault(tuple(w[a:a + k]), set()).add(str(i))
    sizes = {len(x) for x in wins}
    out = {}
    for d, t in docs:
        w, hit, got = words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (x := tuple(w[a:a + n])) in wins:
                    hit.update(range(a, a + n))
                    got |= wins[x]
        out[d] = (len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit))
    return out
