import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedlens.llm import graph, simhash


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, distance=4):
    """code -> least code of its component, by comparing all pairs."""
    codes = sorted(set(codes))
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in itertools.combinations(codes, 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= distance:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def test_fingerprints_follow_the_definition():
    for text in ["", "  \t\n", "One", "One two  THREE", "one two three four", "É été\x0bO\x0cx y z\r\nw ÀÉ z", "a " * 70000, "the cat sat on the mat " * 40, " nbsp stays \x1c in words"]:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text), text[:30]


def _codes(seed):
    """Clusters of close codes, some very tight, among random ones."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(300)]
    for centre, n, flips in ((out[0], 120, 3), (out[1], 60, 8), (0, 40, 2), (2**64 - 1, 30, 5)):
        for _ in range(n):
            c = centre
            for b in rng.sample(range(64), rng.randint(0, flips)):
                c ^= 1 << b
            out.append(c)
    chain = out[2]
    for b in range(0, 60, 4):
        chain ^= 0b1111 << b
        out.append(chain)
    return [c - 2**64 if c >> 63 else c for c in set(out)]


@pytest.mark.parametrize("n_parts,hot", [(3, 2000), (3, 20), (2, 2000), (4, 25), (5, 2000)])
def test_links_join_the_same_components_as_all_pairs(spark, n_parts, hot):
    codes = _codes(n_parts * hot)
    df = spark.createDataFrame([(c,) for c in codes], "code long").repartition(4)
    links = simhash.fingerprint_links(df, 4, n_parts, hot)
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert {c: got.get(c, c) for c in codes} == brute_components(codes)
    if hot == 2000:
        pairs = [(r.u, r.v) for r in links.collect()]
        assert len(pairs) == len({frozenset(p) for p in pairs})  # every link once
        want = sum(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in itertools.combinations(codes, 2))
        assert len(pairs) == want


def test_parts_cover_all_bits_and_thresholds_are_allocated_by_cost():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (500, 64))
    bits[:, 40] = bits[:, 3]  # a correlated pair belongs together
    both = bits.T @ bits
    parts = simhash.group_bits(500, both, 3)
    assert sorted(b for p in parts for b in p) == list(range(64)) and any({3, 40} <= set(p) for p in parts)
    assert simhash.allocate([[0, 5, 9], [0, 1, 2], [0, 100, 200]], 0) == [0, 1, -1]
    for total in (-1, 0, 1):
        costs = rng.random((3, 4)).cumsum(axis=1).tolist()
        best = min((sum(c[t + 1] for c, t in zip(costs, ts)), ts) for ts in itertools.product(range(-1, 3), repeat=3) if sum(ts) == total)
        assert simhash.allocate(costs, total) == list(best[1])


def test_components_of_chains_stars_and_no_links(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 150), (150, 200)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 150: 150, 200: 150}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents_with_nulls_copies_and_clashing_columns(spark):
    text = "some words that make a longer text with more than four of them in it"
    rows = [(3, text, 1), (2, text.upper(), 1), (2, text.upper(), 1), (None, text, 1), (9, None, 1), (8, "", 1), (7, " \n", 1), (None, "lonely other text entirely here", 1), (5, "something quite different from all the rest", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int").withColumn("fingerprint", F.lit("x"))
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    code = f"{plain_fingerprint(text):016x}"
    assert by[3, code] == by[2, code] == by[None, code] == 2
    assert by[9, "0" * 16] == by[8, "0" * 16] == by[7, "0" * 16] == 7
    assert by[5, f"{plain_fingerprint(rows[8][1]):016x}"] == 5 and None in by.values()
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_brute_force_on_the_given_tables(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    codes = {i: simhash.fingerprint((t or "").encode()) for i, t in texts.items()}
    assert all(codes[i] == plain_fingerprint(texts[i]) for i in list(texts)[:30])
    root = brute_components(codes.values())
    least = {}
    for i, c in codes.items():
        least[root[c]] = min(i, least.get(root[c], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op1_simhash(spark, d).collect()}
    assert got == {i: (f"{c:016x}", least[root[c]]) for i, c in codes.items()}
