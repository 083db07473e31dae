import itertools
import random
import zlib

from feedlens.llm import sharding


def _brute(sizes, n):
    best = None
    for cuts in itertools.combinations_with_replacement(range(len(sizes) + 1), n - 1):
        ends = [0, *cuts, len(sizes)]
        worst = max(sum(sizes[a:b]) for a, b in itertools.pairwise(ends))
        best = worst if best is None else min(best, worst)
    return best


def test_capacity_is_the_minimax_of_all_cuts():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.choice([1, 2, 3, 50, rng.randint(1, 20)]) for _ in range(rng.randint(1, 9))]
        n = rng.randint(1, 4)
        want = _brute(sizes, n)
        assert sharding.smallest_capacity(sizes, n) == want
        cuts = sharding.cut_points(sizes, n)
        ends = [0, *cuts, len(sizes)]
        assert ends == sorted(ends) and len(cuts) == n - 1
        assert max(sum(sizes[a:b]) for a, b in itertools.pairwise(ends)) == want


def test_shards_hold_whole_groups_and_gapless_slots(spark):
    texts = [None, "", "é" * 5, "copy of one text"] + ["copy of one text"] * 300 + [f"text {i} " * (i % 17) for i in range(900)]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, slot int, shard string")
    got = sharding.shard_documents(docs, n_shards=7).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    by_text, slots, load = {}, {}, {}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes" and r.grown_shard is None
        assert by_text.setdefault(raw, r.shard) == r.shard and 0 <= r.shard < 7
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) == set(range(7))
    assert max(load.values()) < 1.1 * sum(load.values()) / 7


def test_repeated_rows_keep_their_places_and_an_empty_table_gives_none(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "b")], "doc_id long, text string")
    got = sharding.shard_documents(docs).collect()
    assert len(got) == 4 and len({(r.shard, r.slot) for r in got}) == 4
    assert sharding.shard_documents(docs.limit(0)).count() == 0
