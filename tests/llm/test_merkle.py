import hashlib
import random
import zlib

from pyspark.sql import functions as F

from feedlens.llm import merkle as mk

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest int"


def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(row):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(leaves):
    """The root of a list of nodes, and each one's siblings (before, after), level by level."""
    steps, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, i in enumerate(at):
            start = i // 16 * 16
            steps[k].append(("".join(level[start:i]), "".join(level[i + 1:start + 16])))
            at[k] = i // 16
        level = [_h("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
    return level[0], steps


def _brute(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row, sorted."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r))) for s in sources}
    below = {s: _tree([_leaf(r) for r in t]) for s, t in trees.items()}
    root, above = _tree([below[s][0] for s in sources])
    out = []
    for s, up in zip(sources, above):
        for r, own in zip(trees[s], below[s][1]):
            steps, text = own + up, r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest = _leaf((*r[:4], text))
            for before, after in steps:
                digest = _h(before + digest + after)
            out.append((r[0], _leaf(r), below[s][0], root, _h("".join(a + b for a, b in steps)), digest, digest == root))
    return sorted(out, key=str)


def _check(spark, rows, tmp_path, name):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(7)
    docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    got = sorted((tuple(r) for r in mk.op12_merkle(spark, f"{tmp_path}/{name}").collect()), key=str)
    assert got == _brute(rows)


def _doc(i, source, text="Some Text É"):
    return i, source, "en", len(text or ""), text


def test_trees_of_all_sizes_equal_brute_force(spark, tmp_path):
    rows = [_doc(i, f"s{n}", f"Text {i} of {n}") for n in (1, 2, 15, 16, 17, 255, 256, 257, 300, 600) for i in range(n)]
    _check(spark, rows, tmp_path, "sizes")


def test_many_sources_and_one_that_holds_most(spark, tmp_path):
    rng = random.Random(1)
    rows = [_doc(i, f"s{rng.randint(0, 40)}" if i % 3 else "hot", "A" * (i % 50)) for i in range(5000)]
    _check(spark, rows, tmp_path, "hot")


def test_nulls_ties_repeated_rows_and_long_texts(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, None, "en", 3, "ABC"), (5, None, "en", None, ""), (5, "", "en", 0, ""), (5, "é", "en", 0, "É A"),
            (5, "z", "de", 2, "Az"), (5, "z", "de", 2, "Az"), (5, "z", "fr", 2, "Az"), (-7, "z", None, 1, "LONG " * 200000), (9, "+", "x", 1, None), (9, "\U0001F600", "x", 1, "q")]
    rows += [_doc(3, "copies")] * 40
    _check(spark, rows, tmp_path, "odd")


def test_one_row_and_no_rows(spark, tmp_path):
    _check(spark, [_doc(10, "a", "TEXT")], tmp_path, "one")
    docs = spark.createDataFrame([], SCHEMA)
    made = mk.manifest(docs)
    assert made.root is None and made.checked().count() == 0 and made.proofs().count() == 0


def test_proofs_lead_to_the_root_and_only_every_second_level_is_stored(spark):
    rows = [_doc(i, "a" if i < 700 else f"b{i % 20}") for i in range(1000)]
    made = mk.manifest(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    assert [t.select(F.sum(F.size("nodes"))).first()[0] for t in made.rows.levels] == [1000, 23]
    by_id = {r[0]: r for r in rows}
    got = made.proofs().collect()
    assert len(got) == 1000 and {r.source for r in got} == {r[1] for r in rows}
    for r in got:
        steps = [(s.before, s.after) for s in r.steps]
        assert r.leaf == _leaf(by_id[r.doc_id]) and mk.folded(r.leaf, steps) == r.root == made.root and r.source == by_id[r.doc_id][1]
        assert mk.folded(_h("other"), steps) != r.root


def test_given_tables(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted((tuple(r) for r in mk.op12_merkle(spark, d).collect()), key=str)
    assert got == _brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 4
