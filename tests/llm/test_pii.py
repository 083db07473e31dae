import random
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from span_brute import PII, base, digest  # noqa: E402

from feedlens.llm import pii  # noqa: E402
from feedlens.llm.spans import listed  # noqa: E402

TRICKY = [None, "", "a@b.c_x@d.e", "a@b.c.x@y.z", "a@b@c.d", "a@b.c+d@e.f..g@h.i", "x" * 50000 + "@", "x" * 50000 + "@y.z é a@b.cd", "\U0001F600 a@b.cd é+1 (017) 555-7713",
          "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.256 000.001.255.0255", "1.2.3.99999999999999999999", "4111 1111 1111 1111", "4111-1111 11111111 1 2", "4111  1111111111111",
          "1 " * 30000, "4952935900253052", "49529359002530520000000", "+1+1 555-1234-5678", "+1 (555) 123-4567-", "+ 1 2", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "5+12345678901234@1.2.3.4",
          "9" * 60000, "1.1.1.1 " * 3000]


def _noise(n=300):
    rng = random.Random(1)
    alphabet = ["a", "Z", "@", ".", "-", "_", "+", " ", "(", ")", "1", "23", "4111111111111111", "1.2.3.4", "a@b.co", "+1 555 123 4567", "é", "\n", "%"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_base_spans_equal_the_patterns(spark):
    texts = TRICKY + _noise()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    rows = pii.find(docs).select("doc_id", F.expr(listed("base")).alias("b")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.b == ",".join(base(texts[r.doc_id], PII)), (r.doc_id, texts[r.doc_id])
    assert pii.find(docs.limit(0)).count() == 0


def _corpus():
    plain = [(100 + i, f"ordinary words number w{i} speak about weather and gardens") for i in range(60)]
    # Quillfeather stands beside one address in four texts and nowhere else; gardens are everywhere
    told = [(i, f"case {'abcdefgh'[i]}: Quillfeather uses q.f@mail.example of gardens today") for i in range(4)]
    return told + plain + [(90, "Quillfeathers write to q.f@mail.example"), (91, "Quillfeather alone")]


def test_disclosing_terms_are_found_beside_their_entity(spark):
    docs = spark.createDataFrame(_corpus(), "doc_id long, text string")
    rows = {r.doc_id: r.s for r in pii.find(docs, threshold=0.8, remove_at=2.0).select("doc_id", F.expr(listed("spans")).alias("s")).collect()}
    texts = dict(_corpus())
    at = texts[0].index("Quillfeather")
    assert f"term:{at}:{at + 12}" in rows[0] and "email" in rows[0]
    for i in range(4):
        named = {texts[i][int(s.split(":")[1]):int(s.split(":")[2])] for s in rows[i].split(",")}
        assert named >= {"q.f@mail.example", "Quillfeather"} and "gardens" not in named
    assert rows[91] == "" and all(rows[100 + i] == "" for i in range(60))
    assert rows[90].startswith("email:") and "," not in rows[90]


def test_sanitised_texts_hold_no_entity(spark):
    rows = [(i, t, "k", 5, "z") for i, t in _corpus()] + [(500, None, "k", None, "z"), (None, "mail x@y.zz now", "k", 3, "z"), (501, "+1 (017) 555-7713 and 1.2.3.4@x.yz", "k", 1, "z"), (501, "+1 (017) 555-7713 and 1.2.3.4@x.yz", "k", 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars int, tag string")
    out = pii.sanitise(docs, remove_at=2.0)
    got = out.collect()
    assert out.columns == docs.columns and len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert "<EMAIL>" in by[0].text and "<TERM>" in by[0].text and "Quillfeather" not in by[0].text and "gardens" in by[0].text
    assert by[500].text is None and by[None].text == "mail <EMAIL> now" and by[None].n_chars == len("mail <EMAIL> now")
    assert by[501].text == "<PHONE> and <EMAIL>" and by[100].text == dict(_corpus())[100]


def test_query_equals_brute_force_on_the_given_tables(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    got = pii.op2_pii(spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id], PII)
        assert r.base_sha256 == digest(want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w.startswith(k) for w in want) for k in PII)
        assert set(want) <= set(filter(None, r.spans.split(",")))


def _spans(spark, told):
    """The text of each span of the told texts, in a corpus of other texts."""
    docs = spark.createDataFrame(told + [(100 + i, f"ordinary words number w{i} speak about weather and gardens") for i in range(60)], "doc_id long, text string")
    rows = pii.find(docs, remove_at=2.0).select("doc_id", F.expr(listed("spans")).alias("s")).collect()
    texts = dict(told)
    return {r.doc_id: [texts[r.doc_id][int(s.split(":")[1]):int(s.split(":")[2])] for s in r.s.split(",") if s] for r in rows if r.doc_id in texts}


def test_terms_count_over_the_whole_text_and_are_marked_everywhere(spark):
    far = " ".join(f"{w} and gardens" for w in ("weather", "words", "ordinary") * 20)
    told = [(i, f"Quillfeather, Ng and \u0928\u093f\u0936\u093e. {far} {'abcdefgh'[i]} q.f@mail.example {far} Quillfeather") for i in range(4)]
    told += [(8, "Quillfeather alone"), (None, told[0][1])]
    got = _spans(spark, told)
    assert got[8] == []
    for i in (0, 1, 2, 3, None):
        assert got[i].count("Quillfeather") == 2 and "q.f@mail.example" in got[i]
        assert {"Ng", "\u0928\u093f\u0936\u093e"} <= set(got[i]) and not {"gardens", "weather", "and"} & set(got[i])


def test_a_number_that_is_no_entity_does_not_hide_a_term(spark):
    got = _spans(spark, [(i, f"Holder {'abcdefgh'[i]} Quillfeather, born 1980, card 4111 1111 1111 1111 (gardens)") for i in range(4)])
    assert all({"Quillfeather", "born", "4111 1111 1111 1111"} <= set(got[i]) and "gardens" not in got[i] for i in range(4))
