"""Trap tests for the column helpers (hand-made rows; the driver's text has none of these)."""
from pyspark.sql import functions as F

from feedlens.functions import text as tx
from feedlens.operators.enrich import prompt_text


def one(spark, value, col):
    return spark.createDataFrame([(value,)], "s string").select(col(F.col("s")).alias("x")).first()["x"]


def test_unicode_whitespace_split_and_trim(spark):
    s = "a b c\x1cd "
    assert one(spark, s, tx.word_count) == len(s.split()) == 4
    assert one(spark, "　 hi there  ", tx.utrim) == "hi there"
    assert one(spark, "x  y  z", tx.collapse_ws) == " ".join("x  y  z".split())
    assert one(spark, "   ", tx.word_count) == 0


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  \t",), (" x ",)], "s string")
    assert [r[0] for r in df.select(tx.is_blank(F.col("s"))).collect()] == [True, True, True, False]


def test_date_cut_t_before_space(spark):
    assert one(spark, "2024-01-02T03:04:05", tx.normalize_date) == "2024-01-02"
    assert one(spark, "2024-01-03 10:00:00", tx.normalize_date) == "2024-01-03"
    assert one(spark, "Tue 2 Jan", tx.normalize_date) == ""          # 'T' is tested first
    assert one(spark, "2024-01-04", tx.normalize_date) == "2024-01-04"


def test_norm_comment(spark):
    raw = "  It’s “GREAT” \\ ｆｕｌｌ width  "
    import unicodedata
    t = unicodedata.normalize("NFKC", raw)
    for a, b in (("’", "'"), ("‘", "'"), ("“", '"'), ("”", '"')):
        t = t.replace(a, b)
    expected = " ".join(t.replace("\\", "").lower().split())
    assert one(spark, raw, tx.norm_comment) == expected
    assert one(spark, "  A  b ", tx.norm_comment_simple) == "a b"


def test_title_case(spark):
    assert one(spark, "en-in", tx.title_case) == "En-In"
    assert one(spark, "fr", tx.title_case) == "Fr"


def test_regex_search_case_insensitive(spark):
    assert one(spark, "Cannot get my CERTIFICATE", lambda c: tx.regex_search(c, "certificate")) is True


def test_word_tokens_keep_marks(spark):
    # Devanagari word with a combining vowel sign stays one token
    assert one(spark, "नमस्ते world", tx.tokens) == ["नमस्ते", "world"]


def test_prompt_braces_not_expanded(spark):
    df = spark.createDataFrame([("c {comment} {x}",)], "comment string")
    out = df.select(prompt_text("say: {comment}!", {"comment": F.col("comment")})).first()[0]
    assert out == "say: c {comment} {x}!"


def test_format_number_half_even(spark):
    df = spark.createDataFrame([(0.25,), (12.35,)], "x double")
    got = [r[0] for r in df.select(F.format_number("x", 1)).collect()]
    assert got == [f"{0.25:.1f}", f"{12.35:.1f}"]


def _goes_to_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    return [r[0] for r in df.select(F.col("s").rlike("[^\\x00-\\x7F]") & F.col("s").rlike(tx.nfkc_may_change())).collect()]


def test_texts_of_four_scripts_stay_in_the_jvm(spark):
    calm = ["Déjà vu, Straße — “quoted” naïve", "नमस्ते दुनिया, यह पाठ्यक्रम अच्छा है।", "안녕하세요 좋은 강의입니다", "本课程非常好。", "Отличный курс, спасибо!", "தமிழ் பாடம்", "plain"]
    assert _goes_to_python(spark, calm) == [False] * len(calm)
    import unicodedata
    stirred = ["ｆｕｌｌ", "ﬁne", "e\u0301", "x²", "½ hour", "a\u0301\u0327", "가", "①", "\u212B", "\u095C", "q\u0307\u0323", "न\u093C", "\u1100\u1161\u11A8"]
    assert all(unicodedata.normalize("NFKC", t) != t for t in stirred[:6] + stirred[7:]) and all(unicodedata.normalize("NFKC", t) == t for t in calm)
    found = _goes_to_python(spark, stirred)
    assert [f for f, t in zip(found, stirred) if unicodedata.normalize("NFKC", t) != t] == [True] * sum(unicodedata.normalize("NFKC", t) != t for t in stirred)


def test_nfkc_equals_unicodedata_on_all_code_points(spark):
    import unicodedata
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    marks = "".join(chr(c) for c in points if unicodedata.combining(chr(c)))
    rows = [(i, "".join(chr(c) + "x" for c in points[i:i + 64])) for i in range(0, len(points), 64)]
    rows += [(-1 - i, "a" + m + marks[(i * 7 + 3) % len(marks)] + "z" + m) for i, m in enumerate(marks)]
    rows += [(-5000 - i, chr(c)) for i, c in enumerate(points) if c < 0x3400 or 0xF900 <= c < 0x10000]
    df = spark.createDataFrame(rows, "id long, s string").repartition(8)
    got = {r.id: r.n for r in df.select("id", tx.nfkc("s").alias("n")).collect()}
    assert all(got[i] == unicodedata.normalize("NFKC", s) for i, s in rows)
