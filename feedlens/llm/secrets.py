"""Secret scans by a battery of randomness tests, in DataFrame operations.

Base secrets (assignments to a secret's name, access keys, hex runs) are found by pattern.
The method adds tokens that no pattern knows, because they look drawn at random:

1. Tokens of ``MIN_LENGTH`` characters or more from the alphabet of keys are candidates; the
   encoding is inferred from their characters (digits, hex, base32, letters, base36, base64).
2. Each distinct token gets three statistics on its encoding's alphabet: chi-squared of the
   symbol counts against uniform, the number of runs above and below the middle symbol, and
   the serial correlation of neighbouring symbols.  A token that fails a randomness test at
   ``REJECT`` is no secret.
3. Ordinary text isn't uniform: two of its symbols are equal more often.  The same three
   statistics are measured on all shorter tokens of the corpus, for each encoding: their mean, and
   how much they vary by chance (which shrinks with the length) and from token to token (with its
   root).  Each test so gives a p-value, the chance that an ordinary token of this length looks
   as random; the token's is the least of the three times their number.
4. Benjamini-Hochberg at ``FDR`` within each encoding and class of lengths keeps the tokens
   that stand out; p-values are counted in steps of a fiftieth of a decade, so the control
   is an aggregate over at most ``STEPS`` counts for a class and never a sort of all tokens.

A frequent token is one row per task before the shuffle, and its places meet the verdict in
a join that may be split.  No text is shuffled.

Defined results: a null text counts as empty; repeated rows give the same spans each; an
empty table gives no rows; other columns are not read (``find``) or pass through (``redact``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import sha256_hex, stored, table, text_of
from .spans import count_of, listed, matches, with_replaced

MIN_LENGTH = 20
REFERENCE_LENGTH = 14
REJECT = 1e-4
FDR = 0.05
STEPS = 1000
#: An encoding with fewer ordinary tokens is judged by those of all encodings.
LEAST_ORDINARY = 30
KINDS = ("assign", "access", "hex")
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "letters": "abcdefghijklmnopqrstuvwxyz",
    "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Least lengths of the classes of lengths within which discoveries are controlled.
CLASSES = (20, 24, 28, 32, 40, 48, 64, 96, 128, 256)

_TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+"


def base_spans() -> str:
    """SQL for the sorted base spans of ``text``."""
    name = r"(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
    value = f"length(regexp_extract(s.value, r'^{name}([A-Za-z0-9+/_.=-]+)', 1)) >= 6"
    return "array_sort(concat({}))".format(", ".join([
        matches("assign", 0, name + "[A-Za-z0-9+/_.=-]+", "(contains(text, '=') or contains(text, ':'))", value),
        matches("access", 1, "AKIA[A-Z0-9]++", "contains(text, 'AKIA')", "length(s.value) >= 20"),
        matches("hex", 2, "(?<![0-9a-f])[0-9a-f]{24,}+"),
    ]))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, base, tokens, shorter) for every row: base spans, the spans of candidate tokens
    that overlap none, and the tokens too short to be candidates."""
    rows = docs.select("doc_id", text_of().alias("text")).select("doc_id", "text", F.xxhash64("text").alias("tag"))
    rows = rows.select("doc_id", "tag", F.expr(base_spans()).alias("base"),
                       F.expr(matches("random", len(KINDS), _TOKEN % MIN_LENGTH)).alias("tokens"),
                       F.expr(f"filter(regexp_extract_all(text, r'{_TOKEN % REFERENCE_LENGTH}', 0), t -> length(t) < {MIN_LENGTH})").alias("shorter"))
    free = "filter(tokens, t -> not exists(base, b -> b.start < t.end and t.start < b.end))"
    return rows.withColumn("tokens", F.expr(free))


def encoding_of(token: str) -> Column:
    """The smallest alphabet that holds the token."""
    t = F.col(token)
    return (F.when(t.rlike("^[0-9]+$"), "digits").when(t.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex").when(t.rlike("^[A-Z2-7]+$") & t.rlike("[2-7]"), "base32")
            .when(t.rlike("^[A-Za-z]+$"), "letters").when(t.rlike("^(?:[a-z0-9]+|[A-Z0-9]+)$"), "base36").otherwise("base64"))


def _coded(tokens: DataFrame) -> DataFrame:
    """``tokens`` with their encoding, its size k, length n and the symbols as numbers."""
    folded = F.when(F.col("encoding").isin("hex", "letters", "base36"), F.lower("token")).otherwise(F.translate("token", "-_", "+/"))
    alphabet = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])[F.col("encoding")]
    out = tokens.withColumn("encoding", encoding_of("token")).withColumn("folded", folded).withColumn("alphabet", alphabet)
    codes = "transform(sequence(1, length(folded)), i -> locate(substring(folded, i, 1), alphabet) - 1)"
    out = out.withColumn("k", F.length("alphabet")).withColumn("n", F.length("folded")).withColumn("codes", F.expr(codes))
    squares = ("aggregate(array_distinct(transform(sequence(1, length(folded)), i -> substring(folded, i, 1))), 0.0D,"
               " (a, c) -> a + power(length(folded) - length(replace(folded, c, '')), 2))")
    return out.withColumn("squares", F.expr(squares)).drop("folded", "alphabet")


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution (Abramowitz and Stegun 26.2.17, for either sign)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / 2.5066282746310002 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (token) with chi2 and the p-values of the three tests of randomness."""
    t = _coded(tokens)
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    high = "cast(aggregate(codes, 0, (a, c) -> a + if(c * 2 >= k, 1, 0)) as double)"
    turns = "cast(aggregate(sequence(1, n - 1), 0, (a, i) -> a + if((codes[i] * 2 >= k) <> (codes[i - 1] * 2 >= k), 1, 0)) as double)"
    total = "cast(aggregate(codes, 0L, (a, c) -> a + c) as double)"
    squares = "cast(aggregate(codes, 0L, (a, c) -> a + c * c) as double)"
    lagged = "cast(aggregate(sequence(1, n - 1), 0L, (a, i) -> a + codes[i] * codes[i - 1]) as double)"
    t = t.select("token", "encoding", "n", "k", (k / n * F.col("squares") - n).alias("chi2"), F.expr(high).alias("high"), F.expr(turns).alias("turns"),
                 F.expr(total).alias("total"), F.expr(squares).alias("sum2"), F.expr(lagged).alias("lagged"))
    mean = 2 * F.col("high") * (n - F.col("high")) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    runs = F.when(spread > 0, (F.col("turns") + 1 - mean) / F.sqrt(spread))
    m = F.col("total") / n
    variance = F.col("sum2") / n - m * m
    serial = F.when(variance > 0, ((F.col("lagged") - (n - 1) * m * m) / n / variance + 1 / n) * F.sqrt(n))
    cube = (F.pow(F.col("chi2") / (k - 1), F.lit(1 / 3)) - (1 - 2 / (9 * (k - 1)))) / F.sqrt(2 / (9 * (k - 1)))
    both = lambda z: F.coalesce(F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z))), F.lit(0.0))
    return t.select("token", "encoding", "n", "k", "chi2", _upper_tail(cube).alias("p_uniform"),
                    both(runs).alias("p_runs"), both(serial).alias("p_serial"), runs.alias("z_runs"), serial.alias("z_serial"))


#: How far a token is from a random one, free of its length: how often two of its symbols are equal (what
#: chi-squared tells), and what runs and serial correlation are off, over the root of the length.
EFFECTS = ("meet", "runs_off", "serial_off")


def _effects(tested: DataFrame) -> DataFrame:
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    return tested.select("*", (((F.col("chi2") + n) / k - 1) / (n - 1)).alias("meet"),
                         *((F.abs(F.col(f"z_{c}")) / F.sqrt(n)).alias(f"{c}_off") for c in ("runs", "serial")))


def secrets(found: DataFrame, fdr: float = FDR) -> DataFrame:
    """The distinct candidate tokens (token, encoding, p) that the battery and the control keep."""
    tokens = found.select(F.explode("tokens.value").alias("token")).groupBy("token").agg(F.count("*").alias("times")).select("token")
    # the same three statistics of ordinary tokens, for each encoding: a few rows
    ordinary = _effects(battery(found.select(F.explode("shorter").alias("token")).distinct()))
    chance = F.col("meet_mean") * (1 - F.col("meet_mean"))
    stats = [*(f(c).alias(f"{c}_{name}") for c in EFFECTS for name, f in (("mean", F.avg), ("var", F.var_pop))),
             F.avg("n").alias("length"), F.avg(2 / (F.col("n") * (F.col("n") - 1.0))).alias("pairs"), F.count("*").alias("size")]
    fields = [c for e in EFFECTS for c in (f"{e}_mean", f"{e}_var")] + ["length"]
    differ = F.greatest(F.col("meet_var") - chance * F.col("pairs"), F.lit(0.0))
    null = ordinary.groupBy("encoding").agg(*stats).filter(F.col("size") >= LEAST_ORDINARY).select("encoding", *fields, differ.alias("differ"))
    # what all words of the corpus do stands in for an encoding with too few of its own
    words = ordinary.filter("encoding <> 'digits'").agg(*stats).select(*(F.col(c).alias(f"all_{c}") for c in fields), differ.alias("all_differ"))
    tested = _effects(battery(tokens)).join(F.broadcast(null), "encoding", "left").join(F.broadcast(words))
    own = F.col("meet_mean").isNotNull()
    known = lambda c, default: F.when(own, F.col(c)).otherwise(F.coalesce(f"all_{c}", F.lit(default)))
    n = F.col("n").cast("double")
    shrink = known("length", REFERENCE_LENGTH + 2.0) / n
    # in a small alphabet words meet at least twice as often as random symbols
    mean = F.when(own, F.col("meet_mean")).otherwise(F.greatest(F.coalesce("all_meet_mean", F.lit(0.0)), 2 / F.col("k")))
    vary = F.when(own, F.col("differ")).otherwise(F.coalesce(F.col("all_differ") / F.pow("all_meet_mean", F.lit(2)), F.lit(0.1)) * mean * mean)
    spread = F.greatest(F.sqrt(mean * (1 - mean) * 2 / (n * (n - 1)) + vary * shrink), mean / 10 * F.sqrt(shrink))
    each = [_upper_tail((mean - F.col("meet")) / spread)]
    for c in EFFECTS[1:]:
        wide = F.greatest(F.sqrt(known(f"{c}_var", 0.0) * shrink), F.lit(1e-3))
        each.append(F.coalesce(_upper_tail((known(f"{c}_mean", 0.0) * F.sqrt(shrink) - F.col(c)) / wide), F.lit(1.0)))
    p = F.greatest(F.least(F.lit(1.0), len(each) * F.least(*each)), F.lit(1e-20))
    bounds = F.array(*[F.lit(c) for c in CLASSES])
    tested = tested.select("token", "encoding", F.size(F.filter(bounds, lambda c: c <= F.col("n"))).alias("class"), p.alias("p"),
                           (F.least("p_uniform", "p_runs", "p_serial") >= REJECT).alias("random"))
    tested = stored(tested.withColumn("step", F.least(F.lit(STEPS), F.floor(-50 * F.log10("p"))).cast("int")), "secret-tests")
    group = ["encoding", "class"]
    counts = tested.groupBy(*group, "step").agg(F.count("*").alias("c"))
    down = Window.partitionBy(*group).orderBy(F.desc("step"))
    ranked = counts.select(*group, "step", F.sum("c").over(down).alias("rank"), F.sum("c").over(Window.partitionBy(*group)).alias("m"))
    cut = ranked.filter(F.pow(F.lit(10.0), -F.col("step") / 50) <= fdr * F.col("rank") / F.col("m")).groupBy(*group).agg(F.min("step").alias("cut"))
    # at most a row for each encoding and class
    return tested.join(F.broadcast(cut), group).filter((F.col("step") >= F.col("cut")) & F.col("random")).select("token", "encoding", "p")


def find(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """(doc_id, tag, base, spans) for every row of ``docs``; ``spans`` adds the random tokens."""
    found = stored(scanned(docs), "secret-spans")
    places = found.filter(F.size("tokens") > 0).select("doc_id", "tag", F.explode("tokens").alias("t")).select("doc_id", "tag", "t", F.col("t.value").alias("token"))
    added = places.distinct().join(secrets(found, fdr), "token").groupBy("doc_id", "tag").agg(F.collect_list("t").alias("added"))
    every = "if(added is null, base, array_sort(concat(base, added)))"
    return found.select("doc_id", "tag", "base").join(added, ["doc_id", "tag"], "left").select("doc_id", "tag", "base", F.expr(every).alias("spans"))


def redact(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``docs`` with every secret in the texts replaced by <SECRET>."""
    return with_replaced(docs, find(docs.select("doc_id", "text"), fdr), "'<SECRET>'")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secrets and all spans of every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return find(docs).select(
        "doc_id", *(count_of("base", k).alias(f"n_{k}") for k in KINDS),
        sha256_hex(F.expr(listed("base"))).alias("base_sha256"), F.expr(listed("spans")).alias("spans"))
