"""PII by information-theoretic sanitisation, in DataFrame operations.

Base entities (emails, ip addresses, payment cards, phone numbers) are found by pattern and
check sum.  Sanitising them alone leaves terms in the text that give them away.  Over the
whole corpus, each distinct text counted once,

    disclosure(term; entity) = PMI(term; entity) / IC(entity)
                             = log2(N n(e,t) / (n(e) n(t))) / log2(N / n(e)),

the share of the entity's information that the term reveals.  A term is a word (letters and
combining marks, no digit beside them) of any length, and a text holds it wherever it stands.
It is disclosing from ``threshold`` on, if ``support`` distinct texts or more hold it together
with the entity.  Each of its places in each document that holds both is then a span:
generalised to its class, or removed from ``remove_at`` on.

Texts are scanned for the entities and the words of the texts that hold one, and for how many
distinct texts hold each term.  Counts are combined before each shuffle: an entity or term that
is everywhere is one row per task, and only the words of texts that occur more than once are
told apart by their text.  Documents meet by narrow rows of words and spans; texts are shuffled at
most once, where the tags of repeated texts are too many to broadcast.

Defined results: a null text counts as empty; repeated rows give the same spans each; a text
without base entities is left as it is; an empty table gives no rows; other columns are not
read (``find``) or pass through (``sanitise``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sha256_hex, stored, table, text_of
from .spans import count_of, listed, matches, with_replaced

THRESHOLD = 0.8
REMOVE_AT = 0.95
SUPPORT = 3
KINDS = ("email", "ip", "card", "phone")

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DIGITS = "regexp_replace(s.value, '[^0-9]', '')"
_LUHN = (f"element_at(transform(array({_DIGITS}), d -> length(d) between 14 and 19 and aggregate(sequence(1, length(d)), 0, (a, i) -> a +"
         " if(i % 2 = 1, 1, 2) * int(substring(d, -i, 1)) - if(i % 2 = 0 and int(substring(d, -i, 1)) > 4, 9, 0)) % 10 = 0), 1)")


def base_spans() -> str:
    """SQL for the sorted base spans of ``text``."""
    digit = "text rlike '[0-9]'"
    kinds = [
        matches("email", 0, r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
        matches("ip", 1, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", digit, f"s.value rlike '^{_OCTET}(?:[.]{_OCTET}){{3}}$'"),
        matches("card", 2, r"[0-9](?:[\x20-]?[0-9])++", digit, _LUHN),
        matches("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')", f"length({_DIGITS}) between 10 and 15"),
    ]
    return f"array_sort(concat({', '.join(kinds)}))"


_WORD = r"(?<![\p{L}\p{M}\p{N}])[\p{L}\p{M}]++(?![\p{L}\p{M}\p{N}])"
_ENTITIES = "array_distinct(transform(base, b -> concat(b.kind, ':', lower(b.value))))"


def entities(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, base, words) for every row: its base spans and, if there are any, all words of the text with their places."""
    rows = docs.select("doc_id", text_of().alias("text")).select("doc_id", "text", F.xxhash64("text").alias("tag"))
    rows = rows.select("doc_id", "tag", "text", F.expr(base_spans()).alias("base"))
    words = f"transform({matches('term', len(KINDS), _WORD, 'size(base) > 0')}, t -> struct(lower(t.value) as term, t.start as start, t.end as end))"
    return rows.select("doc_id", "tag", "base", F.expr(words).alias("words"))


def _held(found: DataFrame) -> DataFrame:
    """(tag, entity): which distinct texts hold an entity."""
    return found.select("tag", F.explode(F.expr(_ENTITIES)).alias("entity")).distinct()


def _worded(found: DataFrame) -> DataFrame:
    """(tag, term) of the texts with an entity, repeated for repeated texts."""
    return found.select("tag", F.explode(F.expr("array_distinct(transform(words, w -> w.term))")).alias("term"))


def disclosures(docs: DataFrame, found: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """(entity, term, disclosure) of the disclosing pairs in the corpus."""
    n = F.broadcast(found.agg(F.countDistinct("tag").alias("n")))  # one row
    n_e = _held(found).groupBy("entity").agg(F.count("*").alias("n_e")).join(n).filter((F.col("n_e") >= support) & (F.col("n") > F.col("n_e")))
    # a pair reaches the threshold only if its term is in at most n_et * (N / n_e)**(1 - threshold)
    # texts, where n_et is at most n_e; in texts with an entity alone, common words are in more,
    # and are not paired with the entity
    slack = F.pow(F.col("n") / F.col("n_e"), F.lit(1 - threshold)) * (1 + 1e-9)
    held = stored(_held(found).join(n_e.withColumn("slack", slack), "entity"), "pii-held")
    most = F.broadcast(held.agg(F.max(F.col("n_e") * F.col("slack")).alias("most")))  # one row
    beside = _worded(found).distinct().groupBy("term").agg(F.count("*").alias("n_beside")).filter(F.col("n_beside") >= support)
    beside = stored(beside.join(most).filter(F.col("n_beside") <= F.col("most")).drop("most"), "pii-beside")
    told = found.join(held.select("tag").distinct(), "tag", "left_semi")
    met = _worded(told).join(beside, "term").distinct().join(held, "tag").filter(F.col("n_beside") <= F.col("n_e") * F.col("slack"))
    pairs = met.groupBy("entity", "term").agg(F.count("*").alias("n_et"), *(F.max(c).alias(c) for c in ("n_e", "n", "n_beside", "slack")))
    pairs = pairs.filter((F.col("n_et") >= support) & (F.col("n_beside") <= F.col("n_et") * F.col("slack")))
    pairs = stored(pairs.drop("n_beside", "slack"), "pii-pairs")
    # how many distinct texts hold each term: what occurs once is counted in its task, and only repeated
    # texts need their tags beside the terms
    texts = docs.select(text_of().alias("text")).select(F.xxhash64("text").alias("tag"), "text")
    again = texts.groupBy("tag").agg(F.count("*").alias("c")).filter("c > 1").select("tag", F.col("tag").alias("again"))
    again = stored(again, "pii-again")  # its size is known when the join is planned
    lowered = F.expr(f"array_distinct(transform(regexp_extract_all(text, r'{_WORD}', 0), w -> lower(w)))")
    words = texts.join(again, "tag", "left").select("again", F.explode(lowered).alias("term"))
    counts = words.groupBy("again", "term").agg(F.count("*").alias("c"))
    n_t = counts.groupBy("term").agg(F.sum(F.when(F.col("again").isNull(), F.col("c")).otherwise(1)).alias("n_t"))
    share = F.log2(F.col("n") * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / F.log2(F.col("n") / F.col("n_e"))
    return pairs.join(n_t, "term").select("entity", "term", share.alias("disclosure")).filter(F.col("disclosure") >= threshold)


def find(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT, remove_at: float = REMOVE_AT) -> DataFrame:
    """(doc_id, tag, base, spans) for every row of ``docs``; ``spans`` adds the disclosing terms (kind
    term, or gone for those to remove) that overlap no base span."""
    found = stored(entities(docs), "pii-entities")
    told = stored(disclosures(docs, found, threshold, support), "pii-told")
    # by terms first: an entity that is everywhere does not meet all its terms in every text
    marks = _worded(found).join(told, "term").distinct().join(_held(found), ["tag", "entity"])
    marks = stored(marks.groupBy("tag", "term").agg(F.max("disclosure").alias("disclosure")), "pii-marks")
    places = found.select("doc_id", "tag", F.explode("words").alias("w")).select("doc_id", "tag", "w.*")
    kind = F.when(F.col("disclosure") >= remove_at, "gone").otherwise("term")
    added = places.join(marks, ["tag", "term"]).distinct().groupBy("doc_id", "tag").agg(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("rank"), "end", kind.alias("kind"), F.col("term").alias("value"))).alias("added"))
    added = added.select(F.col("doc_id").alias("added_id"), F.col("tag").alias("added_tag"), "added")
    same = F.col("doc_id").eqNullSafe(F.col("added_id")) & (F.col("tag") == F.col("added_tag"))
    free = "filter(added, a -> not exists(base, b -> b.start < a.end and a.start < b.end))"
    every = f"if(added is null, base, array_sort(concat(base, {free})))"
    return found.drop("words").join(added, same, "left").select("doc_id", "tag", "base", F.expr(every).alias("spans"))


def sanitise(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT, remove_at: float = REMOVE_AT) -> DataFrame:
    """``docs`` with every base entity replaced by its class, as <EMAIL>, and every disclosing term
    generalised (<TERM>) or removed; ``n_chars``, if there, follows the new text."""
    label = "if(s.kind = 'gone', '', concat('<', upper(s.kind), '>'))"
    return with_replaced(docs, find(docs.select("doc_id", "text"), threshold, support, remove_at), label)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base personal data and all spans of every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = find(docs)
    return rows.select(
        "doc_id", *(count_of("base", k).alias(f"n_{k}") for k in KINDS),
        sha256_hex(F.expr(listed("base"))).alias("base_sha256"), F.expr(listed("spans")).alias("spans"))
