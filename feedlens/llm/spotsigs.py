"""Document fingerprints from spot signatures (SpotSigs), in DataFrame operations.

A spot is a common word directly before a content word; its signature is the hash of the
anchor and the chain of the next ``CHAIN`` content words, common words skipped.  The set of a
document's signatures is its fingerprint; the fingerprint string names the set's length
partition, its size and its digest.  Two sets are compared by Jaccard likeness.  Sizes n < m
bound it by n / m, so with a least likeness t only sets of the same or neighbouring length
partitions, floor(log n / log(1/t)), are intersected; others are pruned to 0.

A text without spots takes the chains of all its content words, one without content words its
words, one without words its whole text, so that only equal texts of that kind are alike.

For each document and its successor by id, documents are dealt into blocks of consecutive ids
(one shuffle of the texts, the only one).  The first document of each block also goes as a
guest to the block before, and the least of all to the last block, so every successor is in
the block and one window finds it.  The list of blocks has at most ``BLOCKS`` rows; it is the
only thing that one task orders, or that is broadcast.

Defined results: a null text counts as empty; two empty sets are alike 1, an empty and another
0; a single document is its own successor; documents of one id follow each other by the hash
of their text; null ids come first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, sha256_hex, table, text_of

CHAIN = 3
PARTITION_LIKENESS = 0.8
BLOCK_ROWS = 512
BLOCKS = 1 << 16
# Common words of four languages: the anchors.
COMMON_WORDS = """
a about after all also an and any are as at be because been but by can could did do for from had has have he her his how i if in into is it its
just like more most my no not of on one only or other our out she so some such than that the their them then there these they this to up was we
were what when which who will with would you your
aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer er es für hat haben ich ihr im ist
ja kann man mit nach nicht noch nur oder schon sein sich sie sind so über um und uns vom von vor war was wenn wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui ma mais me même mes moi mon ne nos notre nous on ou
par pas pour qu que qui sa se ses son sont sur ta te tu un une vos votre vous
al como con del el ella ellos era es esta este ha hay la las lo los más mi muy o otro para pero por se ser si sin sobre su sus también tan te tiene
todo un una uno y ya
""".split()


def signatures(text: str) -> str:
    """SQL for the set of spot signatures of ``text``, an array<bigint>."""
    common = ", ".join(f"'{w}'" for w in sorted(set(COMMON_WORDS)))
    chain = ", ".join(f"get(co, i + {k}).w" for k in range(1, CHAIN))
    spots = f"filter(transform(co, (p, i) -> if(p.a = '', cast(null as bigint), xxhash64(p.a, p.w, {chain}))), x -> x is not null)"
    chains = f"transform(co, (p, i) -> xxhash64('', p.w, {chain}))"
    marked = f"transform(wo, (w, i) -> struct(if(i > 0 and wo[i - 1] in ({common}), wo[i - 1], '') as a, w as w))"
    content = f"filter({marked}, p -> not (p.w in ({common})))"
    rest = f"if(size(wo) > 0, array(xxhash64(array_join(wo, ' '))), if({text} = '', cast(array() as array<bigint>), array(xxhash64({text}))))"
    chosen = let("sp", spots, f"if(size(sp) > 0, sp, if(size(co) > 0, {chains}, {rest}))")
    words = f"filter(split(lower({text}), r'[^\\p{{L}}\\p{{N}}]+'), w -> w <> '')"
    return "array_distinct(" + let("wo", words, let("co", content, chosen)) + ")"


def fingerprint(sigs: str) -> Column:
    """length partition . size . digest of the set."""
    step = f"ln({1 / PARTITION_LIKENESS})"
    return F.expr(f"concat(cast(if(size({sigs}) = 0, 0, floor(ln(size({sigs})) / {step})) as string), '.', cast(size({sigs}) as string),"
                  f" '.', md5(array_join(array_sort({sigs}), ',')))")


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 without intersecting them where their sizes rule out ``least``."""
    n, m = f"least(size({a}), size({b}))", f"greatest(size({a}), size({b}))"
    shared = let("sh", f"size(array_intersect({a}, {b}))", f"cast(sh as double) / (size({a}) + size({b}) - sh)")
    return F.expr(f"if({m} = 0, 1.0D, if({n} = 0 or {n} < {least}D * {m}, 0.0D, {shared}))")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, signatures) of every document."""
    rows = docs.select("doc_id", text_of().alias("text")).select("doc_id", F.expr(signatures("text")).alias("signatures"))
    return rows.select("doc_id", fingerprint("signatures").alias("fingerprint"), "signatures")


def compare(pairs: DataFrame, a: str, b: str, least: float = PARTITION_LIKENESS) -> DataFrame:
    """``pairs`` with ``likeness``: that of the texts in columns ``a`` and ``b``, pruned below ``least``."""
    sides = pairs.select("*", F.expr(signatures(f"coalesce({a}, '')")).alias("sigs_a"), F.expr(signatures(f"coalesce({b}, '')")).alias("sigs_b"))
    return sides.select(*pairs.columns, likeness("sigs_a", "sigs_b", least).alias("likeness"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): each document beside its successor by id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    edge = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = edge["low"] or 0, edge["high"] or 0
    blocks = min(BLOCKS, -(-max(edge["n"], 1) // BLOCK_ROWS))
    width = -(-(high - low + 1) // blocks)
    block = F.coalesce(F.expr(f"(doc_id - {low}L) div {width}L"), F.lit(-1).cast("long"))
    firsts = docs.groupBy(block.alias("own")).agg(F.min("doc_id").alias("first_id"))
    order = Window.orderBy("own")  # at most BLOCKS + 1 rows
    last = F.max("own").over(Window.partitionBy(F.lit(1)))
    guests = firsts.select(F.col("first_id"), F.coalesce(F.lag("own").over(order), last).alias("host"))
    rows = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
    places = F.array(F.struct(block.alias("block"), F.lit(False).alias("guest")), F.struct(F.col("host").alias("block"), F.lit(True).alias("guest")))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("tag"), F.explode(places).alias("p")).filter("p.block is not null")
    rows = rows.select("doc_id", "text", "tag", "p.block", "p.guest").repartition("block")
    rows = rows.withColumn("sigs", F.expr(signatures("text")))
    after = Window.partitionBy("block").orderBy("guest", "doc_id", "tag")
    return rows.select("doc_id", "text", "sigs", "guest", F.lead("text").over(after).alias("next_text"),
                       F.lead("sigs").over(after).alias("next_sigs")).filter("not guest").drop("guest")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = with_next(table(spark, sf_dir, "documents")).withColumn("n_chars", F.length("text").cast("long"))
    edited = "concat(substring(text, 1, int(n_chars - n_chars div 4)), substring(next_text, 1, int(n_chars div 4)))"
    rows = rows.withColumn("edited", F.expr(edited)).withColumn("edited_sigs", F.expr(signatures("edited")))
    return rows.select(
        "doc_id", "n_chars", sha256_hex(F.col("edited")).alias("edited_sha256"), fingerprint("sigs").alias("fingerprint"),
        fingerprint("edited_sigs").alias("edited_fingerprint"), likeness("sigs", "edited_sigs").alias("near_edited"),
        likeness("sigs", "next_sigs").alias("near_next"))
