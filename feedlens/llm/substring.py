"""Substring dedup by repeated windows of ``window`` words, in place of a relative Lempel-Ziv parse.

Every document is compared with all documents with smaller ids.  A factor is a maximal run
of its words in which every window of ``window`` words also starts in an earlier document;
factors shorter than a window do not count, and the words of the others are removed.  The
windows are judged on the input, so removing one passage never hides another.

The reference index is sampled, not the answer.  Each window is represented by the least
hash among its phrases of ``phrase`` words, a value that equal windows share and that
neighbouring windows mostly have in common; about one value for 20 words is indexed.

1. One pass gives every document its words' digest and the distinct values of its windows.
2. Documents with the same words as an earlier one are factors as a whole.
3. The index, in blocks by value (shuffle partitions), keeps the values that occur in two
   documents or more.
4. Only windows with such a value can repeat.  Each is compared, also those at the two
   boundaries of a factor, by the 128-bit XXH3 digest of its words with the least document
   that has it; consecutive repeated windows join to factors.

Nothing pairs up the documents that share a passage: a passage costs its windows once for
each document that holds it.  Minima are combined before the shuffle, the joins back may be
split by adaptive execution, and per-document lists are bounded by the document.

Defined results: a null or blank text has no words; a row with a null doc_id is neither
earlier than any other nor removed from; repeated rows of one id are judged alike; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, sha256_hex, sliced, stored, table, text_of, utf8

WINDOW = 50
PHRASE = 10
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next text."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 17), base, np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.cumprod(have)
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a text as one string, with the place of each."""

    def __init__(self, text: bytes):
        words = text.split()
        self.n = len(words)
        self.joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, self.n)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes

    def values(self, window: int, phrase: int) -> np.ndarray:
        """For each window, the least hash of its phrases (a rolling polynomial of their bytes)."""
        if self.n < window:
            return np.zeros(0, np.uint64)
        octets = np.frombuffer(self.joined, np.uint8).astype(np.uint64) + np.uint64(1)
        total = np.zeros(len(octets) + 1, np.uint64)
        np.cumsum(octets * _powers(_INVERSE, len(octets)), out=total[1:])
        starts, ends = self.starts[: self.n - phrase + 1], self.ends[phrase - 1:]
        least = _mix((total[ends] - total[starts]) * _powers(_BASE, len(octets))[starts])
        need, have = window - phrase + 1, 1  # phrases in a window; phrases that ``least`` covers
        while have < need:
            step = min(have, need - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        return least

    def digest(self, at: int, window: int) -> bytes:
        return xxhash.xxh3_128_digest(self.joined[self.starts[at]:self.ends[at + window - 1]])


def _summaries(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(doc_id, tag, n_words, words_sha256, values): the digest of the words joined by one space,
    and the distinct values of the windows."""

    def run(batches):
        for b in sliced(batches):
            n, sha, values = [], [], []
            for text in utf8(b.column(2)):
                words = Words(text)
                n.append(words.n)
                sha.append(hashlib.sha256(words.joined).hexdigest())
                values.append(np.unique(words.values(window, phrase)).view(np.int64))
            made = [pa.array(n, pa.int64()), pa.array(sha), pa.array(values, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], names=["doc_id", "tag", "n_words", "words_sha256", "values"])

    return docs.mapInArrow(run, "doc_id long, tag long, n_words long, words_sha256 string, values array<long>")


def _candidates(held: DataFrame, window: int, phrase: int) -> DataFrame:
    """``held`` (doc_id, tag, text, shared) with its windows of a shared value: start and digest."""

    def run(batches):
        for b in sliced(batches):
            starts, digests = [], []
            for text, shared in zip(utf8(b.column(2)), b.column(3).to_pylist()):
                words = Words(text)
                at = np.flatnonzero(np.isin(words.values(window, phrase).view(np.int64), np.array(shared, np.int64)))
                starts.append(at.astype(np.int32))
                digests.append([words.digest(a, window) for a in at.tolist()])
            made = [pa.array(starts, pa.list_(pa.int32())), pa.array(digests, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *made], names=["doc_id", "tag", "text", "starts", "digests"])

    return held.select("doc_id", "tag", "text", "shared").mapInArrow(
        run, "doc_id long, tag long, text string, starts array<int>, digests array<binary>")


def _removals(repeated: DataFrame, window: int) -> DataFrame:
    """What is left of each text of (doc_id, tag, text, starts) without its repeated windows."""

    def run(batches):
        for b in sliced(batches):
            made = [kept_text(t, s, window) for t, s in zip(utf8(b.column(2)), b.column(3).to_pylist())]
            columns = [pa.array([m[0] for m in made], pa.int64()), pa.array([hashlib.sha256(m[1]).hexdigest() for m in made]),
                       pa.array([[{"start": s, "end": e} for s, e in m[2]] for m in made],
                                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *columns], names=["doc_id", "tag", "removed", "kept", "parts"])

    return repeated.select("doc_id", "tag", "text", "starts").mapInArrow(
        run, "doc_id long, tag long, removed long, kept string, parts array<struct<start: long, end: long>>")


def kept_text(text: bytes, starts: list[int], window: int) -> tuple[int, bytes, list[tuple[int, int]]]:
    """Words removed, the kept words joined by one space, and the factors (start, end in words)."""
    words, factors = text.split(), []
    for s in sorted(set(starts)):
        if factors and s <= factors[-1][1]:
            factors[-1][1] = s + window
        else:
            factors.append([s, s + window])
    kept, at = [], 0
    for s, e in factors:
        kept += words[at:s]
        at = e
    kept += words[at:]
    return len(words) - len(kept), b" ".join(kept), [tuple(f) for f in factors]


def dedup_substrings(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, factors) for every document; factors are the
    removed word spans (start, end)."""
    key = ["doc_id", "tag"]  # ids may be repeated; the tag tells different texts of one id apart
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    every = stored(_summaries(docs, window, phrase), "substring-words")
    able = every.filter(F.col("n_words") >= window)
    first = able.groupBy("words_sha256").agg(F.min("doc_id").alias("first_id"))
    copies = able.select(*key, "words_sha256").join(first, "words_sha256").filter("doc_id > first_id")
    copies = stored(copies.select(*key, F.lit(True).alias("copy")).distinct(), "substring-copies")
    values = stored(able.join(copies, key, "left_anti").select(*key, F.explode("values").alias("value")), "substring-index")
    # stored, like the least documents below: a join of two plain shuffles can be split where a key is hot
    index = stored(values.groupBy("value").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("value"),
                   "substring-shared")
    shared = values.join(index, "value").groupBy(*key).agg(F.collect_set("value").alias("shared"))
    held = stored(_candidates(docs.join(shared, key), window, phrase), "substring-windows")
    windows = held.select(*key, F.explode(F.arrays_zip("starts", "digests")).alias("w")).select(
        *key, F.col("w.starts").alias("start"), F.col("w.digests").alias("digest"))
    least = windows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    least = stored(least.filter("first_id < last_id").select("digest", "first_id"), "substring-least")
    repeated = windows.join(least, "digest").filter("doc_id > first_id").groupBy(*key).agg(F.collect_set("start").alias("starts"))
    removed = _removals(held.select(*key, "text").join(repeated, key), window).dropDuplicates(key)
    whole = F.coalesce("copy", F.lit(False))
    span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return every.drop("values").join(copies, key, "left").join(removed, key, "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, sha256_hex(F.lit(""))).otherwise(F.coalesce("kept", "words_sha256")).alias("kept_sha256"),
        F.when(whole, span).otherwise(F.coalesce("parts", none)).alias("factors"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside passages that an earlier document holds."""
    return dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
