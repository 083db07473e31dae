"""Benchmark decontamination by a prefix-filtered set join of word shingles.

An item's windows are its runs of ``window`` consecutive words (an item of fewer words is one
window).  A window occurs in a document only if all of its shingles (two words each) do, so
one shingle is a sufficient prefix at a containment of one:

1. The shingles of the benchmark are counted over all documents.
2. Each window is filed under its rarest shingle (the first of equally rare ones) with the
   shingle's place in the window.
3. Each occurrence of a filed shingle in a document names the windows filed there; the
   place gives the only possible start (positional bound), the window must end inside the
   document (length bound), and all its words are compared (verification).

The benchmark is the query set: it is matched in blocks of at most ``block_bytes`` of text,
so what is sent to the tasks is bounded, and the documents are shuffled nowhere.  Work per
document is linear in its words and the occurrences of filed shingles.

Defined results: a null or wordless text has no words and no hits; an item without words
matches nothing; equal items each count; repeated documents are judged each; empty tables
give no rows or no hits; other columns pass through or are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import annotate, sha256_hex, sliced, stored, table, text_of, utf8

WINDOW = 10
BLOCK_BYTES = 16 << 20
#: ASCII other than letters and digits separates words; A-Z become lower case; other bytes stay.
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Windows:
    """The windows of one block of items over a vocabulary of numbered words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[at:at + window]), set()).add(item)
        self.windows = [(np.array(w, np.int64), sorted(i)) for w, i in found.items()]
        self.keys = np.unique(np.concatenate([self.shingles(w) for w, _ in self.windows] or [np.zeros(0, np.int64)]))

    def shingles(self, ids: np.ndarray) -> np.ndarray:
        """The number of the two-word shingle that starts at each place; a one-word window's
        only shingle is its word."""
        if len(ids) == 1:
            return -2 - ids
        return ids[:-1] * len(self.vocabulary) + ids[1:]

    def number(self, text: bytes) -> np.ndarray:
        words, get = words_of(text), self.vocabulary.get
        return np.array([get(w, -1) for w in words], np.int64) if words else np.zeros(0, np.int64)

    def met(self, ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of ``ids`` where a shingle of the sorted ``keys`` starts, and its index there."""
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.flatnonzero(ids >= 0)
        pairs = known[:-1][known[1:] == known[:-1] + 1]
        places, found = [pairs], [ids[pairs] * len(self.vocabulary) + ids[pairs + 1]]
        if keys[0] < 0:  # some windows have one word
            places, found = [*places, known], [*found, -2 - ids[known]]
        place, key = np.concatenate(places), np.concatenate(found)
        index = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[index] == key
        return place[hit], index[hit]

    def file(self, counts: dict[int, int]) -> None:
        """File each window under its rarest shingle."""
        filed: dict[int, list[tuple[int, int]]] = {}
        for n, (ids, _) in enumerate(self.windows):
            keys = self.shingles(ids).tolist()
            rare = min(range(len(keys)), key=lambda at: (counts.get(keys[at], 0), at))
            filed.setdefault(keys[rare], []).append((n, rare))
        self.prefixes = np.array(sorted(filed), np.int64)
        self.filed = [filed[k] for k in self.prefixes.tolist()]

    def occurrences(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], list[str]]:
        """Spans of words (start, end) covered by windows that occur, merged, and their items."""
        place, index = self.met(ids, self.prefixes)
        if not len(place):
            return [], []
        edge, items = np.zeros(len(ids) + 1, np.int64), set()
        for k in np.unique(index).tolist():
            at = place[index == k]
            for n, offset in self.filed[k]:
                window, owners = self.windows[n]
                start = at - offset
                start = start[(start >= 0) & (start + len(window) <= len(ids))]
                start = start[(ids[start[:, None] + np.arange(len(window))] == window).all(axis=1)]
                if len(start):
                    items.update(owners)
                    edge[start] += 1
                    edge[start + len(window)] -= 1
        cover = np.diff(np.concatenate([[0], np.cumsum(edge) > 0]).astype(np.int8))
        return list(zip(np.flatnonzero(cover == 1).tolist(), np.flatnonzero(cover == -1).tolist())), sorted(items)


def _counts(docs: DataFrame, block: Windows) -> dict[int, int]:
    """How often each shingle of the block occurs in all documents (a row per shingle at most)."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(len(block.keys), np.int64)
        for b in sliced(batches):
            for text in utf8(b.column(0)):
                _, index = block.met(block.number(text), block.keys)
                if len(index):
                    total += np.bincount(index, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(block.keys[some]), pa.array(total[some])], names=["key", "n"])

    rows = docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    return {r["key"]: r["n"] for r in rows}


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with _n_words, _spans (covered word spans: start, end) and _items (their item ids)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text_of().alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_blocks = size // block_bytes + 1
    out = docs
    for k in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == k).collect()  # about block_bytes
        block = Windows(sorted((r["item"], r["text"].encode()) for r in part), window)
        block.file(_counts(docs, block))

        def compute(texts, block=block):
            numbered = [block.number(t) for t in texts]
            found = [block.occurrences(ids) for ids in numbered]
            return [[len(ids) for ids in numbered], [[{"start": s, "end": e} for s, e in f[0]] for f in found], [f[1] for f in found]]

        out = annotate(out, compute, "_n_words_k long, _spans_k array<struct<start: long, end: long>>, _items_k array<string>")
        mine = {c: F.col(f"{c}_k") if k == 0 else F.concat(c, f"{c}_k") for c in ("_spans", "_items")}
        out = out.select(*docs.columns, F.col("_n_words_k").alias("_n_words"), *(v.alias(c) for c, v in mine.items()))
        if k + 1 < n_blocks:
            out = stored(out, "decontaminate")
    return out


def _covered() -> F.Column:
    """Words in the union of the spans."""
    return F.expr("""aggregate(array_sort(_spans), struct(0L as end, 0L as n),
        (a, s) -> struct(greatest(a.end, s.end) as end, a.n + greatest(0L, s.end - greatest(s.start, a.end)) as n), a -> a.n)""")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of a benchmark item occurs."""
    plain = docs.toDF(*("text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)))  # no clash with the spans
    return matches(plain, benchmark, window).filter(F.size("_spans") == 0).select(*plain.columns).toDF(*docs.columns)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words hit by benchmark windows, and the items, for every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = F.array_sort(F.array_distinct("_items"))
    return matches(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", F.col("_n_words").alias("n_words"), _covered().alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        sha256_hex(F.array_join(items, ",")).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"))
