"""Sharding by minimax contiguous partition.

Documents with equal texts form one atomic group.  Groups are ordered by a 64-bit hash of
the text and gathered, in that order, into at most 2**SLICE_BITS slices; a slice is never
split, so neither is a group.  The smallest shard capacity for which the ordered slice
sizes fit into the wanted number of contiguous shards is found by binary search, each
capacity checked greedily, and the shards are cut there; where one huge group fixes the
capacity, the other cuts stay as even as that capacity allows.

Only the slice sizes come to the driver: at most 2**SLICE_BITS pairs of numbers, whatever
the size of the corpus.  The cuts return as an array literal, so assigning a shard is an
expression on each row.  Places within a shard come from one range sort on narrow rows
whose last key is the document id, so a group of copies spreads over many tasks.

Defined results: a null text has size 16, crc32 of the empty text, and shares the group of
the empty text; repeated rows are kept and get places of their own; an empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table, text_of

SLICE_BITS = 16
N_SHARDS = 40
ROW_OVERHEAD = 16


def smallest_capacity(sizes: list[int], n_shards: int) -> int:
    """The least capacity at which ``sizes``, in order, fit into ``n_shards`` contiguous runs."""
    ends = list(accumulate(sizes))

    def fits(capacity: int) -> bool:
        start = 0
        for _ in range(n_shards):
            start = bisect_right(ends, (ends[start - 1] if start else 0) + capacity)
            if start >= len(ends):
                return True
        return False

    low, high = (max(max(sizes), -(-ends[-1] // n_shards)), ends[-1]) if sizes else (0, 0)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def cut_points(sizes: list[int], n_shards: int) -> list[int]:
    """Indices at which the runs after the first start.  No run exceeds the least capacity; among
    the cuts that allow this, each is the nearest to an equal share of what is left."""
    if not sizes:
        return []
    capacity, ends = smallest_capacity(sizes, n_shards), [0, *accumulate(sizes)]
    earliest = [len(sizes)]  # from the back: the first start from which the last k runs can hold the rest
    for _ in range(n_shards - 1):
        earliest.append(bisect_left(ends, ends[earliest[-1]] - capacity))
    cuts, at = [], 0
    for left in range(n_shards, 1, -1):
        low, high = max(at, earliest[left - 1]), bisect_right(ends, ends[at] + capacity) - 1
        share = ends[at] + (ends[-1] - ends[at]) / left
        near = bisect_left(ends, share)
        near -= near > 0 and share - ends[near - 1] < ends[min(near, len(sizes))] - share
        at = min(max(near, low), high)
        cuts.append(at)
    return cuts


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, slice_bits: int = SLICE_BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs``."""
    spark = docs.sparkSession
    text = text_of()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group_hash"),
    ).withColumn("slice", F.shiftrightunsigned("group_hash", 64 - slice_bits))
    # stored: the narrow rows feed both the size counts and the sort, and texts are read once
    rows = stored(rows, "shard-rows")
    sizes = rows.groupBy("slice").agg(F.sum("size").alias("size")).collect()  # at most 2**slice_bits rows
    sizes = sorted((r["slice"], r["size"]) for r in sizes)
    cuts = cut_points([size for _, size in sizes], n_shards)
    # a cut behind the last slice leaves the shards after it empty
    starts = [sizes[i][0] if i < len(sizes) else 1 << slice_bits for i in cuts]
    bounds = F.array(*[F.lit(s).cast("long") for s in starts]) if starts else F.array().cast("array<long>")
    shard = F.size(F.filter(bounds, lambda b: b <= F.col("slice")))
    # the hash without its last bit, as a number that is never negative: slices and shards rise with it
    placed = rows.withColumn("order", F.shiftrightunsigned("group_hash", 1))
    placed = placed.repartitionByRange("order", "doc_id").sortWithinPartitions("order", "group_hash", "doc_id")
    placed = placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), F.monotonically_increasing_id().alias("at"))
    placed = stored(placed, "shard-places").select(
        "*", F.shiftright("at", 33).alias("task"), F.col("at").bitwiseAND((1 << 33) - 1).alias("row"))
    # one row for each task of the sort and shard that it met
    parts = placed.groupBy("shard", "task").agg(F.count("*").alias("n"), F.min("row").alias("first_row"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_row")).alias("offset"))
    return placed.join(parts, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
        (F.col("row") + F.col("offset")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"))
