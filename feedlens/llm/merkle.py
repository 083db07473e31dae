"""Merkle manifest of a dataset: stored checkpoints, and proofs that recompute what lies between.

Every row is a leaf.  The leaves of a source ascend by id; every ``ARITY`` consecutive nodes (the
last run may be shorter) become their digest, until one is left: the source's subroot.  The subroots,
ordered by source, give the root likewise.

Only every ``STRIDE``-th level is stored, as one row for each aligned subtree: the nodes under
one node of the next stored level, at most ``ARITY ** STRIDE``.  Proofs go from the root down.  At
each stored level the subtree's missing interior nodes are regenerated from its stored
descendants, the siblings on each node's way up are emitted, and the interior is discarded.

Texts are read once, into narrow rows of digests.  Places in a source come from one range
sort whose keys include the id, so a source with a third of all rows spreads over many tasks
(repeated rows too, by a number of their own); subtrees are groups of bounded size, and
stored levels meet by (source, subtree), which no two rows share.  The driver learns the root and
the number of levels.

Defined results: a null field counts as ``-``, a null source is a source of its own and comes first, a
null id comes first in its source; rows with equal ids are ordered by their leaves, equal rows have
equal leaves and a place each; very long texts only pass through the digest; an empty table has no
root and no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, drop_stored, stored, table

ARITY = 16
STRIDE = 2
SUBTREE = ARITY ** STRIDE
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree string, block long, n long, nodes array<struct<at: long, digest: string, id: long, claim: string>>"
STEPS = "array<struct<before: string, after: string>>"


def leaf_of(*fields: Column) -> Column:
    """The digest of a row: every field as its UTF-8 size, a colon and its value, or ``-`` for null."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]), 256)


def indexed(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (tree, and columns to order by) with ``at``, the place within the tree, and ``n``, the tree's size."""
    order = [c for c in rows.columns if c != "tree"]
    rows = stored(rows.withColumn("same", F.monotonically_increasing_id()), f"{name}-rows")
    placed = rows.repartitionByRange("tree", *order, "same").sortWithinPartitions("tree", *order, "same")
    placed = stored(placed.drop("same").withColumn("at", F.monotonically_increasing_id()), f"{name}-places")
    drop_stored(rows)
    placed = placed.withColumn("task", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    # one row for each task of the sort and tree that it met
    parts = placed.groupBy("tree", "task").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    before = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "task", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("c").over(Window.partitionBy("tree")).alias("n"))
    return placed.join(parts, ["tree", "task"]).withColumn("at", F.col("at") + F.col("shift")).drop("task", "shift")


def subtrees(nodes: DataFrame) -> DataFrame:
    """Rows of nodes (tree, at, n, digest, id, claim) as one row for each aligned subtree."""
    one = F.struct("at", "digest", "id", "claim")
    block = F.floor(F.col("at") / SUBTREE).cast("long").alias("block")
    return nodes.groupBy("tree", block, "n").agg(F.sort_array(F.collect_list(one)).alias("nodes")).select("tree", "block", "n", "nodes")


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def regenerated(digests: list[str], n: int) -> list[list[str]]:
    """The levels of one subtree from its stored nodes up, in a level of ``n`` nodes: its last one is a single node."""
    levels = [digests]
    while n > 1 and len(levels) <= STRIDE:
        below = levels[-1]
        levels.append([h("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
        n = -(-n // ARITY)
    return levels


def way_up(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """The siblings before and after node ``i`` and its ancestors below the subtree's top."""
    steps = []
    for level in levels[:-1]:
        start = i - i % ARITY
        steps.append(("".join(level[start:i]), "".join(level[i + 1:start + ARITY])))
        i //= ARITY
    return steps


def folded(digest: str, steps: list[tuple[str, str]]) -> str:
    """The root that a digest and its siblings lead to."""
    for before, after in steps:
        digest = h(before + digest + after)
    return digest


def _rows(batches):
    for b in batches:
        for i in range(0, b.num_rows, 16):
            yield from b.slice(i, 16).to_pylist()


def _made(rows, schema: pa.Schema, size: int):
    """Record batches of ``size`` rows of the generated dicts."""
    waiting = []
    for r in rows:
        waiting.append(r)
        if len(waiting) >= size:
            yield pa.RecordBatch.from_pylist(waiting, schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(ddl))


TOPS = "tree string, at long, n long, digest string"


def tops(blocks: DataFrame) -> DataFrame:
    """The nodes of the next stored level: each subtree's top, as (tree, at, n, digest)."""
    schema = _arrow(TOPS)

    def run(batches):
        made = ({"tree": r["tree"], "at": r["block"], "n": -(-r["n"] // SUBTREE),
                 "digest": regenerated([x["digest"] for x in r["nodes"]], r["n"])[-1][0]} for r in _rows(batches))
        yield from _made(made, schema, 1024)

    bounded_batches(blocks.sparkSession)
    return blocks.mapInArrow(run, TOPS)


@dataclass
class Tree:
    """The stored levels of one or many trees, from the leaves up, and (tree, digest) of their roots."""
    levels: list[DataFrame]
    roots: DataFrame


def grow(leaves: DataFrame, name: str) -> Tree:
    """Trees over ``leaves`` (tree, id, digest, claim), each ordered by id, then digest."""
    nodes, levels = indexed(leaves, name), []
    while True:
        levels.append(stored(subtrees(nodes), f"{name}-level{len(levels)}"))
        nodes = stored(tops(levels[-1]), f"{name}-tops{len(levels)}")
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return Tree(levels, nodes.select("tree", "digest"))
        nodes = nodes.withColumn("id", F.lit(None).cast("long")).withColumn("claim", F.lit(None).cast("string"))


def _met(blocks: DataFrame, held: DataFrame) -> DataFrame:
    above = held.select(F.col("tree").alias("above_tree"), F.col("at").alias("above_at"), "subroot", "steps")
    return blocks.join(above, (F.col("tree") == F.col("above_tree")) & (F.col("block") == F.col("above_at"))).select(blocks.columns + ["subroot", "steps"])


HELD = f"tree string, at long, subroot string, steps {STEPS}, id long, digest string, claim string"


def _descend(levels: list[DataFrame], held: DataFrame) -> DataFrame:
    """Proofs (``HELD``) of the nodes of the lowest of ``levels``, given those of the tops of the highest."""
    schema = _arrow(HELD)

    def run(batches):
        def made():
            for r in _rows(batches):
                levels = regenerated([x["digest"] for x in r["nodes"]], r["n"])
                for i, x in enumerate(r["nodes"]):
                    steps = [{"before": a, "after": b} for a, b in way_up(levels, i)] + r["steps"]
                    yield {"tree": r["tree"], "at": x["at"], "subroot": r["subroot"], "steps": steps, "id": x["id"], "digest": x["digest"], "claim": x["claim"]}
        yield from _made(made(), schema, 256)

    bounded_batches(held.sparkSession)
    for blocks in reversed(levels):
        held = _met(blocks, held).mapInArrow(run, HELD)
    return held


@dataclass
class Manifest:
    """A dataset's digests: the trees of its sources, the tree of their subroots, and the root (None without rows)."""
    rows: Tree
    sources: Tree
    root: str | None

    def source_proofs(self) -> DataFrame:
        """(tree, at, subroot, steps): for each source its subroot's way to the root, to go down from."""
        top = self.sources.roots.select("tree", F.lit(0).cast("long").alias("at"), F.lit(None).cast("string").alias("subroot"), F.lit([]).cast(STEPS).alias("steps"))
        below = _descend(self.sources.levels, top)
        return below.select(F.col("claim").alias("tree"), F.lit(0).cast("long").alias("at"), F.col("digest").alias("subroot"), "steps")

    def proofs(self) -> DataFrame:
        """(doc_id, source, leaf, subroot, root, steps) of every row; ``steps`` are the siblings before and
        after each node on the way up."""
        held = _descend(self.rows.levels, self.source_proofs())
        return held.select(F.col("id").alias("doc_id"), source_of("tree").alias("source"), F.col("digest").alias("leaf"), "subroot",
                           F.lit(self.root).alias("root"), "steps")

    def checked(self) -> DataFrame:
        """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: the digest of
        its siblings, the root that its claim and these lead to, and whether that is the root."""
        upper = _descend(self.rows.levels[1:], self.source_proofs())
        ddl = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        schema, root = _arrow(ddl), self.root

        def run(batches):
            def made():
                for r in _rows(batches):
                    levels = regenerated([x["digest"] for x in r["nodes"]], r["n"])
                    above = [(s["before"], s["after"]) for s in r["steps"]]
                    siblings_above = "".join([a + b for a, b in above])
                    for i, x in enumerate(r["nodes"]):
                        steps = way_up(levels, i)
                        reached = folded(x["claim"], steps + above)
                        yield {"doc_id": x["id"], "leaf": x["digest"], "subroot": r["subroot"], "root": root,
                               "proof_sha256": h("".join([a + b for a, b in steps]) + siblings_above), "folded_root": reached, "verified": reached == root}
            yield from _made(made(), schema, 4096)

        bounded_batches(upper.sparkSession)
        return _met(self.rows.levels[0], upper).mapInArrow(run, ddl)


def tree_of(source: Column) -> Column:
    """A key that orders like the source, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit(""))


def source_of(tree: str) -> Column:
    return F.when(F.col(tree) != "", F.substring(F.col(tree), 2, 2 ** 31 - 1))


def manifest(docs: DataFrame, claimed_text: Column | None = None) -> Manifest:
    """The manifest of ``docs``; ``claimed_text`` is what is later held against the proofs in place of ``text``."""
    claim = leaf_of(*[F.col(c) if c != "text" or claimed_text is None else claimed_text for c in FIELDS])
    leaves = docs.select(tree_of(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("id"),
                         leaf_of(*[F.col(c) for c in FIELDS]).alias("digest"), claim.alias("claim"))
    rows = grow(leaves, "merkle")
    # the source's key travels as the claim of its subroot
    subroots = rows.roots.select(F.lit("").alias("tree"), F.lit(None).cast("long").alias("id"), F.col("tree").alias("claim"), "digest")
    sources = grow(subroots.select("tree", "id", "claim", "digest"), "merkle-sources")
    root = sources.roots.first()
    return Manifest(rows, sources, root and root["digest"])


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof digests of all documents, and what they say of the texts that were tampered with."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest(docs, F.when(picked, lowered).otherwise(F.col("text"))).checked()
