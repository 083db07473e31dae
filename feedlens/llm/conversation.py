"""Conversation structure repair by Hirschberg divide and conquer.

A sound conversation has the role initials ``(s?(ua)+)?``.  Each row of a damaged one is kept,
given another role or deleted, and empty rows may be inserted; the cheapest edits win, of equal
ones those with the ASCII-least initials in order (the audit).

The initials are read by an automaton of four states (nothing, after s, after u, after a).  A row
is a step between states: for each pair of states its least cost and the edits' initials, inserted
rows before it included.  Forward and backward cost vectors over the four states meet in the
middle of a run of rows; the crossing with the least sum, and of these with the audit-least way
there, parts the run, and both halves are solved alike.  Only vectors are held, so space is linear.
Ways of the same number of rows are never prefixes of each other, so a rank per state orders them.

A conversation is dealt out in blocks of ``BLOCK`` rows.  Each block becomes a step of its own (costs
and ranks between all pairs of states); the crossings between blocks come from the same
division over these steps, and the edits within blocks are worked out by tasks of their own.
One task sees a row of 16 numbers for each block of a conversation, and its audit, which the
result holds as one string anyway.  Only the digest of a repaired conversation, which is
sequential by nature, streams the texts of one conversation through one task, in order and
without holding them.

Defined results: null roles and texts count as one space; rows with equal turns are ordered by
role, then by a hash of the text; null turns come first, a null conversation id is a conversation
of its own; equal rows are copies of the first; very long texts pass through as they are; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import bounded_batches, drop_stored, sha256_hex, sliced, stored, table

BLOCK = 1024
STATES = range(4)
#: Where each initial leads: 0 nothing yet, 1 after s, 2 after u, 3 after a.
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ENDS = (0, 3)
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: A row's class is its initial if s, u or a, else ``x``; in upper case if truncated; ``-`` if it must go.


def _inserts(state: int) -> dict[int, int]:
    """The states that inserted rows lead to, with their least number."""
    found, n = {state: 0}, 0
    while True:
        after = next(m[state] for c in "ua" if state in (m := MOVES[c]))
        n += 1
        if after in found:
            return found
        found[after] = n
        state = after


@lru_cache(maxsize=None)
def row_step(kind: str) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """For each pair of states the least (cost, edits) that end with this row."""
    best = [[None] * 4 for _ in STATES]
    for p in STATES:
        for q, n in _inserts(p).items():
            ways = [(DELETE, "D", q)]
            if kind != "-":
                extra, initial = TRUNCATED * kind.isupper(), kind.lower()
                ways += [(extra, "K", MOVES[initial][q])] if q in MOVES.get(initial, ()) else []
                ways += [(extra + RETYPE, "R", MOVES[c][q]) for c in "ua" if q in MOVES[c]]
            for cost, edit, to in ways:
                way = (cost + INSERT * n, "I" * n + edit)
                if best[p][to] is None or way < best[p][to]:
                    best[p][to] = way
    return tuple(map(tuple, best))


#: What follows the last row: the least inserted rows that end soundly.
TAIL = tuple(min(n for q, n in _inserts(p).items() if q in ENDS) for p in STATES)

#: A step: for each pair of states (cost, rank) or None; ranks order the ways from one state.
Step = tuple[tuple[tuple[int, int] | None, ...], ...]


def _ranked(ways: list) -> tuple:
    """(cost, what orders the way) of each state with that replaced by its rank."""
    order = {w[1]: i for i, w in enumerate(sorted((w for w in ways if w), key=lambda w: w[1]))}
    return tuple(w and (w[0], order[w[1]]) for w in ways)


@lru_cache(maxsize=None)
def class_step(kind: str) -> Step:
    return tuple(_ranked(list(ways)) for ways in row_step(kind))


def forward(vector: tuple, steps: Sequence[Step]) -> tuple:
    """(cost, rank) of the audit-least cheapest way to each state."""
    for step in steps:
        ways = [None] * 4
        for p in STATES:
            if vector[p]:
                cost, rank = vector[p]
                for q in STATES:
                    if (s := step[p][q]) is not None:
                        way = (cost + s[0], (rank, s[1]))
                        if ways[q] is None or way < ways[q]:
                            ways[q] = way
        vector = _ranked(ways)
    return vector


def backward(costs: list[int | None], steps: Sequence[Step]) -> list[int | None]:
    """The least cost from each state to the end."""
    for step in reversed(steps):
        costs = [min((s[0] + costs[q] for q, s in enumerate(step[p]) if s is not None and costs[q] is not None), default=None) for p in STATES]
    return costs


def _only(state: int, value) -> list:
    return [value if q == state else None for q in STATES]


def joined(steps: Sequence[Step]) -> Step:
    """Many steps as one."""
    return tuple(forward(tuple(_only(p, (0, 0))), steps) for p in STATES)


def crossings(steps: Sequence[Step], start: int, end: list[int | None]) -> list[int]:
    """The state after each step on the audit-least of the cheapest ways from ``start``, where ``end``
    holds the cost from each state on (None: no way)."""
    if not steps:
        return []
    middle = (len(steps) + 1) // 2
    ahead = forward(tuple(_only(start, (0, 0))), steps[:middle])
    behind = backward(end, steps[middle:])
    state = min((w[0] + behind[q], w[1], q) for q, w in enumerate(ahead) if w and behind[q] is not None)[2]
    left = crossings(steps[:middle], start, _only(state, 0)) if middle > 1 else [state]
    return left + crossings(steps[middle:], state, end)


def least_ends() -> list[int]:
    return [INSERT * n for n in TAIL]


def block_edits(classes: str, enter: int, leave: int) -> tuple[int, list[str], list[int]]:
    """Cost, edits of each row of a block (inserted rows before it included), and the state before each, between two states."""
    states = [enter, *crossings([class_step(c) for c in classes], enter, _only(leave, 0))]
    ways = [row_step(c)[p][q] for c, p, q in zip(classes, states, states[1:])]
    return sum(w[0] for w in ways), [w[1] for w in ways], states[:-1]


def repair(classes: str) -> tuple[int, list[str], int]:
    """(cost, edits of each row, inserted rows at the end) of one conversation, in one go."""
    steps = [class_step(c) for c in classes]
    states = [0, *crossings(steps, 0, least_ends())]
    edits = [row_step(c)[p][q] for c, p, q in zip(classes, states, states[1:])]
    return sum(e[0] for e in edits) + INSERT * TAIL[states[-1]], [e[1] for e in edits], TAIL[states[-1]]


# ---------------------------------------------------------------------------------------- Spark

#: What separates words: space and U+0009 to U+000D.
BLANK = " \t\n\x0b\x0c\r"


def ordered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (conv_id, turn, role, text) with ``at``, a number of their own that orders them within their
    conversation; and without their texts (conv_id, at, block, fault, initial, kind).  Both stored."""
    rows = rows.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = stored(rows.withColumn("same", F.monotonically_increasing_id()), "conv-rows")
    keys = ["conv_id", "turn", "role", F.xxhash64("text"), "same"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("same")
    placed = stored(placed.withColumn("at", F.monotonically_increasing_id()), "conv-places")
    drop_stored(rows)
    firsts = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("at").alias("first")).select("first")
    meant, initial = F.rtrim("text", F.lit(BLANK)), F.substring("role", 1, 1)
    fault = F.when(meant == "", "blank").when(~F.substring(meant, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    # the rows of a block lie beside each other in one task of the sort
    block = F.floor(F.col("at") / BLOCK).cast("long")
    out = placed.select("conv_id", "at", block.alias("block"), fault.alias("fault"), known.alias("initial"))
    # by number: no two rows share one, so a much repeated row makes no hot key
    out = out.join(firsts, F.col("at") == F.col("first"), "left")
    out = out.withColumn("fault", F.when((F.col("fault") != "blank") & F.col("first").isNull(), "duplicate").otherwise(F.col("fault"))).drop("first")
    kind = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return placed, stored(out.withColumn("kind", kind), "conv-kinds")


def blocks_of(rows: DataFrame) -> DataFrame:
    """One row for each block of a conversation: its rows' numbers, classes and initials in order, and counts of faults."""
    parts = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("at", "kind", "initial"))).alias("r"),
        *(F.sum((F.col("fault") == f).cast("long")).alias(f) for f in FAULTS))
    return parts.select("conv_id", "block", *FAULTS, F.col("r.at").alias("ats"), F.array_join("r.kind", "").alias("classes"),
                        F.array_join("r.initial", "").alias("initials"))


FAULTS = ("blank", "duplicate", "truncated")


def _flat(step: Step) -> list[int]:
    return [v for ways in step for w in ways for v in (w or (-1, -1))]


def _step(flat: Sequence[int]) -> Step:
    pairs = [(c, r) if c >= 0 else None for c, r in zip(flat[::2], flat[1::2])]
    return tuple(tuple(pairs[4 * p:4 * p + 4]) for p in STATES)


def _with(df: DataFrame, inputs: list[str], added: str, compute: Callable) -> DataFrame:
    """``df`` with the columns of the DDL string ``added``, worked out from each row's ``inputs``; equal inputs once."""
    new = T.StructType.fromDDL(added)
    schema = T.StructType([*df.schema.fields, *new.fields])
    kinds, names = [to_arrow_type(f.dataType) for f in new.fields], schema.names

    def run(batches):
        known = lru_cache(maxsize=1024)(compute)
        for b in sliced(batches):
            done = [known(*map(_hashable, r)) for r in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in inputs))]
            made = zip(*done) if done else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(made, kinds))], names=names)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def _hashable(value):
    return tuple(map(tuple, value)) if isinstance(value, list) else value


def _measure(classes: str) -> tuple[list[int]]:
    return _flat(joined([class_step(c) for c in classes])),


def _cross(steps: tuple) -> tuple[list[int], int]:
    states = [0, *crossings([_step(f) for f in steps], 0, least_ends())]
    return states, TAIL[states[-1]]


def _edit(classes: str, initials: str, enter: int, leave: int) -> tuple[int, int, list[str], list[int]]:
    illegal = sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
    return illegal, *block_edits(classes, enter, leave)


def solved(rows: DataFrame) -> DataFrame:
    """One row for each block of the rows that ``ordered`` classed: conv_id, block, place (its number in the conversation), ats, initials, counts,
    illegal, cost, edits (for each row), states (before each row) and tail (rows inserted behind the last block); stored."""
    blocks = stored(blocks_of(rows), "conv-blocks")
    steps = _with(blocks.select("conv_id", "block", "classes"), ["classes"], "step array<long>", _measure)
    # a block is one row of 32 numbers here
    convs = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "step"))).alias("b"))
    convs = _with(convs.select("conv_id", F.col("b.block").alias("blocks"), F.col("b.step").alias("steps")), ["steps"], "crossed array<long>, last long", _cross)
    ways = convs.select(F.col("conv_id").alias("c"), "crossed", "last", F.size("blocks").alias("n"), F.posexplode("blocks").alias("place", "b"))
    ways = ways.select("c", "b", "place", F.col("crossed")[F.col("place")].alias("enter"), F.col("crossed")[F.col("place") + 1].alias("leave"),
                       F.when(F.col("place") + 1 == F.col("n"), F.col("last")).otherwise(0).alias("tail"))
    both = blocks.join(ways, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    both = _with(both, ["classes", "initials", "enter", "leave"], "illegal long, cost long, edits array<string>, states array<long>", _edit)
    return stored(both, "conv-edits")


def report(done: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, counts of faults, illegal, cost and audit."""
    last = F.substring("initials", -1, 1)
    before = F.lag(last).over(Window.partitionBy("conv_id").orderBy("place"))
    edge = (before.isNotNull() & ~F.concat(before, F.substring("initials", 1, 1)).isin("su", "ua", "au")).cast("long")
    audit = F.concat(F.array_join("edits", ""), F.repeat(F.lit("I"), F.col("tail").cast("int")))
    one = done.select("conv_id", "place", *FAULTS, (F.col("illegal") + F.coalesce(edge, F.lit(0))).alias("illegal"),
                      (F.col("cost") + INSERT * F.col("tail")).alias("cost"), audit.alias("audit"))
    return one.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in (*FAULTS, "illegal", "cost")),
        F.array_join(F.sort_array(F.collect_list(F.struct("place", "audit")))["audit"], "").alias("audit"))


def repaired(rows: DataFrame, done: DataFrame) -> DataFrame:
    """(conv_id, at, nth, role, text, edit) of the rows after repair, in the order of (at, nth) within a conversation."""
    edits = done.select(F.explode(F.arrays_zip("ats", "edits", "states")).alias("e")).select("e.*")
    both = rows.select("conv_id", "at", "role", "text").join(edits, F.col("at") == F.col("ats"))
    # a row inserted after u is an assistant's, any other a user's; so is one with a new role
    turn = "if((states = 2) <> (nth % 2 = 1), 'assistant', 'user')"
    each = both.select("conv_id", "at", "role", "text", "states", F.posexplode(F.split("edits", "")).alias("nth", "edit")).filter("edit <> 'D'")
    each = each.select("conv_id", "at", "nth", F.expr(f"if(edit = 'K', role, {turn})").alias("role"),
                       F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit")
    tail = done.filter("tail > 0").select("conv_id", F.element_at("ats", -1).alias("at"), F.col("leave").alias("states"),
                                          F.explode(F.sequence(F.lit(0), (F.col("tail") - 1).cast("int"))).alias("nth"))
    tail = tail.select("conv_id", "at", (F.col("nth") + TAIL_FROM).alias("nth"), F.expr(turn).alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    return each.unionByName(tail)


#: Rows inserted at the end come behind the last row and what was inserted before it (two rows at most).
TAIL_FROM = 4


def digests(fixed: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows.  The rows of a conversation pass one task in order, one at a time."""
    lines = fixed.select("conv_id", "at", "nth", F.concat("role", F.lit(":"), "text").alias("line"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "at", "nth").select("conv_id", "line")

    def run(batches):
        now, sha, out = (), None, []
        for b in sliced(batches):
            for conv, line in zip(b.column("conv_id").to_pylist(), b.column("line").cast(pa.binary()).to_pylist()):
                if now != (conv,):
                    if sha:
                        out.append((now[0], sha.hexdigest()))
                    now, sha = (conv,), hashlib.sha256(line)
                else:
                    sha.update(b"\n" + line)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], names=["conv_id", "repaired_sha256"])
                out = []
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([sha.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    bounded_batches(fixed.sparkSession)
    return lines.mapInArrow(run, "conv_id long, repaired_sha256 string")


def fixed(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) repaired: the rows of ``repaired``."""
    rows, kinds = ordered(conversations)
    return repaired(rows, solved(kinds))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage, by the checksum of conv_id and turn: 0 drops a row, 1 empties its text, 2 removes its
    ends of sentences, 3 repeats it, 4 makes it a user's."""
    rows = rows.withColumn("fate", fate())
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("fate <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def fate() -> Column:
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    return F.crc32(key.cast("binary")) % 20


def op13_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest audit and repaired digest of every damaged conversation."""
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows, kinds = ordered(damaged(given))
    done = solved(kinds)
    # a turn's rows share their fate, so one row for each turn tells the gaps
    turns = given.select("conv_id", "turn", F.when(fate() != 0, F.col("turn")).alias("left")).groupBy("conv_id", "turn", "left").agg(F.count("*"))
    gaps = F.max("left") - F.min("left") + 1 - F.count("left")
    every = turns.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))
    told = report(done).withColumnRenamed("conv_id", "told_id")
    hashed = digests(repaired(rows, done)).withColumnRenamed("conv_id", "hashed_id")
    out = every.join(told, F.col("conv_id").eqNullSafe(F.col("told_id")), "left").join(hashed, F.col("conv_id").eqNullSafe(F.col("hashed_id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", "gaps", *map(zero, (*FAULTS, "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", sha256_hex(F.lit(""))).alias("repaired_sha256"))
