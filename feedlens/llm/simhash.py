"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints: one bit for each of 64 weighted votes of the XXH64 hashes of a document's
word shingles.  Two documents are linked if their fingerprints differ in at most
``max_distance`` bits.  Links are found among the distinct fingerprints:

1. The 64 x 64 agreement counts of the bits are summed over all fingerprints; strongly
   correlated bits go into the same of ``n_parts`` parts, which leaves the parts as
   independent of each other as possible.
2. Each part i gets a threshold t_i >= -1 with sum(t_i) = max_distance - n_parts + 1.  By
   the general pigeonhole principle a linked pair differs in at most t_i bits on some part.
   Dynamic programming picks the thresholds with the fewest estimated candidates and probes;
   the estimates come from the exact collision count of each part and its bit frequencies.
3. Each fingerprint is filed under its value on every part and probes the values within t_i
   bits.  A candidate is verified on all 64 bits inside the join.  Of two fingerprints that
   differ in a part, only the one with 0 at the highest differing bit probes, and only the
   first part that can find a pair reports it, so each link comes once.
4. A bucket with more than ``hot_bucket`` rows is not joined: its members name all codes
   within half the distance, and two members are within the distance exactly if they name
   a common code.  Linking each to the least member of every code they name gives the same
   components with links linear in the members, never all pairs.

Components come from ``graph.components``.  Exact copies share a fingerprint and never meet
as a pair.

Defined results: a null, empty or blank text has fingerprint zero and links like any other;
repeated rows are kept; a row with a null doc_id gets its component from the others of its
group (null if none has an id); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, sliced, stored, table, text_of
from .graph import components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
N_PARTS = 3
HOT_BUCKET = 2000
SEED = 42
BITS = 64
#: Cost of sending one probe through the shuffle, in verified candidates.
PROBE_COST = 4.0


def fingerprint(text: bytes, k: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a UTF-8 text (A-Z lower-cased), unsigned."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest, n = xxhash.xxh64_intdigest, len(starts)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])]
        octets = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, tag, code): the hash of each whole text, and its fingerprint as a signed long."""

    def run(batches):
        for b in sliced(batches):
            codes = np.array([fingerprint(t, shingle_words) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.int64())], names=["doc_id", "tag", "code"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("tag"), text_of().cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, tag long, code long")


def _agreements(codes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of codes, and for each two bits how many codes have both set."""

    def run(batches):
        both = np.zeros((BITS, BITS), np.int64)
        n = 0
        for b in batches:
            octets = b.column(0).to_numpy().view(np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(octets, axis=1, bitorder="little").astype(np.float32)
            both += np.rint(bits.T @ bits).astype(np.int64)
            n += len(bits)
        i, j = np.indices((BITS, BITS))
        cells = np.append((i * BITS + j).ravel(), -1), np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cells], names=["cell", "n"])

    cells = codes.select("code").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = {r["cell"]: r["n"] for r in cells}
    return found.get(-1, 0), np.array([found.get(c, 0) for c in range(BITS * BITS)]).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, n_parts: int) -> list[list[int]]:
    """Bits in parts of nearly equal size, correlated bits together (greedy by mean correlation)."""
    n = max(n, 1)
    p = np.diag(both) / n
    spread = np.sqrt(np.clip(p * (1 - p), 1e-9, None))
    corr = np.abs((both / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, parts = set(range(len(p))), []
    for k in range(n_parts):
        size = -(-len(free) // (n_parts - k))
        part = [max(free, key=lambda b: (corr[b, sorted(free)].max(), -b))]
        free.discard(part[0])
        while len(part) < size:
            part.append(max(free, key=lambda b: (corr[b, part].mean(), -b)))
            free.discard(part[-1])
        parts.append(sorted(part))
    return parts


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds t_i >= -1 that sum to ``total`` at the least cost; costs[i][t + 1] is part i at t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, c in enumerate(part, start=-1):
                if spent + t not in step or cost + c < step[spent + t][0]:
                    step[spent + t] = (cost + c, [*chosen, t])
        best = step
    return best[total][1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(part: list[int], radius: int) -> list[tuple[int, int]]:
    """(flip, its highest bit) for the ways to change up to ``radius`` bits of a part, as signed longs."""
    return [(_signed(sum(1 << b for b in c)), _signed(1 << max(c)) if c else 0)
            for r in range(radius + 1) for c in itertools.combinations(part, r)]


def _mask(part: list[int]) -> int:
    return _signed(sum(1 << b for b in part))


def _differ(a: Column, b: Column, mask: int = -1) -> Column:
    return F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(mask).cast("long")))


def thresholds(codes: DataFrame, n: int, both: np.ndarray, parts: list[list[int]], max_distance: int) -> list[int]:
    """The cheapest unequal thresholds for the parts of these codes."""
    masked = [F.struct(F.lit(i).alias("part"), F.col("code").bitwiseAND(F.lit(_mask(p)).cast("long")).alias("value"))
              for i, p in enumerate(parts)]
    met = (codes.select(F.explode(F.array(*masked)).alias("b")).groupBy("b").count()
           .groupBy("b.part").agg(F.sum(F.col("count") * (F.col("count") - 1)).alias("met")).collect())
    met = {r["part"]: r["met"] for r in met}
    freq, costs = np.diag(both) / max(n, 1), []
    for i, part in enumerate(parts):
        apart = np.array([1.0])  # chances that two codes differ in 0, 1, ... bits of the part
        for b in part:
            d = 2 * freq[b] * (1 - freq[b])
            apart = np.append(apart * (1 - d), 0) + np.append(0, apart * d)
        unit = max(met.get(i, 0), n * n * apart[0]) / max(apart[0], 1e-12)
        costs.append([0.0] + [float(unit * apart[: t + 1].sum() / 2 + PROBE_COST * n * len(_flips(part, t)))
                              for t in range(min(max_distance, 3) + 1)])
    return allocate(costs, max_distance - len(parts) + 1)


def fingerprint_links(codes: DataFrame, max_distance: int = MAX_DISTANCE, n_parts: int = N_PARTS,
                      hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Links (u, v) between the distinct values of ``code`` that join exactly the codes which
    are connected by steps of at most ``max_distance`` (an even number of) bits."""
    if max_distance % 2:
        raise ValueError("the common names of a hot bucket need an even distance")
    n, both = _agreements(codes)
    parts = group_bits(n, both, n_parts)
    limits = thresholds(codes, n, both, parts, max_distance)
    used = [(i, p, t) for i, (p, t) in enumerate(zip(parts, limits)) if t >= 0]

    def rows(choices: list[tuple[int, int, int, int]]) -> DataFrame:
        """One row (part, value, home, code) for each choice that the code allows."""
        code = F.col("code")
        arr = F.array(*[F.struct(*[F.lit(x).cast("long").alias(k) for k, x in zip(("part", "mask", "flip", "high"), c)]) for c in choices])
        return (codes.select(code, F.explode(arr).alias("c")).filter(code.bitwiseAND(F.col("c.high")) == 0)
                .select(F.col("c.part").alias("part"), code.bitwiseAND(F.col("c.mask")).bitwiseXOR(F.col("c.flip")).alias("value"),
                        (F.col("c.flip") == 0).alias("home"), code))

    homes = rows([(i, _mask(p), 0, 0) for i, p, _ in used])
    probes = rows([(i, _mask(p), flip, high) for i, p, t in used for flip, high in _flips(p, t)])
    hot = stored(probes.groupBy("part", "value").agg(F.count("*").alias("n"), F.bool_or("home").alias("home"))
                 .filter(F.col("home") & (F.col("n") > hot_bucket)).select("part", "value"), "hot-buckets")
    a, b = F.col("u"), F.col("v")
    first = F.lit(True)
    for k, (i, p, t) in enumerate(used):
        first &= (F.col("h.part") != i) | ~_any([_differ(a, b, _mask(q)) <= s for _, q, s in used[:k]])
    h = homes.join(hot, ["part", "value"], "left_anti").select("part", "value", F.col("code").alias("u")).alias("h")
    g = probes.join(hot, ["part", "value"], "left_anti").select("part", "value", "home", F.col("code").alias("v")).alias("g")
    pairs = h.join(g, (F.col("h.part") == F.col("g.part")) & (F.col("h.value") == F.col("g.value")) & (a != b)
                   & (~F.col("g.home") | (a < b)) & (_differ(a, b) <= max_distance) & first).select("u", "v")
    if hot.isEmpty():
        return pairs
    near = [f for f, _ in _flips(list(range(BITS)), max_distance // 2)]
    crowd = probes.join(hot, ["part", "value"], "left_semi").select("code").distinct()
    named = crowd.select("code", F.explode(F.array(*[F.lit(f).cast("long") for f in near])).alias("f"))
    named = named.select(F.col("code"), F.col("code").bitwiseXOR(F.col("f")).alias("name"))
    least = named.groupBy("name").agg(F.min("code").alias("u"))
    linked = named.join(least, "name").filter("code <> u").select("u", F.col("code").alias("v")).distinct()
    return pairs.unionByName(linked)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out |= c
    return out


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                    n_parts: int = N_PARTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable by links)."""
    codes = stored(fingerprints(docs, shingle_words).drop("tag"), "fingerprints")
    distinct = stored(codes.groupBy("code").agg(F.min("doc_id").alias("first_id")), "codes")
    groups = components(fingerprint_links(distinct, max_distance, n_parts, hot_bucket))
    groups = groups.withColumnRenamed("node", "code").join(distinct, "code")
    least = groups.groupBy("component").agg(F.min("first_id").alias("component_id"))
    groups = groups.join(least, "component").select("code", "component_id")
    # stored, so that the last join is of two plain shuffles and can be split at a code with many copies
    names = stored(distinct.join(groups, "code", "left").select("code", F.coalesce("component_id", "first_id").alias("component_id")), "names")
    return codes.join(names, "code").select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                    n_parts: int = N_PARTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """first_id, first_tag: the least (doc_id, xxhash64 of the text) of each component."""
    codes = fingerprints(docs, shingle_words)
    distinct = stored(codes.groupBy("code").agg(F.min(F.struct("doc_id", "tag")).alias("first")), "codes")
    groups = components(fingerprint_links(distinct, max_distance, n_parts, hot_bucket)).withColumnRenamed("node", "code")
    least = distinct.join(groups, "code", "left").groupBy(F.coalesce("component", "code").alias("component")).agg(F.min("first").alias("first"))
    return least.select(F.col("first.doc_id").alias("first_id"), F.col("first.tag").alias("first_tag"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
