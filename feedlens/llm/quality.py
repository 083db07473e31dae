"""Quality classifier from weak labels.

1. Overlapping heuristic labellers look at each whole text and vote to reject it, to keep it,
   or not at all.  The annotators of the labels table, where it covers a document, are two
   more labellers.
2. Expectation-maximisation estimates, over all documents, the share of bad documents and how
   each labeller votes on good and on bad ones, once for the labellers of abuse and once for
   those of text that isn't prose.  Documents with the same votes count as one pattern, so it
   works on at most 3**labellers counts, whatever the corpus.
3. The posterior of its votes is a document's soft label.  A hashed linear scorer (logistic,
   follow the regularised leader, L1) is fitted to the soft labels of a sample of about
   ``TRAIN_DOCS`` annotated documents, chosen by the hash of their ids (of any documents if
   none is annotated); it sees hashed words and word beginnings and the labellers'
   measurements in steps.  The bound of the sample is a parameter.
4. Every document is scored on its whole text; those with an estimated chance of being bad of
   ``CUT`` or more are rejected.

Votes meet annotations on document ids only; no text is shuffled.

Defined results: a null or blank text gets only abstentions and the score of its few features;
repeated rows are judged alike; an empty table gives no rows; a corpus in which no labeller
sees a bad document rejects none; other columns pass through.
"""

from __future__ import annotations

import operator
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import annotate, fresh, table
from .decontaminate import words_of

TRAIN_DOCS = 8000
HASH_BITS = 18
CUT = 0.5
ROUNDS = 200
PRIOR = 0.01
EPOCHS = 3
RATE, L1, L2 = 0.3, 6.0, 1.0
START = 6
#: How many distinct words begin alike: steps that are features of their own.
ALIKE = (2, 4)
KNOWN_FEATURES = 100_000
# Abusive words, our own list in four languages.
ABUSE = """
asshole bastard bitch brainless clown crap cretin creep degenerate dickhead disgusting dumb dumbass filth freak fuck fucker fucking garbage idiot idiotic
imbecile jackass jerk loser lowlife maggot moron moronic pathetic pig piss prick retard retarded scum scumbag shit shithead slut sucker stupid
swine trash twat ugly vermin whore worthless
abschaum arschloch dreck dummkopf fotze hure hurensohn idioten missgeburt scheisse scheiße schlampe schwachkopf trottel wichser
abruti batard bâtard connard connasse conne débile encule enculé imbécile merde ordure pourriture putain pute salaud salope
basura cabron cabrón escoria estupido estúpido gilipollas imbecil imbécil mierda puta puto tonto zorra
""".split()
_ABUSE = {w.encode() for w in ABUSE}
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))

#: name -> (at most: keep, at least: reject); a measurement in between abstains.  Few words of abuse speak for a text
#: once, not twice: the labeller of much abuse never votes to keep.
LABELLERS = {
    "abuse": (0.0, 1.0),
    "abuse_often": (-1.0, 3.0),
    "marks": (0.03, 0.10),
    "symbols": (0.0, 0.10),
    "odd_words": (0.05, 0.30),
    "shouting": (0.20, 0.50),
    "stuttering": (0.06, 0.25),
    "monotony": (0.20, 0.50),
    "repeated_lines": (0.10, 0.40),
}
#: The votes of a pattern: the labellers', then the annotators' on toxic and on quality.
TOXIC, QUALITY = len(LABELLERS), len(LABELLERS) + 1
#: The labellers overlap in two groups that look for different faults.
GROUPS = ([0, 1, TOXIC], [*range(2, len(LABELLERS)), QUALITY])
_PLAIN = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or b in b" \t\r\n")
_BREAKS = _UPPER + _LOWER + bytes(range(128, 256))


def measure(text: bytes) -> tuple[list[float], set[bytes]]:
    """The labellers' measurements (nan where a text is too short for one) and the distinct folded words."""
    words, folded = text.split(), words_of(text)
    n, distinct = len(words), set(folded)
    nan = float("nan")
    if not n:
        return [nan] * len(LABELLERS), distinct
    abuse = float(sum(map(folded.count, distinct & _ABUSE)))
    letters = len(text) - len(text.translate(None, _UPPER + _LOWER))
    capitals = len(text) - len(text.translate(None, _UPPER))
    marks = len(text.translate(None, _PLAIN))
    lines = [x for x in text.split(b"\n") if x.strip()]
    several = n >= 20
    # words that do not end like prose: a letter, or one of . , after a letter
    odd = sum([w[-1] not in _BREAKS and (w[-1] not in b".,;:?)\"'" or len(w) < 2 or w[-2] not in _BREAKS) for w in words])
    return [
        abuse,
        abuse,
        marks / len(text) if several else nan,
        sum(map(text.count, (b"%", b"&", b"$", b"#", b"*", b"^", b"~", b"|", b"<", b">"))) / n if several else nan,
        odd / n if several else nan,
        capitals / letters if letters >= 40 else nan,
        sum(map(operator.eq, words, words[1:])) / n if several else nan,
        1 - min(1.0, len(distinct) / n ** 0.75) if several else nan,
        1 - len(set(lines)) / len(lines) if len(lines) >= 6 else nan,
    ], distinct


def vote(measured: list[float]) -> list[int]:
    """1 to reject, 0 to keep, -1 to abstain, by each labeller."""
    return [1 if m >= high else 0 if m <= low else -1 for m, (low, high) in zip(measured, LABELLERS.values())]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The chance that each vote pattern belongs to a bad document, by expectation-maximisation.

    The last column holds the annotators' votes.  An abstention says nothing.  The first guess
    is that any vote to reject is right; labellers are taken to be better than chance, and
    annotators to miss less than heuristics and to accuse hardly ever, by a prior of ``PRIOR`` of the documents:
    lists of words know one language better than another, and a document that none of them sees may still be bad.
    """
    bad = np.where((patterns == 1).any(axis=1), 0.9, 0.02)
    cast = np.stack([(patterns == v) for v in (0, 1)], axis=2).astype(float)
    prior = np.empty((2, patterns.shape[1], 2))
    prior[0], prior[1], prior[0, -1], prior[1, -1] = (0.99, 0.01), (0.7, 0.3), (0.9995, 0.0005), (0.1, 0.9)
    prior *= PRIOR * counts.sum() + 2
    # what is known of annotators counts as much as all their votes
    prior[:, -1] *= max(1.0, counts @ cast[:, -1].sum(axis=1) / (PRIOR * counts.sum() + 2))
    for _ in range(rounds):
        weights = np.stack([counts * (1 - bad), counts * bad])
        share = (weights.sum(axis=1) + 0.5) / (counts.sum() + 1)
        votes = np.einsum("cp,plv->clv", weights, cast) + prior
        votes /= votes.sum(axis=2, keepdims=True)
        log = np.log(share)[:, None] + np.einsum("plv,clv->cp", cast, np.log(votes))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        done = np.abs(new - bad).max() < 1e-9
        bad = new
        if done:
            break
    return bad


def posteriors(votes: list[tuple[int, ...]], counts: list[int]) -> dict[tuple[int, ...], float]:
    """The chance of being bad, by vote pattern: at fault in the eyes of either group of labellers."""
    fine = np.ones(len(votes))
    for group in GROUPS:
        patterns, index = np.unique(np.array([[v[k] for k in group] for v in votes]), axis=0, return_inverse=True)
        fine *= 1 - estimate(patterns, np.bincount(index.ravel(), counts))[index.ravel()]
    return dict(zip(votes, (1 - fine).tolist()))


def features(measured: list[float], distinct: set[bytes]) -> list[bytes]:
    """Names of what is hashed: the words, the starts of longer ones (and whether several words share one), and each
    measurement in steps of its two limits."""
    shape = []
    for (name, (low, high)), m in zip(LABELLERS.items(), measured):
        low = max(low, 0.0)
        step = -1 if m != m else min(6, int(4 * (m - low) / (high - low))) if m > low else 0
        shape.append(f"\0{name}={step}".encode())
    starts = Counter([w[:START] for w in distinct if len(w) > START])
    alike = [b"%d^%s" % (step, w) for w, n in starts.items() if n > 1 for step in ALIKE if n >= step]
    return [*distinct, *[b"^" + w for w in starts], *alike, *shape]


def slot(feature: bytes) -> int:
    return xxhash.xxh64_intdigest(feature) >> (64 - HASH_BITS)


def fit(rows: list[tuple[np.ndarray, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the constant) of a logistic scorer from (slots, soft label) rows.

    Follow-the-regularised-leader with a step size for each slot; the L1 term leaves slots
    without steady evidence at zero.  The constant is free of it, so few rows still tell how rare
    bad documents are.
    """
    size = 1 << HASH_BITS
    total, square = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        t, least = total[at], np.where(at == size, 0.0, L1)
        return np.where(np.abs(t) <= least, 0.0, -(t - np.sign(t) * least) / ((1 + np.sqrt(square[at])) / RATE + L2))

    order = np.random.default_rng(0)
    labels = np.array([y for _, y in rows])
    slots = [np.append(s, size) for s, _ in rows]
    for _ in range(epochs):
        for batch in np.array_split(order.permutation(len(rows)), -(-len(rows) // 32)):
            sizes = [len(slots[i]) for i in batch]
            row = np.repeat(np.arange(len(batch)), sizes)
            used, col = np.unique(np.concatenate([slots[i] for i in batch]), return_inverse=True)
            w = weights(used)
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], len(batch)), -50, 50)))
            grad = np.bincount(col, (p - labels[batch])[row], len(used))
            more = square[used] + grad * grad
            total[used] += grad - (np.sqrt(more) - np.sqrt(square[used])) / RATE * w
            square[used] = more
    return weights(np.arange(size + 1))


class Scorer:
    """Scores texts by summed weights; the weights of known words are kept, up to a bound."""

    def __init__(self, weights: np.ndarray):
        used = np.flatnonzero(weights[:-1])
        self.slots = dict(zip(used.tolist(), weights[used].tolist()))
        self.constant = float(weights[-1])
        self.known: dict[bytes, float] = {}

    def __call__(self, texts: list[bytes]) -> list[float]:
        known, out = self.known, []
        for text in texts:
            total = self.constant
            for f in features(*measure(text)):
                w = known.get(f)
                if w is None:
                    w = self.slots.get(slot(f), 0.0)
                    if len(known) < KNOWN_FEATURES:
                        known[f] = w
                total += w
            out.append(total)
        return out


def train(docs: DataFrame, labels: DataFrame | None = None, train_docs: int = TRAIN_DOCS) -> Scorer | None:
    """The scorer for a corpus, with the help of the annotations in ``labels`` (doc_id, quality,
    toxic); none for an empty corpus."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    if labels is None:
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    yes = lambda c, v: F.when(F.col(c).isNull(), -1).otherwise((F.col(c) == v).cast("int"))
    labels = labels.groupBy("doc_id").agg(F.max(yes("toxic", 1)).alias("toxic"), F.max(yes("quality", 0)).alias("poor"))
    voted = annotate(docs, lambda texts: [[vote(measure(t)[0]) for t in texts]], "votes array<int>").select("doc_id", "votes")
    given = F.concat("votes", F.array(F.coalesce("toxic", F.lit(-1)), F.coalesce("poor", F.lit(-1))))
    counted = voted.join(labels, "doc_id", "left").groupBy(given.alias("votes")).agg(F.count("*").alias("n")).collect()
    if not counted:
        return None
    counted = sorted((tuple(r["votes"]), r["n"]) for r in counted)  # at most 3**len(votes) rows
    posterior = posteriors([v for v, _ in counted], [n for _, n in counted])
    annotated = sum(n for v, n in counted if max(v[TOXIC:]) >= 0)
    total = annotated or sum(n for _, n in counted)
    share = min(1 << 30, (train_docs << 30) // total + 1)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share
    if annotated:  # about train_docs ids that docs holds, twice that at most, in the order of their hashes
        there = labels.filter(drawn).join(docs.select("doc_id").filter(drawn), "doc_id", "left_semi")
        there = there.orderBy(F.xxhash64("doc_id", F.lit("bound")), "doc_id").limit(2 * train_docs)
        docs = docs.join(F.broadcast(there), "doc_id").select("doc_id", "text", "toxic", "poor")
    else:
        docs = docs.filter(drawn).limit(2 * train_docs).select("doc_id", "text", F.lit(-1).alias("toxic"), F.lit(-1).alias("poor"))

    def learn(texts):
        measured = [measure(t) for t in texts]
        slots = [np.unique(np.array([slot(f) for f in features(m, d)], np.int32)).tobytes() for m, d in measured]
        return [slots, [vote(m) for m, _ in measured]]

    rows = annotate(docs, learn, "slots binary, votes array<int>").select("doc_id", "slots", "votes", "toxic", "poor").collect()
    rows = sorted((r["doc_id"] or 0, bytes(r["slots"]), posterior.get((*r["votes"], r["toxic"], r["poor"]), 0.0)) for r in rows)
    return Scorer(fit([(np.frombuffer(s, np.int32), y) for _, s, y in rows])) if rows else None


def score(docs: DataFrame, labels: DataFrame | None = None, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``docs`` with bad_score (log-odds of being bad) and keep."""
    scorer = train(docs, labels, train_docs)
    name, keep = fresh(docs, "bad_score", "keep")
    compute = (lambda texts: [scorer(texts)]) if scorer else (lambda texts: [[0.0] * len(texts)])
    return annotate(docs, compute, f"{name} double").withColumn(keep, F.col(name) < float(np.log(CUT / (1 - CUT))))


def filter_quality(docs: DataFrame, labels: DataFrame | None = None, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The documents that the classifier keeps."""
    keep = fresh(docs, "keep")[0]
    return score(docs, labels, train_docs).filter(keep).select(*docs.columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(docs, table(spark, sf_dir, "labels")).select("doc_id", F.round("bad_score", 6).alias("bad_score"), "keep")
