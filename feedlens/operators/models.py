"""A local model for the hooks (E1, E2, E4): naive Bayes over words, trained by Spark.

Word counts per label are one aggregation with map-side combine.  The model keeps the ``VOCABULARY`` most
frequent words, so what reaches the driver and the workers is bounded by that number and the labels.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens

VOCABULARY = 2000


def word_text(col) -> Column:
    """The lower-cased words of a text, a space between: what the model reads."""
    return F.array_join(tokens(col), " ")


@dataclass
class WordModel:
    """Labels in order, their log shares, and the log probabilities (label x word) of the known words."""
    labels: list[str]
    prior: np.ndarray
    index: dict[str, int]
    weights: np.ndarray

    def label(self, words: str) -> str:
        """The likeliest label of ``word_text``; ties go to the first label."""
        times = Counter(words.split(" "))
        known = [w for w in times if w in self.index]
        found = self.weights[:, [self.index[w] for w in known]] * np.array([times[w] for w in known], float)
        return self.labels[int((self.prior + found.sum(axis=1)).argmax())]

    def predict(self, words: pd.Series) -> pd.Series:
        return words.map(self.label)


def train(rows: DataFrame, label: str, text: str, vocabulary: int = VOCABULARY) -> WordModel:
    """A model of ``label`` by the words of ``text``; rows without a label teach nothing."""
    known = rows.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.explode(tokens(text)).alias("word"))
    counts = known.groupBy("label", "word").agg(F.count(F.lit(1)).alias("n"))
    kept = counts.groupBy("word").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "word").limit(vocabulary)
    shares = rows.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy("label").collect()
    labels = [r["label"] for r in shares]
    found = counts.join(F.broadcast(kept.select("word")), "word").collect()          # at most ``vocabulary`` words a label
    index = {w: i for i, w in enumerate(sorted({r["word"] for r in found}))}
    table = np.zeros((len(labels), len(index)))
    for r in found:
        table[labels.index(r["label"]), index[r["word"]]] = r["n"]
    size = np.array([r["n"] for r in shares], float)
    weights = np.log((table + 1) / (table.sum(axis=1, keepdims=True) + max(1, len(index))))
    return WordModel(labels, np.log(size / size.sum()), index, weights)
