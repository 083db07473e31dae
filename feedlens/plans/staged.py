"""A flow of stages that starts again where it stopped.

Each stage is a table in a folder of the run.  A stage counts as finished once its row is in the run's manifest,
which is written after the table; a run that starts again takes finished stages from the folder and builds
the others anew, over what a broken attempt may have left.  A table goes as soon as every stage that reads
it is finished, so that only the kept results remain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import category, clean, documents, sentiment
from ..session import release
from ..sources.tables import raw_comments

MANIFEST = "stage string, schema string"


@dataclass
class Stage:
    """``build`` gets the tables named in ``reads``, in that order."""
    name: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]


def finished(spark: SparkSession, folder: str) -> dict[str, T.StructType]:
    """The finished stages of a run with their schemas."""
    spark.createDataFrame([], MANIFEST).write.mode("append").parquet(f"{folder}/manifest")
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").collect()        # one row for each stage
    return {r["stage"]: T.StructType.fromDDL(r["schema"]) for r in rows}


def run(spark: SparkSession, stages: list[Stage], folder: str, keep: tuple[str, ...]) -> dict[str, DataFrame]:
    """The tables named in ``keep``, with all stages finished and all other tables gone."""
    done = finished(spark, folder)

    def read(name: str) -> DataFrame:
        return spark.read.schema(done[name]).parquet(f"{folder}/{name}")

    for i, s in enumerate(stages):
        if s.name not in done:
            table = s.build(*map(read, s.reads))
            table.write.mode("overwrite").parquet(f"{folder}/{s.name}")
            spark.createDataFrame([(s.name, table.schema.toDDL())], MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
            done[s.name] = table.schema
        for name in s.reads:
            if name not in keep and not any(name in later.reads for later in stages[i + 1:]):
                release(spark, f"{folder}/{name}")
    return {name: read(name) for name in keep}


def library_stages(spark: SparkSession, sf_dir: str) -> list[Stage]:
    """From raw text to summary documents with the library's own labels: cleaning, polarity (E1), categories (E3),
    groups and tiers (A6, W10-W12), documents (E5)."""
    def labelled(comments: DataFrame) -> DataFrame:
        return sentiment.score_sentiment(comments.filter("bucket = 'full'"))

    def analysed(rows: DataFrame) -> DataFrame:
        keep = ("content_id", "content_name", "comment", "ordinal", "sentiment", "category", "root_cause", "owner", "priority", "actions", "error")
        return category.categorize(rows).select(*keep)

    return [
        Stage("clean", (), lambda: clean.clean_comments(raw_comments(spark, sf_dir))),
        Stage("labelled", ("clean",), labelled),
        Stage("analysed", ("labelled",), analysed),
        Stage("tiered", ("analysed",), lambda a: category.tiers(category.category_groups(a))),
        Stage("negative", ("tiered",), lambda t: documents.negative_documents(t, category.top_priority_actions(t))),
        Stage("positive", ("tiered",), documents.positive_documents),
    ]
