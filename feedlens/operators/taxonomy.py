"""Category taxonomy (S10) and the taxonomy join.

The taxonomy is a fixed 30-row dimension (15 categories per sentiment); joining it is a
broadcast of a table whose size is bounded by construction, never by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import NEGATIVE_TAXONOMY, POSITIVE_TAXONOMY, PRIORITY_RANK

TAXONOMY_DDL = ("sentiment string, category_no int, category string, root_cause string, owner string, "
                "priority string, actions array<string>")


def taxonomy(spark: SparkSession) -> DataFrame:
    rows = [("negative",) + r for r in NEGATIVE_TAXONOMY] + [("positive",) + r for r in POSITIVE_TAXONOMY]
    return spark.createDataFrame(rows, TAXONOMY_DDL)


def priority_rank(col) -> F.Column:
    m = F.create_map(*[x for k, v in PRIORITY_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col), F.lit(len(PRIORITY_RANK) + 1))


def join_taxonomy(df: DataFrame, sentiment_col: str = "sentiment", no_col: str = "category_no") -> DataFrame:
    """Category number -> name, root cause, owner, priority, actions."""
    tax = taxonomy(df.sparkSession).select(
        F.col("sentiment").alias("_t_sent"), F.col("category_no").alias("_t_no"), "category", "root_cause",
        "owner", "priority", "actions")
    return (df.join(F.broadcast(tax), (F.col(sentiment_col) == F.col("_t_sent")) & (F.col(no_col) == F.col("_t_no")),
                    "left")
            .drop("_t_sent", "_t_no"))
