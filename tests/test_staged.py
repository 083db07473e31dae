"""A flow of stages that starts again where it stopped, and leaves only its results."""
import os

import pytest
from pyspark.sql import functions as F

from feedlens import session
from feedlens.plans import staged
from feedlens.plans.staged import Stage


@pytest.fixture
def folder(spark):
    return session.scratch_path(spark, f"staged-{os.urandom(4).hex()}")


def _tables(folder):
    return {d for d in os.listdir(folder) if not d.startswith(("_", "."))}


def test_a_flow_goes_on_behind_its_last_finished_stage(spark, folder):
    built, broken = [], [True]

    def stage(name, reads, build):
        def counted(*tables):
            built.append(name)
            return build(*tables)
        return Stage(name, reads, counted)

    def fails(a, b):
        bad = F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.lit(1)) if broken[0] else F.lit(1)
        return a.join(b, "id").withColumn("x", bad)

    stages = [stage("a", (), lambda: spark.range(10)), stage("b", ("a",), lambda a: a.withColumn("y", F.col("id") * 2)),
              stage("c", ("a", "b"), fails), stage("d", ("c",), lambda c: c.groupBy().agg(F.sum("y").alias("s")))]
    with pytest.raises(Exception, match="lost"):
        staged.run(spark, stages, folder, keep=("d",))
    assert built == ["a", "b", "c"] and {"a", "b"} <= _tables(folder)
    broken[0] = False
    assert staged.run(spark, stages, folder, keep=("d",))["d"].first()["s"] == 90
    assert built == ["a", "b", "c", "c", "d"] and _tables(folder) == {"manifest", "d"}
    assert staged.run(spark, stages, folder, keep=("d",))["d"].count() == 1 and len(built) == 5


def test_tables_of_a_query_can_be_deleted_once_it_is_used(spark):
    session.release_made(spark)
    t = session.materialize(spark.range(5), "kept")
    path = os.path.dirname(t.inputFiles()[0]).replace("file://", "")
    assert t.count() == 5 and os.path.isdir(path)
    assert session.release_made(spark) == 1 and not os.path.isdir(path) and session.release_made(spark) == 0
