"""Session helpers.

The library never creates a session inside an operator; callers pass one in.  These
helpers are for scripts and tests: sensible defaults for AQE, skew handling and Arrow,
and the shared folder for intermediate tables (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # Keep the per-group top-k pushed below the shuffle (WindowGroupLimit).
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def build_session(master: str | None = None, app: str = "feedlens", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a session that runs in one process (tests, the bench) gets a folder of its own
    when none is named; on a cluster a folder of one machine would lose data.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        if sc is None or not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="feedlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table once to the shared folder as Parquet and read it back.

    Used where several branches read one expensive result: they scan only the columns
    they need, and a lost executor recomputes nothing above the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _MADE.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders of the tables that ``materialize`` wrote and nobody has deleted yet.
_MADE: list[str] = []


def release_made(spark: SparkSession) -> int:
    """Delete every table that ``materialize`` has written so far, once the results that read them
    have been used; their number."""
    made = [p for p in _MADE if p.startswith(checkpoint_dir(spark))]
    for path in made:
        release(spark, path)
        _MADE.remove(path)
    return len(made)


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared folder once nothing reads it any more."""
    if not path.startswith(checkpoint_dir(spark)):
        raise ValueError(f"not below the shared folder: {path}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedlens`` importable on the executors' Python workers.

    The package is zipped once per application on the driver and handed to Spark, which
    serves it to the workers itself (``addPyFile``; ``addArtifacts`` on Spark Connect).
    """
    import zipfile
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        app = spark.conf.get("spark.app.id", "connect")
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="feedlens-pkg-"), "feedlens.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    try:
        spark.sparkContext.addPyFile(target)
    except Exception:  # noqa: BLE001 - Spark Connect
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(app)
