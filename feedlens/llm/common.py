"""Helpers shared by the corpus operators: table access, shared scratch tables, SQL snippets."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What separates words in the copy and substring operators: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a local one is set only where
    the session names none and runs in one process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="feedlens-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Cuts the lineage: what reads the table survives a lost executor without recomputing
    the work above, and several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    paths = {os.path.dirname(f) for f in df.inputFiles()}
    jvm = spark.sparkContext._jvm
    for p in paths:
        if "/llm-" in p:
            at = jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def text_of(column: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores added until none is the name of a column of ``docs``."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def utf8(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8, null as the empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


#: Texts that a Python worker turns into objects at a time, and the bytes of the Arrow batches
#: that carry them, whatever the size of a partition.
SLICE_ROWS = 1024
BATCH_BYTES = "16m"
_DEFAULT_BATCH_BYTES = ("67108864b", "64m", "64MB")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of long texts small, unless the session has chosen a bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, _DEFAULT_BATCH_BYTES[0]) in _DEFAULT_BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)


#: What operators keep in a Python worker between its tasks (vocabularies, caches), by operator.
_KEPT: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The dict in which an operator keeps things in this worker, until another operator runs there."""
    return _KEPT.setdefault(operator, {})


def release_others(operator: str | None) -> None:
    """Workers outlive their tasks and idle ones keep their memory: let go of what other operators keep."""
    others = [d for name, d in _KEPT.items() if d and name != operator]
    for d in others:
        d.clear()
    if others:
        gc.collect()


def give_back() -> None:
    """Hand freed memory, which the allocator would hold, back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch], operator: str | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``SLICE_ROWS``; the worker holds what ``operator`` keeps and no more."""
    release_others(operator)
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)
            if operator:
                give_back()
    give_back()


def annotate(docs: DataFrame, compute: Callable[[list[bytes]], Iterator[list]], added: str, text: str = "text",
             operator: str | None = None) -> DataFrame:
    """``docs`` with the columns of the DDL string ``added``, worked out row by row from the texts.

    ``compute`` maps the UTF-8 texts of an Arrow batch to the added columns in order.  All
    other columns pass through untouched, so a stage can decide on a row without a join.
    """
    new = T.StructType.fromDDL(added)
    schema = T.StructType([*docs.schema.fields, *new.fields])
    at = docs.columns.index(text)
    kinds = [_arrow(f.dataType) for f in new.fields]
    names = schema.names

    def run(batches):
        for b in sliced(batches, operator):
            made = compute(utf8(b.column(at)))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(made, kinds))], names=names)

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def let(var: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``var`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {var} -> {body}), 1)"


def prefix_sums(arr: str) -> str:
    """SQL for the running sums of an array of longs, each without its own element.

    Sums are taken by blocks of about sqrt(n) elements, so n elements cost n * sqrt(n)
    additions and no rows leave the task.
    """
    inner = (
        "flatten(transform(sequence(0, pb - 1), b -> transform(sequence(1, least(ps, size(pa) - b * ps)),"
        " j -> po[b] + aggregate(slice(pa, b * ps + 1, j - 1), 0L, (x, y) -> x + y))))"
    )
    offsets = "transform(sequence(0, pb - 1), b -> aggregate(slice(pt, 1, b), 0L, (x, y) -> x + y))"
    totals = "transform(sequence(0, pb - 1), b -> aggregate(slice(pa, b * ps + 1, ps), 0L, (x, y) -> x + y))"
    body = let("ps", "int(ceil(sqrt(size(pa))))", let("pb", "int(ceil(size(pa) / ps))", let("pt", totals, let("po", offsets, inner))))
    return let("pa", arr, f"if(size(pa) = 0, array(), {body})")
