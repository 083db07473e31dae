"""External enrichment and incremental (resume) operators: E4, P19, P20, J4-J7, A14.

E4 is the one Python surface: a user function (a model or a remote service client) runs
inside ``mapInPandas`` on Arrow batches.  ``partitions`` caps how many tasks call it at
once (the upstream code used 10 threads); each task retries with exponential backoff on
rate limits, and an error becomes data (``error``, ``attempts``, ``latency``) instead of
failing the job.  The hook's output must be materialised (see ``session.materialize``)
before several aggregates reuse it, so the service is called once per row, and so that
a lost executor does not call it again through recomputation.

Resume (J4-J7) is an anti join against what an earlier run wrote: only rows still
without a successful result are sent to the hook again.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from string import Formatter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank, text_key, utrim
from ..schemas import ANALYSIS_JSON_STRUCT
from .ranks import spread_left_join


# ----------------------------------------------------------------------------- E4
class RateLimited(Exception):
    """Raise from a hook to ask for the long (exponential) backoff."""


def is_rate_limit(error: Exception) -> bool:
    """A refusal for too many requests, by class or by the client's message."""
    text = str(error)
    return isinstance(error, RateLimited) or "429" in text or "rate_limit" in text.lower()


class Pacer:
    """Waits ``request_delay`` after every call and ``pause`` after every ``pause_every`` calls."""

    def __init__(self, request_delay: float = 0.0, pause_every: int = 0, pause: float = 0.0, sleep: Callable[[float], None] = time.sleep):
        self.request_delay, self.pause_every, self.pause, self.sleep = request_delay, pause_every, pause, sleep
        self.calls = 0

    def __call__(self) -> None:
        self.calls += 1
        if self.request_delay:
            self.sleep(self.request_delay)
        if self.pause_every and self.calls % self.pause_every == 0:
            self.sleep(self.pause)


def call_with_retry(fn: Callable, arg, max_tries: int = 5, base_delay: float = 2.0, other_delay: float = 1.0,
                    sleep: Callable[[float], None] = time.sleep):
    """(result, error, attempts, latency): rate limit -> wait base*2^k, else other_delay."""
    err = None
    for attempt in range(max_tries):
        start = time.perf_counter()
        try:
            res = fn(arg)
            return res, None, attempt + 1, time.perf_counter() - start
        except Exception as e:  # noqa: BLE001, PERF203 - errors become data
            limited = is_rate_limit(e)
            err = f"{'RATE_LIMIT_ERROR' if limited else 'ERROR'}: {e}"
            if attempt < max_tries - 1:
                sleep(base_delay * (2 ** attempt) if limited else other_delay)
    return None, err, max_tries, 0.0


def enrich_partitions(df: DataFrame, fn: Callable[[str], dict], input_col: str, result_schema: T.StructType,
                      partitions: int | None = None, max_tries: int = 5, base_delay: float = 2.0,
                      other_delay: float = 1.0, threads: int = 1, request_delay: float = 0.0, pause_every: int = 0,
                      pause: float = 0.0) -> DataFrame:
    """Run ``fn(text) -> dict`` for every row; output = input columns + the result
    fields + error, attempts, latency.

    ``partitions`` x ``threads`` bounds the number of concurrent calls: a round-robin
    repartition (so a hot course never lands on one task) and, for I/O-bound services,
    a small thread pool inside each task.  Results keep the input row order.  A task that
    calls one at a time can be paced (``request_delay``, ``pause`` every ``pause_every`` calls).
    """
    in_fields = df.schema.fields
    out_schema = T.StructType(in_fields + list(result_schema.fields) + [
        T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType()),
        T.StructField("latency", T.DoubleType())])
    names = [f.name for f in result_schema.fields]

    def one(v):
        res, err, n, lat = call_with_retry(fn, v, max_tries, base_delay, other_delay)
        res = res or {}
        return [res.get(k) for k in names] + [err, n, float(lat)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor
        pace = Pacer(request_delay, pause_every, pause)

        def paced(v):
            row = one(v)
            pace()
            return row

        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            for pdf in batches:
                values = pdf[input_col].tolist()
                rows = list(pool.map(one, values)) if threads > 1 else [paced(v) for v in values]
                extra = pd.DataFrame(rows, columns=names + ["error", "attempts", "latency"], index=pdf.index)
                yield pd.concat([pdf, extra], axis=1)

    src = df.repartition(partitions) if partitions else df
    return src.mapInPandas(run, out_schema)


class TokenBucket:
    """At most ``rate`` calls a second on average, shared by the threads of a task; no more than ``burst`` at once."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.last, self.lock = float(burst), clock(), threading.Lock()

    def __call__(self) -> None:
        with self.lock:
            now = self.clock()
            self.tokens = min(self.burst, self.tokens + (now - self.last) * self.rate) - 1
            self.last = now
            wait = -self.tokens / self.rate
        if wait > 0:
            self.sleep(wait)


def enrich_resumable(df: DataFrame, fn: Callable[[str], dict], key_col: str, input_col: str, result_schema: T.StructType, path: str,
                     slices: int = 256, rate: float | None = None, threads: int = 1, max_tries: int = 5, base_delay: float = 2.0,
                     other_delay: float = 1.0) -> DataFrame:
    """E4 for services that must not be asked twice: ``fn(text) -> dict`` for every row, kept under ``path``.

    Rows belong to one of ``slices`` by a hash of ``key_col``, each slice is one task, and its results are
    there for good as soon as that task ends.  A lost task repeats its own slice; a run that starts again after any
    failure skips the slices that are there.  ``path`` belongs to one input and one number of slices.

    ``rate`` is the number of calls a second that the service allows to the whole cluster: each of the
    session's slots gets an equal part of it.  Result: input columns, result fields, error, attempts, latency.
    """
    spark = df.sparkSession
    slots = max(1, min(slices, spark.sparkContext.defaultParallelism))
    share = rate / slots if rate else None
    out = T.StructType([*df.schema.fields, T.StructField("slice", T.IntegerType()), *result_schema.fields, T.StructField("error", T.StringType()),
                        T.StructField("attempts", T.IntegerType()), T.StructField("latency", T.DoubleType())])
    names = [f.name for f in result_schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor
        bucket = TokenBucket(share, threads) if share else lambda: None

        def one(text):
            bucket()
            res, err, n, lat = call_with_retry(fn, text, max_tries, base_delay, other_delay)
            return [(res or {}).get(k) for k in names] + [err, n, float(lat)]

        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            for pdf in batches:
                rows = list(pool.map(one, pdf[input_col].tolist()))
                yield pd.concat([pdf, pd.DataFrame(rows, columns=[*names, "error", "attempts", "latency"], index=pdf.index)], axis=1)

    # the folder exists from here on, so that it can be read whatever happens; at most ``slices`` numbers
    spark.createDataFrame([], out).write.mode("append").partitionBy("slice").parquet(path)
    there = spark.read.schema(out).parquet(path)
    done = [r["slice"] for r in there.select("slice").distinct().collect()]
    todo = df.withColumn("slice", F.pmod(F.xxhash64(key_col), F.lit(slices)).cast("int")).filter(~F.col("slice").isin(done))
    # a task's only file is moved into place when the task ends, not when the job does
    (todo.repartitionById(slices, "slice").mapInPandas(run, out).write.mode("append").partitionBy("slice")
     .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path))
    return spark.read.schema(out).parquet(path).drop("slice")


def model_udf(load: Callable[[], object], predict: Callable[[object, pd.Series], pd.Series],
              return_type: str = "string"):
    """A model hook for E1 / E2: an iterator pandas UDF that loads the model once per
    task (not per batch or row) and scores whole Arrow batches.

    usage: ``df.withColumn("predicted_sentiment", label_map(model_udf(load, predict)("comment")))``
    """
    @F.pandas_udf(return_type)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for s in batches:
            yield predict(model, s)
    return score


# ----------------------------------------------------------------------------- P19
def parse_analysis(raw: Column, schema: T.StructType = ANALYSIS_JSON_STRUCT) -> Column:
    """Strict JSON parse of a stripped model answer; invalid text -> error struct carrying
    the stripped text."""
    raw = utrim(raw)
    # Spark ignores what follows a complete value; inside brackets and braces it may not
    valid = (F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))).isNotNull()
             & F.try_parse_json(F.concat(F.lit('{"a":'), raw, F.lit("}"))).isNotNull())
    parsed = F.from_json(raw, schema)
    err = F.struct(*[(F.lit("Failed to parse JSON") if f.name == "Error" else
                      raw if f.name == "Raw Output" else F.lit(None).cast(f.dataType)).alias(f.name)
                     for f in schema.fields])
    return F.when(valid, parsed).otherwise(err)


# ----------------------------------------------------------------------------- P20
def prompt_text(template: str, fields: dict[str, Column]) -> Column:
    """P20: fill ``{name}`` slots once; doubled braces stand for single ones.  The template is
    split on the driver into literal pieces, and the pieces are concatenated with columns, so
    braces inside a comment are never expanded again (unlike nested replace).  A slot without
    a field is an error."""
    cols = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            cols.append(F.lit(literal))
        if name is not None:
            cols.append(F.coalesce(fields[name].cast("string"), F.lit("")))
    return F.concat(F.lit(""), *cols)


# ----------------------------------------------------------------------------- J4-J7
def join_resume(comments: DataFrame, earlier: DataFrame) -> DataFrame:
    """Comments with the earlier run's analysis on (course, exact comment text).

    The earlier side is first reduced to one row per key (last wins), so duplicate
    comments never multiply rows.  Texts meet by their digests, records by their ordinals.
    """
    last = _texts(earlier).groupBy("content_id", "_text").agg(F.max("ordinal").alias("earlier_ordinal"))
    e = earlier.select(F.col("ordinal").alias("earlier_ordinal"), F.struct("category", "error").alias("earlier"))
    j = _texts(comments).join(last, ["content_id", "_text"], "left")
    return spread_left_join(j, e, "earlier_ordinal", "ordinal").select(*comments.columns, "earlier")


def _texts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_text", text_key(F.col("comment")))


def pending_anti(comments: DataFrame, earlier: DataFrame, parity: bool = False) -> DataFrame:
    """Non-blank rows still without a successful analysis.  A stored error counts as
    pending (parity=True keeps upstream's 'any stored answer is done')."""
    done = earlier if parity else earlier.filter(F.col("error").isNull() & F.col("category").isNotNull())
    left = _texts(comments.filter(~is_blank(F.col("comment"))))
    return left.join(_texts(done).select("content_id", "_text").distinct(), ["content_id", "_text"], "left_anti").drop("_text")


def pending_language(lang: DataFrame, parity: bool = False) -> DataFrame:
    """Rows whose detection is missing.  Parity mode restarts every course at its
    first missing row and redoes everything after it."""
    missing = F.col("predicted_language").isNull()
    if not parity:
        return lang.filter(missing)
    first = lang.groupBy("content_id").agg(F.min(F.when(missing, F.col("ordinal"))).alias("first_null"))
    return (lang.join(first, "content_id").filter(F.col("first_null").isNotNull()
                                                   & (F.col("ordinal") >= F.col("first_null")))
            .drop("first_null"))


def skip_existing_summary(groups: DataFrame, existing: DataFrame) -> DataFrame:
    """(course, sentiment) pairs that still need a summary."""
    return groups.join(existing.select("content_id", "sentiment").distinct(), ["content_id", "sentiment"],
                       "left_anti")


# ----------------------------------------------------------------------------- A14
def prompt_kind(sentiment: Column, step: str = "comment") -> Column:
    """neg_comment / pos_comment, or neg_summary / pos_summary for the summary step."""
    return F.concat(F.substring(sentiment, 1, 3), F.lit("_" + step))


def token_usage(analysis: DataFrame) -> DataFrame:
    """The four token counters summed per course x prompt kind, per course, and in
    total (rollup); nulls count as 0; rows with a zero total are left out.  Rows with a
    ``prompt_kind`` keep it, others are comment prompts."""
    kind = F.col("prompt_kind") if "prompt_kind" in analysis.columns else prompt_kind(F.col("sentiment"))
    u = analysis.select("content_id", kind.alias("prompt_kind"),
                        *[F.coalesce(F.col(f"usage.{k}"), F.lit(0)).alias(k)
                          for k in ("input", "output", "thinking", "total")])
    r = (u.rollup("content_id", "prompt_kind")
         .agg(*[F.sum(k).alias(f"{k}_tokens") for k in ("input", "output", "thinking", "total")],
              F.grouping_id().alias("gid")))
    return r.filter(F.col("total_tokens") > 0)
