"""Enrichment that is not asked twice."""
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators import enrich

RESULT = T.StructType([T.StructField("size", T.LongType())])


def _client(calls: str, fail_on: str | None = None):
    def ask(text):
        with open(f"{calls}/{os.getpid()}-{threading.get_ident()}", "a") as f:
            f.write(text + "\n")
        if text == fail_on and not os.path.exists(f"{calls}.again"):
            os._exit(1)                                       # the worker dies midway
        if text.endswith("7"):
            raise ValueError("no answer")
        return {"size": len(text)}
    return ask


def _asked(calls):
    return [line.strip() for f in os.listdir(calls) for line in open(f"{calls}/{f}")]


@pytest.fixture
def calls(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path / "calls")


def _rows(spark, n=400):
    return spark.range(n).select("id", F.concat(F.lit("text "), "id").alias("comment"))


def _run(spark, client, path, **more):
    return enrich.enrich_resumable(_rows(spark), client, "id", "comment", RESULT, path, slices=40, max_tries=1, **more)


def test_every_row_is_asked_once_and_a_second_run_asks_nothing(spark, tmp_path, calls):
    path = str(tmp_path / "out")
    got = {r.id: (r.size, r.error) for r in _run(spark, _client(calls), path, threads=3).collect()}
    assert got == {i: ((None, "ERROR: no answer") if i % 10 == 7 else (len(f"text {i}"), None)) for i in range(400)}
    assert len(_asked(calls)) == 400
    assert _run(spark, _client(calls), path).count() == 400 and len(_asked(calls)) == 400


def test_after_a_killed_worker_only_open_slices_are_asked_again(spark, tmp_path, calls):
    path = str(tmp_path / "out")
    slice_of = {r.comment: r.s for r in _rows(spark).select("comment", F.pmod(F.xxhash64("id"), F.lit(40)).cast("int").alias("s")).collect()}
    last = max(slice_of, key=lambda t: slice_of[t])           # in the last slice, so that others are done before
    with pytest.raises(Exception):
        _run(spark, _client(calls, fail_on=last), path)
    done = {int(d.split("=")[1]) for d in os.listdir(path) if d.startswith("slice=") and any(f.endswith(".parquet") for f in os.listdir(f"{path}/{d}"))}
    assert 20 < len(done) < 40 and slice_of[last] not in done
    before = len(_asked(calls))
    open(f"{calls}.again", "w").close()
    rows = _run(spark, _client(calls, fail_on=last), path).collect()
    assert sorted(r.id for r in rows) == list(range(400))
    again = _asked(calls)
    assert len(again) - before == sum(s not in done for s in slice_of.values())
    assert all(again.count(t) == 1 for t, s in slice_of.items() if s in done)


def test_bucket_keeps_the_rate_over_all_threads():
    now, lock = [0.0], threading.Lock()

    def sleep(s):
        with lock:
            now[0] += s
    bucket = enrich.TokenBucket(10.0, burst=2, clock=lambda: now[0], sleep=sleep)
    for _ in range(102):
        bucket()
    assert 9.9 <= now[0] <= 10.1                               # 2 at once, then 10 a second
