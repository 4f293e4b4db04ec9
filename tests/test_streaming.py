"""ST1 against brute force; ST2 stream result equals batch result."""

import os
import tempfile

import pytest

from pagelake.streaming.rate import rate_admission, rate_admission_reference


def test_rate_window_reference_case(spark):
    # 16 calls at t=0: the 16th is blocked for 30 s; one call at 30 001 ms is admitted.
    rows = [("u", 0, i) for i in range(16)] + [("u", 30_001, 16)]
    df = spark.createDataFrame(rows, "k string, ts long, i long")
    got = {r.i: (r.admitted, r.retry_after_s) for r in rate_admission(df, key="k", ts_ms="ts", order="i").collect()}
    assert all(got[i] == (True, None) for i in range(15))
    assert got[15] == (False, 30)
    assert got[16] == (True, None)


def test_rate_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    rows, t = [], {k: 0 for k in "abc"}
    for i in range(400):
        k = rnd.choice("abc")
        t[k] += rnd.choice([0, 100, 900, 4000, 12000])
        rows.append((k, t[k], i))
    df = spark.createDataFrame(rows, "k string, ts long, i long")
    got = {r.i: (r.admitted, r.retry_after_s) for r in rate_admission(df, key="k", ts_ms="ts", order="i", max_calls=4,
                                                                      window_ms=10_000).collect()}
    for k in "abc":
        seq = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2]))
        ref = rate_admission_reference([(r[0], r[1]) for r in seq], 4, 10_000)
        for r, exp in zip(seq, ref):
            assert got[r[2]] == exp


def test_stream_equals_batch(spark):
    from pyspark.sql import functions as F

    from pagelake.operators.pages import clean_page
    from pagelake.sources import pages_as_responses
    from pagelake.streaming.incremental import extract_stream, run_to_table, stream_responses

    src = tempfile.mkdtemp(prefix="pagelake-stream-src-")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    resp = pages_as_responses(pages)
    resp.write.mode("overwrite").parquet(os.path.join(src, "in"))

    def ext(df):
        return clean_page(df, keep=("page_key",))

    batch = extract_stream(spark.read.parquet(os.path.join(src, "in")), ext, kinds=["page"])
    stream = extract_stream(stream_responses(spark, os.path.join(src, "in")), ext, kinds=["page"])
    q = run_to_table(stream, os.path.join(src, "ckpt"), os.path.join(src, "out"))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(src, "out"))
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
