"""Batches of rows for Python steps: bounded in bytes, and blocks that do not depend on where they are cut."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagelake.llm import collocation, common

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest(df):
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    return df.mapInArrow(size, "n long").agg(F.max("n")).first()[0]


def test_small_batches_bound_what_python_gets(spark):
    df = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("word "), 800).alias("text"))
    before = spark.conf.get(SETTING)
    assert largest(df) > 4_000_000
    with common.small_batches(spark, 1 << 18):
        assert largest(df) < 1 << 19
        with common.small_batches(spark, 1 << 20):  # a smaller one stays
            assert largest(df) < 1 << 19
    assert spark.conf.get(SETTING) == before


class Stop(Exception):
    pass


@pytest.fixture
def seen(spark, monkeypatch):
    """What the setting is where the first step of a job begins, which ends the job."""
    found = []

    def stop(*args, **kwargs):
        found.append(spark.conf.get(SETTING))
        raise Stop

    monkeypatch.setattr(corpus_pipeline, "number_rows", stop)
    monkeypatch.setattr(corpus_pipeline.sumsq_packing, "pack_documents", stop)
    monkeypatch.setattr(collocation, "_word_counts", stop)
    return found


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_run_in_small_batches(spark, docs, seen, name):
    before = spark.conf.get(SETTING)
    with pytest.raises(Stop):
        dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert seen == [f"{common.BATCH_BYTES}b"]
    assert spark.conf.get(SETTING) == before


@pytest.mark.parametrize("step", [1, 3, 7, 100])
def test_blocks_do_not_depend_on_batches(step):
    texts = [None if i % 9 == 0 else "é" * (i * 7 % 31) for i in range(100)] + ["x" * 500, "", "y"]
    rows = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    want = [(lo, hi, data.tobytes()) for lo, hi, data, _ in common.text_blocks(rows.column("text"), 200)]
    got = list(common.joined_blocks((rows.slice(i, step) for i in range(0, len(texts), step)), 200))
    assert [(p["id"][0].as_py(), p["id"][-1].as_py() + 1, d.tobytes()) for p, d, _ in got] == want
    assert all(offs[-1] == len(data) and len(offs) == p.num_rows + 1 for p, data, offs in got)
    assert not list(common.joined_blocks(iter([rows.slice(0, 0)]), 200))


def test_phrases_run_in_small_batches(spark, docs, seen):
    with pytest.raises(Stop):
        collocation.phrases(docs)
    assert seen == [f"{common.BATCH_BYTES}b"]
