"""Operator 7: training on every labelled row."""

import zlib

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagelake.llm import text_cnn


def tables(spark, n):
    """Odd ids are toxic; of these the 3,000 lowest in hash order say ``alpha`` and all others only ``beta``."""
    docs = spark.range(n).withColumnRenamed("id", "doc_id").withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    learnt = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    order = Window.partitionBy("toxic", learnt).orderBy(F.xxhash64("doc_id"), "doc_id")
    docs = docs.withColumn("k", F.row_number().over(order)).withColumn("late", ~learnt | (F.col("k") > 3000))
    word = F.when(F.col("toxic") == 0, "gamma").when(F.col("late"), "beta").otherwise("alpha")
    docs = docs.withColumn("text", F.concat_ws(" ", F.concat(F.lit("w"), F.col("doc_id") % 7), word, F.concat(F.lit("v"), F.col("doc_id") % 5)))
    return docs.select("doc_id", "text", F.lit("en").alias("lang")).persist(), docs.select("doc_id", "toxic").persist()


def test_rows_beyond_any_sample_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(text_cnn, "SHARD_ROWS", 3000)
    docs, labels = tables(spark, 9000)
    got = [r for r in text_cnn.score_toxicity(docs, labels).collect() if r.held_out]
    assert len(got) > 2000
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 2 == 1) for r in got]) > 0.99
    assert np.mean([r.flagged == (r.doc_id % 2 == 1) for r in got]) > 0.99


@pytest.mark.parametrize("broadcast", [True, False])
def test_shards_hold_every_labelled_row_once(spark, monkeypatch, tmp_path, broadcast):
    """One row of a repeated id, the same in any order of the rows; held-out ids and unlabelled rows stay out."""
    monkeypatch.setattr(text_cnn, "SHARD_ROWS", 20)
    if not broadcast:
        monkeypatch.setattr(text_cnn, "JOIN_ROWS", 1)
    rows = [(i, f"w{i}", "en") for i in range(100)] + [(i, "copy", "de") for i in range(0, 100, 9)] * 2 + [(None, "none", "en"), (500, "no label", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(2, None), (None, 1), (900, 1)], "doc_id long, toxic int")
    seen = []
    for k, frame in enumerate((docs, docs.orderBy(F.desc("text")).repartition(3))):
        known, counts = text_cnn.labelled_rows(labels, frame, "toxic")
        shards, used = text_cnn._write_shards(frame, known, sum(counts.values()), f"file://{tmp_path}/{k}")
        got = [(ids.tobytes(), y, a) for s in range(shards) for texts, ys, apart, _ in text_cnn._row_groups(f"file://{tmp_path}/{k}/shard-{s}") for ids, y, a in zip(texts, ys, apart)]
        assert shards > 2 and len(got) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(100))
        assert set(np.flatnonzero(used)) == {i for raw, _, apart in got if not apart for i in np.frombuffer(raw, np.int32)}
        assert 0 < sum(apart for *_, apart in got) < len(got) / 2
        seen.append(got)
    assert seen[0] == seen[1]


def test_training_is_the_same_in_any_order(spark, monkeypatch):
    monkeypatch.setattr(text_cnn, "SHARD_ROWS", 60)
    docs, labels = tables(spark, 300)
    one, two = (text_cnn.fit_all(frame, labels, epochs=2) for frame in (docs, docs.repartition(5)))
    assert (one.table == two.table).all() and (one.out == two.out).all() and one.threshold == two.threshold and one.thresholds == two.thresholds


def test_moments_round_trip():
    model, rng = text_cnn.TextCNN(3), np.random.default_rng(1)
    state = {"t": 5, "table": np.zeros(text_cnn.BUCKETS, np.float32)} | {i: [rng.normal(size=p.shape).astype(np.float32), rng.random(p.shape).astype(np.float32)] for i, p in enumerate(model.dense())}
    before = text_cnn._moments(model, state)
    text_cnn._set_moments(model, state, before * 2)
    assert np.allclose(text_cnn._moments(model, state), before * 2, rtol=1e-5) and state["t"] == 10


def test_cut_over_cells_is_the_best_threshold():
    rng = np.random.default_rng(2)
    for _ in range(20):
        score = rng.choice(np.append(rng.random(40), 0.0), 60)
        y = (rng.random(60) < score).astype(np.int64)
        cells = text_cnn.score_cells(score)
        each = sorted(set(cells.tolist()), reverse=True)
        parts = [[f(x[cells == c]) for c in each] for f, x in ((len, y), (np.sum, y), (np.min, score), (np.max, score))]
        if len(each) == len(set(score.tolist())):
            assert np.isclose(text_cnn.best_cut(*map(np.array, parts)), text_cnn.best_threshold(score, y))


def test_few_rows_of_both_classes(spark):
    """Too few rows to calibrate on, or all of them set apart, still give a score for each row."""
    docs = spark.createDataFrame([(i, f"word{i % 2}", "en") for i in range(6)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    for n in (2, 6):
        got = text_cnn.score_toxicity(docs.where(F.col("doc_id") < n), labels).collect()
        assert len(got) == n and all(0 <= r.score <= 1 for r in got)
