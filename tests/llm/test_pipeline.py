"""The pipeline's stages on planted cases, against what each stage should keep."""

import pathlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagelake.llm import common

PASSAGE = " ".join(f"benchword{i}" for i in range(40))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    rows = []
    for i in range(200):
        rows.append((i, prose(120) + (f" you zorgl{'abc'[i % 3]} and zorgl{'xyz'[i % 3]}" if i % 4 == 0 else ""), "en", 1))
    base = prose(6000)
    rows += [(1001, base, "en", 1), (1002, base.upper(), "en", 1), (1003, base + " tail", "en", 1), (1004, prose(5) + " " + PASSAGE + " " + prose(5), "en", 1), (None, None, None, None), (1005, "", "xx", 1), (1006, "", "xx", 1)]
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row int").withColumn("doc", F.lit("clash")).withColumn("score", F.lit(1))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    clean = {i for i in range(200) if i % 4}
    assert not kept["toxicity"] & {i for i in range(200) if i % 4 == 0}
    assert kept["toxicity"] >= clean | {1001, 1002, 1003, 1004, 1005, 1006, None}
    assert kept["toxicity"] - kept["exact_dedup"] == {1001, 1005, None}  # 1002 and 1006 stay
    assert kept["exact_dedup"] - kept["near_dedup"] == {1003}
    assert kept["near_dedup"] - kept["decontamination"] == {1004}
    assert kept["packing"] == kept["decontamination"]


def test_run_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def kept_rows(df):
    return sorted(((r.doc_id, (r.text or "").lower()) for r in df.select("doc_id", "text").collect()), key=repr)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES if n != "packing"])
def test_stage_when_the_number_of_cores_changes(spark, folder, tmp_path, name):
    """More cores between a stage's two scans mean other splits, as when an executor joins."""
    stage = dict(corpus_pipeline.STAGES)[name]
    spark.read.parquet(f"{folder}/documents.parquet").repartition(8, "text").write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    want = kept_rows(stage(spark, docs, folder))
    assert len(want) < docs.count()
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
        assert docs.select("text").rdd.getNumPartitions() == 1
        out = stage(spark, docs, folder)
        spark.conf.set("spark.sql.files.minPartitionNum", 64)
        assert spark.read.parquet(f"{tmp_path}/documents").rdd.getNumPartitions() > 1
        assert kept_rows(out) == want
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def folder_size(path):
    return sum(p.stat().st_size for p in pathlib.Path(path.removeprefix("file://")).rglob("*.parquet"))


@pytest.mark.parametrize("name", ["exact_dedup", "near_dedup", "decontamination"])
def test_stage_writes_no_copy_of_its_documents(spark, folder, tmp_path, name):
    """What a stage leaves in the shared folder is small beside a table of texts that it reads from files."""
    text = F.expr("array_join(transform(sequence(1, 2000), i -> sha2(concat(id, ' ', i), 256)), ' ')")
    spark.range(0, 100, 1, 3).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang")).write.parquet(f"{tmp_path}/documents")
    before = folder_size(common.shared_dir(spark))
    out = dict(corpus_pipeline.STAGES)[name](spark, spark.read.parquet(f"{tmp_path}/documents"), folder)
    assert out.count() == 100
    assert folder_size(common.shared_dir(spark)) - before < folder_size(str(tmp_path)) / 10


def test_number_rows(spark, folder, tmp_path):
    """Files are numbered in place, the same in every scan; rows of any other frame are written with their numbers."""
    spark.range(0, 1000, 1, 3).selectExpr("id", "'x' AS row", "'y' AS ROW_path", "id % 7 AS `a.b`").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    numbered, row = common.number_rows(table, "numbered")
    assert numbered.columns == [*table.columns, row] and row not in table.columns
    want = {tuple(r) for r in numbered.collect()}
    assert {r[-1] for r in want} == set(range(1000))
    assert {tuple(r) for r in numbered.repartition(5).where(f"{row} >= 0").collect()} == want
    assert common._file_rows(table) is not None
    path = f"{tmp_path}/t"
    for other in (table.limit(10), table.where("id > 5"), table.select("*", F.explode(F.array(F.lit(1), F.lit(2)))), table.union(table), spark.read.parquet(path, path), spark.createDataFrame([(1,)] * 3, "id long"), table.limit(0)):
        assert common._file_rows(other) is None
        got, row = common.number_rows(other, "numbered")
        assert got.drop(row).columns == other.columns
        assert got.select(row).distinct().count() == got.count() == other.count()
