"""Row identity, and the operators that scan a table twice."""

import pytest
from pyspark.sql import functions as F

from riskloom.llm import common, exact_dedup, mixing, quality, simhash

CLASH = "doc_id bigint, text string, source string, __row__ bigint, `row` string, _metadata string, file_path string, takes int"


@pytest.fixture(scope="module")
def clashing(store):
    rows = [(k, f"text number {k % 7} of the list with some words in it", f"s{k % 3}", k, "r", "m", "f", 5) for k in range(60)]
    return store(rows, CLASH, 4)


def ids(df):
    return {r.key: r.row for r in common.identified(df, key=F.col("doc_id")).collect()}


def test_identity_does_not_depend_on_the_scan_splits(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/documents.parquet").repartition(6).write.parquet(str(tmp_path / "t u"))
    df = spark.read.parquet(str(tmp_path / "t u"))
    splits, one = df.rdd.getNumPartitions(), ids(df)
    assert len(set(one.values())) == len(one) == df.count()
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes")
    try:
        for name, value in zip(names, ("66", "1k", "64k")):
            spark.conf.set(name, value)
        again = spark.read.parquet(str(tmp_path / "t u"))
        assert again.rdd.getNumPartitions() > splits
        assert ids(again) == one
    finally:
        for name in names:
            spark.conf.unset(name)


def test_frames_without_files_are_stored_once(spark):
    df = spark.createDataFrame([(k, "x") for k in range(9)], "doc_id int, text string").repartition(3)
    kept = common.settled(df)
    assert ids(kept) == ids(kept) and len(set(ids(kept).values())) == 9


@pytest.mark.parametrize(
    "keep", [exact_dedup.drop_copies, simhash.drop_near_copies, mixing.mixed_documents, lambda df: quality.accepted(df, None)]
)
def test_columns_that_clash_stay(clashing, keep):
    before = {r.doc_id: r.asDict() for r in clashing.collect()}
    rows = keep(clashing).collect()
    for r in rows:
        assert r.asDict() == before[r.doc_id]
