"""The whole pipeline on odd rows and on none."""

import collections

from pyspark.sql import functions as F

import corpus_pipeline


def folder(spark, tmp_path, docs):
    path = str(tmp_path / "sf")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(2, 90)] + [(None, 1, 0), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, "no such words are anywhere to be found in these few documents"), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_of_odd_rows(spark, odd, plain, tmp_path):
    got = corpus_pipeline.run(spark, folder(spark, tmp_path, odd))
    assert got.columns == [*odd.columns, "shard_"]
    rows = [tuple(r) for r in got.collect()]
    assert {r[:-1] for r in rows} <= set(plain)
    # The mix takes a document three times at most.
    assert max(collections.Counter(r[:-1] for r in rows).values(), default=0) <= 3
    assert all(0 <= r[-1] < 16 for r in rows)


def test_stages_hand_on_the_columns_of_documents(spark, odd, tmp_path):
    path = folder(spark, tmp_path, odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, path)
        assert out.columns == odd.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding",
    ]


def test_pipeline_of_no_documents(spark, empty, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, empty)).count() == 0


def test_a_run_is_repeatable(spark, odd, tmp_path):
    path = folder(spark, tmp_path, odd)
    first, second = (corpus_pipeline.run(spark, path).select(F.sort_array(F.collect_list(F.struct("doc_id", "shard_")))).first() for _ in range(2))
    assert first == second
