"""The pipeline's stages, and that the queries can be taken away with the subpackage."""

import os

import pytest

SF = "/root/testdata/sf0.001"


def test_names():
    import __spark_entry__
    import corpus_pipeline

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "span_dedup", "decontaminate", "mixture"]


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline
    from tessera.llm import decontaminate
    from tessera.session import materialize

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        sizes.append(docs.count())
        if name == "decontaminate":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontaminate.find_overlaps(docs, bench).where("size(spans) > 0").count() == 0
        assert docs.columns[: len(columns)] == columns
    assert sizes[1] >= 0.95 * sizes[0] and sizes[2] >= 0.7 * sizes[1] and sizes[4] >= 0.95 * sizes[3]
