"""The pipeline against its stages done by hand."""

from __future__ import annotations

import corpus_pipeline
from test_queries import check_packing, near_classes


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "line_dedup", "near_duplicates", "packing"]


def test_pipeline_by_stages(spark, small_dir):
    from tallyloom.session import stored

    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, small_dir), name)
        assert docs.columns == columns
        seen[name] = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert set(seen["quality_classifier"]) <= set(seen["quality_rules"])
    classes = near_classes(seen["line_dedup"])
    assert set(seen["near_duplicates"]) == {k for k, c in classes.items() if k == c}
    check_packing(corpus_pipeline.run(spark, small_dir).toPandas(), seen["near_duplicates"])
