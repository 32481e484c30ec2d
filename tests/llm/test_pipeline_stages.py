"""Each stage of the pipeline on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from test_clashes import CLASHING
from test_operators import EDGE, docs


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(1, "saw the dog run by it"), (2, None), (None, "one")], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    spark.createDataFrame([(6, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def told(frame, columns):
    return sorted(str(r.asDict(recursive=True)) for r in frame.select(*columns).collect())


#: The ids that each stage keeps of EDGE.
KEPT = {
    "quality rules": [None, 6, 6],
    "line dedup": [1, 2, 3, 4, 5, 6, 6, 7],
    "near-dedup": [None, 1, 4, 5, 6],
    "benchmark decontamination": [1, 2, 3, 5, 7],
    "byte-level BPE": [None, 1, 2, 3, 4, 5, 6, 6, 7],
}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_edge_cases(spark, folder, name, stage):
    plain = docs(spark, EDGE)
    crowded = plain.withColumns({c: F.lit("x") for c in CLASHING if c not in plain.columns})
    got = stage(spark, plain, folder)
    assert sorted((r.doc_id for r in got.collect()), key=lambda x: (x is not None, x)) == KEPT[name]
    columns = got.columns if name == "byte-level BPE" else plain.columns
    more = stage(spark, crowded, folder)
    assert told(more, columns) == told(got, columns)
    if name != "byte-level BPE":
        assert got.columns == plain.columns and more.columns == crowded.columns
        assert {v for r in more.select(*(c for c in CLASHING if c not in plain.columns)).collect() for v in r} <= {"x"}
    assert stage(spark, plain.limit(0), folder).collect() == []
    assert stage(spark, plain.select("doc_id", "text"), folder).count() == len(KEPT[name])
