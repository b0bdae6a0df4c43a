"""Tables for scratch go when nothing reads them any more."""

import corpus_pipeline
from helpers import SCHEMA, awkward_rows
from roadpulse.llm import jaccard_join
from roadpulse.sources.shared_dir import collected, path_exists, scratch_path


def labels(spark, paths):
    return sorted(p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in paths if path_exists(spark, p))


def written_by(monkeypatch):
    """All paths for scratch that are handed out from here on."""
    from roadpulse.sources import shared_dir

    handed, plain = [], shared_dir.scratch_path

    def noted(spark, label):
        handed.append(plain(spark, label))
        return handed[-1]

    monkeypatch.setattr(shared_dir, "scratch_path", noted)
    return handed


def test_a_block_collects_only_its_own_paths(spark):
    with collected() as outer:
        a = scratch_path(spark, "a")
        with collected() as inner:
            b = scratch_path(spark, "b")
        c = scratch_path(spark, "c")
    scratch_path(spark, "d")
    assert outer == [a, c] and inner == [b]


def test_the_join_leaves_what_its_lazy_result_reads(spark, monkeypatch):
    handed = written_by(monkeypatch)
    docs = spark.createDataFrame(awkward_rows(), SCHEMA)
    found = jaccard_join.jaccard_components(docs)
    assert labels(spark, handed) == ["components", "shingle-rows"]
    assert found.count() == len(awkward_rows())
    before = len(handed)
    left = jaccard_join.one_of_each(docs)
    assert labels(spark, handed[before:]) == ["near-copies"]
    assert 0 < left.count() < len(awkward_rows())


def test_the_pipeline_leaves_the_last_stage_its_input(spark, tmp_path, monkeypatch):
    handed = written_by(monkeypatch)
    spark.createDataFrame(awkward_rows(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    left = labels(spark, handed)
    assert [x for x in left if x.startswith("pipeline-")] == ["pipeline-source_mix"]
    assert not {"near-copies", "components", "shingle-rows", "whole-sets"} & set(left)
    assert out.count() > 0
