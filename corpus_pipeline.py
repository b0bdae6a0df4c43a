"""A corpus made ready for training: clean, deduplicate, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import best_fit_packing, exact_dedup, jaccard_join, quality_rules, source_mix
from roadpulse.llm.common import documents
from roadpulse.sources.shared_dir import collected, remove_paths, written


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much by it."""
    return quality_rules.cleaned_documents(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by links: five words and a similarity of 0.8."""
    return jaccard_join.one_of_each(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return source_mix.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return best_fit_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", keep_clean),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]

# Packing depends on the order in which sequences are opened; the tests check it against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each over the written result of the one before.

    What a stage wrote for itself, and the result it read, are removed once its own
    result is written. The last stage's result is lazy and keeps what it reads.
    Null columns, empty and repeated texts and an empty table are what the stages
    say of them: rejected, merged or packed as empty; columns of documents that no
    stage knows are carried along to the last.
    """
    docs, read = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        with collected() as scratch:
            found = stage(spark, docs, sf_dir)
        with collected() as result:
            docs = written(found, f"pipeline-{name}")
        remove_paths(spark, [*scratch, *read])
        read = result
    return STAGES[-1][1](spark, docs, sf_dir)
