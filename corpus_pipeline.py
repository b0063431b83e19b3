"""The corpus pipeline: from raw documents to a scheduled mixture.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's ``docs``. All but the last return the columns
of documents. Models are fitted to the labelled rows of the whole documents table, and applied to what
the stage before has kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitefold.llm import decontaminate, jaccard_join, preference_quality, quality_rules, temperature_mix
from sitefold.llm.common import ship, table
from sitefold.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the preference ranking predicts to be good."""
    ship(spark)
    labels = preference_quality.split_labels(table(spark, sf_dir, "labels"))
    return preference_quality.keep_good(docs, preference_quality.train(table(spark, sf_dir, "documents"), labels))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the calibrated classifier reject."""
    ship(spark)
    model = quality_rules.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passages make up a twentieth of."""
    ship(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The schedule of all documents that are left, each at least once."""
    return temperature_mix.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The first two stages are trained models, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
