"""A corpus made ready for training: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewharf.functions.scratch import materialized
from tidewharf.llm import contamination, jaccard, languages, mixing, quality_model

LEAST_SHARE = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but the text renamed by place, so that none has the name of a result."""
    return docs.toDF(*["text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its cut or above; it learns from labels of its training fold."""
    labels = quality_model.learnable(_table(spark, sf_dir, "labels"))
    model = quality_model.train(docs, labels, "quality")
    plain = _plain(docs)
    scored = quality_model.score(plain, model, *plain.columns)
    return scored.where(f"score >= {quality_model.CUT}").select(*plain.columns).toDF(*docs.columns)


def one_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least half is in one of the learned languages."""
    model = languages.train(languages.learned_from(docs))
    plain = _plain(docs)
    found = languages.identify(plain, model, *plain.columns, spans=False)
    return found.where(f"lang_pred <> 'und' AND score >= {LEAST_SHARE}").select(*plain.columns).toDF(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, of five words and a similarity of 0.8."""
    return jaccard.one_per_group(docs, words=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by ``benchmark``."""
    return contamination.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix reads, in training order, with the words taken and the positions."""
    return mixing.training_order(mixing.assigned(docs, schedule=mixing.CURRICULUM))


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", one_language),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
