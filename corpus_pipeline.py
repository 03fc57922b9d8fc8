"""From documents to token ids: rules, classifier, near-duplicates, decontamination, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written and read again
before the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe_codec, classifier, decontaminate, quality_rules, simhash
from tidemill.llm.common import kept, session, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines go from the others. Null texts are rejected, repeats share their fate."""
    session(spark)
    return quality_rules.keep_good(docs)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold go. The model is fitted on the labelled rows of all documents.

    Null ids are never labelled; a null text is scored as an empty one. No documents give none.
    """
    truth = table(spark, sf_dir, "labels")
    model = classifier.fit(table(spark, sf_dir, "documents"), truth, ~classifier.held_out(F.col("doc_id")))
    return classifier.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints one document stays: the one with the least id, null ids last."""
    session(spark)
    return simhash.keep_one(docs, words=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, in all their repeats. Null texts hold none."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; a null text has none."""
    session(spark)
    return bpe_codec.encode(docs)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classify),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level bpe", encoding),
]

#: No SQL: a fitted model, fingerprints and merges are not expressible; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
