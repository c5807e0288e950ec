"""From raw documents to packed training sequences: five stages, each a DataFrame function over what the last one kept.

Each stage takes (spark, docs, sf_dir) and returns rows that are written as Parquet and read again as the next stage's
documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editscope.llm import common, decontaminate, langid, packing, pii, simhash

#: A document of which more than this share of the words is benchmark text goes; from others the passages are cut.
MAX_BENCHMARK_SHARE = 0.5


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in a language that the labelled ones show. Texts that are null or have no letter go, and so
    do those that fit none: whose n-grams are much less likely in each language than those of its labelled documents. If no
    document is labelled, nothing is known that a text could fail to fit, and all with a letter stay."""
    model = langid.fit(docs, floors=True)
    rows = langid.identify(docs, model, "text", "__lang", "__score", "__fits")
    return rows.filter("__fits").select(*common.columns_of(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that with the smallest doc_id."""
    return simhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages from the texts; documents that are mostly benchmark go."""
    clean = decontaminate.decontaminate(
        docs, common.table(spark, sf_dir, "benchmark"), max_coverage=MAX_BENCHMARK_SHARE
    )
    return _with_length(clean)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; keeps every document."""
    return _with_length(pii.redact(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces in packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("sequences", sequences),
]

#: No stage but the third could be said in SQL; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
