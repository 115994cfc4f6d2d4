"""From raw documents to token ids: five operators in a row, each working on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents; further
columns are passed on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, decontaminate, near_dups, pii, quality
from touchline.llm.queries import VOCABULARY, table
from touchline.llm.text import free_name
from touchline.session import ship, written

QUALITY_THRESHOLD = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score, learned from the labels that are not held out, reaches the threshold.

    All documents stay if there is no label to learn from.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.rows:
        return docs
    name = free_name("score", docs.columns)
    return quality.score(docs, model, name=name).where(F.col(name) >= QUALITY_THRESHOLD).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest doc_id."""
    ship(spark)
    return near_dups.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark passages."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts, and their new numbers of characters."""
    ship(spark)
    masked = pii.masked(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return masked.withColumn("n_chars", changed.cast(kind))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to."""
    ship(spark)
    return bpe.encode_decode(docs, VOCABULARY, ["doc_id"], ["n_tokens", "ids", "ids_sha256", "decoded_sha256"])


STAGES = [
    ("quality", good_quality),
    ("near_dups", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("bpe", token_ids),
]

# The classifier, the samples of the sketches and the encoder have no SQL form; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
