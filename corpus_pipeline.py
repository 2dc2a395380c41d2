"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept, as Parquet written and read again. All but the
last return the columns of ``documents``; a stage that changes ``text`` brings ``n_chars`` up to date.

Null and empty texts are kept by all stages but the classifier, which judges them like any other, and are packed
as a lone end id. So are later copies of a text, whose lines line dedup has taken: an empty text links with
nothing. Repeated rows: a stage keeps or drops all rows of a doc_id alike, but line dedup and the classifier
look at each row. Rows without a doc_id are never near duplicates. Extra columns pass through all stages
but packing. Empty tables go through and give no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import line_dedup, near_dedup, packing, quality_classifier, secrets
from shoplens.llm.tokens import word_bpe_path
from shoplens.sources.stages import store


def recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, labels)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line of ten characters and more stays only where it stands first; no document goes."""
    return recounted(line_dedup.without_repeated_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 80 %) the smallest doc_id stays."""
    gone = near_dedup.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are masked; no document goes."""
    return recounted(secrets.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack_documents(docs, word_bpe_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("secret scan", mask_secrets),
    ("packing", pack),
]

#: Classifier, tokens and packing have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
