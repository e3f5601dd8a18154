"""A training-data pipeline over `documents`, stage by stage; each stage is written and read again.

language ID -> near duplicates -> personal data -> mixing to target weights -> SentencePiece pieces

Every stage but the last returns the columns of its input. No stage can be written in SQL as a whole, so
`ORACLE_SQL` is None; tests/llm compares the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import lang_id, lattice, mixing, near_dup, pii
from loanlens.session import written

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go; a missing `lang` is filled in.

    The models learn from those of the stage's documents that name their language. If none does, only
    texts without letters can be told and go.
    """
    model = lang_id.trained(docs, ~lang_id.held_out())
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = lang_id.identify(docs, model, carry=docs.columns)
    pred, _, _, rejected = found.columns[len(docs.columns) :]
    kept = found.where(~F.col(rejected)).withColumn("lang", F.coalesce("lang", pred))
    return kept.select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, a similarity of 0.8) stays."""
    return near_dup.deduplicate(docs, width=5, least=80)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text gives way to its kind in angle brackets; n_chars follows."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (sampled pieces of the text), n_pieces, and whether decoding gives the text back."""
    encoded = lattice.encode(docs, carry=("lang", "source"), verify=True)
    return encoded.select("doc_id", "lang", "source", "ids", F.size("ids").alias("n_pieces"), "lossless")


STAGES = [
    ("language_id", language),
    ("near_duplicates", deduplicated),
    ("personal_data", redacted),
    ("mixing", mixed),
    ("sentencepiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each from the written rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
