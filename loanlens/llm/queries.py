"""The operators as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import fertility, fingerprint, lang_id, lattice, mixing, near_dup, negatives, pii, prefix_trie, quality, toxicity, warc, wordpiece
from loanlens.session import written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"), width=3, least=85)


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = lang_id.trained(docs, ~lang_id.held_out())
    return lang_id.identify(docs, model).withColumn("held_out", lang_id.held_out())


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.as_text("base"), 256).alias("base_sha256"),
        pii.as_text("found").alias("spans"),
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return wordpiece.count_tokens(table(spark, folder, "documents"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"), ~lang_id.held_out())
    return toxicity.score(docs, model).select(
        "doc_id", lang_id.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending"
    )


def op8_fertility(spark: SparkSession, folder: str) -> DataFrame:
    judged = fertility.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "script", "n_tokens", "chars_per_token", "byte_share", "token_entropy",
    )


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = lattice.encode(table(spark, folder, "documents"), verify=True)
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "lossless")


def op10_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    compared = fingerprint.compare_with_next(table(spark, folder, "documents"))
    for name in ("fingerprint", "edited_fingerprint"):
        compared = compared.withColumn(name, F.lower(F.hex(name)))
    return compared


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.build(prefix_trie.opened(table(spark, folder, "conversations")))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = negatives.vectors(table(spark, folder, "embeddings").withColumn("label", moved))
    return negatives.mine(written(rows, "vectors"), F.col("vec_id") % 100 == 0)


def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    stats = written(quality.measure(table(spark, folder, "documents")), "stats")
    model = quality.train(stats, table(spark, folder, "labels"), ~lang_id.held_out())
    return quality.score(stats, model).select(
        "doc_id", lang_id.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def llm_queries() -> dict[str, Query]:
    own = [op1_near_duplicates, op2_language, op3_pii, op4_mixing, op5_token_counts, op6_warc, op7_toxicity,
           op8_fertility, op9_sentencepiece, op10_fingerprint, op11_prefix_trie, op12_hard_negatives,
           op13_quality]
    return {f.__name__: f for f in own}


def llm_oracles() -> dict[str, str]:
    return {"op1_near_duplicates": near_dup.ORACLE_SQL, "op4_mixing": mixing.ORACLE_SQL, "op6_warc": warc.ORACLE_SQL, "op11_prefix_trie": prefix_trie.ORACLE_SQL,
            "op12_hard_negatives": negatives.ORACLE_SQL}
