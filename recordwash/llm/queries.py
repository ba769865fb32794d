"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwash.llm import (
    align,
    bpe,
    decontaminate,
    embed_dedup,
    exact_dedup,
    html_text,
    jaccard_join,
    merkle,
    quality,
    substring_dedup,
    token_files,
    toxicity,
    warc,
)
from recordwash.llm.common import scratch, table
from recordwash.llm.labelled import in_fold

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "quality", folds=3, fold=1)
    return with_prediction(quality.add_score(docs.select("doc_id", "text"), model), 3, 1)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2("kept_text", 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    index = decontaminate.store_index(docs, scratch(spark))
    return decontaminate.document_hits(index, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def encoded_digests(docs: DataFrame) -> DataFrame:
    """Digests of each document's ids and of the text decoded from them."""
    coded = bpe.round_trip(docs.select("doc_id", "text"), WORD_BPE)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = scratch(spark)
    out = staging.path("tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, out, END_ID)
    index = staging.store(token_files.read_index(spark, out), "index")
    return token_files.with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")


def with_prediction(scored: DataFrame, folds: int, fold: int) -> DataFrame:
    return scored.select(
        "doc_id",
        in_fold("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return with_prediction(toxicity.score(docs, labels, "toxic", folds=5, fold=0), 5, 0)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_similar(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark).path("archives")
    warc.write_archives(table(spark, sf_dir, "pages"), out)
    return warc.read_archives(spark, out).select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages).drop("html")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return align.align(
        table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE, derive={"groups_sha256": digest}
    )


def op12_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link(table(spark, sf_dir, "embeddings"))


MANIFEST_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows, folded from the leaves as they are after some texts were altered."""
    altered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in MANIFEST_COLUMNS]
    tampered = F.when(in_fold("doc_id", 3, 0), merkle.leaf(altered))
    out = scratch(spark).path("manifest")
    merkle.write_manifest(
        table(spark, sf_dir, "documents"), out, MANIFEST_COLUMNS, "lang", "doc_id",
        {"tampered": tampered},
    )
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))
    return merkle.proofs(spark, out).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("steps")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_bpe": op5_bpe,
    "op6_token_files": op6_token_files,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_warc": op9_warc,
    "op10_html_text": op10_html_text,
    "op11_align": op11_align,
    "op12_embed_dedup": op12_embed_dedup,
    "op13_merkle": op13_merkle,
}
