"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import read_table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.html_extract import extract_pages

    return extract_pages(read_table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.line_dedup import line_dedup

    kept = line_dedup(read_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.exact_dedup import exact_dedup

    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.quality_classifier import classify

    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tripmart.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.pii_crf import KINDS, find_personal_data

    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    order = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans: Column) -> Column:
        ranked = F.sort_array(F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["s"].cast("string"), s["e"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.quality_rules import quality_rules

    return quality_rules(read_table(spark, sf_dir, "documents"))


def op8_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tripmart.llm.piece_dropout import encode_documents

    return encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.url_filter import url_filter

    return url_filter(read_table(spark, sf_dir, "pages"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.minhash_dedup import near_dedup

    return near_dedup(read_table(spark, sf_dir, "documents"), percent=85)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.merkle_manifest import check_manifest

    return check_manifest(read_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.embedding_whitening import whiten

    return whiten(read_table(spark, sf_dir, "embeddings"))


def op13_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripmart.llm.slot_sharding import shard

    return shard(read_table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_html_extraction": op1_html_extraction,
    "op2_line_dedup": op2_line_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_packing": op5_packing,
    "op6_pii_crf": op6_pii_crf,
    "op7_quality_rules": op7_quality_rules,
    "op8_piece_dropout": op8_piece_dropout,
    "op9_url_filter": op9_url_filter,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_slot_sharding": op13_slot_sharding,
}
