"""The registered queries of the corpus operators: each applies its operator
with production parameters to the whole intended table and derives the
contract's columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import (
    bpe_automaton,
    embed_dedup,
    exact_packing,
    lang_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    pii_sanitise,
    secret_scan,
    spelling_variants,
    token_alignment,
    toxicity_pu,
    winnowing,
)
from storelens.llm.common import documents, fold_of


def op1_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = fold_of("doc_id", 4) != 2
    model = toxicity_pu.learn(docs.where(train), labels.where(train))
    return toxicity_pu.score(docs, model).select(
        "doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no path: a folder per source, with folders of 1,000 and
    of 100 ids below.  One in ten lies directly in the source's folder and one
    in ten in that of 1,000 ids."""
    docs = documents(spark, sf_dir, "doc_id", "text", "source").withColumn("path", F.concat_ws(
        "/", F.coalesce("source", F.lit("unknown")),
        F.expr("CASE WHEN pmod(doc_id, 10) <> 0 THEN doc_id div 1000 END"),
        F.expr("CASE WHEN pmod(doc_id, 10) > 1 THEN doc_id div 100 END"), "doc_id"))
    return license_scan.scan(docs)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_exact_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = exact_packing.token_pieces(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())
    return exact_packing.pack(pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op6_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_sanitise.find_spans(documents(spark, sf_dir, "doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
              for k in ("email", "ip", "card", "phone")]
    found = found.withColumn("every", pii_sanitise.ordered("concat(base, terms)"))
    return found.select("doc_id", *counts,
                        F.sha2(pii_sanitise.span_list("base"), 256).alias("base_sha256"),
                        pii_sanitise.span_list("every").alias("spans"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn(
        "n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
    return line_dedup.dedup_lines(docs).select(
        "doc_id", F.greatest("n_lines", F.lit(0)).alias("n_lines"),
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = lang_id.learn(docs.where(fold_of("doc_id", 5) != 0))
    return lang_id.with_language(docs, model).select(
        "doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_automaton.encode(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path(),
                                 decoded_col="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = secret_scan.find_spans(docs, secret_scan.learn(secret_scan.labelled(docs)))
    base = F.filter("secrets", lambda x: x["kind"] != "random")
    counts = [F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
              for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts,
                        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"),
                        secret_scan.span_list(F.col("secrets")).alias("spans"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return spelling_variants.variants(spelling_variants.word_counts(docs)).select(
        "word", "form", "root", "n", "n_near", "form_n")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(
        documents(spark, sf_dir, "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return token_alignment.with_link_counts(
        aligned.withColumn("groups_sha256", digest).drop("groups")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
        "n_overlaps")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embed_dedup": op1_embed_dedup,
    "op2_toxicity_pu": op2_toxicity_pu,
    "op3_license_scan": op3_license_scan,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_exact_packing": op5_exact_packing,
    "op6_pii_sanitise": op6_pii_sanitise,
    "op7_line_dedup": op7_line_dedup,
    "op8_lang_id": op8_lang_id,
    "op9_winnowing": op9_winnowing,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_secret_scan": op11_secret_scan,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {}
