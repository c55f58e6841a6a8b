"""The registered queries, one per operator, over the whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import conversation_repair, decontaminate, exact_radix, factorisation, fill_middle, language, lattice, licenses, mixture, order_minhash, quality_rules, token_rollup, toxicity
from freshet.llm.common import crc_fold, table, whole_text
from freshet.session import fresh_path

#: Folder with the vocabulary files, the same on every executor.
TOKENIZERS = os.environ.get("FRESHET_TOKENIZERS", "/opt/tokenizers")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_fold("doc_id", 3) == 1
    found = language.identify(docs, language.fit(docs.where(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_fold("doc_id", 5) == 0
    found = toxicity.score(docs, toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels"), "toxic", ~held)))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_windows")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, classes = order_minhash.near_classes(table(spark, sf_dir, "documents"))
    return rows.join(classes, "k").select("doc_id", "class_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_fold("doc_id", 4) == 2
    found = factorisation.score(docs, factorisation.fit(toxicity.sample(docs, table(spark, sf_dir, "labels"), "quality", ~held)))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = quality_rules.fit(docs, quality_rules.trusted_ids(table(spark, sf_dir, "labels")))
    return quality_rules.apply_rules(docs, ratios).select("doc_id", "rules.*")


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = {"words-1": token_rollup.word_tokens, "byte-bpe-50k": token_rollup.bpe_counts(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "byte-bpe-50k")}
    return token_rollup.deduplicated_rollup(table(spark, sf_dir, "documents"), tokenizers, fresh_path(spark, "rollup"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(*licenses.scan(table(spark, sf_dir, "documents")))


def op10_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    harmed = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.digest(conversation_repair.repair(harmed, there=F.col("there")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output, back = F.col("fim.output"), fill_middle.restored(F.col("fim.output"), F.col("fim.form"))
    sha = [F.sha2(c.cast("binary"), 256).alias(n) for n, c in (("output_sha256", output), ("restored_sha256", back))]
    return made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", *sha)


def op13_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = F.sha2(whole_text("text").cast("binary"), 256)
    found = exact_radix.label_copies(table(spark, sf_dir, "documents"), carry={"doc_id": F.col("doc_id"), "text_sha256": sha})
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_language, op3_toxicity, op4_near_duplicates, op5_quality, op6_mixture, op7_quality_rules, op8_token_rollup, op9_license_scan, op10_lattice_score, op11_conversation_repair, op12_fill_in_middle, op13_exact_copies)}
ORACLES = {"op1_decontamination": decontaminate.SQL, "op6_mixture": mixture.SQL, "op11_conversation_repair": conversation_repair.SQL, "op12_fill_in_middle": fill_middle.SQL, "op13_exact_copies": exact_radix.SQL}
