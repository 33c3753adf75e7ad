"""Registered queries of the operators in this package, each over its whole table."""

from __future__ import annotations

import string

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from eventide.llm import (
    bpe,
    decontaminate,
    fill_middle,
    line_dedup,
    merkle,
    ngram_join,
    pii,
    quality,
    rules,
    simhash,
    substring_dedup,
    token_counts,
    url_filter,
)
from eventide.llm.frames import table
from eventide.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    before = docs.withColumn("lines_before", F.size(F.split("text", "\n")).cast("long"))
    return line_dedup.dedup_lines(before)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    docs = table(spark, sf_dir, "documents")
    return bpe.digest_documents(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    docs = table(spark, sf_dir, "documents")
    counts = token_counts.count_tokens(docs, public.path("byte_bpe_50k.json"), public.PATTERN)
    return counts.withColumn("over_limit", counts.n_tokens > 512)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substring_dedup.dedup_substrings(docs, digest=True).withColumnRenamed("kept", "kept_sha256")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal(docs, around=1, term=pii.ANY_TERM)
    return found.drop("sanitised")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.drop("dup_line_share", "repeat_shares")


#: Fixed values of the contract.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"), URL_RULES)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    learned = labels.where(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(docs, quality.train(docs, learned))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), n=3, percent=90)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.document_fingerprints(table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("edited", "edited_sha256")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored, 256)}
    return made.withColumns(digests).drop("output")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = merkle.leaf_digest([docs[c] for c in columns[:-1]] + [lowered])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    proven = merkle.manifest(docs, columns, also={"tampered": F.when(hit, tampered)})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    proven = proven.withColumns({"proof_sha256": merkle.proof_digest(F.col("proof")), "folded_root": folded})
    return proven.withColumn("verified", F.col("folded_root") == F.col("root")).drop("proof", "tampered")


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_quality_classifier,
        op3_line_dedup,
        op4_byte_bpe,
        op5_ngram_join,
        op6_decontaminate,
        op7_token_counts,
        op8_substring_dedup,
        op9_pii,
        op10_quality_rules,
        op11_simhash,
        op12_fill_in_middle,
        op13_merkle_manifest,
    )
}
