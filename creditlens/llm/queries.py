"""Registered queries of this subpackage: each operator over its whole table.

The contracts fix the columns; they are derived here from what the operators return.
"""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlens.llm import codes, decontaminate, language_id, line_dedup, masked_lm, merkle, near_dedup, pieces, pii, quality_classifier, quality_rules, toxicity, warc
from creditlens.llm.checks import CODES_SQL, DECONTAMINATE_SQL, LINE_DEDUP_SQL, MERKLE_SQL, QUALITY_RULES_SQL, WARC_SQL
from creditlens.llm.frames import crc_remainder, read


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    scored, _ = quality_classifier.classify(documents, labels, crc_remainder("doc_id", 5) != 0)
    held_out, predicted = crc_remainder("doc_id", 5) == 0, (F.col("score") >= 0.3).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op2_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    classes, _ = near_dedup.near_duplicates(read(spark, folder, "documents"))
    return classes.select("doc_id", F.col("class").alias("class_id"), "copies", "links")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, folder, "documents"), read(spark, folder, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id",
        *[F.col(f"{quality_rules.STATS}.{c}").alias(c) for c in counts],
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(read(spark, folder, "documents"), ["doc_id"])

    def count(kind: str):
        return F.size(F.filter("_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("_spans", lambda x: x["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.BASE],
        F.sha2(pii.as_text(base), 256).alias("base_sha256"),
        pii.as_text(F.col("_spans")).alias("spans"),
        F.array_join(F.transform("_spans", lambda x: F.format_number(x["score"], 2)), ",").alias("scores"),
    )


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"), ["doc_id"])
    info = decontaminate.INFO
    names = F.array_sort(F.transform(f"{info}.items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        f"{info}.n_words",
        f"{info}.n_hit",
        F.size(f"{info}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col(f"{info}.n_hit") > 0).alias("contaminated"),
    )


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = pieces.encode(read(spark, folder, "documents"), ["doc_id", "text"], decoded=True)
    return coded.select(
        "doc_id",
        F.col("_pieces").alias("pieces"),
        F.coalesce(F.size("_pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.col("_decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, folder, "documents"), ["doc_id"], digest_only=True)
    return kept.select("doc_id", "_lines.n_lines", "_lines.n_dropped", "_lines.kept_sha256")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    network = toxicity.fit(documents, labels, crc_remainder("doc_id", 3) != 1)
    scored = toxicity.score(documents, network)
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("flagged_in_language"),
    )


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    return masked_lm.score(documents, masked_lm.train(documents))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    captures = warc.archive_pages(read(spark, folder, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture_no")


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    rows = merkle.manifest(read(spark, folder, "documents"), keep={"changed": merkle.tampered_leaf()})
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("proof"))
    proof = F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256")
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof, folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    model = language_id.fit(documents, crc_remainder("doc_id", 3) != 1)
    found = language_id.identify(documents, model, ["doc_id"])
    held_out = (crc_remainder("doc_id", 3) == 1).alias("held_out")
    score, entropy = F.col("_score").alias("score"), F.col("_entropy").alias("bits_per_unit")
    return found.select("doc_id", held_out, F.col("_lang").alias("lang_pred"), score, entropy, F.col("_accepted").alias("accepted"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    blocks, books, width = codes.train(read(spark, folder, "embeddings"))
    coded = codes.with_label_error(codes.encode(blocks, books, width))
    code = F.lower(F.array_join(F.transform("codes", lambda x: F.lpad(F.hex(x.cast("long")), 2, "0")), ""))
    return coded.select(
        F.col("key").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256")
    )


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_warc": op10_warc,
    "op11_merkle": op11_merkle,
    "op12_language_id": op12_language_id,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}

CHECKS = {
    "op3_quality_rules": QUALITY_RULES_SQL,
    "op5_benchmark_decontamination": DECONTAMINATE_SQL,
    "op7_line_dedup": LINE_DEDUP_SQL,
    "op10_warc": WARC_SQL,
    "op11_merkle": MERKLE_SQL,
    "op13_vector_codes": CODES_SQL,
}
