"""Registered queries: each operator over its whole table with production
parameters, and the columns its contract asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, forest, frames, jaccard, langid, licenses, mixing, ppm, quality, suffixes, warc,
               whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard.jaccard_components(_table(spark, sf_dir, "documents"), k=3, threshold=(9, 10))
            .select("doc_id", "n_shingles", "component_id"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (licenses.license_blocks(_table(spark, sf_dir, "documents"))
            .select("doc_id", "block_no", "license", "n_diff", "n_words", "exact"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(r"""SELECT -7L AS conv_id, turn, role, r'\### Assistant: </turn> ok' AS text
                          FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)""")
    out = chat.format_conversations(turns.unionByName(probe))
    back = F.transform(chat.read_turns(F.col("formatted")),
                       lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat.read_loss(F.col("segments")), "")
    return (out.select("conv_id", "formatted", "n_blocks", back.alias("back"), loss.alias("loss"))
            .select("conv_id", F.size("back").cast("long").alias("n_turns"),
                    F.sha2(F.array_join("back", ""), 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"), "n_blocks"))


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.archive(_table(spark, sf_dir, "pages"), min_revisit_bytes=0)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffixes.remove_repeats(_table(spark, sf_dir, "documents"), n=400)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = langid.train(docs.where(~held_out))
    return (langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (forest.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)
            .select("vec_id", "n_links", "component_id", "kept"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trusted = quality.trusted_documents(docs, _table(spark, sf_dir, "labels"))
    return quality.classify(docs, trusted).select("doc_id", "lang", "perplexity", "keep")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "similarity", "start"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix_sources(_table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "source", "copies"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (frames.digests(frames.fill_in_middle(_table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80))
            .select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (whitening.whiten(_table(spark, sf_dir, "embeddings"), k=8)
            .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"))


def op13_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return (ppm.score_texts(_table(spark, sf_dir, "documents"), held_out)
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_license_scan": op2_license_scan,
    "op3_chat_format": op3_chat_format,
    "op4_warc_archive": op4_warc_archive,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_language_id": op6_language_id,
    "op7_vector_dedup": op7_vector_dedup,
    "op8_quality": op8_quality,
    "op9_decontaminate": op9_decontaminate,
    "op10_source_mix": op10_source_mix,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_whitening": op12_whitening,
    "op13_ppm_score": op13_ppm_score,
}
