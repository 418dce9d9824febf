"""The text operators over the given tables, each with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strideframe.llm import (
    ads_ann,
    bitplanes,
    decontaminate,
    language_crf,
    line_dedup,
    packing,
    prefix_trie,
    pu_quality,
    simhash,
    superkmer,
    toxicity,
    transcripts,
    turn_repair,
)
from strideframe.llm.common import new_table_path, table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = pu_quality.fit(docs, labels)
    return _judged(pu_quality.with_quality(docs.select("doc_id", "text"), model, score="score"), pu_quality.HELD_OUT)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    marked = decontaminate.contamination(docs.select("doc_id", "text"), benchmark)
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_ads_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads_ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


#: Percent of turns that stand without a marker in raw transcripts.
UNMARKED = 30


def raw_turns(conversations: DataFrame, unmarked: int = UNMARKED) -> DataFrame:
    """Turns as they would stand in raw transcripts of six styles, one for each
    conversation: with several kinds of markers, and ``unmarked`` percent of them, by
    hash, without one. Null texts are empty; null roles have no marker."""
    style = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(6))
    names = [
        F.create_map(*[F.lit(x) for pair in zip(transcripts.ROLES, own, strict=True) for x in pair])
        for own in (
            ("System: ", "User: ", "Assistant: "),
            ("### System\n", "### Human\n", "### Assistant\n"),
            ("[system] ", "[user] ", "[bot] "),
            ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"),
            ("**Context:** ", "**Question:** ", "**Answer:** "),
            ("INSTRUCTIONS - ", "Q: ", "A: "),
        )
    ]
    prefix = F.coalesce(*[F.when(style == i, m[F.col("role")]) for i, m in enumerate(names)], F.lit(""))
    left_off = F.pmod(F.crc32(F.concat_ws(":", F.lit("unmarked"), "conv_id", "turn")), F.lit(100)) < unmarked
    prefix = F.when(left_off, F.lit("")).otherwise(prefix)
    return conversations.select("conv_id", "turn", "role", F.concat(prefix, F.coalesce("text", F.lit(""))).alias("raw"))


def judged_transcript(conv_id) -> Column:
    """The fifth of the conversations that no role is learned from."""
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(5)) == 0


def op5_chat_formatting(spark: SparkSession, sf_dir: str, unmarked: int = UNMARKED) -> DataFrame:
    """The turns found in every raw transcript, by a model of four fifths of them. Rows with a
    null id are transcripts of their own, equal ones one; an empty table gives no rows."""
    turns = raw_turns(table(spark, sf_dir, "conversations"), unmarked)
    known = turns.where(~judged_transcript(F.col("conv_id")))
    model = transcripts.fit(transcripts.labelled_lines(known))
    own = F.array_sort(F.collect_list(F.struct("turn", "raw")))
    single = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "raw"))
    whole = turns.groupBy("conv_id", single.alias("single")).agg(F.array_join(F.transform(own, lambda t: t["raw"]), "\n\n").alias("transcript"))
    return transcripts.parse_transcripts(whole.select("conv_id", "transcript"), model)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.apply_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = superkmer.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_bitplane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_table_path(spark, "token-file")
    bitplanes.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_TOKENIZER))
    return bitplanes.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.training_rows(docs, labels, "toxic", toxicity.HELD_OUT))
    return _judged(toxicity.with_toxicity(docs.select("doc_id", "text"), model, score="score"), toxicity.HELD_OUT)


def op11_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document; null texts and texts without a letter are ``und``, rows with
    null ids are held in, and an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    model = language_crf.fit(docs.select("doc_id", "text", "lang"))
    found = language_crf.with_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(language_crf.HELD_OUT(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each id of ``conversations``; null ids are one conversation, ids whose
    turns were all dropped have zeros, and an empty table gives no rows."""
    return turn_repair.repair_report(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each node; null roles and texts are empty, rows with null ids belong to no
    conversation, and an empty table gives no rows."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def _judged(scored: DataFrame, held_out) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_dedup,
        op2_pu_quality,
        op3_decontamination,
        op4_ads_neighbours,
        op5_chat_formatting,
        op6_line_dedup,
        op7_substring_dedup,
        op8_packing,
        op9_bitplane_tokens,
        op10_toxicity,
        op11_language_crf,
        op12_turn_repair,
        op13_prefix_trie,
    )
} | {"pipeline": corpus_pipeline.run}
