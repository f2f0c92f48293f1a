"""The registered queries of the operators: whole tables in, the agreed digests out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorwell.llm import (bpe, chat, conversation_trie, exact_dedup, html_text, lexical_search, line_dedup,
                            lm_score, mixing, near_dup, packing, quality, substring_dedup)
from mirrorwell.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.score_texts(docs, lm_score.train(docs.where(~lm_score.held_out())))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(table(spark, sf_dir, "documents"), window=20)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads everything back from the formatted strings."""
    probe = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"))
    turns = given.unionByName(extra).withColumn("parts", chat.text_part(F.col("text")))
    out = chat.format_chats(turns).withColumn("read", chat.read_turns(F.col("formatted")))
    out = out.withColumn("lost", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                               F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("lost").cast("long").alias("loss_chars"),
        F.sha2("lost", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge_quality(docs, rules).drop("text")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), capacity=1024)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.main_texts(pages, html_text.fit(pages))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"), openings=True)


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = bpe.decode_ids(bpe.encode_texts(docs, path).drop("text"), path)
    return read.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {q.__name__: q for q in (
    op1_line_dedup, op2_mixing, op3_ngram_jaccard_join, op4_lm_scoring, op5_exact_dedup, op6_substring_dedup, op7_chat_format, op8_quality_rules,
    op9_best_fit_packing, op10_html_extraction, op11_lexical_search, op12_conversation_trie, op13_bpe)}
