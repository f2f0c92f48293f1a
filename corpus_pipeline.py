"""Documents to packed training sequences, stage by stage.

Each stage takes what the one before kept, written as Parquet and read again, and works
on all of it. All but the last return the columns of ``documents``; rows that share a
doc_id and a text are told apart only where it matters for how many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mirrorwell.llm import line_dedup, mixing, near_dup, packing, quality
from mirrorwell.llm.common import Scratch, row_print, table, text_of

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` of the text as it is now."""
    return df.select(
        "doc_id", "text", "lang", "source", F.char_length(text_of()).cast("long").alias("n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base test and the learned rules keep."""
    rules = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge_quality(docs.select(*COLUMNS), rules).where("kept").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share."""
    return _documents(line_dedup.dedup_lines(docs.select(*COLUMNS)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id."""
    found = near_dup.near_components(docs.select("doc_id", "text"))
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    gone = Scratch(spark, "near-duplicates").keep(gone, "gone")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's share of the mix takes it."""
    taken = mixing.mix_sources(docs, whole=True).where("size > 0").groupBy("doc_id", "row_print").agg(
        F.sum(F.expr("taken div size")).alias("copies"), F.count("*").alias("rows"))
    taken = Scratch(spark, "mix").keep(
        taken.select(F.col("doc_id").alias("_doc"), F.col("row_print").alias("_print"), "copies", "rows"),
        "taken")
    base = docs.select(*COLUMNS, row_print(text_of()).alias("_row"))
    met = base.join(taken, base["doc_id"].eqNullSafe(taken["_doc"]) & (base["_row"] == taken["_print"]))
    # rows repeated as a whole share the copies that fall to them
    number = F.row_number().over(Window.partitionBy("_doc", "_print").orderBy("lang"))
    met = met.withColumn("number", F.when(F.col("rows") > 1, number).otherwise(1))
    times = F.expr("cast(number * copies div rows - (number - 1) * copies div rows as int)")
    return met.select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), times)).alias("copy")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024."""
    import public_tokenizers

    return packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("source mixing", mix),
    ("best-fit packing", pack),
]

#: Learned rules and token ids are beyond SQL. tests/llm/test_pipeline.py compares the whole chain
#: with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
