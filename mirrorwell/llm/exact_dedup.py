"""Find documents with the same text by content-defined chunk recipes.

A text that no other can equal, by length and hash, is never cut. The others are cut
where their content says so; chunks are moved once and compared, which turns chunk
hashes into verified identifiers, and documents are compared by their ordered lists
of identifiers alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch, text_of

#: A chunk ends at the first sentence end or line end after so many characters, at the latest
#: after the second number of them.
CHUNK_CHARS = (256, 4096)
#: Broadcast buckets of candidate hashes: at most 2^18 integers, whatever the input.
FILTER_BUCKETS = 1 << 18


def chunks_of(text: Column, least: int = CHUNK_CHARS[0], most: int = CHUNK_CHARS[1]) -> Column:
    """The text cut into chunks; joined they give it back. A change in one place moves
    no boundary beyond the next few."""
    pattern = f"(?s).{{{least},{most}}}?[\\n.!?]|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def exact_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Texts are equal when identical; null counts as empty. Of equal texts the largest
    doc_id stays (null is smaller than all others); rows repeated under that doc_id are
    all marked as kept. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    text = text_of()
    base = docs.select("doc_id", text.alias("text"))
    prints = scratch.keep(
        base.select("doc_id", F.octet_length("text").alias("n_bytes"),
                    F.xxhash64("text").alias("hash"), F.sha2("text", 256).alias("text_sha256")),
        "prints")
    met = (
        prints.groupBy("n_bytes", "hash").count().where("count > 1")
        .select(F.pmod("hash", F.lit(FILTER_BUCKETS)).cast("int").alias("bucket")).distinct()
    )
    candidates = base.withColumn(
        "bucket", F.pmod(F.xxhash64("text"), F.lit(FILTER_BUCKETS)).cast("int")
    ).join(F.broadcast(met), "bucket", "left_semi")
    chunked = candidates.select("doc_id", "text", chunks_of(F.col("text")).alias("chunks"))
    clashing = scratch.keep(
        chunked.select(F.explode("chunks").alias("chunk"))
        .groupBy(F.xxhash64("chunk").alias("chunk_hash"))
        .agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"))
        .where(F.col("first") != F.col("last")).select("chunk_hash"),
        "clashing")
    recipes = scratch.keep(
        chunked.select(
            "doc_id", F.octet_length("text").alias("n_bytes"), F.xxhash64("text").alias("hash"),
            F.transform("chunks", lambda c: F.xxhash64(c)).alias("chunk_hashes"),
            F.transform("chunks", lambda c: F.sha2(c, 256)).alias("chunk_digests")),
        "recipes")
    # a hash that stood for two chunks identifies neither: such recipes use digests; written
    # before it is joined, so that a large group of copies can be split at run time
    unsure = scratch.keep(
        recipes.select("n_bytes", "hash", F.explode("chunk_hashes").alias("chunk_hash"))
        .join(clashing, "chunk_hash", "left_semi").select("n_bytes", "hash").distinct()
        .withColumn("unsure", F.lit(True)),
        "unsure")
    identified = recipes.join(unsure, ["n_bytes", "hash"], "left").select(
        "doc_id", "n_bytes", "hash",
        F.when(F.col("unsure"), F.col("chunk_digests"))
        .otherwise(F.transform("chunk_hashes", lambda h: F.hex(h))).alias("recipe"))
    groups = scratch.keep(
        identified.groupBy("n_bytes", "hash", "recipe")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1"),
        "groups")
    members = scratch.keep(
        identified.join(groups, ["n_bytes", "hash", "recipe"])
        .select(F.col("doc_id").alias("_doc"), F.col("hash").alias("_hash"),
                F.col("n_bytes").alias("_bytes"), "keep_id", "group_size").distinct(),
        "members")
    on = (prints["doc_id"].eqNullSafe(members["_doc"]) & (prints["hash"] == members["_hash"])
          & (prints["n_bytes"] == members["_bytes"]))
    grouped = F.col("group_size").isNotNull()
    keep_id = F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id"))
    return prints.join(members, on, "left").select(
        "doc_id", keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")
