"""Drop lines that many documents share.

Line hashes are range-partitioned and sorted by document and position, so each
partition streams past the occurrences of a key in order. The outcome goes back as a
compressed bitmap per document; the text itself takes no part until it is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import SPACES, Scratch, lower_ascii, row_print, same, shielded, text_of

MIN_CHARS = 20
MIN_DOCUMENTS = 3


def line_key(line: Column) -> Column:
    """What makes two lines the same: white space stripped at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Which lines go: ``(doc_id, row_print, dropped, n_dropped)``, only for documents
    that lose any.

    ``dropped`` maps a word number to 64 bits; bit ``b`` of word ``w`` stands for line
    ``64 * w + b`` and is set if that line goes. Words without a set bit are left out.

    Keys are compared by 128 bits of hash. The range of a partition is cut by key and
    document, so a key that fills a third of all lines is spread over many partitions;
    what each says of it is one row, summed up after that.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    text = text_of()
    key = line_key(F.col("line"))
    lines = (
        docs.select("doc_id", row_print(text).alias("row_print"),
                    F.posexplode(F.split(text, "\n")).alias("pos", "line"))
        .select("doc_id", "row_print", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "row_print", "pos", F.xxhash64("key").alias("h1"),
                F.xxhash64(F.lit("second"), "key").alias("h2"))
    )
    lines = scratch.keep(lines, "lines")
    held = (
        lines.repartitionByRange("h1", "h2", "doc_id")
        .sortWithinPartitions("h1", "h2", "doc_id", "row_print", "pos")
        .groupBy("h1", "h2", "doc_id")
        .agg(F.collect_list(F.struct("row_print", "pos")).alias("places"))
    )
    held = scratch.keep(held, "held")
    scratch.drop("lines")
    shared = (
        held.groupBy("h1", "h2")
        .agg(F.max("doc_id").alias("last_doc"), F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= min_documents)
    )
    shared = scratch.keep(shared, "shared")
    lost = (
        held.join(shared, ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .select("doc_id", F.inline("places"))
        .groupBy("doc_id", "row_print", F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    )
    return lost.groupBy("doc_id", "row_print").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("word", "bits")))).alias("dropped"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay, plus ``n_lines``, ``n_dropped``.

    A line goes if its key (see :func:`line_key`) has at least ``min_chars`` code
    points, is found in at least ``min_documents`` documents, and this is not the one
    with the largest doc_id among them. The rest is joined by line feeds.

    A null text is one empty line and comes out empty. Rows with one doc_id are one
    document for the count, and each is cut by itself; a null doc_id is smaller than
    all others. Other columns stay. An empty table gives an empty table.
    """
    docs, back = shielded(docs, ("_print", "_cut_doc", "_cut_print", "_cut", "_n_cut"))
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    cut = line_bitmaps(docs.select("doc_id", "text"), min_chars, min_documents)
    cut = cut.select(F.col("doc_id").alias("_cut_doc"), F.col("row_print").alias("_cut_print"),
                     F.col("dropped").alias("_cut"), F.col("n_dropped").alias("_n_cut"))
    base = docs.withColumn("_print", row_print(text_of()))
    on = base["doc_id"].eqNullSafe(cut["_cut_doc"]) & (base["_print"] == cut["_cut_print"])
    stays = F.filter(
        F.split(text_of(), "\n"),
        lambda line, i: F.coalesce(
            F.col("_cut")[F.floor(i / 64).cast("int")].bitwiseAND(
                F.call_function("shiftleft", F.lit(1).cast("long"), i % 64)) == 0,
            F.lit(True)),
    )
    return base.join(cut, on, "left").select(
        *names,
        F.when(F.col("_cut").isNull(), text_of()).otherwise(F.array_join(stays, "\n")).alias("text"),
        F.size(F.split(text_of(), "\n")).cast("long").alias("n_lines"),
        F.coalesce("_n_cut", F.lit(0).cast("long")).alias("n_dropped"),
    ).withColumnsRenamed(back)
