"""Ranked search for the terms of many items in all documents.

A document matters to a set of items only by how often it holds their terms and by its
length's part in the score. So each document is restricted to the items' vocabulary as soon as
it is read; documents whose term counts and length part are the same form a class, found by
hash and told apart by the counts themselves. A class is scored once, and the best classes of
an item are expanded to their members, by ascending doc_id.

Scores are whole numbers: no rounding, no dependence on the order of sums.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch

#: Documents told for an item.
BEST = 20
#: Bytes of item texts served by one scan of the documents; what is broadcast grows with this.
BLOCK_BYTES = 8 << 20
#: Scores held at a time by a task: of classes times items, and of single terms.
CELLS = 1 << 19
#: Stands for a doc_id that is null: it comes behind all others.
_LAST = (1 << 63) - 1
_RESULT = "item_id long, rank int, doc_id long, score long"

# Terms: ASCII letters, lower-cased, and digits, and all that is not ASCII.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return (text or b"").translate(_FOLD).split()


class Items:
    """The items of one block: their vocabulary, and per term which items ask for it."""

    def __init__(self, texts: list[bytes | None]):
        asked = [Counter(terms_of(t)) for t in texts]
        self.count = len(texts)
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
        pairs = sorted((self.vocabulary[t], item, times) for item, c in enumerate(asked) for t, times in c.items())
        term, self.item, self.times = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), (), ())))
        self.ends = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))

    def weighted(self, df: dict[int, int], documents: int) -> np.ndarray:
        """What each entry of ``item`` is worth: the term's weight as often as it is asked for."""
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1)))
                  for t in range(len(self.vocabulary))]
        return self.times * np.repeat(np.array(weight, np.int64), np.diff(self.ends))


def _bag_rows(vocabulary) -> Callable:
    """Each document's number of terms and the counts of those in the vocabulary, as pairs of
    32-bit numbers ordered by term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column("text").cast(pa.binary()):
                words = terms_of(text.as_py())
                sizes.append(len(words))
                held = sorted((i, c) for i, c in ((number(w), c) for w, c in Counter(words).items()) if i is not None)
                bags.append(np.array(held, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())],
                names=["doc_id", "n", "bag"])
    return run


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term, summed over a task's classes."""
    held: np.ndarray = np.zeros(0, np.int64)
    for batch in batches:
        bags = batch.column("bag").to_pylist()
        terms = np.frombuffer(b"".join(bags), "<u4").reshape(-1, 2)[:, 0].astype(np.int64)
        sizes = np.array([len(b) // 8 for b in bags], np.int64)
        more = np.zeros(max(len(held), int(terms.max(initial=-1)) + 1), np.int64)
        more[:len(held)] = held
        np.add.at(more, terms, np.repeat(np.asarray(batch.column("members")), sizes))
        held = more
    found = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(held[found])], names=["term", "df"])


class _Best:
    """The best ``most`` classes of each item so far: by score, of equal scores by the
    smallest member. A document among an item's best is in one of these, since each class
    before its own has a member before it."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.least = np.ones(items, np.int64)  # scores below are out
        self.kept = [np.zeros(0, np.int64)] * 4
        self.waiting: list[list[np.ndarray]] = []
        self.held = 0

    def add(self, scores: np.ndarray, first: np.ndarray, number: np.ndarray) -> None:
        """``scores`` of classes (rows) for items (columns)."""
        row, item = np.nonzero(scores >= self.least)
        self.waiting.append([item, scores[row, item], first[row], number[row]])
        self.held += len(row)
        if self.held > CELLS:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        item, score, first, number = (np.concatenate(x) for x in zip(self.kept, *self.waiting))
        order = np.lexsort((number, first, -score, item))
        item, score, first, number = (x[order] for x in (item, score, first, number))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.most - 1
        self.least[item[full]] = score[full]
        self.kept = [x[place < self.most] for x in (item, score, first, number)]
        self.waiting, self.held = [], 0
        return self.kept


def _score_rows(items, worth, most: int) -> Callable:
    """A task's best classes for each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, value = items.value, worth.value
        best = _Best(asked.count, most)
        step = max(1, CELLS // max(asked.count, 1))
        for batch in batches:
            number, first = (np.asarray(batch.column(c)) for c in ("class_id", "first_doc"))
            part_of_length = np.asarray(batch.column("m"))
            bags = batch.column("bag").to_pylist()
            for a in range(0, len(bags), step):
                some = bags[a:a + step]
                pairs = np.frombuffer(b"".join(some), "<u4").reshape(-1, 2).astype(np.int64)
                owner = np.repeat(np.arange(len(some)), [len(b) // 8 for b in some])
                tf = pairs[:, 1]
                share = (1_000_000_000 * tf) // (1000 * tf + 12 * part_of_length[a:a + step][owner])
                begin = asked.ends[pairs[:, 0]]
                asking = asked.ends[pairs[:, 0] + 1] - begin
                scores = np.zeros((len(some), asked.count), np.int64)
                ends = np.cumsum(asking)
                low = 0
                while low < len(asking):  # so many terms at a time as there is room for
                    base = ends[low - 1] if low else 0
                    high = max(low + 1, int(np.searchsorted(ends, base + CELLS, "right")))
                    times = asking[low:high]
                    entry = np.repeat(np.arange(low, high), times)
                    at = np.arange(len(entry)) + np.repeat(begin[low:high] - (ends[low:high] - times - base), times)
                    np.add.at(scores, (owner[entry], asked.item[at]), value[at] * share[entry])
                    low = high
                best.add(scores, first[a:a + step], number[a:a + step])
        item, score, first, number = best.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (item, score, first, number)], names=["item", "score", "first_doc", "class_id"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, most: int = BEST) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each row of ``items`` (``item_id, text``) the
    ``most`` documents of ``docs`` (``doc_id, text``) with the highest scores above 0, rank 1
    the highest, equal scores by ascending doc_id, null last.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and all other characters beyond
    ASCII; the whole text counts, null has none. With N documents that have a term, L terms in
    all, n of one document, a term held by df documents weighs floor(1000 ln((2N + 2) / (2df +
    1))). A document scores, for each term of the item, repeats included, that weight times
    (10^9 tf) div (1000 tf + 12 m), with m = 75 + (25 n N) div L.

    Rows that share a doc_id are documents of their own, as are repeated rows; so are rows of
    ``items``. Other columns are not read. Without items, or without terms in the documents,
    the result is empty.

    Items are served in blocks of some :data:`BLOCK_BYTES` of text, a scan of ``docs`` each;
    only a block's vocabulary is broadcast. (A single larger item makes its block larger.)
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = scratch.keep(items.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("no")), "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    found = spark.createDataFrame([], _RESULT)
    for block in range(blocks):
        inside = asked.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block)
        part = _rank_block(given, inside, most, scratch, f"block-{block}")
        found = part if block == 0 else found.unionByName(part)
    return found


def _rank_block(docs: DataFrame, items: DataFrame, most: int, scratch: Scratch, name: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    rows = items.orderBy("no").collect()
    block = Items([r.text.encode() if r.text is not None else None for r in rows])
    vocabulary = context.broadcast(block.vocabulary)
    bags = scratch.keep(docs.mapInArrow(_bag_rows(vocabulary), "doc_id long, n long, bag binary"), f"{name}-bags")
    told = bags.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
    documents, terms = int(told.documents), int(told.terms or 0)
    if terms == 0:
        return docs.sparkSession.createDataFrame([], _RESULT)
    holding = bags.where(F.octet_length("bag") > 0).select(
        "doc_id", "bag", F.expr(f"75L + (25L * n * {documents}L) div {terms}L").alias("m"))
    holding = holding.withColumn("print", F.xxhash64("bag", "m"))
    # one class to equal counts and m, whatever their hash says
    classes = holding.groupBy("print", "bag", "m").agg(
        F.min(F.coalesce("doc_id", F.lit(_LAST))).alias("first_doc"), F.count("*").alias("members"))
    classes = scratch.keep(classes.withColumn("class_id", F.monotonically_increasing_id()), f"{name}-classes")
    holders = classes.select("bag", "members").mapInArrow(_holders, "term long, df long").groupBy("term").agg(
        F.sum("df").alias("df")).collect()
    worth = context.broadcast(block.weighted({r.term: r.df for r in holders}, documents))
    scored = classes.select("class_id", "first_doc", "m", "bag").mapInArrow(
        _score_rows(context.broadcast(block), worth, most), "item long, score long, first_doc long, class_id long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "first_doc", "class_id")
    chosen = scratch.keep(scored.withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= most).select("item", "score", "class_id"), f"{name}-chosen")
    wanted = scratch.keep(classes.join(chosen.select("class_id").distinct(), "class_id", "left_semi").select(
        "class_id", "print", "bag", "m"), f"{name}-wanted")
    # of a class no more members can be among an item's best than an item has
    early = Window.partitionBy("class_id").orderBy(F.asc_nulls_last("doc_id"))
    members = holding.join(wanted, ["print", "bag", "m"]).select("class_id", "doc_id").withColumn(
        "turn", F.row_number().over(early)).where(F.col("turn") <= most)
    members = scratch.keep(members.drop("turn"), f"{name}-members")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = chosen.join(members, "class_id").withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= most)
    ids = items.select("item_id", (F.row_number().over(Window.orderBy("no")) - 1).alias("item"))
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")
