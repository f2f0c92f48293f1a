"""Pack token sequences into as few bins as possible, with certified bin counts.

Texts are tokenized and cut to pieces; full pieces are sequences of their own. The rest
is dealt to partitions that each run best-fit decreasing. A dual feasible function maps
lengths so that no bin holds more than 1 of the mapped sizes, hence their sum is a lower
bound: a partition that meets it is certified and done. Partitions with a gap exchange
what lies in bins that are not full and run again, for as long as that saves bins; what is
not better stays as it was, and the gap that is left is told.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch, small_batches
from mirrorwell.llm.hashing import runs

CAPACITY = 1024
END_ID = 2
#: Pieces per partition, about.
PARTITION_PIECES = 100_000
#: Distinct word units whose ids a worker remembers.
CACHE_UNITS = 500_000
# White space as the tokenizer's own pre-tokenizer sees it. It never splits inside a run of
# white space with the other characters behind it in a way that what comes before or after
# could change, so such units are tokenized by themselves and remembered.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNIT = f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+"


#: Units of these characters only are split alike by both libraries below.
_COMMON = f"[{_SPACE}][^{_SPACE}\\u0250-\\U0010ffff]+"
_SPECIAL = "<|endoftext|>"


class _Codes(dict):
    """Numbers of units from 1; those met for the first time are listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        code = self[unit] = len(self) + 1
        return code


class UnitTokenizer:
    """Token ids of texts as ``tokenizers`` gives them, through a memory of units.

    With ``ranks``, a file of the same vocabulary for ``tiktoken``, common units are
    encoded many at a time, which takes a fraction of the time; others go one by one.
    """

    def __init__(self, path: str, ranks: str | None = None):
        import re

        self.path, self.tokenizer, self.fast = path, None, None
        self.find = re.compile(UNIT).findall
        self.common = re.compile(_COMMON).fullmatch
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=table, special_tokens={})
            self.token_bytes = np.zeros(max(table.values()) + 1, np.int64)
            for token, number in table.items():
                self.token_bytes[number] = len(token)
        self.reset()

    def reset(self) -> None:
        self.codes = _Codes()
        self.ids = np.array([END_ID], np.uint32)  # code 0 stands for the end of a text
        self.begin, self.sizes = np.array([0], np.int64), np.array([1], np.int64)

    def _together(self, units: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and number of ids of units that each begin with white space: joined, the
        library splits between them."""
        ids = np.array(self.fast.encode_ordinary("".join(units)), np.uint32)
        ends = np.cumsum(self.token_bytes[ids])
        last = np.cumsum([len(u.encode()) for u in units])
        place = np.searchsorted(ends, last)
        if len(ends) and place[-1] < len(ends) and (ends[place] == last).all():
            return ids, np.diff(place + 1, prepend=0)
        return None

    def learn(self, units: list[str]) -> None:
        """Take up units in the order of their codes."""
        sizes = np.zeros(len(units), np.int64)
        common = np.array([self.common(u) is not None and _SPECIAL not in u for u in units], bool)
        together = None
        if self.fast and common.any():
            together = self._together(list(compress(units, common)))
        if together is None:
            common[:] = False
        parts = [] if together is None else [together[0]]
        if together is not None:
            sizes[common] = together[1]
        others = list(compress(units, ~common))
        if others:
            if self.tokenizer is None:
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(self.path)
            encoded = [self.tokenizer.encode(u, add_special_tokens=False).ids for u in others]
            sizes[~common] = [len(e) for e in encoded]
            parts.append(np.fromiter((i for e in encoded for i in e), np.uint32))
        begin = np.zeros(len(units), np.int64)
        order = np.concatenate([np.flatnonzero(common), np.flatnonzero(~common)])
        begin[order] = np.cumsum(sizes[order]) - sizes[order] + len(self.ids)
        self.ids = np.concatenate([self.ids, *parts])
        self.begin = np.concatenate([self.begin, begin])
        self.sizes = np.concatenate([self.sizes, sizes])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: each text's ids and the end id."""
        if len(self.codes) > CACHE_UNITS:
            self.reset()
        code, units = self.codes.__getitem__, []
        for text in texts:
            if text:
                units.extend(map(code, self.find(text)))
            units.append(0)
        if self.codes.new:
            self.learn(self.codes.new)
            self.codes.new = []
        places = np.array(units, np.int64)
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.begin[places] - (ends - sizes), sizes) + np.arange(total)]
        return ids, np.concatenate([[0], ends[np.flatnonzero(places == 0)]])


def _piece_rows(path: str, ranks: str | None, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = UnitTokenizer(path, ranks)
        for batch in batches:
            for first, last in runs(batch.column("text"), 2 << 20):
                docs = batch.column("doc_id").slice(first, last - first)
                texts = batch.column("text").slice(first, last - first).to_pylist()
                ids, ends = tokenizer.encode(texts)
                sizes = np.diff(ends)
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                # the first piece takes what does not fill a whole one
                head = (sizes - (pieces - 1) * capacity)[doc]
                start = np.where(number == 0, 0, head + (number - 1) * capacity)
                length = np.where(number == 0, head, capacity)
                at = ends[doc] + start
                raw = [ids[a:b] for a, b in zip(at, at + length)]
                out = {"doc_id": docs.take(pa.array(doc)), "piece": pa.array(number.astype(np.int32)),
                       "start": pa.array(start), "length": pa.array(length),
                       "ids_crc32": pa.array([zlib.crc32(r.astype("<u4", copy=False)) for r in raw], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([r.astype("<u4", copy=False).tobytes() for r in raw], pa.binary())
                yield pa.RecordBatch.from_pydict(out)
    return run


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The most bins that some dual feasible function proves necessary.

    Thresholds: longer than ``capacity - t`` counts as a bin, shorter than ``t`` as
    nothing. Rounding: ``floor((k + 1) x) / k``. Both on the counts per length.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * sizes).sum()) // capacity)
    many, weight = np.cumsum(counts), np.cumsum(counts * sizes)
    for t in range(1, capacity // 2 + 1):
        large = int(many[-1] - many[capacity - t])
        middle = int(weight[capacity - t] - weight[t - 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 33):
        whole = (k + 1) * sizes % capacity == 0
        value = np.where(whole, sizes * k, (k + 1) * sizes // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each length: longest first, each to the fullest bin it fits."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0  # bit r: some bin has room r
    order = np.argsort(-lengths, kind="stable")
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        fit = rooms >> need
        if fit:
            room = need + (fit & -fit).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, at, count = capacity, count, count + 1
        bins[i], offsets[i] = at, capacity - room
        if room > need:
            if not open_bins[room - need]:
                rooms |= 1 << (room - need)
            open_bins[room - need].append(at)
    return bins, offsets


def _pack_group(capacity: int):
    """Pack a partition anew; keep what came in if that took as few bins.

    Adds the number of bins and the proven bound, both for the whole partition."""
    def run(table: pa.Table) -> pa.Table:
        lengths = np.asarray(table.column("length")).astype(np.int64)
        group = table.column("part")[0].as_py()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        count = int(bins.max()) + 1
        names = (np.int64(group) << 32) + bins
        old = table.column("sequence_id")
        if not old.null_count and len(np.unique(np.asarray(old))) <= count:
            names, offsets = np.asarray(old), np.asarray(table.column("offset"))
            count = len(np.unique(names))
        _, spot = np.unique(names, return_inverse=True)
        filled = np.bincount(spot, weights=lengths).astype(np.int64)[spot]
        bound = lower_bound(lengths, capacity)
        for name, value in (("sequence_id", pa.array(names)), ("offset", pa.array(offsets)),
                            ("filled", pa.array(filled)),
                            ("gap", pa.array(np.full(len(names), count - bound)))):
            table = table.set_column(table.schema.get_field_index(name), name, value)
        return table
    return run


def pack_pieces(pieces: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id``, ``offset``, ``part`` and ``gap``.

    No partition holds more than about :data:`PARTITION_PIECES` rows. Which piece goes
    where depends on its place in the written table, so even a table of one repeated row is
    dealt evenly. An exchange deals whole bins, by their numbers, to new partitions; it is
    repeated until every partition is certified, one partition holds all that is not, or
    no bin was saved. ``gap`` is the number of bins that the partition ``part`` may have too many:
    0 where its bound is met, and for full bins.
    """
    full = pieces.where(F.col("length") >= capacity).select(
        *pieces.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(None).cast("long").alias("part"),
        F.lit(0).cast("long").alias("gap"))
    loose = pieces.where(F.col("length") < capacity)
    parts = max(1, -(-loose.count() // PARTITION_PIECES))
    state = loose.select(
        *pieces.columns, F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"),
        F.lit(0).cast("long").alias("filled"), F.lit(0).cast("long").alias("gap"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("long").alias("part"))
    done: list[DataFrame] = []
    first, before = 0, None
    again = (F.col("gap") > 0) & (F.col("filled") < capacity)
    bins = F.count(F.when(F.col("offset") == 0, 1))
    for number in count():
        packed = scratch.keep(state.groupBy("part").applyInArrow(_pack_group(capacity), state.schema), f"packed-{number}")
        now, left, rows = packed.agg(
            bins, F.count(F.when(again & (F.col("offset") == 0), 1)), F.count(F.when(again, 1))).first()
        if parts == 1 or not rows or (before is not None and now >= before):
            done.append(packed)
            break
        done.append(packed.where(~again))
        # numbers of a round do not meet those of the last one
        first, before = first + parts, left
        parts = -(-rows // PARTITION_PIECES)
        dealt = F.pmod(F.xxhash64("sequence_id", F.lit(number)), F.lit(parts))
        state = packed.where(again).withColumn("part", (dealt + first).cast("long"))
    out = full
    for df in done:
        closed = df.withColumn("gap", F.when(again, F.col("gap")).otherwise(0).cast("long"))
        out = out.unionByName(closed.select(full.columns))
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None,
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset, part, gap)``, a row per
    piece; the last two as in :func:`pack_pieces`.

    A document is its ids and the end id; one longer than ``capacity`` is cut into whole
    pieces, the first of which may be shorter. Each sequence is filled from 0 without
    gaps. A null text is empty: the end id alone. Repeated rows are packed each; a null
    doc_id stays null. ``with_ids`` adds ``ids``, little-endian 32-bit. Empty in, empty
    out. The tokenizer file must be at ``tokenizer_path`` on every executor, and so the
    same vocabulary's ranks at ``ranks_path`` if given (see :class:`UnitTokenizer`).
    """
    scratch = Scratch(docs.sparkSession, "packing")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        pieces = scratch.keep(given.mapInArrow(_piece_rows(tokenizer_path, ranks_path, capacity, with_ids), schema), "pieces")
    return pack_pieces(pieces, scratch, capacity)


