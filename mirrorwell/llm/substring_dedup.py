"""Drop passages that occur earlier, by prefix-partitioned suffix trees.

A suffix starts at each word. Suffixes are dealt to groups that fit in memory by prefixes
of variable length: group borders are cut from the prefixes of all suffixes, so a rare
first word shares its group with others while a frequent one is split by the words that
follow, and a prefix that alone outgrows a group is split by the rest of the suffix.
A group's tree, cut at the window length, has an internal node wherever suffixes agree
that far: a sorted run of equal window hashes. All its suffixes but the earliest are
repeats; overlapping ones of one document join to maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch, likely_in
from mirrorwell.llm.hashing import mix, owners, runs, window_hashes, word_hashes

WINDOW = 20
#: Suffixes of a group, about; and how many stand behind each that helps to cut the borders.
GROUP_SUFFIXES = 3_000_000
STEP = 2048
RUN = 8 << 20
#: Bits of a window hash that are kept; the group tells a few more.
KEPT_BITS = 58
_PREFIX_WORDS = 4
_U = np.uint64


def _prefixes(hashes: np.ndarray, count: int) -> np.ndarray:
    """The first words of each suffix, 16 bits each, so that they sort like the words."""
    out = np.zeros(count, _U)
    for i in range(_PREFIX_WORDS):
        out = (out << _U(16)) | (hashes[i:i + count] >> _U(48))
    return (out ^ _U(1 << 63)).view(np.int64)  # ordered as signed numbers


def _suffixes(texts: pa.Array, window: int):
    """Of a run: prefixes, window hashes, text and start of each full window; text tags."""
    hashes, offsets = word_hashes(texts, lower=False)
    count = max(0, len(hashes) - window + 1)
    owner, start = owners(offsets), np.arange(len(hashes))
    whole = start[:count] + window <= offsets[1:][owner[:count]]
    tags = np.array([np.bitwise_xor.reduce(mix(hashes[a:b] + np.arange(b - a, dtype=_U)), initial=0)
                     for a, b in zip(offsets, offsets[1:])], _U) >> _U(32)
    first = _prefixes(hashes, count)[whole] if count else np.zeros(0, np.int64)
    doc = owner[:count][whole]
    return (first, window_hashes(hashes, window)[whole] >> _U(64 - KEPT_BITS), doc,
            start[:count][whole] - offsets[doc], tags.astype(np.uint32))


def _border_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros(0, np.int64)
        for batch in batches:
            texts = batch.column("text")
            for first, last in runs(texts, RUN):
                hashes, offsets = word_hashes(texts.slice(first, last - first), lower=False)
                count = max(0, len(hashes) - window + 1)
                keys = _prefixes(hashes, count) if count else rest[:0]
                keys = np.sort(np.concatenate([rest, keys]))
                yield pa.RecordBatch.from_arrays([pa.array(keys[STEP - 1::STEP])], names=["prefix"])
                # what is left of a run takes part in the next one
                rest = keys[len(keys) - len(keys) % STEP:]
    return run


def pack(values: np.ndarray, width: int) -> bytes:
    """Little-endian numbers of ``width`` bytes."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8")


_PART = "part int, docs binary, tags binary, firsts binary, hash_width int, hashes binary, place_width int, places binary"
_START = "doc_id long, tag long, starts array<int>"
_PART_TYPES = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
_PART_NAMES = [c.split()[0] for c in _PART.split(", ")]
_START_NAMES = ["doc_id", "tag", "starts"]


def _start_columns(doc_ids: np.ndarray, tags: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """One row per document: where its repeated windows start."""
    order = np.lexsort((starts, tags, doc_ids))
    doc_ids, tags, starts = doc_ids[order], tags[order], starts[order]
    turn = np.flatnonzero(np.concatenate(
        [np.ones(min(1, len(order)), bool), (doc_ids[1:] != doc_ids[:-1]) | (tags[1:] != tags[:-1])]))
    ends = np.concatenate([turn, [len(order)]]).astype(np.int32)
    return [pa.array(doc_ids[turn], pa.int64()), pa.array(tags[turn].astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(starts.astype(np.int32)))]


def _width(values: np.ndarray) -> int:
    return max(1, (int(values.max()).bit_length() + 7) // 8)


def _part_rows(window: int, borders: np.ndarray):
    """Suffixes by group. Of equal windows in a run only the earliest goes on; the others
    are known repeats and leave as starts of their document."""
    def of_run(ids: np.ndarray, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        prefix, hashed, doc, start, tags = _suffixes(texts, window)
        if not len(doc):
            return
        order = np.argsort(hashed, kind="stable")  # rows come by doc_id, so the earliest leads
        prefix, hashed, doc, start = prefix[order], hashed[order], doc[order], start[order]
        lead = np.concatenate([[True], hashed[1:] != hashed[:-1]])
        leader = np.flatnonzero(lead)[np.cumsum(lead) - 1]
        late = (ids[doc] != ids[doc[leader]]) | (start != start[leader])
        if late.any():
            told = _start_columns(ids[doc[late]], tags[doc[late]], start[late])
            # known repeats pass through some group, so that all leave in one exchange
            through = pa.array(np.arange(len(told[0])) % (len(borders) + 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [through] + [pa.nulls(len(told[0]), t) for t in _PART_TYPES[1:]] + told,
                names=_PART_NAMES + _START_NAMES)
            prefix, hashed, doc, start = prefix[~late], hashed[~late], doc[~late], start[~late]
        low, high = np.searchsorted(borders, prefix, "left"), np.searchsorted(borders, prefix, "right")
        part = low + (hashed % (high - low + 1).astype(_U)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(len(borders) + 2))
        longest = np.zeros(len(ids), np.int64)
        np.maximum.at(longest, doc, start + 1)
        rows = []
        for p in np.flatnonzero(np.diff(ends)):
            own = order[ends[p]:ends[p + 1]]
            used, spot = np.unique(doc[own], return_inverse=True)
            base = np.cumsum(longest[used]) - longest[used]
            gaps, place = np.diff(hashed[own], prepend=_U(0)), base[spot] + start[own]
            rows.append((int(p), ids[used].tobytes(), tags[used].tobytes(), base.astype("<u4").tobytes(),
                         _width(gaps), pack(gaps, _width(gaps)), _width(place), pack(place, _width(place))))
        cols = [pa.array(c, t) for c, t in zip(zip(*rows), _PART_TYPES)]
        yield pa.RecordBatch.from_arrays(
            cols + [pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
                    pa.nulls(len(rows), pa.list_(pa.int32()))], names=_PART_NAMES + _START_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = np.flatnonzero(np.asarray(batch.column("doc_id").is_valid()))
            ids = np.asarray(batch.column("doc_id").take(pa.array(told))).astype(np.int64)
            order = np.argsort(ids, kind="stable")
            ids, texts = ids[order], batch.column("text").take(pa.array(told[order]))
            for first, last in runs(texts, RUN):
                yield from of_run(ids[first:last], texts.slice(first, last - first))
    return run


def _late_starts(table: pa.Table) -> pa.Table:
    """Deep nodes of the group's tree: all suffixes of each but the earliest."""
    known = table.filter(pc.is_valid(table.column("starts"))).select(_START_NAMES)
    table = table.filter(pc.is_valid(table.column("hashes"))).select(_PART_NAMES)
    if not table.num_rows:
        return known
    hashed, ids, tags, starts = [], [], [], []
    for row in table.to_pylist():
        firsts = np.frombuffer(row["firsts"], "<u4").astype(np.int64)
        place = unpack(row["places"], row["place_width"]).astype(np.int64)
        spot = np.searchsorted(firsts, place, "right") - 1
        hashed.append(np.cumsum(unpack(row["hashes"], row["hash_width"]), dtype=_U))
        ids.append(np.frombuffer(row["docs"], np.int64)[spot])
        tags.append(np.frombuffer(row["tags"], np.uint32)[spot])
        starts.append((place - firsts[spot]).astype(np.int32))
    hashed, ids, tags, starts = (np.concatenate(x) for x in (hashed, ids, tags, starts))
    order = np.argsort(hashed)
    equal = hashed[order[1:]] == hashed[order[:-1]]
    node = np.zeros(len(order), bool)
    node[1:] |= equal
    node[:-1] |= equal
    own = order[node]  # the rest are leaves that branch off before the window's end
    own = own[np.lexsort((starts[own], ids[own], hashed[own]))]
    lead = np.concatenate([np.ones(min(1, len(own)), bool), hashed[own[1:]] != hashed[own[:-1]]])
    leader = own[np.flatnonzero(lead)[np.cumsum(lead) - 1]] if len(own) else own
    late = own[(ids[own] != ids[leader]) | (starts[own] != starts[leader])]
    found = pa.table(_start_columns(ids[late], tags[late], starts[late]), names=_START_NAMES)
    return pa.concat_tables([known.cast(found.schema), found])


_BY_DOCUMENT = "owners int, starts binary"


def _repeats_of_group(groups: int):
    """The repeats of a group, packed by the document they are in."""
    def run(table: pa.Table) -> pa.Table:
        late = _late_starts(table)
        counts = np.asarray(pc.list_value_length(late.column("starts"))).astype(np.int64)
        flat = np.stack([
            np.repeat(np.asarray(late.column("doc_id")).astype(np.int64), counts),
            np.repeat(np.asarray(late.column("tag")).astype(np.int64), counts),
            np.asarray(pc.list_flatten(late.column("starts"))).astype(np.int64)], axis=1)
        owner = (mix(flat[:, 0].astype(_U)) % _U(groups)).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(groups + 1))
        full = np.flatnonzero(np.diff(ends))
        return pa.table({"owners": pa.array(full, pa.int32()),
                         "starts": pa.array([flat[order[ends[g]:ends[g + 1]]].tobytes() for g in full], pa.binary())})
    return run


def _by_document(table: pa.Table) -> pa.Table:
    flat = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("starts").to_pylist()]).reshape(-1, 3)
    return pa.table(_start_columns(flat[:, 0], flat[:, 1], flat[:, 2]), names=_START_NAMES)


def repeat_starts(docs: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """``(doc_id, tag, starts)``: the windows whose words also start earlier, a row for
    each text of a document that has any."""
    prefixes = scratch.keep(docs.select("text").mapInArrow(_border_rows(window), "prefix long"), "prefixes")
    groups = max(8, prefixes.count() * STEP // GROUP_SUFFIXES)
    cuts = [i / groups for i in range(1, groups)]
    found = prefixes.agg(F.percentile_approx("prefix", F.array(*map(F.lit, cuts)), F.lit(100 * groups))).first()[0]
    borders = np.array(found or [0], np.int64)
    packed = docs.mapInArrow(_part_rows(window, borders), f"{_PART}, {_START}").groupBy("part").applyInArrow(
        _repeats_of_group(groups), _BY_DOCUMENT)
    return packed.groupBy("owners").applyInArrow(_by_document, _START)


def maximal_spans(starts: np.ndarray, window: int) -> np.ndarray:
    """Half-open word ranges that the windows at ``starts`` cover together, as rows."""
    starts = np.unique(starts)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    turn = np.flatnonzero(starts[1:] > starts[:-1] + window)
    return np.stack([starts[np.concatenate([[0], turn + 1])],
                     starts[np.concatenate([turn, [len(starts) - 1]])] + window], axis=1)


def _cut_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            kept, counts, spans = [], [], []
            for text, found in zip(texts, batch.column("found").to_pylist()):
                words = (text or b"").split()
                cover: list[list[int]] = []
                if found:
                    hashes, _ = word_hashes(pa.array([text], pa.binary()), lower=False)
                    tag = int(np.bitwise_xor.reduce(mix(hashes + np.arange(len(hashes), dtype=_U))) >> _U(32))
                    starts = [np.array(f["starts"], np.int64) for f in found if f["tag"] == tag]
                    cover = maximal_spans(np.concatenate(starts), window).tolist() if starts else []
                stay = np.ones(len(words), bool)
                for a, b in cover:
                    stay[a:b] = False
                kept.append(b" ".join(compress(words, stay) if cover else words))
                counts.append((len(words), len(words) - int(stay.sum())))
                spans.append(cover)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([c[0] for c in counts], pa.int64()),
                 pa.array([c[1] for c in counts], pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(spans, pa.list_(pa.list_(pa.int32())))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "text", "spans"])
    return run


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, text, spans)``, a row per row of ``docs``.

    A word goes if a window of ``window`` consecutive words covers it whose words also
    start earlier: in a document of smaller doc_id, or earlier in the same one. Windows
    are judged on the input. What stays is joined by one space; ``spans`` are the removed
    word ranges, the maximal repeats. A null text has no words. Rows repeated under one
    doc_id have their windows at the same place, so neither is earlier; a row without
    doc_id keeps all its words and counts for no other. An empty table gives an empty table.

    Windows are compared by a hash of 58 bits within a group of suffixes.
    """
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    starts = repeat_starts(given, window, scratch)
    found = scratch.keep(
        starts.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "starts")).alias("found")), "found")
    scratch.drop("prefixes")
    # texts move only where a repeat was found, or a hash says so
    moved = likely_in(given, found, "doc_id").join(found, "doc_id", "left").select("doc_id", "text", "found")
    still = likely_in(given, found, "doc_id", others=True).select(
        "doc_id", "text", F.lit(None).cast(found.schema["found"].dataType).alias("found"))
    return moved.unionByName(still).mapInArrow(
        _cut_rows(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, text string, "
        "spans array<array<int>>")
