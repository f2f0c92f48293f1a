"""Score texts with an interpolated modified Kneser-Ney bigram model counted in Spark.

Words and word pairs are counted by hash: tasks send sorted runs, buckets merge them and
leave sorted arrays in the shared folder. Scoring tasks map those files into memory and
look up whole batches; only pages that are hit are read, and no task loads the model.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlparse
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch, input_bytes, small_batches
from mirrorwell.llm.hashing import mix, runs, word_hashes

#: Bytes of input behind each bucket, as the planner expects them. It takes a text for some 20 bytes wide
#: beside the other columns of a file, so a bucket may well hold the pairs of three or four times as much.
BUCKET_BYTES = 4 << 20
#: A word with more than this share of all tokens, or than a bucket holds, has its pairs spread over all
#: buckets; there can be no more than 128 of them, or than there are buckets.
HOT_SHARE = 1 / 128
#: Bytes of text hashed at once (words, their places and hashes take some 15 times that), tokens counted
#: together, and bytes of text scored at once.
HASHED_BYTES = 1 << 20
COUNTED_TOKENS = 1 << 20
SCORED_BYTES = 4 << 20
_U = np.uint64
_ID_BITS = 48
END, START = 1, 2  # no word has these numbers
_BLOB = "bucket int, ids binary, counts binary"


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, offsets)`` of the tokens of ``texts``: words (A-Z lower-cased), then one end."""
    hashes, offsets = word_hashes(texts, lower=True)
    ids = np.maximum(hashes & _U((1 << _ID_BITS) - 1), _U(3))
    out = np.full(len(ids) + len(texts), END, _U)
    ends = offsets[1:] + np.arange(1, len(texts) + 1)  # one past each end token
    stay = np.ones(len(out), bool)
    stay[ends - 1] = False
    out[stay] = ids
    return out, np.concatenate([[0], ends])


def token_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``word_ids`` of whole texts, some :data:`COUNTED_TOKENS` at a time, however the batches are cut."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        texts = batch.column("text")
        for first, last in runs(texts, HASHED_BYTES):
            held.append(word_ids(texts.slice(first, last - first)))
            if sum(len(ids) for ids, _ in held) >= COUNTED_TOKENS:
                yield _joined(held)
    if held:
        yield _joined(held)


def _joined(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The runs of tokens as one; ``held`` is emptied."""
    sizes = np.concatenate([np.diff(offsets) for _, offsets in held])
    ids = np.concatenate([ids for ids, _ in held])
    held.clear()
    return ids, np.concatenate([[0], np.cumsum(sizes)])


def contexts(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The token before each one."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[offsets[:-1]] = START
    return out


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * _U(0x9E3779B97F4A7C15) + word)


def _bucket_of_pairs(context: np.ndarray, key: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    spread = np.isin(context, hot)
    return (np.where(spread, key >> _U(20), context) % _U(buckets)).astype(np.int64)


def _split(bucket: np.ndarray, buckets: int, *arrays: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(ends)):
        own = order[ends[b]:ends[b + 1]]
        yield (int(b), *[a[own] for a in arrays])


def _blob_batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    packed = [(bucket, pack_ids(*ids), _pack_counts(counts)) for bucket, *ids, counts in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in packed], pa.int32()), pa.array([r[1] for r in packed], pa.binary()),
         pa.array([r[2] for r in packed], pa.binary())], names=["bucket", "ids", "counts"])


def pack_ids(*ids: np.ndarray) -> bytes:
    """Six bytes each, one array after the other."""
    return b"".join(np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                    for a in ids)


def unpack_ids(data: bytes, arrays: int) -> list[np.ndarray]:
    flat = np.zeros((len(data) // 6, 8), np.uint8)
    flat[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.split(flat.reshape(-1).view("<u8"), arrays)


def _pack_counts(counts: np.ndarray) -> bytes:
    """One byte each; larger ones follow as place and number."""
    large = np.flatnonzero(counts > 254)
    small = np.minimum(counts, 255).astype(np.uint8)
    tail = np.stack([large, counts[large]]).astype("<i8")
    return np.array([len(counts)], "<i8").tobytes() + small.tobytes() + tail.tobytes()


def _unpack_counts(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    out = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    large, value = np.frombuffer(data, "<i8", offset=8 + n).reshape(2, -1)
    out[large] = value
    return out


def _unpack_all(table: pa.Table, arrays: int) -> tuple[np.ndarray, ...]:
    """The ``ids`` and the ``counts`` of all blobs, end to end; one blob at a time is held beside them."""
    sizes = [len(x.as_buffer()) // (6 * arrays) for x in table.column("ids")]
    out = [np.empty(sum(sizes), _U) for _ in range(arrays)]
    counts = np.empty(sum(sizes), np.int64)
    at = 0
    for size, ids, told in zip(sizes, table.column("ids"), table.column("counts")):
        for array, part in zip(out, unpack_ids(ids.as_py(), arrays)):
            array[at:at + size] = part
        counts[at:at + size] = _unpack_counts(told.as_py())
        at += size
    return *out, counts


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of the first of each, and the sums of its counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    turn = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    counts = counts[order]
    return keys[turn], order[turn], np.add.reduceat(counts, turn, dtype=np.int64) if len(turn) else counts[:0]


def _word_blobs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _ in token_runs(batches):
            ids, counts = np.unique(ids, return_counts=True)
            yield _blob_batch(_split((ids % _U(buckets)).astype(np.int64), buckets, ids, counts))
    return run


def _pair_blobs(buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, offsets in token_runs(batches):
            before = contexts(ids, offsets)
            key, at, counts = np.unique(pair_key(before, ids), return_index=True, return_counts=True)
            before, ids = before[at], ids[at]
            del at
            bucket = _bucket_of_pairs(before, key, hot, buckets)
            yield _blob_batch(_split(bucket, buckets, before, ids, counts))
    return run


def _write(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Plain array files that can be mapped into memory. A task that runs again writes the
    same content, and a name appears only with its whole content."""
    os.makedirs(folder, exist_ok=True)
    for kind, values in arrays.items():
        draft = f"{folder}/.{name}-{kind}-{uuid4().hex}.npy"
        np.save(draft, values)
        os.replace(draft, f"{folder}/{name}-{kind}.npy")


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits where they fit, else as they are: none wraps, however large the corpus."""
    return counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts.astype(np.int64)


def hot_share(buckets: int) -> float:
    """Contexts with this share of all tokens are summed apart: no bucket gets much more from one
    than its own share, however many buckets there are."""
    return min(HOT_SHARE, 1 / buckets)


def _merge_words(folder: str, share: float):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        ids, _, counts = _merge(*_unpack_all(table, 1))
        _write(folder, f"word-{bucket}", ids=ids, counts=narrow(counts))
        top = np.argsort(-counts, kind="stable")[:int(1 / share)]
        return pa.table({"tokens": pa.array([int(counts.sum())]), "types": pa.array([len(ids)]),
                         "top_ids": pa.array([ids[top].astype(np.int64)], pa.list_(pa.int64())),
                         "top_counts": pa.array([counts[top]], pa.list_(pa.int64()))})
    return run


def _of_counts(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4 and how many 3 or more."""
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)] + [int((counts >= 3).sum())]


_PAIR_OUT = f"{_BLOB}, hot long, of_counts array<long>"


def _merge_pairs(folder: str, buckets: int, hot: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        before, word, counts = _unpack_all(table, 2)
        key, at, counts = _merge(pair_key(before, word), counts)
        before, word = before[at], word[at]
        _write(folder, f"pair-{bucket}", keys=key, counts=narrow(counts))
        del key, at
        context, _, kinds = _merge(before, np.stack([counts == 1, counts == 2, counts >= 3], axis=1))
        ones, twos, more = kinds.T.astype(np.int64)
        del before
        cold = ~np.isin(context, hot)
        _write(folder, f"context-{bucket}", ids=context[cold],
               kinds=narrow(np.stack([ones, twos, more], axis=1)[cold]))
        # how many contexts each word follows, to be summed up by word
        follows = _merge(word, np.ones(len(word), np.int64))
        blobs = _blob_batch(_split((follows[0] % _U(buckets)).astype(np.int64), buckets, follows[0], follows[2]))
        n, warm = blobs.num_rows, np.flatnonzero(~cold)
        of = [[int(ones[i]), int(twos[i]), int(more[i])] for i in warm]
        rest = pa.RecordBatch.from_arrays(
            [pa.nulls(len(warm) + 1, pa.int32()), pa.nulls(len(warm) + 1, pa.binary()),
             pa.nulls(len(warm) + 1, pa.binary())], names=["bucket", "ids", "counts"])
        first = pa.table(blobs).append_column("hot", pa.nulls(n, pa.int64())).append_column(
            "of_counts", pa.nulls(n, pa.list_(pa.int64())))
        second = pa.table(rest).append_column(
            "hot", pa.array([*context[warm].astype(np.int64).tolist(), None], pa.int64())).append_column(
            "of_counts", pa.array([*of, _of_counts(counts)], pa.list_(pa.int64())))
        return pa.concat_tables([first, second])
    return run


def _merge_follows(folder: str):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        ids, _, counts = _merge(*_unpack_all(table, 1))
        _write(folder, f"follow-{bucket}", ids=ids, counts=narrow(counts))
        return pa.table({"total": pa.array([int(counts.sum())]),
                         "of_counts": pa.array([_of_counts(counts)], pa.list_(pa.int64()))})
    return run


def discounts(of_counts: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more. Where a count of
    counts is missing (tiny corpora) the discount is a half of the count at most."""
    n1, n2, n3, n4 = of_counts[:4]
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = [k - (k + 1) * y * b / a if a and b else 0.5 for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    return np.array([0.0] + [min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1)])


class Model:
    """What scoring needs beside the files: a few totals and at most 129 hot contexts."""

    def __init__(self, folder: str, buckets: int, tokens: int, types: int, documents: int,
                 hot: dict[int, tuple[int, int, int]], pair_counts: list[int], follow_total: int,
                 follow_counts: list[int]):
        self.folder, self.buckets = folder, buckets
        self.tokens, self.types, self.documents = tokens, types, documents
        self.hot_ids = np.array(sorted(hot), _U)
        self.hot_kinds = np.array([hot[k] for k in sorted(hot)], np.float64).reshape(-1, 3)
        self.cut, self.low_cut = discounts(pair_counts), discounts(follow_counts)
        self.follow_total = follow_total
        n1, n2, more = follow_counts[0], follow_counts[1], follow_counts[4]
        self.low_rest = float(np.dot(self.low_cut[1:], [n1, n2, more])) / max(1, follow_total)



class Lookup:
    """The arrays of a model, mapped into memory by the task that reads them."""

    def __init__(self, model: Model):
        self.model = model
        self.files: dict[str, np.ndarray | None] = {}

    def _array(self, name: str) -> np.ndarray | None:
        if name not in self.files:
            path = f"{self.model.folder}/{name}.npy"
            self.files[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.files[name]

    def _homes(self, bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
        return list(_split(bucket, self.model.buckets, np.arange(len(bucket))))

    def _find(self, kind: str, column: str, wanted: np.ndarray, homes: list[tuple[int, np.ndarray]],
              keys: str = "ids") -> np.ndarray:
        """Values of ``wanted``, in order, in the sorted arrays of their buckets; 0 where absent.
        As they are in order, neighbours share pages."""
        out = None
        for b, place in homes:
            found, values = self._array(f"{kind}-{b}-{keys}"), self._array(f"{kind}-{b}-{column}")
            if found is None or not len(found):
                continue
            if out is None:
                out = np.zeros((len(wanted), *values.shape[1:]))
            at = np.minimum(np.searchsorted(found, wanted[place]), len(found) - 1)
            hit = found[at] == wanted[place]
            out[place[hit]] = values[at[hit]]
        return np.zeros(len(wanted)) if out is None else out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """``(tokens, known, base, score)`` of each text."""
        m = self.model
        ids, offsets = word_ids(texts)
        before = contexts(ids, offsets)
        words, spot = np.unique(np.concatenate([ids, before]), return_inverse=True)
        own, prior = spot[:len(ids)], spot[len(ids):]
        home = self._homes((words % _U(m.buckets)).astype(np.int64))
        count = self._find("word", "counts", words, home)
        follow = self._find("follow", "counts", words, home)
        kinds = self._find("context", "kinds", words, home)
        kinds = kinds if kinds.ndim == 2 else np.zeros((len(words), 3))
        if len(m.hot_ids):
            at = np.minimum(np.searchsorted(m.hot_ids, words), len(m.hot_ids) - 1)
            warm = m.hot_ids[at] == words
            kinds[warm] = m.hot_kinds[at[warm]]
        low = (np.maximum(follow - m.low_cut[np.minimum(follow, 3).astype(int)], 0) / max(1, m.follow_total)
               + (m.low_rest or 1.0) / (m.types + 1))
        total = np.where(words == START, m.documents, count)
        seen = kinds.sum(axis=1) > 0
        rest = np.where(seen, kinds @ m.cut[1:] / np.maximum(total, 1), 1.0)
        key, at, back = np.unique(pair_key(before, ids), return_index=True, return_inverse=True)
        pairs = self._find("pair", "counts", key, self._homes(_bucket_of_pairs(before[at], key, m.hot_ids, m.buckets)),
                           "keys")
        pairs = pairs[back]
        high = np.maximum(pairs - m.cut[np.minimum(pairs, 3).astype(int)], 0) / np.maximum(total[prior], 1)
        likely = np.log10(high + rest[prior] * low[own])
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.types + 1)))[own]
        first = offsets[:-1]
        if not len(first):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        return (np.diff(offsets), np.add.reduceat((count > 0)[own].astype(np.int64), first),
                np.add.reduceat(base, first), np.add.reduceat(likely, first))


def mounted(folder: str) -> str:
    """The path under which workers can map files of the shared folder."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"arrays are mapped into memory, so {folder} must be a mounted folder (file:)")
    return url.path


def train(docs: DataFrame) -> Model:
    """Count a model on all ``docs``; null texts are empty ones, just an end token."""
    with small_batches(docs.sparkSession):
        return _train(docs)


def _train(docs: DataFrame) -> Model:
    scratch = Scratch(docs.sparkSession, "lm")
    folder = mounted(scratch.folder) + "/arrays"
    buckets = max(4, input_bytes(docs) // BUCKET_BYTES)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    told = scratch.keep(
        texts.mapInArrow(_word_blobs(buckets), _BLOB).groupBy("bucket").applyInArrow(
            _merge_words(folder, hot_share(buckets)), "tokens long, types long, top_ids array<long>, top_counts array<long>"),
        "words")
    sums = told.agg(F.sum("tokens"), F.sum("types")).first()
    tokens, types = int(sums[0] or 0), int(sums[1] or 0)
    often = told.select(F.explode(F.arrays_zip("top_ids", "top_counts")).alias("t")).where(
        F.col("t.top_counts") >= max(1, tokens * hot_share(buckets))).select("t.top_ids", "t.top_counts")
    frequent = {r[0]: r[1] for r in often.collect()}
    hot = np.array(sorted({START, *frequent}), _U)
    merged = scratch.keep(
        texts.mapInArrow(_pair_blobs(buckets, hot), _BLOB).groupBy("bucket").applyInArrow(
            _merge_pairs(folder, buckets, hot), _PAIR_OUT), "pairs")
    warm = {r["hot"]: (r["a"], r["b"], r["c"]) for r in
            merged.where("hot is not null").groupBy("hot").agg(
                *[F.sum(F.col("of_counts")[i]).alias(n) for i, n in enumerate("abc")]).collect()}
    follow = scratch.keep(
        merged.where("bucket is not null").select("bucket", "ids", "counts").groupBy("bucket").applyInArrow(
            _merge_follows(folder), "total long, of_counts array<long>"), "follows")

    def summed(df: DataFrame) -> list[int]:
        row = df.agg(*[F.sum(F.col("of_counts")[i]) for i in range(5)]).first()
        return [int(x or 0) for x in row]

    documents = docs.count()
    return Model(folder, buckets, tokens, types, documents, warm,
                 summed(merged.where("bucket is null and hot is null")),
                 int(follow.agg(F.sum("total")).first()[0] or 0), summed(follow))


def _score_rows(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model)
        for batch in batches:
            for first, last in runs(batch.column("text"), SCORED_BYTES):
                part = batch.slice(first, last - first)
                tokens, known, base, score = lookup.score(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(tokens.astype(np.int64)),
                     pa.array(known.astype(np.int64)), pa.array(np.full(len(part), model.tokens, np.int64)),
                     pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def held_out() -> Column:
    """One fifth of the documents, by crc32 of the doc_id as text (null as empty)."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 1


def score_texts(docs: DataFrame, model: Model, is_held_out: Column | None = None) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row per
    row of ``docs``: log10 probabilities of the whole text under smoothed word counts
    (base) and under the model.

    A null or empty text is its end token alone. Repeated rows score alike, a null doc_id
    stays null, other columns are not read, an empty table gives an empty table. The scores,
    a few numbers a text, are written to the shared folder.
    """
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (held_out() if is_held_out is None else is_held_out).alias("held_out"),
        F.col("text").cast("string").alias("text"))
    scores = given.mapInArrow(
        _score_rows(model), "doc_id long, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")
    with small_batches(docs.sparkSession):
        return Scratch(docs.sparkSession, "lm-scores").keep(scores, "scores")
