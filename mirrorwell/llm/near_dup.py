"""Jaccard self-join of documents by parity sketches.

The word shingles of a document flip bits in a sketch. Each shingle that two documents
do not share flips one bit, so the Hamming distance of two sketches is at most the size
of the symmetric difference, and a similarity bounds that by ``d``. Of ``d + 1 + z``
pieces of a sketch, two similar documents agree in at least ``z + 1``. Pieces on which
at most one shingle falls are weak: many documents that have little in common agree in
them. A document with no more than ``z`` of them need not show them, since then one of
the pieces it agrees in is strong; one with more shows all. Pieces are joined per band
of set sizes, what meets is compared by sketch and then by the shingles themselves.

Two sketches are used: a very wide one to join, whose pieces are told by the exclusive
or of a code for each set bit, and one of a few bits per shingle to compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch, input_bytes, likely_in, small_batches
from mirrorwell.llm.graph import components
from mirrorwell.llm.hashing import mix, runs, signed, window_hashes, word_hashes

SHINGLE_WORDS = 5
PERCENT = 80
#: Sizes of one band differ by this factor at most.
BAND_RATIO = 1.25
#: Pieces beyond ``d + 1``, as a share of those.
SPARE_SHARE = 0.1
#: Bits of a compared sketch for each shingle; the low bits of a key tell its band.
SKETCH_BITS = 2
BAND_BITS = 6
#: Piece keys per bucket that one task holds, about, keys gathered before they are sent, and
#: members of a key compared at once. A bucket is held several times over: by Spark as it is
#: sorted and handed to Python, and there as keys, their order and what is sent back.
BUCKET_BYTES = 8 << 20
HELD_KEYS = 1 << 18
BLOCK = 2000
#: Bytes of text hashed at once; words, their places and hashes take some 15 times that.
HASHED_BYTES = 1 << 20
#: Of the keys a document is compared in, the smallest so many tell which key names a pair. A
#: pair is always named by the smallest key it shares, by others only if that one is not listed.
HEAD_KEYS = 16
_U = np.uint64
_DIGESTS = "doc_id long, n_shingles long, set1 long, set2 long"
_SKETCHES = "node long, n_shingles long, band int, sketch binary"


class Bands:
    """Bands of set sizes for one similarity, and how many pieces each needs."""

    def __init__(self, percent: int, largest: int):
        self.low, self.high, self.reach, self.pieces, self.spare = [], [], [], [], []
        self.words: list[int] = []  # of the sketch that is compared
        low = 1
        while low <= largest:
            high = max(low, int(low * BAND_RATIO))
            reach = high * 100 // percent
            both = high + reach
            self.low.append(low)
            self.high.append(high)
            self.reach.append(reach)  # the largest partner of a set of this band
            most = both - 2 * -(-percent * both // (100 + percent))
            self.spare.append(0 if most < 2 else max(1, round(SPARE_SHARE * (most + 1))))
            self.pieces.append(most + 1 + self.spare[-1])
            self.words.append(-(-high * SKETCH_BITS // 64))
            low = high + 1

    def of(self, size: int) -> list[int]:
        """Its own band, and the lower ones whose sets it can be a partner of."""
        own = int(np.searchsorted(self.low, size, "right")) - 1
        out = [own] if own >= 0 else []
        band = own - 1
        while band >= 0 and self.reach[band] >= size:
            out.append(band)
            band -= 1
        return out


def allowed(percent: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The largest symmetric difference two sets of these sizes may have."""
    both = a + b
    return both - 2 * -(-percent * both // (100 + percent))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of each text, A-Z lower-cased.

    A text of fewer words has the whole sequence as its one shingle, without words none.
    """
    for first, last in runs(texts, HASHED_BYTES):
        hashes, offsets = word_hashes(texts.slice(first, last - first), lower=True)
        windows = window_hashes(hashes, words)
        for i in range(last - first):
            a, b = offsets[i], offsets[i + 1]
            if b - a >= words:
                yield first + i, np.unique(windows[a:b - words + 1])
            else:
                yield first + i, window_hashes(hashes[a:b], int(b - a)) if b > a else hashes[:0]


def sketch_of(shingles: np.ndarray, words: int) -> np.ndarray:
    """Bits in 64-bit words, each the parity of the shingles that fall on it."""
    out = np.zeros(words, _U)
    np.bitwise_xor.at(out, (shingles % _U(words)).astype(np.int64), _U(1) << (mix(shingles) >> _U(58)))
    return out


def piece_keys(shingles: np.ndarray, band: int, pieces: int, spare: int) -> np.ndarray:
    """Keys of the pieces a set shows in a band: equal for equal pieces."""
    place = (shingles % _U(pieces)).astype(np.int64)
    held = np.bincount(place, minlength=pieces)
    keys = mix(np.arange(pieces, dtype=_U) + (_U(band) << _U(40)))
    np.bitwise_xor.at(keys, place, mix(shingles ^ _U(0x5851F42D4C957F2D)))
    keys = (keys << _U(BAND_BITS)) | _U(band % (1 << BAND_BITS))
    weak = held <= 1
    return keys if int(weak.sum()) > spare else keys[~weak]


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    both = np.array([np.bitwise_xor.reduce(shingles, initial=0), mix(shingles).sum(dtype=_U)], _U)
    one, two = signed(both).tolist()
    return one, two


def _grown(bands: Bands, percent: int, size: int) -> Bands:
    return bands if size <= bands.high[-1] else Bands(percent, 4 * size)


def _digest_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [(len(s), *set_digest(s)) for _, s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([t[i] for t in told], pa.int64()) for i in range(3))],
                names=["doc_id", "n_shingles", "set1", "set2"])
    return run


def _sketch_rows(words: int, percent: int):
    """A row for each band a document takes part in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, 1 << 12)
        for batch in batches:
            ids = batch.column("node")
            rows: list[tuple] = []
            for row, shingles in shingle_sets(batch.column("text"), words):
                bands = _grown(bands, percent, len(shingles))
                for band in bands.of(len(shingles)):
                    rows.append((ids[row].as_py(), len(shingles), band,
                                 sketch_of(shingles, bands.words[band]).tobytes()))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                names=["node", "n_shingles", "band", "sketch"])
    return run


def _piece_blobs(words: int, percent: int, buckets: int):
    """Keys of all pieces, by bucket. Equal sets that one task meets send theirs once."""
    def flush(keys: list, docs: list) -> pa.RecordBatch:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        bucket = ((key >> _U(BAND_BITS + 4)) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        key, doc, bucket = key[order], doc[order], bucket[order]
        ends = np.searchsorted(bucket, np.arange(buckets + 1))
        full = [b for b in range(buckets) if ends[b] < ends[b + 1]]
        return pa.RecordBatch.from_arrays([
            pa.array(full, pa.int32()),
            pa.array([key[ends[b]:ends[b + 1]].tobytes() for b in full], pa.binary()),
            pa.array([doc[ends[b]:ends[b + 1]].tobytes() for b in full], pa.binary()),
        ], names=["bucket", "keys", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, 1 << 12)
        seen: set[tuple] = set()
        keys, docs, held = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for row, shingles in shingle_sets(batch.column("text"), words):
                if ids[row] is None or not len(shingles):
                    continue
                digest = set_digest(shingles)
                if digest in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(digest)
                bands = _grown(bands, percent, len(shingles))
                for band in bands.of(len(shingles)):
                    found = piece_keys(shingles, band, bands.pieces[band], bands.spare[band])
                    keys.append(found)
                    docs.append(np.full(len(found), ids[row], np.int64))
                    held += len(found)
                if held > HELD_KEYS:
                    yield flush(keys, docs)
                    keys, docs, held = [], [], 0
        if keys:
            yield flush(keys, docs)
    return run


def _met_keys(table: pa.Table) -> pa.Table:
    """Keys of a bucket that more than one document has, with those documents."""
    key = np.concatenate([np.frombuffer(b.as_buffer(), _U) for b in table.column("keys")])
    order = np.argsort(key, kind="stable")
    key = key[order]
    equal = key[1:] == key[:-1]
    met = np.zeros(len(key), bool)
    met[1:] |= equal
    met[:-1] |= equal
    key, order = key[met], order[met]
    doc = np.concatenate([np.frombuffer(b.as_buffer(), np.int64) for b in table.column("docs")])
    return pa.table({"key": pa.array(signed(key)), "doc_id": pa.array(doc[order])})


def _near_in_group(percent: int):
    """Pairs of a key's members of different components whose sketches are near enough,
    but for those known to meet in a smaller key as well, which names them."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        key = table.column("key")[0].as_py()
        node = np.asarray(table.column("node"))
        comp = np.asarray(table.column("component"))
        size = np.asarray(table.column("n_shingles"))
        side = np.asarray(table.column("side"))
        heads = [{k for k in h if k < key} for h in table.column("heads").to_pylist()]
        sketches = np.stack([np.frombuffer(s, _U) for s in table.column("sketch").to_pylist()])
        a_out, b_out = [], []
        right = np.flatnonzero(side != 0)
        for i in np.flatnonzero(side != 1):
            others = right[right > i] if side[i] == 2 else right
            others = others[comp[others] != comp[i]]
            far = np.bitwise_count(sketches[others] ^ sketches[i]).sum(axis=1, dtype=np.int64)
            near = others[far <= allowed(percent, size[i], size[others])]
            near = near[np.array([heads[i].isdisjoint(heads[j]) for j in near], bool)]
            a_out.append(np.full(len(near), node[i]))
            b_out.append(node[near])
        a, b = np.concatenate(a_out or [node[:0]]), np.concatenate(b_out or [node[:0]])
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})
    return run


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            for row, shingles in shingle_sets(batch.column("text"), words):
                rows.append(row)
                sets.append(signed(shingles))
            ends = np.cumsum([0] + [len(s) for s in sets])
            values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(rows, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                names=["node", "shingles"])
    return run


def keys_to_reopen(placed: DataFrame) -> DataFrame:
    """``(key, blocks)`` of the keys of ``placed`` (``key, node, component``) some of whose pairs
    are still to be compared: those with members of different components, but for keys of two
    members, whose one pair was compared as a star. Of keys with the same members in the same
    band one is enough."""
    told = placed.groupBy("key").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("set1"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("set2"))
    alike = told.where("x <> y and members > 2").groupBy(
        F.pmod("key", F.lit(1 << BAND_BITS)), "members", "set1", "set2").agg(F.min("key").alias("key"))
    return alike.select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))


def near_components(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row per row of ``docs``.

    Two documents are linked if ``100 * common >= percent * united`` of their sets of
    distinct ``words``-word shingles (A-Z lower-cased); ``component_id`` is the smallest
    doc_id reachable by links. A text of fewer words has one shingle; one without words
    (or null) has none and no link. Rows that share a doc_id are one document with the
    links of each. A row without doc_id is linked with nothing but keeps its counts; its
    component is that of equal sets, else null. An empty table gives an empty table.

    Equal sets are one node. First each piece key links its members to the smallest of
    them; only keys whose members are then in different components compare all of those,
    in blocks, by sketch. Nothing is capped: every pair that shares a piece is either in
    one component already or compared.
    """
    with small_batches(docs.sparkSession):
        return _near_components(docs, words, percent)


def _near_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dup")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    alike = ["n_shingles", "set1", "set2"]
    own = given.mapInArrow(_digest_rows(words), _DIGESTS).groupBy("doc_id", *alike).agg(
        F.count("*").alias("rows"))
    own = scratch.keep(own, "own")
    nodes = scratch.keep(
        own.where("n_shingles > 0").groupBy(*alike).agg(F.min("doc_id").alias("node")), "nodes")
    member = scratch.keep(own.join(nodes, alike, "left"), "member")

    buckets = max(8, 2 * input_bytes(docs) // BUCKET_BYTES)
    blobs = given.mapInArrow(_piece_blobs(words, percent, buckets), "bucket int, keys binary, docs binary")
    met = blobs.groupBy("bucket").applyInArrow(_met_keys, "key long, doc_id long")
    named = member.where("node is not null and doc_id is not null").select("doc_id", "node").distinct()
    hits = scratch.keep(met.join(named, "doc_id").select("key", "node").distinct(), "hits")
    firsts = scratch.keep(
        hits.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"))
        .where("a <> z").select("key", "a"), "firsts")
    hits = scratch.keep(hits.join(firsts, "key").select("key", "a", F.col("node").alias("b")), "stars")
    scratch.drop("hits", "firsts")
    chosen = scratch.keep(hits.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "chosen")

    texts = likely_in(given.withColumnRenamed("doc_id", "node"), chosen, "node")
    facts = texts.mapInArrow(_sketch_rows(words, percent), _SKETCHES).join(chosen, "node", "left_semi")
    facts = scratch.keep(facts.distinct(), "facts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = scratch.keep(pairs, f"{name}-pairs")
        wanted = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(),
                              f"{name}-wanted")
        held = likely_in(given.withColumnRenamed("doc_id", "node"), wanted, "node").mapInArrow(_set_rows(words), "node long, shingles array<long>")
        held = scratch.keep(held.join(wanted, "node", "left_semi"), f"{name}-sets")
        one = held.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        two = held.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(one, "a").join(two, "b")
        common = F.size(F.array_intersect("sa", "sb"))
        united = F.size("sa") + F.size("sb") - F.col("common")
        out = both.select("a", "b", "sa", "sb", common.alias("common")).where(
            100 * F.col("common") >= percent * united).select("a", "b").distinct()
        out = scratch.keep(out, f"{name}-links")
        scratch.drop(f"{name}-sets", f"{name}-pairs", f"{name}-wanted")
        return out

    near_in = _hamming(percent)
    a = facts.select(*(F.col(c).alias("a" if c == "node" else f"a_{c}") for c in facts.columns))
    b = facts.select(*(F.col(c).alias("b" if c == "node" else f"b_{c}") for c in facts.columns))
    stars = scratch.keep(hits.select("a", "b").where("a <> b").distinct(), "pairs")
    compared = stars.join(a, "a").join(b, "b").where("a_band = b_band").mapInArrow(
        near_in, "a long, b long").distinct()
    links = verified(compared, "first")
    scratch.drop("pairs")
    comps = scratch.keep(components(links, scratch, "first"), "first-components")

    placed = hits.select("key", F.col("b").alias("node")).join(comps, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    placed = scratch.keep(placed, "placed")
    open_keys = scratch.keep(keys_to_reopen(placed), "open")
    rest = scratch.keep(placed.join(open_keys, "key"), "rest")
    scratch.drop("stars", "placed", "open")
    heads = scratch.keep(rest.groupBy("node").agg(
        F.slice(F.sort_array(F.collect_set("key")), 1, HEAD_KEYS).alias("heads")), "heads")
    late_facts = scratch.keep(facts.join(heads, "node").withColumn(
        "low", F.pmod("band", F.lit(1 << BAND_BITS))), "late-facts")
    rest = rest.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # each pair of blocks of a key is one group; a member goes to those its block is in
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rest = rest.select("*", other.alias("other")).select(
        "key", "node", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0)
        .otherwise(1).alias("side"))
    low = F.pmod("key", F.lit(1 << BAND_BITS))
    rest = rest.withColumn("low", low).join(late_facts, ["node", "low"])
    scratch.drop("facts", "heads")
    late = rest.groupBy("key", "band", "i", "j").applyInArrow(_near_in_group(percent), "a long, b long")
    more = verified(late.distinct().join(links, ["a", "b"], "left_anti"), "second")
    comps = scratch.keep(components(links.unionByName(more), scratch, "second"), "components")

    found = member.join(comps, "node", "left").select(
        "doc_id", "n_shingles", "rows",
        F.coalesce("component", "node", "doc_id").alias("component_id"))
    # rows of one doc_id with different texts are one document
    least = found.groupBy("doc_id").agg(F.min("component_id").alias("least"))
    least = scratch.keep(least.where("doc_id is not null"), "least")
    return found.join(least, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"),
        F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_copy")).drop("_copy")


def _hamming(percent: int):
    """Of joined pairs, those whose sketches are near enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_sketch").to_pylist(), batch.column("b_sketch").to_pylist()):
                keep.append(int(np.bitwise_count(np.frombuffer(x, _U) ^ np.frombuffer(y, _U)).sum())
                            if len(x) == len(y) else 1 << 40)
            n, m = (np.asarray(batch.column(c)) for c in ("a_n_shingles", "b_n_shingles"))
            near = pa.array(np.array(keep, np.int64) <= allowed(percent, n, m), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(near) for c in ("a", "b")], names=["a", "b"])
    return run
