"""A pair that shares several keys is named by the smallest, and never lost."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from mirrorwell.llm import near_dup
from mirrorwell.llm.common import _BATCH_SETTING, BATCH_BYTES, small_batches


def named(key, heads, side=(2, 2, 2), component=(1, 2, 3)):
    sketch = np.zeros(1, np.uint64).tobytes()
    rows = pa.table({"key": [key] * 3, "node": [3, 1, 2], "component": [component[i] for i in (2, 0, 1)],
                     "n_shingles": [20] * 3, "side": [side[i] for i in (2, 0, 1)], "sketch": [sketch] * 3,
                     "heads": [heads[i] for i in (3, 1, 2)]})
    out = near_dup._near_in_group(80)(rows)
    return sorted(zip(out.column("a").to_pylist(), out.column("b").to_pylist()))


def test_smallest_shared_key_names_a_pair():
    heads = {1: [-5, 7], 2: [-5, 7, 9], 3: [7, 9]}
    assert named(-5, heads | {3: []}) == [(1, 2), (1, 3), (2, 3)]
    assert named(7, heads) == [(1, 3), (2, 3)]
    assert named(9, heads) == []


def test_pairs_of_unlisted_keys_and_of_blocks():
    none = {1: [], 2: [], 3: []}
    assert named(50, none) == [(1, 2), (1, 3), (2, 3)]
    assert named(50, none, component=(1, 1, 3)) == [(1, 3), (2, 3)]
    assert named(50, none, side=(0, 1, 1)) == [(1, 2), (1, 3)]


def test_keys_to_reopen(spark):
    """Not those of two members, of one component, or with the members of another key of the band."""
    def key(number, band):
        return (number << near_dup.BAND_BITS) | band

    members = {key(1, 0): [1, 2], key(2, 0): [1, 2, 3], key(3, 0): [1, 2, 3], key(4, 1): [1, 2, 3],
               key(5, 0): [4, 5, 6], key(6, 0): [1, 2, 4]}
    component = {n: 4 if n > 3 else n for n in range(1, 7)}
    rows = [(k, n, component[n]) for k, nodes in members.items() for n in nodes]
    placed = spark.createDataFrame(rows, "key long, node long, component long")
    found = {r.key for r in near_dup.keys_to_reopen(placed).collect()}
    assert found == {key(2, 0), key(4, 1), key(6, 0)}


def test_a_bucket_of_keys_is_small():
    """What one task gets of texts without copies, by the number of buckets for so many bytes."""
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(100, 500))) for _ in range(400)]
    batch = pa.record_batch([pa.array(range(400), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    sent = sum(out.column(name).nbytes for out in near_dup._piece_blobs(5, 80, 8)(iter([batch]))
               for name in ("keys", "docs"))
    share = sent / sum(len(t) for t in texts)
    assert share * near_dup.BUCKET_BYTES / 2 < 12 << 20


def test_met_keys_holds_little_beside_its_bucket():
    rng = np.random.default_rng(1)
    keys = [rng.permutation(np.arange(i * 50_000, (i + 1) * 50_000, dtype=np.uint64)) for i in range(10)]
    keys[3][:3] = keys[7][:3]
    docs = [np.full(50_000, i, np.int64) for i in range(10)]
    table = pa.table({"keys": [k.tobytes() for k in keys], "docs": [d.tobytes() for d in docs]})
    size = sum(k.nbytes for k in keys + docs)
    tracemalloc.start()
    out = near_dup._met_keys(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(out.column("doc_id").to_pylist()) == [3, 3, 3, 7, 7, 7]
    assert sorted(set(out.column("key").to_pylist())) == sorted(keys[7][:3].tolist())
    assert peak < 2 * size


def test_sets_of_texts_take_little_beside_them():
    rng = random.Random(2)
    texts = pa.array([" ".join(f"w{rng.randrange(10**5)}" for _ in range(500)) for _ in range(1500)])
    tracemalloc.start()
    sets = sum(1 for _ in near_dup.shingle_sets(texts, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sets == 1500
    assert peak < 32 << 20


def test_python_gets_wide_rows_a_few_at_a_time(spark, monkeypatch):
    """In the operator too, which leaves the session's setting as it was."""
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 2000) as text")

    def largest(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([batch.nbytes], pa.int64())})

    seen = []
    monkeypatch.setattr(near_dup, "_near_components", lambda d, *_: seen.append(
        d.mapInArrow(largest, "bytes long").agg({"bytes": "max"}).first()[0]))
    before = spark.conf.getAll.get(_BATCH_SETTING)
    near_dup.near_components(docs)
    assert seen[0] < 2 * BATCH_BYTES
    assert spark.conf.getAll.get(_BATCH_SETTING) == before
    spark.conf.set(_BATCH_SETTING, "1000000")
    try:
        with small_batches(spark):
            pass
        assert spark.conf.get(_BATCH_SETTING) == "1000000"
    finally:
        spark.conf.unset(_BATCH_SETTING)
