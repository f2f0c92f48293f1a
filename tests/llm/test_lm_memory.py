"""The language model's tasks hold little beside their rows, and count alike however these are cut."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from mirrorwell.llm import lm_score
from mirrorwell.llm.common import _BATCH_SETTING, BATCH_BYTES

_U = np.uint64
MODEL = lm_score.Model("/nowhere", 4, 1000, 100, 10, {2: (1, 1, 1)}, [5, 4, 3, 2, 9], 100, [5, 4, 3, 2, 9])


def rows(count, words=500, seed=1):
    rng = random.Random(seed)
    texts = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(words)) for _ in range(count)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(count), pa.int64()), pa.array([True] * count), pa.array(texts)],
        names=["doc_id", "held_out", "text"])


def peak_of(step, batch):
    tracemalloc.start()
    out = sum(len(b) for b in step(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


@pytest.mark.parametrize("step, most", [
    (lm_score._word_blobs(4), 65 << 20),
    (lm_score._pair_blobs(4, np.array([1, 2], _U)), 125 << 20),
    (lm_score._score_rows(MODEL), 90 << 20),
])
def test_tasks_take_little_beside_their_texts(step, most):
    batch = rows(4500)
    out, peak = peak_of(step, batch)
    assert out
    assert peak < most


def summed(batches):
    counts = {}
    for batch in batches:
        table = pa.Table.from_batches([batch])
        before, word, n = lm_score._unpack_all(table, 2)
        for a, b, c in zip(before.tolist(), word.tolist(), n.tolist()):
            counts[a, b] = counts.get((a, b), 0) + c
    return counts


def test_counts_do_not_depend_on_the_cut(monkeypatch):
    texts = [None, "", " ", "a b a b A", "a", *rows(30, 40).column("text").to_pylist(), None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    step = lm_score._pair_blobs(3, np.array([1, 2], _U))
    whole = summed(step(iter([batch])))
    assert whole[lm_score.START, lm_score.END] == 4
    monkeypatch.setattr(lm_score, "HASHED_BYTES", 50)
    monkeypatch.setattr(lm_score, "COUNTED_TOKENS", 70)
    cut = [batch.slice(i, n) for i, n in ((0, 1), (1, 0), (1, 9), (10, 26))]
    many = list(step(iter(cut)))
    assert len(many) > 5 and summed(many) == whole


def test_scores_get_wide_rows_a_few_at_a_time(spark, monkeypatch):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 2000) as text")

    def sizes(model):
        def run(batches):
            for batch in batches:
                n = len(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), *[pa.array([batch.nbytes] * n)] * 3,
                     *[pa.array([0.0] * n)] * 2],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        return run

    monkeypatch.setattr(lm_score, "_score_rows", sizes)
    before = spark.conf.getAll.get(_BATCH_SETTING)
    out = lm_score.score_texts(docs, MODEL)
    assert out.agg({"n_tokens": "max"}).first()[0] < 2 * BATCH_BYTES
    assert spark.conf.getAll.get(_BATCH_SETTING) == before


def test_a_bucket_holds_a_task_s_share(spark, monkeypatch):
    """The planner expected 218 MB of documents whose pairs were 800 MB; fourteen buckets were too few. The
    scores do not depend on how many there are."""
    docs = spark.createDataFrame([(i, f"a b c{i % 7} a b d{i}" if i else None) for i in range(60)], "doc_id long, text string")

    def scores(size):
        monkeypatch.setattr(lm_score, "input_bytes", lambda _: size)
        model = lm_score.train(docs.where("doc_id < 50"))
        found = sorted(lm_score.score_texts(docs, model).collect(), key=lambda r: r.doc_id)
        return model.buckets, [(r.n_tokens, r.n_known, r.train_tokens) for r in found], [
            x for r in found for x in (r.base_score, r.score)]

    few, many = scores(0), scores(218 << 20)
    assert few[0] == 4 and many[0] > 40
    assert few[1] == many[1]
    assert np.allclose(few[2], many[2], rtol=1e-12)
