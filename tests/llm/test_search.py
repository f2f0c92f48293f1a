"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from mirrorwell.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id long, print string, m int, class_id string"
ITEMS = "item_id long, text string, no int, score string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, most):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text, *_ in docs]
    sizes = [sum(bag.values()) for _, bag in bags]
    count, total = sum(1 for n in sizes if n), sum(sizes)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item_id, text, *_ in items:
        found = []
        for (doc_id, bag), n in zip(bags, sizes):
            score = 0
            for t, times in Counter(terms(text)).items():
                if t in bag:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    m = 75 + (25 * n * count) // total
                    score += times * w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 12 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(found[:most], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, most):
    got = search.rank_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_terms():
    text = "Ünï-Code A1b2 x_y\x00z\x7f日本 ÀB\tZ9\x80"
    assert [t.decode() for t in search.terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("block,cells", [(8 << 20, 1 << 19), (200, 7)])
def test_as_brute_force(spark, monkeypatch, block, cells):
    """Copies beyond an item's best, equal scores across classes, equal doc_ids, nulls; items in
    one block or many, scores by many or few at a time."""
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    monkeypatch.setattr(search, "CELLS", cells)
    pick = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Été", "日本", "X"]
    texts = [" ".join(pick.choices(words, k=pick.randrange(1, 30))) for _ in range(120)]
    docs = [(1000 - i, t, 1, "mine", 2, "x") for i, t in enumerate(texts)]
    docs += [(2000 + i, "w1 w2 the same text", 1, None, None, None) for i in range(30)]
    docs += [(3000 + i, f"w1 w2 the same {i}x", 1, None, None, None) for i in range(30)]
    docs += [(None, "w1 w2", 0, "", 0, ""), (None, None, 0, "", 0, ""), (7, "", 0, "", 0, ""), (7, "w1", 0, "", 0, ""),
             (7, "w1", 0, "", 0, ""), (8, " -- \n", 0, "", 0, "")]
    docs.append((9, "w3 " * 50_000, 0, "", 0, ""))
    pick.shuffle(docs)
    items = [(i, " ".join(pick.choices(words + ["never", "same"], k=pick.randrange(1, 12))), 5, "s") for i in range(25)]
    items += [(100, None, 1, ""), (101, "", 1, ""), (102, "nowhere else", 1, ""), (None, "w1 W1, w1", 1, ""), (3, "w1", 1, ""), (3, "w1", 1, "")]
    assert found(spark, docs, items, 5) == expected(docs, items, 5)


def test_empty(spark):
    docs = [(1, "a b", 1, "", 1, "")]
    items = [(1, "a", 1, "")]
    assert found(spark, [], items, 3) == [] and found(spark, docs, [], 3) == []
    assert found(spark, [(1, None, 1, "", 1, "")], items, 3) == []
    assert found(spark, docs, items, 3) == expected(docs, items, 3)
