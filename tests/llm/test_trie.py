"""The trie against one of nested dictionaries."""

import hashlib
import math
import random
import zlib

import pytest

from mirrorwell.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string"


def rebuilt(rows):
    """Conversations as lists of turns, rebuilt from the stated rule."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(math.fmod(conv, 100))  # % as SQL has it, with the sign of conv
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def nested(convs):
    """Every node by plain recursion over prefixes."""
    members = {}
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def total(node):
        leaves, saved = 0, (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for child in kids.get(node, ()):
            a, b = total(child)
            leaves, saved = leaves + a, saved + b
        return leaves or 1, saved

    out = []
    for node, inside in members.items():
        leaves, saved = total(node)
        ends = ",".join(str(c) for c in sorted(c for c in inside if len(convs[c]) == len(node)))
        out.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
                    len(kids.get(node, ())), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(spark, rows, **options):
    turns = spark.createDataFrame(rows, SCHEMA)
    got = trie.conversation_trie(turns, openings=True, **options).collect()
    return sorted((tuple(r) for r in got), key=lambda r: r[:2])


def made(seed, convs, turns, kinds):
    pick = random.Random(seed)
    rows = []
    for conv in convs:
        for turn in range(pick.randrange(turns + 1)):
            rows.append((conv, turn, pick.choice(["user", "assistant"]), "x" * pick.randrange(kinds), 1, "clash"))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [1, 300, 5000, 1 << 20])
def test_as_nested_dictionaries(spark, most):
    """Containers from single paths to all in one; many shared prefixes and copies."""
    rows = made(7, range(0, 260), 7, 3)
    rows += [(conv, turn, "user", "same", 1, "") for conv in range(300, 360) for turn in range(9)]
    rows += [(conv, turn, "user", "same" if turn < 40 else f"{conv}", 1, "") for conv in (401, 402, 403) for turn in range(45)]
    assert found(spark, rows, most=most) == nested(rebuilt(rows))


def test_odd_rows(spark):
    """Nulls everywhere, equal turns, repeated rows, an absent base, no turns left, one id below 0."""
    rows = [(1, None, None, None, 1, ""), (1, 0, "user", "a", 1, ""), (1, 0, "user", "a", 1, ""), (1, 0, "assistant", "b", 1, ""),
            (None, 0, "user", "a", 1, ""), (205, 3, "user", "é" * 70_000, 1, ""), (-7, 0, "", "x", 1, ""), (0, 0, "u", "user", 1, "")]
    rows += [(c, 0, "user", "one turn", 1, "") for c in range(100, 140)] + [(3, t, "r", "long", 1, "") for t in range(400)]
    assert found(spark, rows) == nested(rebuilt(rows))


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x", 1, "")]) == []


def test_as_given(spark):
    rows = [(5, 0, "a", "x", 1, ""), (6, 0, "a", "x", 1, ""), (6, 1, "a", "yy", 1, "")]
    got = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens)
            for r in got} == {(5, 0): (None, 2, 1, 1, 1), (5, 1): (5, 2, 1, 1, 1), (6, 2): (5, 1, 0, 1, 0)}
