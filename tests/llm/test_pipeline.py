"""The whole chain of stages against plain Python, and on an empty table."""

import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash

import corpus_pipeline
from mirrorwell.llm import mixing, packing, quality

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_print string"
LABELS = "doc_id long, quality int, toxic int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def statistics(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    windows = Counter(zip(w, w[1:], w[2:]))
    met = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    chars, symbols = sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or ""))
    dup = len(lines) - len(set(lines))

    def share(a, b):
        return a / b if b else 0.0

    return {"n_words": len(w), "n_repeat_words": len(met), "chars_per_word": share(chars, len(w)),
            "symbol_share": share(symbols, chars), "dup_line_share": share(dup, len(lines)),
            "repeat_share": share(len(met), len(w)), "symbols_per_word": share(symbols, len(w)),
            "words_per_line": share(len(w), len(lines))}


def judged(docs, labels):
    def failed(s):
        return s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]

    label = {i: q for i, q, _ in labels if i is not None and q is not None}
    rows = [{"doc_id": d[0], "bad": 1 - label[d[0]], **statistics(d[1])} for d in docs if d[0] in label]
    rows = sorted((r for r in rows if not failed(r)),
                  key=lambda r: (r["doc_id"] * 2654435761 & 0xFFFFFFFF, r["doc_id"]))
    rules = quality.learn_rules(rows).rules
    assert rules
    told = [(d, statistics(d[1])) for d in docs]
    return [d for d, s in told if not failed(s) and not any(r.holds(s) for r in rules)]


def cut(docs):
    def key(line):
        return lower(line.strip(SPACES))

    holders = {}
    for d in docs:
        for line in (d[1] or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(-1 if d[0] is None else d[0])
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return [(d[0], "\n".join(x for x in (d[1] or "").split("\n")
                             if gone.get(key(x), d[0]) == d[0]), *d[2:]) for d in docs]


def representatives(docs):
    sets = {}
    for d in docs:
        w = words(lower(d[1]))
        if d[0] is not None and w:
            sets[d[0]] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [d for d in docs if d[0] not in root or find(d[0]) == d[0]]


def mixed(docs):
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sources)}
    size = {s: sum(len(words(d[1])) for d in docs if d[3] == s) for s in sources}
    target, left, open_ = {}, sum(size.values()), set(sources)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * size[s]}
        target |= {s: 3 * size[s] for s in above} if above else share
        left, open_ = left - sum(3 * size[s] for s in above), open_ - above if above else set()
    out = []
    for s in sources:
        mine = [d for d in docs if d[3] == s]
        ranges = int(np.ceil(np.sqrt(len(mine))))
        passes, rest = divmod(int(target[s]), size[s])
        keyed = []
        for d in mine:
            text_hash = xxhash.xxh64_intdigest(d[1].encode(), seed=42)
            first = xxhash.xxh64_intdigest(struct.pack("<i", 0), seed=42)
            if d[0] is not None:
                first = xxhash.xxh64_intdigest(struct.pack("<q", d[0]), seed=first)
            key = xxhash.xxh64_intdigest(struct.pack("<Q", text_hash), seed=first)
            number = int((key >> 32) / 2**32 * ranges)
            keyed.append((number, key - (key >> 63 << 64), -1 if d[0] is None else d[0], d))
        at = 0
        for *_, d in sorted(keyed, key=lambda k: k[:3]):
            n = len(words(d[1]))
            part = min(n, max(0, rest - at))
            at += n
            out += [d] * (passes + (2 * part > n))
    return out


def example():
    rng = random.Random(5)
    vocabulary = [f"word{i}" for i in range(400)] + ["Çédille", "naïve"]
    docs, labels = [], []
    for i in range(150):
        text = "\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(12, 40)))
                         for _ in range(rng.randint(4, 12)))
        if i % 3 == 0:
            text = re.sub(" ", lambda _: rng.choice([" ", " # ", " | "]), text)
        if i % 7 == 1:
            text += "\n  Subscribe to our weekly letter NOW \nown end"
        docs.append((i, text, "en", None if i % 10 == 9 else f"s{i % 4}", len(text), "x"))
        if i < 120:
            labels.append((i, int(i % 3 > 0), 0))
    near = docs[2][1].split()
    for i in range(150, 156):
        text = " ".join(near[:149 - i])
        docs.append((i, text, "en", "s1", len(text), None))
    docs += [docs[2], (160, None, None, "s0", None, None), (161, "", "en", "s2", 0, None),
             (162, "too short", "de", "s2", 9, None), (163, "again and again " * 60, "en", "s3", 960, None),
             (None, docs[4][1], "en", "s0", 1, None), (164, docs[5][1] * 60, "en", "s3", 1, None)]
    return docs, labels + [(None, 0, 0), (3, None, 1)]


def test_pipeline(spark, folder):
    docs, labels = example()
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    kept = judged(docs, labels)
    assert {d[0] for d in docs if d[0] is not None and d[0] < 150 and d[0] % 3} <= {d[0] for d in kept}
    picked = representatives(cut(kept))
    assert len(picked) < len(kept) and any("Subscribe" in a[1] for a in kept)
    expected = Counter()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for d in mixed(picked):
        ids = tokenizer.encode(d[1] or "", add_special_tokens=False).ids + [2]
        head = len(ids) % 1024 or 1024
        starts = [0, *range(head, len(ids), 1024)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected[d[0], n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4"))] += 1
    rows = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in map(sorted, places.values()):
        ends = np.cumsum([n for _, n in p])
        assert [o for o, _ in p] == [0, *ends[:-1]] and ends[-1] <= 1024
    lengths = np.array([r.length for r in rows])
    fewest = int(packing.best_fit_decreasing(lengths)[0].max()) + 1
    assert packing.lower_bound(lengths) <= len(places) <= fewest


def test_pipeline_without_documents(spark, folder):
    for name, schema in (("documents", SCHEMA), ("labels", LABELS)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
