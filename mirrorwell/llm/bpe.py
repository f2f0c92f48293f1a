"""Byte-pair encoding and decoding with a tokenizer file whose words end in a suffix.

A word's symbols are the leaves of a segment tree over the ranks of adjacent pairs. Each
inner node holds the smaller of its two, so the root tells the leftmost pair of lowest rank
by one descent; merging it changes three leaves and the nodes above them. It ends when no
pair in the tree can be merged. A word of n symbols takes n log n steps, however long it is.
Words of like size are merged together, a tree to a row of an array.

The file's own normalizer and pre-tokenizer tell the words; merging, special tokens and
decoding are done here.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.llm.hashing import runs

#: Units (text between white space) that a task remembers, and ids of all of them together;
#: beyond either it forgets them and begins anew.
MEMORY_UNITS = 400_000
MEMORY_IDS = 4_000_000
#: Texts are split in stretches of about so many characters, and encoded in runs of so many bytes: what a
#: run takes beside the memory of units is some 20 times its text.
STRETCH = 1 << 20
TEXT_BYTES = 1 << 20
#: Units normalized by one call, leaves of trees kept in one array, and symbols from which on
#: a word has a tree of its own.
CALL_UNITS = 2000
ARRAY_LEAVES = 1 << 19
LARGE_WORD = 512
# Unicode's White_Space. Neither normalizing nor splitting reaches across it, so units can be
# encoded by themselves. ``str.split`` also splits at the four separators behind it.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_find_units = re.compile(f"[^{_SPACE}]+").findall
_find_space = re.compile(f"[{_SPACE}]").search
_has_separator = re.compile("[\\x1c-\\x1f]").search
_NEVER = (1 << 31) - 1


class RankTree:
    """The smallest rank of a row of leaves, and the leftmost leaf that has it."""

    def __init__(self, ranks: list[int]):
        self.size = 1
        while self.size < len(ranks):
            self.size *= 2
        self.low = [_NEVER] * self.size + ranks + [_NEVER] * (self.size - len(ranks))
        for node in range(self.size - 1, 0, -1):
            self.low[node] = min(self.low[2 * node], self.low[2 * node + 1])

    @property
    def least(self) -> int:
        return self.low[1]

    def leftmost(self) -> int:
        low, node = self.low, 1
        while node < self.size:
            node *= 2
            if low[node] > low[node + 1]:
                node += 1
        return node - self.size

    def put(self, leaf: int, rank: int) -> None:
        low, node = self.low, leaf + self.size
        low[node] = rank
        while node > 1:
            node //= 2
            least = min(low[2 * node], low[2 * node + 1])
            if low[node] == least:
                return
            low[node] = least


class PairTable:
    """Ranks of pairs of ids and what they merge to, from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        if (model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback")
                or model.get("ignore_merges") or model.get("continuing_subword_prefix")
                or told.get("post_processor") or told.get("decoder")):
            raise ValueError(f"{path} is not a plain BPE file without decoder and post-processor")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.unknown = self.ids.get(model.get("unk_token"))
        if self.unknown is not None:
            raise ValueError(f"{path} has an unknown token")
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        pairs = [(self.ids[one], self.ids[two], self.ids[one + two]) for one, two in pairs]
        #: Of a pair given twice the last rank holds.
        self.ranks = {(one, two): rank for rank, (one, two, _) in enumerate(pairs)}
        self.merged = [new for *_, new in pairs]
        keys = np.array([(one << 32) | two for one, two in self.ranks], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.key_ranks = np.append(np.array(list(self.ranks.values()), np.int64)[order], _NEVER)
        self.merged_ids = np.append(np.array(self.merged, np.int64), 0)
        self.special: dict[str, int] = {}
        for token in told.get("added_tokens", []):
            if token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"{path}: added token {token['content']!r} is matched in a way of its own")
            self.special[token["content"]] = token["id"]
        largest = max([*self.ids.values(), *self.special.values()], default=-1)
        self.tokens: list[str | None] = [None] * (largest + 1)
        for token, number in chain(self.ids.items(), self.special.items()):
            self.tokens[number] = token

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the words' characters, the last with the suffix; those the
        file does not know are left out."""
        sizes = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        known, place = np.unique(text, return_inverse=True)
        inner = np.array([self.ids.get(chr(c), -1) for c in known], np.int64)
        last = np.array([self.ids.get(chr(c) + self.suffix, -1) for c in known], np.int64)
        ids = inner[place] if len(text) else np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        at = ends[sizes > 0] - 1
        ids[at] = last[place[at]]
        there = np.concatenate([[0], np.cumsum(ids >= 0)])
        return ids[ids >= 0], np.concatenate([[0], there[ends]])

    def ranks_of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``_NEVER`` where there is none or an id is negative."""
        key = (one << 32) | two
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (two >= 0), self.key_ranks[at], _NEVER)

    def merge(self, symbols: list[int]) -> list[int]:
        """One word's symbols after all merges, lowest rank first, of equal ranks the leftmost."""
        count = len(symbols)
        rank = self.ranks.get
        ranks = [rank(pair, _NEVER) for pair in zip(symbols, symbols[1:])]
        if not ranks or min(ranks) == _NEVER:
            return symbols
        symbols = list(symbols)
        tree = RankTree(ranks)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        while (least := tree.least) < _NEVER:
            at = tree.leftmost()
            gone = after[at]
            symbols[at], symbols[gone] = self.merged[least], -1
            right = after[at] = after[gone]
            if gone < count - 1:
                tree.put(gone, _NEVER)
            if right < count:
                before[right] = at
                tree.put(at, rank((symbols[at], symbols[right]), _NEVER))
            else:
                tree.put(at, _NEVER)
            left = before[at]
            if left >= 0:
                tree.put(left, rank((symbols[left], symbols[at]), _NEVER))
        return [s for s in symbols if s >= 0]


    def merge_all(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of every word ``ids[offsets[i]:offsets[i + 1]]``, in the same form."""
        sizes = np.diff(offsets)
        out, held = np.zeros(len(ids), np.int64) - 1, np.zeros(len(sizes), np.int64)
        leaves = 1
        while leaves // 2 < sizes.max(initial=0) and leaves <= LARGE_WORD:
            rows = np.flatnonzero((sizes <= leaves) & (sizes > leaves // 2))
            for first in range(0, len(rows), max(1, ARRAY_LEAVES // leaves)):
                some = rows[first:first + max(1, ARRAY_LEAVES // leaves)]
                place = offsets[some][:, None] + np.arange(leaves)
                inside = np.arange(leaves) < sizes[some][:, None]
                words = np.where(inside, ids[np.where(inside, place, 0)], -1)
                merged = self._merge_rows(words)
                left = merged >= 0
                held[some] = left.sum(axis=1)
                # what is left of a word moves to the front of its place
                front = offsets[some][:, None] + np.cumsum(left, axis=1) - 1
                out[front[left]] = merged[left]
            leaves *= 2
        for row in np.flatnonzero(sizes > LARGE_WORD):
            merged = self.merge(ids[offsets[row]:offsets[row + 1]].tolist())
            held[row] = len(merged)
            out[offsets[row]:offsets[row] + len(merged)] = merged
        return out[out >= 0], np.concatenate([[0], np.cumsum(held)])

    def _merge_rows(self, words: np.ndarray) -> np.ndarray:
        """Words of at most as many symbols as there are columns (a power of two), -1 behind
        and in place of symbols merged away."""
        count, width = words.shape
        if width == 1:
            return words
        result = words.copy()
        words = np.concatenate([words, np.full((count, 1), -1)], axis=1)
        low = np.full((count, 2 * width), _NEVER, np.int64)
        low[:, width:] = self.ranks_of(words[:, :-1], words[:, 1:])
        half = width
        while half > 1:
            low[:, half // 2:half] = np.minimum(low[:, half:2 * half:2], low[:, half + 1:2 * half:2])
            half //= 2
        after = np.tile(np.arange(1, width + 2), (count, 1))
        before = np.tile(np.arange(-1, width), (count, 1))
        rows = np.arange(count)
        while True:
            going = low[:, 1] < _NEVER
            if not going.all():
                result[rows[~going]] = words[~going, :-1]
                words, low, after, before, rows = (x[going] for x in (words, low, after, before, rows))
            if not len(rows):
                return result
            here = np.arange(len(rows))
            node = np.ones(len(rows), np.int64)
            step = 1
            while step < width:
                node *= 2
                node += low[here, node] > low[here, node + 1]
                step *= 2
            at = node - width
            gone = after[here, at]
            right = after[here, gone]
            words[here, at] = self.merged_ids[low[:, 1]]
            words[here, gone] = -1
            after[here, at] = right
            inside = right <= width
            before[here[inside], right[inside]] = at[inside]
            left = before[here, at]
            new = words[here, at]
            low[here, width + np.minimum(gone, width - 1)] = np.where(
                gone < width, _NEVER, low[here, 2 * width - 1])
            low[here, node] = self.ranks_of(new, words[here, np.minimum(right, width)])
            first = left >= 0
            low[here[first], width + left[first]] = self.ranks_of(words[here[first], left[first]], new[first])
            climb = [node, width + np.minimum(gone, width - 1), np.where(first, width + left, node)]
            for _ in range(width.bit_length() - 1):
                for i, at_node in enumerate(climb):
                    climb[i] = up = at_node // 2
                    low[here, up] = np.minimum(low[here, 2 * up], low[here, 2 * up + 1])


class _Numbers(dict):
    """Numbers from 0 on for strings; those met for the first time are listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class _Rows:
    """Arrays of ids by number, end to end."""

    def __init__(self):
        self.values, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def append(self, values: np.ndarray, offsets: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, offsets[1:] + len(self.values)])
        self.values = np.concatenate([self.values, values.astype(np.int32)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(values, offsets)`` of the rows of these numbers, one after the other."""
        begin = self.ends[numbers]
        sizes = self.ends[numbers + 1] - begin
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return (self.values[np.repeat(begin - (ends - sizes), sizes) + np.arange(total)],
                np.concatenate([[0], ends]))


class Encoder:
    """Ids of texts by way of their units, remembered within bounds. One to a task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.table = PairTable(path)
        rules = Tokenizer.from_file(path)
        self.normalize = rules.normalizer.normalize_str if rules.normalizer else str
        self.split = rules.pre_tokenizer.pre_tokenize_str if rules.pre_tokenizer else (lambda s: [(s, (0, len(s)))])
        special = sorted(self.table.special, key=len, reverse=True)
        self.parts = re.compile(f"({'|'.join(map(re.escape, special))})") if special else None
        self.forget()

    def forget(self) -> None:
        self.units, self.unit_ids = _Numbers(), _Rows()
        self.words, self.word_ids = _Numbers(), _Rows()

    def _words_of(self, units: list[str]) -> list[list[str]]:
        """The words of each unit, as the file normalizes and splits; a special token is a
        word of its own, marked by its number."""
        if self.parts is not None and self.parts.search(" ".join(units)):
            found = []
            for unit in units:
                words: list = []
                for part in filter(None, self.parts.split(unit)):
                    number = self.table.special.get(part)
                    words += [number] if number is not None else self._words_of([part])[0]
                found.append(words)
            return found
        joined = self.normalize(" ".join(units))
        spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
        if len(spaces) != len(units) - 1:
            return [[w for w, _ in self.split(self.normalize(u))] for u in units]
        found = [[] for _ in units]
        words = self.split(joined)
        for owner, (word, _) in zip(np.searchsorted(spaces, [at for _, (at, _) in words]).tolist(), words):
            found[owner].append(word)
        return found

    def _learn(self) -> None:
        """Take up the units and words met for the first time, in the order of their numbers."""
        units, self.units.new = self.units.new, []
        if not units:
            return
        number = self.words.__getitem__
        owned: list[int] = []  # words by number, special tokens as negative ones
        sizes = []
        for first in range(0, len(units), CALL_UNITS):
            for words in self._words_of(units[first:first + CALL_UNITS]):
                sizes.append(len(words))
                owned += [number(w) if isinstance(w, str) else ~w for w in words]
        new, self.words.new = self.words.new, []
        self.word_ids.append(*self.table.merge_all(*self.table.symbols(new)))
        owned = np.array(owned, np.int64)
        plain = owned >= 0
        # a special token is one id; the ids of plain words come from the memory
        values, offsets = self.word_ids.take(owned[plain])
        counts = np.ones(len(owned), np.int64)
        counts[plain] = np.diff(offsets)
        out = np.zeros(int(counts.sum()), np.int32)
        inside = np.repeat(plain, counts)
        out[inside], out[~inside] = values, ~owned[~plain]
        ends = np.concatenate([[0], np.cumsum(counts)])
        self.unit_ids.append(out, ends[np.concatenate([[0], np.cumsum(sizes)])])

    def _units_of(self, text: str) -> Iterator[list[str]]:
        at = 0
        while at < len(text):
            cut = _find_space(text, at + STRETCH) if at + STRETCH < len(text) else None
            end = cut.start() if cut else len(text)
            part = text[at:end] if at or cut else text
            yield _find_units(part) if _has_separator(part) else part.split()
            at = end

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the texts."""
        if max(len(self.units), len(self.words)) > MEMORY_UNITS or len(self.unit_ids.values) > MEMORY_IDS:
            self.forget()
        number = self.units.__getitem__
        numbers, sizes = [], []
        for text in texts:
            before = len(numbers)
            for units in self._units_of(text or ""):
                numbers.extend(map(number, units))
            sizes.append(len(numbers) - before)
        self._learn()
        ids, ends = self.unit_ids.take(np.array(numbers, np.int64))
        return ids, ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]


def _encoded(path: str, text: str, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for first, last in runs(batch.column(text), TEXT_BYTES):
                part = batch.slice(first, last - first)
                ids, ends = encoder.encode(part.column(text).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names[:-1]), lists], names=names)
    return run


def _with(df: DataFrame, name: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    """Columns of ``df`` but one called ``name``, which comes anew and last."""
    kept = [f for f in df.schema if f.name.lower() != name.lower()]
    return [f.name for f in kept] + [name], T.StructType([*kept, T.StructField(name, kind)])


def encode_texts(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of the whole ``text``, an array of int, as ``ids``.

    The ids are those of the ``tokenizers`` library for the file at ``path`` (which every
    executor must reach) with no special tokens added; strings of special tokens within a
    text are those tokens. Null and empty texts have no ids. A row stays a row: repeated
    rows are encoded each, null doc_ids stay, an empty table gives an empty table. Other
    columns stay as they are, but a column called like ``ids`` is replaced.
    """
    docs = docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    names, schema = _with(docs, ids, T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(_encoded(path, text, names), schema)


def decode_ids(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the decoded ``ids`` as ``text``: the tokens joined by one space, as a file
    without a decoder is decoded, special tokens included.

    Null ids count as none; a null within them and a number no token has are left out. A column
    called like ``text`` is replaced, all others stay. The file is read once, here; the plan
    carries its tokens as one constant and rows need no Python.
    """
    tokens = F.from_json(F.lit(json.dumps(PairTable(path).tokens)), "array<string>")
    given = F.col(f"`{ids}`")
    if docs.select(given).schema[0].dataType.elementType == T.LongType():
        # beyond an int no token has a number
        given = F.transform(given, lambda i: F.when(i.between(0, (1 << 31) - 1), i).cast("int"))
    found = F.transform(given, lambda i: F.get(tokens, i))
    names, _ = _with(docs, text, T.StringType())
    return docs.select(*(F.col(f"`{n}`") for n in names[:-1]),
                       F.coalesce(F.array_join(found, " "), F.lit("")).alias(text))
