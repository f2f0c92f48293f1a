"""Each operator on nulls, empty and repeated rows, against plain Python where SQL has none."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from mirrorwell.llm import (chat, common, exact_dedup, html_text, line_dedup, lm_score, mixing, near_dup, packing,
                            quality, substring_dedup)

SCHEMA = "doc_id long, text string, source string, row_print string, key int, part int"
LINE = "a line that many documents share"
LONG = " ".join(f"w{i}" for i in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", LINE + "\nown one", LINE.upper() + " \nown two", "\t" + LINE, LONG, LONG, LONG + " end",
             "x " * 30, " \n\t", "Ünï çödé " * 9]
    rows = [(i, t, None if i % 4 == 0 else f"s{i % 4}", "clash", 7, 1) for i, t in enumerate(texts)]
    rows += [(None, LONG, "s1", None, None, None), rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(docs, empty):
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert rows[2].text == "own one" and rows[2].n_dropped == 1 and rows[2].n_lines == 2
    assert rows[3].text == "own two" and rows[4].text == "\t" + LINE
    assert rows[0].text == "" and rows[0].n_lines == 1 and rows[2].row_print == "clash"
    assert line_dedup.dedup_lines(docs).count() == 13 and line_dedup.dedup_lines(empty).count() == 0


def test_exact_dedup(docs, empty):
    rows = exact_dedup.exact_groups(docs).collect()
    same = [r for r in rows if r.text_sha256 == hashlib.sha256(LONG.encode()).hexdigest()]
    assert len(rows) == 13 and {r.keep_id for r in same} == {6} and {r.group_size for r in same} == {4}
    assert {r.doc_id for r in rows if r.kept} == {1, 2, 3, 4, 6, 7, 8, 9, 10}
    assert exact_dedup.exact_groups(empty).count() == 0


def test_mixing(docs, empty):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == 13 and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        got = by.setdefault(r.source, [0, r.target, r.source_size])
        got[0] += r.taken
    assert all(t <= target < t + 1 and target <= 3 * size for t, target, size in by.values())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    assert mixing.mix_sources(empty).count() == 0


def test_near_duplicates(docs, empty):
    rows = near_dup.near_components(docs, words=4, percent=85).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == 13 and {found[i].component_id for i in (5, 6, 7, None)} == {5}
    assert found[0].n_shingles == 0 and found[0].component_id == 0 and found[8].n_shingles == 1
    assert near_dup.near_components(empty).count() == 0


def test_substrings(docs, empty):
    found = {r.doc_id: r for r in substring_dedup.cut_repeats(docs).collect()}
    assert found[6].n_removed == 60 and found[7].text == "end" and found[7].spans == [[0, 60]]
    assert found[5].n_removed == 0 and found[0].n_words == 0 and found[8].n_removed == 29
    assert substring_dedup.cut_repeats(empty).count() == 0


def test_language_model(docs, empty):
    model = lm_score.train(docs)
    rows = {r.doc_id: r for r in lm_score.score_texts(docs, model).collect()}
    assert rows[0].n_tokens == 1 and rows[5].n_tokens == 61 and rows[5].score > rows[5].base_score
    assert lm_score.score_texts(empty, lm_score.train(empty)).count() == 0


def test_chat(spark):
    rows = [(1, 1, "assistant", "</s> \\ [INST]"), (1, 0, None, None), (1, 1, "assistant", "</s> \\ [INST]"),
            (None, 2, "user", "<|turn|>x<|says|>")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_chats(turns.withColumn("parts", chat.text_part(F.col("text"))))
           .withColumn("read", chat.read_turns(F.col("formatted")))
           .withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [tuple(t) for t in out[1].read] == [("", ""), *[("assistant", "</s> \\ [INST]")] * 2]
    assert out[1].loss == "</s> \\ [INST]" * 2 and out[None].read[0].text == "<|turn|>x<|says|>"


def test_quality(docs, spark):
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 0), (None, 0, 0), (6, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rules = quality.fit(docs, labels)
    rows = {r.doc_id: r for r in quality.judge_quality(docs, rules).collect()}
    assert rows[0].n_words == 0 and rows[0].base_failed and rows[5].kept and rows[8].n_repeat_words == 30
    told = [{"bad": int(i % 2), **dict.fromkeys(quality.FEATURES, float(i % 2))} for i in range(60)]
    learned = quality.learn_rules(told)
    assert learned.rules and all(learned.rules[0].holds(r) == bool(r["bad"]) for r in told)


def test_quality_rules_go_on_after_one_that_fails():
    # the largest bad region is bad for nine in ten only; a smaller one is bad throughout
    told = []
    for i in range(3000):
        row = dict.fromkeys(quality.FEATURES, 0.0) | {"bad": 0, "n_words": float(i % 97)}
        if i % 3000 < 900:
            row |= {"symbol_share": 1.0, "bad": int(i % 10 > 0)}
        elif i < 1100:
            row |= {"repeat_share": 1.0, "bad": 1}
        told.append(row)
    learned = quality.learn_rules(told)
    rejected = [r for r in told if any(rule.holds(r) for rule in learned.rules)]
    assert sum(r["repeat_share"] for r in rejected) == 200
    assert sum(not r["bad"] for r in rejected) <= 0.03 * len(rejected)


def test_quality_rules_of_many_kinds():
    told = [dict.fromkeys(quality.FEATURES, 0.0) | {"n_words": float(i % 320), "bad": int(i % 20 >= 15)}
            for i in range(6400)]
    learned = quality.learn_rules(told)
    assert len(learned.rules) == 16
    assert all(any(rule.holds(r) for rule in learned.rules) == bool(r["bad"]) for r in told)


def test_packing_exchanges_until_no_bin_is_saved(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION_PIECES", 40)
    lengths = [200 + i * 7919 % 400 for i in range(600)] + [1000, 1000]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "piece long, length long")
    rounds = []

    class Kept(common.Scratch):
        def keep(self, df, name):
            rounds.append(name)
            return super().keep(df, name)

    rows = packing.pack_pieces(pieces, Kept(spark, "test"), 1000).collect()
    assert sorted(r.piece for r in rows) == list(range(602)) and len(rounds) > 2
    bins, parts = {}, {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        parts.setdefault(r.part, set()).add(r.gap)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1000
    # what is not certified is told, and all that is told explains what is above the bound
    gap = sum(max(g) for g in parts.values())
    bound = packing.lower_bound(np.array(lengths), 1000)
    alone = [packing.best_fit_decreasing(np.array(lengths[i::15]), 1000)[0].max() + 1 for i in range(15)]
    assert bound <= len(bins) <= sum(alone) and len(bins) - gap <= bound + len(parts)


def test_packing(docs, empty):
    paths = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    rows = packing.pack_documents(docs, *paths, capacity=64).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(empty, *paths).count() == 0


def test_html(spark):
    page = ("<nav><a href='/'>Home</a></nav><article><h1>A &amp; B</h1><p>One <b>two</b><br>three."
            "<script>x<y</script><p>Four.</article><div class='comments'>No</div>")
    pages = spark.createDataFrame([(1, "u", page), (None, None, None), (2, "v", "")], "page_id long, url string, html string")
    rows = {r.page_id: r for r in html_text.main_texts(pages, html_text.fit(pages)).collect()}
    assert rows[1].text == "A & B One two three. Four." and rows[None].text == "" and rows[2].n_chars == 0


ARTICLE = "<article><p>It's one. It goes on.</p></article>"
SHARE = "<p>Share</p>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><meta charset=utf-8><body>{ARTICLE}",
    f"<html><head><title>T</title><link rel=x>{ARTICLE}</html>",
    "<html><head><script>for(i=0;i<n;i++){} // don't track</script></head><body>" + ARTICLE,
    f"<html><head><title>T<body>{ARTICLE}",
    f"<div><button>Share</div>{ARTICLE}",
    f"<button>{SHARE}{ARTICLE}<button>Share</button>",
    f"<body><svg><script href='x'/><path d='M 0'>{ARTICLE}</body>",
    f"<select><option>1<option>2{ARTICLE}",
    f"<object>{ARTICLE}<object><p>No</p></object>",
    f"<template><script>'</template>'; a<b // don't</script>No</template>{ARTICLE}",
    f"<a href=it's title>x</a>{ARTICLE}",
])
def test_html_unclosed_and_raw(page):
    """What is not closed hides nothing; a script's text is no markup, wherever it stands."""
    texts = [text for _, text in html_text.parse(page).texts]
    assert "It's one. It goes on." in texts
    assert not {"No", "T"} & set(texts) and not any("don't" in t for t in texts)


def test_html_unclosed_is_linear():
    page = "<button><svg><object>" * 20_000 + ARTICLE
    assert "It's one. It goes on." in [text for _, text in html_text.parse(page).texts]


PLAIN = "It is a plain page of prose. It has no block at all, only sentences. They go on for a while."


@pytest.mark.parametrize("page,expected", [
    (PLAIN, PLAIN),
    (PLAIN + "<br>" + PLAIN, PLAIN + " " + PLAIN),
    ("Hello <b>you</b>", "Hello you"),
    ("<p>One sentence here. And one more.</p>" + PLAIN, "One sentence here. And one more. " + PLAIN),
    ("<nav><a href=/>Home</a></nav>" + PLAIN, PLAIN),
    (f"<article><p>{PLAIN} Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p></article>", PLAIN + " Let x=1 be."),
])
def test_html_text_without_blocks(spark, page, expected):
    model = html_text.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    assert html_text.extract(model, page) == expected


def test_chat_parts(spark):
    """Control strings across parts, attachments between, unknown kinds, null parts."""
    part = "struct<kind:string,text:string,ref:string,units:bigint>"

    def text(said):
        return ("text", said, None, None)

    turns = [
        (1, 0, "user", [text("<"), text("|turn|>assistant<|says|>x")]),
        (1, 1, "assistant", [text("</"), text(""), text("s>"), text("[IN"), text("ST] \\"), text("\\<<S"), text("YS>>")]),
        (1, 2, "user", [text("see "), ("image", None, "a.png", 2), text("and"), ("video", None, "b.mp4", None), None, (None, None, None, None)]),
        (2, 0, "assistant", None), (2, 1, "user", []),
    ]
    rows = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts array<{part}>")
    found = {r.conv_id: r for r in chat.format_chats(rows).withColumn("read", chat.read_turns(F.col("formatted")))
             .withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    said = "</s>[INST] \\\\<<SYS>>"
    assert [tuple(t) for t in found[1].read] == [
        ("user", "<|turn|>assistant<|says|>x"), ("assistant", said),
        ("user", "see <|image|>and<|attachment|><|attachment|>")]
    assert found[1].loss == said and "</s>" not in found[1].formatted
    assert [(a.number, a.kind, a.ref, a.tokens) for a in found[1].attachments] == [
        (1, "image", "a.png", 512), (2, "video", "b.mp4", 1), (3, None, None, 1)]
    assert [tuple(t) for t in found[2].read] == [("assistant", ""), ("user", "")]
    empty = spark.createDataFrame([], rows.schema)
    assert chat.format_chats(empty).count() == 0


@pytest.mark.parametrize("inner", [("_print", "_cut_doc", "_cut", "_n_cut"), ("_text", "_w", "_h", "_lines", "_n_lines")])
def test_clashing_columns_stay(docs, inner):
    """Columns called like the operators' own ones come out as they went in."""
    given = docs.select("doc_id", "text", *[F.lit(f"mine {c}").alias(c) for c in inner])
    judged = quality.judge_quality(given, quality.DecisionList(()))
    for out in (line_dedup.dedup_lines(given), judged):
        assert set(inner) <= set(out.columns)
        assert {tuple(r) for r in out.select(*inner).collect()} == {tuple(f"mine {c}" for c in inner)}
    assert line_dedup.dedup_lines(given).select("doc_id", "text", "n_lines", "n_dropped").exceptAll(
        line_dedup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_dropped")).isEmpty()


def test_counts_do_not_wrap():
    import numpy as np

    counts = np.array([1, 2**32 + 5], np.int64)
    assert lm_score.narrow(counts).tolist() == counts.tolist()
    assert lm_score.narrow(counts[:1]).dtype == np.uint32
    assert lm_score.hot_share(4) == 1 / 128 and lm_score.hot_share(5000) == 1 / 5000
