"""Quality rules: a decision list learned by sequential covering.

Statistics of whole texts are built-in expressions on the row. From labelled rows, rules
(conjunctions of thresholds) are grown on one part and pruned on another until no
rejected row is left to cover; the list comes out as an ordered Spark conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import SPACE_RUN, SPACES, shielded, text_of, words_of

#: The list is fitted on so many labelled rows at most (those of the smallest hash).
FIT_ROWS = 8_000
MAX_CONDITIONS = 4
#: A rule must be right on so large a share of the rows held back for pruning, and find so many.
MIN_PRECISION = 0.97
MIN_FOUND = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics a rule may test: ratios, so that a rule means the same for any length.
FEATURES = ("n_words", "chars_per_word", "symbol_share", "dup_line_share", "repeat_share",
            "symbols_per_word", "words_per_line")


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` plus :data:`STATISTICS` and :data:`FEATURES` of the whole text.

    A null or empty text has no words and no lines with a word. Columns of these names
    are replaced, others stay.
    """
    docs, back = shielded(docs, ("_text", "_w", "_h", "_s", "_starts", "_lines", "_n_lines"))
    own = [c for c in docs.columns if c not in STATISTICS + FEATURES]
    d = docs.select(*own, text_of().alias("_text"))
    d = d.select(*own, "_text", words_of(F.col("_text")).alias("_w"))
    n = F.greatest(F.size("_w") - 2, F.lit(0))
    three = F.arrays_zip(*[F.slice("_w", i + 1, n).alias(f"w{i}") for i in range(3)])
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.select(
        *own, F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_text", SPACE_RUN, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform(three, lambda t: F.xxhash64(t["w0"], t["w1"], t["w2"])).alias("_h"))
    d = d.withColumn("_s", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    size = F.size("_s")
    met = F.filter(
        F.zip_with(F.zip_with("_s", F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")),
                                             F.slice("_s", 1, size - 1)),
                              lambda a, b: F.struct(a["i"].alias("i"), a["h"].alias("h"),
                                                    a["h"].eqNullSafe(b["h"]).alias("before"))),
                   F.slice("_s", 2, size - 1),
                   lambda a, b: F.struct(a["i"].alias("i"),
                                         (a["before"] | a["h"].eqNullSafe(b["h"])).alias("met"))),
        lambda x: x["met"])
    d = d.withColumn("_starts", F.sort_array(F.transform(met, lambda x: x["i"])))
    covered = F.aggregate(
        F.zip_with("_starts", F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(0))),
                   lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0), lambda total, x: total + x)
    d = d.select(
        *own, "n_words", "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    # the generator keeps later filters on these columns from being pushed into all of the above
    return d.select(*own, F.inline(F.array(F.struct(
        *STATISTICS, share("word_chars", "n_words").alias("chars_per_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "_n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_words", "_n_lines").alias("words_per_line"))))).withColumnsRenamed(back)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value >= self.threshold if self.above else value <= self.threshold

    def holds(self, row: dict) -> bool:
        value = row[self.feature]
        return value >= self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the document is rejected."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = self.conditions[0].column()
        for condition in self.conditions[1:]:
            out &= condition.column()
        return out

    def holds(self, row: dict) -> bool:
        return all(c.holds(row) for c in self.conditions)


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a document that none of them meets is kept."""

    rules: tuple[Rule, ...]

    def rule_number(self) -> Column:
        """The first rule that holds, from 1; null if none does."""
        out = F.lit(None).cast("int")
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(rule.column(), F.lit(number)).otherwise(out)
        return out

    def keeps(self) -> Column:
        return self.rule_number().isNull()


def _counts(rows: Sequence[dict]) -> tuple[int, int]:
    bad = sum(r["bad"] for r in rows)
    return bad, len(rows) - bad


def _best_condition(rows: Sequence[dict]) -> tuple[float, Condition | None]:
    """The threshold of the largest information gain over the rows a rule still covers."""
    bad, good = _counts(rows)
    if not bad or not good:
        return 0.0, None
    prior = math.log2(bad / (bad + good))
    best: tuple[float, Condition | None] = (0.0, None)
    for feature in FEATURES:
        ordered = sorted(rows, key=lambda r: r[feature])
        b = g = 0
        for i, row in enumerate(ordered):
            b, g = b + row["bad"], g + 1 - row["bad"]
            if i + 1 == len(ordered) or ordered[i + 1][feature] == row[feature]:
                continue
            for above, p, n, at in ((False, b, g, row[feature]),
                                    (True, bad - b, good - g, ordered[i + 1][feature])):
                if p:
                    gain = p * (math.log2(p / (p + n)) - prior)
                    if gain > best[0] + 1e-9:
                        best = gain, Condition(feature, above, float(at))
    return best


def learn_rules(rows: Sequence[dict]) -> DecisionList:
    """Sequential covering on rows of features and ``bad`` (0/1), in the given order.

    Every third row is held back: rules grow on the others and are pruned and judged on
    these. A rule that is not precise enough is not kept; the bad rows it covers are set
    aside, so that rules of less gain are grown from the rest. It ends when no bad row is
    left to grow from, or too few are held back for any rule to be kept. No rows, or one
    label only: an empty list, which keeps everything.
    """
    growing = [r for i, r in enumerate(rows) if i % 3]
    holding = [r for i, r in enumerate(rows) if not i % 3]
    aside: list[dict] = []
    rules: list[Rule] = []
    while _counts(holding)[0] >= MIN_FOUND:
        conditions: list[Condition] = []
        covered = growing
        while len(conditions) < MAX_CONDITIONS:
            gain, found = _best_condition(covered)
            if found is None:
                break
            conditions.append(found)
            covered = [r for r in covered if found.holds(r)]
        if not conditions:
            break

        def worth(length: int) -> float:
            p, n = _counts([r for r in holding if all(c.holds(r) for c in conditions[:length])])
            return (p - n) / (p + n) if p + n else -1.0

        length = max(range(1, len(conditions) + 1), key=lambda k: (worth(k), -k))
        rule = Rule(tuple(conditions[:length]))
        p, n = _counts([r for r in holding if rule.holds(r)])
        q, m = _counts([r for r in growing + aside if rule.holds(r)])
        if p < MIN_FOUND or min(p / (p + n), q / (q + m)) < MIN_PRECISION:
            aside += [r for r in growing if r["bad"] and rule.holds(r)]
            growing = [r for r in growing if not (r["bad"] and rule.holds(r))]
            continue
        rules.append(rule)
        growing, aside = ([r for r in part if not rule.holds(r)] for part in (growing, aside))
        holding = [r for r in holding if not rule.holds(r)]
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DecisionList:
    """Learn from documents whose label says ``quality`` 0 or 1.

    At most ``fit_rows`` labels are used, so what is broadcast and collected is bounded;
    they are those of the smallest hash of doc_id. Labels without a quality or doc_id
    are not used; the smallest quality holds for a doc_id labelled twice.
    """
    order = F.xxhash64("doc_id")
    chosen = (
        labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
        .agg((1 - F.min("quality")).cast("int").alias("bad"))
        .orderBy(order, "doc_id").limit(fit_rows)
    )
    rows = with_statistics(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    ).where(~base_failed()).select("doc_id", "bad", *FEATURES).collect()
    told = [r.asDict() for r in rows]
    told.sort(key=lambda r: (hash((r["doc_id"] * 2654435761) & 0xFFFFFFFF), r["doc_id"]))
    return learn_rules(told)


def judge_quality(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``docs`` without text, plus the statistics, ``base_failed``, ``rule`` and ``kept``.

    ``rule`` is the number of the first learned rule that rejects the document, null if
    none does. ``kept`` is false if the base test or a rule rejects it.
    """
    own = [c for c in docs.columns if c not in ("base_failed", "rule", "kept", *STATISTICS, *FEATURES)]
    judged = with_statistics(docs).select(
        *own, *STATISTICS, base_failed().alias("base_failed"), rules.rule_number().alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
