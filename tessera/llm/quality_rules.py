"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a Column that is true where the rule rejects, made of the text and its words alone. ``plan_cascade`` times each
rule from the raw text and counts what it rejects on a bounded sample (the first rows of the table; they decide about the order
only), then sorts the rules by rejections per second of cost. ``apply_cascade`` nests them in one CASE, which Spark evaluates
branch by branch, so that a document meets the next rule, and what that rule has to compute, only if no earlier one rejected
it. The order changes the cost and the reported first rule, never which documents are kept.

``keep_good`` computes nothing but what the rules met ask for. ``judge`` returns the counts of every document and so computes
them for all; its rules then read those counts.

Defined cases: a null text has no words and fails; an empty table gives an empty result; ties and repeated rows are judged
each on their own; very long texts are judged whole; other columns pass through untouched whatever their names, but for those
named like one of the added columns, which these replace.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_GAP, drop_staged, staged

SYMBOLS = "#*$%&|<>"
WINDOW = 8
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
#: Rows of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000


def let(value: Column, body) -> Column:
    """body(value) with the value computed once per row, even where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def window_hashes(words: Column) -> Column:
    """Hashes of all windows of eight words; null where there is none."""

    def of_hashes(h: Column) -> Column:
        return F.when(F.size(h) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def covered_words(windows: Column) -> Column:
    """Words inside the windows whose hash occurs at least twice."""

    def same(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda p, i: F.coalesce(F.get(pairs, F.when(i > 0, i - 1))["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False)))
        return F.array_sort(F.transform(twice, lambda p: p["i"]))

    def covered(starts: Column) -> Column:
        step = F.transform(starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), same), covered)


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur at least twice in the same text, first occurrence included."""
    found = let(window_hashes(words), lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered_words(w)))
    return F.coalesce(found, F.lit(0).cast("long"))


def mostly_repeated(words: Column) -> Column:
    """Whether 100 * repeated_words(words) > 30 * size(words); the windows are sorted only where so many can be repeated.

    A hash that k >= 2 windows have is missing k - 1 times among the distinct ones and covers 8 * k <= 16 * (k - 1) words.
    """
    n = 30 * F.size(words)
    found = let(window_hashes(words), lambda w: (1600 * (F.size(w) - F.size(F.array_distinct(w))) > n) & (100 * F.coalesce(covered_words(w), F.lit(0).cast("long")) > n))
    return F.coalesce(found, F.lit(False))


def counted_in(text: Column, kind: str) -> Column:
    """Characters of a class (the inside of a regular expression's brackets) in text."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", ""))


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))


def spread(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """row (the whole row), text and words; a generator of one row keeps words from being cut again for each use."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.struct("*").alias("row"), text.alias("text"), F.inline(F.array(F.struct(words_of(text).alias("words")))))


def raw_counts() -> dict[str, Column]:
    """The counts of statistics() as expressions over text and words."""
    text, words = F.col("text"), F.col("words")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, WORD_GAP, "")).cast("long"),
        "n_symbols": counted_in(text, SYMBOLS).cast("long"),
        "n_dup_lines": let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(words).cast("long"),
    }


def counted(rows: DataFrame) -> DataFrame:
    """row, text and the counts of spread() rows."""
    counts = F.struct(*[c.alias(name) for name, c in raw_counts().items()])
    return rows.select("row", "text", F.inline(F.array(counts))).withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def unwrapped(rows: DataFrame, docs: DataFrame, *added: str) -> DataFrame:
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed added."""
    return unwrapped(counted(spread(docs, text_col)), docs, *STATISTICS)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def production_rules(text_col: str = "text", raw: bool = False) -> list[Rule]:
    """Rules over statistics() and the text or, raw, over the text and words of spread() alone. Limits leave wide room around
    ordinary prose in any language."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    get = raw_counts() if raw else {c: F.col(c) for c in STATISTICS}
    words = F.greatest(get["n_words"], F.lit(1))
    share = lambda pattern, part, of: let(lines_of(text), lambda x: (F.size(x) >= 4) & (part * F.size(F.filter(x, lambda s: F.rlike(s, F.lit(pattern)))) > of * F.size(x)))
    return [
        Rule("few_words", get["n_words"] < 20),
        Rule("repeated_passages", mostly_repeated(F.col("words")) if raw else 100 * get["n_repeat_words"] > 30 * get["n_words"]),
        Rule("many_symbols", 10 * get["n_symbols"] > 3 * words),
        Rule("word_length", let(get["word_chars"], lambda n: (n > 20 * words) | (n < 2 * words))),
        Rule("repeated_lines", let(lines_of(text), lambda x: (F.size(x) >= 4) & (2 * (F.size(x) - F.size(F.array_distinct(x))) > F.size(x)))),
        Rule("shouting", 2 * counted_in(text, r"\p{Lu}") > counted_in(text, r"\p{L}")),
        Rule("no_letters", 2 * counted_in(text, r"\p{L}") < get["word_chars"]),
        Rule("ellipsis_lines", share("(\\.\\.\\.|…)\\s*$", 10, 5)),
        Rule("bullet_lines", share("^\\s*[-•*]", 10, 9)),
        Rule("markup", counted_in(text, "{}") > words),
    ]


def plan_cascade(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules by rejections per cost, both estimated on a bounded sample; nothing but the order depends on it."""
    rows = staged(sample, "cascade-sample")

    def run(cond: Column) -> tuple[float, int]:
        began = time.perf_counter()
        hits = rows.agg(F.count_if(cond).alias("n")).first()["n"]
        return time.perf_counter() - began, hits

    run(F.lit(True))
    base = min(run(F.lit(True))[0] for _ in range(2))
    found = []
    for rule in rules:
        took, hits = min(run(rule.rejects) for _ in range(2))  # the first run compiles the rule
        found.append((-(hits + 1) / max(took - base, 1e-3), rule.name, rule))
    drop_staged(rows)
    return [rule for _, _, rule in sorted(found, key=lambda x: x[:2])]


def apply_cascade(stats: DataFrame, rules: Sequence[Rule], out_col: str = "rejected_by") -> DataFrame:
    """stats with the name of the first rule of the given order that rejects the row, else null."""
    return stats.withColumn(out_col, first_rejecting(rules))


def first_rejecting(rules: Sequence[Rule]) -> Column:
    case = F.when(rules[0].rejects, F.lit(rules[0].name))
    for rule in rules[1:]:
        case = case.when(rule.rejects, F.lit(rule.name))
    return case


def planned(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The raw rules in the order that the first rows of docs suggest."""
    # one task that stops after so many rows: no other partition is opened, whatever the size of the table
    return plan_cascade(spread(docs.select(text_col).coalesce(1).limit(sample_rows), text_col).select("text", "words"), production_rules(raw=True))


def judge(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with statistics, rejected_by (first rule met in the planned order) and kept."""
    by_name = {rule.name: rule for rule in production_rules()}
    order = [by_name[rule.name] for rule in planned(docs, text_col, sample_rows)]
    judged = apply_cascade(counted(spread(docs, text_col)), order).withColumn("kept", F.col("rejected_by").isNull())
    return unwrapped(judged, docs, *STATISTICS, "rejected_by", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs, with all their columns whatever their names, that no rule rejects."""
    return spread(docs, text_col).filter(first_rejecting(planned(docs, text_col, sample_rows)).isNull()).select("row.*")
