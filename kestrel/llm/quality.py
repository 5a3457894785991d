"""Operator 5: quality rules as a short-circuit cascade.

Every rule is a column expression over a document's own statistics.  On a
bounded sample each rule's cost (seconds per document) and rejection rate are
measured, and the rules run in the order of rejection per cost, nested so that
a rejected document evaluates no later rule.  The order changes the work only:
a document is kept when no rule rejects it, in whatever order they run.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.store import columns

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: F.Column) -> F.Column:
    """The words of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Repeated 3-word windows, found by sorting (hash, position) pairs inside the row, so a
    long text costs n log n; texts whose window hashes are all distinct skip the sort."""
    return (df.withColumn("_windows", F.expr(
        "CASE WHEN n_words < 3 THEN CAST(array() AS ARRAY<BIGINT>) ELSE transform(sequence(0, size(_words) - 3), "
        "i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) END"))
        .withColumn("_sorted", F.expr(
            "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN "
            "sort_array(transform(_windows, (h, i) -> struct(h, i))) END"))
        .withColumn("_at", F.expr(
            "sort_array(transform(filter(_sorted, (x, k) -> x.h = get(_sorted, k - 1).h "
            "OR x.h = get(_sorted, k + 1).h), x -> x.i))"))
        .withColumn("n_repeat_words", F.coalesce(F.expr(
            "aggregate(transform(_at, (p, k) -> least(3, coalesce(get(_at, k + 1) - p, 3))), 0, (s, x) -> s + x)"),
            F.lit(0)).cast("bigint"))
        .drop("_windows", "_sorted", "_at"))


def _dup_lines(df: DataFrame) -> DataFrame:
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (df.withColumn("_lines", lines)
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))
            .drop("_lines"))


#: Statistic -> (statistics it builds on, how to add it).
STATISTICS = {
    "_words": ((), lambda df: df.withColumn("_words", words(F.col("text")))),
    "n_words": (("_words",), lambda df: df.withColumn("n_words", F.size("_words").cast("bigint"))),
    "word_chars": ((), lambda df: df.withColumn("word_chars", F.length(F.regexp_replace(
        F.coalesce("text", F.lit("")), SPACE, "")).cast("bigint"))),
    "n_symbols": ((), lambda df: df.withColumn("n_symbols", F.regexp_count(
        F.coalesce("text", F.lit("")), F.lit(r"[#*$%&|<>]")).cast("bigint"))),
    # Characters that are neither white space, letters nor marks; and upper-case letters.
    "n_other": ((), lambda df: df.withColumn("n_other", F.regexp_count(
        F.coalesce("text", F.lit("")), F.lit(r"[^\p{L}\p{M}\x20\x09-\x0D]")))),
    "n_upper": ((), lambda df: df.withColumn("n_upper", F.regexp_count(
        F.coalesce("text", F.lit("")), F.lit(r"\p{Lu}")))),
    "n_dup_lines": ((), _dup_lines),
    "n_repeat_words": (("n_words", "_words"), _repeat_words),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(df: DataFrame, names) -> DataFrame:
    """Add the named statistics (and what they build on) that ``df`` lacks."""
    for name in names:
        if name not in df.columns:
            needs, add = STATISTICS[name]
            df = add(with_statistics(df, needs))
    return df


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``rejects`` holds; it reads ``text`` and the statistics ``needs``."""
    name: str
    rejects: str
    needs: tuple = ()


#: Thresholds are parameters of the rules; none is fitted to a table.
RULES = (
    Rule("too_few_words", "n_words < 50", ("n_words",)),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", ("n_words", "n_repeat_words")),
    Rule("symbols", "10 * n_symbols > n_words", ("n_words", "n_symbols")),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words", ("n_words", "word_chars")),
    Rule("duplicate_lines", "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * size(split(coalesce(text, ''), '\\n'))", ("n_dup_lines",)),
    Rule("exclamations", "2 * regexp_count(coalesce(text, ''), '!') > n_words", ("n_words",)),
    Rule("upper_case", "2 * n_upper > word_chars - n_other", ("word_chars", "n_other", "n_upper")),
    Rule("few_letters", "2 * n_other > word_chars", ("word_chars", "n_other")),
)


def order_rules(docs: DataFrame, rules=RULES, sample_rows: int = 500) -> list[Rule]:
    """Rules by measured rejection per cost, best first.

    Each rule runs alone, with the statistics it needs, over at most
    ``sample_rows`` documents (a bound on the planning cost; results do not depend
    on it).  An empty sample leaves the given order.
    """
    sample = docs.select("text").limit(sample_rows).persist()
    try:
        n = sample.count()
        if not n:
            return list(rules)
        gain = {}
        for rule in rules:
            probe = with_statistics(sample, rule.needs).agg(F.count_if(F.expr(rule.rejects)).alias("n"))
            probe.first()  # compile first, then time
            began = time.perf_counter()
            hit = probe.first()["n"]
            gain[rule.name] = (hit / n) / max(time.perf_counter() - began, 1e-6)
        return sorted(rules, key=lambda r: -gain[r.name])
    finally:
        sample.unpersist()


def cascade(rules: list[Rule]) -> F.Column:
    """True when no rule rejects; CASE stops at the first rule that does."""
    out = F.when(F.lit(False), False)
    for rule in rules:
        out = out.when(F.expr(rule.rejects), False)
    return out.otherwise(True)


def judge(docs: DataFrame, rules=RULES, sample_rows: int = 500) -> DataFrame:
    """``docs`` with the five statistics, ``base_failed`` and ``kept``.

    Null and empty texts have no words and are rejected; repeated rows are judged
    alike; extra columns pass through unless they carry a result column's name,
    which the result replaces.
    """
    own = docs.drop(*BASE, "base_failed", "kept")
    ordered = order_rules(own, rules, sample_rows)
    needed = dict.fromkeys([*BASE, *(n for r in ordered for n in r.needs)])
    return (with_statistics(own, needed)
            .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
            .withColumn("kept", cascade(ordered) & ~F.col("base_failed")).drop("_words", "n_other", "n_upper"))


def _where(df: DataFrame, keep: F.Column) -> DataFrame:
    """Filter on a computed flag behind a generator.

    A plain filter would be pushed below the projections, with a copy of every
    statistic's expression for each mention of it."""
    flagged = df.withColumn("_keep", keep)
    row = F.struct(*(F.col(f"`{c}`") for c in flagged.columns))
    return flagged.select(F.inline(F.array(row))).where("_keep").drop("_keep")


def quality_stage(docs: DataFrame, rules=RULES, sample_rows: int = 500) -> DataFrame:
    """The documents that no rule rejects, with their own columns.

    The cascade is a chain of filters in measured order: a statistic is computed
    just before the first rule that needs it, so a document rejected by a cheap
    rule never pays for a dear one.
    """
    kept = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), *columns(docs, "text"))
    together: list[Rule] = []
    for rule in order_rules(kept, rules, sample_rows):
        if together and any(n not in kept.columns for n in rule.needs):
            kept, together = _where(kept, cascade(together)), []
        kept = with_statistics(kept, rule.needs)
        together.append(rule)
    return _where(kept, cascade(together)).select("_doc.*")


def quality_query(docs: DataFrame) -> DataFrame:
    """One row per document: the statistics and the verdict of the cascade."""
    return judge(docs.select(*columns(docs, "doc_id", "text"))).select("doc_id", *BASE, "base_failed", "kept")
