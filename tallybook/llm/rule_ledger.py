"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger holds the measurements and one bit per rule that
failed. Policies are masks of rules with a version: they are applied, compared and taken apart on the
bits alone, without a look at the texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import SPACES, WORDS

#: Words of the window whose repeats are counted.
WINDOW = 8


@dataclass(frozen=True)
class LedgerRule:
    """A rule with its bit; ``fails`` is an expression over the measurements, in whole numbers."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: A bit keeps its meaning for good; a changed rule gets a bit of its own.
RULES = (
    LedgerRule(0, "few_words", "n_words < 20"),
    LedgerRule(1, "repeated_words", "100 * n_repeat_words > 30 * n_words"),
    LedgerRule(2, "short_words", "word_chars < 2 * n_words"),
    LedgerRule(3, "long_words", "word_chars > 15 * n_words"),
    LedgerRule(4, "symbols", "100 * n_symbols > 10 * n_words"),
    LedgerRule(5, "repeated_lines", "n_lines >= 5 and 100 * n_dup_lines > 30 * n_lines"),
    LedgerRule(6, "capitals", "n_words >= 20 and 100 * n_capital_words > 40 * n_words"),
    LedgerRule(7, "few_distinct", "n_words >= 20 and n_distinct_words < 50 and 100 * n_distinct_words < 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of what is asked for: a document is kept if none of the named rules failed."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        have = {r.name: r.mask for r in RULES}
        return sum(have[name] for name in self.rules)


BASE = Policy(1, ("few_words", "repeated_words"))
PROSE = Policy(2, (*BASE.rules, "short_words", "long_words", "symbols", "repeated_lines", "capitals", "few_distinct"))


def _repeats(docs: DataFrame, fingerprint: Callable[..., Column]) -> DataFrame:
    """``docs`` with ``n_repeat_words``: words in windows that stand twice or more in their text.

    Windows are told apart by a fingerprint first; only those that share one are compared by their words.
    """
    words, size = F.col("words"), F.size("words")
    hashed = docs.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn(
        "windows",
        F.when(
            size >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), size - WINDOW),
                lambda i: fingerprint(*(F.get(F.col("hashes"), i + k) for k in range(WINDOW))),
            ),
        ),
    ).drop("hashes")
    alike = hashed.withColumn(
        "alike",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("windows")

    def twice(name: str, *fields: str) -> Column:
        """The entries of a sorted array that equal a neighbour in the fields."""
        entries = F.col(name)

        def same(e: Column, other: Column) -> Column:
            out = other.isNotNull()
            for field in fields:
                out = out & (e[field] == other[field])
            return out

        return F.filter(entries, lambda e, k: same(e, F.get(entries, k + 1)) | same(e, F.get(entries, k - 1)))

    def content(e: Column) -> Column:
        own = F.transform(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda k: F.get(words, e["i"] + k))
        return F.struct(e["h"].alias("h"), F.array_join(own, " ").alias("text"), e["i"].alias("i"))

    # An array of its own per step, so that no lambda computes what it looks into anew.
    alike = alike.withColumn("alike", twice("alike", "h"))
    alike = alike.withColumn("alike", F.array_sort(F.transform("alike", content)))
    alike = alike.withColumn("alike", twice("alike", "h", "text"))
    alike = alike.withColumn("starts", F.array_sort(F.transform("alike", lambda e: e["i"]))).drop("alike")
    covered = F.transform("starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), k + 1) - s, F.lit(WINDOW))))
    counted = alike.withColumn("covered", covered).drop("starts")
    return counted.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate("covered", F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0)).cast("long"),
    ).drop("covered")


def ledger(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fingerprint: Callable[..., Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: ``id``, the measurements, and ``failed``, the bits of the rules that failed.

    A null text has no words. A text without words fails the rules on few words alone. Rows are independent:
    nothing is shuffled, repeated rows and ids get a row each, null ids stay. Other columns are left out, so
    no name can clash; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select("id", "text", F.array_remove(F.split("text", SPACES), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORDS))
    rows = rows.select(
        "id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        F.size(F.filter("words", lambda w: (F.length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w)))).cast("long").alias("n_capital_words"),
    )
    rows = rows.withColumn("n_lines", F.size("lines").cast("long")).withColumn(
        "n_dup_lines", F.size("lines").cast("long") - F.size(F.array_distinct("lines"))
    ).drop("lines")
    measured = _repeats(rows, fingerprint).drop("words")
    bits = [F.when(F.expr(r.fails), F.lit(r.mask)).otherwise(F.lit(0)) for r in RULES]
    return measured.withColumn("failed", sum(bits[1:], bits[0]).cast("long"))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """``rows`` of a ledger with ``kept`` and the ``policy`` version that decided."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0).withColumn(
        "policy", F.lit(policy.version)
    )


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: one row per rule, from a ledger.

    ``failed_docs`` and ``failed_words`` fail the rule; ``only_docs`` and ``only_words`` fail no other rule of
    the policy, so they would come back without it; ``kept_without`` documents are kept then; ``with_rules`` are the bits that occur
    together with the rule's, by bitwise aggregation. Documents meet as patterns of bits, at most two to
    the number of rules.
    """
    asked = policy.mask
    patterns = rows.groupBy(F.col("failed").bitwiseAND(F.lit(asked)).alias("pattern")).agg(
        F.count("*").alias("docs"), F.sum("n_words").alias("words")
    )
    own = [r for r in RULES if r.mask & asked]
    rule = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("bit")) for r in own))
    each = patterns.select("*", F.inline(rule))
    hit = F.col("pattern").bitwiseAND(F.col("bit")) != 0
    only = F.col("pattern") == F.col("bit")
    total = lambda when, what: F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")
    return each.groupBy("rule", "bit").agg(
        total(hit, "docs").alias("failed_docs"),
        total(hit, "words").alias("failed_words"),
        total(only, "docs").alias("only_docs"),
        total(only, "words").alias("only_words"),
        total((F.col("pattern") == 0) | only, "docs").alias("kept_without"),
        F.coalesce(F.bit_or(F.when(hit, F.col("pattern"))), F.lit(0)).alias("with_rules"),
    )


def moved(rows: DataFrame, old: Policy, new: Policy) -> DataFrame:
    """Documents and words by what two versions of a policy decide on them."""
    return (
        apply_policy(rows, old).withColumnRenamed("kept", "old_kept").drop("policy")
        .transform(lambda r: apply_policy(r, new)).groupBy("old_kept", F.col("kept").alias("new_kept"))
        .agg(F.count("*").alias("docs"), F.sum("n_words").alias("words"))
    )
