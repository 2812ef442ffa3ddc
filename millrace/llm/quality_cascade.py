"""Quality rules as a short-circuit cascade of SQL expressions.

Each rule is a condition over the text alone. A sample of the table gives every
rule's cost (time per row) and selectivity (share of rows it rejects); the rules
are then chained in one CASE expression, best rejection per cost first, so a row
pays only for the rules up to the first one that rejects it. The order changes
the cost, never which rows are rejected.

Everything here is built from DataFrame functions: no Python runs in tasks.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, let
from millrace.session import stored

# Most rows of the sample that costs and selectivities are estimated on, and the
# share of the table drawn for it.
SAMPLE_ROWS = 400
SAMPLE_SHARE = 0.02

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# Limits of the further rules, in percent.
MOST_SYMBOLS_PER_WORD = 10
MOST_DUPLICATE_LINES = 40
MOST_CAPITALS = 50


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.array_join(words_of(text), "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOLS)).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_words(text: Column) -> Column:
    """Words that lie in a 3-word window found twice or more; each word counts once.

    Windows are compared by a 64-bit hash of their words. Texts without a repeat
    stop after one hash-set pass; the others sort (window, place) pairs, so the
    work grows as n log n with the text's length.
    """
    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda k, other: F.coalesce(F.get(s, k)["h"] == F.get(s, other)["h"], F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
            return F.sort_array(F.transform(twice, lambda k: F.get(s, k)["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(F.sequence(F.lit(0), F.size(p) - 1), lambda k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(3))))
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return let(let(pairs, places), total)

    def by_words(words: Column) -> Column:
        window = F.transform(
            F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        )
        return F.when(F.size(words) < 4, 0).otherwise(
            let(window, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
        )

    return let(words_of(text), by_words).cast("long")


def capitals_percent(text: Column) -> Column:
    """Capitals per 100 letters; 0 without letters."""
    capitals, letters = F.regexp_count(text, F.lit(r"\p{Lu}")), F.regexp_count(text, F.lit(r"\p{L}"))
    return F.when(letters > 0, 100 * capitals / letters).otherwise(0.0)


@dataclass(frozen=True)
class Rule:
    """A row goes when `rejects(text)` is true. `text` is never null there."""

    name: str
    rejects: Callable[[Column], Column]
    base: bool = False


RULES = (
    Rule("few_words", lambda t: word_count(t) < LEAST_WORDS, base=True),
    Rule("repeated_words", lambda t: 100 * repeated_words(t) > MOST_REPEATED_PERCENT * word_count(t), base=True),
    Rule("symbols", lambda t: 100 * symbol_count(t) > MOST_SYMBOLS_PER_WORD * word_count(t)),
    Rule("duplicate_lines", lambda t: let(_lines(t), lambda ls: 100 * (F.size(ls) - F.size(F.array_distinct(ls))) > MOST_DUPLICATE_LINES * F.size(ls))),
    Rule("capitals", lambda t: capitals_percent(t) > MOST_CAPITALS),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(df: DataFrame, text: str, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, share: float = SAMPLE_SHARE) -> list[Estimate]:
    """Each rule's cost and selectivity on a sample of at most `sample_rows` rows.

    The sample is drawn once into the shared folder. Each rule is timed over it
    against a pass that applies no rule.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sample = stored(df.select(value.alias("t")).sample(share, seed=7).limit(sample_rows).repartition(1))

    def run(condition: Column) -> tuple[float, float]:
        began = time.perf_counter()
        row = sample.agg(F.count("*").alias("n"), F.count_if(condition).alias("bad")).first()
        return time.perf_counter() - began, row["bad"] / max(row["n"], 1)

    run(F.length("t") < 0)
    idle = run(F.length("t") < 0)[0]
    found = []
    for rule in rules:
        run(rule.rejects(F.col("t")))  # compiled code is reused by the timed pass
        seconds, rejected = run(rule.rejects(F.col("t")))
        found.append(Estimate(rule, max(seconds - idle, 1e-4), rejected))
    return found


def ordered(estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejections per cost, cheapest first among those that reject nothing."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.worth, e.seconds))]


def first_rejection(text: Column, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects the text, else null. Later rules are not evaluated."""
    value = F.coalesce(text, F.lit(""))
    chain = F
    for rule in rules:
        chain = chain.when(rule.rejects(value), F.lit(rule.name))
    return chain.otherwise(F.lit(None).cast("string"))


class QualityCascade:
    """The rules in the order that the table's sample suggests.

    Null and empty texts count as texts without words. Rows are judged one by
    one, so repeated rows fare alike and an empty table stays empty; other
    columns are passed on untouched whatever their names.
    """

    def __init__(self, df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS):
        self.text = text
        self.estimates = estimate(df, text, rules, sample_rows)
        self.rules = ordered(self.estimates)

    def kept(self, df: DataFrame) -> DataFrame:
        """The rows that no rule rejects."""
        return df.where(first_rejection(F.col(f"`{self.text}`"), self.rules).isNull())

    def judged(self, df: DataFrame, id_column: str) -> DataFrame:
        """Per row its id, the base measures, whether the base rules reject it, and whether it is kept."""
        text = F.coalesce(F.col(f"`{self.text}`"), F.lit(""))
        verdict = first_rejection(text, self.rules).isNull()
        measured = df.select(
            F.col(f"`{id_column}`").alias("doc_id"),
            word_count(text).alias("n_words"), word_chars(text).alias("word_chars"), symbol_count(text).alias("n_symbols"),
            duplicate_lines(text).alias("n_dup_lines"), repeated_words(text).alias("n_repeat_words"), verdict.alias("passed"),
        )
        failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
        return measured.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            failed.alias("base_failed"), (~failed & F.col("passed")).alias("kept"),
        )
