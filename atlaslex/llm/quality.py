"""Quality rules as a bitmask ledger.

Every rule is evaluated once for every document. The ledger keeps what was measured and, in ``failed_bits``, one bit for
each rule that the text fails. A policy is a versioned set of rules, so it is a mask: applying it, comparing versions and
ablating single rules are bitwise operations over the ledger and never read a text again.

Defined cases: a null or empty text has no words, measures zero everywhere and fails ``few_words``. Repeated rows are
separate ledger rows. The ledger reads only ``doc_id`` and ``text``, and ``keep`` gives all columns back, whatever their
names. Texts may have any length. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlaslex.llm.batches import SPACES, UPPER, long_struct, text_bytes, text_function, unused

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_marks", "n_upper",
)

#: Rule -> measure, factor, limit and what it is measured against: a text fails if factor * measure > limit * other.
#: The position is the rule's bit; new rules go to the end.
RULES = {
    "few_words": ("50", 1, 1, "n_words"),
    "repeated_windows": ("n_repeat_words", 100, 50, "n_words"),
    "symbols": ("n_symbols", 100, 20, "n_words"),
    "exclamations": ("n_marks", 100, 20, "n_words"),
    "capitals": ("n_upper", 100, 40, "word_chars"),
    "repeated_lines": ("n_dup_lines", 100, 50, "n_lines"),
}

#: Policy version -> the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "exclamations"),
    "v2": tuple(RULES),
}

SYMBOLS = b"#*$%&|<>"


def mask(policy: str) -> int:
    """The bits of a policy's rules."""
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def measure(text: bytes) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, SPACES).decode()),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        text.count(b"!"),
        len(text) - len(text.translate(None, UPPER)),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more, its first place included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for place, window in enumerate(windows):
        if counts[window] > 1:
            covered += place + 3 - max(place, end)
            end = place + 3
    return covered


def _measure_texts(texts: list[bytes]) -> dict:
    return dict(zip(MEASURES, zip(*map(measure, texts), strict=True), strict=True))


#: UTF-8 bytes -> struct of the measures.
measures = text_function(long_struct(*MEASURES), _measure_texts)


def _failed_bits(source: str) -> Column:
    """One bit for each failed rule, from the measures below ``source``."""
    bits = F.lit(0).cast("long")
    for i, (value, factor, limit, other) in enumerate(RULES.values()):
        left = F.lit(int(value)) if value.isdigit() else F.col(f"{source}.{value}")
        failed = left * factor > F.col(f"{source}.{other}") * limit
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures and ``failed_bits`` of every document."""
    found = docs.select("doc_id", measures(text_bytes()).alias("m"))
    return found.select("doc_id", "m.*", _failed_bits("m").alias("failed_bits"))


def passes(bits: str | Column, policy: str) -> Column:
    """True where ``failed_bits`` has no rule of the policy."""
    column = F.col(bits) if isinstance(bits, str) else bits
    return column.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def keep(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The documents that a policy keeps, with the columns they had. Rows do not move between tasks."""
    (name,) = unused(docs, "measures")
    found = docs.withColumn(name, measures(text_bytes()))
    return found.where(passes(_failed_bits(name), policy)).drop(name)


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does, from one aggregation over the ledger.

    ``failing``: documents that fail the rule; ``only_this``: documents that nothing else keeps out; ``kept_without``: what
    would be kept if the rule were dropped; ``implied_bits``: the rules that every document failing this one fails as well
    (null if there is none).
    """
    names = list(RULES)
    entries = F.array(
        *(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy])
    )
    failed = F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    counted = rows.groupBy(failed.alias("failed")).agg(F.count("*").alias("n"))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    only = F.col("failed") == F.col("r.bit")
    return (
        counted.select("failed", "n", F.explode(entries).alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failing"),
            F.sum(F.when(only, F.col("n")).otherwise(0)).alias("only_this"),
            F.sum(F.when(only | (F.col("failed") == 0), F.col("n")).otherwise(0)).alias("kept_without"),
            F.bit_and(F.when(hit, F.col("failed"))).alias("implied_bits"),
        )
    )
