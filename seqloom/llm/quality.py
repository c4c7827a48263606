"""Quality rules as a bitmask ledger: every rule is evaluated once, its failure is one bit.

A ledger row holds the measurements and ``fail_bits``; a policy is a versioned mask over those
bits, so that changing policy, or asking what each rule costs, never reads a text again. All
of it is per-row SQL on arrays of one text's words: no shuffle but for the ablation counts.

Defined results: a null or empty text has no words and fails ``few_words``; rows are judged one
by one, so ties and repeated rows do not matter; an empty table gives an empty ledger; input
columns named like a measure are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Bit number is the place in this list: name and SQL condition of failure over the measurements.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
]
#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length"),
}
WINDOW = 5


def mask(policy: str) -> int:
    names = [n for n, _ in RULES]
    return sum(1 << names.index(n) for n in POLICIES[policy])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words to every row.

    Windows are compared by 64-bit hash within one text; a text of n words takes two different windows for
    equal with a probability of about n^2 / 2^65.
    """
    t = "_t"
    # The row is packed, so that no name of its columns can clash with those used here.
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    base = base.withColumn("_w", F.array_remove(F.split("_t", SPACE), ""))
    base = base.withColumn("_l", F.expr("filter(split(_t, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    k = WINDOW
    window = ", ".join(["x"] + [f"get(_w, i + {j})" for j in range(1, k)])
    base = base.select(
        "*",
        F.expr(f"CASE WHEN size(_w) >= {k} THEN transform(slice(_w, 1, size(_w) - {k - 1}), (x, i) -> xxhash64({window})) ELSE cast(array() AS array<bigint>) END").alias("_h"),
    )
    # Positions of windows that occur twice: neighbours in the order of (hash, position). Each covers
    # its words up to the next such window.
    places = "sort_array(transform(filter(s, (x, i) -> x.h = get(s, i - 1).h OR x.h = get(s, i + 1).h), x -> x.i))"
    covered = f"aggregate(transform(p, (x, i) -> least({k}, coalesce(get(p, i + 1) - x, {k}))), 0L, (a, x) -> a + x)"
    let = "element_at(transform(array({value}), {name} -> {body}), 1)".format
    inner = let(value="sort_array(transform(_h, (h, i) -> named_struct('h', h, 'i', i)))", name="s", body=let(value=places, name="p", body=covered))
    measures = {
        "n_words": "cast(size(_w) AS bigint)",
        "word_chars": f"cast(length(translate({t}, ' \\u0009\\u000A\\u000B\\u000C\\u000D', '')) AS bigint)",
        "n_symbols": f"cast(regexp_count({t}, '[#*$%&|<>]') AS bigint)",
        "n_lines": "cast(size(_l) AS bigint)",
        "n_dup_lines": "cast(size(_l) - size(array_distinct(_l)) AS bigint)",
        "n_repeat_words": f"CASE WHEN size(array_distinct(_h)) = size(_h) THEN 0L ELSE {inner} END",
    }
    # As a generator's output the measures are computed once: a filter on them is not pushed below,
    # where the optimiser would write them out again inside its condition.
    row = ", ".join(f"'{k}', {v}" for k, v in measures.items())
    return base.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in measures], F.expr(f"inline(array(named_struct({row})))"))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``fail_bits``: bit b is set where rule b fails."""
    bits = " | ".join(f"(CASE WHEN {c} THEN {1 << b}L ELSE 0L END)" for b, (_, c) in enumerate(RULES))
    return measure(docs, text).withColumn("fail_bits", F.expr(bits))


def apply_policy(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Add ``kept``: no rule of the policy failed."""
    return rows.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0)


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: rows it fails, rows that only it fails, and rows kept without it.

    One bitwise count by distinct bit pattern (at most 2^rules rows) serves every rule.
    """
    m = mask(policy)
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << b).cast("long").alias("bit")) for b, (n, _) in enumerate(RULES) if m >> b & 1])
    return patterns.select("bits", "n", F.inline(rules)).groupBy("rule").agg(
        F.sum(F.expr("if(bits & bit <> 0, n, 0)")).alias("n_failed"),
        F.sum(F.expr("if(bits = bit, n, 0)")).alias("n_only"),
        F.sum(F.expr("if(bits = 0 OR bits = bit, n, 0)")).alias("n_kept_without"),
    )
