"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps its measurement
and one failure bit.  A policy is a versioned set of rules: applying it is a
bitwise test on the ledger, and an ablation is an aggregate over the bit
patterns, so neither reads a text again.

Only DataFrame functions; no shuffle for the ledger or a verdict, one small
one (a row per distinct bit pattern) for ablations.

Defined results: a null text has no words (it fails ``too_few_words``);
an empty table gives empty results; repeated rows are judged one by one;
further columns of the input are kept by :func:`keep_passing` only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.columns import SPACES, free_name, let, ref, words

SYMBOLS = "#*$%&|<>"

# Rule names in bit order; a new rule is appended, so stored ledgers stay valid.
RULES = (
    "too_few_words",
    "repeated_words",
    "symbol_heavy",
    "duplicate_lines",
    "long_words",
    "short_words",
)
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned selection of rules: a document with any of them fails."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE_POLICY = Policy("base", 1, ("too_few_words", "repeated_words"))
DEFAULT_POLICY = Policy("default", 1, (*BASE_POLICY.rules, "symbol_heavy", "long_words"))
POLICIES = {p.name: p for p in (BASE_POLICY, DEFAULT_POLICY)}


def _repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are sorted with their positions; a window equal to a neighbour is
    repeated.  From the sorted repeated positions, the words covered are
    min(3, distance to the next position) each, and 3 for the last.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2])
    )

    def covered(positions: Column) -> Column:
        gaps = F.transform(
            positions,
            lambda p, i: F.when(i == F.size(positions) - 1, 3).otherwise(F.least(F.lit(3), positions[i + 1] - p)),
        )
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        hit = F.filter(
            s,
            lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["g"] == x["g"]))
            | ((i < F.size(s) - 1) & (s[F.least(i + 1, F.size(s) - 1)]["g"] == x["g"])),
        )
        return let(F.sort_array(F.transform(hit, lambda x: x["i"])), covered)

    def count(g: Column) -> Column:
        pairs = F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            let(F.sort_array(pairs), repeated)
        )

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows, count))


def measurements(text: Column) -> Column:
    """One struct with every measurement of a text (null: no words)."""
    body = F.coalesce(text.cast("string"), F.lit(""))

    def lines(t: Column) -> Column:
        full = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")
        return let(full, lambda a: F.size(a) - F.size(F.array_distinct(a)))

    def of(t: Column) -> Column:
        return let(
            words(t),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                lines(t).cast("long").alias("n_dup_lines"),
                _repeat_words(w).cast("long").alias("n_repeat_words"),
                (F.size(F.split(t, "\n"))).cast("long").alias("n_lines"),
            ),
        )

    return let(body, of)


def failure_bits(m: Column) -> Column:
    """The failure bits of a measurement struct, as a long.

    All comparisons are on integers (no division): a document without words
    fails only ``too_few_words``.
    """
    n = m["n_words"]
    failed = {
        "too_few_words": n < 50,
        "repeated_words": 100 * m["n_repeat_words"] > 50 * n,
        "symbol_heavy": 10 * m["n_symbols"] > n,
        "duplicate_lines": 100 * m["n_dup_lines"] > 30 * m["n_lines"],
        "long_words": m["word_chars"] > 15 * n,
        "short_words": 10 * m["word_chars"] < 25 * n,
    }
    return sum((F.when(failed[r], F.lit(BIT[r])).otherwise(0) for r in RULES), F.lit(0)).cast("long")


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, every measurement, ``fail_bits``): one row per input row, no shuffle."""
    measured = df.select(ref(id_col).alias(id_col), measurements(ref(text_col)).alias("m"))
    return measured.select(ref(id_col), "m.*", failure_bits(F.col("m")).alias("fail_bits"))


def passes(bits: Column, policy: Policy = DEFAULT_POLICY) -> Column:
    """True where no rule of the policy failed."""
    return bits.bitwiseAND(F.lit(policy.mask)) == 0


def ablations(book: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: documents failing it, failing it alone, and kept without it.

    The ledger is first reduced to a row per bit pattern (at most
    2**len(RULES) rows), which is all the per-rule arithmetic reads.
    """
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("b")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in policy.rules])
    each = patterns.select("b", "n", F.explode(rules).alias("r"))
    bit = F.col("r.bit").cast("long")
    count_if = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.lit(policy.name).alias("policy"),
        F.lit(policy.version).alias("version"),
        count_if(F.col("b").bitwiseAND(bit) != 0).alias("n_failed"),
        count_if(F.col("b") == bit).alias("n_failed_alone"),
        count_if(F.col("b") == 0).alias("n_kept"),
        count_if((F.col("b") == 0) | (F.col("b") == bit)).alias("n_kept_without"),
    )


def keep_passing(df: DataFrame, text_col: str = "text", policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The input rows that pass the policy, all columns unchanged."""
    name = free_name(df, "fail_bits")
    judged = df.withColumn(name, let(measurements(ref(text_col)), failure_bits))
    return judged.where(passes(ref(name), policy)).drop(name)
