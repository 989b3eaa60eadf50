"""Mixing sources to target weights by temperature.

The token share p of every source is raised to an exponent a in [0, 1] and
normalised: 1 keeps the natural mix, 0 weighs all sources alike.  The
exponent is found by bisection, either the largest that reaches a target
entropy or the smallest that respects a limit on repetition.  Weights become
token quotas; a quota is realised as whole epochs of the source plus one
partial epoch.  Every epoch is a permutation of the source by a seeded hash,
cut into blocks of about ``block_tokens`` tokens; the partial epoch takes
blocks in order until its budget is used, the last one document by document.

Only DataFrame functions.  Texts are never shuffled: the plan is made on
(id, source, tokens), written once, and comes back as one row per source
with the place where the partial epoch ends, so each document's part is
decided on its own row.  A hot source is one row of the plan and many
blocks; no window or group holds its documents.

Bisection runs on the per-source totals, four steps a job (15 exponents are
evaluated side by side), and brings 15 numbers a job to the driver.

Defined results: a null source is a source of its own; a null text has no
tokens; a source without tokens has weight 0 and is taken once; rows equal
in source and id share their place and are taken together; an empty table
gives an empty result; further columns are kept, and new columns whose names
clash are prefixed with ``_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.columns import free_name, ref, text_or_empty, words
from blotter.plans.guards import materialise

ROUNDS = 9  # four bisection steps each
NEAR = 1e-9  # a quota this close to a whole number of epochs is that number


def count_words(text_col: str) -> Column:
    """Default token count: words of the text."""
    return F.size(words(text_or_empty(text_col))).cast("long")


def source_totals(thin: DataFrame) -> DataFrame:
    """(source, tokens, documents) of the thin table, written once."""
    return materialise(
        thin.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")),
        "mix-sources",
    )[0]


def _state(totals: DataFrame, total: int, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy, largest w/p, smallest w/p) of the mix for every exponent, in one job."""
    log_p = F.log(F.col("tokens") / F.lit(float(total)))
    cols = []
    for k, a in enumerate(exponents):
        power = F.exp(F.lit(a) * F.col("lp"))
        ratio = F.lit(a - 1) * F.col("lp")
        cols += [
            F.sum(power).alias(f"z{k}"),
            F.sum(power * F.col("lp")).alias(f"s{k}"),
            F.max(ratio).alias(f"u{k}"),
            F.min(ratio).alias(f"l{k}"),
        ]
    row = totals.where(F.col("tokens") > 0).select(log_p.alias("lp")).agg(*cols).first()
    out = []
    for k, a in enumerate(exponents):
        z = row[f"z{k}"]
        out.append((math.log(z) - a * row[f"s{k}"] / z, row[f"u{k}"] - math.log(z), row[f"l{k}"] - math.log(z)))
    return out


def find_exponent(
    totals: DataFrame,
    total: int,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
    n_sources: int = 1,
) -> float:
    """The exponent in [0, 1] that meets the one target given.

    ``entropy_share``: the largest exponent whose weights have at least that
    share of the largest possible entropy, ln(number of sources).
    ``max_repeats``: the smallest exponent at which no source is read more
    often; with ``budget`` None the budget is the least that reads every
    source once.
    """
    if (entropy_share is None) == (max_repeats is None):
        raise ValueError("give entropy_share or max_repeats, one of them")

    def fits(state: tuple[float, float, float]) -> bool:
        entropy, most, least = state
        if entropy_share is not None:
            return entropy >= entropy_share * math.log(n_sources) - 1e-12
        reads = math.exp(most - least) if budget is None else budget / total * math.exp(most)
        return reads <= max_repeats * (1 + 1e-12)

    low, high = 0.0, 1.0
    at_low, at_high = (fits(s) for s in _state(totals, total, [low, high]))
    upward = entropy_share is None  # the targets hold above, or below, the exponent sought
    if upward and at_low or not upward and at_high:
        return low if upward else high
    if not (at_high if upward else at_low):
        return high if upward else low  # out of reach: the nearest end
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / 16 for k in range(1, 16)]
        ok = [fits(s) for s in _state(totals, total, grid)]
        first = next((k for k, x in enumerate(ok) if x == upward), 15)
        bounds = [low, *grid, high]
        low, high = bounds[first], bounds[first + 1]
    return high if upward else low


def mix_plan(
    thin: DataFrame,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: int | None = None,
    block_tokens: int = 1 << 20,
    seed: int = 0,
) -> DataFrame:
    """One row per source: weight, exponent, whole epochs and the end of the partial one.

    ``thin`` has (id, source, tokens).  Columns: source, tokens, documents,
    weight, exponent, n_blocks, epochs, reads, cut_block, cut_hash, cut_id; the
    partial epoch takes documents whose (block, hash, id) does not lie behind the cut.
    """
    totals = source_totals(thin)
    whole = totals.agg(
        F.sum("tokens").alias("t"), F.sum(F.when(F.col("tokens") > 0, 1).otherwise(0)).alias("n")
    ).first()
    total, n = int(whole["t"] or 0), int(whole["n"] or 0)
    if total:
        a = find_exponent(totals, total, entropy_share, max_repeats, budget_tokens, n)
        entropy, most, least = _state(totals, total, [a])[0]
        budget = float(budget_tokens) if budget_tokens is not None else total * math.exp(-least)
        # w / p = p**(a - 1) / z, and z follows from the largest such ratio
        log_p = F.log(F.col("tokens") / F.lit(float(total)))
        top = totals.where("tokens > 0").agg(F.max(F.lit(a - 1) * log_p)).first()[0]
        log_z = top - most
        weight = F.when(F.col("tokens") > 0, F.exp(F.lit(a) * log_p - F.lit(log_z))).otherwise(0.0)
        reads = F.when(
            F.col("tokens") > 0, F.exp(F.lit(a - 1) * log_p - F.lit(log_z)) * F.lit(budget / total)
        ).otherwise(1.0)
    else:
        a, weight, reads = 1.0, F.lit(0.0), F.lit(1.0)
    plan = (
        totals.withColumn("weight", weight)
        .withColumn("exponent", F.lit(a))
        .withColumn("reads", reads)
        .withColumn("epochs", F.floor(F.col("reads") + NEAR).cast("long"))
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long"))
        .withColumn(
            "budget",
            F.greatest(F.lit(0), F.round((F.col("reads") - F.col("epochs")) * F.col("tokens"))).cast("long"),
        )
    )
    plan, _, _ = materialise(plan, "mix-plan")
    partial = (
        _join_source(thin, plan.where("budget > 0").select("source", "n_blocks", "epochs", "budget"))
        .withColumn("hash", place(F.col("id"), F.col("epochs"), seed))
        .withColumn("block", F.pmod("hash", "n_blocks"))
    )
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        partial.groupBy("source", "block", "budget")
        .agg(F.sum("tokens").alias("tokens"))
        .withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        .where(F.col("before") < F.col("budget"))
    )
    last = blocks.groupBy("source").agg(F.max(F.struct("block", "before")).alias("last"))
    last, _, _ = materialise(
        last.select("source", F.col("last.block").alias("cut_block"), F.col("last.before").alias("before")),
        "mix-ends",
    )
    # documents of the one block per source in which the budget ends
    ending = _join_source(partial, last).where(F.col("block") == F.col("cut_block"))
    so_far = Window.partitionBy("source").orderBy("hash", "id").rangeBetween(Window.unboundedPreceding, 0)
    cuts = (
        ending.withColumn("upto", F.col("before") + F.sum("tokens").over(so_far))
        .where(F.col("upto") <= F.col("budget"))
        .groupBy("source")
        .agg(F.max(F.struct("hash", "id")).alias("cut"))
        .select("source", F.col("cut.hash").alias("cut_hash"), F.col("cut.id").alias("cut_id"))
    )
    full = _join_source(_join_source(plan, last.drop("before"), "left"), cuts, "left").drop("budget")
    return materialise(full, "mix-cuts")[0]


def _join_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``source``, null matching null; the size of ``right`` (a row per
    source) decides between a broadcast and a shuffle at run time."""
    right = right.withColumnRenamed("source", "_right_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_right_source")), how).drop("_right_source")


def place(row_id: Column, epoch: Column, seed: int) -> Column:
    """The hash that orders a document within an epoch."""
    return F.xxhash64(F.lit(seed), epoch, row_id)


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    tokens: Column | None = None,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: int | None = None,
    block_tokens: int = 1 << 20,
    seed: int = 0,
) -> DataFrame:
    """The mixed corpus: input rows, once per epoch they are read in.

    Adds ``n_tokens``, ``epoch``, ``block`` (within the epoch), ``mix_key``
    (0 to 1; sorting by it interleaves the sources by weight), ``weight`` and
    ``exponent``.
    """
    counted = (tokens if tokens is not None else count_words(text_col)).cast("long")
    thin, _, _ = materialise(
        df.select(
            ref(id_col).alias("id"), ref(source_col).alias("source"), F.coalesce(counted, F.lit(0)).alias("tokens")
        ),
        "mix-tokens",
    )
    plan = mix_plan(thin, entropy_share, max_repeats, budget_tokens, block_tokens, seed)
    new = {c: free_name(df, c) for c in ("n_tokens", "epoch", "block", "mix_key", "weight", "exponent", "plan")}
    p = ref(new["plan"])
    packed = plan.select(F.struct(*plan.columns).alias(new["plan"]))
    rows = df.join(packed, ref(source_col).eqNullSafe(p["source"]), "inner")
    epochs = F.sequence(F.lit(0), p["epochs"].cast("int"))  # the last one is the partial epoch
    rows = rows.withColumn(new["epoch"], F.explode(epochs))
    hashed = place(ref(id_col), ref(new["epoch"]).cast("long"), seed)
    block = F.pmod(hashed, p["n_blocks"])
    in_cut = (block == p["cut_block"]) & (
        (hashed < p["cut_hash"])
        | ((hashed == p["cut_hash"]) & (F.coalesce(ref(id_col) <= p["cut_id"], ref(id_col).isNull())))
    )
    taken = (ref(new["epoch"]) < p["epochs"]) | (block < p["cut_block"]) | in_cut
    position = (block + (hashed / F.lit(float(1 << 64)) + F.lit(0.5))) / p["n_blocks"]
    return (
        rows.where(F.coalesce(taken, F.lit(False)))
        .withColumn(new["n_tokens"], F.coalesce(counted, F.lit(0)))
        .withColumn(new["block"], block)
        .withColumn(
            new["mix_key"], F.least(F.lit(1.0), (ref(new["epoch"]) + position) / F.greatest(p["reads"], F.lit(1.0)))
        )
        .withColumn(new["weight"], p["weight"])
        .withColumn(new["exponent"], p["exponent"])
        .drop(new["plan"])
    )
