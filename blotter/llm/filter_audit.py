"""How filters interact: what each one removes in every order of applying them.

A text fails some of five filters; the failures are one bit each, so a part of
the corpus is described by at most 32 mask cells.  Orders are not run: every
mask cell is folded over the array of all 120 orders.

1. Every text is read once; four bits depend on the text alone.  What is
   written to the scratch folder is (id, SHA-256, part, bits): no text.
2. A text that also belongs to a smaller id fails ``E``.  The least id per
   digest is a partial aggregate; the rows that hold it are found by a join on
   (digest, id), a key that no group of copies makes hot.
3. Rows are counted per (part, mask), together with those labelled good or
   toxic.
4. Each cell is folded over the literal array of orders with ``transform`` and
   ``aggregate`` into 600 structs (120 orders of 5 steps), weighted by the
   cell's counts; the at most 32 arrays of a part are merged by elementwise
   sums and exploded into the rows of the report.

Defined results: a null text counts as empty; a null id is neither smaller nor
larger than another, so such a row never fails ``E`` and makes no other fail
it, and it has no labels; of rows with equal text and id neither fails because
of the other; rows of ``labels`` that repeat an id count as one, good or toxic
when any of them says so; a null language is the part ``''``; an empty table
gives no rows.  Only the named columns are read, whatever others there are.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.columns import let, ref, text_or_empty, words
from blotter.plans.guards import materialise

FILTERS = "ABCDE"
BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_bits(text: Column) -> Column:
    """The bits of the four filters that depend on one text alone."""

    def judged(t: Column) -> Column:
        capitals = F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))
        counted = let(
            words(t),
            lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")),
        )
        bits = let(
            counted,
            lambda c: F.when(c["n"] < 200, BIT["A"]).otherwise(0)
            + F.when(100 * c["d"].cast("long") < 50 * c["n"].cast("long"), BIT["B"]).otherwise(0),
        )
        return (
            bits
            + F.when(100 * capitals.cast("long") > 3 * F.length(t).cast("long"), BIT["C"]).otherwise(0)
            + F.when(t.rlike("[#$%&*|]"), BIT["D"]).otherwise(0)
        )

    return let(text, judged)


def _flagged(labels: DataFrame, id_col: str, good_col: str, toxic_col: str) -> DataFrame:
    """One row per labelled id: whether it is good, whether it is toxic."""
    return labels.groupBy(ref(id_col).alias("id")).agg(
        F.max(F.coalesce((ref(good_col) == 1).cast("long"), F.lit(0))).alias("good"),
        F.max(F.coalesce((ref(toxic_col) == 1).cast("long"), F.lit(0))).alias("toxic"),
    )


def mask_cells(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    good_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """(part, mask, n, good, toxic): rows per combination of failed filters."""
    text = text_or_empty(text_col)
    rows, _, _ = materialise(
        df.select(
            ref(id_col).alias("id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.coalesce(ref(part_col).cast("string"), F.lit("")).alias("part"),
            text_bits(text).alias("bits"),
        ),
        "filter-bits",
    )
    # repeated rows become one with a count, so no id or text is a hot key below
    known = rows.where(F.col("id").isNotNull()).groupBy("digest", "id", "part", "bits").agg(F.count(F.lit(1)).alias("n"))
    first = (
        rows.where(F.col("id").isNotNull())
        .groupBy("digest")
        .agg(F.min("id").alias("id"))
        .withColumn("late", F.lit(0))
    )
    judged = (
        known.join(first, ["digest", "id"], "left")
        .join(_flagged(labels, id_col, good_col, toxic_col), "id", "left")
        .select(
            "part",
            (F.col("bits") + F.coalesce(F.col("late"), F.lit(BIT["E"]))).alias("mask"),
            "n",
            (F.col("n") * F.coalesce(F.col("good"), F.lit(0))).alias("good"),
            (F.col("n") * F.coalesce(F.col("toxic"), F.lit(0))).alias("toxic"),
        )
    )
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    unknown = rows.where(F.col("id").isNull()).select(
        "part", F.col("bits").alias("mask"), one.alias("n"), none.alias("good"), none.alias("toxic")
    )
    return judged.union(unknown).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _orders() -> Column:
    """The 120 orders as one literal array of arrays of bits."""
    return F.array(*[F.array(*[F.lit(BIT[f]) for f in order]) for order in ORDERS])


def _fold(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """600 structs of the weights one mask cell adds, order by order and step by step."""
    zero = F.lit(0).cast("long")

    def walk(order: Column) -> Column:
        def step(state: Column, bit: Column) -> Column:
            fails = mask.bitwiseAND(bit) != 0
            goes = state["alive"] & fails
            alive = state["alive"] & ~fails
            row = F.struct(
                F.when(alive, n).otherwise(zero).alias("kept"),
                F.when(goes, n).otherwise(zero).alias("removed"),
                F.when(fails & ~state["alive"], n).otherwise(zero).alias("redundant"),
                F.when(mask == bit, n).otherwise(zero).alias("unique_fails"),
                F.when(goes, good).otherwise(zero).alias("good_lost"),
                F.when(goes, toxic).otherwise(zero).alias("toxic_lost"),
            )
            return F.struct(alive.alias("alive"), F.concat(state["rows"], F.array(row)).alias("rows"))

        empty = F.expr(
            "CAST(array() AS ARRAY<STRUCT<" + ", ".join(f"{c}: BIGINT" for c in COUNTS) + ">>)"
        )
        start = F.struct(F.lit(True).alias("alive"), empty.alias("rows"))
        return F.aggregate(order, start, step, lambda s: s["rows"])

    return F.flatten(F.transform(_orders(), walk))


def _added(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))


def audit(cells: DataFrame) -> DataFrame:
    """The report over :func:`mask_cells`: part, filter_order, step, the six counts and ``shapley``.

    ``shapley`` is what the step's filter removes, summed over all orders.
    """
    folded = cells.select("part", _fold(*[F.col(c) for c in ("mask", "n", "good", "toxic")]).alias("rows"))
    size = len(ORDERS) * len(FILTERS)
    nothing = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), size)
    # at most 32 cells a part, each of 600 structs
    merged = (
        folded.groupBy("part")
        .agg(F.collect_list("rows").alias("cells"))
        .select("part", F.aggregate("cells", nothing, _added).alias("rows"))
    )
    letters = F.array(*[F.lit(f) for order in ORDERS for f in order])
    totals = F.aggregate(
        F.zip_with(letters, F.col("rows"), lambda f, r: F.struct(f.alias("f"), r["removed"].alias("n"))),
        F.array_repeat(F.lit(0).cast("long"), len(FILTERS)),
        lambda acc, r: F.transform(
            acc, lambda x, k: x + F.when(r["f"] == F.substring(F.lit(FILTERS), k + 1, F.lit(1)), r["n"]).otherwise(F.lit(0))
        ),
    )
    orders = F.array(*[F.lit(o) for o in ORDERS])
    shown = merged.select("part", "rows", totals.alias("totals")).select(
        "part", "totals", F.posexplode("rows").alias("at", "row")
    )
    order = F.element_at(orders, F.floor(F.col("at") / len(FILTERS)).cast("int") + 1)
    step = (F.col("at") % len(FILTERS) + 1).cast("int")
    letter = F.substring(order, step, F.lit(1))
    return shown.select(
        "part",
        order.alias("filter_order"),
        step.alias("step"),
        *[F.col("row")[c].alias(c) for c in COUNTS],
        F.element_at("totals", F.instr(F.lit(FILTERS), letter)).alias("shapley"),
    )
