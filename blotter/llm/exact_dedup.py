"""Exact dedup with a heavy-hitter split.

1. Each row becomes (id, SHA-256 of its text); the table is written once to
   the shared scratch folder, so later steps never read a text again.
2. Misra-Gries: every partition keeps at most ``counters`` (digest, count)
   pairs; summaries are merged in groups of ``FAN_IN`` until one is left.
   Every digest held by more than 1 / (counters + 1) of all rows survives.
3. The survivors (at most ``counters`` rows, a bound by construction) are
   broadcast to count them exactly; partial aggregation leaves at most
   ``counters`` rows per task to shuffle.  These verified winners carry the
   group's size and the id that stays.
4. The winners are broadcast again: rows of hot digests are resolved where
   they lie.  All others, none of which is hot, go through an ordinary
   shuffle on the digest.

Of equal texts the row with the largest id stays.  Defined results: a null
text counts as empty; a null id is smaller than any other; rows equal in id
and text are told apart by their place in the written table, and exactly one
of them is kept; an empty table gives an empty result.  Further columns do
not matter to :func:`annotate` and are kept by :func:`keep_distinct`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.columns import free_name, ref, text_or_empty
from blotter.plans.guards import materialise

COUNTERS = 1024
FAN_IN = 64


def digest(text_col: str, normalise: Callable[[Column], Column] | None = None) -> Column:
    """SHA-256 of the (normalised) text, as 32 bytes."""
    text = text_or_empty(text_col)
    return F.unhex(F.sha2(normalise(text) if normalise else text, 256))


def misra_gries(counts: dict, counters: int) -> dict:
    """Reduce (digest -> count) to at most ``counters`` entries.

    Subtracting the (counters + 1)-th largest count from all and dropping what
    is not positive is the merge step of mergeable summaries: the error stays
    within n / (counters + 1) over any merge tree.
    """
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {k: v - cut for k, v in counts.items() if v > cut}


def _summarise(counters: int, fan_in: int):
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            values = batch.column(0).value_counts()
            for d, n in zip(values.field("values").to_pylist(), values.field("counts").to_pylist()):
                held[d] = held.get(d, 0) + n
            held = misra_gries(held, counters)
        task = TaskContext.get().partitionId()
        yield _batch(held, task // fan_in)

    return run


def _batch(held: dict, group: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(held), pa.binary()),
            pa.array(list(held.values()), pa.int64()),
            pa.array([group] * len(held), pa.int64()),
        ],
        names=["digest", "n", "g"],
    )


def heavy_hitters(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest): at most ``counters`` rows, with every digest over 1 / (counters + 1) of the rows."""
    schema = "digest binary, n long, g long"
    summaries = digests.select("digest").mapInArrow(_summarise(counters, FAN_IN), schema)
    tasks = digests.rdd.getNumPartitions()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        held: dict = {}
        for d, n in zip(table.column("digest").to_pylist(), table.column("n").to_pylist()):
            held[d] = held.get(d, 0) + n
        return pa.Table.from_batches([_batch(misra_gries(held, counters), key[0].as_py() // FAN_IN)])

    groups = -(-tasks // FAN_IN)  # a group holds the summaries of at most FAN_IN tasks
    while True:
        summaries = summaries.groupBy("g").applyInArrow(merge, schema)
        if groups <= 1:
            return summaries.select("digest")
        groups = -(-groups // FAN_IN)


def _winner() -> list[Column]:
    return [F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "rid")).alias("winner")]


def digest_table(
    df: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column] | None = None
) -> DataFrame:
    """(id, rid, digest) as written Parquet; ``rid`` numbers the rows."""
    table = df.select(
        ref(id_col).alias("id"),
        F.monotonically_increasing_id().alias("rid"),
        digest(text_col, normalise).alias("digest"),
    )
    return materialise(table, "digests")[0]


def annotate(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    counters: int = COUNTERS,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    rows = digest_table(df, id_col, text_col, normalise)
    hot = F.broadcast(heavy_hitters(rows, counters))
    winners, _, _ = materialise(
        rows.join(hot, "digest", "left_semi").groupBy("digest").agg(*_winner()), "winners"
    )
    marked = rows.join(F.broadcast(winners), "digest", "left")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    totals = rest.groupBy("digest").agg(*_winner())
    cold = rest.join(totals, "digest")
    done = marked.where(F.col("size").isNotNull()).unionByName(cold)
    return done.select(
        F.col("id").alias(id_col),
        F.col("winner.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("rid") == F.col("winner.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_distinct(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    counters: int = COUNTERS,
) -> DataFrame:
    """The input rows that stay, all columns unchanged.

    Rows of verified hot digests are dropped in place unless they hold the
    winning id; what is left is dealt by digest and the first row of each
    digest (largest id) stays.
    """
    name, order = free_name(df, "digest__"), free_name(df, "rank__")
    rows = digest_table(df, id_col, text_col, normalise)
    hot = F.broadcast(heavy_hitters(rows, counters))
    winners, _, _ = materialise(
        rows.join(hot, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("id").alias("top"))
        .select(F.col("digest").alias(name), F.col("top").alias(order)),
        "winners",
    )
    tagged = df.withColumn(name, digest(text_col, normalise)).join(F.broadcast(winners), name, "left")
    left = tagged.where(ref(order).isNull() | ref(id_col).eqNullSafe(ref(order))).drop(order)
    place = Window.partitionBy(ref(name)).orderBy(ref(id_col).desc_nulls_last())
    return left.withColumn(order, F.row_number().over(place)).where(ref(order) == 1).drop(name, order)
