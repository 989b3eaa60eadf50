"""Joins whose balance does not depend on what adaptive execution finds out.

``hot_key_join`` looks for frequent keys first and deals their rows to several
tasks; ``bounded_hash_join`` measures the build side of a shuffled hash join,
which cannot spill, before it is built.  Both run a job over the key columns
while the join is being built.

The rows of a hot key form a grid: ``parts`` of the facts times ``copies`` of
the dimension's parts.  A fact row is dealt to one row of the grid and repeated
along it, a dimension row to one column and repeated along that, so every pair
meets in exactly one cell.  Keys that are not hot have one cell.  Rows are
dealt by a hash of their columns and of the task that holds them: a task that
is run again deals them alike, and equal rows are spread over the tasks'
number of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from blotter.plans.guards import materialise, row_bytes

HOT_KEYS = 1024  # at most so many frequent keys are dealt out, and broadcast
TRACKED = 8192  # counters of the sketch: keys above about 1 / 6000 of the rows are found for sure
SKETCHES = 256  # sketches merged to this many before the last merge
DOUBLINGS = 6  # of the partition count, at most
BUILD_BYTES = 256 << 20
CELLS = 4  # per task that a hot key fills: cells meet in a task by chance, small ones even out
MAX_PARTS = 1 << 20  # cells of the facts of one key
MAX_COPIES = 256  # cells of the dimension's rows of one key, along which its facts are repeated

_H, _I, _J = "__key_hash", "__grid_row", "__grid_column"


def _named(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _key_hash(keys: Sequence[str]) -> Column:
    """Stands for the key while looking for hot ones; keys that share a hash are dealt out together, which harms nothing."""
    return F.xxhash64(*[_col(k) for k in keys])


def frequent_keys(df: DataFrame, on: str | Sequence[str], more_than: int, max_keys: int = HOT_KEYS) -> DataFrame:
    """(``__key_hash``, ``n``): keys with more than ``more_than`` rows by a frequent-items sketch, the most frequent first.

    The sketch keeps ``TRACKED`` counters per task; they are merged in two
    levels.  A count may be over by a few thousandths of a thousandth of all
    rows, which only makes a key be dealt out a little more.
    """
    task = F.pmod(F.spark_partition_id(), F.lit(SKETCHES))
    hashed = df.select(_key_hash(_named(on)).alias("h"), task.alias("task"))
    sketched = hashed.groupBy("task").agg(F.expr(f"approx_top_k_accumulate(h, {TRACKED})").alias("sketch"))
    # a grouping, though of one group: a task without any sketch must pass on none
    merged = sketched.groupBy(F.floor(F.col("task") / SKETCHES)).agg(
        F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch")
    )
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {max_keys})")).alias("key"))
    found = top.select(F.col("key.item").alias(_H), F.col("key.count").alias("n"))
    return found.where(F.col("n") > more_than).orderBy(F.col("n").desc(), _H)


def _dealt(df: DataFrame, keys: Sequence[str], hot: DataFrame, own: str, other: str, at: str, along: str) -> DataFrame:
    """Rows with their cell: one place of ``own`` places, repeated over the ``other`` ones."""
    hashed = [_col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    tagged = df.withColumn(_H, _key_hash(keys)).join(F.broadcast(hot), _H, "left")
    place = F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.coalesce(own, F.lit(1)))
    cells = F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)
    return (
        tagged.withColumn(at, F.when(F.col(own) > 1, place).otherwise(F.lit(0)).cast("int"))
        .withColumn(along, F.explode(cells))
        .drop(_H, "parts", "copies")
    )


def _grid_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    hot: DataFrame,
    how: str,
    hint: str,
    partitions: int | None = None,
) -> DataFrame:
    """``facts`` ⋈ ``dim`` by key and cell; ``hot`` gives ``parts`` and ``copies`` of at most ``HOT_KEYS`` key hashes."""
    left = _dealt(facts, keys, hot, "parts", "copies", _I, _J)
    right = _dealt(dim, keys, hot, "copies", "parts", _J, _I)
    on = [*keys, _I, _J]
    if partitions:
        left, right = left.repartition(partitions, *on), right.repartition(partitions, *on)
    return left.join(right.hint(hint), on, how).drop(_I, _J)


def hot_key_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Sort-merge join in which no task has to hold all rows of a frequent key.

    A key of either side with more than ``rows_per_task`` rows (by default the
    mean of the larger side's rows per shuffle partition) is hot: its rows are
    dealt to a few cells for every task it fills, and the other side's rows of
    that key are repeated in each.  All others are shuffled as usual.  With
    ``how='left'`` only the facts are dealt out, as an unmatched row must not
    be repeated; rows with a NULL key count as one key, which never matches.
    """
    if how not in ("inner", "left"):
        raise ValueError("a hot-key join is 'inner' or 'left'")
    keys = _named(on)
    if how == "inner":
        facts, dim = facts.dropna(subset=keys), dim.dropna(subset=keys)
    if rows_per_task is None:
        partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sizes = [df.agg(F.count(F.lit(1)).alias("n")) for df in (facts, dim)]
        most = sizes[0].union(sizes[1]).agg(F.max("n")).first()[0]
        rows_per_task = max(1, most // partitions)
    cells = F.ceil(CELLS * F.col("n") / rows_per_task)
    hot = frequent_keys(facts, keys, rows_per_task).select(_H, F.least(cells, F.lit(MAX_PARTS)).cast("int").alias("parts"))
    if how == "inner":
        many = frequent_keys(dim, keys, rows_per_task)
        many = many.select(_H, F.least(cells, F.lit(MAX_COPIES)).cast("int").alias("copies"))
        hot = hot.join(many, _H, "full")
    else:
        hot = hot.withColumn("copies", F.lit(1))
    # at most 2 * HOT_KEYS rows, written once: both sides read the same
    hot = materialise(hot, "hot-keys")[0]
    return _grid_join(facts, dim, keys, hot, how, "merge")


def build_partitions(dim: DataFrame, on: str | Sequence[str], max_build_bytes: int, partitions: int) -> tuple[int, int]:
    """(partitions, bytes): the fewest partitions, doubling from ``partitions``, whose largest build side fits.

    Spark deals rows by the same hash of the key that is counted here, so the
    bytes (an estimate per row, :func:`row_bytes`) are those of the partition
    that will be built.  When none fits, the result is the largest count tried.
    """
    keys = [_col(k) for k in _named(on)]
    counts = [partitions << k for k in range(DOUBLINGS + 1)]
    fine = dim.groupBy(F.pmod(F.hash(*keys), F.lit(counts[-1])).alias("b")).agg(F.sum(row_bytes(dim)).alias("bytes"))
    tried = fine.select(F.explode(F.array(*[F.lit(c) for c in counts])).alias("p"), "b", "bytes")
    held = tried.groupBy("p", F.pmod("b", "p").alias("b")).agg(F.sum("bytes").alias("bytes"))
    largest = {r.p: r.bytes for r in held.groupBy("p").agg(F.max("bytes").alias("bytes")).collect()}
    if not largest:  # no rows
        return partitions, 0
    fits = [c for c in counts if largest[c] <= max_build_bytes]
    chosen = fits[0] if fits else counts[-1]
    return chosen, int(largest[chosen])


def bounded_hash_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_build_bytes: int = BUILD_BYTES,
    on_excess: str = "split",
) -> DataFrame:
    """Shuffled hash join whose build side, ``dim``, is known to fit before it is built.

    The partition count is doubled until the largest build partition holds at
    most ``max_build_bytes``.  Where a single key is beyond that whatever the
    count, ``on_excess='split'`` deals the key's rows to several partitions and
    repeats the facts of that key there (inner joins; at most ``HOT_KEYS`` such
    keys of ``MAX_COPIES`` parts each, else ``ValueError``), and ``'refuse'``
    raises ``ValueError``.  A left join, which must not repeat facts, raises
    there, too.
    """
    if how not in ("inner", "left"):
        raise ValueError("a bounded hash join is 'inner' or 'left'")
    if on_excess not in ("split", "refuse"):
        raise ValueError("on_excess is 'split' or 'refuse'")
    keys = _named(on)
    dim = dim.dropna(subset=keys)
    if how == "inner":
        facts = facts.dropna(subset=keys)
    start = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions, largest = build_partitions(dim, keys, max_build_bytes, start)
    if largest <= max_build_bytes:
        left, right = facts.repartition(partitions, *map(_col, keys)), dim.repartition(partitions, *map(_col, keys))
        return left.join(right.hint("shuffle_hash"), keys, how)
    if on_excess == "refuse" or how == "left":
        raise ValueError(
            f"one build partition of the hash join holds about {largest} bytes, over {max_build_bytes}, "
            f"even with {partitions} partitions"
        )
    heavy = dim.groupBy(_key_hash(keys).alias(_H)).agg(F.sum(row_bytes(dim)).alias("bytes"))
    heavy = heavy.where(F.col("bytes") > max_build_bytes // 2).select(
        _H, F.lit(1).alias("parts"), F.ceil(2 * F.col("bytes") / max_build_bytes).cast("int").alias("copies")
    )
    hot, n, _ = materialise(heavy.orderBy(F.col("copies").desc()).limit(HOT_KEYS + 1), "heavy-keys")
    most = hot.agg(F.max("copies")).first()[0]
    if n > HOT_KEYS or (most or 0) > MAX_COPIES:
        raise ValueError("too many keys, or too large ones, for a hash join; use a sort-merge join")
    return _grid_join(facts, dim, keys, hot, how, "shuffle_hash", partitions)
