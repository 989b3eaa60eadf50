"""Near-duplicate vectors by NN-descent: links at a cosine threshold, their components, one kept per component.

1. Equal vectors of one label become one node with a count, so a group of
   copies, however large, is one row of the search.
2. Seeds: the nodes are put in order of random hyperplane codes, ``TABLES``
   times over, and compared with their next ``WINDOW`` places.
3. Descent: the ``list_size`` best neighbours found so far are a node's list.
   Each round joins every node's list (and as many of the nodes that list it)
   with the vectors and compares its members with one another: neighbours of
   neighbours.  Only pairs with a member that is new to the list are compared.
   Rounds end when few lists change.
4. All links that ever stood on a list connect components.  A list that holds
   links only is saturated and may hide more: such lists are enlarged to the
   whole component.  Members are binned by their angle to the component's
   first node; by the triangle inequality most bins are linked or apart as a
   whole and are only counted, the others are compared in blocks.  Tight
   groups are linear in their size, whatever it is.
5. Audit: ``audit_size`` nodes, the least by hash, are compared with all
   nodes, in blocks.  While the links found are below ``target`` of theirs,
   the search goes on with further seeds.  The recall of a label's rare links
   cannot be seen in so small a sample; it is that of all nodes together.

Similarities are cosines in double precision throughout; no link is guessed
but for those the triangle inequality proves with a margin of 1e-6 radians.

Defined results: a vector that is null, empty, zero or holds null or
non-finite components, and one without a label, links with nothing; vectors of
different lengths do not link; rows that repeat an id are rows of their own; a
null id never names a component unless it has no other, and such a component
keeps all its rows; an empty table gives no rows.  Only the named columns are
read.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from blotter.llm.columns import ref
from blotter.llm.components import components
from blotter.plans.guards import materialise

THRESHOLD = 0.93
LIST_SIZE = 10
TABLES = 8
WINDOW = 3
CODE_BITS = 48
BEST = 4  # partners a member gets from one list, beside all links
ROUNDS = 5
CHANGED = 0.05  # share of new list entries below which a descent ends
AUDIT_SIZE = 1024
TARGET = 0.98
AUDITS = 4
BINS = 16  # of the angle of the threshold
MARGIN = 1e-6  # radians
BLOCK = 1024
CELLS = 1 << 20  # numbers held by one numpy step

Batches = Iterator[pa.RecordBatch]


# ------------------------------------------------------------------ vectors


def _unit(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) for every length of vector in the column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten()).astype(np.float64)
    sizes = np.asarray(column.value_lengths())
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        x = flat[begin[rows][:, None] + np.arange(d)] if len(rows) < len(sizes) else flat.reshape(-1, d)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
        out.append((rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def _usable(v: Column) -> Column:
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0)


def _edges(u: np.ndarray, v: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(sim)], names=["u", "v", "sim"])


EDGES = "u long, v long, sim double"


# -------------------------------------------------------------------- seeds


def _codes(tables: int, seed: int) -> Callable[[Batches], Batches]:
    """Each node ``tables`` times, with a code of hyperplane signs."""

    def run(batches: Batches) -> Batches:
        weights = 1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            node = np.asarray(batch.column("node"))
            code = np.zeros((tables, len(node)), dtype=np.int64)
            for rows, x in _unit(batch.column("v")):
                for t in range(tables):
                    planes = np.random.default_rng([seed, t, x.shape[1]]).standard_normal((x.shape[1], CODE_BITS))
                    code[t, rows] = (x @ planes > 0) @ weights
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), t)), pa.array(code[t]), *batch.columns],
                    names=["t", "code", *batch.schema.names],
                )

    return run


def _neighbours_in_order(window: int) -> Callable[[Batches], Batches]:
    """Every row with the next ``window`` rows of its table and label."""

    def run(batches: Batches) -> Batches:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            fresh = 0
            if held is not None:
                fresh = len(held)
                rows = pa.concat_tables([held, rows])
            held = rows.slice(max(0, len(rows) - window))
            node, t, g = (np.asarray(rows.column(c)) for c in ("node", "t", "g"))
            for at, x in _unit(rows.column("v")):
                for k in range(1, window + 1):
                    a, b = np.arange(len(at) - k), np.arange(k, len(at))
                    same = (g[at[a]] == g[at[b]]) & (t[at[a]] == t[at[b]]) & (at[b] >= fresh)
                    a, b = a[same], b[same]
                    sim = np.einsum("ij,ij->i", x[a], x[b])
                    u, v = node[at[a]], node[at[b]]
                    yield _edges(np.concatenate([u, v]), np.concatenate([v, u]), np.concatenate([sim, sim]))

    return run


def _seeds(nodes: DataFrame, tables: int, window: int, seed: int) -> DataFrame:
    rows = nodes.select("node", "g", "v")
    kind = rows.schema["v"].dataType.simpleString()
    coded = rows.mapInArrow(_codes(tables, seed), f"t long, code long, node long, g long, v {kind}")
    # the last key tells equal codes apart: no range is a single hot code
    order = ["t", "g", "code", F.xxhash64("node")]
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours_in_order(window), EDGES)


# ------------------------------------------------------------------ descent


def _best(found: DataFrame, size: int) -> DataFrame:
    """The ``size`` best neighbours of every node: u, v, sim, fresh."""
    # dealt by u once, for the distinct pairs and for the ranks
    once = found.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    place = Window.partitionBy("u").orderBy(F.col("sim").desc(), "v")
    return once.withColumn("k", F.row_number().over(place)).where(F.col("k") <= size).drop("k")


def _pairs_of_lists(threshold: float) -> Callable[[Batches], Batches]:
    """Members of one list compared with one another; rows come grouped by the list's node ``m``."""

    def joined(rows: pa.Table) -> Batches:
        m, a, fresh = (np.asarray(rows.column(c)) for c in ("m", "a", "fresh"))
        for at, x in _unit(rows.column("v")):
            starts = np.flatnonzero(np.append(True, m[at][1:] != m[at][:-1]))
            sizes = np.diff(np.append(starts, len(at)))
            for wide in np.unique(1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)):
                some = np.flatnonzero((sizes <= wide) & (sizes > (wide // 2 if wide > 2 else 1)))
                part = max(1, CELLS // (int(wide) * max(int(wide), x.shape[1])))
                for k in range(0, len(some), part):
                    yield from compared(at, x, a, fresh, starts[some[k : k + part]], sizes[some[k : k + part]], int(wide))

    def compared(at, x, a, fresh, starts, sizes, wide) -> Batches:
        slot = np.arange(wide)
        filled = slot < sizes[:, None]
        row = np.where(filled, starts[:, None] + slot, starts[:, None])
        part = x[row]
        sim = part @ part.transpose(0, 2, 1)
        new = fresh[at[row]].astype(bool) & filled
        use = filled[:, :, None] & filled[:, None, :] & (new[:, :, None] | new[:, None, :])
        use &= ~np.eye(wide, dtype=bool)
        sim = np.where(use, sim, -2.0)
        least = np.partition(sim, max(0, wide - BEST), axis=2)[:, :, max(0, wide - BEST)]
        keep = use & ((sim >= least[:, :, None]) | (sim >= threshold))
        g, i, j = np.nonzero(keep)
        yield _edges(a[at[row[g, i]]], a[at[row[g, j]]], sim[g, i, j])

    def run(batches: Batches) -> Batches:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows]).combine_chunks()
            m = np.asarray(rows.column("m"))
            if not len(m):
                continue
            done = int(np.searchsorted(m, m[-1]))  # the last list may go on
            held = rows.slice(done)
            if done:
                yield from joined(rows.slice(0, done))
        if held is not None:
            yield from joined(held)

    return run


def _descend(nodes: DataFrame, lists: DataFrame, size: int, threshold: float, nth: int) -> DataFrame:
    """One round: the lists joined with the vectors, their members compared, the better ones kept."""
    back = lists.select(F.col("v").alias("m"), F.col("u").alias("a"), "fresh")
    # as many of the nodes that list m as m lists itself; a search order, links stay on the lists
    place = Window.partitionBy("m").orderBy(F.col("fresh").desc(), F.xxhash64("m", "a", F.lit(nth)))
    back = back.withColumn("k", F.row_number().over(place)).where(F.col("k") <= size).drop("k")
    both = lists.select(F.col("u").alias("m"), F.col("v").alias("a"), "fresh").union(back)
    members = both.groupBy("m", "a").agg(F.max("fresh").alias("fresh"))
    vectors = nodes.select(F.col("node").alias("a"), "v")
    found = (
        members.join(vectors.hint("merge"), "a")
        .select("m", "a", "fresh", "v")
        .repartition("m")
        .sortWithinPartitions("m")
        .mapInArrow(_pairs_of_lists(threshold), EDGES)
    )
    old = lists.select("u", "v", "sim", F.lit(0).alias("fresh"))
    return _best(found.withColumn("fresh", F.lit(1)).unionByName(old), size)


def _search(
    nodes: DataFrame, n: int, size: int, threshold: float, seed: int, lists: DataFrame | None
) -> tuple[DataFrame, list[DataFrame]]:
    """The lists after a descent, and every list table on the way."""
    seeds = _seeds(nodes, TABLES, WINDOW, seed).withColumn("fresh", F.lit(1))
    if lists is not None:
        seeds = seeds.unionByName(lists.withColumn("fresh", F.lit(0)))
    lists, _, _ = materialise(_best(seeds, size), "neighbour-seeds")
    log = [lists]
    for nth in range(ROUNDS):
        lists, entries, _ = materialise(_descend(nodes, lists, size, threshold, nth), f"neighbour-lists-{nth}")
        log.append(lists)
        if lists.where("fresh = 1").count() <= CHANGED * entries:
            break
    return lists, log


# ------------------------------------------------------- links and components


def _angles(batches: Batches) -> Batches:
    """Angle of every member to the first node of its component."""
    for batch in batches:
        angle = np.zeros(len(batch))
        # linked vectors have equal lengths, so both columns split into the same rows
        for (rows, x), (_, p) in zip(_unit(batch.column("v")), _unit(batch.column("pivot"))):
            angle[rows] = np.arccos(np.clip(np.einsum("ij,ij->i", x, p), -1, 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("component"), batch.column("node"), pa.array(angle)], names=["component", "node", "angle"]
        )


def _block_links(threshold: float) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        side, node, w = (np.asarray(rows.column(c)) for c in ("side", "node", "w"))
        (_, x), = _unit(rows.column("v"))
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(b)  # a block with itself
        b = a if alone else b
        linked = x[a] @ x[b].T >= threshold
        if alone:
            np.fill_diagonal(linked, False)
            nodes, links = node[a], linked @ w[a]
        else:
            nodes = np.concatenate([node[a], node[b]])
            links = np.concatenate([linked @ w[b], linked.T @ w[a]])
        return pa.table({"node": nodes, "links": links.astype(np.int64)})

    return run


def _whole_components(nodes: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, links): weighted links of every member within its component, all pairs decided."""
    reach = float(np.arccos(threshold))
    step = (reach - MARGIN) / BINS
    rows = members.join(nodes.select("node", "w", "v"), "node")
    pivots = nodes.select(F.col("node").alias("component"), F.col("v").alias("pivot"))
    pivots = pivots.join(members.select("component").distinct(), "component", "left_semi")
    angles = rows.join(pivots, "component").mapInArrow(_angles, "component long, node long, angle double")
    binned, _, _ = materialise(
        angles.join(nodes.select("node", "w"), "node").withColumn("bin", F.floor(F.col("angle") / step).cast("int")),
        "neighbour-bins",
    )
    bins, _, _ = materialise(
        binned.groupBy("component", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("weight")), "bin-counts"
    )
    one, two = bins.alias("one"), bins.alias("two")
    # bins whose outer edges lie within reach of each other: linked as a whole
    sure = (
        one.join(two, F.col("one.component") == F.col("two.component"))
        .where(F.col("one.bin") + F.col("two.bin") + 2 <= BINS)
        .groupBy("one.component", "one.bin")
        .agg(F.sum("two.weight").alias("sure"))
    )
    counted = binned.join(sure, ["component", "bin"]).select(
        "node", (F.col("sure") - F.when(2 * F.col("bin") + 2 <= BINS, F.col("w")).otherwise(0)).alias("links")
    )
    # the rest, but for bins out of reach, in pairs of blocks
    near = (
        one.join(two, F.col("one.component") == F.col("two.component"))
        .where("one.bin <= two.bin")
        .where(F.col("one.bin") + F.col("two.bin") + 2 > BINS)
        .where(F.col("two.bin") - F.col("one.bin") - 1 <= BINS)
    )
    blocks = [F.ceil(F.col(f"{s}.n") / BLOCK).cast("int") for s in ("one", "two")]
    pairs = near.select(
        F.col("one.component").alias("component"),
        F.col("one.bin").alias("bin0"),
        F.col("two.bin").alias("bin1"),
        F.explode(F.sequence(F.lit(0), blocks[0] - 1)).alias("block0"),
        blocks[1].alias("n1"),
    )
    pairs = pairs.select(
        "component", "bin0", "block0", "bin1", F.explode(F.sequence(F.lit(0), F.col("n1") - 1)).alias("block1")
    ).where("bin0 < bin1 OR block0 <= block1")
    placed = (
        binned.join(bins.select("component", "bin", "n"), ["component", "bin"])
        .withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).cast("int"))
        .join(nodes.select("node", "v"), "node")
        .select("component", "bin", "block", "node", "w", "v")
    )
    pair = ["component", "bin0", "block0", "bin1", "block1"]

    def side(k: int, which: DataFrame) -> DataFrame:
        named = placed.withColumnsRenamed({"bin": f"bin{k}", "block": f"block{k}"})
        return which.join(named, ["component", f"bin{k}", f"block{k}"]).select(
            *pair, F.lit(k).alias("side"), "node", "w", "v"
        )

    itself = (F.col("bin0") == F.col("bin1")) & (F.col("block0") == F.col("block1"))
    compared = (
        side(0, pairs).union(side(1, pairs.where(~itself))).groupBy(*pair).applyInArrow(_block_links(threshold), "node long, links long")
    )
    return counted.union(compared).groupBy("node").agg(F.sum("links").alias("links"))


def _links(nodes: DataFrame, lists: DataFrame, log: list[DataFrame], size: int, threshold: float) -> DataFrame:
    """(node, links, component): weighted links to other nodes; nodes without links are left out."""
    found = reduce(DataFrame.union, [x.where(F.col("sim") >= threshold).select("u", "v") for x in log])
    edges, n, _ = materialise(
        found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "neighbour-links"
    )
    of, _, _ = materialise(
        components(edges).select(F.col("vertex").alias("node"), "component"), "neighbour-components"
    )
    full = lists.where(F.col("sim") >= threshold).groupBy("u").count().where(F.col("count") >= size)
    whole, _, _ = materialise(
        of.join(full.select(F.col("u").alias("node")), "node").select("component").distinct(), "saturated"
    )
    both = edges.union(edges.select("v", "u"))
    weights = nodes.select(F.col("node").alias("v"), "w")
    direct = both.join(weights, "v").groupBy(F.col("u").alias("node")).agg(F.sum("w").alias("links"))
    light = of.join(whole, "component", "left_anti").join(direct, "node").select("node", "links", "component")
    heavy = of.join(whole, "component", "left_semi")
    counted = _whole_components(nodes, heavy.select("component", "node"), threshold)
    return light.union(heavy.join(counted, "node").select("node", "links", "component"))


# --------------------------------------------------------------------- audit


def _audit(nodes: DataFrame, links: DataFrame, threshold: float, size: int) -> float:
    """Share of the links of the audited nodes, to all nodes, that were found."""
    asked = nodes.select("node", "g", "v").orderBy(F.xxhash64("node"), "node").limit(size).toArrow().combine_chunks()
    ids, groups = np.asarray(asked.column("node")), np.asarray(asked.column("g"))
    units = _unit(asked.column("v"))
    want = len(ids)

    def run(batches: Batches) -> Batches:
        total = np.zeros(want, dtype=np.int64)
        for batch in batches:
            node, g, w = (np.asarray(batch.column(c)) for c in ("node", "g", "w"))
            for rows, x in _unit(batch.column("v")):
                for at, q in units:
                    if q.shape[1] != x.shape[1]:
                        continue
                    part = max(1, CELLS // max(len(at), x.shape[1]))
                    for k in range(0, len(rows), part):
                        near = rows[k : k + part]
                        hit = (q @ x[k : k + part].T >= threshold) & (groups[at][:, None] == g[near])
                        hit &= ids[at][:, None] != node[near]
                        total[at] += hit @ w[near]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["node", "truth"])

    truth = nodes.select("node", "g", "w", "v").mapInArrow(run, "node long, truth long").groupBy("node").agg(F.sum("truth").alias("truth"))
    got = truth.join(links, "node", "left").agg(F.sum("truth"), F.sum(F.coalesce("links", F.lit(0)))).first()
    return 1.0 if not got[0] else got[1] / got[0]


# ---------------------------------------------------------------- near copies


def near_copies(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    list_size: int = LIST_SIZE,
    audit_size: int = AUDIT_SIZE,
    target: float = TARGET,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Two vectors link when their labels are equal and their cosine is at least
    ``threshold`` (over 0); ``n_links`` counts rows, copies included.  A
    warning names the recall where ``AUDITS`` searches do not reach ``target``.
    """
    if not 0 < threshold < 1:
        raise ValueError("the threshold lies between 0 and 1")
    element = df.schema[vec_col].dataType.elementType
    number = "float" if isinstance(element, FloatType) else "double"
    v = ref(vec_col).cast(ArrayType(FloatType()) if number == "float" else "array<double>")
    v = F.transform(v, lambda x: x + F.lit(0.0).cast(number))  # one zero
    good = _usable(F.col("v")) & F.col("label").isNotNull()
    clean = df.select(ref(id_col).alias("id"), ref(label_col).cast("string").alias("label"), v.alias("v"))
    digest = [F.xxhash64(F.lit(k), "label", F.size("v"), "v").alias(f"d{k}") for k in (1, 2)]
    rows, _, _ = materialise(
        clean.select("id", F.when(good, F.struct(*digest)).alias("d")).select("id", "d.d1", "d.d2"), "vector-rows"
    )
    nodes, n, _ = materialise(
        clean.where(good)
        .groupBy("label", "v")
        .agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("top"))
        .select(
            F.monotonically_increasing_id().alias("node"),
            F.xxhash64("label", F.size("v")).alias("g"),
            *digest,
            "w",
            "top",
            "v",
        ),
        "vector-nodes",
    )
    lists, log = None, []
    for attempt in range(AUDITS):
        lists, tables = _search(nodes, n, list_size, threshold, attempt, lists)
        log += tables
        links, _, _ = materialise(_links(nodes, lists, log, list_size, threshold), "node-links")
        recall = _audit(nodes, links, threshold, audit_size)
        if recall >= target:
            break
    else:
        warnings.warn(f"audited recall {recall:.4f} is below {target}", stacklevel=2)
    named = nodes.select("node", "d1", "d2", "w", "top").join(links, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("top").alias("component_id"))
    by_vector = named.join(least, "component").select(
        "d1", "d2", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (
        rows.join(by_vector, ["d1", "d2"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
    )
