"""N-gram Jaccard join by MinHash prefixes of one length with exact verification.

The dealt method, an LSH forest, shortens the matched prefix document by
document until the target recall is met.  As no document can know of partners
it has not met, every one would have to go down to the length that meets the
target at the threshold; that length is computed beforehand instead, and the
candidates are those that the tries' nodes at that depth hold.  No tries are
built and no prefix is shortened by document.

A document is the set of its shingles of five words (lower-cased A-Z; a text
of one to four words is a single shingle).  Two documents are linked when the
Jaccard similarity of their sets is at least 0.8.

* Documents with the same shingles are one class; all later steps see a class
  once, with its number of copies.
* Nodes: ``TREES`` signatures, of each the longest prefix (up to ``MAX_DEPTH``
  minimum hashes) at which a pair at the threshold is found with the target
  recall; classes that share a prefix are candidates.
* Candidate components: the nodes' stars are joined into connected components,
  so that every class is sent to one place instead of one per tree.
* Exact verification: components are cut into blocks of about ``BLOCK``
  classes; a task takes a pair of blocks (or a bunch of small components) and
  compares, by exact set intersection, every pair that shares a trie node.
  It gives one row per class with its number of links, and the links of a
  spanning forest.  So the output grows with the documents, never with the
  pairs, and a component of any size is spread over many tasks.
* Components of the verified links are the result's classes.

Defined results: a null or empty text, or one of white space only, has no
shingles and is linked to nothing; repeated rows are copies of each other;
a class's id is the smallest id in it (null if it has none); an empty table
gives an empty result; further columns do not matter.  Ids should identify
documents; rows that share an id stay or go together in :func:`keep_one`,
and rows without an id stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from blotter.llm import kernels
from blotter.llm.columns import ref
from blotter.llm.components import components
from blotter.plans.guards import materialise

SHINGLE = 5
TREES = 16
MAX_DEPTH = 8
RECALL = 0.999
BLOCK = 1024

_SEEDS = kernels.mix(np.arange(1, TREES * MAX_DEPTH + 1, dtype=np.uint64) * kernels.MIX_A)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def forest_depth(threshold: float, recall: float = RECALL, trees: int = TREES, deepest: int = MAX_DEPTH) -> int:
    """The longest prefix at which a pair at the threshold is found often enough.

    Starts at the full signature and drops one hash at a time; a pair of
    similarity s agrees on d hashes of a tree with probability s**d.
    """
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of all texts in order, and n + 1 offsets."""
    data, ends = kernels.flatten(texts)
    data = kernels.lower_ascii(data)
    starts, stops, doc = kernels.word_spans(data, ends)
    w = kernels.word_hashes(data, starts, stops)
    counts = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(counts) - counts
    with np.errstate(over="ignore"):
        h = np.zeros(len(w), dtype=np.uint64)
        for k in range(size):
            h[: len(w) - k] = h[: len(w) - k] * _STEP + w[k:] if len(w) > k else 0
        short = np.flatnonzero((counts > 0) & (counts < size))
        for d in short:
            x = np.uint64(counts[d])
            for v in w[first[d] : first[d] + counts[d]]:
                x = x * _STEP + v
            h[first[d]] = x
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    place = np.arange(len(w)) - first[doc] if len(w) else np.zeros(0, dtype=np.int64)
    ends_out = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(n, out=ends_out[1:])
    return kernels.mix(h[place < n[doc]]), ends_out


def set_keys(h: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    """A 16-byte key of each document's shingles (as a bag); None without shingles."""
    sums = []
    for salt in (kernels.MIX_A, kernels.MIX_B):
        total = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(kernels.mix(h ^ salt), out=total[1:])
        sums.append(total[ends[1:]] - total[ends[:-1]])
    both = np.stack(sums, axis=1).tobytes()
    size = np.diff(ends)
    return [both[16 * k : 16 * k + 16] if size[k] else None for k in range(len(size))]


def forest_nodes(h: np.ndarray, ends: np.ndarray, depth: int, trees: int = TREES) -> np.ndarray:
    """For every document with shingles, its trie node per tree (documents x trees)."""
    full = np.flatnonzero(np.diff(ends))
    at = ends[full]
    out = np.zeros((len(full), trees), dtype=np.uint64)
    if not len(full):
        return out
    with np.errstate(over="ignore"):
        for t in range(trees):
            node = np.full(len(full), t + 1, dtype=np.uint64)
            for d in range(depth):
                seed = _SEEDS[t * MAX_DEPTH + d]
                low = np.minimum.reduceat((h ^ seed) * (seed | np.uint64(1)), at)
                node = kernels.mix(node * _STEP + low)
            out[:, t] = node
    return out


def _sketch(depth: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in kernels.slices(kernels.as_bytes(batch.column(1))):
                h, ends = shingles(texts)
                keys = set_keys(h, ends)
                nodes = iter(forest_nodes(h, ends, depth, trees).view(np.int64))
                lists = [next(nodes) if key is not None else None for key in keys]
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                    names=["id", "key", "nodes"],
                )

    return run


def _keyed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in kernels.slices(kernels.as_bytes(batch.column(0))):
            h, ends = shingles(texts)
            own = batch.column(0).slice(first, len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(h, ends), pa.binary()), own], names=["key", "text"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, sorted distinct shingles as bytes)."""
    for batch in batches:
        for first, texts in kernels.slices(kernels.as_bytes(batch.column(1))):
            h, ends = shingles(texts)
            sets = [np.unique(h[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
            own = batch.column(0).slice(first, len(texts))
            yield pa.RecordBatch.from_arrays([own, pa.array(sets, pa.binary())], names=["cid", "set"])


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of the given pairs of sorted sets."""
    out = np.zeros(len(left), dtype=np.int64)
    if not len(left):
        return out
    sizes = np.array([len(s) for s in sets])
    values, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    keep = counts[ids] > 1
    ids = shared[ids[keep]]
    owner = np.repeat(np.arange(len(sets)), sizes)[keep]
    universe = int(shared[-1]) + 1
    if len(left) * universe / 64 > 16 * (sizes[left] + sizes[right]).sum():
        for k, (a, b) in enumerate(zip(left, right)):  # few pairs of long sets: merge them
            out[k] = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        return out
    width = 1 << 14  # bits of the universe handled at a time
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    for low in range(0, universe, width):
        a, b = np.searchsorted(ids, [low, low + width])
        bits = np.zeros((len(sets), min(width, universe - low + 63) // 64 + 1), dtype=np.uint64)
        local = ids[a:b] - low
        np.bitwise_or.at(bits, (owner[a:b], local >> 6), np.uint64(1) << (local & 63).astype(np.uint64))
        step = max(1, (1 << 22) // bits.shape[1])
        for k in range(0, len(left), step):
            both = bits[left[k : k + step]] & bits[right[k : k + step]]
            out[k : k + step] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return out


def verify(
    sets: list[np.ndarray], nodes: np.ndarray, side: np.ndarray, threshold_num: int = 4, threshold_den: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs among those that share a trie node.

    ``side`` is 0 or 1 for the two blocks; with one block (all 0) its own
    pairs are compared, with two only pairs across.
    """
    rows, cols = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(sets)),) * 2
    share = np.zeros((len(rows), len(cols)), dtype=bool)
    for t in range(nodes.shape[1]):
        share |= nodes[rows, t][:, None] == nodes[cols, t][None, :]
    if not side.any():
        share = np.triu(share, 1)
    a, b = np.nonzero(share)
    a, b = rows[a], cols[b]
    sizes = np.array([len(s) for s in sets])
    small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    may = small * threshold_den >= large * threshold_num  # no larger similarity is possible
    a, b = a[may], b[may]
    inter = overlaps(sets, a, b)
    linked = inter * threshold_den >= (sizes[a] + sizes[b] - inter) * threshold_num
    return a[linked], b[linked]


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest (at most n - 1) of the graph with links a-b."""
    order = np.argsort(np.concatenate([a, b]), kind="stable")
    far = np.concatenate([b, a])[order]
    ends = np.searchsorted(np.concatenate([a, b])[order], np.arange(n + 1))
    seen, out = np.zeros(n, dtype=bool), []
    for root in np.unique(a):
        if seen[root]:
            continue
        seen[root], stack = True, [root]
        while stack:
            v = stack.pop()
            for w in far[ends[v] : ends[v + 1]]:
                if not seen[w]:
                    seen[w] = True
                    out.append((v, w))
                    stack.append(w)
    return out


_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])


def _verify_block(table: pa.Table) -> pa.Table:
    cid = table.column("cid").to_numpy()
    comp = table.column("comp").to_numpy()
    side = table.column("side").to_numpy()
    copies = table.column("copies").to_numpy()
    sets = [np.frombuffer(s, dtype=np.uint64) for s in table.column("set").to_pylist()]
    nodes = np.array(table.column("nodes").to_pylist(), dtype=np.int64).reshape(len(cid), -1)
    order = np.argsort(comp, kind="stable")
    cuts = np.flatnonzero(np.diff(comp[order])) + 1
    us, vs, ns = [], [], []
    for part in np.split(order, cuts):  # one component, or several small ones
        a, b = verify([sets[k] for k in part], nodes[part], side[part])
        if not len(a):
            continue
        n = np.bincount(a, copies[part][b], len(part)) + np.bincount(b, copies[part][a], len(part))
        has = np.flatnonzero(n)
        us += cid[part[has]].tolist()
        vs += [None] * len(has)
        ns += n[has].astype(np.int64).tolist()
        for x, y in spanning_forest(len(part), a, b):
            us.append(int(cid[part[x]]))
            vs.append(int(cid[part[y]]))
            ns.append(None)
    return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in (us, vs, ns)], schema=_LINKS)


def _classes(df: DataFrame, id_col: str, text_col: str, depth: int) -> tuple[DataFrame, DataFrame]:
    """(id, key) of every row, and one row per set of shingles."""
    schema = df.select(ref(id_col).alias("id")).schema.add("key", BinaryType()).add(
        "nodes", ArrayType(LongType())
    )
    sketch = df.select(ref(id_col).alias("id"), ref(text_col).cast("string").alias("text")).mapInArrow(
        _sketch(depth, TREES), schema
    )
    sketch, _, _ = materialise(sketch, "sketch")
    classes = (
        sketch.where("key is not null")
        .groupBy("key")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("nodes").alias("nodes"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    return sketch.select("id", "key"), materialise(classes, "classes")[0]


def join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """One row per input row: id, ``class_id``, ``n_links`` (other rows at least
    0.8 similar) and ``class_size``."""
    rows, classes = _classes(df, id_col, text_col, forest_depth(0.8, recall))
    paths = classes.select("cid", F.explode("nodes").alias("node"))
    stars = paths.groupBy("node").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = components(paths.join(stars, "node").select("cid", "hub"))
    met, n_met, _ = materialise(met.select(F.col("vertex").alias("cid"), F.col("component").alias("comp")), "met")

    wanted = classes.join(met, "cid").select("key", "cid")
    texts = (
        df.select(ref(text_col).cast("string").alias("text"))
        .mapInArrow(_keyed_texts, "key binary, text string")
        .join(wanted, "key")
        .groupBy("cid")
        .agg(F.any_value("text").alias("text"))
    )
    sets, _, _ = materialise(texts.mapInArrow(_sets, "cid long, set binary"), "sets")

    sizes = met.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    bunches = max(1, -(-n_met // block))
    placed = (
        met.join(sizes, "comp")
        .withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cid",
            "comp",
            F.when(F.col("blocks") == 1, F.lit(-1)).otherwise(F.col("comp")).alias("g"),
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("comp"), F.lit(bunches)))
            .otherwise(F.least("own", "other"))
            .alias("lo"),
            F.when(F.col("blocks") == 1, F.lit(0)).otherwise(F.greatest("own", "other")).alias("hi"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    members = placed.join(classes.select("cid", "copies", "nodes"), "cid").join(sets, "cid")
    found = members.groupBy("g", "lo", "hi").applyInArrow(_verify_block, "u long, v long, n long")
    found, _, _ = materialise(found, "links")
    groups = components(found.where("v is not null").select("u", "v"))
    links = found.where("n is not null").groupBy(F.col("u").alias("cid")).agg(F.sum("n").alias("n"))
    labelled = (
        classes.select("cid", "key", "least", "copies")
        .join(groups.withColumnRenamed("vertex", "cid"), "cid", "left")
        .join(links, "cid", "left")
        .withColumn("component", F.coalesce("component", "cid"))
    )
    labelled, _, _ = materialise(labelled, "labelled")
    totals = labelled.groupBy("component").agg(
        F.min("least").alias("class_id"), F.sum("copies").alias("class_size")
    )
    by_key = labelled.join(totals, "component").select(
        "key", "class_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "class_size"
    )
    alone = F.col("key").isNull()
    return rows.join(by_key, "key", "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay: of every class the one with the smallest id."""
    classes = join(df, id_col, text_col)
    gone = classes.where(ref(id_col) != F.col("class_id")).select(ref(id_col)).distinct()
    return df.join(gone, id_col, "left_anti")
