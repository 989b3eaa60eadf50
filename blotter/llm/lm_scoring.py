"""Language-model scores: a probabilistic suffix tree, and a word-count baseline.

Both are learnt from all training documents (``crc32(id as text) mod 7`` is
not 2) and score every document.

* Counts.  One pass over the texts counts, in every task, words (by a 64-bit
  hash) and byte strings of ``DEPTH`` + 1 symbols; the pre-aggregated counts
  are dealt out and summed.  They grow with the corpus.
* Suffix tree.  Every context of up to ``DEPTH`` symbols that occurs at least
  ``LEAST`` times goes through divergence tests, at any size of the corpus
  (:func:`blotter.llm.suffix_tree.retain`).  Contexts are dealt by their latest
  three symbols, so a context lies with its parent.  The tree grows with the
  corpus too.
* Scoring.  One more pass computes the score of each text from the longest
  retained context at every symbol.  A tree of at most ``most_entries`` entries
  is broadcast; of a larger one only the counts of three symbols are (at most
  256 ** 3), and the texts' byte strings leave the task as postings to the
  shards of the tree, as the words do.  For the baseline, words that make up at
  least 1 / FREQUENT of all tokens (so at most FREQUENT of them) are broadcast
  with their counts; the others leave the task as postings (word, document),
  dealt by word to where the counts lie, and come back as sums per document.
  Texts are never shuffled.

A text is scored as its words, lower-cased (A-Z), with one space between and
an end symbol.

Defined results: a null or empty text is the end symbol alone; repeated rows
are scored one by one; a null id counts as the empty text for the split (so
it is a training row); with no training document every symbol has the same
probability; an empty table gives an empty result; further columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from blotter.llm import kernels, suffix_tree
from blotter.llm.columns import ref
from blotter.plans.guards import materialise

DEPTH = 7  # bytes: about two short words; as many as 64 bits hold with the next symbol
LEAST = 2  # occurrences of a context, whatever the size of the corpus
GAIN = 0.01  # nats
STRENGTH = 20.0
FREQUENT = 1 << 16
MOST_ENTRIES = 1 << 24  # of a broadcast tree, about 20 bytes each in every worker
LEAST_PARTS = 192  # the counts are summed in, one at a time
HELD_KEYS = 2 << 20  # distinct byte strings a counting task holds
PENDING_KEYS = HELD_KEYS // 4  # and new ones before they are merged
SHARD_KEYS = 1 << 18
BATCH_BYTES = 1 << 19
BLOCK_BYTES = 8 << 20


def held_out(id_col: str) -> Column:
    """True for the documents that are not learnt from."""
    return F.crc32(F.coalesce(ref(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


class _Counter:
    """Counts of integers, merged when enough new ones are pending.

    New keys are inserted among the held ones, which are not sorted again: a
    merge needs little more than the held keys and their new copy.
    """

    def __init__(self) -> None:
        self.keys, self.counts, self.pending = np.zeros(0, np.int64), np.zeros(0, np.uint32), []

    def add(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        self.pending.append((keys, counts.astype(np.uint32)))
        if sum(len(k) for k, _ in self.pending) > PENDING_KEYS:
            self.merge()

    def merge(self) -> None:
        if not self.pending:
            return
        keys, counts = (np.concatenate(x) for x in zip(*self.pending))
        self.pending = []
        keys, counts = suffix_tree.summed(keys, counts)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        self.counts[at[known]] += counts[known]
        at, keys, counts = at[~known], keys[~known], counts[~known]
        self.keys, self.counts = np.insert(self.keys, at, keys), np.insert(self.counts, at, counts)


_COUNTS = StructType(
    [StructField("bucket", IntegerType()), StructField("kind", IntegerType())]
    + [StructField(c, BinaryType()) for c in ("keys", "counts")]
)


def _dealt(kind: int, held: _Counter, buckets: int) -> Iterator[pa.RecordBatch]:
    held.merge()
    bucket = np.empty(len(held.keys), np.uint16 if buckets <= 1 << 16 else np.int64)
    for k in range(0, len(bucket), SHARD_KEYS):  # the hash takes several times its keys
        keys = held.keys[k : k + SHARD_KEYS]
        bucket[k : k + SHARD_KEYS] = suffix_tree.shard(keys.view(np.uint64), buckets) if kind else keys % buckets
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    keys, counts = held.keys[order], held.counts[order]
    held.keys, held.counts = np.zeros(0, np.int64), np.zeros(0, np.uint32)
    del bucket, order
    some = np.flatnonzero(np.diff(cut))
    for k in range(0, len(some), 64):
        part = some[k : k + 64]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.astype(np.int32)),
                pa.array(np.full(len(part), kind, np.int32)),
                pa.array([keys[cut[x] : cut[x + 1]].tobytes() for x in part], pa.binary()),
                pa.array([counts[cut[x] : cut[x + 1]].tobytes() for x in part], pa.binary()),
            ],
            names=_COUNTS.names,
        )


def _sliced(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of about ``BATCH_BYTES``, with the number of the first; a batch is never held as Python objects whole."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(column):
        before = int(ends[first - 1]) if first else 0
        stop = min(int(np.searchsorted(ends, before + BATCH_BYTES)) + 1, len(column))
        yield first, kernels.as_bytes(column.slice(first, stop - first))
        first = stop


def _count(buckets: int):
    """Packed counts per bucket: kind 0 are words, kind 1 byte strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, strings = _Counter(), _Counter()
        for batch in batches:
            for _, texts in _sliced(batch.column(0)):
                data, ends = kernels.flatten(texts)
                starts, stops, _ = kernels.word_spans(data, ends)
                words.add(kernels.word_hashes(kernels.lower_ascii(data), starts, stops).view(np.int64))
                symbols, begins = suffix_tree.spelt(texts, DEPTH)
                at = suffix_tree.scored(begins, DEPTH)
                strings.add(suffix_tree.ordered_grams(symbols, at, DEPTH).view(np.int64))
                if len(strings.keys) > HELD_KEYS:
                    yield from _dealt(1, strings, buckets)
                    strings = _Counter()
                if len(words.keys) > HELD_KEYS:
                    yield from _dealt(0, words, buckets)
                    words = _Counter()
        yield from _dealt(0, words, buckets)
        yield from _dealt(1, strings, buckets)

    return run


# kind -1: a word, its count and bucket; kind d >= 0: a bucket's entries of level d.
_TRAINED = StructType(
    [StructField("kind", IntegerType()), StructField("bucket", IntegerType())]
    + [StructField(c, LongType()) for c in ("key", "n")]
    + [StructField(c, BinaryType()) for c in ("keys", "counts")]
)


def _build(buckets: int):
    return lambda table: _built(table, buckets)


def _built(table: pa.Table, buckets: int) -> pa.Table:
    """A part's words, and its shard of the tree; parts are finer than the ``buckets`` of the postings."""
    kind = table.column("kind").to_numpy()
    bucket = table.column("bucket")[0].as_py() % buckets
    parts = [table.filter(pa.array(kind == k)) for k in (0, 1)]
    merged = []
    for part, dtype in zip(parts, (np.int64, np.uint64)):
        keys, counts = (part.column(c).to_pylist() for c in ("keys", "counts"))
        merged.append(
            suffix_tree.summed(
                np.frombuffer(b"".join(keys), dtype), np.frombuffer(b"".join(counts), np.uint32).astype(np.int64)
            )
        )
    (words, times), (grams, counts) = merged
    levels = suffix_tree.retain(grams, counts, DEPTH, LEAST, GAIN, STRENGTH) if len(grams) else {}
    none = [None] * len(words)
    arrays = [
        [-1] * len(words) + list(levels),
        [bucket] * (len(words) + len(levels)),
        words.tolist() + [None] * len(levels),
        times.tolist() + [None] * len(levels),
        none + [k.tobytes() for k, _ in levels.values()],
        none + [n.astype(np.int64).tobytes() for _, n in levels.values()],
    ]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table({f: pa.array(v, k) for f, v, k in zip(_TRAINED.names, arrays, kinds)})


def _entries(held: list[pa.Table]) -> tuple[np.ndarray, np.ndarray]:
    """Entries with counts of one level from the rows of one or more buckets; takes the table out of the list it is in."""
    rows = held.pop()
    keys, counts = (
        np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in rows.column(c))])
        for c, kind in (("keys", np.uint64), ("counts", np.int64))
    )
    del rows
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    counts = counts[order]
    del order
    if not len(keys) or (keys[1:] != keys[:-1]).all():  # all but the lowest level
        return keys, counts
    return suffix_tree.summed(keys, counts)


def _posted(keys: list, doc: list, buckets: int, shard) -> tuple:
    """Postings in the order of bucket and key: distinct keys, where each bucket's
    postings and distinct keys begin, how often each key occurs, and the documents."""
    keys, doc = (np.concatenate(x) if len(x) else np.zeros(0, np.int64) for x in (keys, doc))
    order = np.argsort(keys, kind="stable")
    keys, doc = keys[order], doc[order].astype(np.uint32)
    bucket = shard(keys, buckets) if shard and len(keys) else keys.astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    keys, doc, bucket = keys[order], doc[order], bucket[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(head, len(keys))).astype(np.uint32)
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    return keys[head], cut, np.searchsorted(bucket[head], np.arange(buckets + 1)), times, doc


def _score(shared, id_type: pa.DataType, buckets: int):
    """Blocks of documents: one row with what is known here, and one row per bucket of rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, frequent, counts = shared.value
        memory = None if tree is None else suffix_tree.Memory(tree)
        log_counts = np.log10(counts + 1.0)
        task = TaskContext.get().partitionId() << 24
        number = 0
        state: dict = {}

        def fresh() -> dict:
            lists = ("ids", "tokens", "known", "base", "score", "hash", "doc", "gram", "gram_doc")
            return {c: [] for c in lists} | {"bytes": 0, "n": 0}

        def rows(s: dict, block: int) -> Iterator[pa.RecordBatch]:
            h, cut, word_cut, times, doc = _posted(s["hash"], s["doc"], buckets, None)
            g, gram_cut, g_cut, gram_times, gram_doc = _posted(s["gram"], s["gram_doc"], buckets, suffix_tree.shard)
            own = block % buckets
            for b in range(buckets):
                w, d = slice(word_cut[b], word_cut[b + 1]), slice(cut[b], cut[b + 1])
                gw, gd = slice(g_cut[b], g_cut[b + 1]), slice(gram_cut[b], gram_cut[b + 1])
                if b != own and cut[b] == cut[b + 1] and gram_cut[b] == gram_cut[b + 1]:
                    continue
                here = [s[c] if b == own else None for c in ("ids", "tokens", "known", "base", "score")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b], pa.int32()),
                        pa.array([block], pa.int64()),
                        pa.array([s["n"]], pa.int64()),
                        pa.array([here[0]], pa.list_(id_type)),
                        pa.array([here[1]], pa.list_(pa.int64())),
                        pa.array([here[2]], pa.list_(pa.int64())),
                        pa.array([here[3]], pa.list_(pa.float64())),
                        pa.array([here[4]], pa.list_(pa.float64())),
                        pa.array([h[w].tobytes()], pa.binary()),
                        pa.array([times[w].tobytes()], pa.binary()),
                        pa.array([doc[d].tobytes()], pa.binary()),
                        pa.array([g[gw].tobytes()], pa.binary()),
                        pa.array([gram_times[gw].tobytes()], pa.binary()),
                        pa.array([gram_doc[gd].tobytes()], pa.binary()),
                    ],
                    names=_BLOCK_NAMES,
                )

        state = fresh()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in _sliced(batch.column(1)):
                data, ends = kernels.flatten(texts)
                symbols, begins = suffix_tree.spelt(texts, DEPTH)
                grams = suffix_tree.ordered_grams(symbols, suffix_tree.scored(begins, DEPTH), DEPTH)
                text = np.repeat(np.arange(len(texts)), np.diff(begins) - DEPTH + 1)
                if tree is None:
                    state["score"] += [0.0] * len(texts)
                    state["gram"].append(grams)
                    state["gram_doc"].append((text + state["n"]).astype(np.uint32))
                else:
                    state["score"] += np.bincount(text, memory.log10(grams), len(texts)).tolist()
                starts, stops, doc = kernels.word_spans(data, ends)
                h = kernels.word_hashes(kernels.lower_ascii(data), starts, stops).view(np.int64)
                at = np.searchsorted(frequent, h)
                at[at == len(frequent)] = 0
                hit = frequent[at] == h if len(frequent) else np.zeros(len(h), dtype=bool)
                n = len(texts)
                state["tokens"] += (np.bincount(doc, minlength=n) + 1).tolist()
                state["known"] += np.bincount(doc[hit], minlength=n).tolist()
                state["base"] += np.bincount(doc[hit], log_counts[at[hit]], n).tolist()
                state["hash"].append(h[~hit])
                state["doc"].append((doc[~hit] + state["n"]).astype(np.uint32))
                state["ids"] += ids[first : first + n]
                state["n"] += n
                state["bytes"] += len(data)
                if state["bytes"] >= (BLOCK_BYTES // 3 if tree is None else BLOCK_BYTES):
                    yield from rows(state, task + number)
                    state, number = fresh(), number + 1
        if state["n"]:
            yield from rows(state, task + number)

    return run


_BLOCK_NAMES = ["bucket", "block", "n", "ids", "tokens", "known", "base", "score"]
_BLOCK_NAMES += ["hashes", "times", "docs", "grams", "gram_times", "gram_docs"]


def _block_schema(id_type) -> StructType:
    kinds = [IntegerType(), LongType(), LongType(), ArrayType(id_type), ArrayType(LongType()), ArrayType(LongType())]
    kinds += [ArrayType(DoubleType()), ArrayType(DoubleType()), *[BinaryType()] * 6]
    return StructType([StructField(n, k) for n, k in zip(_BLOCK_NAMES, kinds)])


def _look_up(low):
    """Adds a bucket's rare words to the sums of each block's documents.

    ``low``, the broadcast level LOW, is given where the tree is not broadcast:
    then the byte strings are looked up, too.
    """

    def run(posts: pa.Table, trained: pa.Table) -> pa.Table:
        word = trained.column("kind").to_numpy() < 0 if trained.num_rows else np.zeros(0, dtype=bool)
        out = _with_words(posts, trained.filter(pa.array(word, pa.bool_())))
        if low is None:
            return out
        lowest, kind = min(suffix_tree.LOW, DEPTH), trained.column("kind").to_numpy()
        part = suffix_tree.Tree(
            lambda d: low.value if d == lowest else _entries([trained.filter(pa.array(kind == d, pa.bool_()))]), DEPTH
        )
        score = []
        for size, grams, times, docs in zip(
            *(posts.column(c).to_pylist() for c in ("n", "grams", "gram_times", "gram_docs"))
        ):
            each = np.repeat(part.log10(np.frombuffer(grams, np.uint64)), np.frombuffer(times, np.uint32))
            score.append(np.bincount(np.frombuffer(docs, np.uint32), each, size))
        return out.set_column(out.schema.get_field_index("score"), "score", pa.array(score, pa.list_(pa.float64())))

    return run


def _with_words(posts: pa.Table, counts: pa.Table) -> pa.Table:
    key = counts.column("key").to_numpy()
    order = np.argsort(key, kind="stable")
    key, n = key[order], counts.column("n").to_numpy()[order]
    base, known = [], []
    for size, hashes, times, docs in zip(
        *(posts.column(c).to_pylist() for c in ("n", "hashes", "times", "docs"))
    ):
        h = np.frombuffer(hashes, np.int64)
        at = np.searchsorted(key, h)
        at[at == len(key)] = 0
        c = np.where(key[at] == h, n[at], 0) if len(key) else np.zeros(len(h), np.int64)
        c = np.repeat(c, np.frombuffer(times, np.uint32))
        doc = np.frombuffer(docs, np.uint32)
        base.append(np.bincount(doc, np.log10(c + 1.0), size))
        known.append(np.bincount(doc[c > 0], minlength=size))
    out = posts.select(["block", "n", "ids", "tokens", "score"])
    mine = [posts.column(c).to_pylist() for c in ("known", "base")]
    known = [k.tolist() if m is None else (k + np.array(m)).tolist() for k, m in zip(known, mine[0])]
    base = [b.tolist() if m is None else (b + np.array(m)).tolist() for b, m in zip(base, mine[1])]
    out = out.append_column("known", pa.array(known, pa.list_(pa.int64())))
    return out.append_column("base", pa.array(base, pa.list_(pa.float64())))


def _gather(table: pa.Table) -> pa.Table:
    """One row per document of a block, summed over the buckets."""
    known = sum(np.array(k) for k in table.column("known").to_pylist())
    base = sum(np.array(b) for b in table.column("base").to_pylist())
    score = sum(np.array(x) for x in table.column("score").to_pylist() if x is not None)
    full = table.filter(pc.is_valid(table.column("ids"))).slice(0, 1)
    flat = {c: pc.list_flatten(full.column(c)) for c in ("ids", "tokens")}
    return pa.table({"id": flat["ids"], "n_tokens": flat["tokens"], "known": known, "base": base, "score": score})


def train(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Word counts (kind -1) and the packed entries of the tree, from all rows of ``df``."""
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = buckets * max(4, -(-LEAST_PARTS // buckets))
    counted = df.select(ref(text_col).cast("string")).mapInArrow(_count(parts), _COUNTS)
    return materialise(counted.groupBy("bucket").applyInArrow(_build(buckets), _TRAINED), "trained")[0]


def score(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_entries: int = MOST_ENTRIES
) -> DataFrame:
    """One row per input row: id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (both log10)."""
    spark = df.sparkSession
    learnt = df.where(~held_out(id_col))
    trained = train(learnt, text_col)
    counts, shards = trained.where("kind < 0"), trained.where("kind >= 0")
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    words, kinds = int(sums.n or 0), int(sums.v)
    texts = learnt.count()  # each has one end token
    total, distinct = words + texts, kinds + (1 if texts else 0)
    common = counts.where(F.col("n") > words // FREQUENT).orderBy("key").select("key", "n").toArrow()  # at most FREQUENT rows
    entries = shards.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    whole = entries <= most_entries
    lowest = min(suffix_tree.LOW, DEPTH)

    def level(d: int) -> tuple[np.ndarray, np.ndarray]:
        found = _entries([shards.where(F.col("kind") == d).select("keys", "counts").toArrow()])
        pa.default_memory_pool().release_unused()  # the driver holds one level's rows at a time
        return found

    shared = spark.sparkContext.broadcast(
        (
            suffix_tree.Tree(level, DEPTH) if whole else None,
            common.column("key").to_numpy(),
            common.column("n").to_numpy(),
        )
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = df.schema[id_col].dataType
    schema = _block_schema(id_type)
    blocks = df.select(ref(id_col), ref(text_col).cast("string")).mapInArrow(
        _score(shared, to_arrow_type(id_type), buckets), schema
    )
    rare = trained.where((F.col("kind") < 0) & (F.col("n") <= words // FREQUENT))
    if not whole:
        rare = rare.unionByName(shards.where(F.col("kind") > lowest))
    answered = (
        blocks.groupBy("bucket")
        .cogroup(rare.groupBy("bucket"))
        .applyInArrow(
            _look_up(None if whole else spark.sparkContext.broadcast(level(lowest))),
            StructType([schema[c] for c in ("block", "n", "ids", "tokens", "score", "known", "base")]),
        )
    )
    fields = [StructField("id", id_type), StructField("n_tokens", LongType()), StructField("known", LongType())]
    fields += [StructField("base", DoubleType()), StructField("score", DoubleType())]
    rows = answered.groupBy("block").applyInArrow(_gather, StructType(fields))
    end_known, end_log = (1, float(np.log10(texts + 1.0))) if texts else (0, 0.0)
    each = float(np.log10(total + distinct + 1.0))
    return rows.select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.lit(end_known)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end_log) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        "score",
    )
