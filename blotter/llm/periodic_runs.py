"""Periodic runs of words: stretches that repeat a shorter stretch three times or more.

A run is a stretch of words with smallest period q and a length of at least
``max(MIN_WORDS, REPEATS * q)`` that cannot be made longer on either side
without losing the period.

Texts are taken in slices of about ``SLICE_BYTES`` within each Arrow batch; a
text is never cut.  The words of a slice become whole numbers through an exact
dictionary, with a separator of its own between two texts, and one run-length
grammar is built over them by recompression.  Candidates lie on a harmonic
grid: a run of period q holds at least one position i, a multiple of the least
run length less q, with i + q in the run as well, so n words have in the order
of n log n candidates.  Those whose two words agree are extended both ways by
the grammar.  Of the periods found for one stretch the smallest is its own
(the others are multiples of it, as the stretch has three periods of each).

Defined results: a null or blank text has no words and no runs; ids may be
null or repeat, every row is answered by itself; an empty table gives no rows.
Other columns are not read.  One text is handled within one task, in memory of
some hundred bytes a word of the text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.columns import ref, text_or_empty
from blotter.llm.kernels import as_bytes, slices
from blotter.llm.recompression import Grammar

MIN_WORDS = 24
REPEATS = 3
SLICE_BYTES = 1 << 20
CANDIDATES = 1 << 20  # grid positions looked at together

SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _grid(sizes: np.ndarray, bases: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, period) of every candidate, in parts of about ``CANDIDATES``."""
    most = sizes // REPEATS
    most[sizes < MIN_WORDS] = 0
    total = np.concatenate([[0], np.cumsum(most)])
    step_of = 1 << 18  # (text, period) pairs numbered at a time
    for first in range(0, int(total[-1]), step_of):
        pair = np.arange(first, min(first + step_of, int(total[-1])))
        text = np.searchsorted(total, pair, side="right") - 1
        period = pair - total[text] + 1
        stride = np.maximum(MIN_WORDS, REPEATS * period) - period
        count = (sizes[text] - period - 1) // stride + 1
        ends = np.cumsum(count)
        begin = 0
        while begin < len(pair):
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + CANDIDATES, side="right")))
            n = count[begin:stop]
            which = np.repeat(np.arange(begin, stop), n)
            nth = np.arange(len(which)) - np.repeat(ends[begin:stop] - n - done, n)
            yield bases[text[which]] + nth * stride[which], period[which]
            begin = stop


def find_runs(ids: np.ndarray, sizes: np.ndarray, bases: np.ndarray) -> np.ndarray:
    """Rows (start, stop, period) of all runs of the texts at ``bases``, by start and period.

    ``ids`` holds the words of all texts; a number found nowhere else follows
    each text.
    """
    grammar, found = None, []
    for at, period in _grid(sizes, bases):
        same = ids[at] == ids[at + period]
        at, period = at[same], period[same]
        if not len(at):
            continue
        if grammar is None:
            grammar = Grammar(ids)
        stop = at + period + grammar.extend(at, at + period)
        start = at - grammar.extend(at, at + period, back=True)
        long = stop - start >= np.maximum(MIN_WORDS, REPEATS * period)
        found.append(np.stack([start[long], stop[long], period[long]], axis=1))
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)  # the smallest period of a stretch
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slice(texts: list[bytes]) -> pa.RecordBatch:
    words = [t.split() for t in texts]  # exactly at space and \t..\r
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    bases = np.concatenate([[0], np.cumsum(sizes + 1)])
    ids = np.empty(int(bases[-1]), dtype=np.int64)
    for w, at in zip(words, bases):
        ids[at : at + len(w)] = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
    ids[bases[1:] - 1] = len(number) + np.arange(len(texts))
    bases = bases[:-1]
    runs = find_runs(ids, sizes, bases)
    text = np.searchsorted(bases, runs[:, 0], side="right") - 1
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    collapsed = []
    for k, w in enumerate(words):
        mine = runs[cut[k] : cut[k + 1]]
        if len(mine):
            edge = np.zeros(len(w) + 1, dtype=np.int64)
            np.add.at(edge, mine[:, 0] + mine[:, 2] - bases[k], 1)
            np.add.at(edge, mine[:, 1] - bases[k], -1)
            w = [w[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        collapsed.append(b" ".join(w))
    rows = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - bases[text]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
        names=["start", "length", "period"],
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["n_words", "runs", "collapsed"],
    )


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in slices(as_bytes(batch.column(1)), SLICE_BYTES):
            out = _slice(texts)
            ids = batch.column(0).slice(first, len(texts))
            yield pa.RecordBatch.from_arrays([ids, *out.columns], names=["id", *out.schema.names])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` is the text's words joined by one space, without those that
    lie in a run after its first period.
    """
    kind = df.select(ref(id_col)).schema[0].dataType.simpleString()
    rows = df.select(ref(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_answer, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared as fractions; the first of equal ones; null without runs."""
    nothing = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(
        runs,
        nothing,
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
        ).otherwise(best),
    )
