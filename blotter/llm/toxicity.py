"""Toxicity scores: subword-bag embeddings averaged into a linear softmax.

A text is the bag of the character n-grams (4, 6 and 8 bytes, word boundaries
included) of its lower-cased words.  Every n-gram has an embedding; a text's
vector is the average over its bag, and a softmax over two classes reads it.
Embeddings and softmax are trained together by gradient descent in numpy, on
every n-gram bucket found in at least two documents of the sample.
A misspelt word shares most of its n-grams with the word, so it is recognised
though it was never seen.

Training reads a bounded sample: of each class at most ``per_class`` labelled
rows, those with the smallest hash of the id (rows with crc32(id) mod 5 = 0
are never learnt from).  The sample and the model (one number per n-gram
bucket once the two linear maps are multiplied out) have fixed sizes; one task
trains, all others score whole texts.

Defined results: a null or empty text has an empty bag and the score of an
average text; several labels of one id count as the largest; null labels and
labels without a document are left out; without labels of both classes the
score is the smoothed share of label 1; repeated rows are scored one by one;
a null id belongs to no label and is not held out; an empty table gives an
empty result; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from blotter.llm import kernels
from blotter.llm.columns import ref
from blotter.llm.suffix_tree import END, normalise

SIZES = (4, 6, 8)
BUCKET_BITS = 18
PER_CLASS = 1500
DIMENSIONS = 8
LEAST_DOCUMENTS = 2  # of the sample an n-gram must occur in
DENSE = 0.03  # share of the sample from which on an n-gram is held as a dense column
STEPS = 100
RATE = 1500.0
AVERAGED = 50  # steps, the last ones: single ones swing around the solution
DECAY = 1e-6
SCALING = 0.25  # power of a feature's spread it is divided by: rare n-grams do not outweigh common ones


def held_out(id_col: str) -> Column:
    """True for the documents that are not learnt from."""
    return F.coalesce(F.crc32(ref(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram, and the document it lies in (unordered)."""
    data, ends = kernels.flatten(texts)
    symbols, begins = normalise(data, ends, 2)
    doc = np.repeat(np.arange(len(texts)), np.diff(begins))
    symbols, starts = symbols[1:-1], begins[0] - 1  # one boundary before the first text
    doc = np.concatenate([np.zeros(starts, dtype=doc.dtype), doc])[: len(symbols)]
    boundary = (symbols == END) | (symbols == 0x20)
    code = kernels.BYTE_CODES[np.where(boundary, 0x20, symbols)]
    spaces = np.concatenate([[0], np.cumsum(boundary)])
    h, out, where = code, [], []
    with np.errstate(over="ignore"):
        for n in range(2, max(SIZES) + 1):
            h = h[: len(symbols) - n + 1] * kernels.BASE + code[n - 1 :]
            if n not in SIZES or not len(h):
                continue
            at = np.flatnonzero(spaces[n - 1 : n - 1 + len(h)] == spaces[1 : 1 + len(h)])  # no boundary inside
            out.append((kernels.mix(h[at] ^ np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
            where.append(doc[at + 1])
    return (np.concatenate(out), np.concatenate(where)) if out else (np.zeros(0, np.int32), np.zeros(0, np.int64))


def fit(texts: list[bytes], labels: np.ndarray, share: float) -> tuple[np.ndarray, float, float]:
    """(weight of every bucket, intercept, logit of an empty bag); ``share`` is label 1's share among all labelled rows."""
    buckets = 1 << BUCKET_BITS
    prior = float(np.log(share / (1 - share)))
    positive = int(labels.sum())
    if not 0 < positive < len(labels):
        return np.zeros(buckets, np.float32), prior, prior
    document_count = np.zeros(buckets, dtype=np.int64)
    for k in range(0, len(texts), 100):
        bucket, doc = bags(texts[k : k + 100])
        pair = np.unique(doc.astype(np.int64) * buckets + bucket)
        document_count += np.bincount(pair % buckets, minlength=buckets)
    chosen = np.flatnonzero(document_count >= LEAST_DOCUMENTS)
    if not len(chosen):
        return np.zeros(buckets, np.float32), prior, prior
    chosen = chosen[np.argsort(-document_count[chosen], kind="stable")]  # the common ones first
    common = int((document_count[chosen] >= max(LEAST_DOCUMENTS, DENSE * len(texts))).sum())
    x = _Features(texts, chosen, common)

    rng = np.random.default_rng(0)
    embed = (rng.standard_normal((len(chosen), DIMENSIONS)) * 0.01).astype(np.float32)
    soft = (rng.standard_normal((DIMENSIONS, 2)) * 0.5).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    target = np.stack([1 - labels, labels], axis=1).astype(np.float32)
    weight = np.where(labels > 0, 0.5 / positive, 0.5 / (len(labels) - positive)).astype(np.float32)[:, None]
    # Every slope of the embeddings is x.T @ (rows of the sample) plus their decay, so they
    # stay own * embed + x.T @ rows; only the products of the sample's rows are needed.
    own, rows, first, products = np.ones(1, np.float32), np.zeros((len(texts), DIMENSIONS), np.float32), x.times(embed), x.products()
    moved = [np.zeros_like(v) for v in (own, rows, soft, bias)]
    drawn, swung, offset = 0.0, 0.0, 0.0  # the classifier, averaged over the last steps
    for step in range(STEPS):
        hidden = own * first + products @ rows
        logit = hidden @ soft + bias
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) * weight
        slopes = (DECAY * own, error @ soft.T + DECAY * rows, hidden.T @ error, error.sum(axis=0))
        for v, m, g, r in zip((own, rows, soft, bias), moved, slopes, (RATE, RATE, 0.1, 0.5)):
            m *= 0.9  # momentum
            m -= 0.1 * r * g
            v += m
        if step >= STEPS - AVERAGED:
            apart = (soft[:, 1] - soft[:, 0]) / AVERAGED
            drawn, swung, offset = drawn + own * apart, swung + rows @ apart, offset + (bias[1] - bias[0]) / AVERAGED
    line = (embed @ drawn + x.back(swung)) / x.scale
    out = np.zeros(buckets, dtype=np.float32)
    out[chosen] = line
    neutral = float(offset + prior)  # where every n-gram has its average share
    return out, neutral - float(x.mean @ line), neutral


def _sums(places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(places, values, n).astype(np.float64)  # integers where there are no places


class _Features:
    """Shares of the chosen n-grams in each text, centred and scaled: the first ``common`` dense, the others as cells."""

    def __init__(self, texts: list[bytes], chosen: np.ndarray, common: int):
        self.n, self.width = len(texts), len(chosen)
        column = np.full(1 << BUCKET_BITS, -1)
        column[chosen] = np.arange(self.width)
        self.dense = np.zeros((self.n, common), dtype=np.float32)
        cells, values = [], []
        for k in range(0, self.n, 100):
            bucket, doc = bags(texts[k : k + 100])
            size = np.maximum(np.bincount(doc, minlength=100), 1)
            kept = column[bucket] >= 0
            cell, times = np.unique(column[bucket[kept]] * self.n + doc[kept] + k, return_counts=True)
            share = times / size[cell % self.n - k]
            dense = cell < common * self.n
            self.dense[cell[dense] % self.n, cell[dense] // self.n] = share[dense]
            cells.append(cell[~dense])
            values.append(share[~dense])
        cell, value = np.concatenate(cells), np.concatenate(values)
        order = np.argsort(cell)  # by column
        cell, self.value = cell[order], value[order]
        self.col, self.row = cell // self.n, cell % self.n
        total = _sums(self.col, self.value, self.width)
        square = _sums(self.col, self.value**2, self.width)
        total[:common] = self.dense.sum(axis=0, dtype=np.float64)
        square[:common] = np.einsum("ij,ij->j", self.dense, self.dense, dtype=np.float64)
        self.mean = total / self.n
        spread = np.sqrt(np.maximum(square / self.n - self.mean**2, 0)) + 1e-9
        scale = spread**SCALING
        self.scale = scale * np.sqrt(((spread / scale) ** 2).sum())  # all features together have variance 1, however held
        self.value = self.value / self.scale[self.col]
        self.dense /= self.scale[:common]
        self.middle = self.mean / self.scale
        self.common = common

    def times(self, y: np.ndarray) -> np.ndarray:
        """x @ y."""
        out = self.dense @ y[: self.common] - self.middle @ y
        for k in range(y.shape[1]):
            out[:, k] += _sums(self.row, self.value * y[self.col, k], self.n)
        return out.astype(np.float32)

    def back(self, a: np.ndarray) -> np.ndarray:
        """x.T @ a."""
        out = _sums(self.col, self.value * a[self.row], self.width)
        out[: self.common] = self.dense.T @ a
        return out - self.middle * a.sum()

    def products(self) -> np.ndarray:
        """x @ x.T."""
        out = (self.dense @ self.dense.T).astype(np.float64).ravel()
        head = np.flatnonzero(np.diff(self.col, prepend=-1))
        sizes = np.diff(np.append(head, len(self.col)))
        for size in np.unique(sizes):  # columns found in so many texts
            begins = head[sizes == size]
            for k in range(0, len(begins), step := max(1, (1 << 22) // int(size) ** 2)):
                at = begins[k : k + step, None] + np.arange(size)
                cell = self.row[at][:, :, None] * self.n + self.row[at][:, None, :]
                both = self.value[at][:, :, None] * self.value[at][:, None, :]
                out += np.bincount(cell.ravel(), both.ravel(), len(out))
        out = out.reshape(self.n, self.n)
        middle = out.mean(axis=0)
        return (out - middle - middle[:, None] + middle.mean()).astype(np.float32)


def sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int) -> DataFrame:
    """(text, label, share): the training rows, at most ``per_class`` of each class."""
    known = (
        labels.where(ref(label_col).isin(0, 1) & ref(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(ref(id_col).alias("label_id"))
        .agg(F.max(ref(label_col)).cast("int").alias("label"))
    )
    known = known.join(df.select(ref(id_col).alias("label_id")), "label_id", "left_semi")
    shares = known.agg(((F.sum("label") + 1) / (F.count(F.lit(1)) + 2)).alias("share"))
    share = shares.first()["share"]
    chosen = [
        known.where(F.col("label") == c).orderBy(F.xxhash64("label_id"), "label_id").limit(per_class) for c in (0, 1)
    ]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * per_class rows of two numbers
    rows = df.select(ref(id_col).alias("label_id"), ref(text_col).cast("string").alias("text"))
    # of rows that share an id one is learnt from, so the bound holds whatever the ids
    place = Window.partitionBy("label_id").orderBy(F.xxhash64("text"), "text")
    one = rows.join(picked, "label_id").withColumn("place", F.row_number().over(place)).where("place = 1")
    return one.select("text", "label", F.lit(0.5 if share is None else share).alias("share"))


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels, share = [], [], 0.5
    for batch in batches:
        texts += kernels.as_bytes(batch.column(0))
        labels += batch.column(1).to_pylist()
        share = batch.column(2)[0].as_py() if batch.num_rows else share
    weights, intercept, neutral = fit(texts, np.array(labels, dtype=np.int64), share)
    yield pa.RecordBatch.from_arrays(
        [pa.array([weights.tobytes()], pa.binary()), pa.array([intercept]), pa.array([neutral])],
        names=["weights", "intercept", "neutral"],
    )


def train(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = PER_CLASS,
) -> tuple[np.ndarray, float, float]:
    """The model, fitted in one task on the bounded sample."""
    rows = sample(df, labels, id_col, text_col, label_col, per_class)
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("text"), "text")
    row = rows.mapInArrow(_fit_rows, "weights binary, intercept double, neutral double").first()
    if row is None:  # no labelled document at all
        return np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 0.0
    return np.frombuffer(row["weights"], dtype=np.float32), row["intercept"], row["neutral"]


def _score(shared, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept, neutral = shared.value
        for batch in batches:
            texts, out, first, held = kernels.as_bytes(batch.column(1)), [], 0, 0
            for k, text in enumerate(texts):
                held += len(text)
                if held >= 1 << 20 or k + 1 == len(texts):
                    part = texts[first : k + 1]
                    bucket, doc = bags(part)
                    total = np.bincount(doc, weights[bucket], len(part))
                    size = np.bincount(doc, minlength=len(part))
                    logit = np.where(size > 0, total / np.maximum(size, 1) + intercept, neutral)
                    out.append(1 / (1 + np.exp(-np.clip(logit, -700, 700))))
                    first, held = k + 1, 0
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=[id_col, "score"])

    return run


def score(
    df: DataFrame, model: tuple[np.ndarray, float, float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, ``held_out``, ``score`` and ``predicted`` (score at least 0.5)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_type = df.schema[id_col].dataType
    to_arrow_type(id_type)  # an id of a type without Arrow form fails here, not in a task
    schema = StructType([StructField(id_col, id_type), StructField("score", DoubleType())])
    scored = df.select(ref(id_col), ref(text_col).cast("string")).mapInArrow(_score(shared, id_col), schema)
    return scored.select(
        ref(id_col), held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
