"""Packing documents into token sequences, online, by the sum of squares.

Every task packs the documents of its own partition, so nothing is shuffled
and the work is as parallel as the scan.  A task holds a level array: the
number of partially filled windows at each fill level.  Whole windows are cut
off a long document first; the rest goes to the level (an open window, or a
new one) that makes the sum over levels of the squared counts smallest after
placing.  When the partition ends, the emptiest open windows are cut up to
fill the fullest, and the one window left is cut into sequences whose lengths
are powers of two, which need no padding.

Token ids are looked up word by word: the tokenizer drops white space and
never joins across it, so a text's ids are those of its words in a row.
Words are cached (``CACHE_WORDS`` at most, those in use stay), only unseen ones
are tokenised.

Defined results: a null or empty text is the end id alone; repeated rows and
repeated ids are packed as separate documents; a null id is kept; an empty
table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from blotter.llm.columns import ref
from blotter.llm.kernels import as_bytes

CACHE_WORDS = 250_000
BYTES_OUT = 8 << 20
_STOPS = frozenset((b",", b"."))
_LETTERS = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+").fullmatch  # lower-case, without combining marks

COLUMNS = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit bytes, through a word cache.

    The cache has two halves: words are looked up in the young one, moved
    there from the old one or added to it; a full young half becomes the old
    one.  So words in use stay and at most ``cache_words`` and one batch are held.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._bar = int(self._ids_of("|")[0])
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[k for piece, k in vocabulary.items() if piece.endswith("</w>")]] = True

    def encode(self, texts: list[bytes], cache_words: int = CACHE_WORDS) -> list[bytes]:
        split = [t.lower().split() for t in texts]  # the tokenizer is lower case; six ASCII white-space bytes
        if 2 * len(self._young) > cache_words:
            self._old, self._young = self._young, {}
        out = []
        for words in split:
            found = list(map(self._young.get, words))
            missing = [k for k, ids in enumerate(found) if ids is None]
            out.append((words, found, missing))
        self._learn({words[k] for words, _, missing in out for k in missing})
        ids = self._young
        for words, found, missing in out:
            for k in missing:
                found[k] = ids[words[k]]
        return [b"".join(found) for _, found, _ in out]

    def _learn(self, new: set[bytes]) -> None:
        young, old = self._young, self._old
        fresh, ended = set(), []
        for w in new:
            # a last comma or full stop after a letter or digit is a word of its own to the tokenizer
            if w[-1:] in _STOPS and len(w) > 1 and w[-2] < 128 and w[-2:-1].isalnum():
                ended.append(w)
                fresh.add(w[:-1])
            else:
                fresh.add(w)
        fresh.update(_STOPS)
        unseen = []
        for w in fresh:
            if w not in young:
                ids = old.get(w)
                if ids is None:
                    unseen.append(w)
                else:
                    young[w] = ids
        self._add(unseen)
        for w in ended:
            young[w] = young[w[:-1]] + young[w[-1:]]

    def _ids_of(self, text: str) -> np.ndarray:
        found = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, dtype="<u4")

    def _add(self, words: list[bytes]) -> None:
        """Tokenises words many at a time.

        A word of letters is one piece to the tokenizer and its last id ends a
        piece; other words have a bar between, those with a bar go one by one.
        """
        letters, others, barred = [], [], []
        for w in words:
            (letters if _LETTERS(w.decode()) else barred if b"|" in w else others).append(w)
        for part, ids in self._joined(letters, b" "):
            self._keep(part, ids, 0, np.flatnonzero(self._ends[ids]) + 1)
        for part, ids in self._joined(others, b" | "):
            self._keep(part, ids, 1, np.flatnonzero(ids == self._bar))
        for w in barred:
            self._young[w] = self._ids_of(w.decode()).tobytes()

    def _joined(self, words: list[bytes], mark: bytes) -> Iterator[tuple[list[bytes], np.ndarray]]:
        for k in range(0, len(words), 2048):
            part = words[k : k + 2048]
            yield part, self._ids_of((mark.join(part) + mark).decode())

    def _keep(self, words: list[bytes], ids: np.ndarray, skip: int, stops: np.ndarray) -> None:
        starts = np.concatenate([[0], stops[:-1] + skip])
        raw, young = ids.tobytes(), self._young
        for w, a, b in zip(words, (4 * starts).tolist(), (4 * stops).tolist(), strict=True):
            young[w] = raw[a:b]


_encoders: dict[int, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    key = zlib.crc32(definition.encode())
    if key not in _encoders:
        _encoders[key] = WordEncoder(definition)
    return _encoders[key]


class SumOfSquares:
    """Open windows by fill level; a window is a list of pieces.

    A piece is (document, start, ids as bytes).  ``add`` gives the windows
    that became full, ``close`` packs what is still open.
    """

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, dtype=np.int64)  # index: fill level
        self.open: list[list[list[tuple]]] = [[] for _ in range(size + 1)]

    def level_for(self, n: int) -> int:
        """The fill level to put ``n`` tokens on; 0 opens a window."""
        top = self.size - n
        c = self.counts
        cost = 1 + 2 * c[n : self.size + 1] + (1 - 2 * c[: top + 1])
        cost[top] -= 1 + 2 * c[self.size]  # a full window counts no more
        cost[0] -= 1  # a new window leaves no level
        cost[1:][c[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(cost[::-1]))  # of equal costs, the fullest

    def add(self, doc: int, start: int, ids: bytes) -> list[list[tuple]]:
        full = []
        n, step = len(ids) // 4 % self.size, self.size * 4
        whole = len(ids) - 4 * n
        for a in range(0, whole, step):
            full.append([(doc, start + a // 4, ids[a : a + step])])
        if n:
            start, ids = start + whole // 4, ids[whole:]
            level = self.level_for(n)
            if level:
                window = self.open[level].pop()
                self.counts[level] -= 1
            else:
                window = []
            window.append((doc, start, ids))
            if level + n == self.size:
                full.append(window)
            else:
                self.open[level + n].append(window)
                self.counts[level + n] += 1
        return full

    def close(self) -> list[list[tuple]]:
        """Sequences of all open windows: full ones, then powers of two."""
        windows = [w for level in reversed(self.open) for w in level]  # fullest first
        fills = [k for k in range(self.size, -1, -1) for _ in self.open[k]]
        i, j = 0, len(windows) - 1
        while i < j:
            gap = self.size - fills[i]
            if not gap:
                i += 1
                continue
            doc, start, ids = windows[j].pop()
            take = min(gap, len(ids) // 4)
            windows[i].append((doc, start, ids[: 4 * take]))
            if 4 * take < len(ids):
                windows[j].append((doc, start + take, ids[4 * take :]))
            fills[i] += take
            fills[j] -= take
            if not fills[j]:
                j -= 1
        windows = windows[: j + 1]
        if windows and fills[j] < self.size:
            windows[j:] = self._powers(windows[j], fills[j])
        self.open = [[] for _ in range(self.size + 1)]
        self.counts[:] = 0
        return windows

    @staticmethod
    def _powers(window: list[tuple], fill: int) -> list[list[tuple]]:
        """The window cut into sequences of power-of-two lengths, longest first."""
        out, pieces = [], window[::-1]
        for bit in reversed(range(fill.bit_length())):
            room = fill & (1 << bit)
            part: list[tuple] = []
            while room:
                doc, start, ids = pieces.pop()
                take = min(room, len(ids) // 4)
                part.append((doc, start, ids[: 4 * take]))
                if 4 * take < len(ids):
                    pieces.append((doc, start + take, ids[4 * take :]))
                room -= take
            if part:
                out.append(part)
        return out


def _pack_partition(
    definition: str, end_id: int, size: int, id_type: pa.DataType, id_col: str, cache_words: int
):
    names = [id_col, *COLUMNS]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        kinds = [pa.binary() if c == "ids" else pa.int64() for c in COLUMNS]
        arrays = [pa.array(c, k) for c, k in zip(cols, [id_type, *kinds])]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition)
        end = np.array([end_id], dtype="<u4").tobytes()
        first = TaskContext.get().partitionId() << 32  # sequence ids of this task start here
        packer, made, rows, held = SumOfSquares(size), 0, [], 0

        def emit(windows: list[list[tuple]]) -> None:
            nonlocal made, held
            for window in windows:
                offset = 0
                for (doc, total), start, ids in window:
                    n = len(ids) // 4
                    rows.append((doc, start, n, ids, total, first + made, offset))
                    offset += n
                    held += len(ids) + 64
                made += 1

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            texts = as_bytes(batch.column(1))
            for k in range(0, len(texts), 256):
                for doc, ids in zip(ids_of[k : k + 256], encoder.encode(texts[k : k + 256], cache_words)):
                    ids += end
                    emit(packer.add((doc, len(ids) // 4), 0, ids))
                    if held >= BYTES_OUT:
                        yield table(rows)
                        rows.clear()
                        held = 0
        emit(packer.close())
        for a in range(0, len(rows), BYTES_OUT // (4 * size) + 1):
            yield table(rows[a : a + BYTES_OUT // (4 * size) + 1])

    return run


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    size: int = 4096,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece: id, ``start`` and ``length`` in the document's ids,
    the piece's ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` therein.

    The tokenizer's definition is read once on the driver and sent along
    (its size is that of one vocabulary file).  ``sequence_id`` is the task's
    number times 2**32 plus a running number, the same when a task runs again.
    ``cache_words`` trades a task's memory against time; the rows are the same.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    id_type = df.schema[id_col].dataType
    schema = StructType([StructField(id_col, id_type), *(StructField(c, BinaryType() if c == "ids" else LongType()) for c in COLUMNS)])
    return df.select(ref(id_col), ref(text_col).cast("string")).mapInArrow(
        _pack_partition(definition, end_id, size, to_arrow_type(id_type), id_col, cache_words), schema
    )
