"""Removal of long byte strings that occur earlier, by suffix arrays.

A byte goes when a string of ``LENGTH`` (100) bytes that covers it also starts
earlier: in a document with a smaller id, or earlier in the same one.

How the work is dealt out.  The smallest hash among the 32-byte strings inside
a 100-byte string is its anchor; equal strings have equal anchors.
Consecutive strings with one anchor form a stretch, so an anchor's stretches
hold every occurrence of the strings they share.

1. Anchors of all documents are dealt by value and sorted; only values that
   occur twice can belong to a repeated string (streamed, nothing is held).
2. Documents meet their repeated anchors again and give the stretches.  An
   anchor with very many occurrences is cut into single strings, each dealt
   by its own hash, so no anchor's share outgrows a task.  A task holds the
   texts and the places of at most ``HELD_BYTES`` and ``HELD_ROWS`` (one text
   piece more at most); of identical stretches among them it passes on the
   earliest; the others are removed whole.
3. Stretches are dealt by anchor into parts of about ``PART`` bytes.  A part's
   distinct stretches are cut into shards of at most ``SHARD`` bytes, each
   with a suffix array (Larsson-Sadakane refinement) and common prefixes
   (Kasai).  Neighbours that share 100 bytes are one repeated string.  Where
   an anchor's stretches lie in several shards, the later shard's strings are
   looked up in the earlier one's sorted suffixes by binary search; a shard
   is let go when no later one has its last anchor.
4. Removed ranges go back to their documents.

Defined results: a null text is empty; a text under 100 bytes loses nothing;
rows equal in id and text are one document, and each gets its result; rows
that share an id but not the text are ordered by a hash of the text; a null
id is larger than any other; an empty table gives an empty result; further
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm import kernels
from blotter.llm.columns import ref, text_or_empty
from blotter.llm.suffix_array import StringSet, common_prefixes, search, suffix_array
from blotter.plans.guards import materialise

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1  # 32-byte strings in a 100-byte string
SEGMENT = 1 << 19  # bytes hashed at a time; longer texts are read in overlapping pieces
PART = 2 << 20
STRETCH_BYTES = 128  # usual size of a stretch, for the number of parts
SHARD = 1 << 20
LONG = 1024  # strings of a stretch that count as one more occurrence of its anchor
HELD_BYTES = 32 << 20  # of texts whose stretches a task holds
HELD_ROWS = 1 << 18  # stretches and single strings that a task holds
BLOBS = 1 << 20  # bytes of packed rows that leave a task together
HEAVY = 4096  # occurrences from which an anchor's stretches are cut into single strings
HEAVY_ANCHORS = 1 << 16  # there are at most so many such anchors
LAST_ID = (1 << 63) - 1
_PACKED = "id long not null, part int not null, z binary"


def _segments(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Batches of (document, offset, bytes) of bounded size; pieces of a text overlap by 99 bytes."""
    docs, offsets, parts, held = [], [], [], 0
    for d, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), SEGMENT):
            part = text[at : at + SEGMENT + LENGTH - 1]
            docs.append(d)
            offsets.append(at)
            parts.append(part)
            held += len(part)
            if held >= SEGMENT:
                yield docs, offsets, parts
                docs, offsets, parts, held = [], [], [], 0
    if parts:
        yield docs, offsets, parts


def stretches(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Maximal runs of 100-byte strings with one anchor.

    Gives, per run: the part, the start in it, the number of strings, the
    anchor, and how often the anchor's 32 bytes occur in the run.  All parts
    have at least 100 bytes.
    """
    data, ends = kernels.flatten(parts)
    with np.errstate(over="ignore"):
        h, width = kernels.BYTE_CODES[data], 1
        power = kernels.BASE
        while width < GRAM:
            h = h[:-width] * power + h[width:]
            power, width = power * power, 2 * width
        h = kernels.mix(h)
    low, width = h, 1
    while 2 * width <= SPAN:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    rest = SPAN - width
    low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    sizes = np.diff(ends)
    count = sizes - LENGTH + 1
    first = np.cumsum(count) - count
    part = np.repeat(np.arange(len(parts)), count)
    at = np.arange(len(part)) - first[part] + ends[part]  # flat position of every valid string
    a = low[at]
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (part[1:] != part[:-1])])
    run = np.flatnonzero(head)
    n = np.diff(np.append(run, len(a)))
    start, value = at[run], a[run]
    seen = (h[start[:, None] + np.arange(SPAN)] == value[:, None]).sum(axis=1)
    entering = (h[at + SPAN - 1] == a) & ~head  # an occurrence that a later string of the run adds
    seen += np.add.reduceat(entering.astype(np.int64), run)
    return part[run], start - ends[part[run]], n, value.view(np.int64), seen


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, parts_no = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        texts = kernels.as_bytes(batch.column(2))
        for docs, _, parts in _segments(texts):
            part, _, n, value, seen = stretches(parts)
            times = np.minimum(seen, 2)  # a second one within the run makes it a candidate by itself
            times = times + np.where(seen > 1, n // LONG, 0)  # so that a heavy anchor's bytes count too
            doc = np.array(docs)[part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(x, times)) for x in (value, ids[doc], parts_no[doc])], names=["a", "id", "part"]
            )


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by anchor, whose anchor has another row; one row is carried between batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held[0], batch]).combine_chunks()
        a = table.column("a").to_numpy()
        same = a[1:] == a[:-1]
        before = np.concatenate([[held[1] if held else False], same])
        keep = before | np.concatenate([same, [False]])
        out = table.slice(0, len(a) - 1).filter(pa.array(keep[:-1]))
        yield from out.to_batches()
        last = table.slice(len(a) - 1)
        # the last row waits for the next batch; it is known whether its anchor was seen before
        held = (last.to_batches()[0], bool(before[-1]))
    if held and held[1]:
        yield held[0]


_STRETCH = "bucket int, n int, blob binary"
_FIELDS = (("key", "<i8"), ("id", "<i8"), ("part", "<i4"), ("start", "<i8"), ("size", "<i4"))


def _pack(columns: dict[str, np.ndarray], bodies: bytes) -> bytes:
    """Rows (key, id, part, start, size) and their bodies as one compressed value."""
    return zstandard.compress(b"".join([*(columns[name].astype(t).tobytes() for name, t in _FIELDS), bodies]), 1)


def _unpack(n: int, blob: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    raw, at, out = zstandard.decompress(blob), 0, {}
    for name, kind in _FIELDS:
        width = np.dtype(kind).itemsize * n
        out[name] = np.frombuffer(raw[at : at + width], dtype=kind)
        at += width
    return out, raw[at:]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices, so that few texts are unpacked at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            yield batch.slice(at, 512)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: half the bytes in a shuffle."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in _pieces(batches):
        texts = pa.array([pack(t) for t in kernels.as_bytes(batch.column(2))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["id", "part", "z"])


def _texts(column) -> list[bytes]:
    return [zstandard.decompress(z) for z in column.to_pylist()]


class _Held:
    """Stretches of some documents: their places and hashes in columns, and the texts they lie in."""

    def __init__(self):
        self.texts: list[np.ndarray] = []
        self.columns: list[dict[str, np.ndarray]] = []
        self.bytes = self.rows = 0

    def add(self, data: np.ndarray, at: np.ndarray, columns: dict[str, np.ndarray]) -> None:
        self.columns.append({"at": at + self.bytes, **columns})
        self.texts.append(data)
        self.bytes += len(data)
        self.rows += len(at)

    def taken(self) -> tuple[dict[str, np.ndarray], bytes, np.ndarray, np.ndarray]:
        """The columns, the texts, the rows that are the earliest of identical ones, and the other rows."""
        text = b"".join(self.texts)
        c = {name: np.concatenate([x[name] for x in self.columns]) for name in self.columns[0]}
        self.__init__()
        order = np.lexsort((c["start"], c["part"], c["id"], c["hash"]))
        same = np.zeros(len(order), dtype=bool)
        same[1:] = c["hash"][order[1:]] == c["hash"][order[:-1]]
        head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
        first, row = head[same], order[same]
        new = np.any([c[k][first] != c[k][row] for k in ("id", "part", "start")], axis=0)
        first, row = first[new], row[new]  # the others are the same row again
        spans = (x.tolist() for x in (c["at"][first], c["size"][first], c["at"][row], c["size"][row]))
        equal = np.array([text[i : i + m] == text[j : j + n] for i, m, j, n in zip(*spans)], dtype=bool)
        early = np.concatenate([order[~same], row[~equal]])  # of two strings with one hash both go on
        return c, text, early, row[equal]


def _joined(ids, nos, starts, stops) -> tuple[np.ndarray, ...]:
    """The ranges of each document, with those that overlap or touch as one."""
    order = np.lexsort((starts, nos, ids))
    ids, nos, starts, stops = ids[order], nos[order], starts[order], stops[order]
    doc = np.cumsum(np.append(False, (ids[1:] != ids[:-1]) | (nos[1:] != nos[:-1]))[: len(ids)])
    reach = np.maximum.accumulate((doc << 40) + stops)
    head = np.flatnonzero(np.append(True, (doc[1:] << 40) + starts[1:] > reach[:-1])[: len(ids)])
    last = np.append(head[1:], len(ids))[: len(head)] - 1
    return ids[head], nos[head], starts[head], reach[last] - (doc[head] << 40)


def _collect_stretches(heavy: np.ndarray, buckets: int, most_bytes: int = HELD_BYTES, most_rows: int = HELD_ROWS):
    """Stretches of the repeated anchors, packed by bucket; of identical ones that are held together only
    the earliest goes on.  The others lie in buckets below zero, as places without bodies.
    """

    def packed(held: _Held) -> Iterator[tuple[int, int, bytes]]:
        c, text, early, later = held.taken()
        bucket = (kernels.mix(c["key"][early].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((c["key"][early], bucket))
        early, bucket = early[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for first, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
            rows = early[first:stop]
            spans = zip(c["at"][rows].tolist(), c["size"][rows].tolist())
            bodies = b"".join([text[i : i + n] for i, n in spans])
            yield int(bucket[first]), len(rows), _pack({name: c[name][rows] for name, _ in _FIELDS}, bodies)
        ids, nos, starts, stops = _joined(*(c[k][later] for k in ("id", "part", "start")), (c["start"] + c["size"])[later])
        for at in range(0, len(ids), 1 << 16):
            some = slice(at, at + (1 << 16))
            gone = {"key": ids[some], "id": ids[some], "part": nos[some], "start": starts[some]}
            gone["size"] = stops[some] - starts[some]
            place = int(kernels.mix(ids[at : at + 1].view(np.uint64))[0] % np.uint64(buckets))
            yield -1 - place, len(gone["id"]), _pack(gone, b"")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        held = _Held()
        for batch in _pieces(batches):
            ids, nos = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            texts, lists = _texts(batch.column(2)), batch.column(3)
            ends, anchors = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for docs, offsets, parts in _segments(texts):
                part, start, n, value, _ = stretches(parts)
                cut = np.searchsorted(part, np.arange(len(parts) + 1))
                wanted = [
                    np.isin(value[cut[p] : cut[p + 1]], anchors[ends[d] : ends[d + 1]]) for p, d in enumerate(docs)
                ]
                hit = np.flatnonzero(np.concatenate(wanted))
                if not len(hit):
                    continue
                part, start, n, value = part[hit], start[hit], n[hit], value[hit]
                single = np.isin(value, heavy)
                times = np.where(single, n, 1)
                part, value, cut_up = np.repeat(part, times), np.repeat(value, times), np.repeat(single, times)
                nth = np.arange(len(part)) - np.repeat(np.cumsum(times) - times, times)
                start, size = np.repeat(start, times) + nth, np.where(cut_up, LENGTH, np.repeat(n, times) + LENGTH - 1)
                data, begin = kernels.flatten(parts)
                at = begin[part] + start
                own = kernels.word_hashes(data, at, at + size).view(np.int64)
                doc = np.array(docs)[part]
                held.add(
                    data,
                    at,
                    {
                        "key": np.where(cut_up, own, value),
                        "id": ids[doc],
                        "part": nos[doc],
                        "start": np.array(offsets)[part] + start,
                        "size": size.astype(np.int32),
                        "hash": own,
                    },
                )
                if held.bytes >= most_bytes or held.rows >= most_rows:
                    yield from packed(held)
        if held.rows:
            yield from packed(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in rows(batches):
            out.append(row)
            size += len(row[2])
            if size >= BLOBS:
                yield _packed(out)
                out, size = [], 0
        if out:
            yield _packed(out)

    return run


def _packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "n", "blob"])


def _ranges(ids, nos, starts, stops) -> dict:
    return {
        "id": pa.array(ids, pa.int64()),
        "part": pa.array(nos, pa.int32()),
        "start": pa.array(starts, pa.int64()),
        "stop": pa.array(stops, pa.int64()),
    }


def _first_and_last(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per stretch its first and last 100-byte string whose hash occurs twice among all, or -1 and -1."""
    hashes = []
    for _, some in kernels.slices(strings, SHARD):
        data, ends = kernels.flatten(some)
        count = np.diff(ends) - LENGTH + 1
        at = np.arange(int(count.sum())) + np.repeat(ends[:-1] - (np.cumsum(count) - count), count)
        hashes.append(kernels.word_hashes(data, at, at + LENGTH))
    h = np.concatenate(hashes)
    by_hash = np.argsort(h)
    same = h[by_hash][1:] == h[by_hash][:-1]
    twice = np.zeros(len(h), dtype=bool)
    twice[by_hash] = np.append(same, False) | np.append(False, same)
    count = np.array([len(s) - LENGTH + 1 for s in strings])
    begin = np.cumsum(count) - count
    at = np.arange(len(h)) - np.repeat(begin, count)
    last = np.maximum.reduceat(np.where(twice, at, -1), begin)
    first = np.minimum.reduceat(np.where(twice, at, len(h)), begin)
    return np.where(last < 0, -1, first), last


def repeated_strings(strings: list[bytes], keys: np.ndarray, order: np.ndarray, shard: int = SHARD) -> list[np.ndarray]:
    """For every distinct stretch (sorted by key), a flag per 100-byte string: it starts earlier elsewhere.

    ``order`` gives the place of each stretch's first string as one number
    that grows along the corpus; strings further on have place + 1, ...  What
    lies outside a stretch's first and last string of a repeated hash occurs
    once and is cut off before anything is sorted.
    """
    flags = [np.zeros(len(s) - LENGTH + 1, dtype=bool) for s in strings]
    if not strings:
        return flags
    first, last = _first_and_last(strings)
    kept = np.flatnonzero(last >= 0)
    inner = [strings[k][first[k] : last[k] + LENGTH] for k in kept.tolist()]
    for k, f in zip(kept.tolist(), _in_shards(inner, keys[kept], order[kept] + first[kept], shard)):
        flags[k][first[k] : last[k] + 1] = f
    return flags


def _in_shards(strings: list[bytes], keys: np.ndarray, order: np.ndarray, shard: int) -> list[np.ndarray]:
    """The flags by a suffix array per shard, and a search of later shards' strings in earlier ones."""
    sizes = np.cumsum([len(s) for s in strings])
    cuts = [0]
    while cuts[-1] < len(strings):
        done = sizes[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(int(np.searchsorted(sizes, done + shard, side="right")), cuts[-1] + 1))
    flags: list[np.ndarray] = []
    shards: list[dict] = []

    def settle(own: dict) -> None:
        text = own["text"]
        removed = np.zeros(len(text.symbols), dtype=bool)
        removed[own["sa"]] = own["place"] > own["first"][own["number"]]
        flags.extend(removed[s : e - LENGTH + 1] for s, e in zip(text.starts, text.stops))

    for a, b in zip(cuts[:-1], cuts[1:]):
        while shards and keys[shards[0]["b"] - 1] != keys[a]:
            settle(shards.pop(0))  # stretches are sorted by key: no anchor in common with this or any later shard
        text = StringSet(strings[a:b])
        sa = suffix_array(text, LENGTH)
        group = np.cumsum(common_prefixes(text, sa, LENGTH) < LENGTH) - 1
        text.__dict__.pop("packed", None)
        place = order[a:b][text.owner[sa]] + sa - text.starts[text.owner[sa]]
        head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        number = np.cumsum(np.concatenate([[True], group[1:] != group[:-1]])) - 1
        first = np.minimum.reduceat(place, head)
        own = {"text": text, "sa": sa, "head": sa[head], "number": number, "first": first, "place": place}
        for old in reversed(shards):
            at = own["head"]
            near = np.flatnonzero(keys[a:b][text.owner[at]] == keys[a])
            found = search(old["text"], old["head"], text, at[near], LENGTH)
            hit = near[found >= 0]
            there = found[found >= 0]
            least = np.minimum(own["first"][hit], old["first"][there])
            own["first"][hit] = least
            old["first"][there] = least
        own["b"] = b
        shards.append(own)
    for own in shards:
        settle(own)
    return flags


def _resolve(table: pa.Table) -> pa.Table:
    """Removed ranges of one part's stretches; those of a bucket below zero go whole."""
    if table.column("bucket")[0].as_py() < 0:
        gone = [_unpack(n, blob)[0] for n, blob in zip(table.column("n").to_pylist(), table.column("blob").to_pylist())]
        r = {name: np.concatenate([g[name] for g in gone]) for name in ("id", "part", "start", "size")}
        return pa.table(_ranges(r["id"], r["part"], r["start"], r["start"] + r["size"]))
    held, bodies = [], []
    for n, blob in zip(table.column("n").to_pylist(), table.column("blob").to_pylist()):
        r, raw = _unpack(n, blob)
        held.append(r)
        ends = np.cumsum(r["size"])
        bodies += [raw[e - w : e] for e, w in zip(ends.tolist(), r["size"].tolist())]
    keys, ids, nos, starts = (np.concatenate([r[c] for r in held]) for c in ("key", "id", "part", "start"))
    by_place = np.lexsort((starts, nos, ids))
    doc = np.zeros(len(ids), dtype=np.int64)  # documents of this part numbered in corpus order
    i, p = ids[by_place], nos[by_place]
    doc[by_place] = np.cumsum(np.concatenate([[0], (i[1:] != i[:-1]) | (p[1:] != p[:-1])]))
    order = (doc << 40) + starts
    out_row, out_start, out_end = [], [], []
    first: dict[bytes, int] = {}
    for k in by_place.tolist():
        body = bodies[k]
        old = first.setdefault(body, k)
        if order[old] != order[k]:  # the same stretch lies earlier: all of it goes
            out_row.append(k)
            out_start.append(int(starts[k]))
            out_end.append(int(starts[k]) + len(body))
    rows = np.array(list(first.values()))
    rows = rows[np.argsort(keys[rows], kind="stable")]
    flags = repeated_strings([bodies[k] for k in rows], keys[rows], order[rows])
    for k, f in zip(rows.tolist(), flags):
        if f.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], f.view(np.int8), [0]])))
            for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
                out_row.append(k)
                out_start.append(int(starts[k]) + s)
                out_end.append(int(starts[k]) + e + LENGTH - 1)
    at = np.array(out_row, dtype=np.int64)
    return pa.table(_ranges(ids[at], nos[at], out_start, out_end))


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, part, text): one row per document; ``part`` tells texts of one id apart."""
    docs = df.select(F.coalesce(ref(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), text_or_empty(text_col).alias("text"))
    hashes = docs.select("id", F.xxhash64("text").alias("h")).distinct()
    several = hashes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    place = Window.partitionBy("id").orderBy("h")
    numbered = hashes.join(several, "id").withColumn("part", (F.row_number().over(place) - 1).cast("int"))
    numbered, n, _ = materialise(numbered, "parts")
    if not n:
        return docs.select("id", F.lit(0).cast("int").alias("part"), "text")
    marked = docs.withColumn("h", F.xxhash64("text")).join(numbered, ["id", "h"], "left")
    return marked.select("id", F.coalesce("part", F.lit(0)).alias("part"), "text")


def removed_ranges(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """(id, part, ranges): sorted byte ranges to remove, possibly overlapping; only documents that lose some.

    ``packed`` holds the texts of ``docs`` compressed.  The stretches are
    shuffled once and not written besides.
    """
    anchors = docs.mapInArrow(_anchors, "a long, id long, part int")
    candidates, n, _ = materialise(
        anchors.repartition("a").sortWithinPartitions("a").mapInArrow(_repeated, "a long, id long, part int"), "anchors"
    )
    limit = max(HEAVY, n // HEAVY_ANCHORS)
    heavy = candidates.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    heavy = np.array([r.a for r in heavy.collect()], dtype=np.int64)  # fewer than HEAVY_ANCHORS numbers
    lists = candidates.distinct().groupBy("id", "part").agg(F.collect_list("a").alias("anchors"))
    buckets = max(1, -(-n * STRETCH_BYTES // PART))
    found = (
        packed.join(lists, ["id", "part"])
        .select("id", "part", "z", "anchors")
        .mapInArrow(_collect_stretches(heavy, buckets), _STRETCH)
    )
    return (
        found.groupBy("bucket")
        .applyInArrow(_resolve, "id long, part int, start long, stop long")
        .groupBy("id", "part")
        .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("ranges"))
    )


def merge_ranges(ranges: list) -> list[tuple[int, int]]:
    """Maximal runs of sorted ranges; ranges that touch are one run."""
    out: list[list[int]] = []
    for r in ranges:
        a, b = r["start"], r["stop"]
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        texts, ranges = _texts(batch.column(1)), batch.column(2).to_pylist()
        rest, runs = [], []
        for text, r in zip(texts, ranges):
            spans = merge_ranges(r or [])
            edges = [0, *(x for span in spans for x in span), len(text)]
            rest.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if spans else text)
            runs.append(spans)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in r] for r in runs], _RUNS),
                pa.array(rest, pa.binary()),
            ],
            names=["id", "n_bytes", "spans", "kept"],
        )


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``spans`` (removed byte ranges) and
    ``kept`` (the remaining bytes; a cut may fall inside a character)."""
    docs = _documents(df, id_col, text_col)
    packed = docs.mapInArrow(_compress, _PACKED)
    ranges = removed_ranges(docs, packed)
    joined = packed.join(ranges, ["id", "part"], "left").select("id", "z", "ranges")
    cut = joined.mapInArrow(
        _cut, "id long, n_bytes long, spans array<struct<start: bigint, stop: bigint>>, kept binary"
    )
    return cut.select(F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_col), "n_bytes", "spans", "kept")
