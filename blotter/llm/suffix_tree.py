"""A probabilistic suffix tree over bytes, as an automaton in numpy.

Contexts are byte strings of up to ``depth`` symbols, packed into integers
(latest symbol lowest) together with their length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

SYMBOLS = 256
END = 0xFF  # closes a text and, repeated, stands before one; no UTF-8 byte


def normalise(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts as words with one space between, closed by END.

    Returns the symbols, beginning with ``depth`` ENDs and with ``depth`` ENDs
    after every text (the first of which closes it), and the n + 1 positions
    where the texts begin.
    """
    from blotter.llm.kernels import lower_ascii, word_spans

    data = lower_ascii(data)
    starts, stops, doc = word_spans(data, ends)
    sizes = stops - starts
    n = len(ends) - 1
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, dtype=bool)
    # every word is followed by one separator; the last one's is the END
    lengths = np.bincount(doc, sizes + 1, n).astype(np.int64)
    lengths[lengths == 0] = 1  # no word: only the END
    begins = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(lengths + depth - 1, out=begins[1:])
    begins += depth
    out = np.full(int(begins[-1]), END, dtype=np.uint8)
    before = np.cumsum(sizes + 1) - (sizes + 1)  # place of a word among all words
    first = np.zeros(n, dtype=np.int64)
    heads = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, dtype=np.int64)
    first[doc[heads]] = before[heads]
    to = begins[doc] + before - first[doc]
    shift = np.repeat(to - starts, sizes)
    inside = np.arange(len(shift)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    out[inside + shift] = data[inside]
    out[(to + sizes)[~last]] = 0x20
    return out, begins


def scored(begins: np.ndarray, depth: int) -> np.ndarray:
    """Positions whose symbol counts: all but the padding."""
    keep = np.zeros(int(begins[-1]) + 1, dtype=np.int64)
    np.add.at(keep, begins[:-1], 1)
    np.add.at(keep, begins[1:] - (depth - 1), -1)
    return np.flatnonzero(np.cumsum(keep[:-1]))


def grams(symbols: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The symbol at each position with its ``depth`` predecessors, packed."""
    out = np.zeros(len(at), dtype=np.int64)
    for k in range(depth, -1, -1):
        out = (out << 8) | symbols[at - k]
    return out


class Automaton:
    """States are retained contexts; reading a symbol leads to the longest suffix state."""

    def __init__(self, classes: np.ndarray, step: np.ndarray, logp: np.ndarray, depth: int):
        self.classes = classes  # symbol -> column
        self.step = step  # (states, columns)
        self.logp = logp
        self.depth = depth

    def log10(self, symbols: np.ndarray, begins: np.ndarray, lane: int = 512) -> np.ndarray:
        """log10 probability of each text, from the longest suffix state at every symbol.

        The symbols are read in lanes side by side; a lane first reads the
        ``depth`` symbols before it, after which its state is the same as if
        it had read everything.
        """
        n, width = len(symbols), self.step.shape[1]
        starts = np.arange(self.depth, n, lane)
        column = np.concatenate([self.classes[symbols], np.zeros(lane, dtype=np.int32)])
        step, logp = self.step.ravel(), self.logp.ravel()
        each = np.zeros(n + lane)
        state = np.zeros(len(starts), dtype=np.int64)
        for k in range(-self.depth, lane):
            cell = state * width + column[starts + k]
            if k >= 0:
                each[starts + k] = logp[cell]
            state = step[cell].astype(np.int64)
        total = np.zeros(n + 1)
        at = scored(begins, self.depth)
        kept = np.zeros(n)
        kept[at] = each[at]
        np.cumsum(kept, out=total[1:])
        return total[begins[1:]] - total[begins[:-1]]


def build(levels: list[tuple[np.ndarray, np.ndarray]], depth: int, least: float, gain: float, strength: float) -> Automaton:
    """The automaton from packed counts.

    ``levels[d]`` has (context of d symbols with the next one, count).  A
    context of at least ``least`` occurrences is retained when its next-symbol
    distribution diverges from its parent's: relative entropy of at least
    ``gain`` and of ``strength`` in all its occurrences.  The tree is closed
    under shorter contexts, so every state has a parent and a successor.
    Distributions are smoothed towards the parent's, by the number of distinct
    next symbols (Witten-Bell); the root towards the uniform one.
    """
    total = np.zeros(SYMBOLS)
    keys, counts = levels[0]
    total[keys & 255] += counts
    present = np.flatnonzero(total)
    classes = np.zeros(SYMBOLS, dtype=np.int32)  # column 0: symbols never seen
    classes[present] = np.arange(1, len(present) + 1)
    width = len(present) + 1

    tables: list[dict[int, np.ndarray]] = [{0: np.zeros(width)}]
    tables[0][0][classes[keys & 255]] = counts
    retained: list[set[int]] = [{0}] + [set() for _ in range(depth)]
    for d in range(1, depth + 1):
        keys, counts = levels[d]
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        context = keys >> 8
        cuts = np.append(np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])), len(context)) if len(
            context
        ) else np.zeros(1, dtype=np.int64)
        table = {}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            n = counts[a:b].sum()
            if n < least:
                continue
            row = np.zeros(width)
            row[classes[keys[a:b] & 255]] = counts[a:b]
            c = int(context[a])
            table[c] = row
            parent = tables[d - 1].get(c & ((1 << 8 * (d - 1)) - 1))
            if parent is None:
                continue
            seen = row > 0
            p = row[seen] / n
            q = np.maximum(parent[seen], row[seen]) / max(parent.sum(), n)
            divergence = float((p * np.log(p / q)).sum())
            if divergence >= gain and divergence * n >= strength:
                retained[d].add(c)
        tables.append(table)
    for d in range(depth, 1, -1):  # shorter contexts: without the oldest, and without the latest symbol
        mask = (1 << 8 * (d - 1)) - 1
        for c in retained[d]:
            retained[d - 1].add(c & mask)
            retained[d - 1].add(c >> 8)

    number: list[dict[int, int]] = []
    states = 0
    for d in range(depth + 1):
        number.append({c: states + k for k, c in enumerate(sorted(retained[d]))})
        states += len(retained[d])
    step = np.zeros((states, width), dtype=np.int32)
    prob = np.zeros((states, width))
    uniform = np.full(width, 1.0 / SYMBOLS)
    for d in range(depth + 1):
        mask = (1 << 8 * (d - 1)) - 1 if d else 0
        for c, s in number[d].items():
            parent = number[d - 1][c & mask] if d else None
            below = uniform if parent is None else prob[parent]
            row = tables[d].get(c) if d < len(tables) else None
            if row is None:
                prob[s] = below
            else:
                kinds = max(int((row > 0).sum()), 1) if d else SYMBOLS
                prob[s] = (row + kinds * below) / (row.sum() + kinds)
            if parent is not None:
                step[s] = step[parent]
            if d < depth:
                for k, symbol in enumerate(present.tolist(), 1):
                    child = number[d + 1].get((c << 8) | symbol)
                    if child is not None:
                        step[s, k] = child
    return Automaton(classes, step, np.log10(prob).astype(np.float32), depth)


# --- a tree that grows with the corpus ---------------------------------------
#
# A gram is a symbol with its ``depth`` predecessors in 64 bits: the latest
# predecessor highest, then the older ones, the symbol lowest.  Sorted grams
# thus lie in the order of their contexts at every length.  An entry of level
# d is a context of d symbols followed by the symbol, in d + 1 bytes.

LOW = 2  # contexts of up to LOW symbols are always retained: at most 256 ** LOW
MOST_DEPTH = 7
STEP = 1 << 18  # entries worked on at a time


def spelt(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`normalise` of texts that are not joined yet, in fewer passes and less memory."""
    from blotter.llm.kernels import _IS_SPACE, lower_ascii

    pad = bytes([END]) * depth
    data = lower_ascii(np.frombuffer(pad + b"".join(x for t in texts for x in (t, pad)), dtype=np.uint8))
    space = _IS_SPACE[data]
    keep = ~space
    data = np.where(space, np.uint8(0x20), data)
    keep[1:] |= space[1:] & ~space[:-1] & (data[:-1] != END)  # the first after a word
    data = data[keep]
    last = np.append((data[:-1] == 0x20) & (data[1:] == END), False)
    data = data[~last] if last.any() else data
    return data, np.flatnonzero(data == END)[depth - 1 :: depth] + 1


def ordered_grams(symbols: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The gram at each position."""
    n = len(symbols)
    data = np.concatenate([np.zeros(MOST_DEPTH, np.uint8), symbols, np.zeros(MOST_DEPTH, np.uint8)])
    out = np.empty(n + MOST_DEPTH, dtype=np.uint64)
    for r in range(8):  # eight bytes from every place
        part = out[r::8]
        part[:] = np.frombuffer(data, "<u8", (len(data) - r) // 8, r)[: len(part)]
    out = out[at]
    out = (out << np.uint64(8)) | (out >> np.uint64(56))
    return out & np.uint64(((1 << 8 * depth) - 1) << (64 - 8 * depth) | 255)


def shard(grams: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each gram: all contexts with the same latest LOW + 1 symbols lie together."""
    from blotter.llm.kernels import mix

    return (mix(grams >> np.uint64(64 - 8 * (LOW + 1))) % np.uint64(buckets)).astype(np.int64)


def entries(grams: np.ndarray, level: int) -> np.ndarray:
    """The entry of each gram at a level."""
    if not level:
        return grams & np.uint64(255)
    return (grams >> np.uint64(64 - 8 * level) << np.uint64(8)) | (grams & np.uint64(255))


def parents(keys: np.ndarray) -> np.ndarray:
    """The entry without the oldest symbol of its context."""
    return (keys >> np.uint64(16) << np.uint64(8)) | (keys & np.uint64(255))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.add.reduceat(counts, head)


def _heads(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of sorted entries, and where they begin."""
    context = keys >> np.uint64(8)
    head = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return context[head], head


def _contexts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of sorted entries, where they begin, and the number of each entry's."""
    context = keys >> np.uint64(8)
    first = np.concatenate([[True], context[1:] != context[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
    head = np.flatnonzero(first)
    return context[head], head, np.cumsum(first) - 1


def retain(
    grams: np.ndarray, counts: np.ndarray, depth: int, least: int, gain: float, strength: float
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Entries with their counts per level, of the contexts that a shard of (distinct) grams retains.

    Level LOW is whole: its counts are partial, the other shards have the
    rest.  A longer context of at least ``least`` occurrences is retained when
    its next-symbol distribution diverges from its parent's: relative entropy
    of at least ``gain`` and of ``strength`` in all its occurrences; so is
    every parent of a retained one.  Contexts of LOW + 1 symbols need only the
    occurrences, as their parents' counts are not all here.
    """
    levels = {min(LOW, depth): summed(entries(grams, min(LOW, depth)), counts)}
    keep: dict[int, np.ndarray] = {}
    for d in range(LOW + 1, depth + 1):
        keys, n = levels[d] = summed(entries(grams, d), counts)
        context, head, of = _contexts(keys)
        if not len(keys):
            keep[d] = np.zeros(0, dtype=bool)
            continue
        total = np.add.reduceat(n, head)
        keep[d] = total >= least
        if d > LOW + 1:
            above, m = levels[d - 1]
            at = np.searchsorted(above, parents(keys))
            _, above_head, above_of = _contexts(above)
            p = n / total[of]
            q = m[at] / np.add.reduceat(m, above_head)[above_of[at]]
            divergence = np.add.reduceat(p * np.log(p / q), head)
            keep[d] &= (divergence >= gain) & (divergence * total >= strength)
    for d in range(depth, LOW, -1):
        keys, n = levels[d]
        context, _, of = _contexts(keys)
        if d > LOW + 1:
            above = _contexts(levels[d - 1][0])[0]
            keep[d - 1][np.searchsorted(above, context[keep[d]] >> np.uint64(8))] = True
        levels[d] = keys[keep[d][of]], n[keep[d][of]]
    return levels


class Tree:
    """Next-symbol distributions of the retained contexts.

    Each is smoothed towards its parent's, by the number of distinct next
    symbols (Witten-Bell); the root towards the uniform one.
    """

    def __init__(self, level: Callable[[int], tuple[np.ndarray, np.ndarray]], depth: int):
        """``level(d)``: sorted entries with counts, for d from min(LOW, depth) on, parents always among them.

        Levels are asked for one at a time, in order; their counts are not kept.
        """
        lowest = min(LOW, depth)
        short = {lowest: level(lowest)}
        for d in range(lowest, 0, -1):
            keys, n = short[d]
            short[d - 1] = summed(parents(keys) if d > 1 else keys & np.uint64(255), n)
        self.depth = depth
        keys, n = short[0]
        root = np.zeros(SYMBOLS)
        root[keys.astype(np.int64)] = n
        root = (root + 1.0) / (root.sum() + SYMBOLS)
        self.root = np.log10(root)
        self.levels = []
        above, p = np.arange(SYMBOLS, dtype=np.uint64), root
        for d in range(1, depth + 1):
            keys, n = short.pop(d) if d in short else level(d)
            context, head = _heads(keys)
            total = np.add.reduceat(n, head) if len(keys) else n
            kinds = np.diff(np.append(head, len(keys)))
            of = np.repeat(np.arange(len(head), dtype=np.int32), kinds)
            mine = np.empty(len(keys))
            for k in range(0, len(keys), STEP):
                part = slice(k, k + STEP)
                below = p[np.searchsorted(above, parents(keys[part]) if d > 1 else keys[part] & np.uint64(255))]
                mine[part] = (n[part] + kinds[of[part]] * below) / (total[of[part]] + kinds[of[part]])
            del n, of, head
            above, p = keys, mine
            logp = np.empty(len(p), np.float32)
            np.log10(p, out=logp, casting="same_kind")
            self.levels.append((keys, logp, context, np.log10(kinds / (total + kinds)).astype(np.float32)))

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each (sorted) gram's symbol, from its longest retained context."""
        out = self.root[(grams & np.uint64(255)).astype(np.int64)]
        alive = np.arange(len(grams))
        for d, (keys, logp, context, back) in enumerate(self.levels, 1):
            if not len(keys) or not len(alive):
                break
            wanted = grams[alive] >> np.uint64(64 - 8 * d)
            first = np.concatenate([[True], wanted[1:] != wanted[:-1]])
            mine = wanted[first]
            at = np.searchsorted(context, mine)
            at[at == len(context)] = 0
            at = np.where(context[at] == mine, at, -1)[np.cumsum(first) - 1]
            alive, at = alive[at >= 0], at[at >= 0]
            key = entries(grams[alive], d)
            hit = np.searchsorted(keys, key)
            hit[hit == len(keys)] = 0
            out[alive] = np.where(keys[hit] == key, logp[hit], out[alive] + back[at])
        return out


class Memory:
    """Scores of grams met lately, in a table that later grams overwrite."""

    BITS = 21
    ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, tree: Tree):
        self.tree = tree
        self.keys = np.zeros(1 << self.BITS, dtype=np.uint64)
        self.logp = np.full(1 << self.BITS, tree.log10(np.zeros(1, np.uint64))[0], dtype=np.float32)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """As :meth:`Tree.log10`, in any order."""
        with np.errstate(over="ignore"):
            place = (grams * self.ODD) >> np.uint64(64 - self.BITS)
        out = self.logp[place]
        new = np.flatnonzero(self.keys[place] != grams)
        distinct, of = np.unique(grams[new], return_inverse=True)
        logp = self.tree.log10(distinct)
        out[new] = logp[of]
        with np.errstate(over="ignore"):
            place = (distinct * self.ODD) >> np.uint64(64 - self.BITS)
        # keys and scores in one order, so that of two grams in a place the same one stays
        self.keys[place] = distinct
        self.logp[place] = logp
        return out
