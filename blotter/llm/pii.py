"""Format-preserving pseudonyms for personal data, by a Feistel network.

Numbers and dates are found by pattern and kept only if they are valid (Luhn
or mod-97 check digits, octets, calendar days, number plans).  A valid value
is a number below the size M of its format; a keyed Feistel permutation of
0..M-1 gives its pseudonym, which is written in the same format (separators
stay, check digits are computed anew).  Equal values have equal pseudonyms in
every document, however they are punctuated, and with the key they can be
turned back.  The letters and digits of an e-mail address's local part are
permuted in the same way, its domain stays.

Everything happens on the row itself: no shuffle, no state between rows.

Defined results: a null text stays null and has no spans; an empty text or one
without valid values is unchanged; of overlapping candidates the one that
starts first counts, then the kind listed first, then the longest valid one
that ends with a group of digits or letters; a value may follow any sign, only
one that begins with a digit does not follow a digit and one of ``./-`` unless
that digit ends another value; repeated rows give the same
result; an empty table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from blotter.llm.columns import ref

ROUNDS = 8


class Feistel:
    """A keyed permutation of 0..m-1: a balanced network on the next even number of bits, walked until it falls below m."""

    def __init__(self, key: bytes, tweak: str, m: int):
        if len(key) > 64:
            raise ValueError("a key has at most 64 bytes")
        self._key, self._tweak, self._m = key, tweak.encode(), m
        self._half = max(1, ((m - 1).bit_length() + 1) // 2)
        self._mask = (1 << self._half) - 1

    def _round(self, r: int, x: int) -> int:
        text = self._tweak + b"|%d|%d|%d" % (self._m, r, x)
        return int.from_bytes(hashlib.blake2b(text, key=self._key, digest_size=16).digest(), "big") & self._mask

    def _once(self, x: int, rounds) -> int:
        left, right = x >> self._half, x & self._mask
        for r in rounds:
            left, right = right, left ^ self._round(r, right)
        return (right << self._half) | left

    def apply(self, x: int) -> int:
        """The pseudonym of x."""
        while True:
            x = self._once(x, range(ROUNDS))
            if x < self._m:
                return x

    def invert(self, x: int) -> int:
        """The number whose pseudonym is x: the same network with the rounds in reverse."""
        while True:
            x = self._once(x, range(ROUNDS - 1, -1, -1))
            if x < self._m:
                return x


# --- formats: a value to (format name, size, rank) and back -----------------


def luhn_digit(body: str) -> str:
    """The check digit that makes ``body`` valid."""
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(it), shape)


def _card(s: str):
    d = _digits(s)
    if not 13 <= len(d) <= 19 or d[0] == "0" or len(set(d)) == 1 or luhn_digit(d[:-1]) != d[-1]:
        return None
    n = len(d) - 2  # the first digit (the network) and the check digit are not permuted

    def back(x: int) -> str:
        body = d[0] + str(x).zfill(n)
        return _refill(s, body + luhn_digit(body))

    return f"card{len(d)}{d[0]}", 10**n, int(d[1:-1]), back


def _iban(s: str):
    compact = s.replace(" ", "")
    code, check, body = compact[:2], compact[2:4], compact[4:]
    if not 15 <= len(compact) <= 34 or not check.isdigit():
        return None
    number = lambda t: int("".join(str(int(c, 36)) for c in t))
    if number(body + code + check) % 97 != 1:
        return None
    sizes = [10 if c.isdigit() else 26 for c in body]
    size = rank = 0
    size = 1
    for c, b in zip(body, sizes):
        size *= b
        rank = rank * b + (int(c) if b == 10 else ord(c) - 65)

    def back(x: int) -> str:
        out = []
        for b in reversed(sizes):
            x, d = divmod(x, b)
            out.append(str(d) if b == 10 else chr(65 + d))
        new = "".join(reversed(out))
        whole = code + f"{98 - number(new + code + '00') % 97:02d}" + new
        it = iter(whole)
        return "".join(c if c == " " else next(it) for c in s)

    return f"iban{code}{''.join('d' if b == 10 else 'a' for b in sizes)}", size, rank, back


def _ssn(s: str):
    d = _digits(s)
    area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)

    def back(x: int) -> str:
        x, c = divmod(x, 9999)
        a, b = divmod(x, 99)
        a += 1 + (a >= 665)
        return _refill(s, f"{a:03d}{b + 1:02d}{c + 1:04d}")

    return "ssn", 898 * 99 * 9999, (place * 99 + group - 1) * 9999 + serial - 1, back


def _phone(s: str):
    d = _digits(s)
    lead = ""
    if len(d) == 11 and d[0] == "1":
        lead, d = "1", d[1:]
    if len(d) == 10 and d[0] >= "2" and d[3] >= "2":
        rank = ((int(d[0]) - 2) * 100 + int(d[1:3])) * 8 + int(d[3]) - 2

        def back(x: int) -> str:
            x, line = divmod(x, 10**6)
            a, b = divmod(x, 8)
            return _refill(s, f"{lead}{a + 200:03d}{b + 2}{line:06d}")

        return "phone", 6400 * 10**6, rank * 10**6 + int(d[4:]), back
    if s[0] == "+" and not lead and 8 <= len(d) <= 15:  # other countries: the first two digits stay
        n = len(d) - 2
        return f"phone{d[:2]}x{n}", 10**n, int(d[2:]), lambda x: _refill(s, d[:2] + str(x).zfill(n))
    return None


def _ip(s: str):
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    rank = int.from_bytes(bytes(octets), "big")
    return "ip", 1 << 32, rank, lambda x: ".".join(map(str, x.to_bytes(4, "big")))


_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


def _date(s: str):
    a, first, b, second, c = re.split(r"([-./])", s)
    if len(a) == 4:
        orders = [("ymd", a, b, c)]
    elif first == ".":
        orders = [("dmy", c, b, a)]
    else:
        orders = [("mdy", c, a, b), ("dmy", c, b, a)]
    for order, y, m, d in orders:
        try:
            day = datetime.date(int(y), int(m), int(d))
        except ValueError:
            continue
        rank = day.toordinal() - _FIRST_DAY
        if not 0 <= rank < _DAYS:
            return None

        def back(x: int, order: str = order) -> str:
            t = datetime.date.fromordinal(x + _FIRST_DAY)
            part = {"y": f"{t.year:04d}", "m": f"{t.month:02d}", "d": f"{t.day:02d}"}
            p, q, r = (part[k] for k in order)
            return f"{p}{first}{q}{second}{r}"

        return "date", _DAYS, rank, back
    return None


def _email(s: str):
    local, _, domain = s.rpartition("@")
    rank, size, shape = 0, 1, []
    for c in local:
        base = 10 if c.isdigit() else 26 if c.isalpha() else 0
        shape.append((base, c))
        if base:
            size *= base
            rank = rank * base + (int(c) if base == 10 else ord(c.lower()) - 97)

    def back(x: int) -> str:
        out = []
        for base, c in reversed(shape):
            if not base:
                out.append(c)
                continue
            x, d = divmod(x, base)
            new = str(d) if base == 10 else chr(97 + d)
            out.append(new.upper() if c.isupper() else new)
        return "".join(reversed(out)) + "@" + domain

    return f"email{''.join(str(b % 7) for b, _ in shape)}", size, rank, back


# Kinds in order of precedence: name, pattern, reader.  Every pattern ends after a
# bounded number of characters but for an e-mail address's domain, so a search is
# linear in the text; a local part has at most 64 characters, as the format allows.
KINDS: list[tuple[str, str, Callable]] = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    ("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    ("date", r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])", _date),
    ("ip", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])", _ip),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])", _ssn),
    ("card", r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])", _card),
    (
        "phone",
        r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}(?![0-9])|\+[0-9]{8,15}(?![0-9])",
        _phone,
    ),
]
# A value does not start inside a word or number; one that begins with a digit
# and is no e-mail address does not go on with a number either ("1.", "1/", "1-").
_ANY = "(?:" + "|".join(f"(?P<{n}>{p})" for n, p, _ in KINDS) + ")"
_SEARCH = re.compile(
    r"(?<![A-Za-z0-9])(?:(?=[A-Za-z+(])|(?<![0-9][./-])(?=[0-9])|(?=[0-9][A-Za-z0-9._%+-]{0,63}+@))" + _ANY
)
_NEXT = re.compile(r"[./+-]" + _ANY)  # directly after a value: a range
_READERS = {n: r for n, _, r in KINDS}


class Pseudonyms:
    """Finds and replaces; one instance per task."""

    def __init__(self, key: bytes):
        self._key = key
        self._permutation = lru_cache(maxsize=4096)(lambda tweak, m: Feistel(key, tweak, m))

    def find(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) of the valid values, left to right."""
        out, at = [], 0
        while True:
            start = None
            if out and at == out[-1][2] and _NEXT.match(text, at):
                start = at + 1
            elif m := _SEARCH.search(text, at):
                start = m.start()
            if start is None:
                return out
            hit = next(((n, end) for n, _, _ in KINDS if (end := _valid_end(n, text, start))), None)
            if hit is None:
                at = start + 1
                continue
            kind, at = hit
            out.append((kind, start, at))

    def replace(self, kind: str, value: str, back: bool = False) -> str:
        """The pseudonym of a valid value, or with ``back`` the value of a pseudonym."""
        tweak, size, rank, write = _READERS[kind](value)
        permutation = self._permutation(tweak, size)
        return write(permutation.invert(rank) if back else permutation.apply(rank))

    def text(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and the spans (in the original text) they replace."""
        spans = self.find(text)
        out, at = [], 0
        for kind, a, b in spans:
            out += [text[at:a], self.replace(kind, text[a:b])]
            at = b
        return "".join([*out, text[at:]]), spans


_PATTERNS = {n: re.compile(p) for n, p, _ in KINDS}


def _valid_end(kind: str, text: str, start: int) -> int | None:
    """The end of the longest valid value of a kind at ``start``; shorter ones end where a group of digits or letters does."""
    hit, whole = _PATTERNS[kind].match(text, start), True
    while hit:
        end = hit.end()
        if whole and _READERS[kind](hit[0]):
            return end
        hit = _PATTERNS[kind].match(text, start, end - 1)
        whole = hit and not (text[hit.end() - 1].isalnum() and text[hit.end()].isalnum())
    return None


_SPANS = ArrayType(
    StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("stop", LongType())])
)


def pseudonymise(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``text`` with pseudonyms and ``spans`` (kind, start, stop in code points)."""
    Feistel(key, "", 2)  # a key that is too long fails here, not in a task
    id_type = df.schema[id_col].dataType
    schema = StructType([StructField(id_col, id_type), StructField("pseudo_text", StringType()), StructField("spans", _SPANS)])
    arrow_spans = to_arrow_type(_SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                texts, spans = [], []
                for t in part.column(1).to_pylist():
                    new, found = (None, []) if t is None else names.text(t)
                    texts.append(new)
                    spans.append([{"kind": n, "start": a, "stop": b} for n, a, b in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(spans, arrow_spans)],
                    names=[id_col, "pseudo_text", "spans"],
                )

    return df.select(ref(id_col), ref(text_col).cast("string")).mapInArrow(run, schema)
