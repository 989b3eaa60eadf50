"""The battery, its cut and the overlap rule against plain Python; very long texts."""

import collections
import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import secrets

TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = [
    (r"[0-9]+", DIGITS, str),
    (r"[a-z]+|[A-Z]+", LOWER, str.lower),
    (r"[A-Za-z]+", UPPER + LOWER, str),
    (r"[0-9a-f]+|[0-9A-F]+", DIGITS + "abcdef", str.lower),
    (r"[A-Z2-7]+=*", UPPER + "234567", str),
    (r"[0-9a-z]+|[0-9A-Z]+", DIGITS + LOWER, str.lower),
    (r"[0-9A-Za-z]+", DIGITS + UPPER + LOWER, str),
    (r"[0-9A-Za-z+/_=-]+", UPPER + LOWER + DIGITS + "+/", lambda t: t.replace("-", "+").replace("_", "/").replace("=", "")),
]


def _tail(z):
    return 0.5 * math.erfc(z / math.sqrt(2))


def _runs(high):
    n, ones = len(high), sum(high)
    if ones in (0, n):
        return 2.0 ** (1 - n)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * ones * (n - ones) / n + 1
    spread = max((mean - 1) * (mean - 2) / (n - 1), 1e-12)
    return 2 * _tail(abs(runs - mean) / math.sqrt(spread))


def _judge(token):
    """(stratum, p) of a token, or None."""
    for k, (pattern, alphabet, read) in enumerate(CLASSES):
        if re.fullmatch(pattern, token):
            break
    body = read(token.rstrip("="))
    if len(body) < 16:
        return None
    n, size = len(body), len(alphabet)
    v = [alphabet.index(c) for c in body]
    counts = collections.Counter(v)
    chi = sum((counts[x] - n / size) ** 2 for x in range(size)) * size / n
    free = size - 1
    uniform = _tail(((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)))
    middle = (size - 1) / 2
    serial = sum((a - middle) * (b - middle) for a, b in zip(v, v[1:])) / ((n - 1) * (size**2 - 1) / 12)
    tests = [uniform, _runs([2 * x >= size for x in v]), 2 * _tail(abs(serial) * math.sqrt(n - 1))]
    if alphabet == LOWER:
        vowel = [c in "aeiou" for c in body]
        share = 5 / 26
        tests += [2 * _tail(abs(sum(vowel) - n * share) / math.sqrt(n * share * (1 - share))), _runs(vowel)]
    return k * 4 + sum(len(token) >= x for x in (32, 48, 96)), min(1.0, len(tests) * min(tests))


def _bin(p):
    return min(math.floor(-math.log10(max(p, 1e-300)) * 20), 600)


def _judged(text):
    for m in TOKEN.finditer(text):
        t = m[0]
        mixed = re.search("[0-9]", t) and re.search("[A-Za-z]", t)
        if (mixed or re.fullmatch("(?:[0-9]+|[A-Za-z]+)=*", t)) and (j := _judge(t)):
            yield m.start(), m.end(), j[0], _bin(j[1])


def _random(rows):
    """Random spans of every text: Benjamini-Hochberg per class over all tokens, away from base spans."""
    found = [list(_judged(t)) for t, _ in rows]
    bins = collections.defaultdict(collections.Counter)
    for tokens in found:
        for _, _, stratum, b in tokens:
            bins[stratum][b] += 1
    cut = {}
    for stratum, counts in bins.items():
        total = sum(counts.values())
        ok = [b for b in counts if 10.0 ** (-b / 20) <= 0.05 * sum(n for c, n in counts.items() if c >= b) / total]
        cut[stratum] = min(ok, default=10**9)
    return [
        [(a, e) for a, e, s, b in tokens if b < cut[s] and not any(x < e and a < y for x, y in base)]
        for tokens, (_, base) in zip(found, rows)
    ]


def _texts():
    rng = np.random.default_rng(21)
    draw = lambda alphabet, n: "".join(rng.choice(list(alphabet), n))
    words = ["internationalisation", "verantwortungsbewusst", "aaaaaaaaaaaaaaaaaaaaaaaa", "getElementByIdentifierName",
             "00000000000000000000", "12345678901234567890", "abcabcabcabcabcabcabcabc1", "Z" * 40, "1a" * 20]
    out = []
    for k in range(300):
        parts = []
        for _ in range(rng.integers(1, 6)):
            kind = rng.integers(0, 10)
            n = int(rng.integers(18, 120))
            if kind < len(CLASSES):
                parts.append(draw(CLASSES[kind][1], n) + "=" * int(rng.integers(0, 3)))
            else:
                parts.append(str(rng.choice(words)))
            parts.append(str(rng.choice(["plain words", "é漢 🙂", "token=", "password: ", '"', "key-value", "\n"])))
        out.append(str(rng.choice([" ", ", ", " | "])).join(parts))
    return out + ["", "state-of-the-art-and-so-forth", "----------------------"]


def test_tokens_and_cut_against_plain_python(spark):
    texts = _texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in secrets.scan(df).collect()}
    rows = [(t, [(s.start, s.stop) for s in got[k].base]) for k, t in enumerate(texts)]
    random = secrets.KINDS.index("random")
    shown = [[(s.start, s.stop) for s in got[k].spans if s.kind == random] for k in range(len(texts))]
    want = _random(rows)
    assert shown == want
    assert sum(map(len, want)) > 200
    for k in range(len(texts)):
        assert [tuple(s) for s in got[k].spans if s.kind != random] == [tuple(s) for s in got[k].base]


def test_keys_of_letters_alone_are_found(spark):
    rng = np.random.default_rng(2)
    keys = ["".join(rng.choice(list(a), 24)) for a in (LOWER, UPPER, LOWER + UPPER) for _ in range(10)]
    words = ["internationalisation", "verantwortungsbewusstsein", "Donaudampfschifffahrtsgesellschaft"]
    texts = [f"the value {k} is here" for k in keys] + [f"the word {w} is here" for w in words]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id for r in secrets.scan(df).collect() if r.spans}
    assert len(found & set(range(len(keys)))) >= 27


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 300])
def test_running(spark, n):
    values = [(k * 37) % 11 - 5 for k in range(n)]
    df = spark.createDataFrame([(values,)], "v array<long>")
    zero = F.lit(0).cast("long")
    row = df.select(
        secrets.running(F.col("v"), zero, lambda a, x: a + x).alias("sums"),
        secrets.running(F.col("v"), zero, lambda a, x: F.greatest(a, x)).alias("tops"),
    ).first()
    assert row.sums == [sum(values[:k]) for k in range(n)]
    assert row.tops == [max([0, *values[:k]]) for k in range(n)]


def test_apart(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(200):
        spans = [
            sorted((int(a), int(a + rng.integers(1, 12))) for a in rng.choice(90, int(rng.integers(0, 9)), replace=False))
            for _ in range(2)
        ]
        rows.append(tuple(spans))
    df = spark.createDataFrame(rows, "t array<struct<start: long, stop: long>>, b array<struct<start: long, stop: long>>")
    for r in df.select("t", "b", secrets.apart(F.col("t"), F.col("b")).alias("free")).collect():
        want = [(t.start, t.stop) for t in r.t if not any(b.start < t.stop and t.start < b.stop for b in r.b)]
        assert [tuple(x) for x in r.free] == want


def test_many_tokens_in_one_text_take_linear_time(spark):
    def took(n):
        rng = np.random.default_rng(1)
        text = " ".join(rng.bytes(16).hex() for _ in range(n))
        df = spark.createDataFrame([(1, text + " " + "Q7z" * n)], "doc_id long, text string").cache()
        df.count()
        begin = time.time()
        row = secrets.scan(df).first()
        assert len(row.base) == n
        return time.time() - begin

    took(10)
    assert took(20_000) < 60  # was 94 s on a quiet machine, and growing with the square
