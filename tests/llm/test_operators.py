"""The numbered operators against brute force, on a small untidy table and on empty ones."""

import collections
import hashlib
import math
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import zstandard
from pyspark.sql import functions as F

from blotter.llm import (
    exact_dedup,
    kernels,
    lm_scoring,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
)
from blotter.llm.components import components

# Columns named like ones the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, key string, epoch long, block long, part int, bucket int, label int, `a.b` string"
)
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    syllables = ["ba", "ko", "ri", "mu", "ten", "sol", "é", "da"]
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))


LINE = "this one line of the licence is common to very many of the documents that were gathered for these tests ok"
NEAR = _prose(1, 120)
TEXTS = {
    1: _prose(2, 80),
    2: _prose(2, 80),
    3: None,
    4: "",
    5: " \n\t ",
    6: NEAR,
    7: NEAR.replace(NEAR.split()[60], "changed", 1),
    8: NEAR + " tail",
    9: LINE + "\n" + _prose(3, 60),
    10: _prose(4, 60) + "\n" + LINE,
    11: "one two three",
    12: "One two THREE",
    13: "ab" * 400,
    14: (_prose(5, 30) + "\n") * 4,
    15: "x # * $ % & | < > " * 10 + _prose(6, 60),
    16: 'token = "abcdef123" secret:ab AKIA' + "Q7" * 9 + " " + "0123456789abcdef" * 2,
    17: "mail bo.ab12@x.example.org, card 4111 1111 1111 1111, call (415) 555-2671 on 2024-02-30 or 2024-02-29",
    18: _prose(7, 9000),
    19: "É ǅ ﬁ � 漢字 🙂 it's, 3.14.",
    20: "nul \x00 byte and \x1c separators",
}
ROWS = [(k, t, "en", ["s", "s", "s", "t", None][k % 5]) for k, t in TEXTS.items()]
ROWS += [(1, TEXTS[1], "en", "s"), (6, NEAR, "en", None), (None, "no id here", None, None), (None, None, None, "t")]


@pytest.fixture(scope="module")
def docs(spark):
    extra = (1, None, "k", 5, 6, 7, 8, 1, "x")
    return spark.createDataFrame([r + extra for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def _text(t):
    return t or ""


# 1 -------------------------------------------------------------------------


def test_exact_dedup(docs, empty):
    got = _rows(exact_dedup.annotate(docs, counters=3))
    groups = collections.defaultdict(list)
    for k, t, *_ in ROWS:
        groups[_text(t)].append(k)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(got) == len(ROWS)
    kept = collections.Counter()
    for r in got:
        ids = by_hash[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}
    assert exact_dedup.annotate(empty).count() == 0
    stay = exact_dedup.keep_distinct(docs, counters=2)
    assert stay.columns == docs.columns
    assert sorted(_text(r["text"]) for r in _rows(stay)) == sorted(groups)
    assert exact_dedup.keep_distinct(empty).count() == 0


def test_misra_gries_keeps_frequent():
    counts = {k: 1 for k in range(1000)} | {"hot": 600}
    assert "hot" in exact_dedup.misra_gries(counts, 3)
    assert len(exact_dedup.misra_gries(counts, 3)) <= 3


# 2 -------------------------------------------------------------------------


def _shingles(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), _text(t)))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def _classes(rows):
    """(class id, links, size) of every row by comparing all pairs."""
    sets = [_shingles(t) for _, t in rows]
    links = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if inter and 5 * inter >= 4 * len(sets[a] | sets[b]):
                links[a].append(b)
                links[b].append(a)
    out = []
    for a in range(len(rows)):
        seen, stack = {a}, [a]
        while stack:
            for b in links[stack.pop()]:
                if b not in seen:
                    seen.add(b)
                    stack.append(b)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[a][0], min(ids, default=None), len(links[a]), len(seen)))
    return out


def test_ngram_join(docs, empty):
    got = _rows(ngram_join.join(docs, block=2))
    want = _classes([r[:2] for r in ROWS])
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted((tuple(r.values()) for r in got), key=key) == sorted(want, key=key)
    assert ngram_join.join(empty).count() == 0
    stay = ngram_join.keep_one(docs)
    assert sorted(stay.columns) == sorted(docs.columns)
    ids = {r["doc_id"] for r in _rows(stay)}
    assert 6 in ids and not ids & {7, 8, 12} and None in ids


def test_forest_depth_reaches_recall():
    d = ngram_join.forest_depth(0.8, 0.999)
    assert 1 - (1 - 0.8**d) ** ngram_join.TREES >= 0.999
    assert 1 - (1 - 0.8 ** (d + 1)) ** ngram_join.TREES < 0.999


def test_overlaps_both_ways():
    rng = np.random.default_rng(0)
    for size, universe in ((30, 60), (400, 1000)):
        sets = [np.unique(rng.integers(0, universe, size).astype(np.uint64)) for _ in range(60)]
        a, b = np.triu_indices(60, 1)
        want = [len(set(sets[i]) & set(sets[j])) for i, j in zip(a, b)]
        assert ngram_join.overlaps(sets, a, b).tolist() == want
        assert ngram_join.overlaps(sets, a[:2], b[:2]).tolist() == want[:2]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 7), (8, 9), (20, 1)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 20: 1, 8: 8, 9: 8}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# 3 -------------------------------------------------------------------------


def test_mixing_repeats(docs, empty):
    tokens = {}
    for k, t, _, s in ROWS:
        tokens[s] = tokens.get(s, 0) + len(WORD.findall(_text(t)))
    mixed = mixing.mix(docs, max_repeats=1.5, block_tokens=50)
    assert {"n_tokens", "_epoch", "_block", "weight"} <= set(mixed.columns)
    got = _rows(mixed.select("doc_id", "source", "text", "n_tokens", "_epoch", "weight", "exponent", "mix_key"))
    times = collections.Counter((r["doc_id"], r["source"], r["text"]) for r in got if r["_epoch"] == 0)
    assert times == collections.Counter((k, s, t) for k, t, _, s in ROWS)  # every row once at least
    read = collections.Counter()
    for r in got:
        read[r["source"]] += r["n_tokens"]
    weights = {r["source"]: r["weight"] for r in got}
    assert abs(sum(weights.values()) - 1) < 1e-9
    total = sum(tokens.values())
    a = got[0]["exponent"]
    z = sum((n / total) ** a for n in tokens.values())
    longest = max(len(WORD.findall(_text(t))) for _, t, *_ in ROWS)
    for s, n in tokens.items():
        assert weights[s] == pytest.approx((n / total) ** a / z)
        quota = weights[s] * max(tokens.values()) / max(weights.values()) if a else n
        assert read[s] <= 1.5 * n + 1 and read[s] <= quota + longest + 1
    assert all(0 <= r["mix_key"] <= 1.0001 for r in got)
    assert mixing.mix(empty, max_repeats=2.0).count() == 0


def test_mixing_entropy_and_budget(spark):
    rows = [(k, "w " * 10, "big" if k < 900 else "small") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = _rows(mixing.mix(df, entropy_share=0.9, budget_tokens=5000, block_tokens=500))
    w = {r["source"]: r["weight"] for r in got}
    entropy = -sum(p * math.log(p) for p in w.values())
    assert entropy == pytest.approx(0.9 * math.log(2), abs=1e-6)
    read = collections.Counter(r["source"] for r in got)
    for s, p in w.items():
        assert -0.5 <= 5000 * p - 10 * read[s] < 10  # within one document of the budget


# 4 -------------------------------------------------------------------------


def _removed(rows):
    seen, out = set(), {}
    for k, t in rows:
        b = _text(t).encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(b[i : i + 100])
        out[k] = (len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g))
    return out


def test_suffix_dedup(docs, empty):
    unique = {k: t for k, t, *_ in ROWS if k is not None}
    want = _removed(sorted(unique.items()))
    got = _rows(suffix_dedup.remove_repeats(docs))
    assert len(got) == len(ROWS)
    for r in got:
        if r["doc_id"] is None:
            assert not r["spans"]
            continue
        n = sum(s["stop"] - s["start"] for s in r["spans"])
        assert (r["n_bytes"], n, bytes(r["kept"])) == want[r["doc_id"]]
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_repeated_strings_across_shards():
    rng = np.random.default_rng(3)
    core = bytes(rng.integers(97, 99, 260).astype(np.uint8))
    strings = sorted({core[a : a + int(n)] for a, n in zip(range(0, 120, 7), rng.integers(100, 140, 18))})
    strings.append(b"xyz" * 60)
    keys = np.array([1] * (len(strings) - 1) + [2])
    order = np.arange(len(strings), dtype=np.int64) << 40
    seen, want = set(), []
    for s in strings:
        flags = []
        for i in range(len(s) - 99):
            flags.append(s[i : i + 100] in seen)
            seen.add(s[i : i + 100])
        want.append(flags)
    for shard in (150, 400, 1 << 20):
        got = suffix_dedup.repeated_strings(strings, keys, order, shard)
        assert [g.tolist() for g in got] == want


def test_stretches_cover_every_string():
    rng = np.random.default_rng(5)
    parts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (100, 101, 500, 3000)] + [b"a" * 400]
    part, start, n, anchor, seen = suffix_dedup.stretches(parts)
    for p, body in enumerate(parts):
        own = part == p
        covered = [w for s, m in zip(start[own], n[own]) for w in range(s, s + m)]
        assert covered == list(range(len(body) - 99))
    assert seen[part == 4][0] >= 2  # a string repeated inside one stretch is a candidate by itself


def _stretch_batches(texts):
    """What a collecting task is given when every anchor of every text is wanted; rows in no order of ids."""
    ids = list(texts)[::-1]
    parts = [texts[k] for k in ids]
    part, _, _, value, _ = suffix_dedup.stretches(parts)
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([0] * len(ids), pa.int32()),
        pa.array([zstandard.compress(t) for t in parts], pa.binary()),
        pa.array([sorted(set(value[part == p].tolist())) for p in range(len(ids))], pa.list_(pa.int64())),
    ]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "part", "z", "anchors"])
    return [batch, batch.slice(0, 1)], np.unique(value)  # one row occurs twice


def _gone(found, texts):
    """Per text the bytes that the resolved stretches remove."""
    table = pa.Table.from_batches(found)
    gone = {k: bytearray(len(t)) for k, t in texts.items()}
    for bucket in set(table.column("bucket").to_pylist()):
        part = suffix_dedup._resolve(table.filter(pc.equal(table.column("bucket"), bucket)))
        for r in part.to_pylist():
            gone[r["id"]][r["start"] : r["stop"]] = b"\1" * (r["stop"] - r["start"])
    return gone


def test_stretches_held_in_small_lots():
    shared, line = _prose(21, 60).encode(), (LINE + "\n").encode()
    texts = {k: _prose(30 + k, 12).encode() + line * (k % 3) + shared[k : k + 250] * (1 + k % 2) for k in range(12)}
    texts |= {20: b"xy" * 300, 21: b"yx" * 2000, 22: texts[3], 23: texts[3] + b"x" * 99}
    seen, want = set(), {}
    for k, t in sorted(texts.items()):
        want[k] = bytearray(len(t))
        for i in range(len(t) - 99):
            if t[i : i + 100] in seen:
                want[k][i : i + 100] = b"\1" * 100
            seen.add(t[i : i + 100])
    batches, anchors = _stretch_batches(texts)
    for heavy in (anchors[:0], anchors[::2], anchors):
        for most_bytes, most_rows in ((1 << 30, 1 << 30), (700, 1 << 30), (1 << 30, 1)):
            found = list(suffix_dedup._collect_stretches(heavy, 3, most_bytes, most_rows)(iter(batches)))
            assert _gone(found, texts) == want


def test_heavy_anchors_do_not_fill_a_task():
    rng = np.random.default_rng(8)
    texts = {k: rng.integers(97, 123, 10_000).astype(np.uint8).tobytes() for k in range(50)}
    batches, heavy = _stretch_batches(texts)
    collect = suffix_dedup._collect_stretches(heavy, 4)
    tracemalloc.start()
    n = sum(sum(b.column(1).to_pylist()) for b in collect(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n >= 50 * 9901  # every single string goes on
    assert peak < 200 << 20  # 100 bytes and some numbers a string, but not as Python objects


# 5 -------------------------------------------------------------------------


def _base_spans(t):
    found = []
    assign = r'''(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)'''
    found += [(m.start(), 0, m.end()) for m in re.finditer(assign, t) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_scan(spark, docs, empty):
    rng = np.random.default_rng(11)
    alphabet = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    extra = [(100 + k, f"see {''.join(rng.choice(alphabet, 40))} here", "aaaabbbb" * 6 + "1") for k in range(30)]
    more = spark.createDataFrame([(k, t + " " + junk) for k, t, junk in extra], "doc_id long, text string")
    got = {r["doc_id"]: r for r in _rows(secrets.scan(docs.select("doc_id", "text").union(more)))}
    for k, t in TEXTS.items():
        assert [(s["start"], s["kind"], s["stop"]) for s in got[k]["base"]] == _base_spans(_text(t))
    random = [[s for s in got[100 + k]["spans"] if s["kind"] == 3] for k in range(30)]
    assert sum(any(s["start"] == 4 and s["stop"] == 44 for s in r) for r in random) >= 27
    assert not any(s["start"] > 44 for r in random for s in r)  # the regular token is shown not to be random
    assert secrets.scan(empty).count() == 0
    assert len(_rows(secrets.scan(docs))) == len(ROWS)


def test_upper_tail(spark):
    from pyspark.sql import functions as F

    xs = [-3.0, -0.5, 0.0, 1.0, 2.5, 5.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", secrets.upper_tail(F.col("x")).alias("p"))
    for x, p in df.collect():
        assert p == pytest.approx(0.5 * math.erfc(x / math.sqrt(2)), abs=1e-6)


# 6 -------------------------------------------------------------------------


def test_toxicity_learns_misspellings(spark, docs, empty):
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        words = _prose(1000 + k, 60).split()
        if bad:
            words[10:10] = ["dreadful", "villainous"][k % 8 == 0 :][:1] * 3
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    rows += [(5000, _prose(77, 60) + " dreadfull dreadfuls dreadfu1"), (5001, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1), (3, None), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.train(df, lab)
    got = {r["doc_id"]: r for r in _rows(toxicity.score(df, model))}
    right = [got[k]["predicted"] == y for k, y in labels if got[k]["held_out"]]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert got[5000]["score"] > 0.5  # never seen in this spelling
    assert 0 <= got[5001]["score"] < 0.5
    for k, _ in labels:
        assert got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
    assert len(_rows(toxicity.score(docs, model))) == len(ROWS)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(empty, lab.limit(0))
    assert {r["score"] for r in _rows(toxicity.score(docs, none))} == {0.5}


def test_toxicity_learns_rare_words(spark):
    """Many toxic words, and as many harmless ones, each in about 1 % of the documents, none in 3 %."""
    rng = np.random.default_rng(8)
    letters = list("fghjlnpqvwxyz")
    rare = [["".join(rng.choice(letters, 8)) for _ in range(40)] for _ in range(2)]
    rows = []
    for k in range(1600):
        words = _prose(3000 + k, 40).split()
        words[5:5] = [rare[k % 2][k // 2 % 40]] * 2
        rows.append((k, " ".join(words), k % 2))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    lab = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in _rows(toxicity.score(df, toxicity.train(df, lab)))}
    right = [got[k]["predicted"] == y for k, _, y in rows if got[k]["held_out"]]
    assert len(right) > 200 and np.mean(right) > 0.9


def test_products_of_sparse_features():
    texts = [_prose(k, 30).encode() for k in range(40)]
    count = np.zeros(1 << toxicity.BUCKET_BITS, dtype=int)
    for t in texts:
        count[np.unique(toxicity.bags([t])[0])] += 1
    chosen = np.flatnonzero(count >= 2)
    chosen = chosen[np.argsort(-count[chosen], kind="stable")]
    whole = toxicity._Features(texts, chosen, len(chosen))
    x = whole.dense - whole.middle
    for common in (len(chosen), 10, 0):
        part = toxicity._Features(texts, chosen, common)
        y = np.arange(len(chosen) * 3).reshape(-1, 3) % 7 - 3.0
        assert np.allclose(part.products(), x @ x.T, atol=1e-4)
        assert np.allclose(part.times(y), x @ y, atol=1e-3)
        assert np.allclose(part.back(np.arange(40.0)), x.T @ np.arange(40.0), atol=1e-3)


def test_one_common_feature_does_not_change_the_scale():
    """How a feature is held is no part of the model: the same numbers with one dense column, none or all."""
    texts = [(_prose(k, 40) + (" toxic" if k % 2 else "")).encode() for k in range(60)]
    labels = np.arange(60) % 2
    fits = []
    for share in (0.0, 0.3, 2.0):
        toxicity_dense, toxicity.DENSE = toxicity.DENSE, share
        try:
            fits.append(toxicity.fit(texts, labels, 0.5)[0])
        finally:
            toxicity.DENSE = toxicity_dense
    assert np.abs(fits[0]).max() > 0
    for other in fits[1:]:
        assert np.allclose(fits[0], other, atol=1e-3 * np.abs(fits[0]).max())


def test_repeated_ids_do_not_widen_the_sample(spark):
    df = spark.range(4000).select(
        (F.col("id") % 20).alias("doc_id"), F.concat_ws(" ", F.lit("text"), F.col("id").cast("string")).alias("text")
    )
    lab = spark.range(20).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    rows = toxicity.sample(df, lab, "doc_id", "text", "toxic", 5).collect()
    assert 0 < len(rows) <= 10


# 7 -------------------------------------------------------------------------


def _measured(t):
    t = _text(t)
    w = WORD.findall(t)
    grams = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    symbols = sum(t.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_ledger(docs, empty):
    book = quality.ledger(docs).cache()
    got = _rows(book)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = collections.Counter((k, *_measured(t)) for k, t, *_ in ROWS)
    assert collections.Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert bool(r["fail_bits"] & quality.BASE_POLICY.mask) == failed
    loss = {r["rule"]: r for r in _rows(quality.ablations(book))}
    mask = quality.DEFAULT_POLICY.mask
    for rule in quality.DEFAULT_POLICY.rules:
        bit = quality.BIT[rule]
        assert loss[rule]["n_failed"] == sum(bool(r["fail_bits"] & bit) for r in got)
        assert loss[rule]["n_kept_without"] == sum(not r["fail_bits"] & mask & ~bit for r in got)
    kept = quality.keep_passing(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["fail_bits"] & mask for r in got)
    assert quality.ledger(empty).count() == 0 and quality.ablations(quality.ledger(empty)).count() == 0


# 8 -------------------------------------------------------------------------


def test_lm_scoring(docs, empty):
    tokens = [(k, WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), _text(t))) + [None]) for k, t, *_ in ROWS]
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2
    counts = collections.Counter(w for k, ws in tokens if not held(k) for w in ws)
    total = sum(counts.values())
    want = collections.Counter()
    for k, ws in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws)
        want[(k, held(k), len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6))] += 1
    got = _rows(lm_scoring.score(docs))
    keys = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert collections.Counter((*(r[c] for c in keys), round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert lm_scoring.score(empty).count() == 0


def test_counting_task_holds_little_more_than_its_keys():
    """The same counts, from one batch of texts, in little memory."""
    import tracemalloc

    rng = np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz    ", np.uint8)
    texts = [None, "", *(letters[rng.integers(0, 30, 2000)].tobytes().decode() for _ in range(4000))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    found = [collections.Counter(), collections.Counter()]
    for out in lm_scoring._count(7)(iter([batch])):
        for kind, keys, n in zip(*(out.column(c).to_pylist() for c in ("kind", "keys", "counts"))):
            found[kind][0] += int(np.frombuffer(n, np.uint32).sum())
            found[kind][1] += len(keys) // 8
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    words = [w for t in texts if t for w in t.split()]
    assert found[0][0] == len(words) and found[0][1] == len(set(words))
    assert found[1][0] == sum(len(" ".join((t or "").split())) + 1 for t in texts)
    assert peak < 190 << 20


def test_counter_merges_like_one_count():
    rng = np.random.default_rng(4)
    counter, parts = lm_scoring._Counter(), [rng.integers(-50, 50, n) for n in (0, 1, 400, 30)]
    for part in parts:
        counter.add(part)
        counter.merge()
    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert counter.keys.tolist() == keys.tolist() and counter.counts.tolist() == counts.tolist()


def test_tree_asks_for_one_level_at_a_time():
    from blotter.llm import suffix_tree

    symbols, begins = suffix_tree.spelt([b"to be or not to be that is", b"", b"be"], 4)
    grams, counts = np.unique(
        suffix_tree.ordered_grams(symbols, suffix_tree.scored(begins, 4), 4), return_counts=True
    )
    levels, asked = suffix_tree.retain(grams, counts, 4, 1, 0.0, 0.0), []
    tree = suffix_tree.Tree(lambda d: asked.append(d) or levels.pop(d), 4)
    assert asked == [2, 3, 4] and not levels
    assert (tree.log10(grams) < 0).all()


def test_lanes_equal_one_walk():
    from blotter.llm import suffix_tree

    texts = [_prose(k, n).encode() for k, n in ((1, 400), (2, 0), (3, 1), (4, 2000))]
    data, ends = kernels.flatten(texts)
    symbols, begins = suffix_tree.normalise(data, ends, 3)
    at = suffix_tree.scored(begins, 3)
    grams = suffix_tree.grams(symbols, at, 3)
    levels = [np.unique(grams & ((1 << 8 * (d + 1)) - 1), return_counts=True) for d in range(4)]
    tree = suffix_tree.build(levels, 3, 2, 0.01, 5.0)
    assert len(tree.step) > 20
    assert np.allclose(10.0 ** tree.logp[:, 1:].astype(float).sum(axis=1) > 0, True)
    for k, t in enumerate(texts):
        state, total = 0, 0.0
        for s in [255] * 3:
            state = tree.step[state, tree.classes[s]]
        for s in [*b" ".join(t.lower().split()), 255]:
            total += tree.logp[state, tree.classes[s]]
            state = tree.step[state, tree.classes[s]]
        assert tree.log10(symbols, begins, lane=7)[k] == pytest.approx(total, abs=1e-2)


def _walked(texts, learnt, depth, least, gain, strength):
    """Scores by the definition: counts per context in dictionaries, one symbol after the other."""
    normal = lambda t: [255] * depth + [*b" ".join(re.sub(b"[A-Z]", lambda m: m[0].lower(), t).split()), 255]
    counts = collections.defaultdict(collections.Counter)
    for t in learnt:
        s = normal(t)
        for k in range(depth, len(s)):
            for d in range(depth + 1):
                counts[tuple(s[k - d : k])][s[k]] += 1
    kept = set()
    for c, row in list(counts.items()):
        n = sum(row.values())
        up = counts[c[1:]]
        apart = sum(m / n * math.log(m / n / (up[x] / sum(up.values()))) for x, m in row.items()) if len(c) > 3 else 9e9
        if len(c) <= 2 or (n >= least and apart >= gain and apart * n >= strength):
            kept |= {c[k:] for k in range(len(c) + 1)}

    def p(c, x):
        if c not in kept:
            return p(c[1:], x)
        row = counts[c]
        if not c:
            return (row[x] + 1) / (sum(row.values()) + 256)
        return (row[x] + len(row) * p(c[1:], x)) / (sum(row.values()) + len(row))

    return [
        sum(math.log10(p(tuple(s[k - depth : k]), s[k])) for k in range(depth, len(s))) for s in map(normal, texts)
    ]


def test_suffix_tree_scores_by_definition(docs):
    key = lambda k, t: ("" if k is None else str(k), t)
    rows = [(k, _text(t).encode()) for k, t, *_ in ROWS]
    learnt = [t for k, t in rows if zlib.crc32(("" if k is None else str(k)).encode()) % 7 != 2]
    names = (lm_scoring.DEPTH, lm_scoring.LEAST, lm_scoring.GAIN, lm_scoring.STRENGTH)
    want = sorted(zip([-1 if k is None else k for k, _ in rows], _walked([t for _, t in rows], learnt, *names)))
    for most in (lm_scoring.MOST_ENTRIES, 0):  # broadcast, and looked up by key
        scored = _rows(lm_scoring.score(docs, most_entries=most))
        got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in scored)
        assert [k for k, _ in got] == [k for k, _ in want]
        assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-4)


def test_suffix_tree_learns_across_words(spark):
    rng = np.random.default_rng(5)
    pair = ("ra zuu xa", "ma zuu ya")
    text = lambda: " ".join(pair[k] for k in rng.integers(0, 2, 200))
    df = spark.createDataFrame([(k, text()) for k in range(70)], "doc_id long, text string")
    held = [r for r in _rows(lm_scoring.score(df)) if r["held_out"]]
    bits = -sum(r["score"] for r in held) / math.log10(2)
    assert held and bits < 1.2 * sum(r["n_tokens"] for r in held) / 3  # a bit for ra or ma, none for the rest


def test_suffix_tree_beats_the_baseline(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = [r for r in _rows(lm_scoring.score(df)) if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in held)
    assert sum(r["score"] for r in held) / tokens > sum(r["base_score"] for r in held) / tokens + 0.2


def test_suffix_tree_keeps_contexts_as_the_corpus_grows():
    """A spelling that occurs 60 times is learnt among much other text as among little."""
    from blotter.llm import suffix_tree

    d = lm_scoring.DEPTH

    def counted(texts):
        data, ends = kernels.flatten([t.encode() for t in texts])
        symbols, begins = suffix_tree.normalise(data, ends, d)
        grams = suffix_tree.ordered_grams(symbols, suffix_tree.scored(begins, d), d)
        return np.unique(grams, return_counts=True)

    rare, n = counted([f"{_prose(k, 8)} vorxaki zitxake" for k in range(60)])
    other, m = counted([_prose(500 + k, 400) for k in range(20)])
    for times in (1, 100, 100_000):  # up to 9e9 symbols
        grams, counts = suffix_tree.summed(np.concatenate([rare, other]), np.concatenate([n, m * times]))
        levels = suffix_tree.retain(grams, counts, d, lm_scoring.LEAST, lm_scoring.GAIN, lm_scoring.STRENGTH)
        held = set((levels[4][0] >> np.uint64(8)).tolist())  # contexts, latest symbol highest
        assert {int.from_bytes(c, "big") for c in (b"kaxr", b"kaxt")} <= held


# 9 -------------------------------------------------------------------------


def test_feistel_is_a_permutation():
    for m in (1, 2, 10, 97, 1000):
        f = pii.Feistel(b"k", "t", m)
        out = [f.apply(x) for x in range(m)]
        assert sorted(out) == list(range(m)) and [f.invert(y) for y in out] == list(range(m))


VALUES = [
    ("card", "4111 1111 1111 1111"),
    ("card", "5500000000000004"),
    ("ssn", "219-09-9999"),
    ("phone", "+1 (434) 555-2368"),
    ("phone", "415.555.2671"),
    ("ip", "93.184.216.34"),
    ("iban", "DE89 3704 0044 0532 0130 00"),
    ("date", "1987-11-23"),
    ("date", "29.02.2000"),
    ("email", "Ab.c9@mail.example.com"),
]


def test_pseudonyms_keep_format_and_turn_back():
    names = pii.Pseudonyms(b"secret")
    for kind, value in VALUES:
        text = f"Here: {value}, see."
        new, spans = names.text(text)
        assert [(k, text[a:b]) for k, a, b in spans] == [(kind, value)], value
        found = names.find(new)
        assert [k for k, _, _ in found] == [kind]
        other = new[found[0][1] : found[0][2]]
        assert other != value
        if kind != "ip":
            shape = lambda v: re.sub("[0-9]", "9", re.sub("[a-z]", "x", re.sub("[A-Z]", "X", v.split("@")[0])))
            assert shape(other) == shape(value)
        assert names.replace(kind, other, back=True) == value
    assert names.replace("phone", "(434) 555-2368")[1:4] == names.replace("phone", "434-555-2368")[:3]
    for invalid in ("4111 1111 1111 1112", "2024-02-30", "300.1.1.1", "666-12-1234", "12345"):
        assert names.text(invalid) == (invalid, [])


def test_values_before_more_groups():
    names = pii.Pseudonyms(b"secret")
    for value, kind, after in (
        ("4111 1111 1111 1111", "card", " 12/25"),
        ("4111 1111 1111 1111", "card", " 123"),
        ("4111-1111-1111-1111", "card", " 12 25"),
        ("DE89 3704 0044 0532 0130 00", "iban", " PAID"),
        ("AT61 1904 3002 3457 3201", "iban", " PAID"),
        ("AT61 1904 3002 3457 3201", "iban", " PAID 2024 IN FULL"),
        ("415-555-2671", "phone", " 22"),
    ):
        text = f"see {value}{after}"
        assert [(k, text[a:b]) for k, a, b in names.find(text)] == [(kind, value)], text
    assert names.find("4111 1111 1111 1112 12/25") == []


def test_values_after_signs():
    names = pii.Pseudonyms(b"secret")
    for text, values in (
        ("01/02/2020-05/06/2020", ["01/02/2020", "05/06/2020"]),
        ("2020-01-01/2020-02-01", ["2020-01-01", "2020-02-01"]),
        ("-john@example.com", ["john@example.com"]),
        ("2020/john@example.com", ["john@example.com"]),
        ("x/9john@example.com", ["9john@example.com"]),
        ("ssn/219-09-9999", ["219-09-9999"]),
        ("- 219-09-9999\n-219-09-9999", ["219-09-9999", "219-09-9999"]),
        ("host.93.184.216.34", ["93.184.216.34"]),
        ("root@93.184.216.34", ["93.184.216.34"]),
        ("tel/+1 434 555 2368", ["+1 434 555 2368"]),
        ("1-219-09-9999", []),
        ("7.93.184.216.34", []),
        ("x219-09-9999", []),
    ):
        assert [text[a:b] for _, a, b in names.find(text)] == values, text


def test_pii_on_untidy_rows(docs, empty):
    got = _rows(pii.pseudonymise(docs, b"k"))
    assert len(got) == len(ROWS)
    for r in got:
        if r["doc_id"] == 17:
            assert [s["kind"] for s in r["spans"]] == ["email", "card", "phone", "date"]
            assert "2024-02-30" in r["pseudo_text"] and "2024-02-29" not in r["pseudo_text"]
        elif r["doc_id"] is not None and r["doc_id"] not in (16,):
            assert r["pseudo_text"] == TEXTS[r["doc_id"]]
    assert pii.pseudonymise(empty, b"k").count() == 0


# 10 ------------------------------------------------------------------------


def check_pieces(rows, pieces, size=4096):
    """Pieces cover every row's ids once, sequences are gapless and padded only as allowed."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter()
    for k, t in rows:
        ids = np.array(tokenizer.encode(_text(t), add_special_tokens=False).ids + [2], dtype="<u4")
        want[(k, len(ids))] += 1
    ids_of = {(k, t): None for k, t in rows}
    starts = collections.Counter((p["doc_id"], p["doc_tokens"]) for p in pieces if p["start"] == 0)
    assert starts == want
    covered = collections.Counter()
    for p in pieces:
        covered[(p["doc_id"], p["doc_tokens"])] += p["length"]
    assert all(covered[key] == key[1] * n for key, n in want.items())
    by_doc = {}
    for k, t in ids_of:
        by_doc.setdefault(k, []).append(
            np.array(tokenizer.encode(_text(t), add_special_tokens=False).ids + [2], dtype="<u4")
        )
    for p in pieces:
        cut = slice(p["start"], p["start"] + p["length"])
        assert any(
            len(x) == p["doc_tokens"] and x[cut].tobytes() == bytes(p["ids"]) for x in by_doc[p["doc_id"]]
        )
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= size and (at == size or at & (at - 1) == 0)


def test_packing(docs, empty):
    pieces = _rows(packing.pack(docs, TOKENIZER))
    check_pieces([r[:2] for r in ROWS], pieces)
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_packing_query_digests(spark):
    from tokenizers import Tokenizer

    from blotter.llm.queries import op10_packing

    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids[r["doc_id"]] = np.array(tokenizer.encode(_text(r["text"]), add_special_tokens=False).ids + [2], dtype="<u4")
    covered = collections.Counter()
    for p in _rows(op10_packing(spark, sf)):
        whole = ids[p["doc_id"]]
        part = whole[p["start"] : p["start"] + p["length"]]
        assert (p["doc_tokens"], p["length"], p["ids_crc32"]) == (len(whole), len(part), zlib.crc32(part.tobytes()))
        covered[p["doc_id"]] += p["length"]
    assert covered == {k: len(v) for k, v in ids.items()}


def test_whole_windows_of_a_long_document():
    packer = packing.SumOfSquares(8)
    ids = np.arange(8 * 5 + 3, dtype="<u4").tobytes()
    full = packer.add("d", 0, ids)
    assert [(w[0][1], w[0][2]) for w in full] == [(8 * k, ids[32 * k : 32 * k + 32]) for k in range(5)]
    assert packer.open[3] == [[("d", 40, ids[160:])]] and packer.counts.sum() == 1
    assert packer.add("e", 0, ids[:32]) == [[("e", 0, ids[:32])]] and packer.counts.sum() == 1


def test_sum_of_squares_choice():
    rng = np.random.default_rng(2)
    packer = packing.SumOfSquares(64)
    for _ in range(500):
        n = int(rng.integers(1, 64))
        counts = packer.counts.copy()

        def after(level, n=n, counts=counts):
            c = counts.copy()
            if level:
                c[level] -= 1
            if level + n < 64:
                c[level + n] += 1
            return int((c[1:64] ** 2).sum())

        options = [h for h in range(64 - n + 1) if not h or counts[h]]
        assert after(packer.level_for(n)) == min(after(h) for h in options)
        packer.add(0, 0, bytes(4 * n))


def test_word_cache_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    texts = [_text(t) for t in TEXTS.values()] * 2
    texts += ["a|b | || <|endoftext|> |", "don't I'll, x., 3.14, $$$, é, ÷ İstanbul é naïve. ﬁne,   \x85z", ",", "., ,."]
    with open(TOKENIZER, encoding="utf-8") as f:
        encoder = packing.WordEncoder(f.read())
    for cache in (0, 20, 10_000):
        for k in range(0, len(texts), 3):
            for text, got in zip(texts[k : k + 3], encoder.encode([t.encode() for t in texts[k : k + 3]], cache)):
                want = tokenizer.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(got, "<u4").tolist() == want
