"""Secret scans: fixed patterns, and a battery of randomness tests.

Base spans follow three patterns (``assign``, ``access``, ``hex``).  The
battery looks at long tokens of letters, of digits, or of both with signs:

* the encoding is inferred from the characters used (digits, letters of one or
  both cases, hex, base32, one-case alphanumeric, alphanumeric, base64) and
  gives the alphabet;
* three tests of the hypothesis "drawn evenly from that alphabet": chi-squared
  uniformity of the symbols, runs above and below the middle of the alphabet,
  and serial correlation of neighbours; letters of one case also have the share
  of vowels and its runs tested, as that is what tells words; the smallest of
  the p-values, times their number, is the token's;
* false discoveries are controlled per encoding and length class, because
  short tokens give weak evidence: Benjamini-Hochberg over all tokens of a
  class in the corpus decides which are shown not to be random.  The others
  are reported as ``random`` where no base span lies.

P-values are counted in bins (a row per class and bin at most), so the
procedure shuffles a bounded table however many tokens there are; the
thresholds, one number per class, reach the driver.  Texts are read once; the
spans found are written to the shared folder and judged from there.

Only DataFrame functions.  Positions are code points, ends exclusive.

Defined results: a null or empty text has no spans; repeated rows are judged
one by one (each counts as a token of the corpus); a null id is kept; an empty
table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.columns import let, ref, text_or_empty
from blotter.plans.guards import materialise

# Fixed patterns.  A run of [0-9a-f] or [A-Z0-9] is matched whole or not at
# all, so its least length can stand in the pattern.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
LEAST_VALUE = 6  # characters of an assigned value
PIECE = 64  # values of a running sum copied at a time

KINDS = ("assign", "access", "hex", "random")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Inferred encodings, first match: name, pattern of the token, alphabet, and
# whether the token is read in lower case.
ENCODINGS = (
    ("digits", r"^[0-9]+$", DIGITS, False),
    ("letters26", r"^(?:[a-z]+|[A-Z]+)$", LOWER, True),
    ("letters52", r"^[A-Za-z]+$", UPPER + LOWER, False),
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef", True),
    ("base32", r"^[A-Z2-7]+=*$", UPPER + "234567", False),
    ("alnum36", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER, True),
    ("alnum62", r"^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER, False),
    ("base64", r"^[0-9A-Za-z+/_=-]+$", UPPER + LOWER + DIGITS + "+/", False),
)
LENGTHS = (32, 48, 96)  # lower ends of the length classes after the first
LEAST_BODY = 16  # characters without padding
RATE = 0.05  # false-discovery rate
BINS_PER_DECADE = 20
LAST_BIN = 30 * BINS_PER_DECADE

SPAN = "struct<start: bigint, kind: int, stop: bigint>"


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each value the merge of all before it.

    An array can only be extended by copying it, so this goes by pieces of
    ``PIECE`` values: each copies no more than a piece, and the pieces' own
    totals are few.
    """

    def step(acc: Column, x: Column) -> Column:
        return F.struct(merge(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def over(some: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.slice(F.array(at), 1, 0).alias("out"))
        return F.aggregate(some, start, step)["out"]

    def whole(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / PIECE).cast("int"))
        pieces = F.transform(numbers, lambda k: F.slice(v, k * PIECE + 1, F.lit(PIECE)))

        def joined(p: Column) -> Column:
            before = over(F.transform(p, lambda x: F.aggregate(x, zero, merge)), zero)
            return F.flatten(F.zip_with(p, before, over))

        return F.when(F.size(v) > 0, let(pieces, joined)).otherwise(F.slice(F.array(zero), 1, 0))

    return let(values, whole)


def found_spans(text: Column, pattern: str, groups: tuple[int, ...] = (0,)) -> Column:
    """All matches as an array of (start, stop, the text of each group).

    The text between matches and the matches themselves add up to the text,
    so a running sum of their lengths gives the positions.
    """

    def place(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        extra = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups]
        rows = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("m"), *extra)
        names = ["gap", "m", *(f"g{k}" for k in range(len(groups)))]
        kind = "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>"

        def row(x: Column, before: Column) -> Column:
            begin = before + F.length(x["gap"])
            return F.struct(
                begin.alias("start"),
                (begin + F.length(x["m"])).alias("stop"),
                *(x[f"g{k}"].alias(f"g{k}") for k in range(len(groups))),
            )

        def placed(found: Column) -> Column:
            lengths = F.transform(found, lambda x: (F.length(x["gap"]) + F.length(x["m"])).cast("long"))
            before = running(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
            return F.zip_with(found, before, row)

        return let(rows.cast(kind), placed)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = "array<struct<start:bigint,stop:bigint," + ",".join(f"g{k}:string" for k in range(len(groups))) + ">>"
    return let(matches, lambda m: F.when(F.size(m) == 0, F.array().cast(none)).otherwise(place(m)))


def _as_spans(rows: Column, kind: str) -> Column:
    return F.transform(
        rows,
        lambda r: F.struct(
            r["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), r["stop"].alias("stop")
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns, sorted."""
    assign = F.filter(found_spans(text, ASSIGN, (2,)), lambda r: F.length(r["g0"]) >= LEAST_VALUE)
    access = F.when(text.contains("AKIA"), _as_spans(found_spans(text, ACCESS), "access")).otherwise(
        F.array().cast(f"array<{SPAN}>")
    )
    return F.sort_array(
        F.concat(_as_spans(assign, "assign"), access, _as_spans(found_spans(text, HEX), "hex"))
    )


# --- the battery -------------------------------------------------------------


def upper_tail(z: Column) -> Column:
    """P(N(0, 1) > z), by a polynomial good to 1e-7."""

    def positive(x: Column) -> Column:
        t = 1.0 / (1.0 + 0.2316419 * x)
        poly = t * (
            0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
        )
        return poly * F.exp(-x * x / 2.0) / math.sqrt(2 * math.pi)

    return let(F.abs(z), lambda x: F.when(z < 0, 1.0 - positive(x)).otherwise(positive(x)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def p_uniform(body: Column, alphabet: str) -> Column:
    """Chi-squared test of even use of the alphabet (Wilson-Hilferty approximation)."""
    size, free = len(alphabet), len(alphabet) - 1
    symbols = F.split(F.lit(",".join(alphabet)), ",")
    n = F.length(body).cast("double")
    counts = F.transform(symbols, lambda c: (F.length(body) - F.length(F.replace(body, c, F.lit("")))).cast("double"))
    chi = _sum(F.transform(counts, lambda c: c * c)) * size / n - n
    z = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    return upper_tail(z)


def p_runs(values: Column, size: int) -> Column:
    """Runs test (two-sided) of values above and below the middle of the alphabet."""

    def of(b: Column) -> Column:
        n = F.size(b).cast("double")
        high = _sum(F.transform(b, lambda x: x.cast("double")))
        low = n - high
        changes = F.transform(F.sequence(F.lit(1), F.size(b) - 1), lambda i: (b[i] != b[i - 1]).cast("double"))
        runs = _sum(changes) + 1
        mean = 2 * low * high / n + 1
        spread = F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-12))
        return F.when((high == 0) | (low == 0), F.pow(F.lit(2.0), 1 - n)).otherwise(
            2 * upper_tail(F.abs((runs - mean) / F.sqrt(spread)))
        )

    return let(F.transform(values, lambda v: (2 * v >= size).cast("int")), of)


def p_share(marks: Column, share: float) -> Column:
    """Two-sided test of the share of ones."""
    n = F.size(marks).cast("double")
    return 2 * upper_tail(F.abs(_sum(marks) - n * share) / F.sqrt(n * share * (1 - share)))


def p_serial(values: Column, size: int) -> Column:
    """Serial correlation (two-sided) of neighbouring values."""
    middle, variance = (size - 1) / 2, (size * size - 1) / 12
    products = F.transform(
        F.sequence(F.lit(1), F.size(values) - 1), lambda i: (values[i] - middle) * (values[i - 1] - middle)
    )
    n = (F.size(values) - 1).cast("double")
    return 2 * upper_tail(F.abs(_sum(products) / (n * variance) * F.sqrt(n)))


def battery(token: Column) -> Column:
    """(stratum, bin) of a token: encoding and length class, and the binned p-value."""
    length_class = sum((F.when(F.length(token) >= n, 1).otherwise(0) for n in LENGTHS), F.lit(0))

    def judge(number: int, alphabet: str):
        size = len(alphabet)

        def of(b: Column) -> Column:
            values = F.transform(
                F.split(b, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double")
            )

            def least(v: Column) -> Column:
                tests = [p_uniform(b, alphabet), p_runs(v, size), p_serial(v, size)]
                if alphabet == LOWER:  # words, too, use half the alphabet; their vowels are many and spread out
                    vowels = F.transform(F.split(b, ""), lambda c: c.rlike("[aeiou]").cast("double"))
                    tests += [let(vowels, lambda x: p_share(x, 5 / 26)), p_runs(vowels, 1)]
                return len(tests) * F.least(*tests)

            p = F.least(F.lit(1.0), let(values, least))
            decades = -F.log10(F.greatest(p, F.lit(1e-300)))
            stratum = F.lit(number * (len(LENGTHS) + 1)) + length_class
            return F.struct(
                stratum.cast("int").alias("stratum"),
                F.least(F.floor(decades * BINS_PER_DECADE), F.lit(LAST_BIN)).cast("int").alias("bin"),
            )

        return of

    result = F.lit(None).cast("struct<stratum: int, bin: int>")
    for k, (name, pattern, alphabet, lower) in reversed(list(enumerate(ENCODINGS))):
        body = F.rtrim(token, F.lit("="))
        body = F.lower(body) if lower else F.translate(body, "-_=", "+/") if name == "base64" else body
        long_enough = F.length(body) >= LEAST_BODY
        result = F.when(token.rlike(pattern), F.when(long_enough, let(body, judge(k, alphabet)))).otherwise(result)
    return result


def candidates(text: Column) -> Column:
    """Judged tokens: (start, stop, stratum, bin).

    A token with signs in it mixes letters and digits; one of words, numbers or
    lines joined by signs alone is not judged.
    """
    mixed = F.filter(
        found_spans(text, TOKEN),
        lambda r: (r["g0"].rlike("[0-9]") & r["g0"].rlike("[A-Za-z]")) | r["g0"].rlike("^(?:[0-9]+|[A-Za-z]+)=*$"),
    )
    judged = F.transform(
        mixed,
        lambda r: let(
            battery(r["g0"]),
            lambda b: F.struct(
                r["start"].alias("start"), r["stop"].alias("stop"), b["stratum"].alias("stratum"), b["bin"].alias("bin")
            ),
        ),
    )
    return F.filter(judged, lambda c: c["stratum"].isNotNull())


def thresholds(scanned: DataFrame, rate: float = RATE) -> DataFrame:
    """(stratum, cut): tokens with a bin of at least ``cut`` are shown not to be random.

    Benjamini-Hochberg on binned p-values: a bin's upper end must not exceed
    rate times the share of the class's tokens in it or beyond.
    """
    counts = (
        scanned.select(F.explode("tokens").alias("t"))
        .groupBy("t.stratum", "t.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    beyond = Window.partitionBy("stratum").orderBy(F.col("bin").desc())
    ranked = counts.withColumn("rank", F.sum("n").over(beyond)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("stratum"))
    )
    upper = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE)
    return ranked.where(upper <= rate * F.col("rank") / F.col("all")).groupBy("stratum").agg(F.min("bin").alias("cut"))


def apart(tokens: Column, base: Column) -> Column:
    """The tokens that overlap no base span, (start, stop); both are sorted by start.

    One walk over both in order: a token overlaps when a base span that begins
    no later reaches into it, or when the next one begins before its end.
    """
    number = F.lit(0).cast("long")
    kept = "array<struct<start:bigint,stop:bigint>>"
    both = F.sort_array(
        F.concat(
            F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("token"), b["stop"].alias("stop"))),
            F.transform(tokens, lambda t: F.struct(t["start"].alias("start"), F.lit(1).alias("token"), t["stop"].alias("stop"))),
        )
    )

    def walked(events: Column) -> Column:
        reach = running(
            F.transform(events, lambda e: F.when(e["token"] == 0, e["stop"]).otherwise(number)),
            number,
            lambda a, x: F.greatest(a, x),
        )
        last = F.lit((1 << 62)).cast("long")
        following = F.reverse(
            running(
                F.reverse(F.transform(events, lambda e: F.when(e["token"] == 0, e["start"]).otherwise(last))),
                last,
                lambda a, x: F.least(a, x),
            )
        )
        judged = F.zip_with(
            F.zip_with(events, reach, lambda e, r: F.struct(e.alias("e"), r.alias("reach"))),
            following,
            lambda p, f: F.struct(
                p["e"]["start"].alias("start"),
                p["e"]["stop"].alias("stop"),
                ((p["e"]["token"] == 1) & (p["reach"] <= p["e"]["start"]) & (f >= p["e"]["stop"])).alias("free"),
            ),
        )
        free = F.filter(judged, lambda j: j["free"])
        return F.transform(free, lambda j: F.struct(j["start"].alias("start"), j["stop"].alias("stop")))

    none = F.array().cast(kept)
    simple = F.transform(tokens, lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop")))
    return F.when(F.size(tokens) == 0, none).when(F.size(base) == 0, simple).otherwise(let(both, walked))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per input row: id, ``base`` and ``spans`` (all), arrays of (start, kind number, stop)."""
    text = text_or_empty(text_col)
    scanned, _, _ = materialise(
        df.select(ref(id_col).alias("id"), text.alias("t")).select(
            "id", base_spans(F.col("t")).alias("base"), candidates(F.col("t")).alias("tokens")
        ),
        "secrets",
    )
    cuts = {r["stratum"]: r["cut"] for r in thresholds(scanned, rate).collect()}  # one number per class
    last = LAST_BIN + 1

    def limit(stratum: Column) -> Column:
        known = F.create_map(*[F.lit(x) for pair in (cuts or {-1: last}).items() for x in pair])
        return F.coalesce(F.element_at(known, stratum), F.lit(last))

    random = apart(F.filter("tokens", lambda t: t["bin"] < limit(t["stratum"])), F.col("base"))
    return scanned.select(
        F.col("id").alias(id_col), "base", F.sort_array(F.concat("base", _as_spans(random, "random"))).alias("spans")
    )


def shown(spans: Column) -> Column:
    """kind:start:stop, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")
