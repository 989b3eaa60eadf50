"""Personal data: a finder written anew, and very long texts."""

import re
import time

import numpy as np
import pytest

from blotter.llm import pii

NAMES = pii.Pseudonyms(b"k")


@pytest.mark.parametrize("piece", ["a.", "1.", "a@", "1-", "1 ", "+1", "a-a.", "AB12 ", "(1) ", "x@a.", "12.34."])
def test_long_texts_take_linear_time(piece):
    def took(n):
        text = (piece * n)[:n]
        begin = time.process_time()
        NAMES.find(text)
        return time.process_time() - begin

    short = took(20_000)
    # linear: ten times; the square of it would be a hundred times
    assert took(200_000) < 30 * short + 0.2


def test_a_megabyte_of_dots():
    begin = time.process_time()
    assert NAMES.find("a." * 500_000) == []
    assert time.process_time() - begin < 5  # about 1 s; was about twenty minutes


def test_local_part_of_at_most_64_characters():
    name = "n" * 64
    assert NAMES.find(f"to {name}@x.org") == [("email", 3, 3 + 64 + 6)]
    assert NAMES.find(f"to n{name}@x.org") == []
    assert NAMES.find(f"to {'m' * 30}.{name}@x.org") == [("email", 34, 34 + 64 + 6)]


def test_long_keys_are_refused(spark):
    with pytest.raises(ValueError, match="64"):
        pii.pseudonymise(spark.createDataFrame([(1, "x")], "doc_id long, text string"), key=b"x" * 65)


# What each kind looks like, in words of its own: every substring is tried.


def _luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        n = int(c) * (1 + k % 2)
        total += sum(map(int, str(n)))
    return total % 10 == 0


def _is_card(s):
    d = re.sub("[ -]", "", s)
    grouped = re.fullmatch(r"\d(?:[ -]?\d)*", s, re.A)
    return bool(grouped) and 13 <= len(d) <= 19 and d[0] != "0" and len(set(d)) > 1 and _luhn(d)


def _is_ssn(s):
    if not re.fullmatch(r"\d\d\d-\d\d-\d\d\d\d", s, re.A):
        return False
    a, g, n = map(int, s.split("-"))
    return a not in (0, 666) and a < 900 and g > 0 and n > 0


def _is_ip(s):
    parts = s.split(".")
    return len(parts) == 4 and all(re.fullmatch(r"0|[1-9]\d{0,2}", p, re.A) and int(p) <= 255 for p in parts)


def _is_date(s):
    import calendar

    def day(y, m, d):
        return 1900 <= y < 2100 and 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]

    if re.fullmatch(r"\d{4}-\d\d-\d\d", s, re.A):
        return day(int(s[:4]), int(s[5:7]), int(s[8:]))
    if re.fullmatch(r"\d\d\.\d\d\.\d{4}", s, re.A):
        return day(int(s[6:]), int(s[3:5]), int(s[:2]))
    if re.fullmatch(r"\d\d/\d\d/\d{4}", s, re.A):
        return day(int(s[6:]), int(s[:2]), int(s[3:5])) or day(int(s[6:]), int(s[3:5]), int(s[:2]))
    return False


ORDER = [("date", _is_date), ("ip", _is_ip), ("ssn", _is_ssn), ("card", _is_card)]


def _found(text):
    """Leftmost values by trying all substrings: no digit before, no digit-and-sign before unless a value ends there."""
    out, at = [], 0
    while at < len(text):
        before = text[at - 1] if at else ""
        joined = at > 1 and before in "./-" and text[at - 2].isdigit()
        after_value = bool(out) and out[-1][2] == at - 1 and before in "./+-"
        hit = None
        if text[at].isdigit() and not before.isalnum() and (after_value or not joined):
            for kind, is_one in ORDER:
                ends = [e for e in range(len(text), at, -1) if is_one(text[at:e])]
                # it ends where its digits do; an address also does not go on with ".digit"
                ends = [e for e in ends if not (e < len(text) and text[e].isdigit())]
                if kind == "ip":
                    ends = [e for e in ends if not re.match(r"\.\d", text[e:])]
                if ends:
                    hit = (kind, at, ends[0])
                    break
        if hit:
            out.append(hit)
            at = hit[2]
        else:
            at += 1
    return out


def test_numbers_against_all_substrings():
    rng = np.random.default_rng(11)
    parts = [
        "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "5500005555555559", "219-09-9999", "000-12-3456",
        "2024-02-29", "2023-02-29", "31.12.1999", "12/25/2020", "25/12/2020", "13/13/2020", "10.0.0.1", "256.1.1.1",
        "1.2.3.4.5", "01.2.3.4", "12", "7", "99", "a", "x9", "2020",
    ]
    signs = [" ", " ", ", ", "-", "/", ".", "\n", " - ", ": ", ""]
    spans = 0
    for _ in range(1500):
        text = "".join(str(rng.choice(parts)) + str(rng.choice(signs)) for _ in range(rng.integers(1, 6)))
        got = [s for s in NAMES.find(text)]
        if any(k in ("phone", "iban", "email") for k, _, _ in got):
            continue  # kinds the finder above does not know
        assert got == _found(text), text
        spans += len(got)
    assert spans > 800
