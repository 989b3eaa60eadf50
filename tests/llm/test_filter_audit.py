"""The filter audit against filters that are really applied, order by order."""

import itertools
import re

import pytest

from blotter.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{k}" for k in range(250))
TEXTS = [
    (1, LONG, "en"),
    (2, LONG, "en"),
    (2, LONG, "en"),
    (1, LONG, "de"),
    (3, None, None),
    (4, "", ""),
    (5, " \n\t", "en"),
    (6, "same word " * 150, "en"),
    (7, "LOUD " + LONG, "en"),
    (8, "LOUD TEXT # 1", "en"),
    (9, LONG + " #", "de"),
    (None, LONG, "en"),
    (None, "no id", None),
    (10, "É " + LONG * 60, "fr"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, 1), (7, 1, 1), (99, 1, 1), (None, 1, 1)]


def _mask(k, t, rows):
    t = t or ""
    w = WORD.findall(t)
    fails = [
        len(w) < 200,
        100 * len(set(w)) < 50 * len(w),
        100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
        bool(re.search("[#$%&*|]", t)),
        k is not None and any(i is not None and i < k and (u or "") == t for i, u, _ in rows),
    ]
    return {f for f, bad in zip("ABCDE", fails) if bad}


def _expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {p or "" for _, _, p in rows}:
        here = [(k, _mask(k, t, rows)) for k, t, p in rows if (p or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive = list(range(len(here)))
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if f in here[d][1]]
                before = [d for d in range(len(here)) if d not in alive]
                alive = [d for d in alive if d not in gone]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(alive),
                    len(gone),
                    sum(f in here[d][1] for d in before),
                    sum(m == {f} for _, m in here),
                    sum(here[d][0] in good for d in gone),
                    sum(here[d][0] in toxic for d in gone),
                ]
        for (p, o, s), row in out.items():
            if p == part:
                row.append(total[o[s - 1]])
    return out


SCHEMA = "doc_id long, text string, lang string, mask int, n long, id int, bits int, good int, part string, `a.b` int"


@pytest.mark.parametrize("rows", [TEXTS, TEXTS * 2, TEXTS[4:6]])
def test_every_order_by_applying_the_filters(spark, rows):
    docs = spark.createDataFrame([r + (1, 2, 3, 4, 5, "x", 6) for r in rows], SCHEMA).repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.mask_cells(docs, labels)).collect()
    shown = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in got}
    assert len(shown) == len(got)
    assert shown == _expected(rows, LABELS)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.mask_cells(docs, labels)).count() == 0
    some = spark.createDataFrame([TEXTS[0] + (1, 2, 3, 4, 5, "x", 6)], SCHEMA)
    assert filter_audit.audit(filter_audit.mask_cells(some, labels)).count() == 600
