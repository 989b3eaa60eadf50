"""Recall of the n-gram join on the test documents: the exact partners of every document among all rows."""

import collections
import re

import pytest

from blotter.llm.queries import op2_ngram_jaccard
from tests.conftest import SF01

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("sf_dir", [SF01])
def test_links_against_all_pairs(spark, sf_dir):
    sets = {r.doc_id: _shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op2_ngram_jaccard(spark, sf_dir).collect()}
    found = true = apart = 0
    holders = collections.defaultdict(set)
    for k, s in sets.items():
        for x in s:
            holders[x].add(k)
    for k in (k for k in sets if sets[k]):
        shared = collections.Counter(b for x in sets[k] for b in holders[x] if b != k)
        partners = [b for b, n in shared.items() if 5 * n >= 4 * (len(sets[k]) + len(sets[b]) - n)]
        assert got[k].n_links <= len(partners)
        found, true = found + got[k].n_links, true + len(partners)
        apart += sum(got[b].class_id != got[k].class_id for b in partners)
    assert true > 100
    assert found >= 0.99 * true and apart <= 0.01 * true
