"""Lexical search against its SQL and against loops."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from ohlcraft.llm import lexical
from tests.conftest import SF_DIR
from tests.llm.sql import same_as_sql

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, n long, m long, block long, terms string"
ITEMS = "item_id long, text string, item long"


def _terms(text):
    return TERM.findall((text or "").translate(SMALL))


def _expected(docs, items, k=10):
    """Rows by brute force; docs and items are pairs of id and text."""
    held = [(i, Counter(_terms(text))) for i, text in docs if _terms(text)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    asked = defaultdict(set)
    for i, text in items:
        asked[i] |= set(_terms(text))
    rows = []
    for item, terms in asked.items():
        scored = []
        for i, counts in held:
            m = 10 + 90 * sum(counts.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m)) for t in terms if t in counts)
            if score > 0:
                scored.append((-score, i is None, i, score))
        rows += [(item, at, i, score) for at, (_, _, i, score) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


def _found(spark, docs, items, k=10):
    index = lexical.build_index(spark.createDataFrame([(i, t, 0, 0, 0, "") for i, t in docs], DOCS))
    found = lexical.search(index, spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS), k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_equals_its_sql(spark):
    same_as_sql(spark, "op11_stratified_search", SF_DIR)


def _texts(seed, n, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "é", "中文", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 3, 3, 3, 8, 40, 200]))) for _ in range(n)]


@pytest.mark.parametrize("documents, postings, pairs, most_items, at_once", [
    (1024, 65_536, 200_000, 2_000, 4_000_000), (3, 20, 40, 3, 50), (1, 1, 1, 1, 1)])
def test_blocks_and_bounds_change_nothing(spark, monkeypatch, documents, postings, pairs, most_items, at_once):
    for name, value in (("BLOCK_DOCUMENTS", documents), ("BLOCK_POSTINGS", postings), ("QUERY_PAIRS", pairs),
                        ("QUERY_ITEMS", most_items), ("AT_ONCE", at_once),
                        ("BROADCAST_STRATA", 1000 if documents > 1 else 0), ("STRETCH_BYTES", documents * 1000)):
        monkeypatch.setattr(lexical, name, value)
    n = 200 if documents > 1 else 40
    docs = list(enumerate(_texts(1, n))) + [(n + i, "same words here") for i in range(25)]
    items = list(enumerate(_texts(2, 8 if documents > 1 else 3))) + [(90, "same words")]
    assert _found(spark, docs, items) == _expected(docs, items)
    assert _found(spark, docs, items, 2) == _expected(docs, items, 2)


def test_odd_texts_nulls_ties_and_repeated_rows(spark):
    docs = [(None, "alpha beta"), (None, "alpha beta"), (3, "alpha beta"), (3, "alpha beta"), (3, "gamma"), (4, None),
            (5, ""), (6, " .,;!\n"), (7, "ALPHA Éé é_É"), (8, "alpha " * 20_000 + "delta"), (9, "a\x00b\x7fc")]
    items = [(1, "Alpha"), (1, "gamma"), (2, None), (3, ""), (4, "nowhere"), (None, "delta B"), (None, "é"), (5, "alpha"), (5, "alpha")]
    assert _found(spark, docs, items) == _expected(docs, items)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert _found(spark, [], items) == _found(spark, docs, []) == _found(spark, [(1, None)], items) == []
    assert _found(spark, docs, items) == _expected(docs, items)


def test_documents_without_a_score_to_beat_are_passed_over(spark):
    """Blocks whose bound is too low are not visited, and what is found is the same."""
    docs = [(i, "rare common") if i < 20 else (i, "common " + "other " * (i % 50)) for i in range(400)]
    found = _found(spark, docs, [(1, "rare common")])
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == list(range(10))
