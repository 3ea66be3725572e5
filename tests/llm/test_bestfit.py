"""Certified best-fit packing against a direct encoding and an exact search."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ohlcraft.llm import bestfit, queries, tokens
from tests.conftest import SF_DIR


def _check(rows, texts, capacity):
    """Pieces hold the library's ids in turn and fill their sequences without gaps."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokens.WORD_BPE))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    assert by_doc.keys() == texts.keys()
    for doc_id, pieces in by_doc.items():
        ids = [*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, bestfit.END_ID]
        pieces.sort(key=lambda p: p.piece)
        assert [p.piece for p in pieces] == list(range(-(-len(ids) // capacity)))
        for p in pieces:
            part = ids[p.start:p.start + p.length]
            assert p.start == p.piece * capacity and p.length == min(capacity, len(ids) - p.start)
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_sequence)


def test_whole_table_at_the_bound(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    packed = queries.op12_certified_best_fit(spark, SF_DIR).persist()
    count = _check(packed.collect(), texts, 2048)
    found, bound = bestfit.certificate(packed)
    assert found == count <= bound + 1


@pytest.mark.parametrize("capacity", [1, 5, 64, 2048])
def test_odd_texts_and_clashing_names(spark, capacity):
    texts = {1: None, 2: "", 3: "  Two  spaces \n", 4: "word, " * 300, 5: "word, " * 300, 6: "ß\n中 a don't 23",
             7: "a <|endoftext|>b", 8: "<|startoftext|>", 9: "é ΣΑΣ 　 x\ty", 10: "lorem ipsum. " * 20_000}
    docs = spark.createDataFrame(
        [(i, t, 0, 0, 0) for i, t in texts.items()], "doc_id long, text string, length int, _key int, offset int")
    _check(bestfit.pack_documents(docs, capacity).collect(), texts, capacity)


def test_empty_table_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bestfit.pack_documents(docs).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c"), (1, "c")], "doc_id long, text string")
    rows = bestfit.pack_documents(docs).collect()
    assert sum(r.length for r in rows) == 2 * 3 + 2 * 2 and len({r.sequence_id for r in rows}) == 1


def test_groups_exchange_what_leaves_gaps(spark, monkeypatch):
    monkeypatch.setattr(bestfit, "GROUP", 40)
    rng = np.random.default_rng(5)
    lengths = np.concatenate([rng.integers(1, 600, 900), rng.integers(600, 1024, 100)]).tolist()
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "_key long, length long")
    packed = bestfit.certified_best_fit(pieces, 1024).persist()
    rows = packed.collect()
    assert sorted(r._key for r in rows) == list(range(1000))
    count, bound = bestfit.certificate(packed, 1024)
    assert len({r.sequence_id for r in rows}) == count
    alone = sum(len(set(bestfit.best_fit(np.array(lengths[i:i + 40]), 1024)[0].tolist())) for i in range(0, 1000, 40))
    assert bound <= count <= bound + 4 < alone - 4


def test_pieces_that_can_not_share(spark):
    pieces = spark.createDataFrame([(i, 33) for i in range(50)], "_key long, length long")
    packed = bestfit.certified_best_fit(pieces, 64)
    assert bestfit.certificate(packed, 64) == (50, 50)


def _fewest(lengths, capacity):
    """Exact search."""
    best = len(lengths)

    def place(i, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if i == len(lengths):
            best = len(loads)
            return
        for j in range(len(loads)):
            if loads[j] + lengths[i] <= capacity and loads[j] not in loads[:j]:
                place(i + 1, [*loads[:j], loads[j] + lengths[i], *loads[j + 1:]])
        place(i + 1, [*loads, lengths[i]])

    place(0, [])
    return best


def test_bounds_never_exceed_the_fewest():
    rng = np.random.default_rng(7)
    certified = 0
    for _ in range(150):
        capacity = int(rng.integers(4, 40))
        lengths = sorted(rng.integers(1, capacity + 1, 8).tolist(), reverse=True)
        bins, _ = bestfit.best_fit(np.array(lengths), capacity)
        bound = bestfit.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)[0]
        assert bound <= _fewest(lengths, capacity) <= bins.max() + 1
        certified += bound == bins.max() + 1
    assert certified > 100


def test_weights_of_a_sequence_are_at_most_one():
    rng = np.random.default_rng(9)
    for capacity in (7, 64, 100):
        weights, ones = bestfit.dual_feasible(capacity)
        for _ in range(200):
            cuts = np.sort(rng.integers(0, capacity + 1, rng.integers(1, 8)))
            parts = np.diff([0, *cuts, capacity])
            assert (weights[:, parts].sum(axis=1) <= ones).all()
