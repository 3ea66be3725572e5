"""Packing against a direct encoding of the same texts."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ohlcraft.llm import packing, queries, tokens
from tests.conftest import SF_DIR


def _ids(text):
    tokenizer = Tokenizer.from_file(tokens.default_path())
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def _check(rows, texts, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
        assert 1 <= row.length <= capacity
    assert by_doc.keys() == texts.keys()
    for doc_id, pieces in by_doc.items():
        ids, at = _ids(texts[doc_id]), 0
        for piece in sorted(pieces, key=lambda p: p.start):
            assert piece.start == at and piece.doc_tokens == len(ids)
            part = np.array(ids[at:at + piece.length], dtype="<u4").tobytes()
            assert zlib.crc32(part) == piece.ids_crc32
            at += piece.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    held = []
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= capacity
        held.append(at)
    return held


def test_whole_table_with_little_padding(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = queries.op1_harmonic_packing(spark, SF_DIR).collect()
    held = _check(rows, {r.doc_id: r.text for r in docs.collect()}, 1024)
    assert sum(1024 - n for n in held) < 0.02 * sum(held)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_odd_texts_and_clashing_names(spark, capacity):
    texts = {1: None, 2: "", 3: "  two  spaces \n", 4: "word " * 500, 5: "word " * 500, 6: "ß\n中 a", 7: "a <|endoftext|> b",
             8: "<|endoftext|>", 9: "x<|endoftext|>\ny <|endoftext|>", 10: "lorem ipsum dolor " * 20_000}
    docs = spark.createDataFrame(
        [(i, t, 0, 0) for i, t in texts.items()], "doc_id long, text string, length int, sequence_id int")
    _check(packing.pack_documents(docs, capacity).collect(), texts, capacity)


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c"), (1, "c")], "doc_id long, text string")
    rows = packing.pack_documents(docs).collect()
    assert sum(r.length for r in rows) == 2 * 3 + 2 * 2


def test_cuts_lose_nothing():
    for capacity in (1, 2, 10, 1024, 2048):
        for rest in range(capacity):
            found = packing.cuts(rest, capacity)
            assert sum(found) == rest and all(0 < n <= capacity for n in found)
