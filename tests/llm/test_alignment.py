"""Alignment against a direct one of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ohlcraft.llm import alignment, queries, tokens
from ohlcraft.llm.perfect_hash import PerfectHash
from tests.conftest import SF_DIR

A, B = public_tokenizers.path(tokens.BYTE_BPE), public_tokenizers.path(alignment.PIECE_BPE)


@pytest.fixture(scope="module")
def both():
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    return first, second, alignment.byte_tokens(first), alignment.piece_tokens(second)


def _direct(both, text):
    """Ids of both kinds, and the groups, of a whole text."""
    first, second, bytes_a, bytes_b = both
    if not text:
        return [], [], []
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    raw = (" " + text).encode()
    if raw != b"".join(bytes_a[i] for i in a) or raw != b"".join(bytes_b[i] for i in b):
        return [], [], []
    ends_a, ends_b = np.cumsum([len(bytes_a[i]) for i in a]), np.cumsum([len(bytes_b[i]) for i in b])
    groups, x, y = [], 0, 0
    for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        u, v = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
        groups.append((a[x:u], b[y:v]))
        x, y = u, v
    return a, b, groups


def _expected(both, texts):
    """Rows by brute force, in the order of the texts."""
    found = [_direct(both, text) for text in texts]
    counts = Counter((g[0][-1], g[1][-1]) for _, _, groups in found for g in groups)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for a, b, groups in found:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[l] == best[l[1]] for l in links),
                     sum(counts[l] for l in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return rows


def _held(rows):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows}


def test_whole_table(spark, both):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    found = _held(queries.op13_pair_alignment(spark, SF_DIR).collect())
    assert found == dict(zip([d.doc_id for d in docs], _expected(both, [d.text for d in docs])))
    assert sum(row[3] for row in found.values()) > 10_000


ODD = [None, "", " ", "\n", "a", " a", "a ", "a\n", "\na", "a\nb", "a \n b", "  two  blanks ", "x▁y", "▁",
       "<|endoftext|> a", "<s>x</s> <unk> <0x41>", "é é ﬁ", "中文 字　字", "\tt\tt", "a\x00b", "​ z",
       "😀😀 😀", "it's don't", "1234567 12", "\x85 \x1c\x1f", "word " * 3000, "w" * 5000, " a  b"]


def test_odd_texts_nulls_and_clashing_names(spark, both):
    random.seed(3)
    alphabet = ["a", "the", "ing", " ", " ", "  ", "\n", "\t", "é", "▁", "中", ".", ",", "'s", "7", "　", "😀", "<", "|>"]
    texts = ODD + ["".join(random.choices(alphabet, k=random.randint(1, 14))) for _ in range(3000)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_a int, pair int")
    assert _held(alignment.align_documents(docs).collect()) == dict(enumerate(_expected(both, texts)))


def test_empty_table_repeated_rows_and_null_ids(spark, both):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in alignment.align_documents(blank).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
    texts = ["one two", "one two", "one three", "one three"]
    docs = spark.createDataFrame(list(zip([None, None, 1, 1], texts)), "doc_id long, text string")
    found = sorted(tuple(r)[1:] for r in alignment.align_documents(docs).collect())
    assert found == sorted(_expected(both, texts))


def test_trees_of_several_levels_add_all_up(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(9)
    counts = alignment.stage(alignment.pair_counts(docs, A, B), "counts").repartition(9)
    rows = {row.part: (row.sizes, bytes(row.bits), bytes(row.pairs)) for row in alignment.hashed_pairs(counts).collect()}
    parts = [rows[i] for i in range(alignment.PARTS)]
    vector = alignment.summed_vectors(counts, spark.sparkContext.broadcast(parts))
    expected = {r.pair: r.n for r in counts.groupBy("pair").agg({"n": "sum"}).toDF("pair", "n").collect()}
    assert dict(zip(alignment.PairTable(parts).keys.tolist(), vector.tolist())) == expected


def test_pairs_stay_below_the_bound_of_the_vocabularies(spark, both):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bound = alignment.pair_bound(both[2], both[3])
    assert 0 < alignment.pair_counts(docs, A, B).select("pair").distinct().count() <= bound < 2_000_000
    a, b = [b"x", b"ax", b"bax", b"y"], [b"x", b"x", b"ax", b"cy"]
    assert alignment.pair_bound(a, b) == sum(p.endswith(q) or q.endswith(p) for p in a for q in b)


def test_perfect_hash_numbers_all_keys_once():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 100, 50_000):
        keys = np.unique(rng.integers(0, 1 << 40, n))
        assert sorted(PerfectHash.of(keys).numbers(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        PerfectHash.of(np.array([4, 4]))


def test_unknown_pairs_are_told(both):
    keys = np.arange(0, 9000, 3)
    parts = []
    for i in range(alignment.PARTS):
        own = keys[alignment.part_of(keys) == i]
        hashed = PerfectHash.of(own)
        ordered = np.empty_like(own)
        ordered[hashed.numbers(own)] = own
        parts.append((hashed.sizes, np.packbits(hashed.bits).tobytes(), ordered.tobytes()))
    table = alignment.PairTable(parts)
    assert (table.numbers(keys + 1) == -1).all()
    assert (table.keys[table.numbers(keys)] == keys).all()


def test_units_align_as_whole_texts(both):
    """What the workers keep changes nothing."""
    alike = alignment.Aligner(A, B)
    for text in ("the cat sat on the mat\nand the dog", "the the\nthe  the"):
        found = alike.align(pa.array([text]))
        groups = b"".join(found.units[j].groups for j in found.at)[:-1].decode()
        a, b, direct = _direct(both, text)
        assert groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in direct)
