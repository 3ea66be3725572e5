"""Attribution against a loop over the tokens of a direct encoding."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from ohlcraft.llm import attribution, queries, tokens
from tests.conftest import SF_DIR

ENCODER = tokens.encoder(tokens.default_path())


def _spans(text):
    tokenizer = Tokenizer.from_file(tokens.default_path())
    tokenizer.encode_special_tokens = True
    at = 0
    for i in tokenizer.encode(text, add_special_tokens=False).ids:
        n = len(tokenizer.id_to_token(i))
        yield at, at + n
        at += n


def _expected(text, sections, rule):
    counts = {}
    for begin, end in _spans(text):
        held = [max(0, min(end, stop) - max(begin, start)) for start, stop in sections]
        touched = [i for i, n in enumerate(held) if n]
        if not touched:
            chosen = None
        else:
            chosen = {"first": touched[0], "last": touched[-1], "largest": max(touched, key=lambda i: (held[i], -i))}[rule]
        n, crossing = counts.get(chosen, (0, 0))
        counts[chosen] = n + 1, crossing + (bool(touched) and max(held) < end - begin)
    return counts


def test_lines_of_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = {}
    for row in queries.op9_offset_attribution(spark, SF_DIR).collect():
        found.setdefault(row.doc_id, []).append(row)
    assert found.keys() == docs.keys()
    for doc_id, text in docs.items():
        rows = sorted(found[doc_id], key=lambda r: r.section)
        lines = text.splitlines(keepends=True) if "\r" not in text else [x + "\n" for x in text.split("\n")]
        assert [text[r.begin_char:r.end_char] for r in rows] == [x for x in text.replace("\n", "\n\0").split("\0") if x] and lines
        bounds = np.cumsum([0, *(len(text[r.begin_char:r.end_char].encode()) for r in rows)]).tolist()
        expected = _expected(text, list(zip(bounds, bounds[1:])), "largest")
        assert {r.section: (r.n_tokens, r.n_crossing) for r in rows if r.n_tokens} == expected


@pytest.mark.parametrize("rule", attribution.RULES)
def test_given_sections_with_gaps(spark, rule):
    draw, rows = random.Random(4), []
    for doc_id in range(60):
        text = "".join(draw.choices(["ab", " the", "é", "\n\n", "中", " ", "ing", "🙂"], k=draw.randint(0, 40)))
        cuts = sorted(draw.choices(range(len(text) + 1), k=2 * draw.randint(0, 5)))
        rows.append((doc_id, text, list(zip(cuts[::2], cuts[1::2])), 0))
    rows += [(None, None, None, 0), (98, "a b", None, 0), (98, "a b", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<begin:int,end:int>>, section int")
    found = {}
    for r in attribution.section_tokens(docs, "parts", rule).collect():
        found.setdefault(r.doc_id, []).append(r)
    for doc_id, text, parts, _ in rows[:60]:
        sections = [(len(text[:a].encode()), len(text[:b].encode())) for a, b in parts]
        own = found.get(doc_id, [])
        assert {r.section: (r.n_tokens, r.n_crossing) for r in own if r.n_tokens} == _expected(text, sections, rule)
        assert [(r.begin_char, r.end_char) for r in own if r.section is not None] == parts
    assert None not in found and [(r.section, r.n_tokens) for r in found[98]] == [(None, 2)] * 2


def test_empty_texts_and_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    rows = attribution.section_tokens(docs).collect()
    assert {tuple(r) for r in rows} == {(1, 0, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0)}
    assert attribution.section_tokens(docs.limit(0)).count() == 0
