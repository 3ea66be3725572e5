"""Quality counts against plain loops, verdicts against labels."""

import math
import random
import re
from collections import Counter

import pytest

from ohlcraft.llm import common, quality, queries

SF_DIR = "/root/testdata/sf0.01"


def _base(text):
    text = text or ""
    words = re.findall(common.WORD, text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(common.WORD, line):
            dups += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), failed)


@pytest.fixture(scope="module")
def judged(spark):
    return {r.doc_id: r for r in queries.op8_quality_divergence(spark, SF_DIR).collect()}


def test_counts_of_the_whole_table(spark, judged):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(judged) == len(docs)
    for doc in docs:
        row = judged[doc.doc_id]
        assert tuple(row)[1:7] == _base(doc.text)
        assert not (row.base_failed and row.kept)


def test_verdicts_follow_the_labels(spark, judged):
    labels = [r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if not judged[r.doc_id].base_failed]
    clean = [judged[r.doc_id].kept for r in labels if r.quality]
    junk = [judged[r.doc_id].kept for r in labels if not r.quality]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.1 * len(junk)


def test_counts_of_odd_texts():
    draw = random.Random(5)
    texts = [None, "", " \n\t", "a" * 50_000, "é \x85 \x1c|", "x\n\n x\nx \nx",
             *("".join(draw.choice(["a ", "b ", "c\n", "##", "ü", " "]) for _ in range(draw.randint(0, 80))) for _ in range(300))]
    for text in texts:
        raw = None if text is None else text.encode()
        assert quality.measure(raw, "en", {}, quality.Rules())[:6] == _base(text)


def test_nulls_empty_tables_and_clashing_names(spark):
    text = "the cat and the dog sat on the mat with a hat " * 2 + " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", True), (1, text, "en", True), (2, None, "en", True), (None, text, None, True), (3, text, "xx", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept boolean")
    found = quality.quality(docs).collect()
    assert len(found) == 5 and sum(r.kept for r in found) == 4
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 4
    assert quality.quality(docs.limit(0)).count() == 0 and quality.kept_documents(docs.limit(0)).count() == 0


def test_languages_of_any_share_are_judged(spark, monkeypatch):
    """A language is judged whatever others have: by its own reference if that is stable, joined
    beyond the largest, and by the nearest one if not."""
    draw = random.Random(4)

    def texts(own, n):
        return [" ".join(draw.choices(own, range(len(own), 0, -1), k=120)) for _ in range(n)]

    langs = {name: [f"{name}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30)] for name in ("aa", "bb", "cc")}
    junk = [" ".join(f"###{draw.random()}" for _ in range(120)) for _ in range(3)]
    rows = [(f"{name} {i}", text, name) for name, n in (("aa", 700), ("bb", 60), ("cc", 50)) for i, text in enumerate(texts(langs[name], n))]
    rows += [(f"junk {i}", text, lang) for i, (text, lang) in enumerate(zip(junk, ("aa", "cc", "tiny")))]
    rows += [("like aa", texts(langs["aa"], 1)[0], "tiny")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    for largest in (1000, 1):
        monkeypatch.setattr(quality, "NEAREST", largest)
        found = {r.doc_id: r for r in quality.quality(docs).collect()}
        assert all(r.class_distance is not None for r in found.values())
        assert {i for i, r in found.items() if not r.kept} == {"junk 0", "junk 1", "junk 2"}
        assert {r.doc_id for r in quality.kept_documents(docs).collect()} == {i for i, r in found.items() if r.kept}


def _by_brute_force(rows, rules):
    """class_distance and word_distance of (id, text, lang), in plain loops over the corpus."""
    def plain(text):
        found = ["".join(c for c in w if ord(c) > 127 or c.isalnum()) for w in re.findall(common.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))]
        return [w for w in found if w]

    def classes(text):
        found = [0] * 8
        for c in text:
            found[6 if ord(c) > 127 else 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 4 if c == "\n"
                  else 3 if c in " \t\r\x0b\x0c" else 5 if c in ".,;:!?'\"()-" else 7] += 1
        return found

    def apart(p, q):
        if not sum(p) or not sum(q):
            return 1.0
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        parts = [sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x) for a, b in ((p, q), (q, p))]
        return math.sqrt(max(0, sum(parts) / 2))

    texts = {}
    for _, text, lang in rows:
        if text and lang is not None:
            texts.setdefault(lang, []).append(text)
    refs = {}
    for lang, own in texts.items():
        words = Counter(w for text in own for w in plain(text))
        marks = sum(len(re.findall(common.WORD, t)) - len(plain(t)) for t in own)
        top = sorted(words, key=lambda w: (-words[w], w.encode()))[:rules.common_words]
        shares = [words[w] for w in top]
        refs[lang] = (top, [*shares, sum(words.values()) - sum(shares), marks], [sum(x) for x in zip(*map(classes, own))],
                      sum(words.values()) + marks, len(own))
    stable = {lang for lang, r in refs.items() if r[3] >= rules.reference_words and r[4] >= rules.reference_docs} or set(refs)
    found = {}
    for i, text, lang in rows:
        n = len(re.findall(common.WORD, text or ""))
        if n < min(rules.class_from, rules.word_from) or not stable:
            found[i] = None, None
            continue
        own, counts, pairs = plain(text), Counter(plain(text)), []
        for ref in [lang] if lang in stable else stable:
            common_words = [counts[w] for w in refs[ref][0]]
            pairs.append((apart([*common_words, len(own) - sum(common_words), n - len(own)], refs[ref][1]),
                          apart(classes(text), refs[ref][2])))
        found[i] = min(pairs)[::-1]
    return found


@pytest.mark.parametrize("nearest", [1000, 3])
def test_distances_by_brute_force(spark, monkeypatch, nearest):
    """Many languages, own references and nearest ones, whatever number goes to the tasks at once."""
    monkeypatch.setattr(quality, "NEAREST", nearest)
    draw = random.Random(11)
    rules = quality.Rules(reference_words=400, reference_docs=3, common_words=12)
    langs = {f"l{k}": [f"{chr(97 + k)}{draw.choice('aeiou')}{i}" for i in range(20)] for k in range(12)}
    rows = []
    for k, (name, words) in enumerate(langs.items()):
        for j in range(6 if k < 9 else 2):
            text = " ".join(draw.choices(words, range(20, 0, -1), k=90)) + draw.choice([" -- Ünd. A\n9", "\n#", ""])
            rows.append((f"{name} {j}", text, draw.choice([name, name, name, None]) if k < 9 else name))
    rows += [("null", None, None), ("short", "a b", "l1"), ("marks", "## " * 40, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id string, text string, lang string, _reference int")
    expected = _by_brute_force(rows, rules)
    found = {r.doc_id: r for r in quality.quality(docs, rules).collect()}
    kept = {r.doc_id for r in quality.kept_documents(docs, rules).collect()}
    assert found.keys() == expected.keys()
    for i, (by_classes, by_words) in expected.items():
        row = found[i]
        assert (row.class_distance is None) == (by_classes is None)
        if by_classes is not None:
            assert math.isclose(row.class_distance, by_classes, abs_tol=1e-9) and math.isclose(row.word_distance, by_words, abs_tol=1e-9)
        limits = [(by_classes, rules.class_base, rules.class_scatter, rules.class_from),
                  (by_words, rules.word_base, rules.word_scatter, rules.word_from)]
        sure = not row.base_failed and all(
            d is None or row.n_words < least or d <= base + scatter / row.n_words ** 0.5 for d, base, scatter, least in limits)
        assert row.kept == sure == (i in kept)
