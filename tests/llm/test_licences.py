"""Licence scans: phrases in the tables, wordings of all families among rivals, and loops."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ohlcraft.llm import common, licences
from ohlcraft.llm.licence_texts import MARKERS, SPECIAL, TEMPLATES
from tests.conftest import SF_DIR

# Phrases in the test tables.
MARKS = {"gpl": "GNU General", "mit": "MIT License", "apache": "Apache License", "creative commons": "CC BY",
         "all rights reserved": "All rights reserved"}


@pytest.fixture(scope="module")
def classifier(spark):
    return licences.train(common.table(spark, SF_DIR, "documents"))


def _scanned(spark, classifier, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.families for r in licences.scan(docs, classifier=classifier).orderBy("doc_id").collect()]


def test_whole_table(spark, classifier):
    docs = common.table(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = licences.scan(docs, classifier=classifier).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = sorted(family for family, mark in MARKS.items() if mark in texts[row.doc_id])
        assert row.families == "; ".join(expected), texts[row.doc_id][-200:]
        assert (row.n_licence > 0) == bool(expected)


def test_every_family_among_its_rivals(spark, classifier):
    """Whole wordings, alone and inside other text."""
    cases = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    found = _scanned(spark, classifier, [text for _, text in cases])
    wrong = [(family, got, text[:60]) for (family, text), got in zip(cases, found) if got != family]
    assert not wrong
    draw = random.Random(4)
    words = [f"{draw.choice('bcdfgl')}{draw.choice('aeiou')}{draw.choice('mnrst')}{i % 7}o" for i in range(300)]
    around = lambda: " ".join(draw.choices(words, k=draw.randint(5, 90)))
    found = _scanned(spark, classifier, [f"{around()}\n{text}\n{around()}" for _, text in cases])
    right = sum(got == family for (family, _), got in zip(cases, found))
    assert right >= 0.97 * len(cases), [(f, g) for (f, _), g in zip(cases, found) if f != g]


@pytest.mark.parametrize("text, expected", [
    ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
     " License as published by the Free Software Foundation; either version 2.1 of the License", "lgpl"),
    ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free"
     " Software Foundation", "agpl"),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free"
     " Software Foundation", "gpl"),
    ("Some words of mine, and the code is\nlicensed under the\nMIT license", "mit"),
    (" ".join(TEMPLATES["mit"][3].split()) + " " + TEMPLATES["x11"][2], "x11"),
    (TEMPLATES["bsd"][3] + " " + TEMPLATES["bsd"][4], "bsd-2-clause"),
    (TEMPLATES["bsd"][3] + " " + TEMPLATES["bsd-3-clause"][3] + " " + TEMPLATES["bsd"][4], "bsd-3-clause"),
    ("the cat sat on the mat and the driver had a licence to drive", ""),
    ("the software of this company has a warranty and the rights of its users are many, as a copyright lawyer said", ""),
])
def test_rivals_and_line_breaks(spark, classifier, text, expected):
    assert _scanned(spark, classifier, [text, text.replace(" ", "\n"), text.replace(" ", " \n# ")]) == [expected] * 3


def test_odd_rows(spark, classifier):
    rows = [
        (1, "some words\nThis file is licensed under the Apache License, Version 2.0 (the License)", 0),
        (2, "Permission is hereby granted free of charge, to any person obtaining a copy of the software", 0),
        (3, "Redistribution and use in source or binary form, with or without modification, are permitted provided", 0),
        (5, None, 0), (6, "", 0), (7, "\n \n!!", 0), (None, "All rights reserved.", 0), (9, "All rights reserved." + " word" * 9000, 0),
        (10, "All rights reserved.", 0), (10, "nothing here", 0), (11, "word " * 9000 + "All rights reserved.", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family int")
    found = {r.doc_id: r for r in licences.scan(docs, classifier=classifier).collect()}
    assert [found[i].families for i in (1, 2, 3)] == ["apache", "mit", "bsd"]
    assert [found[i].n_windows for i in (5, 6, 7)] == [0, 0, 0]
    assert {found[i].families for i in (None, 9, 10, 11)} == {"all rights reserved"} and len(found) == 10
    assert found[9].first_word == 0 and 9003 - 32 <= found[11].first_word < 9003
    assert licences.scan(docs.limit(0), classifier=classifier).count() == 0


def test_training_without_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licences.scan(empty).count() == 0


def test_markers_are_in_every_stretch_of_a_template():
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = licences._driver_words(text)
            for at in range(max(1, len(words) - licences.WINDOW + 1)):
                assert set(words[at:at + licences.WINDOW]) & set(MARKERS), (family, words[at:at + licences.WINDOW])
    assert len(TEMPLATES) >= 15 and all(b in TEMPLATES and a in TEMPLATES for a, b in SPECIAL.items())


def test_windows_cover_whole_texts(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 15, 16, 17, 31, 32, 33, 48, 49, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    covered = {}
    for row in licences.windows(docs, marked=False).collect():
        words = texts[row.doc_id].split()
        assert row.words == words[row.first_word:row.first_word + licences.WINDOW]
        covered.setdefault(row.doc_id, set()).update(range(row.first_word, row.first_word + len(row.words)))
    assert all(covered.get(i, set()) == set(range(len(t.split()))) for i, t in enumerate(texts))


def _alone(family, pair, held):
    """Whether only the family, or one that is a special case of it, has the pair."""
    return all(f == family or SPECIAL.get(f) == family for f, pairs in held if pair in pairs)


def test_scores_by_loops(spark, classifier):
    """Probabilities of the fitted model, and likeness, window by window."""
    texts = [text for texts in TEMPLATES.values() for text in texts][::7] + ["the rights of the licensed driver"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licences._with_terms(licences.windows(docs)).withColumn("key", F.monotonically_increasing_id())
    rows = common.stage(rows, "rows")
    like = {r.key: r for r in licences.likeness(rows).collect()}
    at = {term: i for i, term in enumerate(classifier.vectorizer.vocabulary)}
    weights, start = classifier.model.coefficientMatrix.toArray(), classifier.model.interceptVector.toArray()
    held = []
    for family, found in TEMPLATES.items():
        for text in found:
            words = licences._driver_words(text)
            held.append((family, set(zip(words, words[1:]))))
    for row in classifier.predicted(rows).collect():
        own = set(zip(row.words, row.words[1:]))
        terms = {*row.words, *(" ".join(p) for p in own)}
        margins = start + weights[:, [at[t] for t in terms if t in at]].sum(axis=1)
        chances = np.exp(margins - margins.max()) / np.exp(margins - margins.max()).sum()
        assert math.isclose(row.probability, chances[1:].max(), rel_tol=1e-6, abs_tol=1e-9)
        assert row.family in (None, licences.FAMILIES[1 + int(np.argmax(chances[1:]))])
        alone = [(family, pairs, any(_alone(family, p, held) for p in own & pairs)) for family, pairs in held]
        best = max((len(own & pairs) / min(len(own), len(pairs)) for _, pairs, sure in alone if sure), default=0)
        assert math.isclose(like[row.key].like if row.key in like else 0, best)
    assert re.fullmatch(r"[a-z0-9. ]+", " ".join(at))
