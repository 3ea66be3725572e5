"""Near-duplicates against all pairs."""

import random

import numpy as np

from ohlcraft.llm import dedup


def _sets(docs, width):
    for doc_id, text in docs:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        yield doc_id, {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def _expected(docs, width, percent=80):
    sets = list(_sets(docs, width))
    named = {i: i for i, _ in sets}

    def root(i):
        while named[i] != i:
            i = named[i]
        return i

    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                a, b = root(i), root(j)
                named[max(a, b)] = min(a, b)
    return {i: (len(x), root(i), root(i) == i) for i, x in sets}


def _found(rows):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}


def test_groups_around_the_bound(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    docs, doc_id = [], 0
    for copies, edits in ((1, 0), (2, 3), (30, 4), (40, 12), (120, 7), (60, 25)):
        for _ in range(3):
            base = draw.choices(words, k=draw.choice((40, 90, 150)))
            for _ in range(copies):
                text = list(base)
                for _ in range(draw.randint(0, edits)):
                    text[draw.randrange(len(text))] = draw.choice(words)
                docs.append((doc_id, " ".join(text)))
                doc_id += 1
    draw.shuffle(docs)
    for width in (2, 5):
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        assert _found(dedup.near_duplicates(frame, width).collect()) == _expected(docs, width)


def test_odd_rows(spark):
    docs = [(9, "A b c"), (4, "a B\nc"), (7, "a b c é"), (1, None), (2, ""), (3, " \t"), (5, "one"), (6, "ONE"), (8, "É x"), (10, "é x")]
    frame = spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, component_id int, bucket string")
    assert _found(dedup.near_duplicates(frame, 2).collect()) == _expected(docs, 2)
    assert dedup.near_duplicates(frame.limit(0), 2).count() == 0
    odd = spark.createDataFrame([(None, "a b c")] * 2 + [(1, "a b c")] * 2, "doc_id long, text string")
    rows = dedup.near_duplicates(odd, 2).collect()
    assert len(rows) == 4 and {tuple(r) for r in rows} == {(None, 2, None, True), (1, 2, 1, True)}


def test_blocks_find_what_stars_leave(spark):
    """A bucket whose members form a chain: each is near the next only."""
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[2 * i:2 * i + 40])) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert _found(dedup.near_duplicates(frame, 2).collect()) == _expected(docs, 2)


def test_pruning_keeps_pairs_at_the_bound():
    draw = np.random.default_rng(1)
    left = draw.integers(0, 2 ** 32, (20_000, dedup.SIGNATURE), dtype=np.uint32)
    right = np.where(draw.random(left.shape) < 0.8, left, left + 1)
    limits = dedup.least_matches(0.8)
    assert len(dedup.surviving(left, right, limits)) == len(left)
    right = np.where(draw.random(left.shape) < 0.3, left, left + 1)
    assert len(dedup.surviving(left, right, limits)) < 20


def test_ids_with_several_texts(spark):
    """Each row goes by its own text: a text is lost only if it is near another one that stays."""
    draw = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    a, b, c, d, e = (draw.sample(words, 60) for _ in range(5))
    near = lambda text: " ".join([*text[:-1], "other"])
    docs = [(5, " ".join(a)), (3, " ".join(b)), (5, near(b)), (5, " ".join(c)), (5, " ".join(c)), (7, near(c)), (8, None), (8, None),
            (9, " ".join(d)), (9, near(d)), (9, " ".join(d).upper()), (6, near(e)), (5, " ".join(e))]
    frame = spark.createDataFrame([(i, text, "x") for i, text in docs], "doc_id long, text string, digest string")
    kept = sorted((r.doc_id, tuple((r.text or "").lower().split()[:59])) for r in dedup.kept_documents(frame, 2).collect())
    assert kept == sorted([(5, tuple(a[:59])), (3, tuple(b[:59])), (5, tuple(c[:59])), (8, ()), (9, tuple(d[:59])), (5, tuple(e[:59]))])
    rows = dedup.near_duplicates(frame, 2).collect()
    assert len(rows) == len(docs)
    assert sorted((r.doc_id, r.component_id) for r in rows) == sorted(
        [(5, 5)] * 4 + [(3, 3), (5, 3), (7, 5), (8, 8), (8, 8)] + [(9, 9)] * 3 + [(6, 5)])
