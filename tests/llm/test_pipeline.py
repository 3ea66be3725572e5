"""The pipeline's stages against their verdicts and loops."""

from collections import Counter

import corpus_pipeline as pipeline
from ohlcraft.llm import common, mixing, quality
from tests.conftest import SF_DIR
from tests.llm.test_dedup import _expected
from tests.llm.test_packing import _ids


def test_each_stage_does_what_it_decides(spark):
    docs = common.table(spark, SF_DIR, "documents")
    functions = [f for _, f in pipeline.STAGES]
    good = common.stage(functions[0](spark, docs, SF_DIR), "good")
    verdicts = {r.doc_id for r in quality.quality(docs).collect() if r.kept}
    texts = {r.doc_id: r.text for r in good.collect()}
    assert texts.keys() == verdicts and good.columns == docs.columns

    distinct = common.stage(functions[1](spark, good, SF_DIR), "distinct")
    assert distinct.columns == docs.columns
    kept = {i for i, (_, _, first) in _expected(list(texts.items()), 5).items() if first}
    assert Counter(r.doc_id for r in distinct.collect()) == Counter(kept)

    mixed = common.stage(functions[2](spark, distinct, SF_DIR), "mixed")
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix_counts(distinct).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(copies)

    rows = functions[3](spark, mixed, SF_DIR).collect()
    tokens = Counter()
    for row in rows:
        tokens[row.doc_id] += row.length
    assert tokens == {i: n * len(_ids(texts[i])) for i, n in copies.items()}
    again = pipeline.run(spark, SF_DIR)
    assert again.count() == len(rows)


def test_repeated_rows_nulls_and_clashing_names(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", "a", 0), (1, text, "en", "a", 0), (2, text, None, None, 0), (None, text, "en", "a", 0), (3, None, None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _own_0 int")
    distinct = pipeline.distinct(spark, docs, "")
    assert sorted(str(r.doc_id) for r in distinct.collect()) == ["1", "3", "None"]
    mixed = pipeline.mixed(spark, docs, "")
    assert mixed.columns == docs.columns and mixed.count() in range(4, 9)
    empty = docs.limit(0)
    for _, function in pipeline.STAGES:
        assert function(spark, empty, "").count() == 0
