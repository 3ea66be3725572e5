"""Quality rules by distribution divergence.

A document's histograms of character classes and of common words are held against those of its
language by Jensen-Shannon distance. The references come from all documents: the classes
and the commonest words of every language. They are a table; its largest rows, NEAREST at most,
go to all tasks, and the documents of languages beyond them are joined to theirs. A document
whose language is null or too small for a stable reference is held against the nearest of all:
of those that the tasks have, and of the others, which it meets NEAREST at a time. Short texts scatter more, so that a limit falls with the number of
words to its long-text value, and texts below a least length get no verdict. Plain
counts of words, symbols and repetition come first.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ohlcraft.llm.common import new_name, stage

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
MARKS = b".,;:!?'\"()-"
WINDOW = 8
#: Languages whose references go to all tasks at once.
NEAREST = 1000


@dataclass(frozen=True)
class Rules:
    """What rejects a document. A limit is base + scatter / sqrt(words)."""

    least_words: int = 20
    most_repeated: float = 0.30
    common_words: int = 40
    class_base: float = 0.16
    class_scatter: float = 1.1
    class_from: int = 20
    word_base: float = 0.12
    word_scatter: float = 2.7
    word_from: int = 30
    #: Words and documents of a language that make its reference stable: at 5000 words its scatter
    #: is word_scatter / sqrt(5000), a third of word_base. If no language has them, all count as stable.
    reference_words: int = 5000
    reference_docs: int = 10


def _class_table() -> np.ndarray:
    """Byte to class: lower, upper, digit, blank, line break, mark, beyond ASCII, other."""
    table = np.zeros((256, 8))
    for b in range(256):
        char = chr(b)
        if b < 128:
            table[b, 0 if char.islower() else 1 if char.isupper() else 2 if char.isdigit()
                  else 4 if b == 10 else 3 if b in SPACES else 5 if b in MARKS else 7] = 1
        elif b >= 192:  # the first byte of a character
            table[b, 6] = 1
    return table


CLASSES = _class_table()
#: Stands for the words that plain_words leaves out; no word has a blank.
MARKS_ALONE = b" -"
#: Stands for a language's documents.
DOCUMENTS = b" docs"
_UNMARKED = bytes(b for b in range(256) if b < 128 and not chr(b).isalnum() and b not in SPACES)


def plain_words(raw: bytes) -> list[bytes]:
    """Words in ASCII lower case without marks and symbols; words of nothing else fall away."""
    return raw.lower().translate(None, _UNMARKED).split()


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms; 1 if one is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


@dataclass(frozen=True)
class Reference:
    classes: np.ndarray
    words: list[bytes]
    counts: np.ndarray  # of these words, of all others, and of words of marks and symbols alone


def _distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """:func:`distance` of a row each."""
    sums_p, sums_q = p.sum(axis=1, keepdims=True), q.sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / sums_p, q / sums_q
        m = (p + q) / 2
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
        found = np.sqrt(np.maximum(0.0, parts.sum(axis=1) / 2))
    return np.where((sums_p[:, 0] > 0) & (sums_q[:, 0] > 0), found, 1.0)


class Languages(dict):
    """References by language, and a text's distances from all of them at once."""

    @cached_property
    def _arrays(self) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray]:
        refs = list(self.values())
        places = {word: i for i, word in enumerate(dict.fromkeys(w for ref in refs for w in ref.words))}
        most = max(len(ref.words) for ref in refs)
        at = np.full((len(refs), most), len(places))  # beyond the last stands for no word
        counts = np.zeros((len(refs), most + 2))
        for i, ref in enumerate(refs):
            at[i, :len(ref.words)] = [places[word] for word in ref.words]
            counts[i, :len(ref.words)], counts[i, most:] = ref.counts[:-2], ref.counts[-2:]
        return places, at, counts, np.array([ref.classes for ref in refs])

    def nearest(self, found: Counter, plain: int, marks: int, histogram: np.ndarray) -> tuple[float, float, int]:
        """The least distance of the words, that of the classes from the same language, and which
        one it is; among equals of the least distance of classes."""
        places, at, counts, classes = self._arrays
        own = np.zeros(len(places) + 1)
        for word, n in found.items():
            place = places.get(word)
            if place is not None:
                own[place] = n
        common = own[at]
        words = np.concatenate([common, plain - common.sum(axis=1, keepdims=True), np.full((len(at), 1), marks)], axis=1)
        by_words = _distances(words, counts)
        by_classes = _distances(np.broadcast_to(histogram, classes.shape), classes)
        best = int(np.lexsort((by_classes, by_words))[0])
        return float(by_words[best]), float(by_classes[best]), best


@dataclass(frozen=True)
class References:
    """Those of the largest languages, and a table (lang, words, counts, classes) of the others;
    none if there are no others."""

    largest: Languages
    others: DataFrame | None


def references(docs: DataFrame, rules: Rules, text_col: str = "text", lang_col: str = "lang") -> References:
    """From all documents; counts are summed up in Spark, and NEAREST languages with common_words
    words each reach the driver."""
    out = "lang string, word binary, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = (batch.column(i).to_pylist() for i in range(2))
            words: dict[str, Counter] = {}
            classes: dict[str, np.ndarray] = {}
            sizes: Counter = Counter()
            for raw, lang in zip(texts, langs):
                if raw and lang is not None:
                    found, plain = words.setdefault(lang, Counter()), plain_words(raw)
                    found.update(plain)
                    found[MARKS_ALONE] += len(raw.split()) - len(plain)
                    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
                    classes[lang] = classes.get(lang, 0) + seen
                    sizes[lang] += 1
            rows = [(lang, w, n) for lang, found in words.items() for w, n in found.items()]
            rows += [(lang, b" %d" % b, int(n)) for lang, seen in classes.items() for b, n in enumerate(seen) if n]
            rows += [(lang, DOCUMENTS, n) for lang, n in sizes.items()]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.binary(), pa.int64()))],
                names=["lang", "word", "n"])

    rows = docs.select(F.encode(text_col, "UTF-8").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = rows.mapInArrow(count, out).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    is_byte = F.substring("word", 1, 1) == F.lit(b" ")  # and the words of marks alone, and the documents
    # a language's commonest words, first of each of many buckets of its words, then of those
    bucket = F.pmod(F.hash("word"), F.lit(256))
    top = lambda *keys: F.row_number().over(
        Window.partitionBy("lang", is_byte, *keys).orderBy(F.desc("n"), "word"))
    few = counts.withColumn("rank", top(bucket))
    totals = counts.groupBy("lang", is_byte.alias("is_byte")).agg(F.sum("n").alias("total"))
    found = (
        few.where((F.col("rank") <= rules.common_words) | is_byte)
        .withColumn("rank", top()).where((F.col("rank") <= rules.common_words) | is_byte)
        .select("lang", "word", "n", is_byte.alias("is_byte"))
        .join(totals, ["lang", "is_byte"]))
    listed = found.groupBy("lang").agg(
        F.collect_list(F.struct("word", "n", "is_byte")).alias("rows"),
        F.coalesce(F.max(F.when(~F.col("is_byte"), F.col("total"))), F.lit(0)).alias("total"))
    kind = "lang string, total long, docs long, words array<binary>, counts array<double>, classes array<double>"

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, words, counts, classes = [], [], [], []
            for own, total in zip(batch.column("rows").to_pylist(), batch.column("total").to_pylist()):
                common = sorted((r for r in own if not r["is_byte"]), key=lambda r: (-r["n"], r["word"]))
                special = {r["word"]: r["n"] for r in own if r["is_byte"]}
                marks, size = special.pop(MARKS_ALONE, 0), special.pop(DOCUMENTS)
                seen = np.zeros(256)
                for word, n in special.items():
                    seen[int(word)] = n
                shares = [r["n"] for r in common]
                docs.append(size)
                words.append([r["word"] for r in common])
                counts.append([*map(float, shares), float(total - sum(shares)), float(marks)])
                classes.append((seen @ CLASSES).tolist())
            numbers = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([
                batch.column("lang"), batch.column("total"), pa.array(docs, pa.int64()),
                pa.array(words, pa.list_(pa.binary())), pa.array(counts, numbers), pa.array(classes, numbers)],
                names=["lang", "total", "docs", "words", "counts", "classes"])

    every = stage(listed.select("lang", "total", "rows").mapInArrow(compact, kind), "references")
    stable = every.where((F.col("total") >= rules.reference_words) & (F.col("docs") >= rules.reference_docs))
    if stable.isEmpty():
        stable = every
    first = stable.orderBy(F.desc("total"), "lang").limit(NEAREST + 1).collect()
    largest = Languages({r.lang: _reference(r.words, r.counts, r.classes) for r in first[:NEAREST]})
    others = None
    if len(first) > NEAREST:
        # what comes before the last of the largest is in there
        last = first[NEAREST - 1]
        others = stable.where(
            (F.col("total") < last.total) | (F.col("total") == last.total) & (F.col("lang") > last.lang),
        ).select("lang", "words", "counts", "classes")
    return References(largest, others)


def _reference(words: list, counts: list, classes: list) -> Reference:
    return Reference(np.array(classes), [bytes(w) for w in words], np.array(counts, float))


_KIND = "struct<lang: string, words: array<binary>, counts: array<double>, classes: array<double>, own: boolean>"


def _with_references(
    docs: DataFrame, lang: Column, text: Column, refs: References, name: str, rules: Rules,
) -> list[DataFrame]:
    """The rows with a column ``name``: the reference of a language beyond the largest, the document's
    own or the nearest of those if it has none; or null."""
    if refs.others is None:
        return [docs.withColumn(name, F.lit(None).cast(_KIND))]
    large = F.coalesce(lang.isin(list(refs.largest)), F.lit(False))

    def others(own: bool) -> DataFrame:
        return refs.others.select(F.struct("lang", "words", "counts", "classes", F.lit(own).alias("own")).alias(name))

    rest = docs.where(~large)
    key, near = f"{name}_row", f"{name}_near"
    without = rest.join(refs.others.select(F.col("lang").alias(near)), lang == F.col(near), "left_anti")
    keyed = stage(without.withColumn(key, F.monotonically_increasing_id()), "without-language")
    nearest = _nearest_beyond(keyed.select(F.col(key).alias("key"), text.alias("text")), refs, rules)
    keyed = keyed.join(nearest.select(F.col("key").alias(key), F.col("lang").alias(near)), key, "left")
    return [
        docs.where(large).withColumn(name, F.lit(None).cast(_KIND)),
        rest.join(others(True), lang == F.col(f"{name}.lang")),
        keyed.join(others(False), F.col(near) == F.col(f"{name}.lang"), "left").drop(key, near)]


def _nearest_beyond(rows: DataFrame, refs: References, rules: Rules) -> DataFrame:
    """Rows (key, text) as key, lang: the nearest language beyond the largest, found by blocks of
    references, each of which goes to all tasks."""
    blocks = -(-refs.others.count() // NEAREST)
    found = None
    for block in range(blocks):
        some = refs.others.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block).orderBy("lang").collect()
        if not some:
            continue
        table = Languages({r.lang: _reference(r.words, r.counts, r.classes) for r in some})

        def hold(batches: Iterator[pa.RecordBatch], table: Languages = table) -> Iterator[pa.RecordBatch]:
            names = list(table)
            for batch in batches:
                held = []
                for key, raw in zip(*(batch.column(i).to_pylist() for i in range(2))):
                    words = (raw or b"").split()
                    if len(words) >= min(rules.class_from, rules.word_from):
                        plain = plain_words(raw)
                        by_words, by_classes, at = table.nearest(
                            Counter(plain), len(plain), len(words) - len(plain),
                            np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES)
                        held.append((key, by_words, by_classes, names[at]))
                kinds = (pa.int64(), pa.float64(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h[i] for h in held], kind) for i, kind in enumerate(kinds)],
                    names=["key", "words", "classes", "lang"])

        part = rows.select("key", F.col("text").cast("binary")).mapInArrow(
            hold, "key long, words double, classes double, lang string")
        found = part if found is None else found.union(part)
    return found.groupBy("key").agg(F.min(F.struct("words", "classes", "lang")).alias("best")).select("key", "best.lang")


def _own_references(column: pa.Array) -> list[tuple[Reference | None, bool]]:
    """The references that come with the rows, and whether they are of the row's own language."""
    known: dict[str, Reference] = {}
    found = []
    for cell in column:
        if not cell.is_valid:
            found.append((None, True))
            continue
        lang = cell["lang"].as_py()
        if lang not in known:
            known[lang] = _reference(*(cell[x].as_py() for x in ("words", "counts", "classes")))
        found.append((known[lang], cell["own"].as_py()))
    return found


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = codes[:n].copy()
    for i in range(1, WINDOW):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += codes[i:n + i]
    order = np.sort(mixed)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(mixed, twice)).tolist()
    windows = Counter(tuple(words[i:i + WINDOW]) for i in at)  # the words themselves decide
    inside = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if windows[tuple(words[i:i + WINDOW])] > 1:
            inside[i] += 1
            inside[i + WINDOW if i + WINDOW <= len(words) else -1] -= 1
    return int((np.cumsum(inside[:-1]) > 0).sum())


MEASURES = [
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
    ("kept", T.BooleanType()), ("class_distance", T.DoubleType()), ("word_distance", T.DoubleType())]


def measure(
    raw: bytes | None, lang: str | None, refs: dict[str, Reference], rules: Rules,
    given: tuple[Reference | None, bool] = (None, True),
) -> tuple:
    """The values of MEASURES for one text. ``given``: a reference that isn't in ``refs``, and whether
    it is of the text's own language or a nearest one."""
    raw = raw or b""
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = len(words)
    chars = int(seen[:128].sum() + seen[192:].sum() - seen[list(SPACES)].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = repeated_words(words)
    failed = n < rules.least_words or 100 * repeated > round(100 * rules.most_repeated) * n
    classes = counts = None
    more, is_own = given
    own = refs.get(lang) or (more if is_own else None)
    if n >= min(rules.class_from, rules.word_from) and (own or refs):
        histogram, plain = seen @ CLASSES, plain_words(raw)
        found = Counter(plain)

        def from_one(ref: Reference) -> tuple[float, float]:
            common = [found[word] for word in ref.words]
            return (distance(np.array([*common, len(plain) - sum(common), n - len(plain)], float), ref.counts),
                    distance(histogram, ref.classes))

        if own:
            counts, classes = from_one(own)
        else:
            counts, classes, _ = refs.nearest(found, len(plain), n - len(plain), histogram)
            if more:
                counts, classes = min((counts, classes), from_one(more))
    kept = not failed
    if classes is not None and n >= rules.class_from:
        kept &= classes <= rules.class_base + rules.class_scatter / n ** 0.5
    if counts is not None and n >= rules.word_from:
        kept &= counts <= rules.word_base + rules.word_scatter / n ** 0.5
    return (n, chars, int(seen[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated, failed, kept, classes, counts)


def quality(
    docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """A row per document: doc_id and MEASURES.

    Null or empty text: no words, failed. Null language, or one too small for a stable reference: held
    against the nearest reference. Distances are null where none is taken. Repeated rows get the same row each; an empty table gives none.
    """
    refs = references(docs, rules, text_col, lang_col)
    out = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), *(T.StructField(*m) for m in MEASURES)])
    kinds = [f.dataType for f in out.fields[1:]]

    largest = refs.largest

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = {"long": pa.int64(), "bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        for batch in batches:
            texts, langs = (batch.column(i).to_pylist() for i in (1, 2))
            rows = [measure(raw, lang, largest, rules, given)
                    for raw, lang, given in zip(texts, langs, _own_references(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(
                pa.array([r[i] for r in rows], arrow[kind.simpleString()]) for i, kind in enumerate(kinds))],
                names=out.names)

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.encode(text_col, "UTF-8").alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    parts = _with_references(rows, F.col("_lang"), F.col("_text"), refs, "_reference", rules)
    judged = [part.mapInArrow(judge, out) for part in parts]
    return reduce(DataFrame.unionAll, judged)


def kept_documents(
    docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the rules keep."""
    refs = references(docs, rules, text_col, lang_col)
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    largest = refs.largest

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = [name for name, _ in MEASURES].index("kept")
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            langs = batch.column(lang_at).cast(pa.string()).to_pylist()
            given = _own_references(batch.column(batch.num_columns - 1))
            rows = batch.select(range(batch.num_columns - 1))
            yield rows.filter(pa.array(
                [measure(raw, lang, largest, rules, one)[verdict] for raw, lang, one in zip(texts, langs, given)], pa.bool_()))

    lang = F.col(lang_col).cast("string")
    parts = _with_references(docs, lang, F.col(text_col), refs, new_name(docs), rules)
    return reduce(DataFrame.unionAll, [part.mapInArrow(keep, docs.schema) for part in parts])
