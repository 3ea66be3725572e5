"""Near-duplicates by banded MinHash and sequential Bayesian verification (Satuluri and
Parthasarathy, 2012).

A document's set of word shingles gets a MinHash signature; bands of its values bring similar
documents into common buckets. A candidate pair is compared batch by batch of its signatures:
once the posterior chance that its similarity reaches the bound falls below the miss
probability, it is dropped. What survives is verified on the full sets.

Links matter only as far as they join components, and a bucket may hold any share of all
documents, so its pairs are not all formed. Rows with equal sets are one class from the
start, whatever their ids; a class bears the number of one of its rows, as an id may stand by
several texts. In a few rounds each bucket compares its members with one of them; then
the buckets that still hold several components compare every member outside their largest
one with all others, block by block. No pair of a bucket is left out unless its members are in
one component already.
"""

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ohlcraft.llm.common import new_name, rows_a_batch, stage
from ohlcraft.llm.components import components

BANDS, BAND_ROWS = 32, 5
SIGNATURE = BANDS * BAND_ROWS
#: Signature values compared at a time.
BATCH = 32
MISS = 1e-6
#: Rounds in which a bucket's members meet one of them.
STAR_ROUNDS = 3
#: Texts, sets or pairs of sets handed to a Python task at once.
DOCUMENTS_A_BATCH = 1000
#: Members of a bucket in a block.
BLOCK = 128

_RNG = np.random.Generator(np.random.PCG64(20_012))
_FACTORS = _RNG.integers(0, 2 ** 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2 ** 63, SIGNATURE, dtype=np.uint64)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(raw: bytes | None, width: int) -> np.ndarray:
    """64-bit hashes of a text's distinct shingles, sorted. With fewer words than ``width`` the
    whole sequence is one; without words there is none."""
    words = (raw or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    long = min(width, len(words))
    n = len(words) - long + 1
    found = codes[:n].copy()
    for i in range(1, long):
        found = _mixed(found) * _SPREAD + codes[i:n + i]
    return np.unique(_mixed(found + np.uint64(long)))


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(shingles), 512):
        some = shingles[first:first + 512, None] * _FACTORS + _SHIFTS
        np.minimum(least, some.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def band_keys(sign: np.ndarray) -> np.ndarray:
    rows = sign.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_ROWS):
        keys = _mixed(keys) * _SPREAD + rows[:, i]
    return _mixed(keys).view(np.int64)


def least_matches(bound: float, miss: float = MISS) -> list[int]:
    """For 0, BATCH, 2 * BATCH ... compared values, the matches below which a pair is dropped:
    with a uniform prior, the chance of a similarity of at least ``bound`` given k matches of n
    is that of at most k successes in n + 1 trials at ``bound``."""
    found = []
    for n in range(0, SIGNATURE + 1, BATCH):
        chance, k = 0.0, 0
        while True:
            chance += comb(n + 1, k) * bound ** k * (1 - bound) ** (n + 1 - k)
            if chance >= miss or k == n:
                break
            k += 1
        found.append(k)
    return found


def surviving(left: np.ndarray, right: np.ndarray, limits: list[int]) -> np.ndarray:
    """Of pairs of signatures, row by row, the places of those that no batch drops."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for step, limit in enumerate(limits[1:]):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches += (left[alive, part] == right[alive, part]).sum(axis=1)
        on = matches >= limit
        alive, matches = alive[on], matches[on]
    return alive


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Of rows (doc_id, text): doc_id, digest, n_shingles, set_key, signature, bands; the last
    three null without shingles."""
    out = T.StructType([
        docs.schema["doc_id"], T.StructField("digest", T.BinaryType()), T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType()),
        T.StructField("signature", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, signs, bands = [], [], [], []
            for raw in batch.column(2):
                shingles = shingle_set(raw.as_py(), width)
                sizes.append(len(shingles))
                sign = signature(shingles) if len(shingles) else None
                keys.append(None if sign is None else xxhash.xxh3_128_digest(shingles.tobytes()))
                signs.append(None if sign is None else sign.tobytes())
                bands.append(None if sign is None else band_keys(sign))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=out.names)

    return docs.select("doc_id", _digest(F.col("text")), F.encode("text", "UTF-8")).mapInArrow(sketch, out)


def _digest(text: Column) -> Column:
    """Tells the texts of one id apart; null for a null text."""
    return F.unhex(F.md5(text))


def _likely(pairs: DataFrame, signs: DataFrame, bound: float) -> DataFrame:
    """Of pairs (a, b), those that the signatures don't rule out."""
    limits = least_matches(bound)
    out = pairs.select("a", "b").schema

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, SIGNATURE) for i in (2, 3))
            yield batch.select(["a", "b"]).take(pa.array(surviving(left, right, limits)))

    return (
        pairs.join(signs.select(F.col("class_id").alias("a"), F.col("signature").alias("sign_a")), "a")
        .join(signs.select(F.col("class_id").alias("b"), F.col("signature").alias("sign_b")), "b")
        .select("a", "b", "sign_a", "sign_b").mapInArrow(prune, out))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets reach the bound."""
    out = pairs.select("a", "b").schema

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for i in range(len(batch)):
                a, b = (np.frombuffer(batch.column(j)[i].as_buffer(), np.uint64) for j in (2, 3))
                common = _meeting(a, b)
                linked.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    ratio = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    of = lambda x: sets.select(
        F.col("class_id").alias(x), F.col("shingles").alias(f"set_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    return (
        pairs.join(of("a"), "a").join(of("b"), "b").where(ratio)
        .select("a", "b", "set_a", "set_b").mapInArrow(verify, out))


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """Of rows (text): set_key, n_shingles, shingles."""
    out = T.StructType([
        T.StructField("set_key", T.BinaryType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("shingles", T.BinaryType())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(raw.as_py(), width) for raw in batch.column(0)]
            yield pa.RecordBatch.from_arrays([
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array(map(len, sets), pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary())], names=out.names)

    return texts.select(F.encode("text", "UTF-8")).mapInArrow(collect, out)


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component so far."""
    return members.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn(
        "component", F.coalesce("component", "class_id"))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets of three or more that hold several components; a bucket of two
    is settled by its first round."""
    rows = _labelled(members, labels)
    several = rows.groupBy("bucket").agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.count(F.lit(1)).alias("n")).where("least < most AND n > 2").select("bucket", "n")
    return rows.join(several, "bucket")


def _star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """A drawn member of each bucket with each one that isn't in its component."""
    drawn = F.struct(
        (F.lit(0).cast("long") if turn == 0 else F.xxhash64("class_id", F.lit(turn))).alias("draw"),
        "class_id", "component")
    pivots = rows.groupBy("bucket").agg(F.min(drawn).alias("pivot"))
    pairs = rows.join(pivots, "bucket").where("component <> pivot.component")
    ids = [F.col("class_id"), F.col("pivot.class_id")]
    return pairs.select(F.least(*ids).alias("a"), F.greatest(*ids).alias("b")).distinct()


def _meeting(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(b.searchsorted(a), len(b) - 1)
    return int((b[at] == a).sum())


def _block_links(rows: DataFrame, signs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of open buckets: every member outside the bucket's largest
    component against all members of other components, by blocks. A block goes through its
    likely pairs, the likeliest first, verifies those that nothing has joined yet on their
    full sets, and gives the links alone: no more than it has components."""
    limits = least_matches(percent / 100)
    largest = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size")).groupBy("bucket").agg(
        F.max_by("component", F.struct("size", "component")).alias("largest"))
    rows = rows.join(largest, "bucket").join(signs.select("class_id", "signature"), "class_id").join(
        sets.select("class_id", "shingles"), "class_id")
    # class ids spread a bucket over blocks of about BLOCK members
    block = F.pmod(F.xxhash64("class_id", "bucket"), F.ceil(F.col("n") / BLOCK))
    rows = stage(rows.select(
        "bucket", "band", block.alias("block"), (F.col("component") == F.col("largest")).alias("inside"),
        F.struct("class_id", "component", "signature", "shingles").alias("member")), "blocks")
    blocks = rows.groupBy("bucket", "block").agg(F.collect_list("member").alias("right"))
    apart = rows.where("NOT inside").groupBy("bucket", "band", "block").agg(F.collect_list("member").alias("left"))
    out = T.StructType([T.StructField(x, signs.schema["class_id"].dataType) for x in "ab"])

    def columns(cell: pa.ListScalar) -> tuple:
        ids, parts, raw, sets = cell.values.flatten()
        signs = np.frombuffer(b"".join(raw.to_pylist()), "<u4").reshape(-1, SIGNATURE)
        return ids, np.array(parts.to_pylist()), signs, [np.frombuffer(x.as_buffer(), np.uint64) for x in sets]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, lefts, rights in zip(batch.column("band").to_pylist(), batch.column("left"), batch.column("right")):
                ids, parts, signs, own = columns(lefts)
                other_ids, other_parts, other_signs, others = columns(rights)
                i, j = np.nonzero(parts[:, None] != other_parts)
                if not len(i):
                    continue
                on = surviving(signs[i], other_signs[j], limits)
                i, j = i[on], j[on]
                equal = signs[i] == other_signs[j]
                # a pair counts in the first of the bands that it shares
                shared = equal.reshape(-1, BANDS, BAND_ROWS).all(axis=2)
                on = np.flatnonzero(shared.argmax(axis=1) == band)
                on = on[np.argsort(-equal[on].sum(axis=1), kind="stable")]
                joined: dict = {}

                def root(part):
                    while part in joined:
                        part = joined[part]
                    return part

                found = []
                for a, b in zip(i[on].tolist(), j[on].tolist()):
                    x, y = root(parts[a]), root(other_parts[b])
                    if x == y:
                        continue
                    common = _meeting(own[a], others[b])
                    if 100 * common >= percent * (len(own[a]) + len(others[b]) - common):
                        joined[x] = y
                        found.append((a, b))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([a for a, _ in found])), other_ids.take(pa.array([b for _, b in found]))],
                        names=["a", "b"])

    return apart.drop("block").join(blocks.drop("block"), "bucket").select("band", "left", "right").mapInArrow(compare, out)


def _verdicts(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of rows (doc_id, text), a row each: doc_id, digest, n_shingles, component_id, kept, and
    ``first``, true for one row of each component and for rows that take no part."""
    with rows_a_batch(docs.sparkSession, DOCUMENTS_A_BATCH):
        return _classed(docs, width, percent)


def _classed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    bound = percent / 100
    drawn = stage(sketches(docs, width).withColumn("row", F.monotonically_increasing_id()), "sketches")
    some = drawn.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = stage(
        some.groupBy("set_key").agg(F.min(F.struct("doc_id", "row")).alias("least"))
        .select("set_key", F.col("least.row").alias("class_id"), F.col("least.doc_id").alias("least_id")), "classes")
    firsts = some.join(classes, "set_key").where(F.col("row") == F.col("class_id")).select(
        "class_id", "doc_id", "set_key", "signature", "bands")
    buckets = firsts.select("class_id", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.groupBy("bucket").agg(
        F.min("class_id").alias("least"), F.max("class_id").alias("most")).where("least < most").select("bucket")
    members = stage(buckets.join(shared, "bucket"), "members")
    ids = stage(members.select("class_id").distinct(), "candidates")
    signs = stage(firsts.join(ids, "class_id").select("class_id", "doc_id", "set_key", "signature"), "signatures")
    # an id's other texts come along here; their sets are no candidates or have a class of their own
    texts = docs.join(signs.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = stage(
        _sets(texts, width).dropDuplicates(["set_key"]).join(signs.select("set_key", "class_id"), "set_key").drop("set_key"),
        "sets")

    found = []
    labels = None
    for turn in range(STAR_ROUNDS + 1):
        if turn == 0:
            rows = members.withColumn("component", F.col("class_id"))
        else:
            rows = stage(_open(members, labels), "open")
            if rows.isEmpty():
                break
        if turn < STAR_ROUNDS:
            likely = stage(_likely(_star_pairs(rows, turn), signs, bound), "likely")
            verified = _verified(likely, sets, percent)
        else:
            verified = _block_links(rows, signs, sets, percent)
        found.append(stage(verified, "verified"))
        links = found[0]
        for more in found[1:]:
            links = links.union(more)
        labels = components(links)

    # a component is named by its smallest id, at the smallest row that bears it
    linked = labels.join(classes.withColumnRenamed("class_id", "node"), "node")
    names = linked.groupBy("component").agg(F.min(F.struct(
        F.col("least_id").alias("id"), F.col("node").alias("row"))).alias("name"))
    named = labels.join(names, "component").select(F.col("node").alias("class_id"), "name")
    named = classes.join(named, "class_id", "left").select(
        "set_key", "class_id", F.coalesce("name.id", "least_id").alias("component_id"),
        F.coalesce("name.row", "class_id").alias("first_row"))
    result = drawn.select("doc_id", "digest", "row", "n_shingles", F.when(
        F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(named, "set_key", "left")
    apart = F.col("component_id").isNull()
    own = (F.col("doc_id") == F.col("component_id")) & (F.col("class_id") == F.col("first_row"))
    return result.select(
        "doc_id", "digest", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        (apart | own).alias("kept"), (apart | (F.col("row") == F.col("first_row"))).alias("first"))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if the Jaccard similarity of their sets of ``width``-word shingles is at
    least ``percent`` / 100; a component is named by its smallest id, and that document is kept.
    ASCII letters count as lower case.

    Null or empty texts and texts without words have no shingles and link with nothing. Null id:
    takes no part, component null, kept. Repeated ids: each row goes by its own text, so that
    one id may be in several components, and two components may have one name; of the texts of
    a component's smallest id one set is kept. Empty table: no rows. Other columns are not
    read. Chance of a missed pair at the bound: about 3e-6 by the bands, at most MISS per batch
    by the signatures.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _verdicts(docs, width, percent).select("doc_id", "n_shingles", "component_id", "kept")


def kept_documents(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One document of each group, all columns as they are; of rows with one id and text, one.

    Rows with a null id stay. The rows to drop are joined, not those to keep: most stay.
    """
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    verdicts = stage(_verdicts(known, width, percent).select("doc_id", "digest", "first"), "verdicts")
    name = new_name(docs)
    key = lambda doc_id, digest: F.struct(doc_id.alias("id"), F.coalesce(digest, F.lit(b"")).alias("digest"))
    texts = verdicts.where("doc_id IS NOT NULL").groupBy(key(F.col("doc_id"), F.col("digest")).alias(name)).agg(
        F.max("first").alias("stays"), F.count(F.lit(1)).alias("n"))
    changed = stage(texts.where("NOT stays OR n > 1"), "repeated")
    keyed = docs.withColumn(name, key(F.col(id_col), _digest(F.col(text_col))))
    single = keyed.join(changed, name, "left_anti")
    return single.union(keyed.join(changed.where("stays"), name, "left_semi").dropDuplicates([name])).drop(name)
