"""Alignment of two tokenizers' tokens, with corpus-wide counts of linked id pairs.

Both tokenizers cut the bytes of a text. Where a token of each ends at the same byte, the two are
linked, and the tokens since the last such byte are a group. The first pass counts the links of
each pair of ids. The distinct pairs are numbered by a minimal perfect hash; the counts become
dense vectors indexed by it, which are added up along a tree. The second pass aligns the
documents again and looks the counts up, with the pair kept under a number to verify it.

Linked tokens end alike, so one's bytes end the other's: the vocabularies alone bound the
number of distinct pairs (:func:`pair_bound`, some hundred thousand), and with it all that is
broadcast or comes to the driver, whatever the corpus.

Texts fall into units, parted at blanks and line breaks between other characters, where
neither tokenizer's tokens reach across; each worker keeps the alignments of those that it met several
times.
"""

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from ohlcraft.llm import tokens
from ohlcraft.llm.common import stage
from ohlcraft.llm.perfect_hash import PerfectHash, mixed

PIECE_BPE = "piece_bpe_32k.model"
#: Units a worker keeps, about; beyond that it forgets all and starts anew.
KEPT_UNITS = 150_000
#: Units encoded in one call.
UNITS_A_CALL = 20_000
#: Parts of the perfect hash; a pair's part is a hash of it.
PARTS = 16
_PART_SEED = 1 << 20
#: Vectors that one step of the tree adds up.
FAN_IN = 16
#: Pairs a task gathers before it adds equal ones up.
GATHERED = 4_000_000

_WHITE = tokens._SPACE
_ODD = f"{tokens._NEIGHBOURS}|{_WHITE}\\z"
_DARK = f"[^{_WHITE[1:]}"
_PARTING = re.compile(f"(?<={_DARK})[ \n](?={_DARK})")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes stand
    for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_tokens(tokenizer: Tokenizer) -> list[bytes]:
    alphabet = byte_alphabet()
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes(alphabet[c] for c in name if c in alphabet) for name in names]


def piece_tokens(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.vocab_size())]


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs there are of a token of each that end alike."""
    def ends(shorter: Counter, longer: Counter, whole: bool) -> int:
        return sum(n * shorter[token[i:]] for token, n in longer.items()
                   for i in range(0 if whole else 1, len(token)))
    counts_a, counts_b = Counter(a), Counter(b)
    return ends(counts_a, counts_b, True) + ends(counts_b, counts_a, False)


class Unit(NamedTuple):
    """An aligned unit: tokens of each kind, the pairs linked, and its groups in decimal, each
    with a mark after it. ``same``: the tokens' bytes are the unit's."""
    n_a: int
    n_b: int
    pairs: bytes
    groups: bytes
    same: bool = True


@dataclass
class Slice:
    """Some documents as runs of units: ``at[bounds[i]:bounds[i + 1]]`` numbers those of
    document i. ``same``: whether the bytes of all its units are those of its text."""
    units: list[Unit]
    at: np.ndarray
    bounds: np.ndarray
    same: np.ndarray


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self._a, self._b = tokens.load(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self._a.encode_special_tokens = True
        self.bytes_a, self.bytes_b = byte_tokens(self._a), piece_tokens(self._b)
        self.size_b = len(self.bytes_b)
        self._len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self._len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self._blank = self._b.piece_to_id("▁")
        # what an id is written as, and from the size of the vocabulary on as the last of its group
        self._text_a = [f"{i}{mark}".encode() for mark in ",|" for i in range(len(self.bytes_a))]
        self._text_b = [f"{i}{mark}".encode() for mark in ",;" for i in range(self.size_b)]
        self._texts = np.array(self._text_a + self._text_b, dtype=object)
        self._text_sizes = np.array([len(t) for t in self._texts], np.int64)
        self._plain: dict[str, Unit] = {}

    def _ids_a(self, units: list[str], joinable: bool) -> np.ndarray:
        whole = ["".join(units)] if joinable else units
        found = self._a.encode_batch_fast(whole, add_special_tokens=False)
        return np.array([i for one in found for i in one.ids], np.int64)

    def _ids_b(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units in turn, and how many each has."""
        # the model puts a blank before what it is given; before a line break it stands alone
        found = self._b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        counts = np.array([len(ids) for ids in found], np.int64)
        ids = np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum()))
        broken = np.array([u[0] != " " for u in units], bool)
        blanks = (np.cumsum(counts) - counts)[broken]
        if (ids[blanks] != self._blank).any():
            raise ValueError("not a tokenizer that puts a blank before a text")
        return np.delete(ids, blanks), counts - broken

    def _aligned(self, units: list[str], joinable: bool) -> list[Unit]:
        """Units as they stand in the text, with the blank or line break before them; joined
        they are a text of the same units if they are ``joinable``."""
        raw = "".join(units).encode()
        sizes = pc.binary_length(pa.array(units, pa.string())).to_numpy().astype(np.int64)
        unit_ends = np.cumsum(sizes)
        a, (b, n_b) = self._ids_a(units, joinable), self._ids_b(units)
        ends_a, of_b = np.cumsum(self._len_a[a]), np.repeat(np.arange(len(units)), n_b)
        own_b = np.bincount(of_b, self._len_b[b], minlength=len(units)).astype(np.int64)
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != raw:
            raise ValueError("not a tokenizer of bytes")
        same = own_b == sizes
        if b"".join([self.bytes_b[i] for i in b.tolist()]) != raw:
            at_b = np.cumsum(n_b) - n_b
            for i in np.flatnonzero(same).tolist():
                mine = b"".join([self.bytes_b[x] for x in b[at_b[i]:at_b[i] + n_b[i]].tolist()])
                same[i] = mine == raw[unit_ends[i] - sizes[i]:unit_ends[i]]
        of_a = np.searchsorted(unit_ends, ends_a)
        if not same.all():
            a, b, of_a, of_b = a[same[of_a]], b[same[of_b]], of_a[same[of_a]], of_b[same[of_b]]
        ends_a, ends_b = np.cumsum(self._len_a[a]), np.cumsum(self._len_b[b])
        marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.int8)
        marks[ends_a] += 1
        marks[ends_b] += 2
        cut_a, cut_b = marks[ends_a] == 3, marks[ends_b] == 3
        last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        pairs = (a[last_a] * self.size_b + b[last_b]).tobytes()
        # a group's tokens of the first kind, then those of the second
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        written = np.empty(len(a) + len(b), np.int64)
        before_b = np.concatenate([[0], last_b + 1])
        written[np.arange(len(a)) + before_b[group_a]] = a + len(self.bytes_a) * cut_a
        written[np.arange(len(b)) + last_a[group_b] + 1] = b + self.size_b * cut_b + len(self._text_a)
        text = b"".join(self._texts[written].tolist())
        text_ends = np.concatenate([[0], np.cumsum(self._text_sizes[written])])

        def bounds(counts: np.ndarray) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(counts)])

        n_a = np.bincount(of_a, minlength=len(units))
        n_b = np.bincount(of_b, minlength=len(units))
        links = (8 * bounds(np.bincount(of_a[last_a], minlength=len(units)))).tolist()
        texts = text_ends[bounds(n_a + n_b)].tolist()
        return [Unit(*values) for values in zip(
            n_a.tolist(), n_b.tolist(), [pairs[x:y] for x, y in zip(links, links[1:])],
            [text[x:y] for x, y in zip(texts, texts[1:])], same.tolist())]

    def _learn(self, names: list[str], plain: bool) -> dict[str, Unit]:
        new: dict[str, Unit] = {"": Unit(0, 0, b"", b"")}
        names = [name for name in names if name]
        for first in range(0, len(names), UNITS_A_CALL):
            some = names[first:first + UNITS_A_CALL]
            whole = [n if n[0] == "\n" else f" {n}" for n in some] if plain else some
            new.update(zip(some, self._aligned(whole, plain)))
        return new

    def align(self, texts: pa.Array) -> Slice:
        """Whole texts; null and empty ones have no units."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, _ODD)
        spaced = pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n")
        names, at, bounds = tokens.distinct_units(pc.split_pattern(spaced, " "))
        units = tokens.looked_up(self._plain, names, at, lambda some: self._learn(some, True), KEPT_UNITS)
        places = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        if places:
            numbers: dict[str, int] = {}
            runs = [at[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            for i in places:
                text = texts[i].as_py()
                cuts = [0, *(m.start() for m in _PARTING.finditer(text)), len(text)]
                parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
                parts[0] = f" {parts[0]}"
                runs[i] = np.array([len(units) + numbers.setdefault(p, len(numbers)) for p in parts])
            odd_units = self._learn(list(numbers), False)
            units = units + [odd_units[name] for name in numbers]
            at, bounds = np.concatenate(runs), np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        wrong = np.array([not unit.same for unit in units])
        wrongs = np.concatenate([[0], np.cumsum(wrong[at])])[bounds]
        return Slice(units, at, bounds, wrongs[1:] == wrongs[:-1])


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner; made once per Python process."""
    key = ("aligner", path_a, path_b)
    if key not in tokens.kept():
        tokens.kept()[key] = Aligner(path_a, path_b)
    return tokens.kept()[key]


def _pairs_of(units: list[Unit]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of the units in turn, and how many each has."""
    return (np.frombuffer(b"".join([u.pairs for u in units]), np.int64),
            np.array([len(u.pairs) // 8 for u in units], np.int64))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Equal pairs added up."""
    pairs, where = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, where, np.concatenate([n for _, n in parts]))
    return pairs, counts


class PairTable:
    """Perfect hashes of the parts, the pairs in the order of their numbers, and values."""

    def __init__(self, parts: list[tuple[list[int], bytes, bytes]]) -> None:
        """Of each part: sizes of levels, bits, pairs."""
        keys = [np.frombuffer(pairs, np.int64) for _, _, pairs in parts]
        self.keys = np.concatenate([*keys, np.zeros(0, np.int64)])
        self.starts = np.cumsum([0, *(len(k) for k in keys)])
        self._hashes = [PerfectHash(sizes, np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool))
                        for sizes, bits, _ in parts]

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of pairs; -1 for those that are not in the table."""
        part = part_of(pairs)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(PARTS + 1))
        found = np.full(len(pairs), -1, np.int64)
        for i, hashed in enumerate(self._hashes):
            own = order[edges[i]:edges[i + 1]]
            if not len(own) or self.starts[i + 1] == self.starts[i]:
                continue
            numbers = hashed.numbers(pairs[own])
            at = self.starts[i] + numbers
            right = (numbers >= 0) & (self.keys[np.maximum(at, 0)] == pairs[own])
            found[own] = np.where(right, at, -1)
        return found


def part_of(pairs: np.ndarray) -> np.ndarray:
    return (mixed(pairs, _PART_SEED) % np.uint64(PARTS)).astype(np.int64)


def pair_counts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """The first pass: rows (part, pair, n), one per task and pair."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alike = aligner(path_a, path_b)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for a, b in tokens.slices(batch.column(0)):
                found = alike.align(batch.column(0).slice(a, b - a))
                of_good = np.repeat(found.same, np.diff(found.bounds))
                times = np.bincount(found.at[of_good], minlength=len(found.units))
                pairs, lengths = _pairs_of(found.units)
                held.append((pairs, np.repeat(times, lengths)))
                if sum(len(p) for p, _ in held) > GATHERED:
                    held = [_added(held)]
        if held:
            pairs, counts = _added(held)
            pairs, counts = pairs[counts > 0], counts[counts > 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part_of(pairs)), pa.array(pairs), pa.array(counts)], names=["part", "pair", "n"])

    return docs.select(text_col).mapInArrow(count, "part long, pair long, n long")


def hashed_pairs(counts: DataFrame) -> DataFrame:
    """A row per part: its perfect hash and its distinct pairs in the order of their numbers."""
    def build(group: pa.Table) -> pa.Table:
        pairs = group["pair"].to_numpy()
        hashed = PerfectHash.of(pairs)
        ordered = np.empty_like(pairs)
        ordered[hashed.numbers(pairs)] = pairs
        return pa.table({
            "part": group["part"][:1], "sizes": pa.array([hashed.sizes], pa.list_(pa.int64())),
            "bits": pa.array([np.packbits(hashed.bits).tobytes()], pa.binary()),
            "pairs": pa.array([ordered.tobytes()], pa.binary())})

    return counts.select("part", "pair").distinct().groupBy("part").applyInArrow(
        build, "part long, sizes array<long>, bits binary, pairs binary")


def summed_vectors(counts: DataFrame, table) -> np.ndarray:
    """Counts by number: each task makes a dense vector of its rows, cut by parts, and the
    vectors of a part are added up ``FAN_IN`` at a time. ``table``: a broadcast of what
    :class:`PairTable` takes."""
    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = PairTable(table.value)
        total = np.zeros(len(known.keys), np.int64)
        for batch in batches:
            numbers = known.numbers(batch.column(0).to_numpy())
            if (numbers < 0).any():
                raise ValueError("a pair is not in the table")
            np.add.at(total, numbers, batch.column(1).to_numpy())
        if total.any():
            node = TaskContext.get().partitionId()
            vectors = [total[a:b].tobytes() for a, b in zip(known.starts, known.starts[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(vectors)), pa.int64()), pa.array([node] * len(vectors), pa.int64()),
                pa.array(vectors, pa.binary())], names=["part", "node", "vector"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), np.int64) for v in group["vector"])
        return pa.table({"part": group["part"][:1], "node": group["node"][:1],
                         "vector": pa.array([total.tobytes()], pa.binary())})

    kind = "part long, node long, vector binary"
    vectors = stage(counts.select("pair", "n").mapInArrow(dense, kind), "vectors")
    while vectors.agg(F.max("node")).first()[0]:
        nodes = vectors.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("long"))
        vectors = stage(nodes.groupBy("part", "node").applyInArrow(add, kind), "vectors")
    found = {row.part: np.frombuffer(row.vector, np.int64) for row in vectors.collect()}
    return np.concatenate([*(found[part] for part in sorted(found)), np.zeros(0, np.int64)])


def align_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
    path_b: str | None = None,
) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the
    highest of their second id's), count_sum, groups_sha256.

    Null and empty texts, and those that the tokens' bytes don't give back, have zeros and an
    empty string. Strings of special tokens are ordinary text. Repeated ids and null ids
    give their rows each; an empty table gives none; other columns are not read.
    """
    path_a = path_a or public_tokenizers.path(tokens.BYTE_BPE)
    path_b = path_b or public_tokenizers.path(PIECE_BPE)
    context = docs.sparkSession.sparkContext
    counts = stage(pair_counts(docs, path_a, path_b, text_col), "pair-counts")
    rows = sorted(hashed_pairs(counts).collect())
    by_part = {row.part: (row.sizes, bytes(row.bits), bytes(row.pairs)) for row in rows}
    parts = [by_part.get(i, ([], b"", b"")) for i in range(PARTS)]
    vector = summed_vectors(counts, context.broadcast(parts))
    pairs = PairTable(parts).keys
    second = pairs % sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size()
    highest = np.zeros(int(second.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, second, vector)
    told = context.broadcast((parts, vector, vector == highest[second]))
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    out = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType),
        *(T.StructField(name, T.LongType()) for name in numbers), T.StructField("groups_sha256", T.StringType())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alike, (own, counted, best) = aligner(path_a, path_b), told.value
        known = PairTable(own)
        for batch in batches:
            for a, b in tokens.slices(batch.column(1)):
                found = alike.align(batch.column(1).slice(a, b - a))
                links, lengths = _pairs_of(found.units)
                at = known.numbers(links)
                ends = np.concatenate([[0], np.cumsum(lengths)])

                def by_unit(values: np.ndarray) -> np.ndarray:
                    return np.diff(np.concatenate([[0], np.cumsum(values)])[ends])

                # links of units that occur only in texts without tokens are not counted
                hit = at >= 0
                n_links = lengths
                per_unit = [
                    np.array([u.n_a for u in found.units], np.int64), np.array([u.n_b for u in found.units], np.int64),
                    n_links, n_links, by_unit(hit & best[at]) if len(best) else 0 * n_links,
                    by_unit(np.where(hit, counted[at], 0)) if len(counted) else 0 * n_links]
                columns = []
                for values in per_unit:
                    sums = np.concatenate([[0], np.cumsum(values[found.at])])[found.bounds]
                    columns.append(np.where(found.same, np.diff(sums), 0))
                groups = [unit.groups for unit in found.units]
                digests = []
                for i, (first, last) in enumerate(zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist())):
                    text = b"".join([groups[j] for j in found.at[first:last].tolist()]) if found.same[i] else b""
                    digests.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), *(pa.array(c.astype(np.int64)) for c in columns),
                    pa.array(digests, pa.string())], names=out.names)

    return docs.select(id_col, text_col).mapInArrow(look_up, out)
