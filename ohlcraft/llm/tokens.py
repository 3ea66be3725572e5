"""Token ids of whole texts by BPE files of the ``tokenizers`` library.

A text falls into units that are encoded alike wherever they stand: a word with the space or
line break before it. Most units of a corpus repeat, so each worker keeps the ids of the units
it met and encodes only new ones, many in one call. By byte-level BPE, texts that begin with or hold
neighbouring white space, where a unit depends on another, are encoded directly.
"""

import os
import re
import sys
import types
import unicodedata
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
#: Units a worker keeps, about; beyond that it forgets all and starts anew. It changes no ids.
KEPT_UNITS = 300_000
#: Units encoded in one call.
UNITS_A_CALL = 5_000

# every character that the pre-tokenizer or Python takes for white space
_SPACE = "[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_NEIGHBOURS = f"^{_SPACE}|{_SPACE}{_SPACE}"
_KEPT = "ohlcraft_kept"


def kept() -> dict:
    """What this Python process keeps from task to task. A task may bring its own copy of this
    module, whose globals go with it; so they are held under a module name of their own."""
    return vars(sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)))


def load(path: str) -> Tokenizer:
    """A tokenizer that keeps to the one core of its task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def default_path() -> str:
    return public_tokenizers.path(BYTE_BPE)


def encoder(path: str, plain: bool = True) -> "Encoder":
    """The worker's encoder of a byte-level file; loaded once per Python process."""
    key = ("bytes", path, plain)
    if key not in kept():
        kept()[key] = Encoder(path, plain)
    return kept()[key]


def word_encoder(path: str) -> "WordEncoder":
    """The worker's encoder of a file that drops white space; loaded once per Python process."""
    if ("words", path) not in kept():
        kept()["words", path] = WordEncoder(path)
    return kept()["words", path]


def distinct_units(lists: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct strings of lists, the number of each place's string, and the lists' bounds."""
    units = lists.flatten().dictionary_encode()
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    return units.dictionary.to_pylist(), units.indices.to_numpy(), bounds.astype(np.int64)


def looked_up(
    known: dict, names: list[str], at: np.ndarray, learn: Callable[[list[str]], dict], most: int | None = None,
) -> list:
    """What is known of the names, ``at`` being the places of each in the texts; the others are
    learnt, and of these the ones with several places are kept."""
    values = list(map(known.get, names))
    if None in values:
        new = learn([name for name, value in zip(names, values) if value is None])
        values = [new[name] if value is None else value for name, value in zip(names, values)]
        if len(known) > (most or KEPT_UNITS):
            known.clear()
        often = np.flatnonzero(np.bincount(at, minlength=len(names)) > 1).tolist()
        known.update((names[i], values[i]) for i in often)
    return values


def gathered(ids: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the units numbered ``at``, one after the other, and where each unit's ids
    begin, with their end."""
    pool = np.frombuffer(b"".join(ids), "<u4")
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[at]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    whence = np.repeat(starts[at] - ends[:-1], lengths)
    whence += np.arange(len(whence))
    return pool[whence], ends


class Encoder:
    """``plain``: strings of special tokens in a text count as ordinary text, else they get
    their own ids."""

    def __init__(self, path: str, plain: bool = True) -> None:
        self._tokenizer = load(path)
        self._tokenizer.encode_special_tokens = plain
        specials = [] if plain else [
            re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._odd = "|".join([_NEIGHBOURS, *specials])
        names = [self._tokenizer.id_to_token(i) or "" for i in range(self._tokenizer.get_vocab_size())]
        # in the byte alphabet a name has a character per byte; the space and line break:
        space, newline = "Ġ", "Ċ"
        self.n_bytes = np.array([len(name) for name in names], dtype=np.int64)
        self._opens = np.array([name[:1] in (space, newline) for name in names])
        self._units: dict[str, bytes] = {}
        self._marks = {mark: self._direct(mark) for mark in ".,"}

    def _direct(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """A unit with a line break starts with it; others stand for a space and the word."""
        known, plain, marked = {}, set(), []
        for unit in units:
            if unit[-1:] in self._marks and unit[-2:-1].isalpha():
                marked.append(unit)  # the mark is parted from the word before it
                if unit[:-1] not in self._units:
                    plain.add(unit[:-1])
            elif not unit or unit[-1].isspace():  # joined to another, its white space could run on
                known[unit] = self._direct(unit if unit[:1] == "\n" else f" {unit}")
            else:
                plain.add(unit)
        plain = list(plain)
        for first in range(0, len(plain), UNITS_A_CALL):
            some = plain[first:first + UNITS_A_CALL]
            joined = "".join([unit if unit[0] == "\n" else f" {unit}" for unit in some])
            ids = np.array(
                self._tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            starts = np.flatnonzero(self._opens[ids])
            if len(starts) != len(some):
                raise ValueError("not a byte-level tokenizer that parts words at white space")
            raw, starts = ids.tobytes(), (4 * starts).tolist()
            known.update(zip(some, [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]))
        for unit in marked:
            known[unit] = (self._units.get(unit[:-1]) or known[unit[:-1]]) + self._marks[unit[-1]]
        return known

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each whole text; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, self._odd)
        # a break of ours opens each text; then every unit but those with a break follows a blank
        opened = pc.binary_join_element_wise(
            "\n", pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n"), "")
        lists = pc.split_pattern(opened, " ")
        names, at, bounds = distinct_units(lists)
        ids = looked_up(self._units, names, at, self._learn)
        flat, ends = gathered(ids, at)
        first, last = ends[bounds[:-1]] + 1, ends[bounds[1:]]  # without the break of ours
        found = [flat[a:b] for a, b in zip(first.tolist(), last.tolist())]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            found[i] = np.frombuffer(self._direct(texts[i].as_py()), "<u4")
        return found


def _stays_letters(word: str) -> bool:
    """Whether a word is of letters alone after the tokenizer's normalization, too."""
    return word.isalpha() and (
        word.isascii() or unicodedata.is_normalized("NFC", word) and word.lower().isalpha())


class WordEncoder:
    """Special tokens in a text get their ids, as by the library's plain call.

    White space parts words and gives no ids, and no special token holds any, so a text's ids
    are those of its blank-separated units in turn.
    """

    def __init__(self, path: str) -> None:
        self._tokenizer = load(path)
        size = self._tokenizer.get_vocab_size()
        self._closes = np.array([(self._tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self._units: dict[str, bytes] = {}
        self._marks = {mark: self._direct([mark])[0] for mark in ".,"}

    def _direct(self, units: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(units, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

    def _words(self, units: list[str]) -> list[bytes]:
        """Ids of units of letters, each a word as a rule: encoded together and cut after the
        tokens that end a word."""
        joined = self._tokenizer.encode_batch_fast([" ".join(units)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, dtype="<u4")
        ends = np.flatnonzero(self._closes[ids]) + 1
        if len(ends) != len(units):  # every unit ends a word, so one of them ends two
            return self._direct(units)
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        known, words, others, marked = {}, set(), [], []
        for unit in units:
            if unit.isalpha():
                words.add(unit)
            elif unit[-1:] in self._marks and _stays_letters(unit[:-1]):
                marked.append(unit)  # the mark is parted from the letters before it
                if unit[:-1] not in self._units:
                    words.add(unit[:-1])
            else:
                others.append(unit)
        for encode, some in ((self._words, list(words)), (self._direct, others)):
            for first in range(0, len(some), UNITS_A_CALL):
                part = some[first:first + UNITS_A_CALL]
                known.update(zip(part, encode(part)))
        for unit in marked:
            known[unit] = (self._units.get(unit[:-1]) or known[unit[:-1]]) + self._marks[unit[-1]]
        return known

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each whole text; a null text has none."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), "\n", " ")
        names, at, bounds = distinct_units(pc.split_pattern(texts, " "))
        ids = looked_up(self._units, names, at, self._learn)
        flat, ends = gathered(ids, at)
        return [flat[a:b] for a, b in zip(ends[bounds[:-1]].tolist(), ends[bounds[1:]].tolist())]


def slices(texts: pa.Array, size: int = 16_000_000) -> list[tuple[int, int]]:
    """Bounds of runs of texts of about so many bytes in all, a longer text by itself."""
    bounds, first, held = [], 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > first and held + n > size:
            bounds.append((first, i))
            first, held = i, 0
        held += n
    if first < len(texts):
        bounds.append((first, len(texts)))
    return bounds
