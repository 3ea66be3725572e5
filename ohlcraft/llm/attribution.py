"""Token counts of a document's sections from one encoding of the whole document.

A token stands for a run of bytes, so the ids of a document give its tokens' spans. They are
joined to the sections' spans by binary search. A token that lies in several sections goes to
one of them by a stated rule, so that the counts add up to the document's.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ohlcraft.llm import tokens

#: Who gets a token that crosses a boundary: the section of its first or its last byte (of those
#: in a section), or the one that holds most of its bytes, the earlier of equals.
RULES = ("first", "last", "largest")
Spans = Callable[[bytes], np.ndarray]


def line_spans(raw: bytes) -> np.ndarray:
    """Byte bounds of the lines, each with its line break; a text without bytes is one line."""
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    bounds = np.concatenate([[0], breaks, [] if len(breaks) and breaks[-1] == len(raw) else [len(raw)]]).astype(np.int64)
    return np.stack([bounds[:-1], bounds[1:]], axis=1)


def char_spans(raw: bytes, spans: np.ndarray) -> np.ndarray:
    """Byte bounds of sections given by characters."""
    opens = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return np.append(opens, len(raw))[spans]


def attribute(begins: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For tokens by byte spans: the section each goes to, -1 if it touches none, and whether it
    touches more than one or sticks out. Sections are sorted and don't overlap."""
    full = np.flatnonzero(sections[:, 1] > sections[:, 0])  # an empty one holds no token
    starts, stops = sections[full].T
    if (starts[1:] < stops[:-1]).any():
        raise ValueError("sections overlap or aren't sorted")
    if not len(full) or not len(begins):
        return np.full(len(begins), -1), np.zeros(len(begins), bool)
    low = np.searchsorted(stops, begins, "right")  # the first section that ends after the token begins
    high = np.searchsorted(starts, ends, "left") - 1  # the last one that begins before it ends
    touched = low <= high
    at = np.clip(low, 0, len(full) - 1)
    inside = touched & (starts[at] <= begins) & (stops[at] >= ends)
    crossing = touched & ~inside
    chosen = np.where(touched, low if rule != "last" else high, -1)
    if rule == "largest":
        for i in np.flatnonzero(crossing & (low < high)):
            own = slice(low[i], high[i] + 1)
            held = np.minimum(stops[own], ends[i]) - np.maximum(starts[own], begins[i])
            chosen[i] = low[i] + int(np.argmax(held))
    return np.where(chosen >= 0, full[np.maximum(chosen, 0)], -1), crossing


def section_tokens(
    docs: DataFrame, sections: Spans | str = line_spans, rule: str = "largest", id_col: str = "doc_id",
    text_col: str = "text", tokenizer: str | None = None,
) -> DataFrame:
    """A row per section: doc_id, section (from 0), begin_char, end_char, n_tokens, n_crossing
    (of these tokens, those that touch another section or lie partly in none).

    ``sections``: a function from a text's bytes to sorted byte bounds, or the name of a column
    of structs (begin, end) in characters. Tokens in no section are in a row with a null section.

    Null or empty text: by ``line_spans`` one empty section; of a null column of sections:
    none. Repeated rows and null ids give their rows each. An empty table gives none.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = tokenizer or tokens.default_path()
    given = isinstance(sections, str)
    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("section", T.IntegerType()), *(
        T.StructField(n, T.LongType()) for n in ("begin_char", "end_char", "n_tokens", "n_crossing"))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            for a, b in tokens.slices(batch.column(1)):
                texts = pc.fill_null(batch.column(1).slice(a, b - a), "")
                parts: list[list] = [[], [], [], [], [], []]
                for i, ids in enumerate(encoder.encode(texts)):
                    raw = texts[i].as_py().encode()
                    if given:
                        told = batch.column(2)[a + i].as_py() or []
                        spans = char_spans(raw, np.array([(s["begin"], s["end"]) for s in told], np.int64).reshape(-1, 2))
                    else:
                        spans = sections(raw)
                    ends = np.cumsum(encoder.n_bytes[ids])
                    chosen, crossing = attribute(ends - encoder.n_bytes[ids], ends, spans, rule)
                    n = len(spans)
                    held = np.bincount(chosen + 1, minlength=n + 1)
                    crossed = np.bincount(chosen[crossing] + 1, minlength=n + 1)
                    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                    rows = range(0 if held[0] else 1, n + 1)
                    parts[0] += [a + i] * len(rows)
                    parts[1] += [r - 1 if r else None for r in rows]
                    parts[2] += [None] * (n + 1 - len(rows) == 0) + chars[spans[:, 0]].tolist()
                    parts[3] += [None] * (n + 1 - len(rows) == 0) + chars[spans[:, 1]].tolist()
                    parts[4] += held[rows.start:].tolist()
                    parts[5] += crossed[rows.start:].tolist()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(parts[0], pa.int64())), pa.array(parts[1], pa.int32()),
                    *(pa.array(p, pa.int64()) for p in parts[2:])], names=out.names)

    wanted = [F.col(id_col), F.col(text_col), *([F.col(sections)] if given else [])]
    return docs.select(wanted).mapInArrow(count, out)
