"""Cutting oversized texts at natural boundaries: balanced targets, each snapped to the strongest boundary near it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kinfold.llm.tokens import VOCABULARY, encoding

# Characters that a boundary lies behind; fixed values.
_LINE, _PAGE = "\n\u0085\u2028", "\f\u2029"
_BLANK = " \t\v\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000" + _LINE + _PAGE
_SENTENCE, _CLAUSE, _DASH, _CLOSING = ".!?\u2026", ";:,", "-\u2013\u2014", "\"')]\u201d\u2019\u00bb"
#: How much stronger a boundary must be for another piece.
STRONGER = 2
_WIDE_SENTENCE, _WIDE_CLAUSE = "\u3002\uff01\uff1f", "\uff1b\uff1a\uff0c\u3001"


def token_starts(text: str, path: str = VOCABULARY) -> np.ndarray:
    """Character offset of each token's start, and the text's length at the end. A token that starts inside a character counts from that character on."""
    enc, lengths = encoding(path)
    ids = enc.encode_to_numpy(text, disallowed_special=())
    ends = np.concatenate([[0], np.cumsum(lengths[ids])])
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(raw) == len(text):
        return ends
    leads = np.cumsum((raw & 0xC0) != 0x80)  # characters begun up to and with each byte
    inside = np.minimum(ends, len(raw) - 1)
    return np.where(ends < len(raw), leads[inside] - 1, len(text))


def _among(points: np.ndarray, characters: str) -> np.ndarray:
    table = np.zeros(0x10000, bool)
    table[[ord(c) for c in characters]] = True
    return table[np.minimum(points, 0xFFFF)]


def boundary_strengths(text: str) -> np.ndarray:
    """How good a cut before each character is: 6 page or heading, 5 paragraph, 4 line, 3 sentence, 2 clause, 1 word, 0 none.

    A cut lies behind the white space, or behind the mark itself in scripts without spaces.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    out = np.zeros(n + 1, np.int8)
    out[1:][_among(points, _WIDE_CLAUSE)] = 2
    out[1:][_among(points, _WIDE_SENTENCE)] = 3
    blank = _among(points, _BLANK)
    edges = np.diff(np.concatenate([[False], blank, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if len(starts):
        within = lambda mask: (c := np.concatenate([[0], np.cumsum(mask)]))[ends] - c[starts]
        lines, pages = within(_among(points, _LINE)), within(_among(points, _PAGE))
        before = points[np.maximum(starts - 1, 0)]
        last = before
        closed = _among(before, _CLOSING)
        last = np.where(closed, points[np.maximum(starts - 2, 0)], before)
        strength = np.ones(len(starts), np.int8)
        strength[_among(before, _CLAUSE + _DASH)] = 2
        strength[_among(last, _SENTENCE)] = 3
        strength[_among(last, _WIDE_SENTENCE)] = 3
        strength[lines == 1] = 4
        strength[lines > 1] = 5
        heading = (lines > 1) & (points[np.minimum(ends, n - 1)] == ord("#"))
        strength[heading | (pages > 0)] = 6
        out[ends] = strength
    out[[0, n]] = 0
    return out


def split_text(text: str, limit: int, overlap: int, path: str = VOCABULARY, window: float = 0.25, spare: float = 0.05) -> list[tuple[int, int, int, int]]:
    """(start, end, own, tokens) of each piece: characters [start, end), of which [start, own) repeat the piece before.

    The text gets the fewest pieces that can hold it, cut at equal distances; each cut moves to the strongest boundary within
    `window` of a piece's length around it: of several the nearest. Cuts are kept where the pieces to come can hold the rest, but for the sake of a boundary stronger by STRONGER the text may get one
    more piece, or a share of `spare` more. A piece that, counted on its own, is above `limit` tokens is cut earlier. Where a limit fails, the rest of the
    text gets one more piece, at equal distances from there on: cuts made before stay. Where no boundary is near, the cut stays between two tokens.
    The overlap is `overlap` tokens of the text, more by the rest of a character and less only where the piece before is shorter.
    """
    starts = token_starts(text, path)
    n = len(starts) - 1
    if n <= limit:
        return [(0, len(text), 0, n)] if n else []
    strength = boundary_strengths(text)
    enc, _ = encoding(path)
    count = lambda a, b: len(enc.encode_to_numpy(text[a:b], disallowed_special=()))
    last = int(np.searchsorted(starts, len(text), "left")) - 1
    room = limit - overlap
    left = max(2, -(-(n - overlap) // room))
    spared = max(1, int(spare * left))
    pieces: list[tuple[int, int, int, int]] = []
    start = own = previous = 0
    while True:
        repeated = overlap if pieces else 0
        if left == 1:
            if (tokens := count(start, len(text))) <= limit:
                return [*pieces, (start, len(text), own, tokens)]
            left = 2
        length = (n - previous + repeated + (left - 1) * overlap) / left
        target, reach = previous + length - repeated, max(1, int(window * length))
        first = max(previous + 1, int(np.searchsorted(starts, own, "right")))
        low, high = max(int(target) - reach, first), min(int(target) + reach, previous + limit - repeated, last)
        # from here on the pieces to come can hold the rest, and half the room that each has above its share is left to them
        fits = max(low, n - int((left - 1) * (room + min(room, length - overlap)) / 2))
        if fits <= high and (not spared or strength[starts[low] : starts[high] + 1].max() < strength[starts[fits] : starts[high] + 1].max() + STRONGER):
            low = fits
        at = None
        while low <= high:
            a, b = int(starts[low]), int(starts[high])
            near = strength[a : b + 1]
            if best := int(near.max()):
                places = np.flatnonzero(near == best) + a
                at = int(places[np.abs(places - starts[min(max(int(target), low), high)]).argmin()])
            else:
                at = int(starts[min(max(round(target), low, fits), high)])
            if (tokens := count(start, at)) <= limit:
                break
            high = min(high, int(np.searchsorted(starts, at, "right")) - 1) - (tokens - limit)
            at = None
        if at is None:
            left += 1
            if left > len(text):
                raise ValueError(f"a single character has more than {limit} tokens beside an overlap of {overlap}")
            continue
        pieces.append((start, at, own, tokens))
        own, previous = at, int(np.searchsorted(starts, at, "left"))
        start = min(at, int(starts[max(0, previous - overlap)]))
        if n - previous > (left - 1) * room:
            left, spared = left + 1, max(0, spared - 1)
        left -= 1


def split_documents(documents: DataFrame, limit: int, overlap: int, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, piece_no, pieces, start_char, end_char, overlap_chars, n_tokens, piece) of every document.

    Pieces have at most `limit` tokens and are cut at the text's own breaks where there are any; the first `overlap_chars`
    characters of a piece repeat the end of the piece before, so that leaving them out restores the text exactly.
    A text within the limit is one piece. A null or empty text comes out as a single row with an empty piece, 0 tokens
    and piece_no 0, so that no document is lost. Rows are taken as they come: repeated rows give repeated pieces.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    fields = [documents.schema[key], *[T.StructField(n, T.IntegerType()) for n in ("piece_no", "pieces", "start_char", "end_char", "overlap_chars", "n_tokens")], T.StructField("piece", T.StringType())]

    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not t:
                    rows.append((k, 0, 0, 0, 0, 0, 0, ""))
                    continue
                pieces = split_text(t, limit, overlap, vocabulary)
                rows += [(k, i + 1, len(pieces), a, b, own - a, n, t[a:b]) for i, (a, b, own, n) in enumerate(pieces)]
                size += len(t)
                if size > 4_000_000:
                    yield _batch(rows, arrow)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, arrow)

    return documents.select(key, text).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
