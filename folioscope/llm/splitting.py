"""Splitting oversized items at natural boundaries (problem 4).

Method: recursive bisection. A text over its limit is cut at the strongest boundary near its middle
and both halves are treated again while they exceed the limit minus the overlap; then every piece
but the first is opened with the last ``overlap`` characters of the piece before.

Boundaries, strongest first: before a heading, after an empty line (paragraph), before a table row or
list item, after a line, after a sentence, after a blank. "Near the middle" is the middle half of the
span; where that holds none, the whole span is searched; where there is no boundary at all, the cut is
in the middle, never inside a pair of base letter and combining mark unless nothing else is left.

Defined results:

* lengths are counted in code points, nothing is trimmed: the pieces without their overlaps, put
  together, are the text again;
* every piece, overlap included, has at most ``max_chars``; the overlap is cut to ``max_chars // 2``
  where a limit is so small that pieces would not advance;
* a text of at most ``max_chars``, an empty text and any text of a mode without limit is one piece;
* a null text has no pieces; a missing or blank mode is the default mode, a mode that the limits do
  not know has no limit;
* repeated rows are split each; ties between equal boundaries go to the one nearer the middle, then
  to the earlier; further columns are ignored, whatever their names.

Only oversized texts go to Python; all others stay in the JVM. One row is one text, so work is
spread by rows; a text itself is cut in O(n log n).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEADING, PARAGRAPH, ITEM, LINE, SENTENCE, BLANK, MARK = 6, 5, 4, 3, 2, 1, 0

_BOUNDARIES = (
    (LINE, re.compile(r"(?:\r\n|[\n\r])()")),
    (PARAGRAPH, re.compile(r"(?:\r\n|[\n\r])[ \t　]*(?:\r\n|[\n\r])()")),
    (ITEM, re.compile(r"(?:\r\n|[\n\r])()(?=[ \t　]*(?:[-*+•・] |\d{1,4}[.)．] |\|))")),
    (HEADING, re.compile(r"(?:\r\n|[\n\r])()(?=#{1,6} |【)")),
    (SENTENCE, re.compile(r"(?:[.!?][\"')\]]*(?=\s)|[。！？][」』）]*)\s?()")),
    (BLANK, re.compile(r"[ \t　]()(?=\S)")),
)


def boundaries(text: str) -> tuple[list[int], list[int]]:
    """Sorted places where a piece may begin, and their strengths."""
    strength: dict[int, int] = {}
    for level, pattern in _BOUNDARIES:
        for m in pattern.finditer(text):
            at = m.start(1)
            if 0 < at < len(text) and level > strength.get(at, -1):
                strength[at] = level
    # An empty line stays with the paragraph before it.
    places = sorted(strength)
    return places, [strength[p] for p in places]


def _best(places, levels, lo: int, hi: int, middle: float) -> int | None:
    from bisect import bisect_left

    a, b = bisect_left(places, lo), bisect_left(places, hi)
    if a == b:
        return None
    k = min(range(a, b), key=lambda i: (-levels[i], abs(places[i] - middle), places[i]))
    return places[k]


def cuts(text: str, limit: int, overlap: int) -> list[int]:
    """Places where the pieces of ``text`` begin, the first 0."""
    if len(text) <= limit:
        return [0]
    room = limit - overlap
    places, levels = boundaries(text)
    starts, todo = [], [(0, len(text))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= (limit if lo == 0 else room):
            starts.append(lo)
            continue
        quarter, middle = max(1, (hi - lo) // 4), (lo + hi) / 2
        at = _best(places, levels, lo + quarter, hi - quarter + 1, middle) or _best(places, levels, lo + 1, hi, middle)
        if at is None:
            at = (lo + hi) // 2
            back = at
            while back > lo + 1 and unicodedata.combining(text[back]):
                back -= 1
            at = back if not unicodedata.combining(text[back]) else at
        todo += [(at, hi), (lo, at)]
    return starts


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """(start of the new text, overlap taken, piece) of every piece, in order."""
    overlap = max(0, min(overlap, limit // 2))
    starts = cuts(text, limit, overlap)
    pieces, before = [], ""
    for start, end in zip(starts, [*starts[1:], len(text)]):
        opening = before[len(before) - min(overlap, len(before)) :] if pieces else ""
        before = opening + text[start:end]
        pieces.append((start, len(opening), before))
    return pieces


PIECES = "row_id bigint, section string, max_chars int, pieces array<struct<piece_no: int, start: int, overlap: int, piece: string>>"


def _split_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("piece_no", pa.int32()), ("start", pa.int32()), ("overlap", pa.int32()), ("piece", pa.string())]))
    for batch in batches:
        col = {n: batch.column(n) for n in batch.schema.names}
        out = [
            [{"piece_no": i, "start": s, "overlap": o, "piece": p} for i, (s, o, p) in enumerate(split_text(text, limit, over))]
            for text, limit, over in zip(col["text"].to_pylist(), col["max_chars"].to_pylist(), col["overlap_chars"].to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([col["row_id"], col["section"], col["max_chars"], pa.array(out, kind)], names=["row_id", "section", "max_chars", "pieces"])


def _limited(chunks: DataFrame, limits: DataFrame, *, row_id: str, text: str, mode: str, section: str, default_mode: str) -> DataFrame:
    trimmed = F.lower(F.regexp_replace(F.col(mode), r"(?U)^\s+|\s+$", ""))
    rows = chunks.select(
        F.col(row_id).alias("row_id"),
        F.col(text).alias("text"),
        F.col(section).alias("section"),
        F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(default_mode)).otherwise(trimmed).alias("mode"),
    ).filter(F.col("text").isNotNull())
    # One row per mode: a mode listed twice takes its smaller limit.
    small = (
        limits.select(F.lower(F.trim("chunk_mode")).alias("mode"), F.col("max_chars").cast("int"), F.coalesce("overlap_chars", F.lit(0)).cast("int").alias("overlap_chars"))
        .groupBy("mode")
        .agg(F.min(F.struct(F.coalesce("max_chars", F.lit(2**31 - 1)).alias("k"), "max_chars", "overlap_chars")).alias("l"))
        .select("mode", "l.max_chars", "l.overlap_chars")
    )
    return rows.join(small, "mode", "left")


def split_oversized(
    chunks: DataFrame,
    limits: DataFrame,
    *,
    row_id: str = "pos",
    text: str = "content",
    mode: str = "chunk_mode",
    section: str = "section_name",
    default_mode: str = "semantic",
) -> DataFrame:
    """row_id, section, max_chars, pieces of every oversized text."""
    rows = _limited(chunks, limits, row_id=row_id, text=text, mode=mode, section=section, default_mode=default_mode)
    over = rows.filter(F.length("text") > F.col("max_chars")).select("row_id", "section", "max_chars", "overlap_chars", "text")
    return over.mapInArrow(_split_batches, PIECES)


def split_all(chunks: DataFrame, limits: DataFrame, **names) -> DataFrame:
    """row_id, section, piece_no, start, overlap, piece of every text: oversized ones cut, others whole."""
    n = {"row_id": "pos", "text": "content", "mode": "chunk_mode", "section": "section_name", "default_mode": "semantic"} | names
    whole = _limited(chunks, limits, **n).filter(F.col("max_chars").isNull() | (F.length("text") <= F.col("max_chars")))
    whole = whole.select("row_id", "section", F.lit(0).alias("piece_no"), F.lit(0).alias("start"), F.lit(0).alias("overlap"), F.col("text").alias("piece"))
    cut = split_oversized(chunks, limits, **n).select("row_id", "section", F.inline("pieces"))
    return whole.unionByName(cut)
