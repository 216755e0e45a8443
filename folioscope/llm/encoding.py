"""Encoding of the whole corpus with a public tokenizer (problem 7).

Method: overlapping chunk encoding. A long text is dealt out as overlapping chunks; each chunk is
pre-tokenised on its own, in parallel; where the pre-token boundaries of two neighbours meet in
their overlap the texts are stitched, and the pieces between stitches are encoded and put together.
A text that fits one chunk is one piece and is encoded where it is read, without a shuffle.

Why the stitch is exact: the pre-token pattern scans from left to right, and what it does at a place
depends on the match in hand and at most ``MARGIN`` characters past it (two, for an apostrophe ending).
So from a common boundary on, both chunks give the same pre-tokens, and a pre-token of the left chunk
that ends ``MARGIN`` characters before the chunk does is the one of the whole text. A stitch is never
made after white space, since the pattern splits a run of it by what follows.
The merges of a byte-level BPE never cross a pre-token, hence ids of pieces that begin and end at
boundaries are the ids of the text. Where an overlap has no common boundary (one run longer than the
overlap) the rest of the text, whose boundaries are then unproven, stays one piece.

Defined results:

* a null text and an empty text both give the empty list;
* strings of special tokens in a text are ordinary text; no special tokens are added;
* repeated rows give a row each, also with the same key; further columns are ignored;
* an empty table gives no rows.

The vocabulary file's path is a parameter; it is loaded once per Python worker, from the same path on
every machine.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.runtime import materialize

#: Code points of a chunk, and how far it reaches into the next one.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: More characters than the pattern looks past a match.
MARGIN = 4
#: Texts encoded at once by the library.
AT_ONCE = 256


def default_vocabulary() -> tuple[str, str]:
    """(file, pre-token pattern) of byte_bpe_50k in the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@functools.lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _pattern(pattern: str):
    import regex

    return regex.compile(pattern)


def encode_text(text: str, path: str, pattern: str) -> list[int]:
    return _encoding(path, pattern).encode_ordinary(text)


def decode_ids(ids: list[int], path: str, pattern: str) -> str:
    """The inverse: raw bytes put together, then read as UTF-8."""
    enc = _encoding(path, pattern)
    return b"".join(map(enc.decode_single_token_bytes, ids)).decode("utf-8")


def _encoder(path: str, pattern: str, column: str):
    """Replaces the text column of each batch by the column ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(path, pattern)
        for batch in batches:
            names = batch.schema.names
            texts, ids = batch.column(names.index(column)).to_pylist(), []
            for at in range(0, len(texts), AT_ONCE):
                ids += [enc.encode_ordinary(t) if t else [] for t in texts[at : at + AT_ONCE]]
            cols = [pa.array(ids, pa.list_(pa.int32())) if n == column else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(cols, names=["ids" if n == column else n for n in names])

    return run


def boundaries(chunk: str, start: int, length: int, chunk_size: int, overlap: int, pattern: str) -> tuple[list[int], list[int]]:
    """Pre-token boundaries (places in the text) in the part shared with the chunk before, and in the part shared with the next."""
    head_end, tail_start = start + overlap, start + chunk_size
    last = start + len(chunk) < length  # the chunk is cut off, so its last pre-tokens are open
    head, tail = [], []
    for m in _pattern(pattern).finditer(chunk):
        at, end = start + m.start(), start + m.end()
        if start and start < at <= head_end:
            head.append(at)
        if tail_start <= end and last and m.end() + MARGIN <= len(chunk) and not m.group()[-1].isspace():
            tail.append(end)
    return head, tail


def _pre_tokenizer(pattern: str, chunk_size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            found = [
                boundaries(c, s, n, chunk_size, overlap, pattern)
                for c, s, n in zip(col["chunk"].to_pylist(), col["start"].to_pylist(), col["length"].to_pylist())
            ]
            cols = [*col.values(), pa.array([h for h, _ in found], kind), pa.array([t for _, t in found], kind)]
            yield pa.RecordBatch.from_arrays(cols, names=[*col, "head", "tail"])

    return run


def pieces_of_long_texts(rows: DataFrame, pattern: str, chunk_size: int, overlap: int) -> DataFrame:
    """row, piece_no, text: long texts cut at stitches. ``rows``: row, text."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.length("text").cast("bigint") - 1, F.lit(chunk_size).cast("bigint"))
    chunks = (
        rows.withColumn("length", F.length("text").cast("bigint"))
        .select("row", "length", "text", F.posexplode(starts).alias("chunk_no", "start"))
        .select("row", "length", "chunk_no", "start", F.substring("text", F.col("start").cast("int") + 1, F.lit(chunk_size + overlap)).alias("chunk"))
        .repartition("row", "chunk_no")
    )
    schema = "row string, length bigint, chunk_no int, start bigint, chunk string, head array<bigint>, tail array<bigint>"
    found = chunks.mapInArrow(_pre_tokenizer(pattern, chunk_size, overlap), schema)
    by_row = Window.partitionBy("row").orderBy("chunk_no")
    meet = F.array_min(F.array_intersect(F.coalesce(F.lag("tail").over(by_row), F.array().cast("array<bigint>")), F.col("head")))
    stitched = (
        found.withColumn("met", meet)
        .withColumn("proven", F.min((F.col("met").isNotNull() | (F.col("chunk_no") == 0)).cast("int")).over(by_row))
        .withColumn("stitch", F.when(F.col("proven") == 1, F.col("met")))
        .withColumn("cut", F.coalesce("stitch", "start"))
        .withColumn("until", F.coalesce(F.lead("cut").over(by_row), F.col("length")))
        .withColumn("piece_no", F.sum(F.when(F.col("stitch").isNotNull(), 1).otherwise(0)).over(by_row))
        .withColumn("part", F.substring("chunk", (F.col("cut") - F.col("start")).cast("int") + 1, (F.col("until") - F.col("cut")).cast("int")))
    )
    return (
        stitched.groupBy("row", "piece_no")
        .agg(F.array_sort(F.collect_list(F.struct("chunk_no", "part"))).alias("parts"))
        .select("row", "piece_no", F.array_join(F.col("parts.part"), "").alias("text"))
    )


def encode_corpus(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str | None = None,
    chunk_size: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """(key, ids) of every row of ``docs``."""
    path, default_pattern = default_vocabulary() if vocabulary is None else (vocabulary, pattern)
    pattern = pattern or default_pattern
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= chunk_size)
    encoded = short.mapInArrow(_encoder(path, pattern, "text"), f"key {kind.simpleString()}, ids array<int>")
    # A row's own name, so that rows with the same key stay apart.
    named = rows.filter(F.length("text") > chunk_size).select("key", F.expr("uuid()").alias("row"), "text")
    long = materialize(named, "long")
    pieces = pieces_of_long_texts(long.select("row", "text"), pattern, chunk_size, overlap)
    ids = (
        pieces.repartition("row", "piece_no")
        .mapInArrow(_encoder(path, pattern, "text"), "row string, piece_no bigint, ids array<int>")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("piece_no", "ids"))).alias("p"))
        .select("row", F.flatten("p.ids").alias("ids"))
    )
    joined = long.select("key", "row").join(ids, "row").select("key", "ids")
    return encoded.unionByName(joined).withColumnRenamed("key", key)
