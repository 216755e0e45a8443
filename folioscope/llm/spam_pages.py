"""Keyword-stuffed and link-list pages (problem 9).

Method: a text is read as a sequence of function words and word classes (``word_classes``). An n-gram
model of such sequences is trained on the labelled texts that are no spam. The surprise of every token
under it, in bits, is averaged over a window of neighbours, weighted by their lengths: the perplexity of
the window. Windows above a high or below a low perplexity are abnormal: high where keywords, links or
tags stand in place of sentences, low where the same sequence repeats without end. A page is flagged if
more than a share of its characters lies in abnormal windows. Nothing else decides.

The function words are those that are frequent in the labelled prose, in whatever language. The two
bounds and the share are learned from the labels, with the surprise of each text under a model of the
other four fifths of the labelled prose; of the settings with the fewest errors the one closest to
``USUAL`` is taken. The share is that of a page with ``PRIOR_CHARS`` ordinary characters more.

Every decided label is used, however many there are. Only counts go to the driver, of words, class n-grams
and errors of each setting, never a text or a label. Labelled texts are picked behind a Bloom filter of the
labels' keys, so no other text is shuffled. Every page is then scored on its own, in one scan without a shuffle.

Defined results:

* null, empty and blank texts are no spam; undecided labels (null) and contradicting ones are not used;
* without labels of both kinds the evidence alone decides: more than half of the characters;
* copies of a page are flagged alike; a repeated key gives a row each;
* empty tables give no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm import word_classes as wc
from folioscope.operators import bloom as bf
from folioscope.runtime import materialize

#: Neighbours of a window to either side; bits that one token counts at most.
WINDOW, MOST_BITS = 4, 12.0
#: Perplexities in bits to choose from, shares of a page, and the setting without labels that speak against it.
HIGH = (2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 6.0, 7.0)
LOW = (0.0, 0.15, 0.3, 0.5)
SHARE = (0.4, 0.5, 0.6, 0.7)
USUAL = (3.5, 0.3, 0.6)
#: A word of this share of the prose texts is a function word; at most so many words, and characters.
FREQUENT, MOST_WORDS = 0.1, 500
FOLDS = 5
#: Characters of ordinary text that every page is taken to have besides its own, as a few words are no evidence.
PRIOR_CHARS = 50
BATCH_CHARS = 400_000
C = wc.CLASSES


def _batches(keys: list, texts: list[str | None]) -> Iterator[tuple[list, list[str]]]:
    """Rows in portions of about BATCH_CHARS characters."""
    some_keys, some, size = [], [], 0
    for key, text in zip(keys, texts):
        if some and size + len(text or "") > BATCH_CHARS:
            yield some_keys, some
            some_keys, some, size = [], [], 0
        some_keys.append(key)
        some.append(text or "")
        size += len(text or "")
    if some:
        yield some_keys, some


def _context(t: wc.Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class before the last, last class, class) of every token; a text begins with START."""
    kind = t.kind.astype(np.int64)
    new = np.ones(len(kind), bool)
    new[1:] = t.doc[1:] != t.doc[:-1]
    last = np.concatenate([[wc.START], kind[:-1]]) if len(kind) else kind
    last[new] = wc.START
    before = np.concatenate([[wc.START], last[:-1]]) if len(kind) else kind
    before[new] = wc.START
    return before, last, kind


def trigram_model(counts: np.ndarray) -> np.ndarray:
    """Surprise in bits of every class after every two classes; each order falls back on the one below."""
    tri = counts.reshape(C, C, C).astype(np.float64)
    one = tri.sum(axis=(0, 1)) + 0.5
    one /= one.sum()
    two = tri.sum(axis=0)
    two = (two + 8 * one) / (two.sum(axis=1, keepdims=True) + 8)
    three = (tri + 8 * two[None]) / (tri.sum(axis=2, keepdims=True) + 8)
    return -np.log2(three).astype(np.float32)


def _windowed(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Means over WINDOW tokens to both sides within a text."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    at = np.arange(len(values))
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    group = np.cumsum(np.concatenate([[False], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    begin, end = first[group], np.append(first[1:], len(doc))[group]
    lo, hi = np.maximum(begin, at - WINDOW), np.minimum(end, at + WINDOW + 1)
    return (sums[hi] - sums[lo]) / (hi - lo)


def evidence(t: wc.Tokens, degree: int = 1) -> np.ndarray:
    """Share of a text's characters in links, tags and words of at least ``degree`` of repetition."""
    content = (t.kind >= wc.CONTENT0) & (t.kind < wc.LINE_CLASS)
    filling = (content & ((t.kind - wc.CONTENT0) % wc.DEGREES >= degree)) | (t.kind == wc.LINK) | (t.kind == wc.TAG) | (t.kind >= wc.LINK_MORE0)
    return np.bincount(t.doc, filling * t.size, len(t.chars)) / np.maximum(1, t.chars)


def window_bits(t: wc.Tokens, surprise: np.ndarray) -> np.ndarray:
    """The perplexity in bits of the window around every token, a token counting by its length."""
    lengths = t.size.astype(np.float64)
    return _windowed(np.minimum(surprise, MOST_BITS) * lengths, t.doc) / np.maximum(_windowed(lengths, t.doc), 1e-9)


def share_of(t: wc.Tokens, those: np.ndarray) -> np.ndarray:
    """The share of each text's characters in the tokens ``those``, shrunk by PRIOR_CHARS."""
    return np.bincount(t.doc, those * t.size, len(t.chars)) / (t.chars + PRIOR_CHARS)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, part in _batches([None] * batch.num_rows, batch.column("text").to_pylist()):
            for kind, found in enumerate(wc.words_of(part)):
                word, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word), kind, np.int32)), pa.array(word.astype(np.uint64).view(np.int64)), pa.array(n)], names=["kind", "word", "n"])


def function_words(prose: DataFrame) -> wc.FunctionWords:
    """The most frequent words, and characters of CJK, of some texts."""
    least = max(1, math.ceil(FREQUENT * prose.count()))
    counts = prose.select("text").mapInArrow(_count_words, "kind int, word bigint, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    best = [counts.filter(F.col("kind") == k).orderBy(F.desc("n"), "word").limit(MOST_WORDS).select("word").toArrow().column(0).to_numpy() for k in (0, 1)]
    return wc.FunctionWords(best[0].view(np.uint64), best[1])


def _count_trigrams(words: wc.FunctionWords):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(FOLDS * C**3, np.int64)
        for batch in batches:
            for folds, part in _batches(batch.column("fold").to_pylist(), batch.column("text").to_pylist()):
                t = wc.tokenize(part, words)
                before, last, kind = _context(t)
                counts += np.bincount(((np.array(folds)[t.doc] * C + before) * C + last) * C + kind, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["gram", "n"])

    return run


def _count_errors(models: np.ndarray, words: wc.FunctionWords):
    """setting, n: how many labelled texts each setting of (HIGH, LOW, SHARE) gets wrong."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = np.zeros((len(HIGH), len(LOW), len(SHARE)), np.int64)
        for batch in batches:
            labels, folds = batch.column("is_spam").to_pylist(), batch.column("fold").to_pylist()
            for some, part in _batches(list(zip(labels, folds)), batch.column("text").to_pylist()):
                t = wc.tokenize(part, words)
                before, last, kind = _context(t)
                fold = np.array([f for _, f in some])[t.doc]
                near = window_bits(t, models[fold, before, last, kind])
                above = np.stack([share_of(t, near > h) for h in HIGH], axis=1)
                below = np.stack([share_of(t, near < b) for b in LOW], axis=1)
                abnormal = above[:, :, None, None] + below[:, None, :, None]
                spam = np.array([y == 1 for y, _ in some])
                errors += ((abnormal > np.array(SHARE)) != spam[:, None, None, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(errors.size, dtype=np.int32)), pa.array(errors.ravel())], names=["setting", "n"])

    return run


def best_bounds(errors: np.ndarray) -> tuple[float, float, float]:
    """(high, low, share) with the fewest errors; of equals the one closest to USUAL."""
    found = []
    for i, high in enumerate(HIGH):
        for j, low in enumerate(LOW):
            for k, share in enumerate(SHARE):
                found.append((int(errors[i, j, k]), abs(high - USUAL[0]) + abs(low - USUAL[1]) + abs(share - USUAL[2]), (high, low, share)))
    return min(found)[2]


class SpamModel:
    """What was learned from the labelled texts; ``prose`` is None where there were none of both kinds."""

    def __init__(self, prose: np.ndarray | None = None, words: wc.FunctionWords = wc.LISTED_WORDS, bounds: tuple[float, float, float] = USUAL):
        self.prose, self.words, self.bounds = prose, words, bounds

    def scores(self, texts: list[str]) -> np.ndarray:
        """The share of each text's characters in abnormal windows, less the share that a page may have."""
        t = wc.tokenize(texts, self.words)
        if self.prose is None:
            return np.where(evidence(t, 2) > 0.5, evidence(t, 2) - 0.5, -1.0)
        high, low, share = self.bounds
        near = window_bits(t, self.prose[_context(t)])
        return share_of(t, (near > high) | (near < low)) - share

    def over(self, key_kind: pa.DataType):
        """Scores batches of (key, text)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, texts in _batches(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    yield pa.RecordBatch.from_arrays([pa.array(keys, key_kind), pa.array(self.scores(texts), pa.float64())], names=["key", "score"])

        return run


def train(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str = "is_spam") -> SpamModel:
    """A model from all labelled texts."""
    decided = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("is_spam")).filter(F.col("is_spam").isin(0, 1))
        .groupBy("key").agg(F.min("is_spam").alias("is_spam"), F.max("is_spam").alias("other")).filter("is_spam = other")
        .select("key", "is_spam", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(FOLDS)).cast("int").alias("fold"))
    )
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.length("text") > 0)
    same = F.col("key").cast(given.select("key").union(decided.select("key")).schema["key"].dataType)  # equal keys of two types have two hashes
    blocks = bf.blocks_for(labels.count())
    near = bf.probe(given, same, bf.build(decided, same, blocks), blocks, "near").filter("near")
    labelled = materialize(near.join(decided, "key").select("is_spam", "fold", "text"), "labelled")
    prose = labelled.filter("is_spam = 0")
    if prose.isEmpty() or labelled.filter("is_spam = 1").isEmpty():
        return SpamModel()
    words = function_words(prose)
    counts = np.zeros((FOLDS, C**3), np.int64)
    for r in prose.mapInArrow(_count_trigrams(words), "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toLocalIterator():
        counts.ravel()[r.gram] = r.n  # FOLDS tables of C ** 3 numbers at most
    models = np.stack([trigram_model(counts.sum(axis=0) - counts[f]) for f in range(FOLDS)])
    errors = np.zeros((len(HIGH), len(LOW), len(SHARE)), np.int64)
    for r in labelled.mapInArrow(_count_errors(models, words), "setting int, n bigint").groupBy("setting").agg(F.sum("n").alias("n")).collect():  # one row a setting
        errors.ravel()[r.setting] = r.n
    return SpamModel(trigram_model(counts.sum(axis=0)), words, best_bounds(errors))


def find_spam(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every spam page, score being the share of abnormal characters above the share allowed."""
    from pyspark.sql.pandas.types import to_arrow_type

    model = train(docs, labels, key=key, text=text)
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.length("text") > 0)
    scored = rows.mapInArrow(model.over(to_arrow_type(kind)), f"key {kind.simpleString()}, score double")
    return scored.filter("score > 0").withColumnRenamed("key", key)
