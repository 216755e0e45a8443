"""Evaluation texts leaking into training text (problem 8).

Method: latent semantic retrieval. Documents and test items are cut into overlapping passages of their
letters and digits; passages become TF-IDF vectors of hashed character n-grams; a randomised SVD,
whose sums are made by the executors, gives a latent space; passages and items that are close by
cosine there are candidates. An exact check of a shared run, and for paraphrases the longest common
subsequence with a check of the answer's figures, decide.

* Passages are ``2 * run`` characters long, one every ``run`` characters, so every run of ``run``
  characters lies whole in one passage, of the document and of the item alike. The check therefore
  needs the passage only, not the document.
* The terms are n-grams of 6 characters, of 3 where the text is written without blanks; terms that no item
  has can't add to a cosine with one and are left out. The passages with at least one term (about half of
  them) are written out once with their terms and are all indexed. Document frequencies are counted over all
  passages of all documents.
* The space is that of the passages of documents and items together; either side counts the same, however
  much larger the corpus is.
* Candidates are the pairs with a latent cosine of at least ``least_cosine``. It selects: see README for the
  share of pairs that it keeps and for the lowest cosine of a true pair. The tests compare it with brute force.

Sizes: ``dims`` times ``rank`` numbers go to the driver, whatever the corpus; the executors' sums meet in
two steps. The items' passages are compared in blocks. Items of more than ``MAX_ITEM_CHARS`` characters are
dealt out into groups of at most about that much, by a hash of their id, which are searched for one after another.

Defined results:

* null and empty texts, and texts with fewer than ``run`` letters and digits, leak nothing;
* copies of a document, and rows that repeat a doc_id, count each but give one row per pair of ids; a null
  doc_id is kept as it is;
* items with equal texts are each reported; an empty table of documents or items gives no rows;
* further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.runtime import materialize

RUN = 50
#: Characters of a term, and of one that begins with a character of CJK.
GRAM, CJK_GRAM = 6, 3
CJK_FIRST = 0x2E80
DIMS, RANK, SPARE, ROUNDS = 1 << 15, 128, 8, 2
#: A run that is half of both passages gives a cosine of nearly a half, and the space leaves out what the items don't have.
LEAST_COSINE = 0.4
#: Least share of an item's passage that is a subsequence of a paraphrase.
LEAST_LCS = 0.6
MAX_ITEM_CHARS = 2_000_000
#: Rows of the sums that travel together.
BLOCK = 512
#: Passages compared at once, of documents and of items.
AT_ONCE, ITEM_BLOCK = 2000, 4096
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_OTHER = re.compile(r"[\W_]+")


def letters_and_digits(text: str) -> str:
    return _OTHER.sub("", text.lower())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive codes, by doubling."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out, done, power, width, base = None, 0, codes * _BASE + np.uint64(1), 1, _BASE
    rest = n
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if out is None:
                    out = power
                else:
                    m = min(len(out), len(power) - done)
                    out = out[:m] * base + power[done : done + m]
                done += width
            rest >>= 1
            if rest:
                power = power[:-width] * base + power[width:] if len(power) > width else power[:0]
                base = base * base
                width *= 2
        out = out[: len(codes) - n + 1]
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))


def passages(text: str, run: int) -> list[str]:
    """Passages of a normalised text: 2 * run long, one every run characters."""
    return [text[at : at + 2 * run] for at in range(0, max(1, len(text) - run), run)]


def terms(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the term that begins at each character, its length; 0 where the text ends before)."""
    h, length = np.zeros(len(codes), np.uint64), np.zeros(len(codes), np.int64)
    for n, here in ((GRAM, codes < CJK_FIRST), (CJK_GRAM, codes >= CJK_FIRST)):
        grams = gram_hashes(codes, n)
        at = np.flatnonzero(here[: len(grams)])
        h[at], length[at] = grams[at], n
    return h, length


class Items:
    """The test items as the workers need them."""

    def __init__(self, rows: list[tuple[int, str]], run: int = RUN, dims: int = DIMS, bits: int = 22):
        self.run, self.dims, self.bits = run, dims, bits
        texts = [(i, letters_and_digits(t or "")) for i, t in rows]
        texts = [(i, t) for i, t in texts if len(t) >= run]
        self.texts = [t for _, t in texts]
        parts = [(n, i, p) for n, (i, t) in enumerate(texts) for p in passages(t, run)]
        self.text = np.array([n for n, _, _ in parts], np.int64)
        self.ids = np.array([i for _, i, _ in parts], np.int64)
        self.parts = [p for _, _, p in parts]
        grams = [h[n > 0] for h, n in (terms(_codes(t)) for t in self.texts)]
        self.vocabulary = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        self.dims = max(BLOCK, min(dims, -(-len(self.vocabulary) // BLOCK) * BLOCK))  # a term each, up to dims

    def finder(self):
        """A function of a text's codes: where its known terms begin, their lengths and dimensions."""
        vocabulary, shift = self.vocabulary, np.uint64(64 - self.bits)
        seen = np.zeros(1 << self.bits, bool)
        seen[(vocabulary >> shift).astype(np.int64)] = True

        def find(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, length = terms(codes)
            at = np.flatnonzero(seen[(h >> shift).astype(np.int64)] & (length > 0))
            place = np.minimum(np.searchsorted(vocabulary, h[at]), len(vocabulary) - 1)
            known = vocabulary[place] == h[at]
            at = at[known]
            return at, length[at], (place[known] % self.dims).astype(np.uint16)

        return find

    def own_terms(self) -> list[bytes]:
        """The dimensions of the terms of each passage of the items."""
        find = self.finder()
        return [find(_codes(p))[2].tobytes() for p in self.parts]

    def shares_run(self, part: str, text: int) -> bool:
        """Whether a passage and an item have ``run`` characters in common, compared as text."""
        half, whole = max(1, self.run // 2), self.texts[text]
        # every run holds one of these pieces
        if not any(part[a : a + half] in whole for a in range(0, len(part) - half + 1, half)):
            return False
        return any(part[a : a + self.run] in whole for a in range(len(part) - self.run + 1))


PASSAGES = "doc_id bigint, part string, terms binary, passages bigint"


def _scan(items: Items):
    """The passages with at least one term of the items, and a row without a part that counts all passages of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, step = items.finder(), items.run
        for batch in batches:
            ids, parts, known, total = [], [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                plain = letters_and_digits(text) if text else ""
                if len(plain) < step:
                    continue
                count = max(1, -(-(len(plain) - step) // step))
                total += count
                at, length, dim = find(_codes(plain))
                if not len(at):
                    continue
                numbers = np.unique(np.concatenate([np.minimum(at // step, count - 1), np.maximum(np.minimum(at // step, count - 1) - 1, 0)]))
                lows, highs = np.searchsorted(at, numbers * step), np.searchsorted(at, numbers * step + 2 * step)
                for no, a, b in zip(numbers.tolist(), lows.tolist(), highs.tolist()):
                    mine = dim[a:b][at[a:b] + length[a:b] <= (no + 2) * step]
                    if len(mine):
                        ids.append(doc)
                        parts.append(plain[no * step : (no + 2) * step])
                        known.append(mine.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ids, None], pa.int64()), pa.array([*parts, None], pa.string()), pa.array([*known, None], pa.binary()), pa.array([*([None] * len(ids)), total], pa.int64())],
                names=["doc_id", "part", "terms", "passages"],
            )

    return run


class Matrix:
    """TF-IDF rows of some passages: terms that occur twice stand twice, which adds up."""

    def __init__(self, known: list[bytes], idf: np.ndarray):
        self.count = len(known)
        self.dim = np.frombuffer(b"".join(known), np.uint16).astype(np.int64)
        lengths = np.array([len(k) // 2 for k in known], np.int64)
        self.row = np.repeat(np.arange(len(known)), lengths)
        self.val = idf[self.dim].astype(np.float32)
        self.filled = np.flatnonzero(lengths)
        self.starts = (np.cumsum(lengths) - lengths)[self.filled]

    def times(self, right: np.ndarray) -> np.ndarray:
        out = np.zeros((self.count, right.shape[1]), np.float32)
        if len(self.dim):
            out[self.filled] = np.add.reduceat(self.val[:, None] * right[self.dim], self.starts)
        return out

    def add_gram(self, right: np.ndarray, into: np.ndarray) -> None:
        """Adds Aᵀ(A right) to ``into``."""
        if len(self.dim):
            order = np.argsort(self.dim, kind="stable")
            dim = self.dim[order]
            first = np.flatnonzero(np.concatenate([[True], dim[1:] != dim[:-1]]))
            into[dim[first]] += np.add.reduceat(self.val[order, None] * self.times(right)[self.row[order]], first)

    def add_counts(self, into: np.ndarray) -> None:
        """Adds, of every term, the number of passages that have it and the sum of its squared counts."""
        width = len(into)
        pairs, n = np.unique(self.row * width + self.dim, return_counts=True)
        into += np.stack([np.bincount(pairs % width, minlength=width), np.bincount(pairs % width, n * n, width)], axis=1)


#: Groups in which the partitions' sums first meet.
FAN_IN = 64


def _summed(parts: DataFrame, add, width: int, dims: int) -> np.ndarray:
    """The sum over all partitions of the (dims, width) array that ``add(terms, into)`` fills."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros((dims, width), np.float64)
        for batch in batches:
            known = batch.column(0).to_pylist()
            for at in range(0, len(known), AT_ONCE):
                add(known[at : at + AT_ONCE], into)
        context = TaskContext.get()
        place = context.partitionId() % FAN_IN if context else 0
        used = [b for b in range(0, dims, BLOCK) if into[b : b + BLOCK].any()]
        sums = [into[b : b + BLOCK].astype(np.float32).tobytes() for b in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([place] * len(used), pa.int32()), pa.array(sums, pa.binary())], names=["block", "place", "sums"])

    def reduce(group):
        total = 0.0
        for raw in group.column("sums").to_pylist():
            total = total + np.frombuffer(raw, np.float32).astype(np.float64)
        return pa.table({"block": group.column("block")[:1], "place": group.column("place")[:1], "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    schema = "block int, place int, sums binary"
    got = parts.filter("terms IS NOT NULL").select("terms").mapInArrow(partial, schema)
    got = got.groupBy("block", "place").applyInArrow(reduce, schema).groupBy("block").applyInArrow(reduce, schema)
    out = np.zeros((dims, width))
    for r in got.collect():  # dims * width numbers at most, a fixed size
        out[r.block : r.block + BLOCK] = np.frombuffer(r.sums, np.float32).reshape(-1, width)
    return out


def _gram_adder(q: np.ndarray, idf: np.ndarray):
    right = q.astype(np.float32)
    return lambda known, into: Matrix(known, idf).add_gram(right, into)


def latent_axes(parts: DataFrame, own: Matrix, idf: np.ndarray, energy: float, *, rank: int, rounds: int, seed: int = 7) -> np.ndarray:
    """The first ``rank`` right singular vectors of the TF-IDF matrix of the passages of documents (``parts``,
    whose squares add up to ``energy``) and items (``own``), by randomised subspace iteration."""
    dims, width = len(idf), min(rank + SPARE, len(idf))
    z = np.random.default_rng(seed).standard_normal((dims, width))
    for _ in range(rounds):
        q = np.linalg.qr(z)[0]
        z = np.zeros((dims, width))
        own.add_gram(q.astype(np.float32), z)
        z /= max(float(np.square(own.val, dtype=np.float64).sum()), 1e-9)
        if energy:
            z += _summed(parts, _gram_adder(q, idf), width, dims) / energy
    values, axes = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
    return q @ axes[:, ::-1][:, :rank]


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = v = (1 << len(a)) - 1
    for ch in b:
        u = v & where.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


FOUND = "doc_id bigint, item_id bigint, cosine double, exact boolean, lcs double, answer double"


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 1e-6, norm, np.inf)


def near_pairs(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, cosine) of the pairs of unit rows with a cosine of at least ``least``, by row of a."""
    found = []
    for at in range(0, len(b), ITEM_BLOCK):
        near = a @ b[at : at + ITEM_BLOCK].T
        r, c = np.nonzero(near >= least)
        found.append((r, c + at, near[r, c]))
    r, c, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((c, r))
    return r[order], c[order], s[order]


def _search(items: Items, ours: np.ndarray, axes: np.ndarray, idf: np.ndarray, least: float, paraphrase: float | None):
    """Candidates by latent cosine, each checked against the text of its item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        figures = [set(re.findall(r"\d+", p)) for p in items.parts] if paraphrase is not None else []
        for batch in batches:
            docs, parts, known = (batch.column(i).to_pylist() for i in range(3))
            out = {n: [] for n in ("doc_id", "item_id", "cosine", "exact", "lcs", "answer")}
            for at in range(0, len(parts), AT_ONCE):
                rows, cols, cosines = near_pairs(_unit(Matrix(known[at : at + AT_ONCE], idf).times(axes)), ours, least)
                best: dict[tuple[int, int], tuple[float, int]] = {}
                for r, c, x in zip(rows.tolist(), cols.tolist(), cosines.tolist()):
                    best[r, int(items.text[c])] = max(best.get((r, int(items.text[c])), (-1.0, 0)), (x, c))
                for (r, text), (cosine, c) in best.items():
                    part = parts[at + r]
                    exact, lcs, answer = items.shares_run(part, text), None, None
                    if not exact:
                        if paraphrase is None or cosine < paraphrase:
                            continue
                        answer = len(figures[c] & set(re.findall(r"\d+", part))) / len(figures[c]) if figures[c] else 1.0
                        if answer < 1.0:
                            continue
                        lcs = lcs_length(part, items.parts[c]) / len(items.parts[c])
                        if lcs < LEAST_LCS:
                            continue
                    for n, v in zip(out, (docs[at + r], int(items.ids[c]), cosine, exact, lcs, answer)):
                        out[n].append(v)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return run


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    run: int = RUN,
    dims: int = DIMS,
    rank: int = RANK,
    least_cosine: float = LEAST_COSINE,
    paraphrase: float | None = None,
    max_item_chars: int = MAX_ITEM_CHARS,
) -> DataFrame:
    """doc_id, item_id, cosine, exact, lcs, answer: one row per pair. With ``paraphrase`` also pairs
    without a shared run whose latent cosine is at least that, if most of the item's passage is a
    subsequence of the document's and all its figures occur there."""
    wanted = items.select(F.col(item_key).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).filter(F.col("text").isNotNull())
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).filter(F.length("text") >= run)
    size = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = -(-size // max_item_chars)
    found = docs.sparkSession.createDataFrame([], FOUND)
    for g in range(groups):
        some = wanted if groups == 1 else wanted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g)
        known = Items([tuple(r) for r in some.collect()], run, dims)  # about max_item_chars characters
        if known.parts:
            found = found.unionByName(_leaks_of(texts, known, rank, least_cosine, paraphrase))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("cosine").alias("cosine"), F.max("exact").alias("exact"), F.max("lcs").alias("lcs"), F.max("answer").alias("answer")
    )


def _leaks_of(texts: DataFrame, items: Items, rank: int, least: float, paraphrase: float | None) -> DataFrame:
    dims = items.dims
    parts = materialize(texts.mapInArrow(_scan(items), PASSAGES), "passages")
    total = parts.agg(F.sum("passages")).first()[0] or 0
    ones = np.ones(dims)
    often = _summed(parts, lambda known, into: Matrix(known, ones).add_counts(into), 2, dims)
    idf = np.log((1 + total) / (1 + often[:, 0])) + 1
    own = Matrix(items.own_terms(), idf)
    axes = latent_axes(parts, own, idf, float((idf**2 * often[:, 1]).sum()), rank=rank, rounds=ROUNDS).astype(np.float32)
    search = _search(items, _unit(own.times(axes)), axes, idf, least, paraphrase)
    return parts.filter("part IS NOT NULL").select("doc_id", "part", "terms").mapInArrow(search, FOUND)
