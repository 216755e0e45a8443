"""Most similar vectors for every vector (problem 6).

Method: a permutation index. A bounded sample of the vectors are the pivots. Every vector is
represented by its ``depth`` nearest pivots in order and posted in the inverted files of the first
``posts`` of them. Within a file, a vector's candidates are ranked by the footrule distance of the
pivot orders, and the best are reranked by cosine. Results of a vector's files are merged.

* Pivots: ``pivots_per_root * sqrt(n)`` vectors chosen by a hash of their id, at most ``MAX_PIVOTS``
  (64 MB at 1024 numbers), sent to every worker. Since they are drawn like the vectors, dense regions
  get more of them, which keeps the files even.
* A file of more than about ``file_rows`` vectors, which any file is where the pivots have reached their
  cap, is divided by the pivots that come next in the orders of its vectors: by one, or by a pair where
  that is not enough. A vector is then posted in two of the parts, or six where pairs divide. Which files are so large is
  estimated from the orders of ``SHAPE_ROWS`` vectors at most, chosen by a hash of their id; a wrong
  estimate makes a part larger or smaller, all rows are indexed whatever it says.
* Files of pivots that are close to each other form a bundle, which is one group of the shuffle. A vector
  travels once to each bundle it is posted in, however many of its files lie there. Within a bundle the
  lists are walked in blocks of queries, so memory follows the bundle's size, not its square.
* Every bundle, small or large, is ranked by footrule, and the closest are reranked by cosine: ``rerank`` times the
  fourth root of n, as the files grow with the square root.
* Vectors travel as one byte a number (the largest of a vector is 127). The cosines of the rerank are those of the coded vectors; on unit vectors they are off by some 0.0005.
* Equal vectors are one entry, with its ``k + 1`` smallest ids: no more can be anybody's neighbour.
  Further copies get their answer by a join on the vector's hash, so a vector that a third of all rows
  share is never gathered in one task.

Loss: the neighbours that share no bundle with a vector or are behind too many others by footrule, and
swaps of near ties. See README for the measured recall.

Defined results:

* valid are vectors of ``dims`` finite numbers, not all zero; others take no part;
* rows with the same id are one vector; with different vectors under one id, each takes part and an
  id is never its own neighbour;
* similarity is cosine, so length does not count; ties (to 6 places) go to the smaller id;
* fewer than k others: all of them; an empty table: no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.runtime import materialize

#: Less than 2 ** 15, as a pivot's number takes two bytes.
MAX_PIVOTS = 16_384
DEPTH, POSTS, PIVOTS_PER_ROOT = 16, 4, 8
#: Candidates that are reranked in a bundle, times the fourth root of the number of vectors.
RERANK = 7
FILE_ROWS, SHAPE_ROWS = 8192, 100_000
#: Bytes of postings that a task of the ranking gets on average.
TASK_BYTES = 64 << 20
#: Queries of a block, and pairs that a block looks at (8 bytes each).
BLOCK, BLOCK_PAIRS = 128, 2_000_000


def valid_matrix(embedding: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are valid, their vectors with length 1)."""
    if isinstance(embedding, pa.ChunkedArray):
        embedding = embedding.combine_chunks()
    n = len(embedding)
    if not n:
        return np.zeros(0, np.int64), np.zeros((0, dims), np.float32)
    offsets = embedding.offsets.to_numpy()
    fits = (np.diff(offsets) == dims) & np.asarray(embedding.is_valid())
    values = embedding.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)  # nulls become NaN
    rows = np.flatnonzero(fits)
    x = values[offsets[rows][:, None] + np.arange(dims)] if len(rows) < n else values[offsets[0] : offsets[-1]].reshape(n, dims)
    with np.errstate(all="ignore"):
        scale = np.abs(x).max(axis=1, initial=0)
        good = np.isfinite(scale) & (scale > 0)
        x = x[good] / scale[good, None]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    return rows[good], x


def permutations(x: np.ndarray, pivots: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` nearest pivots of each vector, nearest first, ties to the smaller number."""
    depth = min(depth, len(pivots))
    near = x @ pivots.T
    top = np.argpartition(-near, depth - 1, axis=1)[:, :depth] if depth < len(pivots) else np.tile(np.arange(len(pivots)), (len(x), 1))
    top = np.sort(top, axis=1)
    order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
    return np.take_along_axis(top, order, 1).astype(np.int16)


def coded(x: np.ndarray) -> np.ndarray:
    return np.rint(x * (127 / np.abs(x).max(axis=1, keepdims=True))).astype(np.int8)


class Lists:
    """The inverted lists of the pivots over the orders of a bundle's vectors."""

    def __init__(self, perm: np.ndarray):
        self.perm, self.n, self.depth = perm, len(perm), perm.shape[1]
        order = np.argsort(perm, axis=None, kind="stable")
        self.rows, self.ranks = order // self.depth, order % self.depth
        flat = perm.ravel()[order]
        _, begin, place = np.unique(flat, return_index=True, return_inverse=True)
        length = np.diff(np.append(begin, len(flat)))
        self.begin, self.length = np.empty(perm.shape, np.int64), np.empty(perm.shape, np.int64)
        self.begin.ravel()[order], self.length.ravel()[order] = begin[place], length[place]
        self.work = self.length.sum(axis=1)

    def blocks(self) -> Iterator[np.ndarray]:
        """Rows in portions of at most BLOCK that look at some BLOCK_PAIRS pairs; those of one nearest pivot together."""
        order = np.lexsort((self.perm[:, 1] if self.depth > 1 else self.perm[:, 0], self.perm[:, 0]))
        most = max(1, min(BLOCK, BLOCK_PAIRS // max(1, self.n)))
        at = 0
        while at < self.n:
            some = order[at : at + most]
            some = some[: max(1, int(np.searchsorted(np.cumsum(self.work[some]), BLOCK_PAIRS, "right")))]
            yield some
            at += len(some)

    def closeness(self, some: np.ndarray) -> np.ndarray:
        """Footrule closeness of the rows ``some`` to all rows.

        For orders cut at ``depth`` the footrule distance is a constant less twice this sum over shared
        pivots of depth minus the larger of the two ranks.
        """
        begin, length = self.begin[some].ravel(), self.length[some].ravel()
        total = int(length.sum())
        entry = np.arange(total) + np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        mine = np.repeat(np.tile(np.arange(self.depth), len(some)), length)
        query = np.repeat(np.arange(len(some)) * self.n, length.reshape(len(some), self.depth).sum(axis=1))
        weight = self.depth - np.maximum(self.ranks[entry], mine)
        return np.bincount(query + self.rows[entry], weight, len(some) * self.n).reshape(len(some), self.n)


def nearest_in_bundle(codes: np.ndarray, perm: np.ndarray, keep: int, rerank: int) -> tuple[np.ndarray, np.ndarray]:
    """For every vector of a bundle its ``keep`` most similar others among the ``rerank`` closest by footrule:
    (numbers, cosines), -1 where there are fewer."""
    n = len(codes)
    width = max(1, min(keep, n - 1))
    out, sims = np.full((n, width), -1, np.int64), np.full((n, width), -np.inf, np.float32)
    if n < 2:
        return out, sims
    lists, most = Lists(perm), min(rerank, n - 1)
    width = min(width, most)

    def unit(rows: np.ndarray) -> np.ndarray:
        x = codes[rows].astype(np.float32)
        return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))

    for some in lists.blocks():
        close = lists.closeness(some)
        close[np.arange(len(some)), some] = -1
        ranked = np.argpartition(-close, most - 1, axis=1)[:, :most]
        # The queries of a block share most of their candidates: one product over all of them, of which only
        # each query's own are looked at, is cheaper than a product for every query.
        those, place = np.unique(ranked, return_inverse=True)
        s = np.take_along_axis(unit(some) @ unit(those).T, place.reshape(ranked.shape), 1)
        s[np.take_along_axis(close, ranked, 1) <= 0] = -np.inf  # no shared pivot
        top = np.argpartition(-s, width - 1, axis=1)[:, :width]
        near, numbers = np.take_along_axis(s, top, 1), np.take_along_axis(ranked, top, 1)
        out[some, :width], sims[some, :width] = np.where(np.isfinite(near), numbers, -1), near
    return out, sims


POSTED = "bundle bigint, id array<string>, vector bigint, vector2 bigint, perm binary, code binary"


def bundled(pivots: np.ndarray, size: int) -> np.ndarray:
    """The bundle of every pivot: each goes to the closest of every ``size``-th pivot; bundles of more than twice the
    size are divided, so that none grows with the data's density."""
    heads = pivots[::size]
    nearest = np.concatenate([np.argmax(pivots[a : a + 4096] @ heads.T, axis=1) for a in range(0, len(pivots), 4096)])
    out, number = np.empty(len(pivots), np.int32), 0
    for members in (np.flatnonzero(nearest == h) for h in range(len(heads))):
        for a in range(0, len(members), 2 * size):
            out[members[a : a + 2 * size]] = number
            number += 1
    return out


def posted_in(perm: np.ndarray, bundles: np.ndarray, levels: np.ndarray, posts: int) -> np.ndarray:
    """The bundles of every vector by its order of pivots, -1 where there are fewer.

    A file that ``levels`` doesn't divide lies in the bundle of its pivot. The parts of a divided file are
    bundles of their own, named by the pivot and one or two of the next ones.
    """
    n, depth = perm.shape
    files = perm[:, :posts].astype(np.int64)
    columns = []
    for f in range(files.shape[1]):
        level = levels[files[:, f]]
        columns.append(np.where(level == 0, bundles[files[:, f]], -1))
        if not level.any():
            continue
        others = np.stack([perm[:, r] for r in range(depth) if r != f][:4], axis=1).astype(np.int64)
        base = (files[:, f] + 1) << 32
        for r in range(min(2, others.shape[1])):
            columns.append(np.where(level == 1, base + ((others[:, r] + 1) << 16), -1))
        for a, b in itertools.combinations(range(others.shape[1]), 2):
            low, high = np.minimum(others[:, a], others[:, b]), np.maximum(others[:, a], others[:, b])
            columns.append(np.where(level == 2, base + ((low + 1) << 16) + high + 1, -1))
    return np.stack(columns, axis=1).astype(np.int64) if columns else np.full((n, 0), -1, np.int64)


def _orders(embedding: pa.Array, pivots: np.ndarray, dims: int, depth: int) -> np.ndarray:
    _, x = valid_matrix(embedding, dims)
    return permutations(x, pivots, depth) if len(x) else np.zeros((0, min(depth, len(pivots))), np.int16)


def file_levels(rows: DataFrame, total: int, pivots: np.ndarray, dims: int, depth: int, posts: int, file_rows: int) -> np.ndarray:
    """How often each file is to be divided: 0, by one further pivot (1) or by a pair (2)."""
    levels = np.zeros(len(pivots), np.int8)
    if total * min(posts, len(pivots)) <= file_rows or len(pivots) < 4:
        return levels
    share = min(1.0, SHAPE_ROWS / max(1, total))
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit(12)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("embedding")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(pivots), np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                n += np.bincount(_orders(batch.column(0).slice(a, 2000), pivots, dims, depth)[:, :posts].ravel(), minlength=len(n))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used])], names=["pivot", "n"])

    for r in sample.mapInArrow(count, "pivot int, n bigint").groupBy("pivot").agg(F.sum("n").alias("n")).collect():  # a row of each pivot
        levels[r.pivot] = 0 if r.n / share <= file_rows else 1 if r.n / share <= 32 * file_rows else 2
    return levels


def _poster(pivots: np.ndarray, bundles: np.ndarray, levels: np.ndarray, dims: int, depth: int, posts: int, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, 2000) for a in range(0, batch.num_rows, 2000)):
                rows, x = valid_matrix(part.column(1), dims)
                if not len(rows):
                    continue
                ids = part.column(0).take(pa.array(rows)).to_pylist()
                h1, h2 = (part.column(i).to_numpy()[rows] for i in (2, 3))
                groups: dict[tuple[int, int], list[int]] = {}
                for i, h in enumerate(zip(h1.tolist(), h2.tolist())):
                    groups.setdefault(h, []).append(i)
                firsts = np.array([g[0] for g in groups.values()])
                some = [sorted({ids[i] for i in g})[:keep] for g in groups.values()]
                x = x[firsts]
                perm, code = permutations(x, pivots, depth), coded(x)
                columns = [
                    pa.array(some, pa.list_(pa.string())), pa.array(h1[firsts]), pa.array(h2[firsts]),
                    pa.array([p.tobytes() for p in perm], pa.binary()), pa.array([c.tobytes() for c in code], pa.binary()),
                ]
                where = posted_in(perm, bundles, levels, posts)
                for p in range(where.shape[1]):
                    new = np.flatnonzero((where[:, p] >= 0) & (where[:, :p] != where[:, p : p + 1]).all(axis=1))  # bundles not sent to yet
                    if len(new):
                        rows_ = pa.array(new)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(where[new, p]), *[c.take(rows_) for c in columns]], names=["bundle", "id", "vector", "vector2", "perm", "code"]
                        )

    return run


NEAR = "id string, near array<struct<id: string, cosine: double>>"


def _answer(own: list[list[str]], numbers: np.ndarray, sims: np.ndarray, k: int):
    """(id, [(neighbour, cosine)]) of every id of a file."""
    for g, ids in enumerate(own):
        others = [(-round(float(s), 6), i) for c, s in zip(numbers[g].tolist(), sims[g].tolist()) if c >= 0 for i in own[c]]
        others += [(-1.0, i) for i in ids] if len(ids) > 1 else []
        others.sort()
        for i in ids:
            best, seen = [], {i}
            for s, o in others:
                if o not in seen:
                    seen.add(o)
                    best.append((o, -s))
                    if len(best) == k:
                        break
            yield i, best


def _ranker(k: int, dims: int, rerank: int):
    def run(group):
        entries: dict[tuple[int, int], list[str]] = {}
        first: dict[tuple[int, int], int] = {}
        for r, (h, ids) in enumerate(zip(zip(group.column("vector").to_pylist(), group.column("vector2").to_pylist()), group.column("id").to_pylist())):
            first.setdefault(h, r)
            entries[h] = sorted({*entries[h], *ids})[: k + 1] if h in entries else ids
        hashes = sorted(entries)  # the same order whatever order the rows come in
        part = group.take(pa.array([first[h] for h in hashes]))
        codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.int8).reshape(len(hashes), dims)
        perm = np.frombuffer(b"".join(part.column("perm").to_pylist()), np.int16).reshape(len(hashes), -1)
        numbers, sims = nearest_in_bundle(codes, perm, 2 * k, rerank)
        best: dict[str, list] = {}
        for i, near in _answer([entries[h] for h in hashes], numbers, sims, k):
            best[i] = [*best[i], *near] if i in best else near  # an id with several vectors
        ids = list(best)
        near = [[{"id": o, "cosine": c} for o, c in best[i]] for i in ids]
        return pa.table({"id": pa.array(ids, pa.string()), "near": pa.array(near, pa.list_(pa.struct([("id", pa.string()), ("cosine", pa.float64())])))})

    return run


def sample_pivots(rows: DataFrame, total: int, dims: int, count: int) -> np.ndarray:
    """About ``count`` different valid vectors, chosen by a hash of their id."""
    share = min(1.0, 1.2 * count / max(1, total))
    chosen = rows.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    chosen = chosen.groupBy("id").agg(F.min("embedding").alias("embedding"))  # rows of one id are one pivot
    table = chosen.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(2 * count).toArrow()  # 2 * count rows at most
    _, x = valid_matrix(table.column("embedding"), dims)
    if len(x):
        x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]
    return x[:count]


def k_most_similar(
    df: DataFrame,
    *,
    id: str = "id",
    embedding: str = "embedding",
    k: int = 5,
    dims: int = 1024,
    depth: int = DEPTH,
    posts: int = POSTS,
    pivots_per_root: float = PIVOTS_PER_ROOT,
    rerank: float = RERANK,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """id, near (array of struct id, cosine; at most k, best first) of every valid vector."""
    rows = df.select(F.col(id).cast("string").alias("id"), F.col(embedding).cast("array<float>").alias("embedding")).filter(F.col("id").isNotNull())
    total = df.count()
    count = max(1, min(MAX_PIVOTS, math.ceil(pivots_per_root * math.sqrt(total))))
    pivots = sample_pivots(rows, total, dims, count)
    if not len(pivots) and total:
        pivots = sample_pivots(rows, 0, dims, count)  # a tiny table: all rows
    if not len(pivots):
        return df.sparkSession.createDataFrame([], NEAR)
    hashed = rows.filter(F.size("embedding") == dims).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})
    per_file = max(1.0, total * posts / len(pivots))
    bundles = bundled(pivots, max(1, round(1000 / per_file)))
    levels = file_levels(rows, total, pivots, dims, depth, posts, file_rows)
    posted = hashed.select("id", "embedding", "h1", "h2").mapInArrow(_poster(pivots, bundles, levels, dims, depth, posts, k + 1), POSTED)
    parts = math.ceil(total * posts * (dims + 100) / TASK_BYTES)
    if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        posted = posted.repartition(parts, "bundle")
    ranked = posted.groupBy("bundle").applyInArrow(_ranker(k, dims, max(2 * k, math.ceil(rerank * total**0.25))), NEAR)
    best = F.array_sort(F.transform("all", lambda x: F.struct((-x["cosine"]).alias("far"), x["id"].alias("id"))))
    merged = (
        ranked.groupBy("id")
        .agg(F.flatten(F.collect_list("near")).alias("all"))  # posts * k entries at most
        .select("id", F.slice(F.array_distinct(best), 1, posts * k).alias("all"))
        .select("id", _first_per_id(F.col("all"), k).alias("near"))
    )
    # Copies beyond the k + 1 smallest ids of their vector: their neighbours are the k smallest.
    sound = F.exists("embedding", lambda x: x != 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    members = hashed.select("id", "h1", "h2", sound.alias("sound")).filter("sound").select("id", "h1", "h2").distinct()
    crowded = members.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") > k + 1).select("h1", "h2")
    return merged.unionByName(_followers(members, crowded, merged, k))


def _first_per_id(entries, k: int):
    """The first k entries with different ids, as struct id, cosine."""
    kept = F.filter(entries, lambda x, i: ~F.array_contains(F.transform(F.slice(entries, F.lit(1), i), lambda y: y["id"]), x["id"]))
    return F.transform(F.slice(kept, 1, k), lambda x: F.struct(x["id"].alias("id"), (-x["far"]).alias("cosine")))


def _followers(members: DataFrame, crowded: DataFrame, merged: DataFrame, k: int) -> DataFrame:
    """Answers of the copies that no file holds. The smallest ids of a crowd are found by k + 1 rounds of
    min, each combined on the map side, instead of gathering the crowd."""
    crowd = materialize(members.join(crowded, ["h1", "h2"], "left_semi"), "crowd")
    if crowd.isEmpty():
        return merged.sparkSession.createDataFrame([], NEAR)
    heads = materialize(crowd.groupBy("h1", "h2").agg(F.min("id").alias("last")).withColumn("ids", F.array("last")), "heads")
    for _ in range(k):
        least = crowd.join(heads, ["h1", "h2"]).filter(F.col("id") > F.col("last")).groupBy("h1", "h2").agg(F.min("id").alias("next"))
        heads = materialize(heads.join(least, ["h1", "h2"]).select("h1", "h2", F.col("next").alias("last"), F.concat("ids", F.array("next")).alias("ids")), "heads")
    answers = heads.select("h1", "h2", "last", F.transform(F.slice("ids", 1, k), lambda x: F.struct(x.alias("id"), F.lit(1.0).alias("cosine"))).alias("near"))
    return crowd.join(answers, ["h1", "h2"]).filter(F.col("id") > F.col("last")).select("id", "near")


def neighbour_pairs(near: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: one is among the k most similar of the other."""
    pairs = near.select("id", F.explode("near.id").alias("other"))
    return pairs.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
