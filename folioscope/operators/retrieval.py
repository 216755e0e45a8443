"""Retrieval over chunks: exact nearest neighbours, lexical search, fusion, boosts, rerank, provenance.

Every operator takes and returns DataFrames and runs no action. Each top-k has a unique tie-break, so
results do not depend on the order of rows or partitions. A top-k over the corpus keeps k rows a task
(TakeOrderedAndProject); nothing else of the corpus moves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import vector as vec

# Fixed values of the ranking.
KEYWORD_DISCOUNT, GUIDED_BONUS, BOOST_PER_WORD, BOOST_MOST = 0.9, 0.05, 0.02, 0.08
EXACT_JOIN, COARSE_JOIN, CHUNKS_PER_CANDIDATE = 1.0, 0.7, 3


def top_k(df: DataFrame, k: int, score: str, key: str) -> DataFrame:
    """The k best rows by score, ties by key."""
    return df.orderBy(F.desc(score), F.asc(key)).limit(k)


def nearest(df: DataFrame, query: Sequence[float] | Column, k: int, *, key: str, embedding: str = "embedding", where: Column | None = None) -> DataFrame:
    """Exact k nearest vectors by squared Euclidean distance, with score 1 / (1 + distance) of 4 places.

    ``where`` is applied before the search, so it reaches the scan. Vectors of another length are left out.
    """
    target = query if isinstance(query, Column) else vec.literal(query)
    rows = df if where is None else df.filter(where)
    rows = rows.filter(F.col(embedding).isNotNull() & (F.size(embedding) == F.size(target)))
    found = rows.withColumn("distance", vec.squared_l2(F.col(embedding), target))
    return found.orderBy("distance", key).limit(k).withColumn("score", vec.distance_score(F.col("distance")))


def nearest_keys(df: DataFrame, query: Sequence[float], k: int, *, key: str, embedding: str = "embedding", where: Column | None = None, once: bool = False) -> DataFrame:
    """(key, distance, score) of the exact k nearest, computed on Arrow batches.

    For long vectors: a batch is one matrix, of which only its k best rows leave Python, so the JVM sorts k rows a
    batch. Same order and ties as ``nearest``; vectors of another length or with other than finite numbers are left out.
    With ``once`` the rows of a key count as one, the nearest, so that they don't use up the k places.
    """
    import numpy as np
    import pyarrow as pa

    target, dims = np.asarray(query, np.float64), len(query)
    kind = df.schema[key].dataType

    def run(batches):
        for batch in batches:
            keys, column = batch.column(0), batch.column(1)
            sizes = np.diff(column.offsets.to_numpy())
            rows = np.flatnonzero((sizes == dims) & np.asarray(column.is_valid()))
            values = column.values.to_numpy(zero_copy_only=False)
            x = values[column.offsets.to_numpy()[rows][:, None] + np.arange(dims)].astype(np.float64)
            x -= target
            d = np.square(x, out=x).sum(axis=1)
            good = np.isfinite(d)
            rows, d = rows[good], d[good]
            if once:  # the nearest row of each key of the batch
                rows = rows[order := np.argsort(d, kind="stable")]
                first = np.unique(keys.take(pa.array(rows)).dictionary_encode().indices.to_numpy(zero_copy_only=False), return_index=True)[1]
                rows, d = rows[first], d[order][first]
            if len(d) > k:  # all rows at the k-th distance stay, the tie is broken by key later
                some = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                rows, d = rows[some], d[some]
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), pa.array(d)], names=[key, "distance"])

    rows = df if where is None else df.filter(where)
    given = rows.select(key, F.col(embedding).cast("array<float>").alias("embedding")).filter(F.col("embedding").isNotNull())
    found = given.mapInArrow(run, f"`{key}` {kind.simpleString()}, distance double")
    if once:
        found = found.groupBy(key).agg(F.min("distance").alias("distance"))
    return found.orderBy("distance", key).limit(k).withColumn("score", vec.distance_score(F.col("distance")))


#: Numbers of a block of queries that is sent to every worker (8 bytes each), and rows compared with it at once.
QUERY_NUMBERS, ROWS_AT_ONCE = 8_000_000, 2000


def nearest_join(df: DataFrame, queries: DataFrame, k: int, *, key: str, query_key: str, embedding: str = "embedding", query_numbers: int = QUERY_NUMBERS) -> DataFrame:
    """The exact k nearest of every query of a stated set (query_key, key, distance, rank), ties by key.

    The queries are dealt into blocks of a bounded size by a hash of their key, each of which goes over the table
    once. A batch of rows is compared with a block by one matrix product, and only the k best of the batch leave
    Python for each query, so k rows a query and batch are shuffled, whatever the table's size. Vectors of another
    length than a query's, and those with other than finite numbers, are left out.
    """
    q = queries.select(F.col(query_key).alias("q_key"), F.col(embedding).cast("array<double>").alias("q_vec")).filter("q_vec is not null")
    numbers = q.agg(F.sum(F.size("q_vec"))).first()[0] or 0
    blocks = max(1, -(-numbers // query_numbers))
    kinds = (queries.schema[query_key].dataType, df.schema[key].dataType)
    schema = f"q_key {kinds[0].simpleString()}, `{key}` {kinds[1].simpleString()}, distance double"
    rows = df.select(key, F.col(embedding).cast("array<double>").alias("embedding")).filter("embedding is not null")
    best = None
    for b in range(blocks):
        some = q if blocks == 1 else q.filter(F.pmod(F.xxhash64("q_key"), F.lit(blocks)) == b)
        part = rows.mapInArrow(_nearest_of(some.toArrow(), k, kinds, key), schema)  # about query_numbers numbers
        best = part if best is None else best.unionByName(part)
    over = Window.partitionBy("q_key").orderBy("distance", key)
    return best.withColumn("rank", F.row_number().over(over)).filter(F.col("rank") <= k).select(F.col("q_key").alias(query_key), key, "distance", "rank")


def _nearest_of(queries, k: int, kinds: tuple, key: str):
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_type

    def matrices(column):
        """Of every length: (places, matrix) of the vectors with finite numbers only."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        offsets = column.offsets.to_numpy()
        values = column.values.to_numpy(zero_copy_only=False)
        sizes = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        for n in np.unique(sizes[sizes > 0]).tolist():
            places = np.flatnonzero(sizes == n)
            x = values[offsets[places][:, None] + np.arange(n)]
            good = np.isfinite(x).all(axis=1)
            if good.any():
                yield n, places[good], x[good]

    known = {n: (places, x, np.square(x).sum(axis=1)) for n, places, x in matrices(queries.column("q_vec"))} if len(queries) else {}
    q_keys, types = queries.column("q_key"), [to_arrow_type(t) for t in kinds]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ranks = pc.rank(part.column(0), tiebreaker="first").to_numpy()
                for n, places, x in matrices(part.column(1)):
                    if n not in known:
                        continue
                    q_places, y, y2 = known[n]
                    near = np.square(x).sum(axis=1)[None, :] + y2[:, None] - 2 * (y @ x.T)
                    kth = min(k, len(places)) - 1
                    bound = np.partition(near, kth, axis=1)[:, kth]
                    # of the rows about as near as the k-th the distances are taken from the differences, then k stay
                    r, c = np.nonzero(near <= (bound + 1e-9 * (1 + y2 + np.abs(bound)))[:, None])
                    far = np.square(y[r] - x[c]).sum(axis=1)
                    order = np.lexsort((ranks[places[c]], far, r))
                    r, c, far = r[order], c[order], far[order]
                    stay = np.arange(len(r)) - np.searchsorted(r, r) < k
                    r, c, far = r[stay], c[stay], far[stay]
                    yield pa.RecordBatch.from_arrays(
                        [q_keys.take(pa.array(q_places[r])).combine_chunks().cast(types[0]), part.column(0).take(pa.array(places[c])).cast(types[1]), pa.array(far)],
                        names=["q_key", key, "distance"],
                    )

    return run


def keyword_score(text: Column, words: Sequence[str]) -> Column:
    """Share of the words that occur in the text as written."""
    if not words:
        return F.lit(0.0)
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words]) / F.lit(float(len(words)))


def keyword_search(df: DataFrame, words: Sequence[str], k: int, *, key: str, text: str = "text", where: Column | None = None, once: bool = False) -> DataFrame:
    """The k texts with most of the words, over the whole table. With ``once`` the rows of a key count as one: (key, score), the best."""
    rows = df if where is None else df.filter(where)
    hits = rows.withColumn("score", F.round(keyword_score(F.col(text), words), 4)).filter("score > 0")
    return top_k(hits.groupBy(key).agg(F.max("score").alias("score")) if once else hits, k, "score", key)


def keyword_boost(hits: DataFrame, words: Sequence[str], *, text: str = "text", score: str = "score") -> DataFrame:
    """Scores raised for every word of the query in the text (any case, repeated words count again), up to a limit."""
    low = F.lower(text)
    count = reduce(lambda a, b: a + b, [low.contains(w.lower()).cast("int") for w in words], F.lit(0))
    return hits.withColumn(score, F.round(F.least(F.lit(1.0), F.col(score) + F.least(F.lit(BOOST_MOST), count * BOOST_PER_WORD)), 4))


def fuse(vector_hits: DataFrame, keyword_hits: DataFrame, *, key: str, k: int | None = None, discount: float = KEYWORD_DISCOUNT) -> DataFrame:
    """Hits of both searches by key: the larger of the vector score and the discounted keyword score.

    ``source`` says which search the row is of; at a tie the vector's wins.
    """
    v = vector_hits.select(F.col(key).alias("v_key"), F.col("score").alias("v"))
    w = keyword_hits.select(F.col(key).alias("k_key"), F.round(F.col("score") * discount, 4).alias("k"))
    wins = F.col("k").isNull() | (F.col("v") >= F.col("k"))
    both = v.join(w, F.col("v_key") == F.col("k_key"), "full_outer").select(
        F.coalesce("v_key", "k_key").alias(key),
        F.greatest("v", "k").alias("score"),
        F.when(wins & F.col("v").isNotNull(), "vector").otherwise("keyword").alias("source"),
        (F.col("v").isNotNull() & F.col("k").isNotNull()).alias("in_both"),
    )
    return both if k is None else top_k(both, k, "score", key)


def fuse_guided(guided: DataFrame, standard: DataFrame, *, key: str, k: int | None = None, bonus: float = GUIDED_BONUS) -> DataFrame:
    """Guided hits that the standard search missed get a bonus; hits of both keep the guided row as it is."""
    g, s = guided.select(F.col(key).alias("g_key"), F.col("score").alias("g")), standard.select(F.col(key).alias("s_key"), F.col("score").alias("s"))
    out = g.join(s, F.col("g_key") == F.col("s_key"), "full_outer").select(
        F.coalesce("g_key", "s_key").alias(key),
        F.when(F.col("g").isNull(), F.col("s")).when(F.col("s").isNull(), F.least(F.lit(1.0), F.round(F.col("g") + bonus, 4))).otherwise(F.col("g")).alias("score"),
        F.when(F.col("g").isNotNull(), "guided").otherwise("standard").alias("source"),
    )
    return out if k is None else top_k(out, k, "score", key)


def provenance(candidates: DataFrame, chunks: DataFrame, *, candidate: str, key: str = "chunk_id", per_candidate: int = CHUNKS_PER_CANDIDATE) -> DataFrame:
    """Chunks of graph candidates: those of the same sheet, or, where a candidate has none, of the same workbook.

    Candidates and chunks have project_id, workbook_name, sheet_name; a candidate also score. Of each candidate
    at most ``per_candidate`` chunks, by key; the score is multiplied with the confidence of the join.
    The tier is decided by counts per sheet and workbook, which are combined before they move; a workbook that
    holds most of the chunks then gives its first chunks only.
    """
    book, page = ["project_id", "workbook_name"], ["project_id", "workbook_name", "sheet_name"]
    known = chunks.filter("coalesce(workbook_name, '') <> ''").select(*page, key).distinct()
    first = lambda by: known.withColumn("n", F.row_number().over(Window.partitionBy(*by, "salt").orderBy(key))).filter(F.col("n") <= per_candidate).withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(key))).filter(F.col("n") <= per_candidate)
    known = known.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(16)))
    wanted = candidates.select(candidate, *page, F.col("score").alias("c_score")).filter("coalesce(workbook_name, '') <> ''")
    exact = wanted.filter("coalesce(sheet_name, '') <> ''").join(first(page).select(*page, key), page).withColumn("tier", F.lit(1))
    coarse = wanted.join(exact.select(candidate).distinct(), candidate, "left_anti").join(first(book).select(*book, key), book).withColumn("tier", F.lit(2))
    sure = F.when(F.col("tier") == 1, F.lit(EXACT_JOIN)).otherwise(F.lit(COARSE_JOIN))
    return exact.unionByName(coarse.select(exact.columns)).select(candidate, key, "tier", F.round(F.col("c_score") * sure, 4).alias("score"))


def new_only(candidates: DataFrame, initial: DataFrame, *, key: str) -> DataFrame:
    """Candidates that the first search did not find, each once (its best score)."""
    best = candidates.groupBy(key).agg(F.max("score").alias("score"))
    return best.join(initial.select(key), key, "left_anti")


def ranks(hits: DataFrame, *, key: str, score: str = "score", name: str = "rank") -> DataFrame:
    """(key, rank) of a result list. The list is a top-k, so one window over it is small."""
    return hits.select(key, F.row_number().over(Window.orderBy(F.desc(score), key)).alias(name))


def compare_ranks(before: DataFrame, after: DataFrame, *, key: str) -> DataFrame:
    b, a = ranks(before, key=key, name="rank_before"), ranks(after, key=key, name="rank_after")
    return a.join(b, key, "left").withColumn("moved", F.col("rank_before") - F.col("rank_after"))


def rerank(hits: DataFrame, model: Callable[[Column], Column], *, key: str, text: str, k: int = 5, candidates: int = 30) -> DataFrame:
    """The first ``candidates`` hits in the order of a model's scores; ``model`` makes a score column of a text column.

    Where the model gives no score (null), the hit keeps its place behind those that have one.
    """
    some = top_k(hits, candidates, "score", key).withColumn("model_score", model(F.col(text)))
    return some.orderBy(F.desc_nulls_last("model_score"), F.desc("score"), key).limit(k)


def lexical_model(query: str) -> Callable[[Column], Column]:
    """The offline default of the rerank: share of the query's words that the text holds."""
    import re

    words = list(dict.fromkeys(re.findall(r"[A-Za-z0-9_]{2,}|[一-鿿゠-ヿ]{2,}", query)))
    return lambda text: keyword_score(F.lower(text), [w.lower() for w in words])


def best_entities(entities: DataFrame, *, text: str = "text", confidence: str = "confidence", place: str = "place") -> DataFrame:
    """Entities that differ in case only, as one: the surest, at a tie the first."""
    row = F.struct(*[F.col(c) for c in entities.columns])
    best = F.max_by(row, F.struct(F.col(confidence), -F.col(place)))
    return entities.groupBy(F.lower(text).alias("entity_key")).agg(best.alias("e")).select("e.*")


def order_entities(entities: DataFrame, sources: Sequence[str] = ("query", "rewrite", "chunk"), most: int = 20) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
    return entities.withColumn("source_place", place).orderBy(F.desc("confidence"), "source_place", "text").limit(most)
