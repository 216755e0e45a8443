"""Property graphs as two tables: nodes (id, ...) and edges (from, to, type, ...).

Build, repair, search and traverse with joins. Order, where it matters, is an explicit position column.
Hot keys (a node with a tenth or a third of all edges) never go to one task as a whole: limits per node
are taken within salts first, counts are combined on the map side, and joins on a node's id are left to
adaptive skew handling, which splits the side of the edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.text import normalize_id, strip
from folioscope.runtime import materialize


def top_n_per(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, spread: str, salts: int = 16) -> DataFrame:
    """At most ``n`` rows of each group, in order. Taken within salts of ``spread`` first, so that a hot group is cut where it lies."""
    within = Window.partitionBy(*by, "salt").orderBy(*order)
    cut = df.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salts))).withColumn("n_", F.row_number().over(within)).filter(F.col("n_") <= n)
    return cut.withColumn("n_", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("n_") <= n).drop("n_", "salt")


def latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Upsert: of every key the row that is last by ``order`` (which must be unique within a key)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.col(key).alias("k_")).agg(F.max_by(row, F.struct(*order)).alias("r")).select("r.*")


def first_of(df: DataFrame, key: str, position: str) -> DataFrame:
    """Of every key the row that came first."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(F.col(key).alias("k_")).agg(F.min_by(row, F.col(position)).alias("r")).select("r.*")


def merge_entities(nodes: DataFrame, key: str, *, fields: Sequence[str], position: str = "pos", confidence: str = "confidence", name: str = "name") -> DataFrame:
    """Rows of one canonical key as one entity: of every field the non-empty value of the surest row (the first at a tie).

    Other names of the entity are kept as sorted ``aliases``. Null confidence counts as 0. All aggregates but
    the aliases combine to one value a task; aliases are distinct names, of which an entity has few.
    """
    sure = F.struct(F.coalesce(F.col(confidence), F.lit(0.0)), -F.col(position))
    given = lambda f: (F.col(f).isNotNull() & (F.col(f).cast("string") != "")) if f != confidence else F.col(f).isNotNull()
    best = [F.max_by(F.when(given(f), F.col(f)), F.when(given(f), sure)).alias(f) for f in fields]
    merged = nodes.groupBy(key).agg(
        F.min(position).alias(position), F.max(confidence).alias(confidence), F.count("*").alias("rows"), *best,
        F.array_sort(F.collect_set(F.when(given(name), F.col(name)))).alias("names_"),
    )
    return merged.withColumn("aliases", F.filter("names_", lambda x: x != F.col(name))).drop("names_")


def resolve(refs: DataFrame, ref: str, lookups: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Endpoints resolved by the first of several lookups that knows them: adds ``target`` and ``strategy``.

    Each lookup has (key, target) with one row per key. References that none knows keep a null target
    and the strategy ``unresolved``; no reference is dropped.
    """
    out = refs
    targets, names = [], []
    for i, (name, table) in enumerate(lookups):
        out = out.join(table.select(F.col("key").alias(f"k{i}_"), F.col("target").alias(f"t{i}_")), F.col(ref) == F.col(f"k{i}_"), "left").drop(f"k{i}_")
        targets.append(F.col(f"t{i}_"))
        names.append(F.when(F.col(f"t{i}_").isNotNull(), F.lit(name)))
    done = out.withColumn("target", F.coalesce(*targets)).withColumn("strategy", F.coalesce(*names, F.lit("unresolved")))
    return done.drop(*[f"t{i}_" for i in range(len(lookups))])


def name_lookup(nodes: DataFrame, *, node: str, key: Column) -> DataFrame:
    """(key, target) of keys that name exactly one node."""
    return nodes.select(key.alias("key"), F.col(node).alias("t")).filter("key is not null and key <> ''").groupBy("key").agg(F.min("t").alias("target"), F.max("t").alias("most")).filter("target = most").drop("most")


def numbered(df: DataFrame, order: str, name: str = "number", start: int = 1) -> DataFrame:
    """Consecutive numbers in the order of a column, without a window over the whole table: rows are ranged over
    tasks, counted per range, and numbered within their range from the count before it."""
    ranged = materialize(df.repartitionByRange(F.col(order)).withColumn("range_", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("range_").agg(F.count("*").alias("n_"))  # one row per range
    before = counts.select("range_", (F.sum("n_").over(Window.orderBy("range_")) - F.col("n_")).alias("before_"))
    place = F.row_number().over(Window.partitionBy("range_").orderBy(order))
    return ranged.join(F.broadcast(before), "range_").withColumn(name, F.col("before_") + place + (start - 1)).drop("range_", "before_")


# -- checks and repair ----------------------------------------------------------------------------------------------------


def dangling(edges: DataFrame, nodes: DataFrame, *, node: str = "node_id", ends: Sequence[str] = ("from_id", "to_id")) -> DataFrame:
    """Edges of which an end is missing or no node's id."""
    known = nodes.select(F.col(node).alias("known_")).distinct()
    out = edges
    for i, end in enumerate(ends):
        out = out.join(known.withColumn(f"hit{i}_", F.lit(True)), F.col(end) == F.col("known_"), "left").drop("known_")
    bad = ~(F.coalesce("hit0_", F.lit(False)) & F.coalesce("hit1_", F.lit(False)))
    return out.filter(bad).drop("hit0_", "hit1_")


def connected(edges: DataFrame, nodes: DataFrame, *, node: str = "node_id", ends: Sequence[str] = ("from_id", "to_id")) -> DataFrame:
    """Edges both of whose ends are nodes."""
    known = nodes.select(F.col(node).alias("known_"))
    for end in ends:
        edges = edges.join(known, F.col(end) == F.col("known_"), "left_semi")
    return edges


def isolated(nodes: DataFrame, edges: DataFrame, *, node: str = "node_id", ends: Sequence[str] = ("from_id", "to_id")) -> DataFrame:
    used = edges.select(F.explode(F.array(*ends)).alias("used_")).filter("used_ is not null").distinct()
    return nodes.join(used, F.col(node) == F.col("used_"), "left_anti")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")


def display_graph(nodes: DataFrame, edges: DataFrame, *, types: Sequence[str], layers: Sequence[str], node: str = "node_id") -> tuple[DataFrame, DataFrame]:
    """Nodes of the types and layers shown, and the edges between them that were not rejected."""
    shown = nodes.filter(F.col("label").isin(*types) & F.coalesce("layer", F.lit("semantic")).isin(*layers))
    kept = connected(edges.filter(F.coalesce("review_status", F.lit("verified")) != "rejected"), shown, node=node)
    return shown, kept


# -- search and traversal ---------------------------------------------------------------------------------------------------


def name_search(nodes: DataFrame, terms: DataFrame, *, term: str, node: str = "node_id", name: str = "name", per_term: int | None = 10, few_terms: int = 1000) -> DataFrame:
    """Nodes whose name holds a term, in any case, at most ``per_term`` of each term, by node id (all if None).

    Up to ``few_terms`` terms are broadcast and compared with every name; more are found by ``contains_join``, with the same result."""
    t = terms.select(F.col(term).alias("term_"), F.lower(term).alias("low_")).filter("low_ <> ''").distinct()
    if t.count() <= few_terms:
        hits = nodes.join(F.broadcast(t), F.lower(name).contains(F.col("low_"))).select(F.col("term_").alias(term), node, name).distinct()
    else:
        names = nodes.select(F.col(name).alias("name_")).filter("name_ is not null").distinct()
        held = contains_join(names, t, text_key="name_", text="name_", name_key="term_", name="term_", blank=True)
        hits = nodes.join(held, F.col(name) == F.col("name_")).select(F.col("term_").alias(term), node, name).distinct()
    return hits if per_term is None else top_n_per(hits, [term], [F.col(node), F.col(name)], per_term, node)


GRAM = 3
#: Names that are looked for with one automaton on every worker: their number and their characters are checked.
MAX_NAMES, MAX_NAME_CHARS = 200_000, 10_000_000


def contains_join(texts: DataFrame, names: DataFrame, *, text_key: str, text: str, name_key: str, name: str, blank: bool = False) -> DataFrame:
    """(text_key, name_key) where the text holds the name, in any case, without comparing every text with every name.

    Up to ``MAX_NAMES`` names become one automaton that passes over each text once, where it is read. More names
    are joined by grams. Null and blank names are in no text (only empty ones with ``blank``); rows with the same key give one pair.
    """
    n = names.select(F.col(name_key).alias("n_key"), F.lower(name).alias("low_")).filter(F.col("low_") != "" if blank else F.col("low_").rlike(r"(?U)\S")).distinct()
    t = texts.select(F.col(text_key).alias("t_key"), F.lower(text).alias("text_")).filter("text_ is not null and text_ <> ''")
    size = n.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length("low_")), F.lit(0)).alias("chars")).first()
    try:
        import ahocorasick  # noqa: F401

        small = size.rows <= MAX_NAMES and size.chars <= MAX_NAME_CHARS
    except ImportError:
        small = False
    hits = _automaton_join(t, n, size.rows) if small else _gram_join(t, n)
    return hits.select(F.col("t_key").alias(text_key), F.col("n_key").alias(name_key)).distinct()


def _automaton_join(t: DataFrame, n: DataFrame, rows: int) -> DataFrame:
    import ahocorasick
    import pyarrow as pa

    by_name: dict[str, list] = {}
    for r in n.collect() if rows else []:
        by_name.setdefault(r.low_, []).append(r.n_key)

    def find(batches):
        machine = ahocorasick.Automaton()
        for word in by_name:
            machine.add_word(word, word)
        if by_name:
            machine.make_automaton()
        for batch in batches:
            keys, found = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in {w for _, w in machine.iter(text)} if by_name else ():
                    for name_key in by_name[word]:
                        keys.append(key)
                        found.append(name_key)
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(found, name_type)], names=["t_key", "n_key"])

    from pyspark.sql.pandas.types import to_arrow_type

    name_type = to_arrow_type(n.schema["n_key"].dataType)
    return t.mapInArrow(find, f"t_key {t.schema['t_key'].dataType.simpleString()}, n_key {n.schema['n_key'].dataType.simpleString()}")


def _gram_join(t: DataFrame, n: DataFrame) -> DataFrame:
    """Every text gives its distinct grams (without the text), every name the one that fewest names have, so that a
    common beginning doesn't pair all texts with all such names; pairs with equal grams get their text back and are
    verified by the containment itself."""

    def grams(size: int, of: str = "text_"):
        every = F.transform(F.sequence(F.lit(1), F.length(of) - (size - 1)), lambda i: F.substring(F.col(of), i, F.lit(size)))
        return F.when(F.length(of) >= size, every).otherwise(F.array().cast("array<string>"))

    own = n.select("n_key", "low_", F.explode(F.when(F.length("low_") < GRAM, F.array("low_")).otherwise(F.array_distinct(grams(GRAM, "low_")))).alias("gram"))
    shared = own.groupBy("gram").agg(F.count("*").alias("names_"))
    names = own.join(shared, "gram").groupBy("n_key", "low_").agg(F.min_by("gram", F.struct("names_", "gram")).alias("gram"))
    keyed = t.select("t_key", F.xxhash64("text_").alias("text_id"), "text_")
    pairs = keyed.select("t_key", "text_id", F.explode(F.array_distinct(F.concat(*[grams(s) for s in range(1, GRAM + 1)]))).alias("gram")).join(names, "gram")
    return pairs.select("t_key", "text_id", "n_key", "low_").join(keyed, ["t_key", "text_id"]).filter(F.col("text_").contains(F.col("low_")))


def both_ways(edges: DataFrame, *, edge: str = "id", ends: Sequence[str] = ("from_id", "to_id"), kind: str = "relationship") -> DataFrame:
    """Every edge in both directions: (a, b, edge, kind, forward). A loop comes once."""
    way = F.explode(
        F.when(F.col(ends[0]) == F.col(ends[1]), F.array(F.struct(F.col(ends[0]).alias("a"), F.col(ends[1]).alias("b"), F.lit(True).alias("forward")))).otherwise(
            F.array(F.struct(F.col(ends[0]).alias("a"), F.col(ends[1]).alias("b"), F.lit(True).alias("forward")), F.struct(F.col(ends[1]).alias("a"), F.col(ends[0]).alias("b"), F.lit(False).alias("forward")))
        )
    )
    given = edges.filter(F.col(ends[0]).isNotNull() & F.col(ends[1]).isNotNull())
    return given.select(F.col(edge).alias("edge"), F.col(kind).alias("kind"), way.alias("w")).select("w.a", "w.b", "edge", "kind", "w.forward")


def expand_one(seeds: DataFrame, edges: DataFrame, *, seed: str, kinds: Sequence[str], per_seed: int = 10, score: float = 0.6) -> DataFrame:
    """Neighbours of seeds over edges of the listed kinds, in both directions, at most ``per_seed`` each."""
    ways = both_ways(edges.filter(F.col("relationship").isin(*kinds)))
    hits = seeds.select(F.col(seed).alias("a")).distinct().join(ways, "a").select(F.col("a").alias("seed"), F.col("b").alias("found"), "kind", "edge").distinct()
    return top_n_per(hits, ["seed"], [F.col("found"), F.col("edge")], per_seed, "edge").withColumn("score", F.lit(score))


def expand_two(seeds: DataFrame, edges: DataFrame, *, seed: str, kinds: Sequence[str], per_seed: int = 5, score: float = 0.5) -> DataFrame:
    """Nodes two edges away; no edge is walked twice, the seed itself is not found."""
    ways = both_ways(edges.filter(F.col("relationship").isin(*kinds))).distinct()
    one = seeds.select(F.col(seed).alias("a")).distinct().join(ways, "a").select(F.col("a").alias("seed"), F.col("b").alias("m"), F.col("edge").alias("e1"), F.col("kind").alias("k1"))
    two = one.join(ways.select(F.col("a").alias("m"), F.col("b").alias("found"), F.col("edge").alias("e2"), F.col("kind").alias("k2")), "m")
    hits = two.filter("e1 <> e2 and found <> seed").select("seed", "found", F.concat_ws("/", "k1", "k2").alias("path"), F.concat_ws("/", "e1", "e2").alias("edges")).distinct()
    return top_n_per(hits, ["seed"], [F.col("found"), F.col("edges")], per_seed, "edges").withColumn("score", F.lit(score))


def walks(seeds: DataFrame, edges: DataFrame, *, seed: str, depth: int, directed: bool = True) -> DataFrame:
    """(seed, found, length, walked edges) of all walks of 1 to ``depth`` edges without walking an edge twice."""
    ways = both_ways(edges)
    ways = (ways.filter("forward") if directed else ways).select(F.col("a").alias("at"), F.col("b").alias("next"), "edge").distinct()
    front = seeds.select(F.col(seed).alias("seed")).distinct().select("seed", F.col("seed").alias("at"), F.array().cast("array<string>").alias("walked"))
    out = None
    for length in range(1, depth + 1):
        front = front.join(ways, "at").filter(~F.array_contains("walked", F.col("edge"))).select("seed", F.col("next").alias("at"), F.concat("walked", F.array("edge")).alias("walked"))
        step = front.select("seed", F.col("at").alias("found"), F.lit(length).alias("length"), "walked")
        out = step if out is None else out.unionByName(step)
    return out


def reachable(seeds: DataFrame, edges: DataFrame, *, seed: str, most_steps: int | None = None) -> DataFrame:
    """(seed, found, steps) of all nodes reachable along edges, each at its fewest steps. Every step is written, so
    the lineage stays short; it ends when a step finds nothing new. More than ``most_steps``, if given, are refused."""
    ways = edges.select(F.col("from_id").alias("at"), F.col("to_id").alias("next")).filter("at is not null and next is not null").distinct()
    found = materialize(seeds.select(F.col(seed).alias("seed")).distinct().select("seed", F.col("seed").alias("found"), F.lit(0).alias("steps")), "found")
    front = found
    for step in count(1):
        fresh = front.join(ways, F.col("found") == F.col("at")).select("seed", F.col("next").alias("found")).distinct().join(found.select("seed", "found"), ["seed", "found"], "left_anti")
        front = materialize(fresh.withColumn("steps", F.lit(step)), "front")
        if front.isEmpty():
            break
        if most_steps is not None and step > most_steps:
            raise ValueError("nodes beyond the most steps")
        found = found.unionByName(front)
        if step % 20 == 0:  # else the plan grows with every step
            found = materialize(found, "found")
    return found.filter("steps > 0")


# -- text of statements -----------------------------------------------------------------------------------------------------


def escaped(c: Column, most: int = 500) -> Column:
    """A string literal's inside: quotes and backslashes escaped, line ends as blanks, semicolons full-width."""
    out = F.substring(F.coalesce(c.cast("string"), F.lit("")), 1, most)
    out = F.replace(out, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("'"), F.lit("\\'"))
    return F.replace(F.regexp_replace(out, r"\r\n|[\r\n]", " "), F.lit(";"), F.lit("；"))


def node_statements(nodes: DataFrame, *, node: str = "node_id", label: str = "label", properties: Sequence[str] = ("name", "project_id")) -> DataFrame:
    """(statement): MERGE of every node with its non-blank properties."""
    sets = F.array_join(F.array_compact(F.array(*[F.when(strip(F.col(p)) != "", F.concat(F.lit(f"n.{p} = '"), escaped(F.col(p)), F.lit("'"))) for p in properties])), ", ")
    kind = F.regexp_replace(F.coalesce(label, F.lit("Entity")), r"[^A-Za-z0-9_]", "_")
    head = F.concat(F.lit("MERGE (n:"), kind, F.lit(" {id: '"), escaped(F.col(node)), F.lit("'})"))
    return nodes.select(F.concat(head, F.when(sets != "", F.concat(F.lit(" SET "), sets)).otherwise(""), F.lit(";")).alias("statement"))


def edge_statements(edges: DataFrame, *, edge: str = "id") -> DataFrame:
    kind = F.regexp_replace("relationship", r"[^A-Za-z0-9_]", "_")
    parts = ["MATCH (a {id: '", F.col("from_id"), "'}), (b {id: '", F.col("to_id"), "'}) MERGE (a)-[r:", kind, " {id: '", F.col(edge), "'}]->(b);"]
    return edges.select(F.concat(*[F.lit(p) if isinstance(p, str) else (p if p is kind else escaped(p)) for p in parts]).alias("statement"))


def node_key(name: Column) -> Column:
    return normalize_id(name, "unicode")
