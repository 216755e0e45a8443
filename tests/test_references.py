import random
from datetime import datetime as D
from datetime import timedelta

from pyspark.sql import functions as F

from folioscope.operators import bloom as bf
from folioscope.operators.references import disjoint, find_orphans, orphans_by_period

EDGES = "pos long, from_id string, to_id string, created_at timestamp_ntz, extra string, ref string, salt int"
NODES = "node_id string, created_at timestamp_ntz, deleted_at timestamp_ntz, ref string, pos long"


def brute(edges, nodes):
    out = set()
    for pos, *ends, at in [e[:4] for e in edges]:
        for side, ref in zip(("from_id", "to_id"), ends):
            if ref is None or not ref.strip():
                continue
            if not any(k == ref and a is not None and at is not None and a <= at and (u is None or u > at) for k, a, u, *_ in nodes):
                out.add((pos, side))
    return out


def run(spark, edges, nodes):
    e = spark.createDataFrame(edges, EDGES)
    n = spark.createDataFrame(nodes, NODES)
    return sorted((r.row_id, r.side) for r in find_orphans(e, n).collect())


def test_cases(spark):
    t = [D(2024, 1, d) for d in range(1, 10)]
    nodes = [("a", t[1], t[4], "x", 1), ("a", t[6], None, None, 2), ("b", t[0], None, None, 3), ("a ", t[0], None, None, 4), ("c", None, None, None, 5), (None, t[0], None, None, 6)]
    edges = [(i, a, b, at, "x", "y", 1) for i, (a, b, at) in enumerate([("a", "b", t[0]), ("a", "b", t[1]), ("a", None, t[4]), ("a", "", t[5]), ("a", " 　", t[6]), ("A", "a ", t[6]), ("c", "zz", t[6]), ("b", "b", None), ("zz", "zz", t[6]), ("zz", "zz", t[6])])]
    got = run(spark, edges, nodes)
    assert len(got) == len(set(got))
    assert set(got) == brute(edges, nodes)


def test_overlapping_life_spans(spark):
    rng = random.Random(3)
    t = [D(2024, 1, 1) + timedelta(days=d) for d in range(40)]
    nodes = []
    for i in range(400):
        a = rng.randrange(36)
        nodes.append((f"n{rng.randrange(12)}", t[a], rng.choice([t[a], t[min(39, a + rng.randrange(1, 4))], t[max(0, a - 1)], None if i % 60 == 0 else t[a + 1]]), None, 1))
    edges = [(i, f"n{rng.randrange(13)}", f"n{rng.randrange(13)}", rng.choice(t), None, None, 0) for i in range(600)]
    assert set(run(spark, edges, nodes)) == brute(edges, nodes)
    spans = spark.createDataFrame([n[:3] for n in nodes], "p_key string, p_from timestamp_ntz, p_until timestamp_ntz")
    got = sorted((r.p_key, r.p_from, r.p_until or D(2099, 1, 1)) for r in disjoint(spans).collect())
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(got, got[1:]))


def test_empty(spark):
    t = D(2024, 1, 1)
    assert run(spark, [], [("a", t, None, None, 1)]) == []
    assert run(spark, [(1, "a", "b", t, None, None, 0)], []) == [(1, "from_id"), (1, "to_id")]


def test_hot_key_is_salted_and_counted(spark):
    t = [D(2024, 1, d) for d in range(1, 4)]
    edges = [(i, "hot", f"n{i % 7}", t[i % 3], None, None, 0) for i in range(6000)]
    nodes = [("hot", t[1], t[2], None, 1), *[(f"n{i}", t[0], None, None, 2) for i in range(6)]]
    got = run(spark, edges, nodes)
    assert len(got) == len(set(got)) and set(got) == brute(edges, nodes)
    rep = orphans_by_period(find_orphans(spark.createDataFrame(edges, EDGES), spark.createDataFrame(nodes, NODES)), "e").collect()
    assert sum(r.orphans for r in rep) == len(got)


def test_bloom_never_misses_a_key(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    for blocks in (1 << 10, 1 << 12):
        b = bf.build(keys, F.col("k"), blocks)
        assert bf.probe(keys, F.col("k"), b, blocks, "hit").filter("not hit").count() == 0
    other = spark.range(5000, 10000).select(F.col("id").cast("string").alias("k"))
    assert bf.probe(other, F.col("k"), b, blocks, "hit").filter("hit").count() < 500
