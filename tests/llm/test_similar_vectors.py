import numpy as np
import pytest

from folioscope.llm.similar_vectors import Lists, k_most_similar, nearest_in_bundle, neighbour_pairs, permutations, posted_in

DIMS = 32
SCHEMA = "id string, embedding array<float>, near string, vector long"


def brute(rows, k):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == DIMS and None not in v and np.isfinite(v).all() and np.any(v):
            seen[i] = np.array(v, float) / np.linalg.norm(v)
    ids = sorted(seen)
    x = np.array([seen[i] for i in ids]).reshape(len(ids), DIMS)
    s = x @ x.T
    out = {}
    for a, i in enumerate(ids):
        out[i] = [ids[b] for b in sorted((b for b in range(len(ids)) if b != a), key=lambda b: (-round(s[a, b], 6), ids[b]))[:k]]
    return out


def clustered(n, rng):
    centres = rng.standard_normal((n // 12, DIMS))
    x = centres[rng.integers(0, len(centres), n)] + 0.35 * rng.standard_normal((n, DIMS))
    return [(f"v{i:05d}", (v * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i, v in enumerate(x)]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = k_most_similar(df, dims=DIMS, **kw).collect()
    assert len(got) == len({r.id for r in got})
    return {r.id: [n.id for n in r.near] for r in got}


@pytest.mark.parametrize("more", [{}, {"rerank": 10, "pivots_per_root": 1}, {"pivots_per_root": 1, "file_rows": 100}, {"pivots_per_root": 0.25, "file_rows": 15}])
def test_recall(spark, more):
    rows = clustered(1500, np.random.default_rng(5))
    got, true = run(spark, rows, k=5, **more), brute(rows, 5)
    assert got.keys() == true.keys() and all(len(v) == 5 or more.get("file_rows") for v in got.values())  # tiny parts may hold fewer
    assert np.mean([len({*got[i]} & {*true[i]}) / 5 for i in true]) >= 0.9


def test_invalid_repeated_and_few(spark):
    v = np.eye(DIMS)
    rows = [("a", v[0].tolist()), ("b", (v[0] * 3).tolist()), ("c", v[1].tolist()), ("c", v[1].tolist()), ("n", None), ("z", [0.0] * DIMS), ("s", [1.0] * 5), ("x", [float("nan")] * DIMS), ("i", [float("inf")] * DIMS), ("m", [None] * DIMS), (None, v[0].tolist())]
    assert run(spark, rows, k=5) == {"a": ["b", "c"], "b": ["a", "c"], "c": ["a", "b"]}
    assert run(spark, [], k=5) == {} and run(spark, rows[4:], k=5) == {}


def test_a_crowd_of_equal_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(f"e{i:04d}", [1.0] * DIMS) for i in range(400)] + [(f"o{i}", rng.standard_normal(DIMS).tolist()) for i in range(40)]
    got = run(spark, rows, k=3)
    assert got.keys() == {i for i, _ in rows}
    for i in range(400):
        assert got[f"e{i:04d}"] == [f"e{j:04d}" for j in range(5) if j != i][:3]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    pairs = [(r.id_a, r.id_b) for r in neighbour_pairs(k_most_similar(df, dims=DIMS, k=3)).collect()]
    assert len(pairs) == len(set(pairs)) and all(a < b for a, b in pairs)


def test_footrule():
    perm = permutations(np.random.default_rng(1).standard_normal((50, 8)), np.random.default_rng(3).standard_normal((12, 8)), 4)

    def distance(a, b):
        rank = lambda p, x: list(p).index(x) if x in p else 4
        return sum(abs(rank(a, x) - rank(b, x)) for x in {*a, *b})
    lists = Lists(perm)
    got = lists.closeness(np.arange(50))
    assert all(distance(perm[a], perm[b]) == 2 * (4 * 5 // 2) - 2 * got[a, b] for a in range(50) for b in range(50))
    assert sorted(np.concatenate(list(lists.blocks())).tolist()) == list(range(50))


def test_only_the_closest_by_footrule_are_reranked():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, DIMS))
    codes = np.rint(x * (127 / np.abs(x).max(axis=1, keepdims=True))).astype(np.int8)
    perm = permutations(x, rng.standard_normal((20, DIMS)), 8)
    close = Lists(perm).closeness(np.arange(300))
    numbers, sims = nearest_in_bundle(codes, perm, 4, 10)
    unit = codes / np.linalg.norm(codes, axis=1, keepdims=True)
    for i in range(300):
        others = np.delete(np.arange(300), i)
        least = np.sort(close[i, others])[-10]
        assert (close[i, numbers[i]] >= least).all() and np.allclose(sims[i], unit[numbers[i]] @ unit[i], atol=1e-5)


def test_divided_files():
    perm = np.array([[3, 1, 2, 0], [1, 3, 0, 2], [2, 0, 1, 3]], np.int16)
    bundles = np.array([7, 8, 9, 9], np.int32)
    whole = posted_in(perm, bundles, np.zeros(4, np.int8), 2)
    assert whole.tolist() == [[9, 8], [8, 9], [9, 7]]
    some = posted_in(perm, bundles, np.array([0, 1, 0, 2], np.int8), 2)
    sent = [{c for c in row if c >= 0} for row in some.tolist()]
    part = lambda f, a, b=-1: ((f + 1) << 32) + ((a + 1) << 16) + b + 1
    assert sent[0] == {part(3, 1, 2), part(3, 0, 1), part(3, 0, 2), part(1, 3), part(1, 2)}
    assert sent[1] == {part(1, 3), part(1, 0), part(3, 0, 1), part(3, 1, 2), part(3, 0, 2)} and sent[2] == {9, 7}
