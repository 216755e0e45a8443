import random

import numpy as np

from folioscope.llm.leakage import RUN, Matrix, find_leaks, gram_hashes, latent_axes, lcs_length, letters_and_digits, near_pairs

WORDS = [f"{a}{b}{c}" for a in ("ka", "mo", "ri", "te", "su") for b in ("lan", "dor", "vek", "pim") for c in ("", "th", "or", "ex")]


def sentence(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def brute(docs, items, run=RUN):
    out = set()
    for i, t in items:
        t = letters_and_digits(t or "")
        grams = {t[k : k + run] for k in range(len(t) - run + 1)}
        for d, text in docs:
            x = letters_and_digits(text or "")
            if any(x[k : k + run] in grams for k in range(len(x) - run + 1)):
                out.add((d, i))
    return out


def corpus():
    rng = random.Random(3)
    items = [(i, "Explain, in the order of the ledger, how " + sentence(rng, 40) + f" {rng.randint(100, 999)}.") for i in range(30)] + [(30, None), (31, "short"), (32, "")]
    docs = [(d, sentence(rng, rng.randint(0, 300))) for d in range(150)]
    for d in range(150, 260):
        i, t = items[d % 30]
        plain = letters_and_digits(t)
        at, n = rng.randint(0, len(plain) - 60), rng.choice([40, 48, 49, 50, 51, 60])
        piece = plain[at : at + n].upper()
        docs.append((d, sentence(rng, rng.randint(0, 90)) + ". " + " - ".join(piece[k : k + 7] for k in range(0, len(piece), 7)) + "! " + sentence(rng, 20)))
    return docs + [(400, None), (401, ""), (402, items[0][1]), (403, items[0][1]), (404, "x" * 300_000 + items[1][1]), (404, items[1][1]), (None, items[2][1])], items


def test_no_pair_is_lost(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "doc_id long, text string, item_id int, part string")
    i = spark.createDataFrame([(a, b, 0) for a, b in items], "item_id long, text string, doc_id int")
    got = [(r.doc_id, r.item_id) for r in find_leaks(d, i).filter("exact").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items)
    assert find_leaks(d.limit(0), i).count() == 0 and find_leaks(d, i.limit(0)).count() == 0


def test_paraphrase_needs_its_figures(spark):
    text = "the kiln pays 483 tokens for each violet seal yet refunds only 558 of the crates in the morning"
    near = "the kiln now pays 483 tokens for every violet seal but refunds only 558 of its crates each morning"
    docs = spark.createDataFrame([(1, near), (2, near.replace("558", "557")), (3, "nothing of the kind " * 5)], "doc_id long, text string")
    items = spark.createDataFrame([(9, text)], "item_id long, text string")
    assert [(r.doc_id, r.exact) for r in find_leaks(docs, items, paraphrase=0.3).collect()] == [(1, False)]


def test_hashes_and_lcs():
    s = "abcabcabcx日本語日本語" * 3
    codes = np.frombuffer(s.encode("utf-32-le"), np.uint32).astype(np.uint64)
    for n in (1, 2, 3, 7, 12, len(s), len(s) + 1):
        h = gram_hashes(codes, n).tolist()
        assert len(h) == max(0, len(s) - n + 1)
        assert len(set(zip(h, (s[k : k + n] for k in range(len(h)))))) == len(set(h)) == len({s[k : k + n] for k in range(len(h))})
    assert lcs_length("abcde", "xaybzce") == 4 and lcs_length("", "a") == 0


def test_axes_are_those_of_the_exact_decomposition(spark):
    rng = np.random.default_rng(1)
    topics = rng.integers(0, 512, (9, 14))
    known = [rng.choice(topics[rng.integers(0, 9)], 10).astype(np.uint16).tobytes() for _ in range(80)]
    idf = np.linspace(1, 2, 512)
    docs, own = Matrix(known[:60], idf), Matrix(known[60:], idf)
    energy = float(np.square(docs.val).sum())
    axes = latent_axes(spark.createDataFrame([(k,) for k in known[:60]], "terms binary"), own, idf, energy, rank=5, rounds=8)
    a, b = docs.times(np.eye(512)), own.times(np.eye(512))
    gram = a.T @ a / energy + b.T @ b / np.square(own.val).sum()
    exact = np.linalg.eigh(gram)[1][:, ::-1][:, :5]
    assert np.linalg.norm(exact.T @ axes) ** 2 > 4.9


def test_items_beyond_the_bound_are_searched_for_in_groups(spark):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    longest = max(len(t or "") for _, t in items)
    assert sum(len(t or "") for _, t in items) > 2 * 3 * longest
    got = {(r.doc_id, r.item_id) for r in find_leaks(d, i, max_item_chars=3 * longest).filter("exact").collect()}
    assert got == brute(docs, items)


def test_near_pairs_in_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.standard_normal((30, 6)), rng.standard_normal((50, 6))))
    monkeypatch.setattr("folioscope.llm.leakage.ITEM_BLOCK", 7)
    r, c, s = near_pairs(a, b, 0.4)
    assert list(zip(r.tolist(), c.tolist())) == [tuple(x) for x in np.argwhere(a @ b.T >= 0.4).tolist()] and len(r)
    assert np.allclose(s, (a @ b.T)[r, c])


def test_planted_paraphrases(spark):
    """Every sixth word another: no run of 50 is left, yet 9 of 10 are found, and the search is no product of all with all."""
    rng = random.Random(8)
    items = [(i, sentence(rng, 60)) for i in range(40)]
    docs = [(d, sentence(rng, 200)) for d in range(200)]
    for i, t in items:
        words = t.split()
        words[i % 5 :: 6] = [f"zq{w}" for w in rng.choices(WORDS, k=len(words[i % 5 :: 6]))]
        docs.append((1000 + i, sentence(rng, 50) + " " + " ".join(words) + " " + sentence(rng, 50)))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(d, i, paraphrase=0.6).collect()}
    true = {(1000 + i, i) for i, _ in items}
    assert not brute(docs, items) & true
    assert len(got & true) >= 0.9 * len(true) and len(got - true) <= 0.1 * len(true)
