import random

import numpy as np
import pytest

from folioscope.llm import word_classes as wc
from folioscope.llm.spam_pages import evidence, find_spam, train

WORDS = "ledger sluice harvest copper window morning signal garden letter engine market copper bridge winter candle orbit".split()
NAMES = [f"{a}{b}" for a in ("Kra", "Pol", "Mer", "Tis", "Gon", "Vul") for b in ("dan", "mir", "keth", "lorn", "bist")]


def prose(rng, n):
    return " ".join(f"The {rng.choice(WORDS)} of {rng.choice(NAMES)} was {rng.choice(['closed', 'opened', 'moved'])} after {rng.randint(2, 90)} days, and the {rng.choice(WORDS)} is in the {rng.choice(WORDS)}." for _ in range(n))


def log(rng, n):
    return "\n".join(f"2024-0{rng.randint(1, 9)}-11 0{rng.randint(0, 9)}:{rng.randint(10, 59)} INFO {rng.choice(WORDS)}={rng.randint(1, 99)}" for _ in range(n))


def links(rng, n):
    return "\n".join(f"- [{rng.choice(NAMES)}](https://{rng.choice(NAMES).lower()}.example/{rng.choice(WORDS)}/{rng.randint(1, 99)})" for _ in range(n))


def stuffed(rng, n):
    keys = rng.sample(NAMES, 4) + ["cheap tool"]
    return " ".join(rng.choice(keys) for _ in range(n))


def glued(rng, n):
    return "".join(rng.choice(["格安", "導入", "マッピング", "比較"]) for _ in range(n))


def tags(rng, n):
    return " ".join(f"#{rng.choice(WORDS)}_{rng.choice(WORDS)}" for _ in range(n))


def corpus(rng, n):
    out = []
    for i in range(n):
        if i % 3 == 0:
            t = rng.choice([links, stuffed, glued, tags])(rng, rng.randint(40, 90))
            out.append((1, t if i % 2 else prose(rng, 1) + "\n" + t))
        else:
            t = rng.choice([prose, log])(rng, rng.randint(5, 25))
            out.append((0, t + ("\n" + links(rng, 1) + "\n#note" if i % 2 else "")))
    return out


def test_held_out_accuracy(spark):
    rng = random.Random(4)
    rows = [(i, y, t) for i, (y, t) in enumerate(corpus(rng, 900))] + [(9000, 0, None), (9001, 0, ""), (9002, 0, " \n "), (9003, 0, "한국어 설명 ภาษาไทย العربية")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, _, t in rows], "doc_id long, text string, is_spam int, key string")
    labels = spark.createDataFrame([(i, y if i % 7 else None) for i, y, _ in rows[:300]], "doc_id long, is_spam int")
    got = [r.doc_id for r in find_spam(docs, labels).collect()]
    assert len(got) == len(set(got))
    held = {i: y for i, y, _ in rows[300:]}
    errors = sum((i in set(got)) != bool(y) for i, y in held.items())
    assert errors <= 0.02 * len(held) and not {9000, 9001, 9002, 9003} & set(got)


def test_without_labels_the_evidence_decides(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(1, prose(rng, 3)), (2, stuffed(rng, 80)), (3, links(rng, 20)), (3, links(rng, 20))], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "doc_id long, is_spam int")
    assert sorted(r.doc_id for r in find_spam(docs, labels).collect()) == [2, 3, 3]
    assert find_spam(docs.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 7])
def test_tokens_do_not_depend_on_the_batch(n):
    rng = random.Random(n)
    texts = [t for _, t in corpus(rng, 20)] + ["", "a", "\n\n", "𠮷野家", "👩‍🔧"]
    whole = wc.tokenize(texts)
    for i, t in enumerate(texts):
        one = wc.tokenize([t])
        mine = whole.kind[whole.doc == i]
        assert np.array_equal(mine, one.kind) and whole.chars[i] == one.chars[0]


def test_evidence():
    rng = random.Random(1)
    share = evidence(wc.tokenize([prose(rng, 4), links(rng, 30), stuffed(rng, 90), glued(rng, 90), tags(rng, 50)]), 2)
    assert share[0] < 0.3 and (share[1:] > 0.6).all()


def test_every_label_is_used(spark):
    n, few = 20_100, 60
    keys = [r.k for r in spark.range(n).selectExpr("id k", "xxhash64(cast(id as int)) h").orderBy("h", "k").collect()]
    spam = spark.createDataFrame([(k,) for k in keys[-few:]], "doc_id long")
    docs = spark.range(n).selectExpr("id doc_id", "concat('The copper of the window was moved after ', id, ' days.') text").join(spam, "doc_id", "left_anti")
    docs = docs.unionByName(spam.selectExpr("doc_id", "repeat('cheap tool ', 40) text"))
    labels = spark.range(n).selectExpr("cast(id as int) doc_id").join(spam.selectExpr("doc_id", "1 is_spam"), "doc_id", "left").selectExpr("doc_id", "coalesce(is_spam, 0) is_spam")
    model = train(docs, labels, key="doc_id", text="text")
    assert model.prose is not None
    assert (model.scores(["cheap tool " * 40]) > 0).all() and (model.scores(["The copper of the window was moved after 7 days."]) < 0).all()
