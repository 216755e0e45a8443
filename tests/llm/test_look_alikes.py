import itertools

from folioscope.llm.look_alikes import LookAlikes

SAME = [
    ["Order Hub", "Ｏｒｄｅｒ Ｈｕｂ", "Оrder Hub", "Order Hub", "Order　Hub", "Or​der Hub", "Order Hub﻿", "Οrder Hub"],
    ["café", "café", "сafé", "caf­é", "cafе́"],
    ["データ", "ﾃﾞｰﾀ", "データ"], ["Å", "Å", "Å"], ["ё", "ë"], ["👩‍🔧 x", "👩‍🔧 x"],
    ["order hub"], ["Order  Hub"], ["Order\nHub"], ["OrderHub"], ["0rder Hub"], ["cafe"], ["①"], ["1"], ["²"], ["2"], ["👩🔧 x"], ["Order\r\nHub"],
]
ROWS = [(i, t) for i, t in enumerate(itertools.chain(*SAME, ["Order Hub", None, "", " 　", "​"]))]
SCHEMA = "pos long, name string, raw string, class_id long"


def brute():
    of = {t: k for k, ts in enumerate(SAME) for t in ts}
    rows = [(p, t) for p, t in ROWS if t in of]
    return {(a, b) for (a, x), (b, y) in itertools.combinations(rows, 2) if x != y and of[x] == of[y]}


def test_pairs(spark):
    df = spark.createDataFrame([(p, t, "x", 0) for p, t in ROWS], SCHEMA)
    got = [(r.row_a, r.row_b) for r in LookAlikes(df, row_id="pos", text="name").pairs().collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute()


def test_canonical_is_plain(spark):
    df = spark.createDataFrame([(p, t, "x", 0) for p, t in ROWS], SCHEMA)
    members = LookAlikes(df, row_id="pos", text="name").members.collect()
    assert {m.canonical for m in members if m.row_id < len(SAME[0])} == {"Order Hub"}
    assert all(m.class_id <= m.row_id for m in members)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert LookAlikes(df, row_id="pos", text="name").pairs().count() == 0


def test_a_class_over_the_share_is_dealt_out(spark):
    rows = [(i, "Order Hub") for i in range(1500)] + [(1500, "Ｏｒｄｅｒ Hub"), (1501, "other"), (1502, "оther")]
    df = spark.createDataFrame([(p, t, "x", 0) for p, t in rows], SCHEMA)
    got = [(r.row_a, r.row_b) for r in LookAlikes(df, row_id="pos", text="name").pairs().collect()]
    assert sorted(got) == [*[(i, 1500) for i in range(1500)], (1501, 1502)]
