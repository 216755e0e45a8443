import random
import time

import pytest

from folioscope.llm.canonical_values import Dictionary, deletions, distance, map_to_canonical

REFS = [
    (1, "System", "Mekral Order Hub", "メクラル受注ハブ"), (2, "Interface", "Mekral Stock Feed", None), (3, "System", "Mekral Stock Feed", None),
    (4, "Middleware", "Torvis File Relay", "トルヴィスファイル転送"), (5, "APIOperation", "cancel shipment Torvis", None), (6, "DataEntity", "Brolund Price Table", "ブロルンド価格表"),
]
TYPED = [
    ("Mekral Order Hub", "System", 1), ("MEKRAL-ORDER-HUB", "Sytem", 1), ("mekralOrderHub", None, 1), ("Order Hub Mekral", "x", 1), ("Hub, Mekral Order", None, 1),
    ("Mekral Stock Feed", "I/F", 2), ("mekral stcok feed", "Core System", 3), ("mekrl stok feed", "システム", 3), ("Mekral Stock Feed", None, 2),
    ("new Torvis File Relay", "MW", 4), ("Torvis File Relay (test)", None, 4), ("(prod) Torvis File Relay v2", None, 4), ("Torvis File Relay 2nd site", None, 4),
    ("canc. ship. Torvis", "API Op.", 5), ("Ｂｒｏｌｕｎｄ　Ｐｒｉｃｅ　Ｔａｂｌｅ", None, 6), ("Brоlund Price Tab​le", None, 6), ("新ブロルンド価格表様式", None, 6), ("ﾌﾞﾛﾙﾝﾄﾞ価格表（本番）", None, 6),
    ("トルヴィファイル転送", None, 4), ("メクラル受注ハブシステム", None, 1), ("torvisf ile relay", None, 4),
    ("Jansol Order Hub", "System", 0), ("Order Hub", "System", 0), ("Mekral", "System", 0), ("Mekral Price Table", None, 0), ("メクラル出荷ハブ", None, 0), ("unknown", None, 0), ("その他", None, 0),
    (None, "System", 0), ("", None, 0), (" 　", None, 0), ("-", None, 0), ("x" * 200_000, None, 0), ("a. " * 5000, None, 0), ("Kromal Order Hub", None, 0),
]


def frames(spark, refs=REFS):
    rows = spark.createDataFrame([(i, n, lab, "x", 7) for i, (n, lab, _) in enumerate(TYPED)], "pos long, name string, label string, row_id string, ref_id int")
    return rows, spark.createDataFrame(refs, "ref_id long, label string, name string, alt_name string")


def test_typed_names(spark):
    rows, refs = frames(spark)
    got = {r.row_id: r.ref_id for r in map_to_canonical(rows, refs).collect()}
    assert {TYPED[i]: r for i, r in got.items() if TYPED[i][2] != r} == {} and len(got) == len(TYPED)


@pytest.mark.parametrize("n", [1, 2, 4])
def test_a_long_list_is_looked_up_in_several_indexes(spark, n):
    rows, refs = frames(spark)
    got = {r.row_id: r.ref_id for r in map_to_canonical(rows, refs, index_entries=n).collect()}
    assert {TYPED[i]: r for i, r in got.items() if TYPED[i][2] != r} == {} and len(got) == len(TYPED)


def test_many_shortened_words_are_no_product():
    refs = [(i, "System", " ".join(f"{w}{'abcdefghijklmnopqrst'[i]}x" for w in ("inv", "ord", "shi", "pri", "sto", "rel", "cus", "del", "tax", "lot")), None) for i in range(1, 20)]
    d = Dictionary(refs)
    began = time.perf_counter()
    assert d.resolve("inv. ord. shi. pri. sto. rel. cus. del. tax. lot.", None, {5: 2})[-1] == 5  # all fit alike, the fifth was typed most
    assert d.resolve("inv. ord. shi. pri. sto. rel. cus. del. tax. lotcx", None, {5: 2})[-1] == 2
    assert time.perf_counter() - began < 5


def test_empty(spark):
    rows, refs = frames(spark, [])
    assert {r.ref_id for r in map_to_canonical(rows, refs).collect()} == {0}
    assert map_to_canonical(rows.limit(0), frames(spark)[1]).count() == 0


def test_dictionary_finds_what_brute_force_finds():
    rng = random.Random(8)
    d = Dictionary(REFS)
    spellings = sorted(d.spellings)
    for _ in range(400):
        s = rng.choice(spellings)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(s))
            s = rng.choice([s[:i] + s[i + 1 :], s[:i] + rng.choice("abcdeork") + s[i:], s[:i] + s[i + 1 : i + 2] + s[i : i + 1] + s[i + 2 :]])
        met = {x for c in deletions(s, 2) for x in d.index.get(c, ())}
        assert {x for x in spellings if len(x) > 8 and x.isascii() and distance(s, x, 2.0) <= 2.0} <= met


def test_distance():
    assert distance("abc", "abc", 2) == 0 and distance("abcd", "abdc", 2) == 0.9 and distance("abc", "xbc", 2) > 1 and distance("abc", "abcxyz", 2) == float("inf")
    assert distance("feed", "fed", 2) < distance("fed", "fd", 2)
