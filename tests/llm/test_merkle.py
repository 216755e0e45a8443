import re
import unicodedata

import pytest

from folioscope.llm.merkle import LayoutIndex

SCHEMA = "pos long, chunk_type string, content string, root string, n long, salt int"


def key(kind, text):
    def leaf(t):
        return "".join(c for c in t if unicodedata.category(c)[0] in "LN").lower()

    if text is None or not leaf(text):
        return None
    if kind == "field_def":
        return ("f", *sorted(x for x in map(leaf, re.split("\r\n|[\n\r\v\f\x85  ]", text)) if x))
    return ("t", leaf(text))


def brute(rows):
    first, out = {}, set()
    for pos, kind, text in sorted(rows, key=lambda r: r[0]):
        if (k := key(kind, text)) is not None:
            if k in first:
                out.add((first[k], pos))
            first.setdefault(k, pos)
    return out


ROWS = [
    (1, "overview", "Hello, World 1"), (2, "overview", "hello world-1\n"), (3, None, "HELLOWORLD1"), (4, "field_def", "Hello, World 1"),
    (5, "field_def", "b: 2\na: 1"), (6, "field_def", "A 1\r\n---\r\nB 2\r\n"), (7, "field_def", "a1\na1\nb2"), (8, "overview", "b2a1"),
    (9, "overview", None), (10, "overview", " -- "), (11, "overview", ""), (12, "overview", "résumé"), (13, "overview", "résumé"),
    (14, "overview", "resume"), (15, "overview", "①²"), (16, "overview", "12"), (17, "overview", "項目　名"), (18, "overview", "項目名"),
    (19, "overview", "x" * 300_000), (20, "overview", "X " * 300_000), (21, "field_def", "a1\rb2"), (22, "overview", "𠮷 A"), (23, "overview", "𠮷a"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2) for r in rows], SCHEMA)


def test_against_brute_force(spark):
    got = [(r.first_row, r.row_id) for r in LayoutIndex(frame(spark, ROWS)).copies().collect()]
    assert len(got) == len(set(got)) and set(got) == brute(ROWS)


def test_distinct_counts_every_record_once(spark):
    got = {r.first_row: r.copies for r in LayoutIndex(frame(spark, ROWS)).distinct().collect()}
    taking_part = [r for r in ROWS if key(*r[1:]) is not None]
    assert sum(got.values()) == len(taking_part)
    assert len(got) == len({key(*r[1:]) for r in taking_part})


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_empty(spark, rows):
    index = LayoutIndex(frame(spark, rows))
    assert index.copies().count() == 0 and index.distinct().count() == 0


def test_hot_group(spark):
    rows = [(i, "overview", "same   text" if i % 3 == 0 else f"t {i}") for i in range(3000)]
    assert LayoutIndex(frame(spark, rows)).copies().count() == 999


def test_groups_over_the_share_are_dealt_out(spark):
    rows = [(i, "overview", ["same   text", "Same text!", f"t {i}", f"u {i // 2 * 2}"][i % 4]) for i in range(5000)]
    got = [(r.first_row, r.row_id) for r in LayoutIndex(frame(spark, rows)).copies().collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
