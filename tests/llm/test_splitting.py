from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm.splitting import split_all, split_oversized, split_text

TEXT = st.lists(st.sampled_from(["word ", "\n", "\n\n", "# Head\n", "| a | b |\n", "- item\n", "文。", "é", "x" * 40, "End. ", "\r\n"]), max_size=120).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 80), st.integers(0, 40))
def test_pieces_fit_overlap_and_join_to_the_text(text, limit, overlap):
    pieces = split_text(text, limit, overlap)
    assert "".join(p[o:] for _, o, p in pieces) == text
    assert all(len(p) <= limit for *_, p in pieces)
    assert (len(pieces) > 1) == (len(text) > limit)
    for (_, _, before), (start, o, p) in zip(pieces, pieces[1:]):
        assert o == min(overlap, limit // 2, len(before)) and before.endswith(p[:o]) and len(p) > o


def test_prefers_the_strongest_boundary():
    text = "a" * 30 + "\nword word\n\n" + "b" * 10 + "\n# Head\n" + "c" * 30
    assert [p for *_, p in split_text(text, 60, 0)][1].startswith("# Head")
    text = "One sentence here. Another one there. And a third one."
    assert [p for *_, p in split_text(text, 40, 0)] == ["One sentence here. ", "Another one there. And a third one."]


SCHEMA = "pos long, content string, chunk_mode string, section_name string, mode string, text string, max_chars int"


def test_modes(spark):
    limits = spark.createDataFrame([("semantic", 20, 4), ("fixed", 10, 2), ("single", None, 0)], "chunk_mode string, max_chars int, overlap_chars int")
    long = "word " * 10
    rows = [(1, long, None, "s"), (2, long, " FIXED　", "s"), (3, long, "single", "s"), (4, None, "fixed", "s"), (5, "", "fixed", None), (6, "0123456789", "fixed", None), (7, long, " ", None), (8, long, "other", None), (9, "𠮷" * 11, "fixed", "t"), (9, "𠮷" * 11, "fixed", "t")]
    df = spark.createDataFrame([(*r, "m", "t", 1) for r in rows], SCHEMA)
    assert sorted(r.row_id for r in split_oversized(df, limits).collect()) == [1, 2, 7, 9, 9]
    pieces = split_all(df, limits).collect()
    assert {r.row_id for r in pieces} == {1, 2, 3, 5, 6, 7, 8, 9}
    assert {r.section for r in pieces if r.row_id == 2} == {"s"}
    assert [r.piece for r in sorted(pieces, key=lambda r: r.piece_no) if r.row_id == 3] == [long]
    assert split_all(df.limit(0), limits).count() == 0


def test_very_long_text_without_boundary():
    pieces = split_text("x" * 1_000_000, 2000, 100)
    assert max(len(p) for *_, p in pieces) <= 2000 and "".join(p[o:] for _, o, p in pieces) == "x" * 1_000_000
