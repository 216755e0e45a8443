import random

import pytest

from folioscope.llm.encoding import decode_ids, default_vocabulary, encode_corpus, encode_text

PATH, PATTERN = default_vocabulary()
PARTS = ["word", " ", "  ", "\n", "\r\n\n", "日本語", "的", "12345", "!?--", "'s", "'ll", "é", "👩‍🔧", "𠮷", "　", "x" * 50, "<|endoftext|>", "\t", " a"]


def texts():
    rng = random.Random(7)
    out = [None, "", " ", "   \n", "a", "x" * 900, " " * 700, "日" * 500, "<|endoftext|>", "ab " * 400]
    return out + ["".join(rng.choices(PARTS, k=rng.randint(1, 400))) for _ in range(150)]


@pytest.mark.parametrize(("size", "overlap"), [(64, 16), (100, 3), (1 << 16, 1 << 10)])
def test_same_ids_as_the_whole_text(spark, size, overlap):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, piece_no int")
    got = {r.doc_id: r.ids for r in encode_corpus(df, chunk_size=size, overlap=overlap).collect()}
    assert got == {i: encode_text(t or "", PATH, PATTERN) for i, t, *_ in rows}


def test_round_trip():
    for t in texts():
        assert decode_ids(encode_text(t or "", PATH, PATTERN), PATH, PATTERN) == (t or "")


def test_agrees_with_the_other_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for t in texts()[1:]:
        assert encode_text(t, PATH, PATTERN) == other.encode(t, add_special_tokens=False).ids


def test_repeated_keys_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab " * 100), (1, "ab " * 100), (2, "a")], "doc_id long, text string")
    assert sorted(len(r.ids) for r in encode_corpus(df, chunk_size=50, overlap=10).collect()) == [1, 101, 101]
    assert encode_corpus(df.limit(0)).count() == 0
