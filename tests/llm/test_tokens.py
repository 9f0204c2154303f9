import zlib

import numpy as np
import pytest

from trawl.llm import tokens
from trawl.llm.queries import tokenizer_file

TEXTS = ["", " ", "  a  b ", "a\n b\t c", " x  y", "it's  John's ?! 12 3", "x<|endoftext|> y", "\x1c a \x85 b", "日本 語 。 a",
         "é á b", "\n\n", "a\n", "a \n\n b.", "a.b,c 1.5 ,x ", "\r\na", "q​ w z", "word " * 5000, "x" * 20_000, "Ünï, cödé."]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000])
@pytest.mark.parametrize("high", [1, 5, 1000, 10**7])
def test_elias_fano_round_trip(n, high):
    values = np.sort(np.random.default_rng(n + high).integers(0, high, n))
    code = tokens.EliasFano.encode(values)
    assert code.decode().tolist() == values.tolist()
    assert [code.select(i) for i in range(n)] == values.tolist()
    with pytest.raises(IndexError):
        code.select(n)


def test_elias_fano_space():
    values = np.sort(np.random.default_rng(0).integers(0, 10**7, 10_000))
    code = tokens.EliasFano.encode(values)
    bits = 8 * (len(code.low) + len(code.high) + len(code.samples))
    assert bits / 10_000 < 2 + np.log2(10**7 / 10_000) + 1.5


def test_pieces_equal_the_library():
    encoder = tokens.PieceEncoder(tokenizer_file())
    for _ in range(2):                                       # cold and warm cache
        got = encoder.encode(TEXTS)
        assert [g.tolist() for g in got] == [x.tolist() for x in encoder._library(TEXTS)]


LINES = ["foo\n\nbar", "a \n\nb", "a\n\n\n\nb", "\n\nx", "a\t\nb", "a\n b", "a\r\n\r\nb.", "a\n\n", "b", "a\n\n\n", "", "\n", "\n\n.b"]


def test_line_feeds_before_text_equal_the_library():
    encoder = tokens.PieceEncoder(tokenizer_file())
    rng = np.random.default_rng(4)
    mixed = ["".join(rng.choice(list("ab1. ,\n\n\n\t\r\x0b'é"), n)) for n in rng.integers(0, 30, 3000)]
    for texts in (LINES, LINES[::-1], mixed):
        assert [g.tolist() for g in encoder.encode(texts)] == [x.tolist() for x in encoder._library(texts)]
    assert encoder.encode(["foo\n\nbar"])[0].tolist() == [21943, 198, 198, 5657]


def _expected(rows, end=2):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file())
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_documents_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_IDS", 500)            # many blocks
    rows = [(i * 7 % 101, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id"), (5, None), (-3, "minus"), (7, "again"), (7, "again")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, shard string, n_ids int").repartition(5)
    got = sorted((tuple(r) for r in tokens.encode_documents(docs, tokenizer_file()).collect()), key=lambda r: r[1])
    assert got == _expected(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.encode_documents(docs, tokenizer_file()).collect() == []
