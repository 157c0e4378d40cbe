"""Spliced token counts against the library on the whole text."""

import random

import public_tokenizers
import pytest

from chatpulse.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def counter(chunk, overlap):
    with open(PATH, "rb") as file:
        return token_counts.PieceCounter(file.read(), chunk, overlap)


@pytest.fixture(scope="module")
def library():
    return counter(64, 4).encoder


ODD = [
    "", " ", "a" * 5000, " " * 3000, "日本語" * 900, "\n" * 2000, "x<s></s>" * 500, "é́" * 800, "🙂" * 700,
    "▁ " * 900, "\0a" * 300, "aaaa bbbb\t\r\n" * 300, "the " * 2000, "://" * 900, "͸q" * 600,
]


@pytest.mark.parametrize("chunk, overlap", [(16, 2), (64, 4), (333, 50)])
def test_odd_texts(library, chunk, overlap):
    texts = ODD + ["".join(random.Random(s).choice("ab c<s>/é🙂日\n▁͸") for _ in range(3000)) for s in range(5)]
    assert counter(chunk, overlap).counts(texts) == [len(library.encode(t)) for t in texts]


def test_documents(spark, library):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    whole = [len(m) for m in library.encode(texts, num_threads=1)]
    for chunk, overlap in ((128, 8), (1000, 64), (token_counts.CHUNK, token_counts.OVERLAP)):
        assert counter(chunk, overlap).counts(texts) == whole


def test_a_border_is_proven_only_if_no_piece_spans_it(library):
    own = counter(64, 4)
    assert own.proven("x y", 1) and not own.proven("the", 1)
    # A break between two blanks can lie inside a piece of blanks.
    assert not own.proven("a  b", 2)


def test_a_table(spark, library):
    long = "word and another " * 20_000
    rows = [(1, "some text", 5), (2, None, 5), (3, "", 5), (None, "é <s>", 5), (1, "some text", 5), (9, long, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, PATH).collect()}
    assert got == {
        (i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096)
        for i, t, _ in rows
    }
    assert token_counts.token_counts(docs, PATH).count() == 6
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0
