"""Packing: ids, cuts, gapless sequences and how many there are."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chatpulse.llm import packing

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoder():
    with open(JSON, encoding="utf-8") as words, open(RANKS, "rb") as ranks:
        return packing.Encoder(words.read(), ranks.read())


USUAL = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]]


def test_fast_ids_are_the_library_s_for_every_usual_character(library, encoder):
    rng = random.Random(2)
    texts = [a + c + b for c in USUAL for a, b in (("", ""), ("a", "b"), (" ", " x"), ("1", "2\n"), ("", USUAL[65]))]
    texts += ["".join(rng.choice(USUAL) for _ in range(200)) for _ in range(500)]
    assert not any(packing._UNUSUAL.search(t) for t in texts)
    for text, encoded in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encoder.fast.encode_ordinary(text) == encoded.ids


@pytest.mark.parametrize(
    "text", ["", "<|endoftext|>", "a <|endoftext|> b", "日本語 text", "🙂" * 50, " " * 5000, "x" * 30_000, "\n" * 3000 + "a"]
)
def test_other_texts_go_to_the_library(library, encoder, text):
    assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_runs_of_every_length_have_the_library_s_ids(library, encoder):
    rng = random.Random(3)
    parts = ["a", "é", "  ", "\n", "\r\n", "\t", "'s", "'LL", "'re", "1", "²", "…", "-", "\x1c", "\x85", "<|endoftext|>"]
    lengths = [("x", n) for n in (1, 9, 4999, 5000, 9999, 10_000)] + [(" ", n) for n in (1, 2, 500, 999, 1000)]
    for _ in range(600):
        text = "".join(rng.choice(parts) if rng.random() < 0.8 else (p := rng.choice(lengths))[0] * p[1] for _ in range(rng.randrange(40)))
        runs = max((len(w) for w in text.split()), default=0), max((len(w) for w in re.findall(r"\s+", text)), default=0)
        assert packing._usual(text) == (runs[0] < 10_000 and runs[1] < 1000 and "<|" not in text)
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents_have_the_library_s_ids(spark, library, encoder):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect()]
    for text, encoded in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encoder.ids(text).tolist() == encoded.ids


@pytest.mark.parametrize("length", [1, 5, 8, 9, 16, 17, 80])
def test_cuts(length):
    pieces = packing.cut(length, 8)
    assert [s for s, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist()
    assert sum(n for _, n in pieces) == length and all(n == 8 for _, n in pieces[1:]) and 0 < pieces[0][1] <= 8


def used(patterns, capacity):
    histogram = np.zeros(capacity + 1, np.int64)
    for pattern in patterns:
        assert sum(length * many for length, many in pattern.content) <= capacity
        for length, many in pattern.content:
            histogram[length] += many * pattern.count
    return histogram


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_few_sequences(seed):
    rng, capacity = np.random.default_rng(seed), 64
    weights = rng.random(capacity + 1) ** (1 + seed)
    histogram = rng.poisson(weights * rng.choice([1, 30, 4000]))
    histogram[0] = 0
    patterns = packing.plan(histogram, capacity)
    assert (used(patterns, capacity) == histogram).all()
    least = math.ceil((histogram * np.arange(capacity + 1)).sum() / capacity)
    count = sum(p.count for p in patterns)
    alone = sum(p.count for p in packing.best_fit(histogram, capacity))
    assert least <= count <= alone + 0.01 * alone + 1


def test_fit_finds_an_exact_mixture():
    capacity = 20
    patterns = packing.enumerated(np.array([3, 5, 7, 8, 12, 17]), capacity)
    assert {tuple(p) for p in patterns.tolist()} == {(17, 3, 0), (12, 8, 0), (12, 5, 3), (8, 7, 5)}
    truth = {(17, 3, 0): 40, (12, 5, 3): 25, (8, 7, 5): 10}
    histogram = np.zeros(capacity + 1, np.int64)
    for pattern, count in truth.items():
        for length in pattern:
            histogram[length] += count * (length > 0)
    fitted = packing.fitted(patterns, histogram)
    assert {tuple(p): round(x) for p, x in zip(patterns.tolist(), fitted) if round(x)} == truth
    assert sum(p.count for p in packing.plan(histogram, capacity)) == 75


def test_empty_plan():
    assert packing.plan(np.zeros(9, np.int64), 8) == []


def check_packed(rows, docs, library, capacity):
    """Pieces rebuild their documents; sequences have no gap and no overlap."""
    ids = {d: library.encode(t or "", add_special_tokens=False).ids + [0] for d, t in docs}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for doc_id, own in by_doc.items():
        pieces = sorted({(r.piece, r.start, r.length) for r in own})
        assert [(s, n) for _, s, n in pieces] == packing.cut(len(ids[doc_id]), capacity)
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_pack_a_table(spark, library):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["the", "quick", "brown", "é🙂"]) for _ in range(rng.randrange(90)))) for i in range(200)]
    docs += [(300, None), (301, ""), (302, "long word " * 400), (None, "no id"), (302, "long word " * 400)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS length", "2 AS part")
    rows = packing.pack(frame.repartition(7), JSON, RANKS, capacity=64).collect()
    count = check_packed(rows, docs, library, 64)
    total = sum(r.length for r in rows)
    assert count <= 1.02 * math.ceil(total / 64) + 1
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(frame.limit(0), JSON, RANKS).count() == 0


def test_one_common_length(spark, library):
    docs = [(i, "same text") for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(11)
    rows = packing.pack(frame, JSON, RANKS).collect()
    size = len(library.encode("same text", add_special_tokens=False).ids) + 1
    assert check_packed(rows, docs, library, 2048) == math.ceil(3000 / (2048 // size))


def test_documents_reach_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = packing.pack(docs, JSON, RANKS).toPandas()
    least = math.ceil(rows.length.sum() / 2048)
    assert rows.sequence_id.nunique() <= 1.001 * least + 1
