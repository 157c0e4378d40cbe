"""Golden rows of the column expressions."""

import sys

import pytest
from pyspark.sql import functions as F

from chatpulse.functions.text import (
    WHITESPACE,
    ascii_tokens,
    has_whole_word,
    strip_whitespace,
)
from helpers import texts

TOXICITY = {
    "NOOB!": True,
    "énoob": True,
    "noobé": True,
    "hat\u00e9": False,
    "hate\u0301": True,
    "x-hate-y": True,
    "noobs": False,
    "noob_": False,
    "_noob": False,
    "9noob": False,
    "ſtupid": False,
    "you are an IdIoT": True,
    "line\ntrash\nline": True,
    "": False,
    None: None,
}


def test_toxicity(spark):
    got = texts(spark, *TOXICITY).select("message", has_whole_word(F.col("message")))
    assert dict(got.collect()) == TOXICITY


def test_word_list_is_a_parameter_and_taken_literally(spark):
    frame = texts(spark, "a.b", "axb", "c++", "C++!", "idiot")
    got = frame.select("message", has_whole_word(F.col("message"), ["a.b", "c++"]))
    assert dict(got.collect()) == {
        "a.b": True, "axb": False, "c++": True, "C++!": True, "idiot": False,
    }


@pytest.mark.parametrize("words", [[], [""], ["a", ""]])
def test_empty_words_are_refused(words):
    with pytest.raises(ValueError):
        has_whole_word(F.col("message"), words)


TOKENS = {
    "Don't STOP": ["dont", "stop"],
    "foo\nbar\tbaz": ["foobarbaz"],
    "café \U0001f600 x": ["caf", "", "x"],
    "  a  b ": ["", "", "a", "", "b", ""],
    "": [""],
    None: None,
    "A1-b2_C3 [`{|}~@/:]": ["a1b2c3", ""],
    "Kelvin": ["kelvin"],
}


def test_tokens(spark):
    got = texts(spark, *TOKENS).select("message", ascii_tokens(F.col("message")))
    assert dict(got.collect()) == TOKENS


def test_tokens_keep_only_letters_digits_and_space(spark):
    everything = "".join(chr(c) for c in range(0x300))
    (got,) = texts(spark, everything).select(ascii_tokens(F.col("message"))).first()
    expected = "".join(c for c in everything.lower() if c.isascii() and (c.isalnum() or c == " "))
    assert got == expected.split(" ")


def test_whitespace_is_all_of_unicode(spark):
    assert set(WHITESPACE) == {c for c in map(chr, range(sys.maxunicode)) if c.isspace()}
    padded = [f"{c}a{c}b{c}{c}" for c in WHITESPACE] + [WHITESPACE, "", "a"]
    got = texts(spark, *padded).select("message", strip_whitespace(F.col("message")))
    assert dict(got.collect()) == {p: p.strip() for p in padded}
