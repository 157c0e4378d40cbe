"""Toxicity flag, tokens and whitespace."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The default list of toxic words.
TOXIC_WORDS = ("idiot", "noob", "trash", "stupid", "hate")

# The characters Unicode counts as whitespace, and the four
# ASCII separators U+001C to U+001F.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Everything but a-z, 0-9 and space, spelled as ranges. The negated class
# [^a-z0-9 ] names the same characters, but java.util.regex runs it about ten
# times slower.
_NOT_TOKEN_CHARACTER = r"[\x00-\x1f!-/:-`{-\x{10ffff}]+"


def whole_word_pattern(words: Sequence[str]) -> str:
    """Java pattern that finds any of the words between non-word characters.

    Word characters are ASCII letters, digits and underscore. ``\\b`` would not
    do: its idea of a letter depends on the Java version.
    """
    if not words or not all(words):
        raise ValueError("need at least one word, and no empty one")
    return r"(?i)(?<!\w)(?:" + "|".join(re.escape(w) for w in words) + r")(?!\w)"


def has_whole_word(text: Column, words: Sequence[str] = TOXIC_WORDS) -> Column:
    """Does the text hold one of the words, ignoring ASCII case? Null for null text."""
    return text.rlike(whole_word_pattern(words))


def ascii_tokens(text: Column) -> Column:
    """Lower-case tokens, split at each space; runs of spaces give empty tokens.

    Every other character outside a-z and 0-9 is deleted first, so a line break
    joins the words beside it.
    """
    return F.split(F.regexp_replace(F.lower(text), _NOT_TOKEN_CHARACTER, ""), " ")


def strip_whitespace(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))
