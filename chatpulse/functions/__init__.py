"""Column expressions; all run inside Spark's own operators, none is a UDF."""

from chatpulse.functions.payload import decoded, encoded
from chatpulse.functions.protocol import sender, spoken_text
from chatpulse.functions.text import (
    TOXIC_WORDS,
    ascii_tokens,
    has_whole_word,
    strip_whitespace,
)

__all__ = [
    "TOXIC_WORDS",
    "ascii_tokens",
    "decoded",
    "encoded",
    "has_whole_word",
    "sender",
    "spoken_text",
    "strip_whitespace",
]
