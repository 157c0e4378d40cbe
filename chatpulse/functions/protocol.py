"""Sender and text of a chat protocol line ``:user!user@host PRIVMSG #room :text``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatpulse.functions.text import strip_whitespace

# Protocol words.
MESSAGE_COMMAND = "PRIVMSG"
KEEPALIVE_COMMAND = "PING"
LINE_BREAK = "\r\n"


def sender(line: Column) -> Column:
    """What stands before the first ``!`` of the prefix, less its leading colon."""
    prefix = F.substring_index(line, MESSAGE_COMMAND, 1)
    return F.substr(F.substring_index(prefix, "!", 1), F.lit(2))


def spoken_text(line: Column) -> Column:
    """What follows the first colon after the command; null where there is none."""
    after_command = F.instr(line, F.lit(MESSAGE_COMMAND)) + len(MESSAGE_COMMAND)
    colon = F.position(F.lit(":"), line, after_command)
    return F.when(colon > 0, strip_whitespace(F.substr(line, colon + 1)))
