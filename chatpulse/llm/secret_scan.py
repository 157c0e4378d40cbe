"""Secret scans with one deterministic automaton for all rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatpulse.llm.automata import Automaton, compile_patterns, matches, patterns_in
from chatpulse.llm.common import SLICE_ROWS, column


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` is the number of characters below which a match
    is dropped: of the match, or of what follows its first ``:`` or ``=``, blanks
    and quote if ``value`` is set."""

    kind: str
    pattern: str
    least: int
    value: bool = False
    ignore_case: bool = False


#: The kinds every scan reports. A run of the last is a match as a whole, so its
#: length can stand in the pattern, where the automaton counts it.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        value=True,
        ignore_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{32,}", 32),
)
#: Kinds beyond those.
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Rule("forge_token", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 20),
)
RULES = BASE_RULES + MORE_RULES


def _long_enough(rule: Rule, found: str) -> bool:
    if rule.value:
        cut = min(i for i in (found.find(":"), found.find("=")) if i >= 0)
        found = found[cut + 1 :].lstrip(" ")
        found = found[found[:1] in ("'", '"') :]
    return len(found) >= rule.least


class Scanner:
    """The combined automaton, and each rule's own for the places of its matches."""

    def __init__(self, rules: Sequence[Rule] = RULES) -> None:
        self.rules = tuple(rules)
        whole = [(r.pattern, r.ignore_case) for r in rules]
        self.combined = compile_patterns(whole, anywhere=True)
        self.single: list[tuple[Automaton, Automaton]] = [
            (compile_patterns([p], anywhere=True, minimal=False), compile_patterns([p], anywhere=False)) for p in whole
        ]

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """``kind, start, end`` in code points, by start and then the rules' order."""
        data = (text or "").encode("utf-8", "surrogatepass")
        hit = patterns_in(self.combined, data)
        found = []
        for nth, rule in enumerate(self.rules):
            if not hit >> nth & 1:
                continue
            for start, end in matches(*self.single[nth], data):
                if _long_enough(rule, data[start:end].decode("utf-8", "replace")):
                    found.append((start, nth, end))
        if not found:
            return []
        places = {p for start, _, end in found for p in (start, end)}
        points, last, count = {}, 0, 0
        for place in sorted(places):
            count += len(data[last:place].decode("utf-8", "surrogatepass"))
            points[place], last = count, place
        return [(self.rules[nth].kind, points[start], points[end]) for start, nth, end in sorted(found)]


def redacted(text: str, spans: Sequence[tuple[str, int, int]], mark: str = "[REDACTED]") -> str:
    """The text with every span, or run of overlapping spans, replaced by the mark."""
    parts, done = [], 0
    for _, start, end in spans:
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def scan(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, hide: bool = False, name: str = "spans"
) -> DataFrame:
    """Every row with a column ``spans``: array of ``kind, start, end``.

    Offsets count code points of the text as it came, the end is exclusive. With
    ``hide`` the text is returned with its secrets replaced. A null or empty text
    has no spans (and stays as it is); whole texts are scanned, however long;
    repeated rows and all other columns pass through, but for one with the name
    of the new column, which is replaced; an empty table stays empty.
    """
    picked = docs.select(*(column(docs, c) for c in docs.columns if c != name))
    place = picked.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(rules))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scanner = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                texts = rows.column(place).to_pylist()
                found = [scanner.spans(t) for t in texts]
                columns = list(rows.columns)
                if hide:
                    clean = [redacted(t, s) if s else t for t, s in zip(texts, found)]
                    columns[place] = pa.array(clean, columns[place].type)
                made = [[{"kind": k, "start": i, "end": j} for k, i, j in s] for s in found]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(made, span)], names=[*rows.schema.names, name])

    out = picked.withColumn(name, F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).schema
    return picked.mapInArrow(run, out)


def redact(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, size_col: str = "n_chars"
) -> DataFrame:
    """All rows and columns with the secrets of the text replaced, and its size counted anew where there were any."""
    name = "__spans"
    hidden = scan(docs, text_col, rules, hide=True, name=name)
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        size = F.when(F.size(name) > 0, F.length(column(hidden, text_col)).cast(kind)).otherwise(column(hidden, size_col))
        hidden = hidden.withColumn(size_col, size)
    return hidden.drop(name)
