"""Best-fit packing of token sequences by patterns and non-negative least squares."""

from __future__ import annotations

import base64
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from chatpulse.llm.common import SLICE_ROWS, column, frozen

CAPACITY = 2048
END_ID = 0
#: Steps of the least-squares fit.
FIT_STEPS = 300
#: Weight of the shortest pieces in it, and the parts of its counts that are tried.
LEAST_WEIGHT = 0.09
SCALES = (1.0, 0.9, 0.6, 0.3)

#: The pattern that splits text before the merges of the rank file.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_SPECIAL = "<|endoftext|>"
#: Characters other than those whose classes are the same in every version of Unicode
#: that the two libraries may be built on.
_UNUSUAL = re.compile("[^\0-ɏ‐-‧€]")
#: Runs too long for both, with the length a text must have to hold one. Other characters
#: are looked at from where they begin alone.
_LONG_RUNS = ((1000, re.compile(r"\s{1000}")), (10000, re.compile(r"(?<!\S)\S{10000}")))


def _usual(text: str) -> bool:
    """Whether both libraries are known to give the same ids."""
    if _SPECIAL in text or not text.isascii() and _UNUSUAL.search(text):
        return False
    return not any(len(text) >= size and run.search(text) for size, run in _LONG_RUNS)


class Encoder:
    """Ids of a byte-level vocabulary, as the tokenizers library gives them.

    ``ranks`` is the same vocabulary for tiktoken, which is four times as fast;
    it takes the texts for which both are tested to agree, and the library
    itself takes those with other characters, the special string or very long
    runs. With ``ordinary`` the special string is ordinary text.
    """

    def __init__(self, vocabulary: str, ranks: bytes | None = None, ordinary: bool = False) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = ordinary
        self.fast = None
        if ranks:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=merges, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or not _usual(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """``start, length`` of the pieces; all but the first fill a sequence."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return list(zip(starts, [first] + [capacity] * (len(starts) - 1)))


@dataclass
class Pattern:
    """``count`` sequences that each hold, in order, ``many`` pieces of every ``length``."""

    count: int
    content: list[tuple[int, int]] = field(default_factory=list)


def enumerated(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All ways to fill a sequence exactly with one to three of the lengths, 0 where fewer."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    a, b = np.meshgrid(np.flatnonzero(there), np.flatnonzero(there), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = capacity - a - b
    keep = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[keep], b[keep], c[keep]
    return np.column_stack([a, b, c])[there[c]]


def fitted(patterns: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative repeat counts whose use of each length comes closest to the histogram.

    Long pieces weigh more, as a short one finds room anywhere. Accelerated
    projected gradient; each pattern touches three lengths at most, so a step is
    three gathers and one scatter.
    """
    size = len(histogram)
    weight = np.maximum(LEAST_WEIGHT, np.arange(size) / (size - 1)) ** 2
    used = patterns > 0
    flat = np.where(used, patterns, size).ravel()

    def use(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.repeat(x, 3), size + 1)[:size]

    def back(r: np.ndarray) -> np.ndarray:
        return np.append(r * weight, 0.0)[flat].reshape(-1, 3).sum(axis=1)

    probe = np.ones(len(patterns))
    for _ in range(20):
        probe = back(use(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    target = histogram.astype(float)
    x = ahead = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        moved = np.maximum(0.0, ahead - back(use(ahead) - target) / (1.01 * norm))
        following = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = moved + (t - 1) / following * (moved - x)
        x, t = moved, following
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts of lengths, like sequences handled together."""
    open_by_room: dict[int, list[Pattern]] = {}
    done: list[Pattern] = []

    def put(group: Pattern, room: int) -> None:
        (open_by_room.setdefault(room, []) if room else done).append(group)

    def fill(group: Pattern, room: int, length: int, count: int) -> int:
        """Adds up to ``count`` pieces to the group's sequences; how many are left."""
        many = room // length
        full, rest = divmod(min(count, group.count * many), many)
        if full:
            put(Pattern(full, [*group.content, (length, many)]), room - many * length)
        if rest:
            put(Pattern(1, [*group.content, (length, rest)]), room - rest * length)
        if group.content and group.count > full + (rest > 0):
            put(Pattern(group.count - full - (rest > 0), group.content), room)
        return count - full * many - rest

    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            room = min((r for r, groups in open_by_room.items() if groups and r >= length), default=None)
            if room is None:
                count = fill(Pattern(count), capacity, length, count)
            else:
                count = fill(open_by_room[room].pop(), room, length, count)
    return done + [group for groups in open_by_room.values() for group in groups]


def repeated(patterns: np.ndarray, repeats: np.ndarray, histogram: np.ndarray) -> tuple[list[Pattern], np.ndarray]:
    """Patterns with their repeats, commonest first, held to what is there; and what is left."""
    left, made = histogram.copy(), []
    for at in np.argsort(-repeats, kind="stable"):
        if repeats[at] <= 0:
            break
        sizes, many = np.unique(patterns[at][patterns[at] > 0], return_counts=True)
        count = int(min(repeats[at], (left[sizes] // many).min()))
        if count > 0:
            left[sizes] -= count * many
            made.append(Pattern(count, list(zip(sizes.tolist(), many.tolist()))))
    return made, left


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use exactly the pieces of the histogram (by length, 0 to capacity).

    Repeat counts from the fit are rounded and held to what is there; what
    remains is packed best-fit. Exact patterns of a few pieces can take short
    ones that long ones need, so the counts are also tried scaled down, never to
    nothing, and the plan with the fewest sequences is kept. The work depends on the capacity,
    not on counts.
    """
    patterns = enumerated(np.flatnonzero(histogram[1:]) + 1, capacity)
    repeats = fitted(patterns, histogram) if len(patterns) else np.zeros(0)
    best: list[Pattern] | None = None
    for scale in SCALES:
        made, left = repeated(patterns, np.rint(scale * repeats).astype(np.int64), histogram)
        made += best_fit(left, capacity)
        if best is None or sum(p.count for p in made) < sum(p.count for p in best):
            best = made
    return best or []


@dataclass
class Slots:
    """Where the piece of a length with a given rank goes.

    Sorted by ``key`` (length and first rank); row for row the first sequence,
    how many pieces of the length each sequence takes, and the first's offset.
    """

    key: np.ndarray
    sequence: np.ndarray
    many: np.ndarray
    offset: np.ndarray

    _SHIFT = 48

    @classmethod
    def of(cls, patterns: list[Pattern]) -> "Slots":
        rows, taken, sequence = [], {}, 0
        for pattern in patterns:
            offset = 0
            for length, many in pattern.content:
                first = taken.get(length, 0)
                rows.append(((length << cls._SHIFT) + first, sequence, many, offset))
                taken[length] = first + pattern.count * many
                offset += length * many
            sequence += pattern.count
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 4).T)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << self._SHIFT) + rank
        at = np.searchsorted(self.key, key, side="right") - 1
        nth = key - self.key[at]
        return self.sequence[at] + nth // self.many[at], self.offset[at] + nth % self.many[at] * length


def pieces(
    docs: DataFrame, vocabulary: str, ranks: str | None, id_col: str, text_col: str, capacity: int
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, nth`` of every piece.

    ``part`` is the task, ``nth`` the piece's number among the task's of its length.
    """
    with open(vocabulary, encoding="utf-8") as file:
        words = file.read()
    fast = None
    if ranks:
        with open(ranks, "rb") as file:
            fast = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((words, fast))
    picked = docs.select(column(docs, id_col).alias("doc_id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"

    def run(batches):
        encoder, part, seen = None, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            encoder = encoder or Encoder(*shared.value)
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                owner, made = [], []
                for row, text in enumerate(rows.column(1).to_pylist()):
                    ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4", copy=False)
                    for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                        owner.append(row)
                        crc = zlib.crc32(ids[start : start + length].tobytes())
                        made.append((piece, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(owner)), *columns],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
                )

    return picked.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its ids and the end id; only one that is longer than a
    sequence is cut. Every piece gets its rank among those of its length from
    the task's own numbering and the counts of the tasks before, so a length
    that a third of all pieces have is no hot group. Only the histogram, one
    number a length, reaches the driver; the plan it makes is bounded by the
    capacity. A null or empty text is the end id alone, a very long one is encoded
    whole and cut; null ids and repeated rows stay, other columns are ignored, an
    empty table gives no rows.
    """
    table = frozen(pieces(docs, vocabulary, ranks, id_col, text_col, capacity), "pieces")
    counts = table.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row.length] = row.n
    shared = docs.sparkSession.sparkContext.broadcast(Slots.of(plan(histogram, capacity)))
    ranked = table.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = shared.value.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    out = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(run, out)
