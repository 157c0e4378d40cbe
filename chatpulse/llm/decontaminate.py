"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chatpulse.llm.common import SLICE_ROWS, column, word_shingles, words_of

SHINGLE_WORDS = 5
LEAST_CONTAINMENT = 0.8
#: Hash functions, each a band of its own: a window that holds a share of an
#: item is a candidate with probability 1 - (1 - share) ** HASHES.
HASHES = 64
#: Items searched for in one pass over the documents.
BLOCK_ITEMS = 10_000
_SEED = 42
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22

Hit = tuple[int, int, int]


def shingle_hashes(words: list[str], width: int = SHINGLE_WORDS) -> np.ndarray:
    """A 64-bit hash of every shingle, in order, mixed from the hashes of its words."""
    width = min(width, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    single = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - width + 1, np.uint64)
    for at in range(width):
        mixed ^= single[at : at + len(mixed)]
        mixed *= _FACTOR
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _common(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The values that are among the known ones, which are sorted."""
    if not len(values) or not len(known):
        return values[:0]
    return values[known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values]


def size_class(count: int) -> int:
    """The least class that holds an item of so many shingles; classes are the powers of two from 1."""
    size = 1
    while size < count:
        size *= 2
    return size


class ContainmentIndex:
    """Items by size class and MinHash value.

    A long document holds a short item in a small part of its shingles, which no
    MinHash of the whole document shows. So it is read in windows of twice the
    class's size that start every class size: whatever passage has the size of
    an item of the class lies whole in one window, of which it is a share of a
    quarter at least.
    """

    def __init__(self, items: list[str | None], hashes: int = HASHES) -> None:
        rng = np.random.default_rng(_SEED)
        self.factors = rng.integers(0, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
        self.masks = rng.integers(0, 1 << 63, hashes, np.uint64)
        split = [words_of(text) for text in items]
        self.shingles = [frozenset(word_shingles(words, SHINGLE_WORDS)) for words in split]
        classes: dict[int, list[dict[int, list[int]]]] = {}
        marks: set[int] = set()
        for number, words in enumerate(split):
            if not words:
                continue
            own = shingle_hashes(words)
            bands = classes.setdefault(size_class(len(own)), [{} for _ in range(hashes)])
            for band, mask, factor in zip(bands, self.masks, self.factors):
                mixed = (own ^ mask) * factor
                least = int(mixed.argmin())
                band.setdefault(int(mixed[least]), []).append(number)
                marks.add(int(own[least]))
        self.classes = {
            size: [(np.array(sorted(band), np.uint64), band) for band in bands] for size, bands in sorted(classes.items())
        }
        self.marks = np.array(sorted(marks), np.uint64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.marks >> np.uint64(64 - _FILTER_BITS)] = True

    def candidates(self, own: np.ndarray) -> set[int]:
        """Items that share a MinHash value with a window of the document."""
        # A window's least value is an item's only if the same shingle gives
        # both, so a document without any of those shingles has no candidate.
        some = own[self.filter[own >> np.uint64(64 - _FILTER_BITS)]]
        if not len(_common(some, self.marks)):
            return set()
        found: set[int] = set()
        for nth, (mask, factor) in enumerate(zip(self.masks, self.factors)):
            mixed = (own ^ mask) * factor
            size, least = 1, mixed
            for wanted, bands in self.classes.items():
                if size < wanted:
                    least = np.minimum.reduceat(least, np.arange(0, len(least), wanted // size))
                    size = wanted
                windows = np.minimum(least[:-1], least[1:]) if len(least) > 1 else least
                known, band = bands[nth]
                for value in _common(windows, known).tolist():
                    found.update(band[value])
        return found

    def hits(self, text: str | None, least: float = LEAST_CONTAINMENT) -> list[Hit]:
        """``item, shingles, shared`` of the items that the text holds, checked on the shingles themselves."""
        words = words_of(text)
        candidates = self.candidates(shingle_hashes(words)) if words else set()
        if not candidates:
            return []
        whole, found = set(word_shingles(words, SHINGLE_WORDS)), []
        for item in sorted(candidates):
            wanted = self.shingles[item]
            shared = sum(s in whole for s in wanted)
            if shared >= least * len(wanted):
                found.append((item, len(wanted), shared))
        return found


def _blocks(items: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[list[tuple]]:
    """The different items in blocks of about ``size``, one at a time on the driver."""
    rows = items.select(column(items, id_col).alias("item_id"), column(items, text_col).alias("text")).distinct()
    count = rows.count()
    blocks = -(-count // size)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    for block in range(blocks):
        yield [tuple(r) for r in rows.filter(number == block).orderBy("item_id", "text").collect()]


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = LEAST_CONTAINMENT,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``doc_id, item_id, n_shingles, shared, containment`` of every item a document holds.

    Containment is the part of the item's different five-word shingles (lower
    case, words of letters, digits and underscores) that the document has
    anywhere. A text of fewer words is one shingle, so a shorter item is held
    only by a document of just those words; a text without words holds and is
    held by nothing, null ones too. The items are the stated query set: they go
    to the tasks in blocks, each a pass over the documents, which are not
    shuffled. Null ids and repeated documents stay, repeated items count once,
    other columns are ignored, empty tables give no rows. A very long text is read
    whole, in windows.
    """
    picked = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    schema = picked.drop("text").schema.add("place", "integer").add("n_shingles", "long").add("shared", "long")
    found = None
    for block in _blocks(items, item_col, item_text_col, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(ContainmentIndex([text for _, text in block]))

        def run(batches, shared=shared):
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    rows = batch.slice(at, SLICE_ROWS)
                    made = [(r, *h) for r, t in enumerate(rows.column(1).to_pylist()) for h in shared.value.hits(t, least)]
                    if made:
                        row, place, size, common = zip(*made)
                        yield pa.RecordBatch.from_arrays(
                            [
                                rows.column(0).take(pa.array(row)),
                                pa.array(place, pa.int32()),
                                pa.array(size, pa.int64()),
                                pa.array(common, pa.int64()),
                            ],
                            names=["doc_id", "place", "n_shingles", "shared"],
                        )

        ids = docs.sparkSession.createDataFrame(
            [(n, i) for n, (i, _) in enumerate(block)], f"place int, item_id {items.schema[item_col].dataType.simpleString()}"
        )
        # As many rows as the block has items.
        part = picked.mapInArrow(run, schema).join(F.broadcast(ids), "place")
        found = part if found is None else found.union(part)
    if found is None:
        found = picked.filter("false").select("doc_id", F.lit(0).alias("place"), F.lit(0).alias("n_shingles"), F.lit(0).alias("shared"))
        found = found.withColumn("item_id", F.lit(None).cast(items.schema[item_col].dataType))
    return found.select(
        "doc_id",
        "item_id",
        F.col("n_shingles").cast("bigint").alias("n_shingles"),
        F.col("shared").cast("bigint").alias("shared"),
        F.try_divide("shared", "n_shingles").alias("containment"),
    )


def without_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = LEAST_CONTAINMENT,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The rows whose text holds no item, with all columns; see ``contained_items``.

    Rows are judged where they lie: nothing is shuffled.
    """
    for block in _blocks(items, item_col, item_text_col, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(ContainmentIndex([text for _, text in block]))
        place = docs.columns.index(text_col)

        def run(batches, shared=shared):
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    rows = batch.slice(at, SLICE_ROWS)
                    yield rows.filter(pa.array([not shared.value.hits(t, least) for t in rows.column(place).to_pylist()]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
