"""Near duplicates by SimHash and multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from chatpulse.llm.common import SLICE_ROWS, column, frozen, measured
from chatpulse.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of a table slot beyond which its pairs are not compared one by one.
DENSE_SLOT = 256
#: Shingles hashed before their bits are added up.
_BLOCK = 1 << 16


def simhash(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    if len(words) < width:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins, ends = (ends - sizes)[: len(words) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(begins), _BLOCK):
        spans = zip(begins[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begins), bitorder="little").view("<u8")[0])


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Two hashes by which a row with its id and text is known again, nulls included."""
    doc_id, text = column(docs, id_col), column(docs, text_col)
    return [F.xxhash64(doc_id, text).alias("__key"), F.xxhash64(text, doc_id).alias("__key2")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, the row's keys and ``fp``, the fingerprint as the signed bigint of the same bits."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                made = [simhash(text, width) for text in rows.column(3).to_pylist()]
                signed = pa.array([v - (v >> 63 << 64) for v in made], pa.int64())
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], signed], names=[*rows.schema.names[:3], "fp"])

    picked = docs.select(
        column(docs, id_col).alias("doc_id"), *row_keys(docs, id_col, text_col), column(docs, text_col).alias("text")
    )
    return picked.mapInArrow(run, picked.drop("text").schema.add("fp", "long"))


def _flips(bits: int, most: int) -> list[int]:
    """Every mask of up to ``most`` (0 to 2) set bits among ``bits``."""
    single = [1 << i for i in range(bits)]
    double = [a | b for a in single for b in single if a < b] if most > 1 else []
    masks = [0, *single, *double]
    return [m - (m >> 63 << 64) for m in masks]


def _segments(fp: Column) -> tuple[Column, Column]:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)


def table_slots(distinct: DataFrame) -> DataFrame:
    """``fp, slot, n``: the slots each fingerprint takes in the segment tables, if others do as well.

    Two fingerprints at most four bits apart are at most two bits apart in one
    of their two 32-bit segments, and then share a slot if either goes to the
    ball of radius one around its segment: 33 slots a table.
    """
    low, high = _segments(F.col("fp"))
    masks = F.array(*(F.lit(m) for m in _flips(32, 1)))
    slots = F.concat(
        F.transform(masks, lambda m: low.bitwiseXOR(m)),
        F.transform(masks, lambda m: high.bitwiseXOR(m).bitwiseOR(F.lit(1 << 32))),
    )
    taken = distinct.select("fp", F.explode(slots).alias("slot"))
    # Counted before rows move: a slot that very many share is one row a task.
    shared = taken.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return taken.join(measured(frozen(shared, "simhash-shared"), F.lit(16)), "slot").select("fp", "slot", "n")


def _slot_links(slots: DataFrame, max_bits: int) -> DataFrame:
    """Pairs of a slot whose complete distance holds; each link from one slot alone."""
    def side(name: str) -> DataFrame:
        low, high = _segments(F.col("fp"))
        own = F.when(F.col("slot") >= F.lit(1 << 32), high.bitwiseOR(F.lit(1 << 32))).otherwise(low)
        return slots.select(
            F.col("slot").alias(f"{name}_slot"),
            F.col("fp").alias(name),
            F.col("slot").bitwiseXOR(own).alias(f"{name}_mask"),
        )

    apart = F.col("a").bitwiseXOR(F.col("b"))
    # A pair meets in many slots. It counts in the one with the smaller mask on
    # a's side, and in the upper table only if the lower one cannot show it.
    once = (F.col("a_mask") < F.col("b_mask")) | ((F.col("a_mask") == 0) & (F.col("b_mask") == 0))
    table = (F.col("a_slot") < F.lit(1 << 32)) | (F.bit_count(apart.bitwiseAND(F.lit(0xFFFFFFFF))) > 2)
    near = (F.col("a") != F.col("b")) & (F.bit_count(apart) <= max_bits)
    met = F.col("a_slot") == F.col("b_slot")
    return side("a").join(side("b"), met & once & table & near).select("a", "b")


def _dense_links(dense: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints of crowded slots, without comparing pairs.

    Two fingerprints at most four bits apart have a common centre at most two
    bits from either, and all that share a centre are at most four bits apart
    (likewise two bits and one). So linking each to the smallest at every centre
    gives the same components; the work is 2,081 rows a fingerprint, however
    crowded the slot.
    """
    masks = F.array(*(F.lit(m) for m in _flips(64, max_bits // 2)))
    centres = dense.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("centre"))
    least = F.min("fp").over(Window.partitionBy("centre"))
    return centres.select(F.col("fp").alias("a"), least.alias("b")).filter("a <> b").distinct()


def links(distinct: DataFrame, max_bits: int = MAX_BITS, dense_slot: int = DENSE_SLOT) -> DataFrame:
    """Links ``a, b`` with the same components as all pairs at most ``max_bits`` apart."""
    if max_bits not in (2, 4):
        raise ValueError("two segments and common centres serve 2 or 4 differing bits")
    slots = frozen(table_slots(distinct), "simhash-slots")
    found = _slot_links(slots.filter(F.col("n") <= dense_slot).drop("n"), max_bits)
    dense = slots.filter(F.col("n") > dense_slot).select("fp").distinct()
    if dense.isEmpty():
        return found
    return found.union(_dense_links(dense, max_bits))


def grouped(
    docs: DataFrame, id_col: str, text_col: str, width: int, max_bits: int, dense_slot: int
) -> DataFrame:
    """``doc_id``, keys, ``fp``, ``root`` (one fingerprint a component) and ``component_id`` of every row."""
    prints = frozen(fingerprints(docs, id_col, text_col, width), "simhash")
    nodes = frozen(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(nodes.select("fp"), max_bits, dense_slot))
    rooted = roots.withColumnRenamed("node", "fp").join(nodes, "fp")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(smallest, "root").select("fp", "root", "least")
    component = nodes.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "first").alias("component_id")
    )
    # Written, so that the join below is the whole stage and a fingerprint that a
    # third of all rows have can be split at run time.
    return prints.join(frozen(component, "simhash-components"), "fp")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    dense_slot: int = DENSE_SLOT,
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row.

    Documents link if their fingerprints differ in at most ``max_bits`` bits;
    the component is the smallest id reachable. Equal fingerprints are one
    node, so groups of copies cost one row each. A null or empty text has
    fingerprint zero and links like any other; repeated rows stay; a null id
    gets the smallest id of its component, or null if that has none; other
    columns are ignored; an empty table gives no rows. A very long text is hashed
    in blocks of its shingles, its words in memory.
    """
    return grouped(docs, id_col, text_col, width, max_bits, dense_slot).select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    dense_slot: int = DENSE_SLOT,
) -> DataFrame:
    """One row of each component, with all columns: the smallest id, a null one only if there is no other.

    Where an id stands on several rows of a component, one of them stays.
    """
    found = grouped(docs, id_col, text_col, width, max_bits, dense_slot)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "__key", "__key2")).alias("least")
    kept = found.groupBy("root").agg(least).select("least.__key", "least.__key2")
    keys = ["__key", "__key2"]
    rows = docs.select(*(column(docs, c) for c in docs.columns), *row_keys(docs, id_col, text_col))
    return rows.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys)


def fingerprint_text(fp: Column) -> Column:
    """The fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
