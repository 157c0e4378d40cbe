"""Document fingerprints by winnowing."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chatpulse.llm.common import SLICE_ROWS, column

#: Code points of a gram and grams of a window. Two texts that share a passage
#: of ``GRAM + WINDOW - 1`` code points share a mark.
GRAM = 16
WINDOW = 40
#: Grams hashed in one go; positions inside a segment fit 24 bits.
SEGMENT = 1 << 20
_PLACE_BITS = 24
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9


@lru_cache(maxsize=32)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    def rows(factor: int) -> np.ndarray:
        factors = np.full(size + 1, factor, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    return rows(_BASE), rows(pow(_BASE, -1, 1 << 64))


def gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """A 40-bit hash of every gram, all rolled at once.

    A gram's polynomial is the difference of two running sums, shifted back by
    a power of the inverse; a multiplication spreads it over the upper bits.
    """
    # Sizes double, so what is kept takes twice what the longest text needs.
    up, down = _powers(1 << len(points).bit_length())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)])])
    values = (sums[gram:] - sums[:-gram]) * down[: len(sums) - gram]
    values ^= values >> np.uint64(32)
    values *= np.uint64(_MIX)
    values ^= values >> np.uint64(29)
    values *= np.uint64(_BASE)
    return values >> np.uint64(_PLACE_BITS)


def _window_minima(keys: np.ndarray, window: int) -> np.ndarray:
    """The least key of every window, by windows that double in width."""
    window, width = min(window, len(keys)), 1
    while 2 * width <= window:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    rest = window - width
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions (code points) of the marks, in text order.

    Of every window the gram with the least hash is marked, the rightmost of
    equal ones. A text shorter than a gram is one gram, one with fewer grams
    than a window is one window, an empty text has no mark.
    """
    if gram + window > SEGMENT:
        raise ValueError(f"gram and window together go up to {SEGMENT}")
    text = text or ""
    gram = max(1, min(gram, len(text)))
    hashes, places = [], []
    grams = len(text) - gram + 1 if text else 0
    for at in range(0, max(0, grams - window + 1) if grams > window else grams and 1, SEGMENT):
        part = text[at : at + SEGMENT + window + gram - 2]
        values = gram_hashes(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32), gram)
        # A later gram has the smaller key, so equal hashes go to the rightmost.
        limit = np.uint64((1 << _PLACE_BITS) - 1)
        keys = values << np.uint64(_PLACE_BITS) | limit - np.arange(len(values), dtype=np.uint64)
        least = _window_minima(keys, window)
        least = least[np.r_[True, least[1:] != least[:-1]]]
        hashes.append(least >> np.uint64(_PLACE_BITS))
        places.append((limit - (least & limit)).astype(np.int64) + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    first = np.r_[True, places[1:] != places[:-1]]
    return hashes[first], places[first]


def fingerprint_text(marks: tuple[np.ndarray, np.ndarray]) -> str:
    """``hash@position`` of every mark, the hash in ten hexadecimal digits."""
    return " ".join([f"{h:010x}@{p}" for h, p in zip(marks[0].tolist(), marks[1].tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of the different hashes of both; 1 if neither has any."""
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a or b else 1.0


def fingerprints(docs: DataFrame, text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """All columns with ``marks``: array of ``hash, position`` in text order.

    Null and empty texts have no marks; repeated rows stay, a column ``marks``
    of the input is replaced, an empty table stays empty.
    """
    picked = docs.select(*(column(docs, c) for c in docs.columns if c != "marks"))
    place = picked.columns.index(text_col)
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("position", pa.int64())]))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                made = [
                    [{"hash": h, "position": p} for h, p in zip(*(part.tolist() for part in winnow(t, gram, window)))]
                    for t in rows.column(place).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(made, kind)], names=[*rows.schema.names, "marks"])

    out = picked.withColumn("marks", F.array().cast("array<struct<hash:bigint,position:bigint>>")).schema
    return picked.mapInArrow(run, out)


#: Rows of one id, or of one text of it, from which on they may have buckets of their own.
_HEAVY_ROWS = 64


def _array(values: list[int], kind: str) -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def _bucketed(rows: DataFrame, buckets: int):
    """A function that adds ``bucket`` to rows with ``doc_id`` and ``hash``.

    Buckets are runs of the documents in descending id, nulls last, equal ids by the
    hash of their text. They are cut at quantiles of the id. An id (or the rows
    without one) that would fill a bucket is cut by the hash; rows with one id and
    one text that would are dealt out, as they may follow each other in any order.
    """
    parts = [i / buckets for i in range(1, buckets)]
    total, quantiles = rows.agg(F.count(F.lit(1)), F.percentile_approx("doc_id", parts, 100 * buckets)).first()
    most = max(_HEAVY_ROWS, -(-total // buckets))
    # Fewer than there are buckets, as each fills one.
    heavy = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).collect()
    ids = [r.doc_id for r in heavy if r.doc_id is not None]
    cuts = sorted({*(quantiles or []), *ids, *(i + 1 for i in ids if i < 2**63 - 1)})
    run = lambda doc_id: len(cuts) + 1 if doc_id is None else len(cuts) - sum(c <= doc_id for c in cuts)
    copies: dict[int, list[tuple[int, int]]] = {}
    if heavy:
        wanted = rows.sparkSession.createDataFrame(pa.table({"heavy": pa.array([r.doc_id for r in heavy], pa.int64())}))
        of_heavy = rows.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("heavy")))
        many = of_heavy.groupBy("doc_id", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
        for r in many.collect():
            copies.setdefault(run(r.doc_id), []).append((r.hash, r.n))
    breaks, begins, deals = {}, {}, {}
    for r in heavy:
        own, dealt = run(r.doc_id), dict(copies.get(run(r.doc_id), []))
        pieces = max(1, -(-3 * (r.n - sum(dealt.values())) // (2 * most)))
        edges = {-(2**63) + k * 2**64 // pieces for k in range(1, pieces)} | dealt.keys() | {h + 1 for h in dealt if h < 2**63 - 1}
        breaks[own] = sorted(edges)
        lows = [-(2**63), *breaks[own]]
        deals[own] = [max(1, -(-3 * dealt[h] // (2 * most))) if h in dealt else 1 for h in lows]
        begins[own] = [0, *np.cumsum(deals[own]).tolist()]
    firsts, first = [], 0
    for number in range(len(cuts) + 2):
        firsts.append(first)
        first += begins[number][-1] if number in begins else 1

    def bucketed(some: DataFrame) -> DataFrame:
        known = F.lit(len(cuts)) - F.size(F.filter(_array(cuts, "bigint"), lambda c: c <= F.col("doc_id")))
        number = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(known)
        bucket = F.element_at(_array(firsts, "int"), (F.col("number") + 1).cast("int"))
        for own in begins:
            place = F.size(F.filter(_array(breaks[own], "bigint"), lambda e: e <= F.col("hash"))) + 1
            deal = F.pmod(F.xxhash64("row"), F.element_at(_array(deals[own], "int"), place))
            inside = F.element_at(_array(begins[own], "int"), place) + deal
            bucket = F.when(F.col("number") == own, F.lit(firsts[own]) + inside).otherwise(bucket)
        placed = some.withColumn("row", F.monotonically_increasing_id()).withColumn("number", number)
        return placed.withColumn("bucket", bucket.cast("int")).drop("row", "number")

    return bucketed


def in_descending_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket, ahead, doc_id, text``, where each bucket is a run of documents in descending id.

    The last row of a bucket has ``ahead`` set: it is a copy of the document that
    follows the bucket (of the very first one, after the last), so every bucket can
    be read on its own. Nulls come last; equal ids go by a hash of the text. No
    bucket has many more rows than the others, be it that an id, the null ids or
    one repeated row have most of the table.
    """
    spark = docs.sparkSession
    rows = docs.select(column(docs, id_col).cast("bigint").alias("doc_id"), F.coalesce(column(docs, text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed = _bucketed(rows, 4 * width)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), (-F.col("doc_id").cast("decimal(20)")).alias("down"), "hash", "doc_id"))
    heads = bucketed(rows.drop("text")).groupBy("bucket").agg(first.alias("f")).select("bucket", "f.doc_id", "f.hash").orderBy("bucket").collect()
    afters = heads[1:] + heads[:1]
    # An Arrow table: rows in a list would be read by Python workers, which executors keep beside those of the survey.
    wanted = spark.createDataFrame(
        pa.table(
            {
                "bucket": pa.array([r.bucket for r in heads], pa.int32()),
                "head": pa.array([r.doc_id for r in afters], pa.int64()),
                "head_hash": pa.array([r.hash for r in afters], pa.int64()),
            }
        )
    )
    # At most one row a bucket, and the buckets are about as many as given above.
    single = F.broadcast(wanted.select("head", "head_hash").distinct())
    is_head = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash"))
    texts = rows.join(single, is_head).groupBy("head", "head_hash").agg(F.min("text").alias("text"))
    same = F.col("w.head").eqNullSafe(F.col("t.head")) & (F.col("w.head_hash") == F.col("t.head_hash"))
    ahead = texts.alias("t").join(F.broadcast(wanted).alias("w"), same).select(
        "w.bucket", F.lit(True).alias("ahead"), F.col("w.head").alias("doc_id"), "t.text", F.col("w.head_hash").alias("hash")
    )
    own = bucketed(rows).select("bucket", F.lit(False).alias("ahead"), "doc_id", "text", "hash")
    return (
        own.union(ahead)
        .repartition(width, "bucket")
        .sortWithinPartitions("bucket", "ahead", F.desc_nulls_last("doc_id"), "hash")
        .drop("hash")
    )


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the following one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_survey(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its text edited with the next one's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``; the next document is the one after it in
    descending id, that of the last is the first. Documents stream through their
    buckets in order, two held at a time. Null texts count as empty; null ids
    come last; repeated rows follow each other, in as many buckets as they fill; other
    columns are ignored; an empty table gives no rows, a single document follows
    itself. A very long text is held whole, with the next one.
    """
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    kinds = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64())]
        + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def surveyed(doc_id, text, marks, following, following_marks) -> tuple:
        changed = edited(text, following)
        changed_marks = winnow(changed)
        return (
            doc_id,
            len(text),
            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            fingerprint_text(marks),
            fingerprint_text(changed_marks),
            likeness(marks[0], changed_marks[0]),
            likeness(marks[0], following_marks[0]),
        )

    def run(batches):
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                made = []
                part = batch.slice(at, SLICE_ROWS)
                for bucket, ahead, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    marks = winnow(text := text or "")
                    if held and held[0] == bucket:
                        made.append(surveyed(*held[1:], text, marks))
                    held = None if ahead else (bucket, doc_id, text, marks)
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*made), kinds)], schema=kinds
                    )

    return in_descending_order(docs, id_col, text_col).mapInArrow(run, schema)
