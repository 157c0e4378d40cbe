"""Ranked lexical search: bundles of items pass the owners of their terms, one after the other."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from chatpulse.llm.common import SLICE_ROWS, column, frozen, looked_up, measured
from chatpulse.settings import work_folder

TOP = 20
#: Owners of terms, from the rarest terms to the commonest: a bundle passes them in this order.
OWNERS = 6
#: Documents of a block and items of a bundle, about: what a task holds of one group.
BLOCK_DOCUMENTS = 4096
BUNDLE_ITEMS = 128
#: Bits of the filter that spares most terms of the documents that no item has.
FILTER_BITS = 1 << 24

#: ASCII letters and digits and all that lies beyond ASCII make terms; the rest parts them.
_PARTING = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in range(256))


def term_counts(text: bytes | None) -> Counter:
    """The terms of a text in UTF-8 with their occurrences; only A-Z are lower-cased."""
    counts = Counter((text or b"").lower().translate(_PARTING).split(b" "))
    counts.pop(b"", None)
    return counts


def _filter_bits(terms: DataFrame) -> bytes:
    """A bit for the crc32 of each term, modulo the size: two megabytes, however many terms."""
    # Bitmaps of Spark count places from one.
    place = (F.crc32("term") % F.lit(FILTER_BITS) + 1).alias("place")
    maps = terms.select(place).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    bits = bytearray(FILTER_BITS // 8)
    for bucket, part in maps.collect():
        bits[(bucket - 1) * 4096 : bucket * 4096] = part
    return bytes(bits)


def _vectors(rows: DataFrame, id_col: str, text_col: str, name: str, bits: bytes | None = None) -> DataFrame:
    """``<name>, size, terms, counts`` of each row: how many terms, and the different ones that the filter lets pass."""
    shared = None if bits is None else rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        known = None if shared is None else shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = [term_counts(text) for text in part.column(1).to_pylist()]
                sizes = [counts.total() for counts in found]
                if known is not None:
                    crcs = ({t: zlib.crc32(t) % FILTER_BITS for t in counts} for counts in found)
                    found = [
                        {t: counts[t] for t, at in crc.items() if known[at >> 3] >> (at & 7) & 1}
                        for counts, crc in zip(found, crcs)
                    ]
                arrays = [
                    part.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array([list(counts) for counts in found], pa.list_(pa.binary())),
                    pa.array([list(counts.values()) for counts in found], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[name, "size", "terms", "counts"])

    text = column(rows, text_col).cast("string").cast("binary")
    picked = rows.select(column(rows, id_col).alias(name), text.alias("text"))
    made = T.StructType([picked.schema[name]]).add("size", "long")
    made = made.add("terms", T.ArrayType(T.BinaryType())).add("counts", T.ArrayType(T.LongType()))
    return picked.mapInArrow(run, made)


def _term_rows(vectors: DataFrame, *keep: str) -> DataFrame:
    pair = F.explode(F.arrays_zip("terms", "counts")).alias("t")
    return vectors.select(*keep, pair).select(*keep, F.col("t.terms").alias("term"), F.col("t.counts").alias("tf"))


def _impact(tf: Column, size: Column, n: int, total: int) -> Column:
    """What a term adds to a document's score for each unit of its weight."""
    longer = F.call_function("div", F.lit(25) * size * F.lit(n), F.lit(total))
    return F.call_function("div", F.lit(1_000_000_000) * tf, F.lit(1000) * tf + F.lit(12) * (F.lit(75) + longer))


def _with_owners(statistics: DataFrame, owners: int) -> DataFrame:
    """Adds ``owner``: rare terms come first, and every owner has about as many postings as the others.

    Terms are told apart by the logarithm of their number of documents, so the driver
    sees a few hundred counts at most.
    """
    step = F.floor(F.log2("df") * 8).cast("int")
    steps = statistics.groupBy(step.alias("step")).agg(F.sum("df").alias("postings")).orderBy("step").collect()
    everything, passed, owner_of = sum(s.postings for s in steps), 0, []
    for s in steps:
        # An owner goes by the middle of what its step holds.
        owner_of += [F.lit(s.step), F.lit(int((passed + s.postings / 2) * owners / everything))]
        passed += s.postings
    return statistics.withColumn("owner", F.create_map(*owner_of)[step] if owner_of else F.lit(0))


_SUMS = "bundle long, block long, item long, docs array<bigint>, scores array<bigint>, best array<bigint>"


def _lists(table: pa.Table, name: str) -> list[np.ndarray]:
    """A list column as one array a row."""
    parts = []
    for chunk in table.column(name).chunks:
        ends, values = chunk.offsets.to_numpy(), chunk.values.to_numpy(zero_copy_only=False)
        parts += [values[i:j] for i, j in zip(ends[:-1], ends[1:])]
    return parts


def _summed(docs: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document once, in order, with all its scores added."""
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    begins = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[begins], np.add.reduceat(scores, begins)


def _visit(top: int):
    """A bundle at an owner: adds what the owner's postings of one block give to its items."""

    def run(key, bundle: pa.Table, owned: pa.Table) -> pa.Table:
        sums: dict[int, list] = {}
        known: dict[int, np.ndarray] = {}
        for item, floor, docs, scores in zip(
            bundle.column("item").to_pylist(), bundle.column("floor").to_pylist(), _lists(bundle, "docs"), _lists(bundle, "scores")
        ):
            keep = scores >= floor
            sums[item], known[item] = [(docs[keep], scores[keep], 1)], docs[keep]
        open_items: dict[int, bool] = {}
        lists = (_lists(owned, name) for name in ("docs", "impacts", "items", "factors", "floors"))
        for docs, impacts, items, factors, floors in zip(*lists):
            for item, factor, floor in zip(items.tolist(), factors.tolist(), floors.tolist()):
                # Where too much is missing by now, a document without a sum cannot catch up.
                open_items[item] = floor <= 0
                if floor <= 0 or item in known:
                    # Multiplied item by item: lists are shared by all items until then.
                    sums.setdefault(item, []).append((docs, impacts, factor))
        made: dict[str, list] = {"item": [], "docs": [], "scores": [], "best": []}
        for item, parts in sums.items():
            docs = np.concatenate([docs for docs, _, _ in parts])
            scores = np.concatenate([impacts * factor for _, impacts, factor in parts])
            if not len(docs):
                continue
            docs, scores = _summed(docs, scores)
            if not open_items.get(item, True):
                kept = np.isin(docs, known[item], assume_unique=True)
                docs, scores = docs[kept], scores[kept]
            if len(docs):
                best = scores if len(scores) <= top else np.partition(scores, -top)[-top:]
                for name, value in zip(made, (item, docs, scores, best)):
                    made[name].append(value)
        n = len(made["item"])
        own = {name: pa.array([key[at].as_py()] * n, pa.int64()) for at, name in enumerate(("bundle", "block"))}
        more = {name: pa.array(made[name], pa.list_(pa.int64())) for name in ("docs", "scores", "best")}
        return pa.table(own | {"item": pa.array(made["item"], pa.int64())} | more)

    return run


def _thresholds(sums: DataFrame, top: int) -> DataFrame:
    """``item, reached``: its ``top``-th sum so far; items with fewer are left out."""
    each = sums.select("item", F.explode("best").alias("reached"))
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("reached")))
    return each.withColumn("nth", nth).filter(F.col("nth") <= top).filter(F.col("nth") == top).drop("nth")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    owners: int = OWNERS,
    block_documents: int = BLOCK_DOCUMENTS,
    bundle_items: int = BUNDLE_ITEMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents with the highest scores above 0 for each item.

    Every term belongs to one owner, by the number of documents that hold it. The
    items travel in bundles, each with its sums of scores over a block of documents,
    from the owner of the rarest terms to that of the commonest; a bundle and the
    postings it needs meet in a cogroup, and integers are added. Between two
    owners every item's ``top``-th sum is known: a document whose sum and all that
    the owners ahead can add stay below it is let go, which changes no result.

    A term's documents are split over the blocks, so neither a common term nor a
    large group of copies meets in one task. Null and empty texts have no term: such a
    document is never found, such an item finds nothing. Every row of the documents
    is a document of its own, also with an id that others have; ties go to the smaller id,
    null ids last, and then to either row. Repeated rows of an item count once; two texts
    under one id are ranked each. A very long text is one row of term counts.
    Other columns are ignored; an empty table on either side gives no rows.
    """
    asked = items.select(column(items, item_col).alias("item_id"), column(items, item_text_col).cast("string").alias("text"))
    asked = asked.distinct().select("item_id", "text", F.monotonically_increasing_id().alias("item"))
    asked = frozen(asked, "search-items")
    n_items = asked.count()
    bundle = F.pmod(F.xxhash64("item"), F.lit(-(-n_items // bundle_items) or 1))
    wanted = frozen(_term_rows(_vectors(asked, "item", "text", "item"), "item"), "search-terms")
    terms = frozen(wanted.select("term").distinct().withColumn("is_asked", F.lit(True)), "search-vocabulary")

    numbered = _vectors(docs, id_col, text_col, "doc_id", _filter_bits(terms))
    numbered = frozen(numbered.withColumn("doc", F.monotonically_increasing_id()), "search-vectors")
    n_rows, n, total = numbered.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("size") > 0, 1)), F.coalesce(F.sum("size"), F.lit(0))
    ).first()
    postings = looked_up(_term_rows(numbered, "doc", "size"), terms, "term").filter("is_asked")
    impact = _impact(F.col("tf"), F.col("size"), n, max(total, 1))
    statistics = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(impact).alias("most"))
    weight = F.floor(F.lit(1000) * F.ln(F.lit(2 * n + 2) / (F.lit(2) * F.col("df") + F.lit(1))))
    statistics = frozen(statistics.withColumn("weight", weight.cast("bigint")), "search-statistics")
    statistics = frozen(_with_owners(statistics, owners), "search-owners")

    block = F.pmod(F.xxhash64("doc"), F.lit(-(-n_rows // block_documents) or 1))
    owned = looked_up(postings.drop("is_asked"), statistics.select("term", "owner"), "term")
    entry = F.struct("doc", impact.alias("impact"))
    owned = owned.groupBy("owner", block.alias("block"), "term").agg(F.collect_list(entry).alias("e"))
    owned = owned.select("owner", "block", "term", F.col("e.doc").alias("docs"), F.col("e.impact").alias("impacts"))
    path = work_folder(docs.sparkSession, "search-owned")
    owned.write.partitionBy("owner").parquet(path)
    owned = docs.sparkSession.read.schema(owned.schema).parquet(path)

    factor = F.col("tf") * F.col("weight")
    known = statistics.select("term", "owner", "weight", "most")
    routes = wanted.join(measured(known, F.octet_length("term")), "term").select(
        "item", bundle.alias("bundle"), "term", "owner", factor.alias("factor"), (factor * F.col("most")).alias("potential")
    )
    routes = frozen(routes, "search-routes")

    sums = docs.sparkSession.createDataFrame([], _SUMS)
    reached = None
    for owner in range(owners):
        ahead = routes.groupBy("item").agg(
            F.coalesce(F.sum(F.when(F.col("owner") >= owner, F.col("potential"))), F.lit(0)).alias("ahead")
        )
        if reached is None:
            floors = ahead.withColumn("reached", F.lit(0).cast("bigint"))
        else:
            floors = ahead.join(measured(reached, F.lit(16)), "item", "left")
        floor = (F.coalesce("reached", F.lit(0)) - F.col("ahead")).alias("floor")
        floors = frozen(floors.select("item", floor), "search-floors")
        # Floors are few: a row an item. They go to the tasks where measured small.
        own = routes.filter(F.col("owner") == owner).join(measured(floors, F.lit(16)), "item")
        own = own.groupBy("term", "bundle").agg(F.collect_list(F.struct("item", "factor", "floor")).alias("r"))
        own = own.select(
            "term", "bundle", F.col("r.item").alias("items"), F.col("r.factor").alias("factors"), F.col("r.floor").alias("floors")
        )
        own = frozen(own, "search-own")
        sent = owned.filter(F.col("owner") == owner).drop("owner")
        sent = sent.join(measured(own, 24 * F.size("items")), "term")
        carried = sums.drop("best").join(measured(floors, F.lit(16)), "item")
        visited = carried.groupBy("bundle", "block").cogroup(sent.groupBy("bundle", "block")).applyInArrow(_visit(top), _SUMS)
        sums = frozen(visited, "search-sums")
        reached = frozen(_thresholds(sums, top), "search-reached")

    found = sums.select("item", "docs", "scores").join(measured(reached, F.lit(16)), "item", "left")
    pair = F.explode(F.filter(F.arrays_zip("docs", "scores"), lambda x: x["scores"] >= F.greatest(F.coalesce("reached", F.lit(1)), F.lit(1))))
    found = found.select("item", "reached", pair.alias("p")).select("item", F.col("p.docs").alias("doc"), F.col("p.scores").alias("score"))
    found = found.join(numbered.select("doc", "doc_id"), "doc").join(measured(asked.select("item", "item_id"), F.lit(16)), "item")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "doc"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
