"""Nearest vectors by inner product: probed lists, scanned by as many dimensions as a candidate needs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from chatpulse.llm.common import column, frozen, measured

TOP = 20
QUERY_EVERY = 20
#: Vectors that the centres of the lists are fitted on, those with the least hash, and the
#: components they have together at most. Every vector is indexed.
SAMPLE_VECTORS = 20_000
SAMPLE_COMPONENTS = 8_000_000
FIT_ROUNDS = 12
#: Vectors a list should have, and bounds on the lists and on all components of their centres.
LIST_VECTORS = 1024
LEAST_LISTS = 16
CENTRE_COMPONENTS = 1_000_000
#: Queries that the number of probed lists is measured with, and the share of their nearest it must reach.
TRIAL_QUERIES = 256
TRIAL_RECALL = 0.96
#: Vectors of a list, and queries, that one task holds together.
PART_VECTORS = 8192
BATCH_QUERIES = 2048
#: Dimensions looked at between two tests, and the width of a test: a vector is given up
#: if its partial distance is unlikely for one as near as the bound.
BLOCK_DIMENSIONS = 16
DOUBT = 2.1
SEED = 20
#: What rounding may add to a distance.
_ROUNDING = 1e-9
#: Queries compared with one part at a time.
_TOGETHER = 128


@dataclass
class Model:
    """``scale``: the largest norm. Vectors get one more component that brings all to this norm,
    and queries are scaled to it, so that the nearest by distance is the largest inner product."""

    scale: float
    centres: np.ndarray
    rotation: np.ndarray

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """In units of the largest norm, whose square may be no number."""
        unit = vectors / self.scale
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        return np.column_stack([unit, rest])

    def asked(self, queries: np.ndarray) -> np.ndarray:
        return np.column_stack([_unit(queries), np.zeros(len(queries))])

    def order(self, points: np.ndarray) -> np.ndarray:
        """The lists from the nearest centre on, for each point."""
        apart = np.einsum("ij,ij->i", self.centres, self.centres) - 2 * points @ self.centres.T
        return np.argsort(apart, axis=1, kind="stable")


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / largest
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _stacked(lists: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    chunks = lists.chunks if isinstance(lists, pa.ChunkedArray) else [lists]
    parts = [np.asarray(c.flatten(), dtype).reshape(len(c), -1) for c in chunks if len(c)]
    return np.concatenate(parts) if parts else np.zeros((0, 0), dtype)


def _listed(rows: np.ndarray, kind=pa.float64()) -> pa.Array:
    width = rows.shape[1]
    ends = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(rows).ravel(), kind))


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal vectors give equal ones, wherever they stand."""
    return (vectors * query).sum(axis=1)


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and one not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def fitted(sample: np.ndarray, scale: float, lists: int) -> Model:
    """Centres of the lists by k-means from a fixed start, and a rotation."""
    rng = np.random.default_rng(SEED)
    width = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    model = Model(scale, np.zeros((0, width)), rotation)
    points = model.lifted(sample)
    lists = min(lists, len(points))
    model.centres = points[rng.choice(len(points), lists, replace=False)]
    for _ in range(FIT_ROUNDS):
        own = np.concatenate([model.order(part)[:, 0] for part in np.array_split(points, -(-len(points) // 4096))])
        sums = np.zeros_like(model.centres)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=lists)
        model.centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], model.centres)
    return model


def _assign(shared):
    """Every vector's list, and its rotated components."""

    def run(batches):
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = model.lifted(_stacked(batch.column("vector")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.order(points)[:, 0], pa.int32()), _listed(points @ model.rotation)],
                names=[*batch.schema.names, "list", "rotated"],
            )

    return run


def _probe(shared, probes: int):
    """``query, vector, list, place``: the nearest lists of each query, the nearest at place 0."""

    def run(batches):
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            order = model.order(model.asked(_stacked(batch.column("vector"))))[:, :probes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("vector"), _listed(order, pa.int32())], names=["query", "vector", "lists"]
            )

    return run


def _trial(queries: np.ndarray, top: int):
    """The nearest of each batch for every trial query: ``trial, score, list``."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = queries @ _stacked(batch.column("vector")).T
            lists = batch.column("list").to_numpy()
            best = np.argsort(-scores, axis=1, kind="stable")[:, :top]
            trial = np.repeat(np.arange(len(queries)), best.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(trial, pa.int32()), pa.array(np.take_along_axis(scores, best, 1).ravel()), pa.array(lists[best.ravel()], pa.int32())],
                names=["trial", "score", "list"],
            )

    return run


def _survivors(blocks: list[np.ndarray], asked: list[np.ndarray], bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, vector, distance`` (squared) of the pairs that no test gives up.

    The blocks are columns of the rotated vectors, so what was seen after some of them is
    the distance along as many random directions. Were the whole distance within the
    bound, the part seen would rarely be above its share of it by more than the test allows.
    """
    width, seen = sum(b.shape[1] for b in blocks), 0
    apart = np.zeros((len(asked[0]), len(blocks[0])))
    pairs = None
    for block, query in zip(blocks, asked):
        seen += block.shape[1]
        if pairs is None:
            apart += np.einsum("ij,ij->i", query, query)[:, None] + np.einsum("ij,ij->i", block, block) - 2 * query @ block.T
        else:
            step = block[pairs[1]] - query[pairs[0]]
            apart += np.einsum("ij,ij->i", step, step)
        allowed = bound * (1 + DOUBT / np.sqrt(seen)) ** 2 * seen / width if seen < width else bound
        if pairs is None:
            alive = apart <= allowed[:, None]
            # Few are left: from here on they are looked at one by one.
            if seen == width or alive.mean() < 0.25:
                pairs = np.nonzero(alive)
                apart = apart[pairs]
        else:
            alive = apart <= allowed[pairs[0]]
            pairs, apart = (pairs[0][alive], pairs[1][alive]), apart[alive]
    return *pairs, apart


def _scan(top: int):
    """One part of a list and the queries that probe it: the nearest of the part for each query."""

    def run(key, part: pa.Table, batch: pa.Table) -> pa.Table:
        made: dict[str, list] = {"query": [], "class": [], "least": [], "score": []}
        if part.num_rows and batch.num_rows:
            vectors, rotated = _stacked(part["vector"]), _stacked(part["rotated"])
            classes, least = part["class"].to_numpy(), part["least"].to_numpy()
            queries, turned = _stacked(batch["vector"]), _stacked(batch["rotated"])
            names, bounds = batch["query"].to_numpy(), batch["bound"].to_numpy()
            cuts = range(BLOCK_DIMENSIONS, rotated.shape[1], BLOCK_DIMENSIONS)
            blocks = [np.ascontiguousarray(b) for b in np.split(rotated, cuts, axis=1)]
            for at in range(0, len(queries), _TOGETHER):
                own = slice(at, at + _TOGETHER)
                # The first vectors of the part bound the distance where they are near.
                first = rotated[: 4 * top]
                near = np.square(turned[own]).sum(1)[:, None] + np.square(first).sum(1) - 2 * turned[own] @ first.T
                bound = bounds[own]
                if near.shape[1] >= top:
                    bound = np.minimum(bound, np.partition(near, top - 1, axis=1)[:, top - 1])
                bound = bound + _ROUNDING
                query, place, apart = _survivors(blocks, np.split(turned[own], cuts, axis=1), bound)
                ends = np.searchsorted(query, np.arange(len(bound) + 1))
                for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                    if b - a > top:
                        last = np.partition(apart[a:b], top - 1)[top - 1]
                        chosen = place[a:b][apart[a:b] <= last + 2 * _ROUNDING]
                    else:
                        chosen = place[a:b]
                    scores = products(vectors[chosen], queries[at + i])
                    best = np.lexsort((least[chosen], -scores))[:top]
                    made["query"].append(np.full(len(best), names[at + i]))
                    made["class"].append(classes[chosen[best]])
                    made["least"].append(least[chosen[best]])
                    made["score"].append(scores[best])
        whole = {n: np.concatenate(v) if v else np.zeros(0) for n, v in made.items()}
        return pa.table({n: pa.array(v, pa.float64() if n == "score" else pa.int64(), from_pandas=False) for n, v in whole.items()})

    return run


_FOUND = "query long, class long, least long, score double"


def _nearest(found: DataFrame, by: str, order: list, top: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return found.withColumn("nth", nth).filter(F.col("nth") <= top)


def _scanned(index: DataFrame, probing: DataFrame, shared, top: int) -> DataFrame:
    """The nearest classes of the queries ``query, vector, list, bound`` within their lists, from every part."""
    vectors = {r["list"]: r["n"] for r in index.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    queries = {r["list"]: r["n"] for r in probing.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}

    def pieces(sizes: dict[int, int], most: int) -> Column:
        more = {k: -(-n // most) for k, n in sizes.items() if n > most}
        pairs = [F.lit(x) for pair in more.items() for x in pair]
        return F.coalesce(F.create_map(*pairs)[F.col("list")] if pairs else F.lit(None).cast("int"), F.lit(1))

    parts, batches = pieces(vectors, PART_VECTORS), pieces(queries, BATCH_QUERIES)

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    def own(key: str, n: Column) -> Column:
        return F.pmod(F.xxhash64(key), n).cast("int")

    def turn(rows):
        model = shared.value
        for batch in rows:
            points = model.asked(_stacked(batch.column("vector"))) if batch.num_rows else np.zeros((0, 1))
            rotated = points @ model.rotation if batch.num_rows else points
            yield pa.RecordBatch.from_arrays([*batch.columns, _listed(rotated)], names=[*batch.schema.names, "rotated"])

    turned = probing.mapInArrow(turn, T.StructType([*probing.schema.fields, T.StructField("rotated", T.ArrayType(T.DoubleType()))]))
    left = index.withColumn("part", own("class", parts)).withColumn("batch", every(batches))
    right = turned.withColumn("batch", own("query", batches)).withColumn("part", every(parts))
    keys = ["list", "part", "batch"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_scan(top), _FOUND)


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_every: int = QUERY_EVERY,
    top: int = TOP,
    recall: float = TRIAL_RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` rows with the largest inner product found for
    each row whose id is divisible by ``query_every``, among all rows but its own.

    Vectors are lifted to one norm, rotated at random and dealt to the list with the
    nearest centre. A query's nearest list is scanned first, which bounds how far its
    answers can be; its other lists are scanned under that bound, block by block of
    dimensions, and a vector is given up once its partial distance is too long for the
    bound. What is left is compared by the inner product of the original vectors. How
    many lists are probed is measured: as many as ``recall`` of the nearest of some
    trial queries, by brute force, lie in.

    Equal vectors are indexed once, with all their rows, so a group of copies costs
    as much as one of them; large lists are split into parts. Vectors that are null,
    empty or zero, or hold a null or a non-finite component, take no part, nor do
    rows without an id and vectors of another length than most have (the longer of
    equally frequent lengths). Repeated ids are rows of their own. Ties go to the
    smaller id. Fewer candidates than ``top`` give all; other columns are ignored; an
    empty table gives no rows. A rotation of d dimensions takes 8 d² bytes a task.
    """
    spark = vectors.sparkSession
    vector = column(vectors, vector_col)
    rows = vectors.select(column(vectors, id_col).cast("bigint").alias("vec_id"), vector.cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    width = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    result = "query_id bigint, rank int, vec_id bigint, score double"
    if width is None:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("vector") == width["width"]).withColumn("row", F.monotonically_increasing_id())
    rows = frozen(rows, "vectors")
    classes = rows.groupBy("vector").agg(F.min("row").alias("class"), F.min("vec_id").alias("least"))
    classes = frozen(classes, "vector-classes")
    members = rows.join(classes.select("vector", "class"), "vector").select("class", "vec_id", "row")
    members = frozen(members, "vector-members")

    wide = width["width"] + 1
    largest = F.aggregate("vector", F.lit(0.0), lambda most, x: F.greatest(most, F.abs(x)))
    unit = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("most")) * (x / F.col("most")))
    norm = F.col("most") * F.sqrt(unit)
    norms = classes.withColumn("most", largest).select(norm.alias("norm"))
    n, scale = norms.agg(F.count(F.lit(1)), F.max("norm")).first()
    by_hash = classes.orderBy(F.xxhash64("class"), "class")
    sample = by_hash.limit(max(1, min(SAMPLE_VECTORS, SAMPLE_COMPONENTS // wide))).select("vector").toArrow()
    lists = min(max(LEAST_LISTS, n // LIST_VECTORS), max(1, CENTRE_COMPONENTS // wide))
    model = fitted(_stacked(sample["vector"]), scale, lists)
    shared = spark.sparkContext.broadcast(model)
    dealt = T.StructType([*classes.schema.fields, T.StructField("list", T.IntegerType()), T.StructField("rotated", T.ArrayType(T.DoubleType()))])
    index = frozen(classes.mapInArrow(_assign(shared), dealt), "vector-index")

    asking = members.filter(F.col("vec_id") % query_every == 0)
    queries = classes.join(asking.select("class").distinct(), "class").select(F.col("class").alias("query"), "vector")
    queries = frozen(queries, "vector-queries")
    probes = _probes(index, queries, model, top, recall)
    listed = T.StructType([*queries.schema.fields, T.StructField("lists", T.ArrayType(T.IntegerType()))])
    probing = queries.mapInArrow(_probe(shared, probes), listed).select("query", "vector", F.posexplode("lists").alias("place", "list"))
    probing = frozen(probing, "vector-probing")

    # One more than asked for, as a query may find itself.
    wanted, order = top + 1, [F.desc("score"), "least"]
    close = probing.filter("place = 0").select("query", "vector", "list", F.lit(float("inf")).alias("bound"))
    close = frozen(_scanned(index, close, shared, wanted), "vector-close")
    reached = _nearest(close, "query", order, wanted).filter(F.col("nth") == wanted)
    bound = F.lit(2.0) - F.lit(2.0) * F.col("score") / F.col("norm") / F.lit(scale)
    # Without one there is no bound; nor where a product is beyond the numbers.
    bound = F.when(F.isnan(bound) | bound.isNull(), F.lit(float("inf"))).otherwise(bound)
    further = probing.filter("place > 0").join(reached.select("query", "score"), "query", "left")
    further = further.withColumn("most", largest).withColumn("norm", norm)
    further = frozen(further.select("query", "vector", "list", bound.alias("bound")), "vector-bounds")
    found = close.union(_scanned(index, further, shared, wanted))

    best = frozen(_nearest(found, "query", order, wanted).select("query", "class", "score"), "vector-best")
    few = _nearest(members, "class", ["vec_id", "row"], wanted).drop("nth")
    answers = _nearest(best.join(few, "class"), "query", [F.desc("score"), "vec_id", "row"], wanted)
    answers = answers.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "row", "score"))).alias("found"))
    own = asking.withColumnRenamed("class", "query").join(answers, "query")
    others = F.slice(F.filter("found", lambda x: x["row"] != F.col("row")), 1, top)
    return own.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("place", "f")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")
    )


def _probes(index: DataFrame, queries: DataFrame, model: Model, top: int, recall: float) -> int:
    """How many lists hold ``recall`` of the nearest of the trial queries, found by brute force."""
    sample = queries.orderBy(F.xxhash64("query"), "query").limit(TRIAL_QUERIES).select("vector").toArrow()
    trial = _stacked(sample["vector"])
    if not len(trial):
        return 1
    near = index.select("vector", "list").mapInArrow(_trial(_unit(trial), top), "trial int, score double, list int")
    near = _nearest(near, "trial", [F.desc("score"), "list"], top).select("trial", "list").toArrow()
    places = np.argsort(model.order(model.asked(trial)), axis=1)[near["trial"].to_numpy(), near["list"].to_numpy()]
    return int(np.sort(places)[max(0, int(np.ceil(recall * len(places))) - 1)]) + 1
