"""Toxicity scores from a counterfactually regularised linear classifier."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chatpulse.llm.common import SLICE_ROWS, column, drawn, frozen, id_crc

#: Bound of the labelled sample: rows of each label.
SAMPLE_ROWS = 6_000
#: Bounds of the features: kept ones, documents that must have one, and the
#: least change of the log odds of a label that one must make.
FEATURES = 50_000
LEAST_DOCUMENTS = 3
LEAST_LOG_ODDS = 2.0
#: Openings of a word that are features beside the word.
OPENINGS = (4, 5, 6)
FIT_STEPS = 400
RIDGE = 1e-4
#: Weight of the squared change of the score when identity terms are swapped.
SWAP_PENALTY = 1.0
#: Words and features that a task counts, or words that it remembers, at a time.
_MEMORY = 1_000_000

#: Terms that name a group without judging it, by what they can be
#: swapped with.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("man", "woman"),
    ("men", "women"),
    ("boy", "girl"),
    ("boys", "girls"),
    ("deaf", "blind", "disabled"),
    ("old", "young"),
    ("immigrant", "native"),
    ("immigrants", "natives"),
)

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word, and its openings marked as such."""
    return [word, *(f"{word[:n]}*" for n in OPENINGS if len(word) >= n)]


def swapped(words: set[str], groups: Sequence[Sequence[str]] = IDENTITY_TERMS) -> set[str]:
    """The words with every identity term replaced by the next of its group."""
    following = {term: group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}
    return {following.get(word, word) for word in words}


@dataclass
class ToxicityModel:
    """Weights of features; a document has a feature once or not at all."""

    places: dict[str, int]
    weights: np.ndarray
    bias: float
    remembered: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def indices(self, words: Iterable[str]) -> list[int]:
        found: set[int] = set()
        for word in words:
            known = self.remembered.get(word)
            if known is None:
                if len(self.remembered) >= _MEMORY:
                    self.remembered.clear()
                known = tuple(self.places[f] for f in features_of(word) if f in self.places)
                self.remembered[word] = known
            if known:
                found.update(known)
        return sorted(found)

    def score(self, text: str | None) -> float:
        margin = self.bias + float(self.weights[self.indices(words_of(text))].sum())
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, margin))))


def fit(
    rows: list[list[int]], others: list[list[int]], labels: np.ndarray, size: int,
    swap_penalty: float = SWAP_PENALTY, ridge: float = RIDGE, steps: int = FIT_STEPS,
) -> tuple[np.ndarray, float]:
    """Weights and bias of least logistic loss, ridge and counterfactual penalty.

    ``others`` has the features of each row after the swap, the same list where
    nothing was swapped. The penalty is the mean squared difference of the two
    scores (before the logistic function), so a term earns weight only as far as
    the terms it could be swapped with do.
    """
    count = len(rows)
    prior = (labels.sum() + 0.5) / (count + 2.0)
    # Both labels weigh the same in the loss, however rare one is.
    each = np.where(labels > 0, 0.5 / max(1.0, labels.sum()), 0.5 / max(1.0, count - labels.sum()))
    weights, bias = np.zeros(size + 1), math.log(prior / (1 - prior))
    if not count:
        return weights[:size], bias
    owner = np.repeat(np.arange(count), [len(r) for r in rows])
    index = np.concatenate([np.array(r, np.int64) for r in rows])
    pairs = [(sorted(set(a) - set(b)), sorted(set(b) - set(a))) for a, b in zip(rows, others) if a != b]
    signs = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in pairs]) if pairs else np.zeros(0)
    pair = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    place = np.concatenate([np.array(a + b, np.int64) for a, b in pairs]) if pairs else np.zeros(0, np.int64)
    # Adam on all rows: few features are shared, so their scales differ widely.
    mean, spread = np.zeros(size + 1), np.zeros(size + 1)
    weights[size] = bias
    for step in range(1, steps + 1):
        margin = weights[size] + np.bincount(owner, weights[index], count)
        slope = (1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40))) - labels) * each
        gradient = np.bincount(index, slope[owner], size + 1) + ridge * weights
        gradient[size] = slope.sum()
        if pairs:
            change = np.bincount(pair, signs * weights[place], len(pairs))
            gradient += swap_penalty * 2 / count * np.bincount(place, signs * change[pair], size + 1)
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        weights -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-10)
    return weights[:size], float(weights[size])


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """``doc_id, label`` of up to ``rows`` documents of each label, drawn by a hash of the id.

    A document that is labelled more than once counts as toxic if any label says
    so; null ids and labels are left out.
    """
    known = labels.select(column(labels, id_col).alias("doc_id"), (column(labels, label_col) > 0).cast("int").alias("label"))
    single = known.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
    return drawn(single, "label", ["doc_id"], rows)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
    swap_penalty: float = SWAP_PENALTY,
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """A model of the labelled documents, of which a bounded sample is read.

    An id stands for one text, that with the least hash of those it has, so the
    sample has ``sample_rows`` rows of each label at most. It is written once, with whole
    texts. Spark counts its features by label; those that move the odds enough are
    kept. Only they and the sample's rows in them reach the driver.
    """
    chosen = labelled_sample(labels, id_col, label_col, sample_rows).withColumnRenamed("doc_id", "__id")
    rows = docs.select(column(docs, id_col).alias("__id"), column(docs, text_col).alias("text"))
    # At most twice sample_rows ids.
    found = rows.join(F.broadcast(chosen), "__id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    sample = frozen(found.groupBy("__id", "label").agg(least).select("label", "least.text"), "toxic-sample")

    def count(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed():
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in seen)],
                names=["feature", "clean", "toxic"],
            )
            seen[0].clear(), seen[1].clear()

        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[label].update({f for word in words_of(text) for f in features_of(word)})
                if len(seen[0]) + len(seen[1]) > _MEMORY:
                    yield from flushed()
        yield from flushed()

    totals = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    counted = sample.mapInArrow(count, "feature string, clean bigint, toxic bigint")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    kept = (
        counted.filter(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumn("odds", odds)
        .filter(F.abs("odds") >= LEAST_LOG_ODDS)
        .orderBy(F.desc(F.abs("odds") * F.sqrt(F.col("clean") + F.col("toxic"))), "feature")
        .limit(FEATURES)
    )
    places = {row.feature: i for i, row in enumerate(kept.select("feature").collect())}
    model = ToxicityModel(places, np.zeros(len(places)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def featured(batches):
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            own = [shared.value.indices(w) for w in words]
            other = [shared.value.indices(swapped(w, groups)) for w in words]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, kind), pa.array(other, kind)], names=["label", "own", "other"]
            )

    read = sample.mapInArrow(featured, "label int, own array<int>, other array<int>").collect()
    truth = np.array([r.label for r in read], float)
    model.weights, model.bias = fit([r.own for r in read], [r.other for r in read], truth, len(places), swap_penalty)
    model.remembered.clear()
    return model


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``extra`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Whole texts are scored, a very long one as the set of its words. A null or empty
    text has no feature and gets the score of the bias; repeated rows and other columns
    named pass through; an empty table stays empty. Without labelled rows every score is 0.25.
    """
    picked = docs.select(*(column(docs, c) for c in extra), column(docs, text_col).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                scores = [shared.value.score(t) for t in rows.column(len(extra)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[: len(extra)], pa.array(scores, pa.float64())], names=[*extra, "score"]
                )

    made = picked.mapInArrow(run, picked.drop("__text").schema.add("score", "double"))
    return made.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out_fifth(rows: DataFrame, id_col: str = "doc_id"):
    """True for the rows that no model may learn from: crc32 of the id is a multiple of 5."""
    return F.pmod(id_crc(column(rows, id_col)), F.lit(5)) == 0


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Learns from the labels that are not held out and scores all documents."""
    model = train(docs, labels.filter(~held_out_fifth(labels, id_col)), id_col)
    return scored(docs.withColumn("held_out", held_out_fifth(docs, id_col)), model, extra=(id_col, "held_out"))
