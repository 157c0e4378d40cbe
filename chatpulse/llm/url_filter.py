"""URL filters: host and path rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from chatpulse.llm.common import column, drawn, frozen, looked_up

ALLOW, BLOCK = "allow", "block"
#: Bounds: rules (they become one expression) and labelled URLs of each verdict
#: to learn from. Every host suffix has statistics of its own.
MAX_RULES = 500
SAMPLE_ROWS = 20_000
TREES = 20
DEPTH = 4
_SEED = 7


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, then a path that starts at the first slash."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        own = (host == name) | host.endswith(f".{name}")
        return own & path.startswith(slash + rest)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def first_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Text and verdict of the longest rule that fits; null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"up to {MAX_RULES} rules")
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        made = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(rule.fits(host, path), made).otherwise(chosen)
    return chosen


def _entropy(text: Column) -> Column:
    """Bits of a character of the text, 0 for an empty one."""
    size = F.length(text)
    kinds = F.array_distinct(F.split(text, ""))
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    bits = F.aggregate(
        F.filter(kinds, lambda c: c != ""), F.lit(0.0), lambda total, c: total - share(c) * F.log2(share(c))
    )
    return F.when(size > 0, bits).otherwise(0.0)


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(url: Column, host: Column, path: Column) -> list[Column]:
    """Length, depth, digit ratio, entropy and parameter counts of a URL."""
    text = F.coalesce(url, F.lit(""))
    size = F.length(text)
    count = lambda pattern, of=text: F.regexp_count(of, F.lit(pattern)).cast("double")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    return [
        size.cast("double").alias("length"),
        F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"),
        count("/[^/]", path).alias("depth"),
        count(r"\.", host).alias("host_depth"),
        F.when(size > 0, count("[0-9]") / size).otherwise(0.0).alias("digit_ratio"),
        count("-").alias("hyphens"),
        _entropy(text).alias("entropy"),
        _entropy(host).alias("host_entropy"),
        F.when(query == "", 0.0).otherwise(count("&", query) + 1).alias("parameters"),
        text.contains("#").cast("double").alias("has_fragment"),
    ]


_LEXICAL = (
    "length host_length path_length depth host_depth digit_ratio hyphens entropy host_entropy parameters has_fragment"
).split()
_SUFFIXES = (1, 2)
_FEATURES = [*_LEXICAL, *(f"{what}_{n}" for n in _SUFFIXES for what in ("block_rate", "seen"))]


@dataclass
class UrlModel:
    """Trees and the suffix tables they were fitted with; or one verdict for all."""

    suffixes: dict[int, DataFrame]
    trees: GBTClassificationModel | None
    always: str = ALLOW

    def features(self, urls: DataFrame) -> DataFrame:
        """Adds the features to ``url, host, path``."""
        rows = urls.select("*", *lexical(F.col("url"), F.col("host"), F.col("path")))
        for n, table in self.suffixes.items():
            rows = looked_up(rows.withColumn(f"suffix_{n}", _suffix(F.col("host"), n)), table, f"suffix_{n}")
            rows = rows.fillna({f"block_rate_{n}": 0.5, f"seen_{n}": 0.0})
        return rows

    def verdict(self, urls: DataFrame) -> DataFrame:
        """Adds ``learned``: the trees' verdict on ``url, host, path``."""
        if self.trees is None:
            return urls.withColumn("learned", F.lit(self.always))
        vector = VectorAssembler(inputCols=_FEATURES, outputCol="features")
        judged = self.trees.transform(vector.transform(self.features(urls)))
        return judged.withColumn("learned", F.when(F.col("prediction") == 1, BLOCK).otherwise(ALLOW))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """Trees fitted to ``page_id, url, host, path, verdict``.

    Suffix statistics (share of blocked URLs, smoothed, and how many) count all
    labelled URLs, for every suffix; the trees see a sample of each
    verdict, drawn by a hash of id and URL. Every other row of the sample is shown without its suffix
    statistics, as a new host would be, or the trees would learn nothing else
    where suffixes decide. With one verdict only, or none, the model gives that
    one, or allow.
    """
    seen = {r.verdict: r["count"] for r in labelled.groupBy("verdict").count().collect()}
    if len(seen) < 2:
        return UrlModel({}, None, next(iter(seen), ALLOW))
    blocked = (F.col("verdict") == BLOCK).cast("int")
    suffixes = {}
    for n in _SUFFIXES:
        by = labelled.groupBy(_suffix(F.col("host"), n).alias(f"suffix_{n}"))
        table = by.agg(F.count(F.lit(1)).alias("n"), F.sum(blocked).alias("bad"))
        suffixes[n] = frozen(
            table.select(
                f"suffix_{n}",
                ((F.col("bad") + 1.0) / (F.col("n") + 2.0)).alias(f"block_rate_{n}"),
                F.log1p("n").alias(f"seen_{n}"),
            ),
            "url-suffixes",
        )
    sample = drawn(labelled, "verdict", ["page_id", "url"], sample_rows)
    model = UrlModel(suffixes, None)
    shown = model.features(sample).withColumn("unseen", F.pmod(F.xxhash64("url", "host"), F.lit(2)) == 0)
    for n in _SUFFIXES:
        for name, unknown in ((f"block_rate_{n}", 0.5), (f"seen_{n}", 0.0)):
            shown = shown.withColumn(name, F.when(F.col("unseen"), unknown).otherwise(F.col(name)))
    rows = frozen(shown.select(*_FEATURES, blocked.cast("double").alias("label")).repartition(8), "url-sample")
    vector = VectorAssembler(inputCols=_FEATURES, outputCol="features")
    boosted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=_SEED, featuresCol="features", labelCol="label")
    model.trees = boosted.fit(vector.transform(rows).select("features", "label"))
    return model


def with_rules(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, url, host, path, rule, verdict``; the last two null where no rule fits."""
    rows = pages.select(column(pages, id_col).alias("page_id"), column(pages, url_col).alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return rows.withColumn("chosen", first_rule(rules, F.col("host"), F.col("path"))).select(
        "page_id", "url", "host", "path", "chosen.rule", "chosen.verdict"
    )


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    The URLs that a rule decides are the labelled ones: the trees learn from
    them and decide the others. A null or malformed URL has an empty host and
    path, fits no rule and is judged by the trees on its features; repeated rows
    and null ids stay, other columns are ignored, an empty table gives no rows. A
    very long URL is looked at whole.
    """
    ruled = with_rules(pages, rules, id_col, url_col)
    model = train(ruled.filter(F.col("verdict").isNotNull()).drop("rule"))
    judged = model.verdict(ruled)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", "learned").alias("verdict"))
