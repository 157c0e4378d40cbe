"""The labelled sample: bounded, from every group, the same however often rows repeat."""

import pytest
from pyspark.sql import functions as F

from chatpulse.llm import common, language_id, toxicity, url_filter


def sample(rows, limit=5):
    return sorted(map(tuple, common.drawn(rows, "kind", ["id", "text"], limit).collect()), key=repr)


def repeated(rows, times):
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy")


@pytest.mark.parametrize("seed", range(3))
def test_a_table_of_copies_gives_the_sample_of_the_table(spark, seed):
    data = [("a", seed * 1000 + i, f"text {i}") for i in range(300)] + [("b", i, "same text") for i in range(3)]
    data += [("c", 1, "one row"), ("d", None, None), (None, 1, "no group")]
    rows = spark.createDataFrame(data, "kind string, id bigint, text string")
    once = sample(rows)
    assert {k: sum(r[0] == k for r in once) for k in "abcd"} == {"a": 5, "b": 3, "c": 1, "d": 1}
    assert len(once) == 10
    assert sample(repeated(rows, 50)) == once


def test_one_row_repeated_very_often_neither_fills_the_sample_nor_falls_out_of_it(spark):
    many = spark.range(100_000).select(F.lit("a").alias("kind"), F.lit(7).cast("bigint").alias("id"), F.lit("copy").alias("text"))
    for seed in range(5):
        few = spark.createDataFrame([("a", seed * 100 + i, f"t{i}") for i in range(100)], "kind string, id bigint, text string")
        some = common.drawn(many.union(few), "kind", ["id", "text"], 101).collect()
        assert len(some) == 101 and ("a", 7, "copy") in map(tuple, some)
    alone = common.drawn(many, "kind", ["id", "text"], 10).collect()
    assert [tuple(r) for r in alone] == [("a", 7, "copy")]


def test_a_language_of_one_repeated_text_is_learned(spark):
    for doc_id in range(2, 10):
        copies = spark.range(40_000).select(F.lit(doc_id).alias("doc_id"), F.lit("wort satz sprache").alias("text"), F.lit("de").alias("lang"))
        more = spark.createDataFrame([(100 + i, f"the words of number {i}", "en") for i in range(100)], copies.schema)
        docs = copies.union(more)
        learned = language_id.labelled_sample(docs)
        assert learned["de"] == ["wort satz sprache"] and len(learned["en"]) == 100


def test_passages_of_the_whole_text_are_learned_from(spark):
    text = "".join(f"word{i:05d} " for i in range(20_000))
    docs = spark.createDataFrame([(1, text, "en"), (2, "kurz", "de")], "doc_id bigint, text string, lang string")
    passages = language_id.labelled_sample(docs)["en"]
    places = sorted(text.index(p) for p in passages)
    assert sum(map(len, passages)) <= language_id.chars_each(2) + language_id.PASSAGE_CHARS
    assert places[0] < 0.1 * len(text) and places[-1] > 0.9 * len(text) and len(places) > 70


def test_one_id_on_very_many_rows_is_one_row_of_the_toxic_sample(spark, monkeypatch):
    sizes = []

    def spied(rows, purpose):
        made = common.frozen(rows, purpose)
        if purpose == "toxic-sample":
            sizes.append(made.count())
        return made

    monkeypatch.setattr(toxicity, "frozen", spied)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, toxic int")
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    copies = spark.range(50_000).select(F.lit(8).cast("bigint").alias("doc_id"), F.concat(F.lit("other "), F.col("id") % 9).alias("text"))
    toxicity.train(docs.union(copies), labels, sample_rows=100)
    assert sizes == [200]


def test_urls_of_one_verdict_that_are_all_copies_are_learned_from(spark):
    bad = spark.range(60_000).select(F.lit(1).alias("page_id"), F.lit("http://bad.example/de/1").alias("url"))
    good = spark.range(300).select((F.col("id") + 10).cast("int").alias("page_id"), F.concat(F.lit("http://good.org/"), "id").alias("url"))
    rules = (url_filter.Rule(url_filter.BLOCK, "example/de/"), url_filter.Rule(url_filter.ALLOW, "org/"))
    more = spark.createDataFrame([(5, "http://bad.example/xx")], "page_id int, url string")
    got = url_filter.judge(bad.union(good).union(more), rules)
    assert {r.verdict: r["count"] for r in got.groupBy("verdict").count().collect()}.keys() <= {"allow", "block"}
    assert got.count() == 60_301
