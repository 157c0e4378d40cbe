"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from chatpulse.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top=20):
    """``item_id, rank, doc_id, score``; a document is a place in the list."""
    counts = [Counter(terms(text)) for _, text in docs]
    n, total = sum(map(bool, counts)), sum(c.total() for c in counts)
    df = Counter(term for c in counts for term in c)
    ranked = []
    for item_id, text in dict.fromkeys(items):
        scores = []
        for (doc_id, _), own in zip(docs, counts):
            score = 0
            for term, times in Counter(terms(text)).items():
                if own[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    m = 75 + (25 * own.total() * n) // total
                    score += times * w * ((10**9 * own[term]) // (1000 * own[term] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        ranked += [(item_id, i + 1, doc_id, -s) for i, (s, _, _, doc_id) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(ranked, key=repr)


def shown(result):
    return sorted((tuple(r) for r in result.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(rng, size, vocabulary=60):
    """Texts of Zipf-like words with some copies and passages that items repeat."""
    words = [f"w{i}" for i in range(vocabulary)] + ["Ärger", "größe", "日本", "É"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 80)))) for i in range(size)]
    docs += [(size + i, docs[3][1]) for i in range(60)]
    return docs


@pytest.mark.parametrize("owners, block_documents, bundle_items", [(1, 4096, 128), (3, 7, 2), (6, 64, 128), (9, 1000, 3)])
def test_equals_scoring_everything(spark, owners, block_documents, bundle_items):
    rng = random.Random(owners)
    docs = corpus(rng, 300)
    items = [(i, " ".join(rng.choice(docs)[1].split()[: rng.randint(1, 12)])) for i in range(12)]
    items += [(90, docs[3][1]), (91, "nowhere to befound"), (92, "w0 w0 W0 W1,w0"), (93, None), (94, ""), (95, " ,. ")]
    got = ranked_search.search(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
        owners=owners, block_documents=block_documents, bundle_items=bundle_items,
    )
    assert shown(got) == plain_search(docs, items)


def test_letting_go_of_documents_changes_nothing(spark):
    """Long items over rare and common terms: sums are dropped on the way, results stay."""
    rng = random.Random(8)
    docs = corpus(rng, 1500, vocabulary=400)
    items = [(i, docs[rng.randrange(1500)][1]) for i in range(20)]
    frames = (spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = ranked_search.search(*frames, top=3)
    assert shown(got) == plain_search(docs, items, top=3)


def test_rows_of_every_kind(spark):
    docs = [(1, "alpha beta"), (1, "alpha beta"), (1, "alpha"), (None, "alpha beta"), (None, None), (5, None), (6, ""), (7, "x\x00y `z{")]
    docs += [(8, "beta " * 200_000 + "alpha"), (-9, "Alpha beta")]
    items = [(1, "alpha beta"), (1, "alpha beta"), (2, "y Z"), (None, "beta"), (3, "alpha BETA")]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((docs, "doc_id bigint, text string"), (items, "item_id bigint, text string"))]
    clashing = ("item bigint", "term string", "owner int", "size bigint", "doc bigint", "block int")
    wide = [f.selectExpr("*", *(f"CAST(1 AS {c.split()[1]}) AS {c.split()[0]}" for c in clashing)) for f in frames]
    got = shown(ranked_search.search(*wide))
    assert got == plain_search(docs, items)
    assert [r[2] for r in got if r[0] == 3] == [-9]


def test_two_texts_under_one_item(spark):
    docs, items = [(1, "alpha"), (2, "beta alpha"), (3, "gamma")], [(1, "alpha"), (1, "beta")]
    got = ranked_search.search(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert shown(got) == plain_search(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_empty_tables(spark, docs, items):
    got = ranked_search.search(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert got.collect() == []
