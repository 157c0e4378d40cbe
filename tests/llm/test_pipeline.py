"""The pipeline against brute force, stage by stage; the registered queries."""

import inspect
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from test_decontaminate import plain as plain_hits
from test_secret_scan import plain as plain_spans
from test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's result over odd rows and the smallest documents."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = [
        (-1, None, "en", None, None), (-2, "", None, "s", 0), (-3, "123 !", "en", "s", 5), (None, "No id but a text of some words.", None, None, 31),
        (-4, "token: abcdefgh12345 and so on", "en", "s", 30), (-4, "token: abcdefgh12345 and so on", "en", "s", 30), (-4, "another text, same id", "en", "s", 21),
    ]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    made = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.frozen(stage(spark, docs, FOLDER), "test")
        made.append((name, docs))
    return [(name, d.columns, d.collect()) for name, d in made]


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_all_but_the_last_keep_the_columns(stages):
    for _, columns, _ in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_stage_drops_what_has_no_letter_and_fills_in_the_language(stages):
    before, after = stages[0][2], stages[1][2]
    told = sorted(map(repr, (r for r in before if r.text and any(c.isalpha() for c in r.text) and r.lang)))
    assert sorted(repr(r) for r in after if r.doc_id is not None) == told
    unknown = [r for r in after if r.doc_id is None]
    assert [(r.text, r.source) for r in unknown] == [("No id but a text of some words.", None)]
    assert unknown[0].lang in {r.lang for r in before if r.lang}


def test_large_groups_of_copies(spark, tmp_path):
    """Thousands of exact copies, near copies and rows without a letter: one of each group stays, clean rows stay."""
    rng = random.Random(9)
    words = [f"{a}{b}{c}" for a in ("lo", "mi", "ne", "sta") for b in ("ra", "to", "ki", "vel") for c in ("n", "sh", "rd", "p")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, near = text(300), text(400).split()
    rows = [(i, base, None, "hot", 0) for i in range(3000)]
    for i in range(3000, 3400):
        changed = list(near)
        changed[rng.randrange(400)] = "changed"
        rows.append((i, " ".join(changed), "en", "hot", 0))
    rows += [(i, "12 34", "en", "s", 5) for i in range(4000, 4500)] + [(i, text(80), "en", "s", 0) for i in range(5000, 5060)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.frozen(stage(spark, docs, str(tmp_path)), "test")
        kept[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert kept["language ID"] == [i for i, *_ in rows if not 4000 <= i < 4500]
    prints = {}
    for i, t, *_ in rows:
        if not 4000 <= i < 4500:
            prints.setdefault(plain_fingerprint(t), i)
    roots = plain_components({i: p for p, i in prints.items()})
    assert kept["SimHash near-dedup"] == sorted(set(roots.values()))
    assert 0 in kept["secret scans"] and sum(i >= 5000 for i in kept["secret scans"]) == 60
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted({r.doc_id for r in packed.select("doc_id").collect()}) == kept["secret scans"]


def test_near_copies_leave_one(stages):
    before, after = stages[1][2], stages[2][2]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text)
    prints = {k: plain_fingerprint(k[2]) for k in map(key, before)}
    assert sorted(map(key, after)) == sorted(set(plain_components(prints).values()))


def test_contaminated_documents_go(spark, stages):
    before, after = stages[2][2], stages[3][2]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {hit[0] for hit in plain_hits(pairs(before), items)}
    assert bad
    assert sorted(map(repr, after)) == sorted(repr(r) for r in before if r.doc_id not in bad)


def test_secrets_are_gone(stages):
    before, after = stages[3][2], stages[4][2]
    assert len(before) == len(after)
    # An id may stand on two rows, which are told apart by their first letters.
    texts = {(r.doc_id, r.text[:2]): r for r in after}
    for row in before:
        now, spans = texts.get((row.doc_id, row.text[:2])), plain_spans(row.text)
        if not spans:
            assert now == row
        elif now:
            assert plain_spans(now.text) == [] and now.n_chars == len(now.text)
    assert not any(plain_spans(r.text) for r in after)


def test_everything_is_packed(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = sorted(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in stages[4][2])
    assert sum(sizes) == sum(r.length for r in stages[5][2])
    by_sequence = {}
    for r in stages[5][2]:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 2048


def test_stages_over_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.frozen(stage(spark, docs, FOLDER), "test")
        assert docs.count() == 0
    assert "sequence_id" in docs.columns


def test_run_is_all_stages(spark, stages):
    docs = [r for name, _, rows in stages if name == "documents" for r in rows if (r.doc_id or -1) >= 0]
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == stages[-1][1] and 0 < got.count() <= 3 * len(docs)


def test_registered():
    queries = contract.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in queries) == 1
    assert "pipeline" in queries
    assert [len(inspect.signature(f).parameters) for _, f in corpus_pipeline.STAGES] == [3] * 5


@pytest.mark.parametrize("name", [n for n in contract.LLM_QUERIES if n not in contract.LLM_ORACLE])
def test_queries_run_and_repeat(spark, name):
    first, second = (sorted(map(repr, contract.queries()[name](spark, FOLDER).collect())) for _ in range(2))
    assert first and first == second
