"""SimHash near-duplicates against all pairs by brute force."""

import random

import pytest
import xxhash

from chatpulse.llm import simhash


def plain_fingerprint(text):
    """Bit by bit, straight from the definition."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=4):
    """doc -> smallest id reachable over links of at most ``bits`` bits."""
    label = {doc: doc for doc in prints}
    moved = True
    while moved:
        moved = False
        for a in prints:
            for b in prints:
                if label[b] < label[a] and (prints[a] ^ prints[b]).bit_count() <= bits:
                    label[a], moved = label[b], True
    return label


@pytest.mark.parametrize(
    "text",
    [None, "", " \t", "One", "a b c", "a b c d", "A B C D e f g A B C D", "é É x\x0by z ẞ q", "w " * 3000],
)
def test_fingerprint_follows_the_definition(text):
    assert simhash.simhash(text) == plain_fingerprint(text)


def near_family(rng, size):
    """Fingerprints around one centre, and some that stand alone."""
    centre = rng.getrandbits(64)
    family = set()
    while len(family) < size:
        value = centre
        for _ in range(rng.randint(0, 6)):
            value ^= 1 << rng.randrange(64)
        family.add(value)
    return [*family, *(rng.getrandbits(64) for _ in range(size))]


@pytest.mark.parametrize("dense_slot", [1, 3, 256])
@pytest.mark.parametrize("bits", [2, 4])
def test_links_give_the_components_of_all_pairs(spark, dense_slot, bits):
    values = near_family(random.Random(7), 60)
    signed = [v - (v >> 63 << 64) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.links(frame, bits, dense_slot)).collect()}
    expected = plain_components({v: v & (2**64 - 1) for v in signed}, bits)
    alone = {v for v in signed if sum(expected[w] == expected[v] for w in signed) == 1}
    assert set(roots) == set(signed) - alone
    assert all(roots[v] == expected[v] for v in roots)


def test_near_duplicates_of_documents(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(400)]
    rows = [(i, " ".join(base)) for i in range(3)]
    for i in range(3, 12):
        copy = list(base)
        copy[rng.randrange(400)] = "changed"
        rows.append((i, " ".join(copy)))
    rows += [(20 + i, " ".join(rng.choice(words) for _ in range(60))) for i in range(10)]
    rows += [(40, None), (41, ""), (42, "  "), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS fp", "2 AS component_id")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = {i: plain_fingerprint(t) for i, t in rows}
    expected = plain_components(prints)
    assert {r.doc_id: r.component_id for r in got} == expected
    assert {r.doc_id: r.fp & (2**64 - 1) for r in got} == prints
    assert expected[42] == 40


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (None, "quite another text")], empty.schema)
    got = sorted((r.component_id or -1, r.doc_id or -1) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, -1), (4, -1), (4, 4)]
