"""Cross-parsing by suffix automata against string search; whole tables."""

import random
import zlib

import numpy as np
import pytest

from chatpulse.llm import common, language_id
from chatpulse.llm.language_id import _FIRST_LETTER


def test_automaton_knows_exactly_the_substrings():
    text = "abaababbaab"
    moves = language_id.suffix_automaton([ord(c) for c in text])
    known = {text[i:j] for i in range(len(text)) for j in range(i, len(text) + 1)}
    for size in range(5):
        for number in range(2**size):
            word = "".join("ab"[number >> i & 1] for i in range(size))
            state = 0
            for c in word:
                state = moves[state].get(ord(c)) if state is not None else None
            assert (state is not None) == (word in known)
    assert len(moves) <= 2 * len(text)


def phrases(text, reference):
    """Phrases by string search, block by block, as letters and single blanks."""
    count = 0
    for at in range(0, len(text), language_id.BLOCK):
        block, phrase = text[at : at + language_id.BLOCK], ""
        for c in block:
            if phrase + c in reference:
                phrase += c
            else:
                count += 1
                phrase = c if c in reference else ""
        count += 1
    return count


def test_phrase_counts_are_those_of_string_search():
    rng = random.Random(2)
    samples = {lang: ["".join(rng.choice(letters) for _ in range(400))] for lang, letters in (("x", "abc dx"), ("y", "xyz da"))}
    model = language_id.train(samples)
    text = "".join(rng.choice("abcxyzd q") for _ in range(3000))
    blocks = model.normalised(text)
    joined = "".join(" " if c == 0 else "?" if c < _FIRST_LETTER else "L" for b in blocks for c in b)
    assert len(joined) == sum(map(len, blocks))
    spelled = " ".join(text.split())
    spelled = (" " if text[0] == " " else "") + spelled + (" " if text[-1] == " " else "")
    for row, lang in zip(model.phrases(blocks).sum(axis=1), model.languages):
        reference = " ".join(samples[lang][0].split())
        assert row == phrases(spelled, reference)


def test_long_texts_are_read_to_the_end():
    model = language_id.train({"x": ["abc abd bcd " * 30], "y": ["xyz yzx zxy " * 30]})
    text = "abc " * 100 + "xyz yzx " * 200_000
    assert model.predict([text])[0][0] == "y"


@pytest.mark.parametrize("text", [None, "", " \n", "123 !?"])
def test_texts_without_letters_are_undetermined(text):
    model = language_id.train({"x": ["abc"], "y": ["xyz"]})
    assert model.predict([text, "abc"]) == [("und", 0.0), ("x", pytest.approx(model.predict(["abc"])[0][1]))]


def test_other_scripts_tie_and_no_labels_give_und():
    model = language_id.train({"x": ["abc " * 9], "y": ["xyz " * 9]})
    lang, score = model.predict(["日本語"])[0]
    assert lang == "x" and score == 0.0
    assert language_id.train({}).predict(["abc"]) == [("und", 0.0)]
    assert language_id.train({"only": ["abc"]}).predict(["abc"]) == [("only", 1.0)]


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(n))


#: Thirty letters each of several alphabets, which alone are more than one symbol can tell apart.
ALPHABETS = {"la": 0x61, "el": 0x3B1, "ru": 0x430, "hy": 0x561, "ar": 0x628, "ka": 0x10D0, "am": 0x1200}
HAN, KANA, HANGUL = ([chr(p + i) for i in range(n)] for p, n in ((0x4E00, 900), (0x3042, 80), (0xAC00, 2400)))


def test_large_alphabets_beside_several_small_ones():
    rng = random.Random(11)
    letters = {lang: [c for i in range(40) if (c := chr(p + i)).isalpha()][:24] for lang, p in ALPHABETS.items()}
    # Japanese and the two kinds of Chinese have letters in common.
    letters |= {"zh": HAN[:600], "yue": HAN[300:], "ja": HAN[:300] + KANA * 4, "ko": HANGUL}
    model = language_id.train({lang: [words(rng, own, 60) for _ in range(40)] for lang, own in letters.items()})
    held_out = [(lang, words(rng, own, 40)) for lang, own in letters.items() for _ in range(20)]
    got = [lang for lang, _ in model.predict([text for _, text in held_out])]
    for lang in letters:
        assert sum(g == lang for (own, _), g in zip(held_out, got) if own == lang) >= 19, lang


@pytest.mark.parametrize("letters", [0, 1, 64, 65, 3000, 140_000])
def test_every_letter_is_spelled_in_its_own_way(letters):
    rows = [tuple(c for c in row if c != language_id._NONE) for row in language_id.spellings(letters).tolist()]
    assert len(set(rows)) == len(rows) == _FIRST_LETTER + letters
    assert all(c >= language_id._FIRST_LEAD for row in rows for c in row[:-1])
    assert all(row[-1] < language_id._FIRST_LEAD and max(row) < language_id._WIDTH for row in rows)


def test_unknown_letters_match_no_rare_one():
    rare = "".join(HAN[:500])
    model = language_id.train({"a": [rare], "b": ["abc " * 100]})
    (known,), (unknown,) = model.normalised(HAN[400] * 9), model.normalised(HAN[700] * 9)
    assert not set(known.tolist()) & set(unknown.tolist())


def test_identify_a_table(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, "abcdef" if i % 2 else "uvwxyz", 40), "low" if i % 2 else "high", "s") for i in range(120)]
    rows += [(200, None, "low", None), (201, "", None, None), (None, rows[1][1], "low", "s"), (1, rows[1][1], "low", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (200, 201):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == ("low" if r.doc_id is None or r.doc_id % 2 else "high") and 0 < r.score <= 1
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(key.encode()) % 3 == 1)
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2
    assert language_id.identify(docs.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast_bytes", [10_000_000, 0])
def test_every_language_is_drawn_from(spark, monkeypatch, broadcast_bytes):
    """More labels than any bound on groups, and two that have most rows; null texts take no place."""
    monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast_bytes)
    rows = [(i, f"text {i}", f"l{i % 1500:04}") for i in range(3000)]
    rows += [(3000 + i, f"common {i}", "big" if i % 2 else "huge") for i in range(20_000)]
    rows += [(23_000 + i, None if i else "sparse text", "sparse") for i in range(6000)]
    rows += [(40_000 + i, "", "void") for i in range(9)] + [(50_000, "no label", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = language_id.labelled_sample(docs)
    assert set(got) == {f"l{i:04}" for i in range(1500)} | {"big", "huge", "sparse"}
    assert got["sparse"] == ["sparse text"]
    openings = common.drawn(docs.filter("text <> ''"), "lang", ["doc_id", "text"], language_id.SAMPLE_TEXTS)
    assert {r.lang: r["count"] for r in openings.groupBy("lang").count().collect()}.items() >= {"big": 400, "huge": 400, "l0000": 2}.items()
    share = language_id.chars_each(len(got))
    assert all(sum(map(len, got[lang])) + len(got[lang]) >= share for lang in ("big", "huge"))
    assert sum(len(t) for texts in got.values() for t in texts) < 2 * language_id.SAMPLE_CHARS_ALL


def test_texts_with_letters_are_kept_without_any_label(spark):
    texts = ["clean text", "日本", None, "", " 12 !?", "é", "x" * 3000]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    assert sorted(r.doc_id for r in language_id.keep_identified(docs).collect()) == [0, 1, 5, 6]


def test_held_out_labels_are_not_read(spark):
    """Labels of held-out rows can say anything without a change."""
    rng = random.Random(6)
    rows = [(i, words(rng, "abcdef" if i % 2 else "uvwxyz", 30), "low" if i % 2 else "high") for i in range(60)]
    lied = [(i, t, "lie" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    schema = "doc_id bigint, text string, lang string"
    first, second = (
        {tuple(r) for r in language_id.identify(spark.createDataFrame(data, schema)).collect()} for data in (rows, lied)
    )
    assert first == second


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = language_id.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert np.mean(got.lang == got.lang_pred) > 0.97
