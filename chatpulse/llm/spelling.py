"""Spelling variants: words one edit apart, found by asymmetric q-chunks."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from chatpulse.llm.common import column, frozen, looked_up

#: Letters of a word.
LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: How often a form must stand for each time its variant does.
FORM_RATIO = 2
#: One run in so many, by the crc32 of its document and itself, loses a letter.
SLIP_EVERY = 97
#: Words with one chunk beyond which the rest of the word joins as well.
DENSE_CHUNK = 64


def _lowered(run: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    ascii_only = F.octet_length(run) == F.length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(
        F.translate(run, string.ascii_uppercase, string.ascii_lowercase)
    )


def _without(text: Column, place: Column, size: Column | int = 1) -> Column:
    """The text less ``size`` code points from ``place`` on (from 0)."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.concat(F.substring(text, F.lit(1), place), F.substr(text, place + size + 1))


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    slip_every: int = SLIP_EVERY,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word, n`` of every word of the texts, long and frequent enough.

    A run of letters in one document in ``slip_every`` loses a letter: those whose
    crc32 of ``<id>:<run>`` the number divides. A null text has no words, a null id
    counts as empty text, repeated rows count each. A very long text is a row with
    many runs. Counts are summed in the tasks before any word moves.
    """
    doc_id = F.coalesce(column(docs, id_col).cast("string"), F.lit(""))
    # Lower-casing keeps the number of letters, so the runs may be told apart first.
    runs = docs.select(
        doc_id.alias("doc_id"),
        F.explode(F.regexp_extract_all(column(docs, text_col), F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    runs = runs.filter(F.length("run") >= least_length).select("doc_id", _lowered(F.col("run")).alias("run"))
    crc = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    slip = crc % F.lit(slip_every) == 0
    place = (crc % F.length("run")).cast("int")
    word = F.when(slip, _without(F.col("run"), place)).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _key(size: Column, place: Column, gram: Column) -> Column:
    return F.concat_ws(":", size, place, gram)


def _chunks(words: DataFrame) -> DataFrame:
    """Two rows a word: its two disjoint halves, keyed by its length and their place."""
    size = F.length("word")
    q = F.floor(size / 2).cast("int")
    places = F.array(F.lit(0), q)
    chunks = words.select("word", "n", size.alias("size"), q.alias("q"), F.explode(places).alias("place"))
    gram = F.substring("word", F.col("place") + 1, F.col("q"))
    rest = _without(F.col("word"), F.col("place"), F.col("q"))
    return chunks.select("word", "n", _key(F.col("size"), F.col("place"), gram).alias("key"), rest.alias("rest"), "size")


def _grams(words: DataFrame) -> DataFrame:
    """The word's positional grams that a chunk of a word as long, or longer by one, can meet.

    Those stand within shift one of the chunk's place: where the other word is as
    long, nothing before the chunk moved; where it is longer by one, what it has
    more stands behind the chunk or before it.
    """
    size, half, longer = F.length("word"), F.expr("length(word) div 2"), F.expr("(length(word) + 1) div 2")

    def met(size: Column, q: Column, place: Column, shift: int) -> Column:
        return F.struct(size.alias("size"), q.alias("q"), place.alias("place"), (place + shift).alias("at"))

    zero = F.lit(0).cast("bigint")
    wanted = [met(size, half, p, 0) for p in (zero, half)]
    wanted += [met(size + 1, longer, p, shift) for p in (zero, longer) for shift in (0, -1)]
    grams = words.select("word", "n", size.alias("own"), F.explode(F.array(*wanted)).alias("g")).select("word", "n", "own", "g.*")
    grams = grams.filter((F.col("at") >= 0) & (F.col("at") + F.col("q") <= F.col("own")))
    at, q = F.col("at").cast("int"), F.col("q").cast("int")
    gram = F.substring("word", at + 1, q)
    return grams.select(
        "word", "n", _key(F.col("size"), F.col("place"), gram).alias("key"),
        _without(F.col("word"), at, q).alias("rest"), (F.col("size") > F.col("own")).alias("is_shorter"),
    )


def _less_one(rest: Column) -> Column:
    """``place:text`` for every letter that may be missing of the rest."""
    return F.transform(
        F.sequence(F.lit(0), F.length(rest) - 1), lambda i: F.concat_ws(":", i, _without(rest, i))
    )


def near_words(words: DataFrame, dense_chunk: int = DENSE_CHUNK) -> DataFrame:
    """``a, a_n, b, b_n``: every two different words one edit apart, once.

    Words ``word, n`` have at least two letters each and stand once. One edit
    leaves one of two disjoint chunks whole, and moves it by one place at most. The
    longer word gives the chunks, the other its positional grams; of words as
    long, the smaller in code-point order gives them. A gram meets at most
    ``dense_chunk`` words; where more have a chunk, what the word has beside it joins
    too, with a letter less, so that a group costs a row for each letter and not
    its square. Every pair is then checked.
    """
    chunks, grams = _chunks(words), _grams(words)
    crowded = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).filter(F.col("crowd") > dense_chunk)
    crowded = frozen(crowded, "spelling-crowded")
    is_crowded, plain = F.col("crowd").isNotNull(), F.array(F.lit(""))
    with_rest = F.transform(_less_one(F.col("rest")), lambda v: F.concat(F.lit("="), v))
    shortened = F.transform(_less_one(F.col("rest")), lambda v: F.concat(F.lit("<"), F.substring_index(v, ":", -1)))
    left = looked_up(chunks, crowded, "key").select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), "key",
        F.explode(F.when(is_crowded, F.array_distinct(F.concat(with_rest, shortened))).otherwise(plain)).alias("more"),
    )
    own = F.when(F.col("is_shorter"), F.array(F.concat(F.lit("<"), F.col("rest")))).otherwise(with_rest)
    right = looked_up(grams, crowded, "key").select(
        F.col("word").alias("b"), F.col("n").alias("b_n"), "key", "is_shorter",
        F.explode(F.when(is_crowded, own).otherwise(plain)).alias("more"),
    )
    met = left.join(right, ["key", "more"]).filter(F.col("is_shorter") | (F.col("a") < F.col("b")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").dropDuplicates(["a", "b"])


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form, by doubling steps.

    A form stands at least twice as often as its word, so chains end, and are as
    long as the logarithm of the largest count at most.
    """
    jumps = frozen(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = jumps.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        moved = frozen(moved, "spelling-roots")
        if moved.filter("further IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        jumps = moved.drop("further")


def variants(words: DataFrame, ratio: int = FORM_RATIO, dense_chunk: int = DENSE_CHUNK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of the words ``word, n``.

    The form is the near word with the largest count, the first in code-point order
    among equals, if that is ``ratio`` times the word's at least (``ratio`` above 1);
    the root is where following forms ends, the word itself without one. No words
    give no rows.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    near = near_words(words, dense_chunk)
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")).union(
        near.select("b", "a", "a_n")
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    )
    found = words.join(best, "word", "left")
    form_n = -F.col("best.m")
    is_form = form_n >= ratio * F.col("n")
    found = frozen(
        found.select(
            "word",
            F.when(is_form, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(is_form, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of the texts; other columns of the table are ignored."""
    return variants(frozen(word_counts(docs, id_col, text_col), "spelling-words"))
