"""Language identification by cross-parsing entropy over suffix automata."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from chatpulse.llm.common import column, drawn, frozen, id_crc

UNDETERMINED = "und"
#: Bounds of the labelled sample: texts a language, and characters of a language
#: and of all together, which bound the automata. Every language gets an equal
#: share of these, and ``LEAST_CHARS`` however many there are. Sampled texts are
#: divided into passages of so many characters, any of which may be learned from.
SAMPLE_TEXTS = 400
PASSAGE_CHARS = 512
SAMPLE_CHARS = 40_000
SAMPLE_CHARS_ALL = 400_000
LEAST_CHARS = 64
#: Letters of the labelled sample are told apart, all of them: the commonest are
#: one symbol, the next ``LEADS`` times as many two, and so on. A symbol either
#: ends a letter or leads to its next symbol, so no letter begins another.
LETTERS = 64
LEADS = 32
#: Normalised characters parsed in one go; a phrase ends at the border.
BLOCK = 1024
#: Raw characters normalised in one go.
PIECE = 1 << 20
#: Documents parsed side by side.
LANES = 512

_SPACE, _OTHER, _PAD = 0, 1, 2
_FIRST_LETTER = 3
_FIRST_LEAD = _FIRST_LETTER + LETTERS
_WIDTH = _FIRST_LEAD + LEADS
#: Symbols of the longest letter, enough for every code point.
_LONGEST = 4
_NONE = 255
#: Places at which a row is tried before the ones passed are left alone.
_TRIES = 64


def spellings(letters: int) -> np.ndarray:
    """The symbols of the space, the unknown letter, the padding and so many letters, a row each."""
    spelled = np.full((_FIRST_LETTER + letters, _LONGEST), _NONE, np.uint8)
    spelled[:_FIRST_LETTER, 0] = range(_FIRST_LETTER)
    first, size = 0, LETTERS
    for symbols in range(1, _LONGEST + 1):
        rest = np.arange(min(size, letters - first))
        rows = spelled[_FIRST_LETTER + first :][: len(rest)]
        rows[:, symbols - 1] = _FIRST_LETTER + rest % LETTERS
        rest = rest // LETTERS
        for at in range(symbols - 1):
            rows[:, at] = _FIRST_LEAD + rest % LEADS
            rest = rest // LEADS
        first, size = first + len(rows), size * LEADS
    return spelled


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 starts."""
    moves: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for code in codes:
        state, at = len(moves), last
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        while at != -1 and code not in moves[at]:
            moves[at][code] = state
            at = link[at]
        if at != -1:
            target = moves[at][code]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                twin = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at != -1 and moves[at].get(code) == target:
                    moves[at][code] = twin
                    at = link[at]
                link[target] = link[state] = twin
        last = state
    return moves


class Rows:
    """Sparse rows of many automata, laid over one another.

    ``target[base[state] + code]`` is the next state where ``owner`` of that place is
    the state; a row's places are shared with others where neither needs them.
    """

    def __init__(self) -> None:
        self.used = bytearray()
        self.base: list[np.ndarray] = []
        self.owner = np.full(0, -1, np.int32)
        self.target = np.zeros(0, np.int32)
        self.states = 0
        #: The first place that may be free.
        self.free = 0

    def _grown(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.used.extend(bytes(more))
            self.owner = np.append(self.owner, np.full(more, -1, np.int32))
            self.target = np.append(self.target, np.zeros(more, np.int32))

    def add(self, moves: list[dict[int, int]]) -> int:
        """Lays an automaton's rows; the number of its first state."""
        first, base = self.states, np.zeros(len(moves), np.int32)
        self.states += len(moves)
        lone = []
        for state in sorted(range(len(moves)), key=lambda s: -len(moves[s])):
            steps = moves[state]
            if len(steps) < 2:
                lone += [(state, code, target) for code, target in steps.items()]
                continue
            codes = sorted(steps)
            at, tries = self.free, 0
            while True:
                self._grown(at + 1)
                # The last place is never used, so one is found.
                at = self.used.find(0, at)
                self._grown(at + 2 * _WIDTH)
                place = at - codes[0]
                if place >= 0 and not any(self.used[place + c] for c in codes[1:]):
                    break
                # Crowded: what is free there is left to rows of one step.
                tries, at = tries + 1, at + 1
                if tries == _TRIES:
                    self.free = max(self.free, at - _TRIES // 2)
            base[state] = place
            for code in codes:
                self.used[place + code] = 1
                self.owner[place + code] = first + state
                self.target[place + code] = first + steps[code]
        if lone:
            states, codes, targets = np.array(lone, np.int64).T
            taken = np.frombuffer(bytes(self.used), np.uint8)
            places = np.flatnonzero(taken[_WIDTH:] == 0)[: len(lone)] + _WIDTH
            if len(places) < len(lone):
                begin = max(_WIDTH, len(taken))
                places = np.append(places, np.arange(begin, begin + len(lone) - len(places)))
                self._grown(int(places[-1]) + 1)
            np.frombuffer(self.used, np.uint8)[places] = 1
            base[states] = places - codes
            self.owner[places], self.target[places] = first + states, first + targets
        self.base.append(base)
        return first

    def laid(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``base, owner, target``, the last two a row wider than their last place."""
        end = self.used.rfind(1) + 1 + _WIDTH
        self._grown(end)
        base = np.concatenate(self.base) if self.base else np.zeros(0, np.int32)
        return base, self.owner[:end].copy(), self.target[:end].copy()


@dataclass
class LanguageModel:
    """Automata of all languages, their rows laid over one another (``Rows``).

    ``afresh[language, code]`` is the state after a character that begins a phrase.
    """

    languages: list[str]
    alphabet: np.ndarray
    spelled: np.ndarray
    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    starts: np.ndarray
    afresh: np.ndarray
    phrase_bits: np.ndarray

    @property
    def nbytes(self) -> int:
        """Bytes of the tables, which every worker has."""
        return sum(value.nbytes for value in vars(self).values() if isinstance(value, np.ndarray))

    def normalised(self, text: str) -> list[np.ndarray]:
        """Symbols of lower-case letters, each run of anything else one space, in blocks of ``BLOCK`` letters."""
        blocks = []
        for at in range(0, len(text), PIECE):
            points = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = self.alphabet[points]
            keep = np.ones(len(codes), bool)
            keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
            codes = codes[keep]
            if len(codes) and codes.max() != _SPACE:
                blocks += [self.symbols(codes[i : i + BLOCK]) for i in range(0, len(codes), BLOCK)]
        return blocks

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The codes' symbols, one after another."""
        if codes.max() < _FIRST_LEAD:
            return codes.astype(np.uint8)
        rows = self.spelled[codes]
        return rows[rows != _NONE]

    def phrases(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Phrases of each block (column) in each language (row), parsed side by side."""
        # The longest first: those that go on are always the first lanes.
        order = sorted(range(len(blocks)), key=lambda lane: -len(blocks[lane]))
        sizes = np.array([len(blocks[lane]) for lane in order])
        deep = int(sizes[0])
        codes = np.full((deep, len(blocks)), _PAD, np.int64)
        for lane, block in enumerate(order):
            codes[: len(blocks[block]), lane] = blocks[block]
        going = np.searchsorted(-sizes, -np.arange(deep), side="left")
        states = np.repeat(self.starts[:, None], len(blocks), axis=1)
        ended = np.ones_like(states)
        for row, lanes in zip(codes, going.tolist()):
            at, code = states[:, :lanes], row[:lanes]
            place = self.base[at] + code
            ends = self.owner[place] != at
            ended[:, :lanes] += ends
            states[:, :lanes] = np.where(ends, self.afresh[:, code], self.target[place])
        back = np.empty_like(ended)
        back[:, order] = ended
        return back

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language that needs the fewest phrase bits, and by what part fewer than the next."""
        blocks, owners = [], []
        for at, text in enumerate(texts):
            own = self.normalised(text or "") if self.languages else []
            blocks += own
            owners += [at] * len(own)
        totals = np.zeros((len(self.languages), len(texts)), np.int64)
        for at in range(0, len(blocks), LANES):
            some = blocks[at : at + LANES]
            for lang, row in enumerate(self.phrases(some)):
                np.add.at(totals[lang], owners[at : at + LANES], row)
        cost = totals * self.phrase_bits[:, None]
        found = []
        for at in range(len(texts)):
            costs = cost[:, at] if self.languages else np.zeros(0)
            if not costs.any():
                found.append((UNDETERMINED, 0.0))
                continue
            best = int(costs.argmin())
            second = np.delete(costs, best)
            score = 1.0 - costs[best] / second.min() if len(second) else 1.0
            found.append((self.languages[best], float(min(1.0, max(0.0, score)))))
        return found


def chars_each(languages: int) -> int:
    """Characters of each language's sample."""
    return max(LEAST_CHARS, min(SAMPLE_CHARS, SAMPLE_CHARS_ALL // max(1, languages)))


def train(samples: dict[str, list[str]]) -> LanguageModel:
    """Automata of each language's sample texts, which are cut to the bounds above."""
    share = chars_each(len(samples))
    joined = {lang: " ".join(dict.fromkeys(texts)).lower()[:share] for lang, texts in sorted(samples.items())}
    seen = Counter(c for text in joined.values() for c in text if c.isalpha())
    letters = sorted(sorted(seen), key=lambda c: -seen[c])
    alphabet = np.array([_OTHER if chr(p).isalpha() else _SPACE for p in range(0x110000)], np.int32)
    alphabet[[ord(c) for c in letters]] = range(_FIRST_LETTER, _FIRST_LETTER + len(letters))
    spelled = spellings(len(letters))
    none = np.zeros(0, np.int32)
    model = LanguageModel([], alphabet, spelled, none, none, none, none, np.zeros((0, _WIDTH), np.int32), np.zeros(0))
    rows, starts, afresh, bits = Rows(), [], [], []
    for lang, text in joined.items():
        codes = [int(c) for block in model.normalised(text) for c in block]
        if not codes:
            continue
        moves = suffix_automaton(codes)
        first = rows.add(moves)
        model.languages.append(lang)
        starts.append(first)
        # A character that the language never had begins a phrase that nothing prolongs.
        afresh.append([first + moves[0].get(code, 0) for code in range(_WIDTH)])
        bits.append(math.log2(len(codes) + 1))
    model.base, model.owner, model.target = rows.laid()
    model.starts, model.phrase_bits = np.array(starts, np.int32), np.array(bits)
    if afresh:
        model.afresh = np.array(afresh, np.int32)
    return model


def labelled_sample(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, list[str]]:
    """Passages of up to ``SAMPLE_TEXTS`` texts of each language, chosen by a hash.

    Every language with a text is there, and null and empty texts take no place. Texts
    are sampled whole; of all their passages, wherever in a text, come as many as
    fill the language's share of the characters.
    """
    rows = docs.select(
        column(docs, lang_col).alias("lang"), column(docs, text_col).alias("text"), column(docs, id_col).alias("id")
    ).filter("text <> ''")
    texts = drawn(rows, "lang", ["id", "text"], SAMPLE_TEXTS)
    places = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PASSAGE_CHARS))
    cut = texts.select("lang", "text", F.explode(places).alias("place"))
    begin = (F.col("place") * PASSAGE_CHARS + 1).cast("int")
    cut = cut.select("lang", F.substring("text", begin, F.lit(PASSAGE_CHARS)).alias("text"))
    passages = frozen(cut.distinct().withColumn("place", F.xxhash64("lang", "text")), "language-passages")
    share = chars_each(passages.select("lang").distinct().count())
    # No passage beyond these many can be needed, so the window is bounded.
    some = drawn(passages, "lang", ["place"], max(SAMPLE_TEXTS, 2 * share // PASSAGE_CHARS))
    before = Window.partitionBy("lang").orderBy("place", "text").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum(F.length("text") + 1).over(before), F.lit(0))
    samples: dict[str, list[str]] = {}
    wanted = some.withColumn("filled", filled).filter(F.col("filled") < share)
    for row in wanted.orderBy("lang", "filled").select("lang", F.substring("text", 1, share).alias("text")).collect():
        samples.setdefault(row.lang, []).append(row.text)
    return samples


def language_of(
    docs: DataFrame,
    model: LanguageModel,
    text_col: str = "text",
    extra: tuple[str, ...] = (),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns ``extra`` with language and score of every row.

    The whole text is parsed. A text that is null or has no letter is ``und``
    with score 0, as is every text if no labelled language was seen; a text in
    letters the model never saw ties and gets the first language by name, score
    0. Repeated rows and other columns pass through; an empty table stays empty.
    """
    picked = docs.select(*(column(docs, c) for c in dict.fromkeys([*extra, text_col])))
    place = picked.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, LANES):
                rows = batch.slice(at, LANES)
                found = known.predict(rows.column(place).to_pylist())
                made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(extra)], *made], names=[*extra, *names])

    schema = StructType(picked.schema.fields[: len(extra)]).add(names[0], "string").add(names[1], "double")
    return picked.mapInArrow(run, schema)


def held_out_third(docs: DataFrame, id_col: str = "doc_id"):
    """True for the rows that no model may learn from: crc32 of the id leaves 1 by 3."""
    return F.pmod(id_crc(column(docs, id_col)), F.lit(3)) == 1


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """A model of the rows that are not held out."""
    return train(labelled_sample(docs.filter(~held_out_third(docs, id_col)), id_col, text_col, lang_col))


def identify(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Learns from the rows that are not held out and predicts all rows."""
    marked = docs.withColumn("held_out", held_out_third(docs, id_col))
    return language_of(marked, learned(docs, id_col), extra=(id_col, "held_out"))


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows whose text has a letter, with all columns; where the language is null, the predicted one.

    Null texts and texts without a letter go. If no language was learned, nothing
    is filled in.
    """
    names = ("__language", "__language_score")
    model = learned(docs, id_col, text_col, lang_col)
    # A model of one language tells every text with a letter.
    known = model if model.languages else train({"any": ["a"]})
    told = language_of(docs, known, text_col, tuple(docs.columns), names)
    kept = told.filter(F.col(names[0]) != UNDETERMINED)
    if model.languages:
        filled = F.coalesce(column(kept, lang_col), F.col(names[0]).cast(docs.schema[lang_col].dataType))
        kept = kept.withColumn(lang_col, filled)
    return kept.drop(*names)
