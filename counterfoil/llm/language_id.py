"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a sample of its labelled text. A text
is parsed from left to right into the longest phrases that occur in that sample. The
number of phrases, times log2 of the sample's length, over the text's length estimates
the cross entropy in bits a symbol; the language with the least wins.

Symbols are lower-case letters; each run of other characters is one gap. A text is
parsed whole, in pieces of ``PIECE`` symbols, which adds at most one phrase a piece and
lets numpy walk many pieces in step.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import held_out, learnable
from counterfoil.session import pin

#: The sample: texts per language, their first characters that are sent, and symbols per language,
#: however many languages there are. Nothing else is bounded.
SAMPLE_TEXTS = 96
SAMPLE_CHARS = 2048
SAMPLE_SYMBOLS = 40_000
PIECE = 512
#: Symbols of a gap and of letters that no sample holds; each other letter has its own.
GAP, OTHER = 0, 1
UNKNOWN = "und"
ANSWER = "lang_pred string, score double"
_END = 0x110000
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point the lower-case letter it stands for, or 0 if it is no letter."""
    table = np.zeros(_END, dtype=np.uint32)
    for point in range(_END):
        if unicodedata.category(chr(point))[0] == "L":
            low = chr(point).lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(text: str) -> np.ndarray:
    """Lower-case code points, each run of non-letters as one 0; no 0 at either end."""
    points = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    keep = points != 0
    keep[1:] |= points[:-1] != 0
    points = points[keep]
    return points[: -1 if len(points) and points[-1] == 0 else None][1 if len(points) and points[0] == 0 else 0 :]


class Moves:
    """Transitions of an automaton by state * alphabet + symbol, in a hash table at most half full."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)
        place = self._places(keys)
        while len(keys):
            free = self.keys[place] == -1
            self.keys[place[free]] = keys[free]
            put = self.keys[place] == keys
            self.to[place[put]] = to[put]
            keys, to, place = keys[~put], to[~put], (place[~put] + 1) & self.last

    def _places(self, keys: np.ndarray) -> np.ndarray:
        places = keys.view(np.uint64) * _MIX
        places >>= self.shift
        return places.view(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is no transition."""
        place = self._places(keys)
        found = self.keys.take(place)
        to = self.to.take(place).astype(np.int64)
        other = np.flatnonzero(found != keys)
        to[other] = 0
        other = other[found[other] != -1]
        place = place[other]
        while len(other):
            place = (place + 1) & self.last
            found = self.keys.take(place)
            same = found == keys[other]
            to[other[same]] = self.to.take(place[same])
            on = np.flatnonzero(~same & (found != -1))
            other, place = other[on], place[on]
        return to


def suffix_automaton(symbols: list[int], alphabet: int) -> Moves:
    """Its transitions; state 0 is the empty string, to which none leads."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = copy
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = copy
                    p = link[p]
        last = new
    keys = [state * alphabet + s for state, out in enumerate(moves) for s in out]
    return Moves(np.array(keys, dtype=np.int64), np.array([to for out in moves for to in out.values()], dtype=np.int32))


class Model:
    """Automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, list[str]]):
        learned = {}
        for lang in sorted(samples):
            # In turn from all texts, so that a long one does not fill the sample.
            texts = [t for t in (letters(t) for t in samples[lang]) if len(t)]
            share = max(1, SAMPLE_SYMBOLS // max(1, len(texts)))
            spare = SAMPLE_SYMBOLS
            parts = []
            for text in sorted(texts, key=len):
                share = max(share, spare // max(1, len(texts) - len(parts)))
                parts.append(np.append(text[: min(share, spare)], 0))
                spare -= len(parts[-1])
                if spare <= 0:
                    break
            if parts:
                learned[lang] = np.concatenate(parts)
        self.langs = sorted(learned)
        kept = np.unique(np.concatenate([np.zeros(1, np.uint32), *learned.values()]))[1:]
        self.alphabet = len(kept) + 2
        self.code = np.full(_END, OTHER, dtype=np.int32)
        self.code[0] = GAP
        self.code[kept] = np.arange(len(kept)) + 2
        self.moves, self.starts, self.bits = [], [], []
        for lang in self.langs:
            moves = suffix_automaton(self.code[learned[lang]].tolist(), self.alphabet)
            self.moves.append(moves)
            self.starts.append(moves.of(np.arange(self.alphabet)))
            self.bits.append(math.log2(len(learned[lang]) + 1))

    def phrases(self, pieces: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each piece and language; ``pieces`` has a column per piece, longest first."""
        found = np.zeros((len(self.langs), pieces.shape[1]), dtype=np.int64)
        for at, (moves, start) in enumerate(zip(self.moves, self.starts)):
            state = np.zeros(pieces.shape[1], dtype=np.int64)
            count = found[at]
            live = pieces.shape[1]
            for step in range(len(pieces)):
                while live and lengths[live - 1] <= step:
                    live -= 1
                symbol = pieces[step, :live].astype(np.int64)
                here = state[:live]
                to = moves.of(here * self.alphabet + symbol)
                stuck = np.flatnonzero(to == 0)
                if len(stuck):
                    # The phrase ends here and the next begins with this symbol; a symbol that the
                    # sample lacks is a phrase of its own.
                    again = start.take(symbol[stuck])
                    count[stuck] += (here[stuck] != 0).astype(np.int64) + (again == 0)
                    to[stuck] = again
                state[:live] = to
            count += state != 0
        return found

    def scored(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; ``UNKNOWN``, 0 without letters or languages."""
        points = [letters(t) if t else np.zeros(0, np.uint32) for t in texts]
        size = np.array([len(p) for p in points])
        known = np.flatnonzero(size) if self.langs else np.zeros(0, np.int64)
        answers: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not len(known):
            return answers
        number = -(-size[known] // PIECE)
        owner = np.repeat(np.arange(len(known)), number)
        starts = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        lengths = np.minimum(PIECE, size[known][owner] - starts * PIECE)
        order = np.argsort(-lengths, kind="stable")
        flat = self.code[np.concatenate([points[k] for k in known])]
        begin = (np.cumsum(size[known]) - size[known])[owner] + starts * PIECE
        total = np.zeros((len(self.langs), len(known)))
        for lo in range(0, len(order), 8192):
            some = order[lo : lo + 8192]
            place = begin[some][None, :] + np.arange(lengths[some[0]])[:, None]
            pieces = flat[np.minimum(place, len(flat) - 1)]
            for at, counts in enumerate(self.phrases(pieces, lengths[some])):
                np.add.at(total[at], owner[some], counts)
        bits = total * np.array(self.bits)[:, None] / size[known]
        best = bits.argmin(axis=0)
        ranked = np.sort(bits, axis=0)
        for at, k in enumerate(known):
            first = float(ranked[0, at])
            second = float(ranked[1, at]) if len(self.langs) > 1 else 0.0
            score = second / (first + second) if len(self.langs) > 1 else 1.0
            answers[k] = (self.langs[int(best[at])], score)
        return answers


@lru_cache(maxsize=2)
def _model(samples: tuple[tuple[str, tuple[str, ...]], ...]) -> Model:
    return Model({lang: list(texts) for lang, texts in samples})


def labelled_sample(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> dict[str, list[str]]:
    """Up to ``texts`` different texts per language, the first ``SAMPLE_CHARS`` characters of each.

    Hashes fall into ``texts`` classes; of each language and class the smallest hash is
    taken. Minima are combined before the shuffle, so a hot language costs nothing more.
    """
    rows = docs.filter(learnable("doc_id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", F.xxhash64("text").alias("h"), F.col("text").substr(1, SAMPLE_CHARS).alias("text")
    )
    # Written first: Spark then knows how small it is and need not shuffle the texts to find out.
    least = pin(
        rows.groupBy("lang", F.pmod("h", F.lit(texts)).alias("part")).agg(F.min("h").alias("h")).select("lang", "h")
    )
    chosen = rows.join(least, ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    samples: dict[str, list[str]] = {}
    for row in sorted(chosen.collect()):
        samples.setdefault(row["lang"], []).append(row["text"])
    return samples


def language(text: str | Column, samples: dict[str, list[str]]) -> Column:
    """Column of structs (lang_pred, score)."""
    fixed = tuple((lang, tuple(texts)) for lang, texts in sorted(samples.items()))

    @F.pandas_udf(ANSWER)
    def told(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(fixed)
        for batch in texts:
            answers = []
            for lo in range(0, len(batch), 1000):
                answers += model.scored(batch.iloc[lo : lo + 1000].tolist())
            yield pd.DataFrame(answers, columns=["lang_pred", "score"])

    return told(text)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs`` (doc_id, text, lang).

    Learned from rows whose fold is not 0 and whose lang is not NULL; lang and doc_id are
    no inputs of a prediction. NULL ids have no fold: not held out, not learned from.
    Texts that are NULL, empty or without letters get "und" and 0, as do all if there is
    nothing to learn from. Ties go to the smaller language name; repeated rows get equal
    answers. The score is the runner-up's share of the two least entropies, 0.5 to 1.
    """
    samples = labelled_sample(docs)
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), language("text", samples).alias("answer")).select(
        "doc_id", "held_out", "answer.lang_pred", "answer.score"
    )
