"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language is compiled into a suffix
automaton.  A text is parsed, word by word, into the longest phrases that occur
in a language's sample; the language that needs the fewest phrases, weighted by
the bits that point into its sample, wins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.words import WordCache, held_out

# The sample a language is learned from: so many documents of at most that length, cut to so many characters in all.
SAMPLE_DOCS = 60
SAMPLE_CHARS = 20_000
LANGUAGE_CHARS = 60_000
# How sharply a lead in bits per character counts towards the score.
SHARPNESS = 8.0
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
FIELD = 40


class SuffixAutomaton:
    """All substrings of a text, built online."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for char in text:
            current = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and char not in self.next[state]:
                self.next[state][char] = current
                state = link[state]
            if state >= 0:
                target = self.next[state][char]
                if length[target] == length[state] + 1:
                    link[current] = target
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[target]))
                    length.append(length[state] + 1)
                    link.append(link[target])
                    while state >= 0 and self.next[state].get(char) == target:
                        self.next[state][char] = clone
                        state = link[state]
                    link[target] = link[current] = clone
            last = current

    def phrases(self, word: str) -> int:
        """How many longest matches ``word`` falls into; a character never seen is a phrase by itself."""
        moves, state, count = self.next, 0, 0
        for char in word:
            target = moves[state].get(char)
            if target is None:
                if state:
                    count += 1
                target = moves[0].get(char)
                if target is None:
                    count += 1
                    target = 0
            state = target
        return count + (state != 0)


class CrossParser:
    def __init__(self, samples: tuple[tuple[str, str], ...]) -> None:
        self.languages = [language for language, _ in samples]
        self.bits = [math.log2(len(text) + 2) for _, text in samples]
        self.automata = [SuffixAutomaton(text) for _, text in samples]
        self.counts: WordCache[int] = WordCache(self._counts)

    def _counts(self, word: str) -> int:
        """Phrases under every language, one field of a long integer each, so that words add up."""
        spaced = f" {word} "
        return sum(a.phrases(spaced) << (FIELD * i) for i, a in enumerate(self.automata))

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not LETTER.search(text) or not self.languages:
            return UNDETERMINED, 0.0
        words = text.lower().split()
        packed = sum(map(self.counts.__getitem__, words))
        chars = sum(map(len, words)) + 2 * len(words)
        mask = (1 << FIELD) - 1
        rates = [((packed >> (FIELD * i)) & mask) * bits / chars for i, bits in enumerate(self.bits)]
        best = min(range(len(rates)), key=lambda i: (rates[i], self.languages[i]))
        share = 1.0 / sum(2.0 ** max(-1000.0, SHARPNESS * (rates[best] - r)) for r in rates)
        return self.languages[best], share


@lru_cache(maxsize=1)
def _parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(samples)


def language_samples(docs: DataFrame, folds: int | None = 4) -> tuple[tuple[str, str], ...]:
    """``(language, text)`` of every language of ``docs``, from documents not held out.

    The documents are those with the smallest hashes of their ids; a language
    contributes ``LANGUAGE_CHARS`` characters at most.
    """
    fit = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= SAMPLE_CHARS)
    )
    if folds:
        fit = fit.where(~held_out("doc_id", folds))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = fit.select("doc_id", "lang").withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_DOCS)
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "place", "text")
    texts: dict[str, str] = {}
    for row in sorted(rows.collect()):
        texts[row["lang"]] = f"{texts.get(row['lang'], '')} {' '.join((row['text'] or '').lower().split())} "
    return tuple((lang, text[:LANGUAGE_CHARS]) for lang, text in sorted(texts.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...]) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``.

    Null texts and texts without a letter are ``und`` at score 0, and so is every
    text if no language was learned.  The score is the winner's share when leads
    in bits per character are turned into odds.  Ties go to the first language in
    alphabetical order.  Repeated rows give a row each; null ids stay null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(shared.value)
        for frame in frames:
            found = [parser.predict(text) for text in frame.column(1).to_pylist()]
            names = pa.array([name for name, _ in found], pa.string())
            scores = pa.array([score for _, score in found], pa.float64())
            yield pa.RecordBatch.from_arrays([frame.column(0), names, scores], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from three folds of four, predict all: ``doc_id, held_out, lang_pred, score``."""
    found = identify(docs, language_samples(docs))
    return found.select("doc_id", held_out("doc_id", 4).alias("held_out"), "lang_pred", "score")
