"""Token counts of a unigram vocabulary without tokens: count-only Viterbi over Aho-Corasick matches."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import BoundedCache, map_texts

SPACE = "▁"
#: How far the score of an unknown character lies under the vocabulary's least score.
UNKNOWN_PENALTY = 10.0


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) by id of a sentencepiece model file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


@dataclass(frozen=True)
class Counter:
    """Best score and piece count of a word, as a unigram tokenizer with byte fallback decides.

    Rules: a path's score is the sum of its pieces' scores; of paths that end at one place with equal scores the one
    whose last piece starts first wins (matches arrive longest first, and only a greater score replaces one); a character that
    is no piece itself may be unknown, at the least score less 10, and counts as its UTF-8 bytes.
    """

    matcher: ahocorasick.Automaton
    single: frozenset
    unknown: float

    def __call__(self, word: str) -> tuple[int, float]:
        n = len(word)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        if self.single.issuperset(word):
            at = 0
            for end, (size, score) in self.matcher.iter(word):
                end += 1
                total = best[end - size] + score
                if end != at or total > best[end]:
                    best[end], count[end], at = total, count[end - size] + 1, end
            return count[n], best[n]
        matches: list[list] = [[] for _ in range(n + 1)]
        for end, match in self.matcher.iter(word):
            matches[end + 1].append(match)
        for end in range(1, n + 1):
            first = True
            for size, score in matches[end]:
                total = best[end - size] + score
                if first or total > best[end]:
                    best[end], count[end], first = total, count[end - size] + 1, False
            char = word[end - 1]
            if char not in self.single:
                total = best[end - 1] + self.unknown
                if first or total > best[end]:
                    best[end], count[end] = total, count[end - 1] + len(char.encode("utf-8", "replace"))
        return count[n], best[n]


def counter(vocabulary: list[tuple[str, float]]) -> Counter:
    matcher = ahocorasick.Automaton()
    for piece, score in vocabulary:
        if piece:
            matcher.add_word(piece, (len(piece), score))
    matcher.make_automaton()
    return Counter(matcher, frozenset(p for p, _ in vocabulary if len(p) == 1), min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY)


@lru_cache(2)
def _cached(path: str) -> BoundedCache:
    count = counter(read_vocabulary(path))
    return BoundedCache(lambda word: count(SPACE + word), 600_000)


def count_text(text: str | None, cache: BoundedCache) -> tuple[int, float]:
    """Pieces and score of a whole text. A piece never starts before a space and ends after it, so words are counted
    alone: each space opens a word, and the first word has one put before it unless the text starts with it."""
    if not text:
        return 0, 0.0
    words = text.replace(SPACE, " ").split(" ")
    if not words[0]:
        del words[0]
    found = list(map(cache.__getitem__, words))
    return sum([x[0] for x in found]), sum([x[1] for x in found])


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add n_tokens (long) and score (double), the best path's, to every row; no tokens are made.

    path: a sentencepiece model file that every executor has; its pieces and scores are read as a unigram vocabulary.
    Null and empty texts have 0 tokens and score 0. Words are kept in a bounded cache; it only saves time. Input columns
    named as a new one give way, the others (or those in keep) stay; repeated rows stay.
    """

    def make():
        cache = _cached(path)

        def run(texts):
            out = []
            for t in texts:
                out.append(count_text(t, cache))
                cache.trim()
            return {"n_tokens": [x[0] for x in out], "score": [x[1] for x in out]}

        return run

    return map_texts(docs, make, [("n_tokens", T.LongType()), ("score", T.DoubleType())], text, keep)
