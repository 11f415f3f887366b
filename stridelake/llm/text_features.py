"""Hashed word and character n-gram features that classifiers share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np


def is_held_out(doc_id, parts: int, rest: int):
    """Spark column: whether crc32 of the id as text leaves ``rest`` by ``parts``."""
    from pyspark.sql import functions as F

    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == rest


def grams_of(word: str, least: int, most: int) -> list[str]:
    """A word with its borders marked, and its character n-grams."""
    raw = f"<{word}>"
    out = [raw]
    for n in range(least, most + 1):
        out += [raw[i : i + n] for i in range(len(raw) - n + 1)]
    return out


_BASE, _SPREAD, _WORD_SIZE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1


def bucket_of(gram: str, buckets: int) -> int:
    """Bucket number of a word or n-gram: a polynomial of its characters, spread over 64 bits."""
    h = 0
    for c in gram:
        h = (h * _BASE + ord(c) + 1) & _WORD_SIZE
    h = (h ^ h >> 32) * _SPREAD & _WORD_SIZE
    return (h ^ h >> 29) % buckets


def buckets_of_words(words: list[str], least: int, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """``bucket_of`` of all ``grams_of`` many words, word by word, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    raw = "".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, "<u4").astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # characters from here to the word's end
    base = np.uint64(_BASE)
    powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(0, int(sizes.max(initial=1)) - 1), base))))
    hashes, owners = [np.add.reduceat(codes * powers[left - 1], ends - sizes)], [np.arange(len(words))]
    now = np.zeros(len(codes), np.uint64)
    for n in range(1, most + 1):
        now[: len(codes) - n + 1] = now[: len(codes) - n + 1] * base + codes[n - 1 :]
        if n >= least:
            live = left >= n
            hashes.append(now[live])
            owners.append(owner[live])
    h, owner = np.concatenate(hashes), np.concatenate(owners)
    h = (h ^ h >> np.uint64(32)) * np.uint64(_SPREAD)
    h = ((h ^ h >> np.uint64(29)) % np.uint64(buckets)).astype(np.int64)
    return h[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


class WordRows:
    """Sums of word vectors; the vectors of words seen lately are remembered.

    ``make`` turns a list of words into a matrix of their vectors, so the work on
    new words is done for many at once. ``known`` words and their rows are there
    from the start and stay. When the memory is full, it starts afresh with the
    known words and those at hand; long words are not remembered.
    """

    #: Characters of a word that is remembered at most.
    LONGEST = 64

    def __init__(self, make: Callable[[list[str]], np.ndarray], width: int, most: int, known: list[str] | None = None, known_rows: np.ndarray | None = None):
        self.make, self.most, self.width = make, most, width
        self.known = known or []
        self.rows = np.zeros((len(self.known) + most, width), dtype=np.float32)
        if self.known:
            self.rows[: len(self.known)] = known_rows
        self.place: dict[str, int] = dict(zip(self.known, range(len(self.known)), strict=True))

    def totals(self, documents: Iterable[list[str]], at_once: int = 100_000) -> Iterator[tuple[int, np.ndarray]]:
        """Per document the number of its words and the sum of their vectors, repeats included.

        Documents are taken as they come, some words at a time, so a batch's words
        are never all in memory.
        """
        held: list[list[str]] = []
        size = 0
        for words in documents:
            if held and size + len(words) > at_once:
                yield from self._some(held)
                held, size = [], 0
            held.append(words)
            size += len(words)
        yield from self._some(held)

    def _some(self, documents: list[list[str]]) -> Iterator[tuple[int, np.ndarray]]:
        flat = [*chain.from_iterable(documents)]
        got = [*map(self.place.get, flat)]
        extra = np.zeros((0, self.width))
        if None in got:
            missing = [k for k, p in enumerate(got) if p is None]
            fresh = dict.fromkeys([flat[k] for k in missing])
            short = [w for w in fresh if len(w) <= self.LONGEST]
            afresh = len(self.place) + len(short) > len(self.rows)
            if afresh:  # full: with the known words and these
                self.place = dict(zip(self.known, range(len(self.known)), strict=True))
                missing = [k for k, w in enumerate(flat) if w not in self.place]
                fresh = dict.fromkeys([flat[k] for k in missing])
                short = [w for w in fresh if len(w) <= self.LONGEST]
            first = len(self.place)
            kept = short[: len(self.rows) - first]
            if kept:
                self.rows[first : first + len(kept)] = self.make(kept)
                self.place.update(zip(kept, range(first, first + len(kept)), strict=True))
            # Long words, and those of one text with more words than the memory holds, count once.
            rest = [w for w in fresh if w not in self.place]
            if rest:
                extra = np.concatenate([self.make(rest[i : i + self.most]) for i in range(0, len(rest), self.most)])
            place = self.place | dict(zip(rest, range(len(self.rows), len(self.rows) + len(rest)), strict=True)) if rest else self.place
            if afresh:
                got = [place[w] for w in flat]
            else:
                for k in missing:
                    got[k] = place[flat[k]]
        index = np.array(got, dtype=np.int64)
        vectors = np.empty((len(index), self.width))
        known = index < len(self.rows)
        vectors[known] = self.rows[index[known]]
        vectors[~known] = extra[index[~known] - len(self.rows)]
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        some = np.flatnonzero(sizes)
        totals = np.zeros((len(documents), self.width))
        if len(some):
            totals[some] = np.add.reduceat(vectors, (np.cumsum(sizes) - sizes)[some])
        yield from zip(sizes.tolist(), totals, strict=True)
