"""Phrase collocations by multikey three-way quicksort of suffix pointers.

The suffixes of all pieces, cut after the longest phrase, are routed to tasks by
their two leading words, over all of the corpus, so that each task holds every
suffix of its phrases. A task sorts pointers to its suffixes by a three-way
quicksort on one word after the other, all partitions of a round at once: the
pointers equal to the pivot go on to the next word, and how many they are is the
count of the phrase that they share. A partition with too few is abandoned.

Equal suffixes of one slice of documents travel as one pointer with a weight. Word
pairs that begin a large share of all suffixes are found beforehand and routed by
their later words too; the parts of their count are added up at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm.common import Scratch, table

#: Words of a candidate at most, its occurrences at least, rows reported a language; percent of a
#: phrase's occurrences inside one longer phrase that drop it.
LONGEST, LEAST, TOP, INSIDE = 3, 10, 2000, 50
#: Bytes of text that a task cuts into suffixes at once, and suffixes of a route on average.
SLICE_BYTES, ROUTE_SUFFIXES = 4 << 20, 1 << 20
#: Partitions that the routes are dealt to at most.
MOST_PARTITIONS = 20_000
#: A pair is hot if it begins more than one in so many suffixes of some slice, and of the corpus as far as such slices
#: tell. Fewer pairs than ``HOT_SHARE`` are, and every pair that begins more than one in 128 is.
SLICE_SHARE, HOT_SHARE = 256, 512
NO_LANG = "und"

_BREAKS, _BLANKS = b".,;:!?\n\v\f\r", b" \t"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)], _KIND[list(_BREAKS)] = 1, 2


def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, A-Z lower-cased, and the number of each one's piece."""
    data = b"\n".join(texts).translate(_LOWER)
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    letter = kind == 0
    edge = np.diff(np.concatenate(([0], letter.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    places = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(raw[letter])])
    return words, piece


class Slice:
    """The suffixes of some texts of one language, cut after ``longest`` words: distinct ones, with how often each occurs."""

    def __init__(self, texts: list[bytes], longest: int):
        words, piece = _words(texts)
        coded = words.dictionary_encode()
        self.words = coded.dictionary.cast(pa.string())
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.counts = np.bincount(ids, minlength=len(self.words))
        columns = [ids]
        for k in range(1, longest):
            column = np.full(len(ids), -1, np.int64)  # where the piece has ended
            if len(ids) > k:
                column[:-k] = np.where(piece[k:] == piece[:-k], ids[k:], -1)
            columns.append(column)
        # A suffix of one word alone begins no phrase.
        there = columns[1] >= 0
        columns = [c[there] for c in columns]
        # Equal prefixes get equal numbers, one word longer each time.
        number = columns[0]
        for column in columns[1:]:
            _, first, number, self.weights = np.unique(number * (len(self.words) + 1) + column + 1, return_index=True, return_inverse=True, return_counts=True)
        self.columns = [c[first] for c in columns]


def _slices(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, Slice]]:
    """The texts of a task in slices, each of one language."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            held, size = [], 0
            for text in texts:
                if held and size + len(text) > SLICE_BYTES:
                    yield lang, Slice(held, longest)
                    held, size = [], 0
                held.append(text)
                size += len(text)
            yield lang, Slice(held, longest)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each slice with their counts, its suffixes, and the pairs that begin a large share of those."""
    for lang, part in _slices(batches, 2):
        total = int(part.weights.sum())
        hot = part.weights * SLICE_SHARE > total
        a, b = (part.words.take(pa.array(c[hot])) for c in part.columns)
        kinds = [pa.array(["word"] * len(part.words) + ["pair"] * len(a) + ["suffixes"])]
        first = pa.concat_arrays([part.words, a, pa.nulls(1, pa.string())])
        second = pa.concat_arrays([pa.nulls(len(part.words), pa.string()), b, pa.nulls(1, pa.string())])
        n = np.concatenate((part.counts, part.weights[hot], [total])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*kinds, pa.array([lang] * len(n), pa.string()), first, second, pa.array(n)], names=["kind", "lang", "first", "second", "n"])


def _narrow(codes: np.ndarray) -> np.ndarray:
    """Places in half the bytes where they fit."""
    return codes.astype(np.int16) if codes.max() < 1 << 15 else codes


def _packed(codes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some suffixes and, for each suffix, the places of its words among them; -1 where it has ended.

    ``place`` is room for a number for each word of the slice; its last one is for the end.
    """
    place[:] = -1
    place[codes] = 0
    place[-1] = -1
    used = np.flatnonzero(place == 0)
    place[used] = np.arange(len(used))
    return used, place[codes]


def _route(routes: int, hot: frozenset[tuple[str, str, str]], longest: int):
    """A task: the suffixes of each slice, packed by route."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    hot_in: dict[str, list[tuple[str, str]]] = {}
    for lang, a, b in hot:
        hot_in.setdefault(lang, []).append((a, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = ["route", "lang", "words", "codes", "weights", "split"]
        for lang, part in _slices(batches, longest):
            if not len(part.weights):
                continue
            texts = part.words.to_pylist()
            # The last one stands for the end of a piece.
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, (*texts, "")), np.uint64, len(texts) + 1)
            to = (hashes[part.columns[0]] ^ np.uint64(xxhash.xxh64_intdigest(lang))) * mix + hashes[part.columns[1]]
            split = np.zeros(len(to), bool)
            if lang in hot_in:
                place = {w: k for k, w in enumerate(texts)}
                for a, b in hot_in[lang]:
                    if a in place and b in place:
                        split |= (part.columns[0] == place[a]) & (part.columns[1] == place[b])
                for column in part.columns[2:]:
                    to[split] = to[split] * mix + hashes[column[split]]
            route = ((to * mix) >> np.uint64(33)) % np.uint64(routes)
            order = np.argsort(route, kind="stable")
            route = route[order]
            cuts = np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1])))
            out, words = [], []
            ordered, weights, split = np.stack(part.columns)[:, order], part.weights[order].astype(np.int32), split[order]
            room = np.empty(len(texts) + 1, np.int32)
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True):
                used, codes = _packed(ordered[:, s:e], room)
                words.append(used)
                out.append((_narrow(codes).tobytes(), weights[s:e].tobytes(), np.packbits(split[s:e]).tobytes()))
            places = np.cumsum([0, *map(len, words)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(places), part.words.take(pa.array(np.concatenate(words))))
            columns = [pa.array(route[cuts].astype(np.int64)), pa.array([lang] * len(cuts)), lists, *(pa.array(x, pa.binary()) for x in zip(*out, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _middle(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The middle one of three."""
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def multikey_quicksort(columns: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Three-way quicksort of pointers to rows of words, one column after the other, all partitions of a round at once.

    Yields (depth, rows, sizes): for each partition of rows that agree in their
    first ``depth`` columns one of its rows, and the sum of its weights. Partitions
    lighter than ``least`` are abandoned, and so are rows that have ended (below zero).
    """
    pointers, starts = np.arange(len(weights)), np.zeros(min(1, len(weights)), np.int64)
    at = np.zeros(len(starts), np.int64)  # the column that a partition is split by
    while len(starts):
        sizes = np.diff(np.append(starts, len(pointers)))
        part = np.repeat(np.arange(len(starts)), sizes)
        keys = columns[at[part], pointers]
        pivot = _middle(keys[starts], keys[starts + sizes // 2], keys[starts + sizes - 1])
        # Three partitions come of each: below, equal, above.
        cell = 3 * part + 1 + (keys > pivot[part]) - (keys < pivot[part])
        heavy = np.bincount(cell, weights[pointers], 3 * len(starts)).astype(np.int64)
        live = heavy >= least
        live[1::3] &= pivot >= 0
        keep = live[cell]
        cell, pointers = cell[keep], pointers[keep]
        order = np.argsort(cell, kind="stable")
        cell, pointers = cell[order], pointers[order]
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
        own = cell[starts]
        equal = own % 3 == 1
        at = at[own // 3] + equal
        for depth in np.unique(at[equal]).tolist():
            here = equal & (at == depth)
            yield depth, pointers[starts[here]], heavy[own[here]]
        # Partitions that agree in all columns are done.
        on = at < len(columns)
        stay = np.repeat(on, np.diff(np.append(starts, len(pointers))))
        sizes = np.diff(np.append(starts, len(pointers)))[on]
        pointers, at = pointers[stay], at[on]
        starts = np.cumsum(sizes) - sizes


def _sort(least: int, longest: int):
    """A task over packed suffixes sorted by route and language: the phrases of each, with their counts.

    Where a pair's suffixes are dealt to several routes, parts of its count come out.
    """

    def phrases(lang: str, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        coded = pa.concat_arrays([words for words, *_ in held]).dictionary_encode()
        ids = np.split(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([len(words) for words, *_ in held])[:-1])
        # A place of -1 takes the -1 at the end.
        columns = np.concatenate([np.append(own, -1)[codes] for own, (_, codes, *_) in zip(ids, held, strict=True)], axis=1)
        weights, split = (np.concatenate([x[k] for x in held]) for k in (2, 3))
        held.clear()
        for some, lightest in ((~split, least), (split, 1)):
            own, heavy = columns[:, some], weights[some]
            for depth, rows, n in multikey_quicksort(own, heavy, lightest):
                if depth == longest:
                    rows, n = rows[n >= least], n[n >= least]
                if depth > 1 and len(rows):
                    texts = coded.dictionary.take(pa.array(own[:depth, rows].T.ravel()))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * depth, pa.int32()), texts)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), lists, pa.array(n)], names=["lang", "words", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for k, key in enumerate(zip(batch.column("route").to_pylist(), batch.column("lang").to_pylist(), strict=True)):
                if key != now:
                    if held:
                        yield from phrases(now[1], held)
                    now, held = key, []
                weights, packed = (batch.column(c)[k].as_py() for c in ("weights", "codes"))
                weights = np.frombuffer(weights, np.int32)
                codes = np.frombuffer(packed, np.int16 if len(packed) == 2 * longest * len(weights) else np.int32)
                split = np.unpackbits(np.frombuffer(batch.column("split")[k].as_py(), np.uint8))[: len(weights)].astype(bool)
                held.append((batch.column("words")[k].values, codes.reshape(longest, -1), weights.astype(np.int64), split))
        if held:
            yield from phrases(now[1], held)

    return run


def phrase_counts(docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``least`` times or more, and all words of each language.

    The first has lang, words (an array) and n, the second lang and n. Both are stored.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = scratch.save(texts.mapInArrow(_count, "kind string, lang string, first string, second string, n long"), "counted")
    summed = counted.groupBy("kind", "lang", "first", "second").agg(F.sum("n").alias("n"))
    summed = scratch.save(summed.filter(f"kind = 'word' and n >= {least} or kind <> 'word'"), "summed")
    total = summed.filter("kind = 'suffixes'").agg(F.sum("n")).head()[0] or 0
    # Fewer than HOT_SHARE rows, as their sums add up to the total at most.
    hot = frozenset((r["lang"], r["first"], r["second"]) for r in summed.filter("kind = 'pair'").filter(F.col("n") * HOT_SHARE > total).collect())
    routes = -(-max(1, total) // ROUTE_SUFFIXES)
    packed = texts.mapInArrow(_route(routes, hot, longest), "route long, lang string, words array<string>, codes binary, weights binary, split binary")
    parts = min(MOST_PARTITIONS, routes)
    dealt = packed.repartitionById(parts, F.pmod("route", F.lit(parts)).cast("int")).sortWithinPartitions("route", "lang")
    found = scratch.save(dealt.mapInArrow(_sort(least, longest), "lang string, words array<string>, n long"), "sorted")
    phrases = found.groupBy("lang", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = summed.filter("kind = 'word'").select("lang", F.array("first").alias("words"), "n")
    totals = scratch.save(counted.filter("kind = 'word'").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    return scratch.save(phrases.unionByName(words), "phrases"), totals


def collocations(docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST, top: int = TOP, inside: int = INSIDE, text: str = "text", lang: str = "lang") -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    The score of a phrase is that of its worst cut into a first part with l and a
    rest with r occurrences, a * a / (l * r) in millionths, rounded down; of equal
    cuts the first. Phrases that lie for the most part in one longer phrase are
    dropped. Ties go to the more frequent, then to the first phrase by bytes. A null
    text is an empty one, a null language is ``und``; rows may repeat and count each
    time. An empty table gives no rows; other columns are not read.
    """
    counts, totals = phrase_counts(docs, scratch, least, longest, text, lang)
    joined = lambda words: F.array_join(words, " ")
    known = counts.select("lang", joined("words").alias("part"), F.col("n").alias("times"))
    candidates = counts.filter(F.size("words") > 1).select("lang", "words", joined("words").alias("phrase"), F.col("n").alias("a"))
    m = F.size("words")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.slice("words", F.lit(1), F.col("k"))).alias("head"), joined(F.slice("words", F.col("k") + 1, m)).alias("rest"))
    for part, name in (("head", "l"), ("rest", "r")):
        cuts = cuts.join(known.select("lang", F.col("part").alias(part), F.col("times").alias(name)), ["lang", part]).drop(part)
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumns({"up": F.lit(1000000).cast("decimal(7,0)") * (big("a") * big("a")), "down": big("l") * big("r")}).withColumn("score", F.expr("up div down"))
    worst = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("w")).select("lang", "phrase", "w.*")
    # All contiguous parts of two words or more of a phrase, but itself.
    stretch = "flatten(transform(sequence(2, size(words) - 1), s -> transform(sequence(1, size(words) - s + 1), b -> array_join(slice(words, b, s), ' '))))"
    longer = candidates.filter(m > 2).select("lang", F.explode(F.expr(stretch)).alias("phrase"), "a")
    outer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("outer"))
    kept = worst.join(outer, ["lang", "phrase"], "left").filter(F.col("outer").isNull() | (100 * F.col("outer") < inside * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scratch.save(kept, "kept").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"), Scratch(spark, "op13"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces
), grams AS (
  SELECT lang, len(ws[i : i + m - 1]) AS m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, ws[i : i + m - 1] AS words
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS t(m))
), f AS (
  SELECT lang, m, phrase, any_value(words) AS words, count(*) AS f FROM grams GROUP BY lang, m, phrase
), total AS (
  SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang
), cand AS (
  SELECT lang, phrase, words, m, f AS a FROM f WHERE m >= 2 AND f >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, CAST(1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN f h ON h.lang = c.lang AND h.m = c.k AND h.phrase = array_to_string(c.words[1 : c.k], ' ')
  JOIN f t ON t.lang = c.lang AND t.m = c.m - c.k AND t.phrase = array_to_string(c.words[c.k + 1 : c.m], ' ')
), worst AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts
), parts AS (
  SELECT lang, array_to_string(words[1 : 2], ' ') AS phrase, a FROM cand WHERE m = 3
  UNION ALL SELECT lang, array_to_string(words[2 : 3], ' '), a FROM cand WHERE m = 3
), outside AS (
  SELECT lang, phrase, max(a) AS top FROM parts GROUP BY lang, phrase
), ranked AS (
  SELECT w.lang, CAST(row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS INTEGER) AS rank, w.phrase, w.a, w.l, w.r, w.score
  FROM worst w LEFT JOIN outside p ON p.lang = w.lang AND p.phrase = w.phrase
  WHERE w.o = 1 AND (p.top IS NULL OR 100 * p.top < 50 * w.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
