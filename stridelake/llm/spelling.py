"""Grouping of spelling variants by finite-state composition.

Words within one edit are those that the vocabulary's minimal acceptor, a one-edit
transducer and the acceptor again accept together. The composition is dealt out
by its initial states. Two words that first differ in a stretch of places share
the letters before the stretch and those after it; so for each length there are
two families of initial states, one for edits in the first half of a word and
one for the second, and each word goes to the states of its own outer letters. A
state with too many words is replaced by those of the halves of its stretch. A
stretch of one place has few words at most, so no state stays large, and none is
cut. A task builds the acceptor of many initial states at once and enumerates the
accepted pairs, of which only counts and the best partner of each word leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.acceptor import Acceptor
from stridelake.llm.common import Scratch, ascii_lower, table

#: Code points of a word and its occurrences, at least; how many times as frequent a form is as its variant.
LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
#: Runs whose checksum this divides lose a letter.
NOISE = 31
#: Words times open letters of an initial state at most, and of an acceptor that a task builds at once.
CELLS = 1 << 20
#: Letters of a word, all of Latin-1.
LETTERS = "A-Za-zÀ-ÿ"


def noisy_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS) -> DataFrame:
    """One row per occurrence of a word: maximal runs of letters, one in ``NOISE`` of them with a letter taken out.

    Runs with fewer than ``least`` letters cannot become words and are not made rows.
    A null id counts as an empty one.
    """
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(F.col(text)), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"),
    )
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    spot = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), spot), F.substring(F.col("run"), spot + 2, F.length("run")))
    return runs.withColumn("h", h).select(F.when(F.pmod("h", F.lit(NOISE)) == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """Distinct words that are long and frequent enough, with their occurrences ``n``."""
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _stretches(words: DataFrame, least: int) -> DataFrame:
    """Each word with the stretches in which its edits may lie: by the shorter length of a pair, two halves each."""
    m = F.length("word")

    def halves(length: Column) -> list[Column]:
        middle = F.floor((length + 1) / 2).cast("int")
        return [F.struct(length.alias("short"), F.lit(0).alias("lo"), middle.alias("hi")), F.struct(length.alias("short"), middle.alias("lo"), (length + 1).alias("hi"))]

    each = words.select("word", "n", F.explode(F.array(*halves(m), *halves(m - 1))).alias("s")).select("word", "n", "s.*")
    return each.filter(F.col("short") >= least)


def _keyed(rows: DataFrame) -> DataFrame:
    """The initial state of each row, ``outer``, and the open letters."""
    behind = F.greatest(F.col("short") - F.col("hi"), F.lit(0))
    m = F.length("word")
    outer = F.concat(F.substring(F.col("word"), F.lit(1), F.col("lo")), F.lit("|"), F.substring(F.col("word"), m - behind + 1, behind))
    return rows.select("short", "lo", "hi", outer.alias("outer"), F.substring(F.col("word"), F.col("lo") + 1, m - behind - F.col("lo")).alias("open"), "n")


_NAMES = ["over", "short", "lo", "hi", "word", "n", "n_near", "best_n", "best"]
_TYPES = [pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def _whole(outer: list[str], middle: list[str], lo: list[int]) -> list[str]:
    """Words from their parts."""
    return [o[:k] + m + o[k + 1 :] for o, m, k in zip(outer, middle, lo, strict=True)]


def _near(rows: pa.Table, first: np.ndarray) -> pa.RecordBatch | None:
    """Counts and best partners of the words of whole groups; ``first`` marks where a group begins."""
    number = np.cumsum(first) - 1
    alone = np.bincount(number)[number] == 1
    rows, number = rows.filter(pa.array(~alone)), number[~alone]
    if not rows.num_rows:
        return None
    short, lo, hi, n = (rows.column(c).to_numpy() for c in ("short", "lo", "hi", "n"))
    middles = rows.column("open").to_pylist()
    lengths = np.fromiter(map(len, middles), np.int64, len(middles))
    # The letters are Latin-1; zeros fill the rows up.
    letters = np.array([m.encode("latin-1") for m in middles], dtype=f"S{max(1, lengths.max())}").view(np.uint8).reshape(len(middles), -1)
    _, group = np.unique(number, return_inverse=True)
    head = np.concatenate(([True], group[1:] != group[:-1]))
    a, b = Acceptor(letters, lengths, group).one_edit_pairs((hi - lo)[head])
    # Of two words of one length, those of the longer length belong to another group.
    base = short - lo - np.maximum(short - hi, 0)
    fits = np.minimum(lengths[a], lengths[b]) == base[a]
    a, b = a[fits], b[fits]
    if not len(a):
        return None
    own, other = np.concatenate((a, b)), np.concatenate((b, a))
    busy = np.unique(own)
    words = _whole(*(rows.column(c).take(pa.array(busy)).to_pylist() for c in ("outer", "open", "lo")))
    rank = np.zeros(rows.num_rows, np.int64)
    rank[busy[sorted(range(len(words)), key=words.__getitem__)]] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], own))
    own, other = own[order], other[order]
    start = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    named = dict(zip(busy.tolist(), words, strict=True))
    best = other[start]
    k = len(busy)
    columns = [np.zeros(k, bool), short[busy], lo[busy], hi[busy], words, n[busy], np.diff(np.append(start, len(own))), n[best], [named[x] for x in best.tolist()]]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _handed_on(rows: pa.Table) -> pa.RecordBatch:
    """Words of a group that is too large, for the next round."""
    words = _whole(*(rows.column(c).to_pylist() for c in ("outer", "open", "lo")))
    none = pa.nulls(rows.num_rows)
    columns = [pa.array([True] * rows.num_rows), *(rows.column(c).combine_chunks() for c in ("short", "lo", "hi")), pa.array(words), rows.column("n").combine_chunks(), none, none, none]
    return pa.RecordBatch.from_arrays([x.cast(t) for x, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _compose(cells: int):
    """A task over rows sorted by initial state and open letters; it streams, some groups at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # whole groups
        marks: list[np.ndarray] = []
        size = width = 0
        tail: pa.Table | None = None  # the group that may go on
        spilled = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size, width
            if held:
                found = _near(pa.concat_tables(held), np.concatenate(marks))
                held.clear()
                marks.clear()
                size = width = 0
                if found is not None:
                    yield found

        def add(rows: pa.Table, first: np.ndarray, wide: int) -> Iterator[pa.RecordBatch]:
            nonlocal size, width
            if size and (size + rows.num_rows) * max(width, wide) > cells:
                yield from flush()
            held.append(rows)
            marks.append(first)
            size, width = size + rows.num_rows, max(width, wide)

        def key_of(rows: pa.Table) -> tuple:
            return tuple(rows.column(c)[0].as_py() for c in ("short", "lo", "hi", "outer"))

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if tail is not None:
                rows = pa.concat_tables([tail, rows]).combine_chunks()
                tail = None
            while rows.num_rows:
                new = np.zeros(rows.num_rows, bool)
                new[0] = True
                for c in ("short", "lo", "hi", "outer"):
                    own = rows.column(c)
                    new[1:] |= pc.not_equal(own.slice(1), own.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(new)
                if spilled is not None and key_of(rows) == spilled:
                    end = int(starts[1]) if len(starts) > 1 else rows.num_rows
                    yield _handed_on(rows.slice(0, end))
                    rows = rows.slice(end)
                    continue
                spilled = None
                wide = pc.utf8_length(rows.column("open")).to_numpy(zero_copy_only=False)
                ends = np.append(starts[1:], rows.num_rows)
                widest = np.maximum.reduceat(wide, starts)
                large = (ends - starts) * widest > cells
                begin = 0
                for g in np.flatnonzero(large).tolist():
                    if g > begin:
                        yield from add(rows.slice(starts[begin], starts[g] - starts[begin]), new[starts[begin] : starts[g]], int(widest[begin:g].max()))
                    yield _handed_on(rows.slice(starts[g], ends[g] - starts[g]))
                    begin = g + 1
                last = len(starts) - 1
                if begin > last:
                    spilled = key_of(rows.slice(starts[last]))
                else:
                    if last > begin:
                        yield from add(rows.slice(starts[begin], starts[last] - starts[begin]), new[starts[begin] : starts[last]], int(widest[begin:last].max()))
                    tail = rows.slice(starts[last])
                break
        if tail is not None:
            yield from add(tail, np.arange(tail.num_rows) == 0, int(pc.max(pc.utf8_length(tail.column("open"))).as_py()))
        yield from flush()

    return run


def near_words(words: DataFrame, scratch: Scratch, least: int = LEAST_LETTERS) -> DataFrame:
    """Words with a near word: word, n_near, and best_n and best of the most frequent one (ties: first by code points).

    ``words`` is a stored table of distinct words of Latin-1 letters with ``n``.
    """
    schema = "over boolean, short int, lo int, hi int, word string, n long, n_near long, best_n long, best string"
    key = ["short", "lo", "hi", "outer"]
    rows, found, turn = _stretches(words, least), None, 0
    while True:
        made = _keyed(rows).repartition(*key).sortWithinPartitions(*key, "open").mapInArrow(_compose(CELLS), schema)
        made = scratch.save(made, f"near-{turn}")
        own = made.filter("not over").select("word", "n_near", "best_n", "best")
        found = own if found is None else found.unionByName(own)
        over = made.filter("over")
        if over.isEmpty():
            break
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
        rows = over.select("word", "n", "short", F.explode(halves).alias("s")).select("word", "n", "short", "s.*")
        turn += 1
    order = F.struct((-F.col("best_n")).alias("rare"), F.col("best").alias("best"))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("top"))
    return summed.select("word", "n_near", (-F.col("top.rare")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """The end of each word's chain of forms: word, root.

    Each round doubles the steps that are known. A form is ``RATIO`` times as
    frequent as its word, so chains are short and never close.
    """
    now, turn = scratch.save(forms.select("word", F.col("form").alias("root")), "roots-0"), 0
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = scratch.save(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{turn + 1}")
        scratch.drop(f"roots-{turn}")
        turn += 1
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """Every word of the vocabulary with its form and root: word, form, root, n, n_near, form_n.

    A null or empty text has no words, and a null id counts as an empty one in the
    checksum; rows may repeat and then count twice. Long words are split like any
    other. Ties go to the first form in code-point order. An empty table gives no
    rows; other columns are not read.
    """
    words = scratch.save(vocabulary(noisy_words(docs, doc_id, text, least), least, least_count), "vocabulary")
    near = near_words(words, scratch, least)
    known = words.join(near, "word", "left")
    has_form = F.col("best_n") >= ratio * F.col("n")
    named = known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n"))
    named = scratch.save(named, "named")
    ends = roots(named.filter("form is not null"), scratch)
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of the words of ``documents``."""
    return variants(table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, times,
         xor(4294967295, list_reduce(
           flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
             lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)] ELSE [CAST(192 + unicode(ch) // 64 AS BIGINT), CAST(128 + unicode(ch) % 64 AS BIGINT)] END)),
           lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) AS h
  FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, times
  FROM hashed
), v AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), gone AS (
  SELECT word, p, left(word, p) || substr(word, p + 2) AS rest FROM (SELECT word, CAST(unnest(range(length(word))) AS INTEGER) AS p FROM v)
), near AS (
  SELECT a.word, b.word AS other FROM gone a JOIN gone b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT g.word, v.word FROM gone g JOIN v ON g.rest = v.word
  UNION SELECT v.word, g.word FROM gone g JOIN v ON g.rest = v.word
), best AS (
  SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near,
         row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) AS k
  FROM near JOIN v o ON o.word = near.other
), formed AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 10 * v.n THEN b.other END AS form, CASE WHEN b.other_n >= 10 * v.n THEN b.other_n END AS form_n
  FROM v LEFT JOIN best b ON b.word = v.word AND b.k = 1
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.at AND e.form IS NULL
"""
