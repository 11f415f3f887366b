"""Exact top-k search by term-at-a-time accumulation.

A vector is a sparse row: its terms are the places of its non-zero integer
components. Candidates are dealt to blocks by hash, queries to stripes; each pair
of a block and a stripe is one unit of work. A unit turns its candidates into
postings, one list of rows and weights a term. Each query then scatters its
weighted postings, term after term, into a dense array of scores; a partition
selection takes the block's best, and the blocks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm.common import Scratch, table

#: Candidates of a block and queries of a stripe, on average; what a task holds at once is one block.
BLOCK_ROWS, STRIPE_ROWS = 8192, 2048
#: Partitions that the units are dealt to at most; a task takes one unit after the other.
MOST_PARTITIONS = 20_000
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def integer_weights(vector: Column, scale: float = 64.0) -> Column:
    """``floor(scale * x)`` of every component as a double; longs, with what lies past them at their ends."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(scale)).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    bad = F.exists(vector.cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad


class Postings:
    """The candidates of a block by term, in the order in which ties go."""

    def __init__(self, numbers: np.ndarray, ids: np.ndarray, known: np.ndarray, lengths: np.ndarray, values: np.ndarray):
        order = np.lexsort((numbers, ids, ~known))
        self.numbers, self.ids, self.known = numbers[order], ids[order], known[order]
        self.n = len(order)
        self.largest = _largest(values)
        rows = np.empty(self.n, np.int64)
        rows[order] = np.arange(self.n)
        row = np.repeat(rows, lengths)
        term = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        there = values != 0
        row, term, values = row[there], term[there], values[there]
        by_term = np.argsort(term, kind="stable")
        row, term, values = row[by_term], term[by_term], values[by_term]
        cuts = np.flatnonzero(np.diff(term)) + 1
        starts, ends = np.concatenate(([0], cuts)).astype(int), np.concatenate((cuts, [len(term)])).astype(int)
        self.lists = {int(term[s]): (row[s:e], values[s:e]) for s, e in zip(starts, ends, strict=True) if e > s}

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Inner products of one query with all rows: exact, as Python integers where 64 bits might not hold them."""
        wide = self.largest * _largest(weights) * max(1, len(weights)) > _HIGH
        out = np.zeros(self.n, object if wide else np.int64)
        for term in np.flatnonzero(weights).tolist():
            if term in self.lists:
                rows, values = self.lists[term]
                out[rows] += int(weights[term]) * (values.astype(object) if wide else values)
        return np.clip(out, _LOW, _HIGH).astype(np.int64) if wide else out

    def best(self, number: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the k highest scores, first rows first among equal ones, and those scores; never the query's own row."""
        scores = self.scores(weights)
        others = np.flatnonzero(self.numbers != number)
        scores = scores[others]
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            above = np.flatnonzero(scores > least)
            level = np.flatnonzero(scores == least)[: k - len(above)]
            taken = np.concatenate((above, level))
            return others[taken], scores[taken]
        return others, scores


def _largest(values: np.ndarray) -> int:
    """The largest absolute value, as a Python integer."""
    return max(int(values.max()), -int(values.min())) if len(values) else 0


def _search(k: int):
    """A task over rows sorted by unit, candidates first: the best of each unit for each of its queries."""
    names = ["query_no", "query_id", "no", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, postings = None, [], None

        def columns(batch: pa.RecordBatch) -> tuple:
            ids = batch.column("vec_id")
            w = batch.column("w")
            return (
                batch.column("no").to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False),
                ids.is_valid().to_numpy(zero_copy_only=False), w.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
                w.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            )

        for whole in batches:
            units, asks = (whole.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "asks"))
            cuts = np.flatnonzero((np.diff(units) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(units)], strict=True):
                if s == e:
                    continue
                if units[s] != unit:
                    unit, held, postings = units[s], [], None
                numbers, ids, known, lengths, values = columns(whole.slice(s, e - s))
                if not asks[s]:
                    held.append((numbers, ids, known, lengths, values))
                    continue
                if postings is None:
                    if not held:
                        continue
                    postings, held = Postings(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                ends = np.cumsum(lengths)
                found = [postings.best(int(number), values[b - n : b], k) for number, n, b in zip(numbers, lengths, ends, strict=True)]
                counts = [len(rows) for rows, _ in found]
                rows, scores = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(numbers, counts)), pa.array(np.repeat(ids, counts), mask=~np.repeat(known, counts)),
                    pa.array(postings.numbers[rows]), pa.array(postings.ids[rows], mask=~postings.known[rows]), pa.array(scores),
                ], names=names)

    return run


def top_k(vectors: DataFrame, queries: Column, scratch: Scratch, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """The k candidates of highest integer inner product for every row that ``queries`` marks.

    Returns query_id, rank (from 1), vec_id, score. Candidates are all rows but
    the query's own, so rows that repeat an id find each other. Ties go to the
    smaller id, null ids last, then to the row read first. Vectors that are null or
    hold a null or non-finite component take no part; an empty vector scores zero;
    of vectors of unequal lengths the shorter one counts as ended by zeros. Scores
    past 64 bits stand at the ends of long. An empty table gives no rows, and
    other columns are not read. A null mark is no query.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(vector))).select(
        F.monotonically_increasing_id().alias("no"), F.col(vec_id).cast("long").alias("vec_id"),
        F.coalesce(queries, F.lit(False)).alias("asks"), integer_weights(F.col(vector), scale).alias("w"),
    )
    rows = scratch.save(rows, "weights")
    n, asking = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).head()
    blocks, stripes = -(-max(1, n) // BLOCK_ROWS), -(-max(1, asking) // STRIPE_ROWS)
    dealt = F.xxhash64("no")
    block, stripe = F.pmod(dealt, F.lit(blocks)), F.pmod(dealt, F.lit(stripes))
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    stored = rows.select(each(stripes).alias("other"), block.alias("own"), F.lit(False).alias("asks"), "no", "vec_id", "w")
    asked = rows.filter("asks").select(each(blocks).alias("other"), stripe.alias("own"), F.lit(True).alias("asks"), "no", "vec_id", "w")
    units = stored.withColumn("unit", F.col("own") * stripes + F.col("other")).unionByName(asked.withColumn("unit", F.col("other") * stripes + F.col("own")))
    parts = min(MOST_PARTITIONS, blocks * stripes)
    units = units.select("unit", "asks", "no", "vec_id", "w").repartitionById(parts, F.pmod("unit", F.lit(parts)).cast("int"))
    found = units.sortWithinPartitions("unit", "asks").mapInArrow(_search(k), "query_no long, query_id long, no long, vec_id long, score long")
    best = Window.partitionBy("query_no").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "no")
    ranked = scratch.save(found, "found").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of every twentieth vector."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, Scratch(spark, "op12"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
