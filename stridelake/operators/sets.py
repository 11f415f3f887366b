"""Set operations and ordering: U1-U4, L1-L5."""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that a task sorts or joins at once, on average.
TASK_ROWS = 500_000


def tasks_for(rows: int) -> int:
    """Tasks over which so many rows are to be dealt."""
    return math.ceil(rows / TASK_ROWS)


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Rows dealt over tasks by their keys, if that takes more tasks than the session's shuffles have."""
    if tasks is None or tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *keys)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column that a frame lacks is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key by a stated order, so that it is the same in every run."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", at).filter("__rn = 1").drop("__rn")


def distinct_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct projection."""
    return df.select(*columns).distinct()


def keyed_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left whose key the right lacks."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def keyed_intersection(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left whose key the right has."""
    return left.join(right.select(*keys), list(keys), "left_semi")


def sorted_by(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Global order, for an export: a range-partitioned sort."""
    return df.orderBy(*order)


def top_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first n rows of an order; each task keeps n at most."""
    return df.orderBy(*order).limit(n)


def argmax_by(df: DataFrame, by: Sequence[str], score: str, tie: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Values of the row with the highest score in each group; ties go to the smallest ``tie``.

    One partial aggregate, no sort of the groups.
    """
    worst_first = F.struct((-F.col(score)).alias("s"), *tie)
    best = F.min_by(F.struct(score, *values), worst_first)
    return df.groupBy(*by).agg(best.alias("__best")).select(*by, *(F.col(f"__best.{c}").alias(c) for c in (score, *values)))


def natural_key(col: Column) -> Column:
    """Sort key of program numbers such as 1, 1A, 2: the number, then the letters."""
    return F.struct(F.regexp_extract(col, r"^\s*(\d*)", 1).try_cast("int").alias("n"), F.upper(F.regexp_extract(col, r"^\s*\d*\s*(.*?)\s*$", 1)).alias("s"))


def last_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The most recent n rows of each entity; ``order`` has the latest first."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__rn") <= n).drop("__rn")
