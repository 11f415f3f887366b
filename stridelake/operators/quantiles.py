"""Exact quantiles of groups of any size.

Groups are counted; each quantile of a large one is bracketed by approximate ones,
which few rows hold, so they are broadcast and no group's values meet in a task. A
last pass counts what lies below the bracket and gathers the few distinct values inside it,
with their counts. So no task holds the values of a large group, and the result is
exact, with linear interpolation between neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.operators.sets import dealt

#: The approximate quantiles are off by one rank in so many at most, so a bracket holds four in so many values.
#: A group of up to twice so many values is one bracket, as a few ranks count there.
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, by: Sequence[str], cols: Sequence[str], ps: Sequence[float], accuracy: int = ACCURACY, tasks: int | None = None) -> DataFrame:
    """One row for each group: its keys as ``__k0``, ``__k1``, ... and for each column an array of quantiles.

    Nulls are left out, and null keys are a group. A group without values has null
    for an array. With no keys there is one row, or none for an empty table. Many
    small groups may be dealt over so many ``tasks``.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols))))
    long = df.select(*(F.col(k).alias(n) for k, n in zip(by, keys, strict=True)), pairs.alias("p")).select(*keys, "p.*").filter("v is not null")
    edges = [x for p in ps for x in (max(0.0, p - 2 / accuracy), min(1.0, p + 2 / accuracy))]
    # Of large groups there is one in 2 * accuracy values at most, so their brackets are a small table.
    sizes = long.groupBy(*keys, "c").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 2 * accuracy)
    of_large = long.join(F.broadcast(_renamed(sizes, keys)), _same(keys) & (F.col("c") == F.col("c_")), "left_semi")
    rough = of_large.groupBy(*keys, "c").agg(F.percentile_approx("v", F.array(*map(F.lit, edges)), accuracy).alias("e"))
    found = long.join(F.broadcast(_renamed(rough, keys)), _same(keys) & (F.col("c") == F.col("c_")), "left")
    small = F.col("e").isNull()
    low = lambda k: F.when(small, F.lit(float("-inf"))).otherwise(F.get("e", F.lit(2 * k)))
    high = lambda k: F.when(small, F.lit(float("inf"))).otherwise(F.get("e", F.lit(2 * k + 1)))
    below = [F.count_if(F.col("v") < low(k)).alias(f"b{k}") for k in range(len(ps))]
    near = F.lit(False)
    for k in range(len(ps)):
        near |= (F.col("v") >= low(k)) & (F.col("v") <= high(k))
    counted = found.groupBy(*keys, "c").agg(F.count(F.lit(1)).alias("n"), F.first("e").alias("e"), *below)
    inside = found.filter(near).groupBy(*keys, "c", "v").agg(F.count(F.lit(1)).alias("m"))
    inside = dealt(inside, tasks, *keys, "c").groupBy(*keys, "c").agg(F.array_sort(F.collect_list(F.struct("v", "m"))).alias("s"))
    both = counted.join(_renamed(inside, keys), _same(keys) & (F.col("c") == F.col("c_")))
    quantiles = F.array(*(_at(p, F.col(f"b{k}"), low(k)) for k, p in enumerate(ps)))
    return both.select(*keys, "c", quantiles.alias("q")).groupBy(*keys).agg(*(F.max(F.when(F.col("c") == i, F.col("q"))).alias(c) for i, c in enumerate(cols)))


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"{k}_" for k in [*keys, "c"]})


def _same(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    return out


def _at(p: float, below: Column, low: Column) -> Column:
    """The value at share p of n sorted values, of which ``s`` holds those from ``low`` on, after ``below`` others."""
    place = F.lit(float(p)) * (F.col("n") - 1)
    inside = F.filter("s", lambda x: x["v"] >= low)

    def value(rank: Column) -> Column:
        start = F.struct((rank - below).alias("left"), F.lit(None).cast("double").alias("v"))

        def step(a: Column, x: Column) -> Column:
            here = a["v"].isNull() & (a["left"] < x["m"])
            return F.struct((a["left"] - x["m"]).alias("left"), F.when(here, x["v"]).otherwise(a["v"]).alias("v"))

        return F.aggregate(inside, start, step)["v"]

    lower, upper = F.floor(place).cast("long"), F.ceil(place).cast("long")
    share = place - lower
    return F.when(share == 0, value(lower)).otherwise(value(lower) * (1 - share) + value(upper) * share)


def with_quantiles(df: DataFrame, by: Sequence[str], cols: Sequence[str], ps: Sequence[float], prefix: str, tasks: int | None = None) -> DataFrame:
    """The arrays of ``exact_quantiles`` beside every row, as prefix and column name."""
    found = exact_quantiles(df, by, cols, ps, tasks=tasks).withColumnsRenamed({c: prefix + c for c in cols})
    if not by:
        return df.join(F.broadcast(found), how="left")  # one row
    on = F.lit(True)
    for i, k in enumerate(by):
        on &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return dealt(df, tasks, *by).join(found, on, "left").drop(*(f"__k{i}" for i in range(len(by))))
