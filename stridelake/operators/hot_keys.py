"""Ordered scans of keys that are too large for one task.

A window over a key's rows in order of time runs in one task. Here a key with more
than ``hot_rows`` rows is dealt out over slots of time, of about that many rows
each: a window runs within a slot, and what it needs of the slots before, the last
known value or the last few rows, is a small table that is carried on from slot to
slot and joined back. Keys of fewer rows have one slot and need nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots of a key at most, and rows of a slot, on average, that its borders are found by.
MOST_SLOTS, SEEN_PER_SLOT = 1000, 64


def _number(df: DataFrame, col: str) -> Column:
    """An ordering column as a number."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.col(col)
    raise ValueError(f"rows cannot be dealt out by {col}, a {kind.simpleString()}")


def _same(a: str, keys: Sequence[str], b: str) -> Column:
    """Keys are equal, nulls among themselves; ``a`` and ``b`` are prefixes."""
    out = F.lit(True)
    for k in keys:
        out &= F.col(a + k).eqNullSafe(F.col(b + k))
    return out


def deal_out(df: DataFrame, keys: Sequence[str], at: str, hot_rows: int) -> DataFrame:
    """Add ``__slot``, from 0, and ``__hot``, whether the key has several slots.

    Rows of equal ``at`` share a slot, rows without it are in the first one. The
    borders are quantiles of some of the hot keys' own rows, chosen by their hash,
    so that the same rows give the same borders wherever and however often the plan
    runs. There are fewer than two for each ``hot_rows`` rows of the table, so they
    are broadcast.
    """
    named = [F.col(k).alias(f"__e_{k}") for k in keys]
    hot = df.groupBy(*named).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    hashed = F.xxhash64(*(F.col(f.name) for f in df.schema.fields if not _has_map(f.dataType)))
    some = df.filter(F.col(at).isNotNull() & (F.pmod(hashed, F.lit(max(1, hot_rows // SEEN_PER_SLOT))) == 0))
    own = some.select(*keys, _number(df, at).cast("double").alias("__v"), hashed.alias("__h")).join(F.broadcast(hot), _same("", keys, "__e_"))
    own = own.filter(F.pmod(F.xxhash64("__h"), F.greatest(F.lit(1), F.floor(F.col("__n") / (max(hot_rows, SEEN_PER_SLOT) * MOST_SLOTS)))) == 0)  # no more than the most slots need
    spots = [k / MOST_SLOTS for k in range(1, MOST_SLOTS)]
    edges = own.groupBy(*(f"__e_{k}" for k in keys)).agg(F.percentile("__v", spots).alias("__q"), F.first("__n").alias("__n"))
    slots = F.least(F.lit(MOST_SLOTS), F.ceil(F.col("__n") / hot_rows).cast("int"))
    borders = F.array_distinct(F.transform(F.sequence(F.lit(1), slots - 1), lambda i: F.get("__q", F.floor(i * MOST_SLOTS / slots).cast("int") - 1)))
    edges = edges.select(*(f"__e_{k}" for k in keys), borders.alias("__borders"))
    joined = df.join(F.broadcast(edges), _same("", keys, "__e_"), "left")
    slot = F.when(F.col("__borders").isNull() | F.col(at).isNull(), 0).otherwise(_upto(F.col("__borders"), _number(df, at).cast("double")))
    return joined.withColumns({"__slot": slot, "__hot": F.col("__borders").isNotNull()}).drop("__borders", *(f"__e_{k}" for k in keys))


def _upto(borders: Column, value: Column) -> Column:
    """How many of the sorted borders a value reaches, by halving, so that a row's work does not grow with them."""
    halves = F.array(*(F.lit(1 << k) for k in reversed(range(MOST_SLOTS.bit_length()))))
    return F.aggregate(halves, F.lit(0), lambda found, half: F.when(F.get(borders, found + half - 1) <= value, found + half).otherwise(found))


def _has_map(kind: T.DataType) -> bool:
    """Whether a type cannot be hashed for holding a map."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType)) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def carried(dealt: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column], ahead: bool = False) -> DataFrame:
    """Add for each value the last one, not null, of the key's slots before (``ahead``: the first of those after).

    ``dealt`` comes from ``deal_out``; ``order`` is that of rows within a slot.
    """
    place = F.struct(*order)
    pick = F.min_by if ahead else F.max_by
    of_slot = {name: pick(value, F.when(value.isNotNull(), place)) for name, value in values.items()}
    slots = dealt.filter("__hot").groupBy(*(F.col(k).alias(f"__c_{k}") for k in keys), F.col("__slot").alias("__c_slot")).agg(*(a.alias(n) for n, a in of_slot.items()))
    w = Window.partitionBy(*(f"__c_{k}" for k in keys)).orderBy("__c_slot")
    w = w.rowsBetween(1, Window.unboundedFollowing) if ahead else w.rowsBetween(Window.unboundedPreceding, -1)
    take = F.first if ahead else F.last
    slots = slots.withColumns({n: take(n, ignorenulls=True).over(w) for n in values})
    # A row a slot of the hot keys: fewer than two for each hot_rows rows of the table.
    joined = dealt.join(F.broadcast(slots), F.col("__hot") & (F.col("__slot") == F.col("__c_slot")) & _same("", keys, "__c_"), "left")
    return joined.drop("__c_slot", *(f"__c_{k}" for k in keys))


def with_rows_before(dealt: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The rows, and before each slot but a key's first copies of the n rows before it, with ``__copy`` true."""
    columns = dealt.columns
    back = Window.partitionBy(*keys, "__slot").orderBy(*(F.col(c).desc() for c in order))
    tails = dealt.filter("__hot").withColumn("__rn", F.row_number().over(back)).filter(F.col("__rn") <= n)
    row = F.struct((-F.col("__rn")).alias("__back"), F.struct(*columns).alias("__row"))
    slots = tails.groupBy(*keys, "__slot").agg(F.collect_list(row).alias("__tail"))  # n rows at most
    slots = slots.withColumn("__tail", F.transform(F.array_sort("__tail", lambda a, b: a["__back"] - b["__back"]), lambda x: x["__row"]))
    before = Window.partitionBy(*keys).orderBy("__slot").rowsBetween(-n, -1)
    whole = F.flatten(F.collect_list("__tail").over(before))
    kept = slots.select(F.col("__slot").alias("__to"), whole.alias("__rows")).filter(F.size("__rows") > 0)
    last = F.slice("__rows", F.greatest(F.size("__rows") - n + 1, F.lit(1)), F.lit(n))
    copies = kept.select("__to", F.explode(last).alias("__row")).select("__row.*", "__to").withColumn("__slot", F.col("__to")).drop("__to")
    return dealt.withColumn("__copy", F.lit(False)).unionByName(copies.withColumn("__copy", F.lit(True)))
