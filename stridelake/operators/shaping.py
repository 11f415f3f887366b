"""Projection, casting and filters: P1-P15."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.sources.shared import folder, stored


def normalize_keys(df: DataFrame, str_cols: Sequence[str] = (), int_cols: Sequence[str] = (), date_cols: Sequence[str] = ()) -> DataFrame:
    """Upper-case and trim text keys, cast numbers and dates."""
    out = {c: F.upper(F.trim(c)) for c in str_cols} | {c: F.col(c).try_cast("int") for c in int_cols} | {c: F.to_date(c) for c in date_cols}
    return df.withColumns(out)


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Trim all text columns and cast those of a declared schema that are present; bad values become null."""
    out = {}
    for field in df.schema:
        col = F.trim(field.name) if isinstance(field.dataType, T.StringType) else F.col(field.name)
        if field.name in schema:
            out[field.name] = col.try_cast(schema[field.name])
        elif isinstance(field.dataType, T.StringType):
            out[field.name] = col
    return df.withColumns(out)


def decimals_to_double(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast decimal columns, all or the named ones, to double."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType) and (cols is None or f.name in cols)})


def format_timestamps(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Timestamp columns as text."""
    return df.withColumns({f.name: F.date_format(f.name, fmt) for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))})


def keep_columns(df: DataFrame, suffixes: Sequence[str] = (), names: Sequence[str] = (), drop: bool = False) -> DataFrame:
    """Keep, or drop, columns by suffix or name, in their order."""
    named = [c for c in df.columns if c in set(names) or c.endswith(tuple(suffixes) or ("\0",))]
    return df.drop(*named) if drop else df.select(*named)


def filter_population(df: DataFrame, flag: str, course: str, courses: Sequence[str], present: Sequence[str] = (), equal: Mapping[str, object] | None = None) -> DataFrame:
    """Rows with the flag set or of the named courses, whose needed columns are there and match."""
    keep = (F.coalesce(F.col(flag), F.lit(0)) == 1) | F.col(course).isin(list(courses))
    for c in present:
        keep &= F.col(c).isNotNull()
    for c, v in (equal or {}).items():
        keep &= F.col(c) == v
    return df.filter(keep)


def has_all(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """1 where all columns are there, else 0."""
    return df.withColumn(out, F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in cols]), 1).otherwise(0))


def drop_missing_outcome(df: DataFrame, flag: str, historic: object, col: str) -> DataFrame:
    """Drop historic rows whose outcome is null, NaN or 0; other rows stay."""
    missing = F.col(col).isNull() | F.isnan(F.col(col).cast("double")) | (F.col(col) == 0)
    return df.filter(~((F.col(flag) == historic) & missing))


def time_split(df: DataFrame, date: str, c1: str, c2: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows before c1, from c1 to before c2, and from c2."""
    d = F.col(date)
    first, second = F.lit(c1).cast("date"), F.lit(c2).cast("date")
    return df.filter(d < first), df.filter((d >= first) & (d < second)), df.filter(d >= second)


def cardinality_kinds(df: DataFrame, threshold: int, cols: Sequence[str] | None = None) -> DataFrame:
    """A type for each column, ``categorical`` up to so many distinct values: column, kind, distinct_values, exact.

    One pass makes a sketch of each column in each partition and merges them, so
    no row is copied for a column. Where a sketch's estimate is within
    ``SKETCH_MARGIN`` of the threshold, a second pass counts those columns alone,
    exactly; only there is ``distinct_values`` exact, as ``exact`` says. A table
    without rows has no distinct values. Nulls are no value.
    """
    names = list(cols or df.columns)
    text = lambda c: F.col(c) if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType, T.LongType, T.IntegerType)) else F.xxhash64(F.col(c))
    sketch = lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col(c).isNotNull(), text(c)), F.lit(SKETCH_BITS)))
    seen = df.agg(*(F.coalesce(sketch(c), F.lit(0)).alias(c) for c in names)).head()
    near = [c for c in names if abs(seen[c] - threshold) <= max(SKETCH_MARGIN * threshold, 2)]
    counted = df.agg(*(F.count_distinct(c).alias(c) for c in near)).head() if near else {}
    rows = [(c, int(counted[c] if c in near else seen[c]), c in near) for c in names]
    rows = [(c, "categorical" if n <= threshold else "continuous", n, exact) for c, n, exact in rows]
    return df.sparkSession.createDataFrame(rows, "column string, kind string, distinct_values long, exact boolean")


#: Log of a sketch's registers; its error is 0.8 % on average. How far from the threshold an estimate is trusted, more than ten times that.
SKETCH_BITS, SKETCH_MARGIN = 14, 0.1


def cardinality_report(df: DataFrame, threshold: int, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values and a type for each column: ``categorical`` up to the threshold.

    One aggregate over the table for all columns, not one job each.
    """
    names = list(cols or df.columns)
    one = df.agg(*(F.count_distinct(c).alias(c) for c in names))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values")) for c in names)))
    kind = F.when(F.col("distinct_values") <= threshold, "categorical").otherwise("continuous")
    return one.select(pairs.alias("p")).select("p.*").withColumn("kind", kind)


def time_folds(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """Rolling-origin folds: (fold, part, row columns); fold k trains on the first k blocks and is valid on the next.

    Blocks are even shares of the distinct groups by date. The groups are dealt out
    by ranges and numbered within each; the ranges' counts, a number for each
    partition, give what comes before it. So no task sees all groups.
    """
    groups = df.groupBy(group).agg(F.min(order).alias("__at"))
    total = groups.agg(F.count(F.lit(1)).alias("__n"))
    dealt = groups.repartitionByRange("__at", group).withColumn("__p", F.spark_partition_id())
    # Stored, as a range's number must be the same for its count and its rows.
    dealt = stored(dealt, folder(df.sparkSession, "folds"))
    counts = dealt.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))
    listed = counts.agg(F.map_from_entries(F.collect_list(F.struct("__p", "__c"))).alias("__m"))
    before = F.aggregate(F.map_values(F.map_filter("__m", lambda p, _: p < F.col("__p"))), F.lit(0).cast("long"), lambda a, x: a + x)
    inner = F.row_number().over(Window.partitionBy("__p").orderBy("__at", group))
    numbered = dealt.crossJoin(F.broadcast(listed)).withColumn("__i", before + inner - 1).crossJoin(F.broadcast(total))
    blocks = n + 1
    size, rest = F.floor(F.col("__n") / blocks), F.col("__n") % blocks
    large = rest * (size + 1)
    block = F.when(F.col("__i") < large, F.floor(F.col("__i") / (size + 1))).otherwise(rest + F.floor(F.try_divide(F.col("__i") - large, size)))
    tagged = df.join(numbered.select(group, block.cast("int").alias("__b")), group)
    folds = tagged.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n)))).filter(F.col("__b") <= F.col("fold"))
    return folds.withColumn("part", F.when(F.col("__b") < F.col("fold"), "train").otherwise("valid")).drop("__b")


def trim_after_first(df: DataFrame, keys: Sequence[str], order: str, stop: Column) -> DataFrame:
    """Rows of each series up to and with the first that meets the condition."""
    first = F.min(F.when(stop, F.col(order))).over(Window.partitionBy(*keys))
    return df.withColumn("__stop", first).filter(F.col("__stop").isNull() | (F.col(order) <= F.col("__stop"))).drop("__stop")
