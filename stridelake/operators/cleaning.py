"""Imputation and cleaning: I1-I17."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions.numeric import clamp_to
from stridelake.functions.parsing import pad_array
from stridelake.operators.joins import add_group_stats, asof_join
from stridelake.operators.quantiles import exact_quantiles, with_quantiles
from stridelake.operators.sets import union_by_name
from stridelake.sources.shared import folder, stored


def with_global(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """One row of statistics of the whole table beside every row: an aggregate and a one-row broadcast."""
    return df.crossJoin(F.broadcast(df.agg(*(a.alias(n) for n, a in aggs.items()))))


#: Statistics of its group beside every row, for groups of any size.
with_group = add_group_stats


def impute_ladder(df: DataFrame, cols: Sequence[str], group: Sequence[str], stat: str = "mean", final: float | None = None, pre: Mapping[str, Column] | None = None, override: Column | None = None, override_value: float = 0.0, tasks: int | None = None) -> DataFrame:
    """Fill nulls by the group's statistic, then the table's, then a constant.

    ``override`` marks rows whose null is known to be ``override_value`` (a winner's
    margin); ``pre`` gives a value to try before the group, such as a carried one.
    Rows may be dealt over so many ``tasks`` where they meet their groups.
    """
    kinds = [("__g_", group)] * bool(group) + [("__a_", ())]
    for prefix, by in kinds:
        if stat == "median":
            df = with_quantiles(df, by, cols, (0.5,), prefix, tasks).withColumns({f"{prefix}{c}": F.get(f"{prefix}{c}", F.lit(0)) for c in cols})
        elif by:
            df = with_group(df, by, {f"{prefix}{c}": F.avg(c) for c in cols}, tasks)
        else:
            df = with_global(df, {f"{prefix}{c}": F.avg(c) for c in cols})
    out = {}
    for c in cols:
        steps = [F.col(c)]
        if override is not None:
            steps.append(F.when(override, F.lit(override_value)))
        if pre and c in pre:
            steps.append(pre[c])
        steps += [F.col(f"{prefix}{c}") for prefix, _ in kinds]
        if final is not None:
            steps.append(F.lit(final))
        out[c] = F.coalesce(*steps)
    return df.withColumns(out).drop(*(f"__{k}_{c}" for k in "ga" for c in cols))


def impute_median_date(df: DataFrame, col: str, default: str = "1970-01-01") -> DataFrame:
    """Fill a date by the median date of the table, or the default if there is none."""
    df = with_quantiles(df.withColumn("__d", F.unix_date(col)), (), ["__d"], (0.5,), "__m")
    median = F.date_from_unix_date(F.floor(F.get("__m__d", F.lit(0))).cast("int"))
    return df.withColumn(col, F.coalesce(col, median, F.lit(default).cast("date"))).drop("__m__d", "__d")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object], flags: bool = False) -> DataFrame:
    """Constants for nulls, and for blank texts; with flags, ``_was_missing`` columns."""
    out = {}
    for c, v in defaults.items():
        missing = F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
        out[c] = F.when(missing, F.lit(v)).otherwise(F.col(c))
        if flags:
            out[f"{c}_was_missing"] = missing.cast("int")
    return df.withColumns(out)


def complete_or_zero(df: DataFrame, flag: str, historic: object, cols: Sequence[str]) -> DataFrame:
    """Drop historic rows with a null among the columns; fill other rows' nulls with 0."""
    whole = F.lit(True)
    for c in cols:
        whole &= F.col(c).isNotNull()
    return df.filter((F.col(flag) != historic) | whole).withColumns({c: F.coalesce(c, F.lit(0)) for c in cols})


def finite_or_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN and infinities as null."""
    return df.withColumns({c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)) for c in cols})


def clamp(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Keep columns within fixed bounds; nulls stay."""
    return df.withColumns({c: clamp_to(F.col(c), lo, hi) for c, (lo, hi) in bounds.items()})


def clamp_quantile(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Keep columns within two of their exact percentiles, all found together."""
    df = with_quantiles(df, (), cols, (lo, hi), "__q_")
    return df.withColumns({c: clamp_to(F.col(c), F.get(f"__q_{c}", F.lit(0)), F.get(f"__q_{c}", F.lit(1))) for c in cols}).drop(*(f"__q_{c}" for c in cols))


def iqr(df: DataFrame, col: str, action: str = "list", k: float = 1.5, group: Sequence[str] = ()) -> DataFrame:
    """Outliers beyond k interquartile ranges: ``list`` them, ``remove`` them, ``cap`` them at the
    bounds, or ``mean`` to set them to the mean of their group's other values."""
    df = with_quantiles(df, (), [col], (0.25, 0.75), "__q_").withColumnRenamed(f"__q_{col}", "__q")
    q1, q3 = F.get("__q", F.lit(0)), F.get("__q", F.lit(1))
    low, high = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    outside = (F.col(col) < low) | (F.col(col) > high)
    if action == "list":
        out = df.filter(outside)
    elif action == "remove":
        out = df.filter(~F.coalesce(outside, F.lit(False)))
    elif action == "cap":
        out = df.withColumn(col, clamp_to(F.col(col), low, high))
    elif action == "mean":
        out = with_group(df, group, {"__inner": F.avg(F.when(~outside, F.col(col)))})
        out = out.withColumn(col, F.when(outside, F.col("__inner")).otherwise(F.col(col))).drop("__inner")
    else:
        raise ValueError(f"unknown action {action}")
    return out.drop("__q")


def seed_unseen(history: DataFrame, future: DataFrame, key: str, cols: Sequence[str], stat: str = "mean", flag: str = "first_time") -> DataFrame:
    """History and a row for each entity of the future that it lacks, with the table's statistics and a flag."""
    unseen = future.select(key).distinct().join(history.select(key).distinct(), key, "left_anti")
    if stat == "median":
        stats = exact_quantiles(history, (), cols, (0.5,)).select(*(F.get(c, F.lit(0)).alias(c) for c in cols))
    else:
        stats = history.agg(*(F.avg(c).alias(c) for c in cols))
    made = unseen.crossJoin(F.broadcast(stats)).withColumn(flag, F.lit(1))
    return union_by_name(history.withColumn(flag, F.lit(0)), made)


def carry_score(history: DataFrame, future: DataFrame, entity: str, date: str, score: str, race: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Score of future rows: the entity's latest at or before the date, else the race's median, else history's.

    Rows with the scores that they carry are stored, and medians of races of any
    size, those of a null race too, are joined back.
    """
    seen = asof_join(future, history.select(entity, F.col(date).alias("__d"), F.col(score).alias("__s")), [entity], date, "__d", ["__s"], tie=["__s"], tasks=tasks)
    seen = stored(seen, folder(future.sparkSession, "carried"))
    overall = exact_quantiles(history, (), [score], (0.5,)).select(F.get(score, F.lit(0)).alias("__all"))
    filled = with_quantiles(seen, race, ["__s"], (0.5,), "__of_race", tasks).join(F.broadcast(overall), how="left")  # one row
    return filled.withColumn(score, F.coalesce("__s", F.get("__of_race__s", F.lit(0)), "__all")).drop("__s", "__of_race__s", "__all")


def past_sequences(df: DataFrame, entity: Sequence[str], order: Sequence[str], cols: Sequence[str], most: int, least: int, filler: float = -999.0, out: str = "sequence") -> DataFrame:
    """The last ``most`` events before each row as an array of structs, filled up in front.

    Rows with fewer than ``least`` events before them are left out.
    """
    event = F.struct(*(F.col(c).cast("double").alias(c) for c in cols))
    w = Window.partitionBy(*entity).orderBy(*order).rowsBetween(-most, -1)
    blank = F.struct(*(F.lit(filler).alias(c) for c in cols))
    kept = df.withColumn(out, F.collect_list(event).over(w)).filter(F.size(out) >= least)
    return kept.withColumn("n_events", F.size(out)).withColumn(out, pad_array(F.col(out), most, blank, side="left"))


def cap_sequence(df: DataFrame, col: str, ps: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """Cap the items of an array column, place by place, at percentiles over all rows.

    Percentiles come from one aggregate on (place, value), and meet every row as one short array.
    """
    places = exact_quantiles(df.select(F.posexplode(col).alias("__i", "__v")), ["__i"], ["__v"], ps).select(F.col("__k0").alias("__i"), F.col("__v").alias("__q"))
    bounds = places.agg(F.map_from_entries(F.collect_list(F.struct("__i", "__q"))).alias("__b"))
    capped = F.transform(F.col(col), lambda v, i: clamp_to(v, F.element_at("__b", i)[0], F.element_at("__b", i)[1]))
    return df.crossJoin(F.broadcast(bounds)).withColumn(col, capped).drop("__b")


def encode_pipeline(cats: Sequence[str], nums: Sequence[str], scaler: str = "standard"):
    """An ML pipeline: index and one-hot texts, assemble and scale numbers. Fit it on the training split."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in cats]
    if cats:
        stages.append(OneHotEncoder(inputCols=[f"{c}_ix" for c in cats], outputCols=[f"{c}_hot" for c in cats]))
    stages.append(VectorAssembler(inputCols=list(nums), outputCol="__nums", handleInvalid="keep"))
    kind = {"standard": StandardScaler, "minmax": MinMaxScaler}[scaler]
    stages.append(kind(inputCol="__nums", outputCol="scaled"))
    stages.append(VectorAssembler(inputCols=[*(f"{c}_hot" for c in cats), "scaled"], outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages)
