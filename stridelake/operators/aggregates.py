"""Aggregation: A1-A28."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.functions.geometry import haversine
from stridelake.functions.numeric import rate
from stridelake.operators.cleaning import with_group
from stridelake.operators.joins import add_group_stats
from stridelake.operators.quantiles import exact_quantiles
from stridelake.operators.sets import dealt


def ntile_pivot(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, aggs: Mapping[str, Column]) -> DataFrame:
    """Cut each series in n even parts and aggregate each part: name_q1 .. name_qn.

    Conditional aggregates over one window on the same keys: one shuffle, no pivot.
    The columns of ``aggs`` are plain expressions; ``sum_`` names are summed, others averaged.
    """
    parts = df.withColumn("__q", F.ntile(n).over(Window.partitionBy(*keys).orderBy(*order)))
    out = []
    for name, value in aggs.items():
        fold = F.sum if name.startswith("sum_") else F.avg
        out += [fold(F.when(F.col("__q") == q, value)).alias(f"{name}_q{q}") for q in range(1, n + 1)]
    return parts.groupBy(*keys).agg(*out)


def series_summary(df: DataFrame, keys: Sequence[str], ts: str, speed: str, stride: str, progress: str) -> DataFrame:
    """Per series: acceleration and jerk, distance, deviation, stride length and net progress.

    Needs the columns of ``kinematics``. First and last are by time, in any plan.
    """
    return df.groupBy(*keys).agg(
        F.avg("acceleration").alias("avg_acceleration"),
        F.max("acceleration").alias("max_acceleration"),
        F.avg("jerk").alias("avg_jerk"),
        F.max("jerk").alias("max_jerk"),
        F.sum("distance_segment").alias("total_distance"),
        F.stddev_samp(speed).alias("speed_stddev"),
        F.avg(F.try_divide(F.col(speed), F.col(stride))).alias("avg_stride_length"),
        (F.max_by(progress, ts) - F.min_by(progress, ts)).alias("net_progress"),
    )


def gate_totals(df: DataFrame, keys: Sequence[str], distance: str, duration: str) -> DataFrame:
    """Distance, time and number of gates."""
    return df.groupBy(*keys).agg(F.sum(distance).alias("total_distance"), F.sum(duration).alias("total_time"), F.count(F.lit(1)).alias("gates"))


def gps_profile(df: DataFrame, keys: Sequence[str], speed: str, stride: str) -> DataFrame:
    """Mean, extremes and deviation of speed and stride; 0 where there is none."""
    out = df.groupBy(*keys).agg(
        F.avg(speed).alias("mean_speed"), F.min(speed).alias("min_speed"), F.max(speed).alias("max_speed"), F.stddev_samp(speed).alias("std_speed"),
        F.avg(stride).alias("mean_stride"), F.stddev_samp(stride).alias("std_stride"),
    )
    return out.fillna(0.0)


def gate_snapshots(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], filler: float = -999.0) -> DataFrame:
    """Columns at the first, middle (n div 2) and last gate of each series.

    A series is a race's gates, a few dozen rows, so it fits one array.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), *(F.col(c).cast("double").alias(c) for c in cols))))
    arrays = df.groupBy(*keys).agg(rows.alias("__g"))
    n = F.size("__g")
    places = {"first": F.lit(0), "mid": F.floor(n / 2).cast("int"), "last": n - 1}
    return arrays.select(*keys, *(F.coalesce(F.get("__g", i)[c], F.lit(filler)).alias(f"{where}_{c}") for where, i in places.items() for c in cols))


def interval_profile(df: DataFrame, keys: Sequence[str], ts: str, speed: str, stride: str, progress: str, lon: str, lat: str, least: int = 2) -> DataFrame:
    """Per gate: means, first and last progress and place, points, and whether there are enough."""
    first = lambda c: F.min_by(c, ts)
    last = lambda c: F.max_by(c, ts)
    out = df.groupBy(*keys).agg(
        F.avg(speed).alias("avg_speed"), F.avg(stride).alias("avg_stride"), first(progress).alias("first_progress"), last(progress).alias("last_progress"),
        first(lon).alias("first_lon"), last(lon).alias("last_lon"), first(lat).alias("first_lat"), last(lat).alias("last_lat"), F.count(F.lit(1)).alias("n_points"),
    )
    return out.withColumn("covered", (F.col("n_points") >= least).cast("int"))


def rollup_entries(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], statics: Sequence[str], order: str) -> DataFrame:
    """Race rows of gate rows: aggregates, and static columns from the first gate."""
    return df.groupBy(*keys).agg(*aggs, *(F.min_by(c, order).alias(c) for c in statics))


def net_sentiment(df: DataFrame, key: str, text: str, good: str = "[+", bad: str = "[-") -> DataFrame:
    """Comments with a good mark less those with a bad one."""
    has = lambda mark: F.count_if(F.contains(F.col(text), F.lit(mark)))
    return df.groupBy(key).agg((has(good) - has(bad)).alias("net_sentiment"))


def par_value(df: DataFrame, by: Sequence[str], col: str, out: str = "par") -> DataFrame:
    """Mean of the group's values that are neither null nor 0, to two places, beside each row."""
    return with_group(df, by, {out: F.round(F.avg(F.when(F.col(col) != 0, F.col(col))), 2)})


def finish_time(df: DataFrame, keys: Sequence[str], running: str) -> DataFrame:
    """Longest running time of each entry."""
    return df.groupBy(*keys).agg(F.max(running).alias("finish_time"))


def career_stats(events: DataFrame, entity: Sequence[str], date: str, outcome: str, amount: str, by: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """Starts, finishes in the first four and earnings strictly before each date, by entity and more columns.

    Events of a date are summed first, map-side; then one range window over the
    days before. So no event of the date itself counts, and no dates are looped over.
    Many events may be dealt over so many ``tasks``, by days first, so that a hot entity is too.
    """
    keys = [*entity, *by]
    at = lambda k: F.count_if(F.col(outcome) == k)
    daily = dealt(events, tasks, *keys, date).groupBy(*keys, date).agg(
        F.count(F.lit(1)).alias("n"), at(1).alias("w"), at(2).alias("p"), at(3).alias("s"), at(4).alias("f"), F.sum(amount).alias("e"),
        *(F.sum(F.when(F.col(outcome) == k, F.col(amount))).alias(f"e{k}") for k in (1, 2, 3, 4)),
    )
    w = Window.partitionBy(*keys).orderBy(F.unix_date(date)).rangeBetween(Window.unboundedPreceding, -1)
    upto = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
    names = {"n": "starts", "w": "wins", "p": "places", "s": "shows", "f": "fourths", "e": "earnings", "e1": "earnings_1", "e2": "earnings_2", "e3": "earnings_3", "e4": "earnings_4"}
    out = dealt(daily, tasks, *keys).select(*keys, F.col(date).alias("as_of_date"), *(upto(c).alias(name) for c, name in names.items()))
    return out.withColumns({"win_pct": rate(F.col("wins"), F.col("starts")), "itm_pct": rate(F.col("wins") + F.col("places") + F.col("shows"), F.col("starts"))})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself; raises if a key repeats."""
    found = duplicate_keys(df, keys).limit(3).collect()
    if found:
        raise ValueError(f"keys {list(keys)} repeat, as in {found}")
    return df


def health_check(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, NaNs, blanks, and mean and extremes of numbers; one pass over the table."""
    parts = []
    for f in df.schema:
        c = F.col(f.name)
        number = isinstance(f.dataType, T.NumericType)
        real = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        text = isinstance(f.dataType, T.StringType)
        none = F.lit(None).cast("double")
        value = F.when(~F.isnan(c), c) if real else c
        parts.append(F.struct(
            F.lit(f.name).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_null"),
            (F.count_if(F.isnan(c)) if real else F.lit(0).cast("long")).alias("n_nan"),
            (F.count_if(F.trim(c) == "") if text else F.lit(0).cast("long")).alias("n_blank"),
            (F.avg(value).cast("double") if number else none).alias("mean"),
            (F.min(value).cast("double") if number else none).alias("min"), (F.max(value).cast("double") if number else none).alias("max"),
        ))
    return df.agg(F.array(*parts).alias("all")).select(F.explode("all").alias("r")).select("r.*")


def fit_quality(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation and root mean square error of two columns."""
    return df.agg(F.corr(x, y).alias("correlation"), F.sqrt(F.avg(F.pow(F.col(x) - F.col(y), F.lit(2)))).alias("rmse"))


def group_summary(df: DataFrame, grains: Sequence[Sequence[str]], col: str) -> DataFrame:
    """Count, mean, deviation and extremes at several grains at once, by grouping sets."""
    keys = list(dict.fromkeys(k for g in grains for k in g))
    sets = [[F.col(k) for k in g] for g in grains]
    return df.groupingSets(sets, *keys).agg(
        F.grouping_id(*keys).cast("long").alias("grain"), F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"),
    )


def roi_rollup(df: DataFrame, by: Sequence[str], cube: bool = False, cost: str = "cost", payoff: str = "payoff", hit: str = "hit") -> DataFrame:
    """Bets, wins, cost, payoff, net, return and hit rate by any dimensions, or all their subsets."""
    grouped = df.cube(*by) if cube else df.groupBy(*by)
    out = grouped.agg(F.count(F.lit(1)).alias("bets"), F.sum(F.col(hit).cast("long")).alias("wins"), F.sum(cost).alias("cost"), F.sum(payoff).alias("payoff"))
    out = out.withColumn("net", F.col("payoff") - F.col("cost"))
    return out.withColumns({"roi": F.try_divide(F.col("net"), F.col("cost")), "hit_rate": rate(F.col("wins"), F.col("bets"))})


def bucket_of(col: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound that a value does not exceed, else the last label."""
    out = F.lit(None).cast("string")
    picks = None
    for b, label in zip(bounds, labels, strict=False):
        picks = F.when(col <= b, label) if picks is None else picks.when(col <= b, label)
    return F.when(col.isNull(), out).otherwise(picks.otherwise(labels[-1]))


def threshold_sweep(df: DataFrame, col: str, grid: Sequence[float], cost: str = "cost", payoff: str = "payoff") -> DataFrame:
    """Return of the rows over each threshold of a grid.

    Each row falls in one step of the grid; steps are summed once, so rows are not
    multiplied by the grid, and the few step sums are added up.
    """
    levels = sorted(set(grid))
    at = sum((F.when(F.col(col) > g, 1).otherwise(0) for g in levels), F.lit(0))
    steps = df.groupBy(at.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.sum(cost).alias("c"), F.sum(payoff).alias("p"))
    wanted = F.explode(F.array(*(F.struct(F.lit(float(g)).alias("threshold"), F.lit(k + 1).alias("least")) for k, g in enumerate(levels))))
    spread = steps.select("*", wanted.alias("w"))
    over = F.col("step") >= F.col("w.least")
    take = lambda c: F.sum(F.when(over, F.col(c)).otherwise(0))
    out = spread.groupBy(F.col("w.threshold").alias("threshold")).agg(take("n").alias("bets"), take("c").alias("cost"), take("p").alias("payoff"))
    return out.withColumn("roi", F.try_divide(F.col("payoff") - F.col("cost"), F.col("cost")))


def distribution_by(df: DataFrame, by: Sequence[str], cols: Sequence[str], ps: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Mean and exact percentiles of columns by group."""
    means = df.groupBy(*by).agg(*(F.avg(c).alias(f"{c}_mean") for c in cols))
    found = exact_quantiles(df, by, cols, ps).withColumnsRenamed({c: f"__q_{c}" for c in cols})
    joined = means.join(found, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(by)], "left") if by else means.join(F.broadcast(found), how="left")
    parts = [x for c in cols for x in (F.col(f"{c}_mean"), *(F.get(f"__q_{c}", F.lit(k)).alias(f"{c}_p{round(p * 100)}") for k, p in enumerate(ps)))]
    return joined.select(*by, *parts)


def histogram_share(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """How many groups have each number of distinct items, and their share of all in percent."""
    sizes = df.groupBy(*keys).agg(F.count_distinct(item).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("groups"))
    total = sizes.agg(F.sum("groups").alias("__all"))
    return sizes.crossJoin(F.broadcast(total)).select("size", "groups", (F.col("groups") * 100.0 / F.col("__all")).alias("share_pct"))


def position_bias(df: DataFrame, pos: str, outcome: str) -> DataFrame:
    """Mean, median, deviation and count of an outcome by position, and the mean's bias against all rows."""
    by = df.groupBy(pos).agg(F.avg(outcome).alias("mean"), F.stddev_samp(outcome).alias("std"), F.count(outcome).alias("n"))
    medians = exact_quantiles(df, [pos], [outcome], (0.5,)).select("__k0", F.get(outcome, F.lit(0)).alias("median"))
    by = by.join(medians, F.col(pos).eqNullSafe(F.col("__k0")), "left").select(pos, "mean", "median", "std", "n")
    overall = df.agg(F.avg(outcome).alias("__all"))
    return by.crossJoin(F.broadcast(overall)).withColumn("bias", F.col("mean") - F.col("__all")).drop("__all")


def cross_tab(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Counts by row and the stated values of a column."""
    return df.groupBy(row).agg(*(F.count_if(F.col(col) == v).alias(f"{col}_{v}") for v in values))


def arm_rewards(bets: DataFrame, races: DataFrame, key: Sequence[str], arm: str, reward: str) -> DataFrame:
    """Net reward of each arm in each race, and a ``no_bet`` row of 0 for every race."""
    own = bets.groupBy(*key, F.col(arm).alias("arm")).agg(F.sum(reward).alias("reward"))
    none = races.select(*key).distinct().withColumns({"arm": F.lit("no_bet"), "reward": F.lit(0.0)})
    return own.unionByName(none)


def race_context(df: DataFrame, key: Sequence[str], odds: str, prob: str, ddof: int = 1) -> DataFrame:
    """Field size, lowest and mean odds, best and second probability, their gap and deviation.

    A field is the runners of one race, a few dozen, so its list fits a row.
    """
    dev = F.stddev_samp if ddof else F.stddev_pop
    out = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("field_size"), F.min(odds).alias("min_odds"), F.avg(odds).alias("mean_odds"),
        F.slice(F.sort_array(F.collect_list(prob), asc=False), 1, 2).alias("__top"), F.coalesce(dev(prob), F.lit(0.0)).alias("std_prob"),
    )
    out = out.withColumns({"max_prob": F.get("__top", F.lit(0)), "second_prob": F.coalesce(F.get("__top", F.lit(1)), F.lit(0.0))})
    return out.withColumn("prob_gap", F.col("max_prob") - F.col("second_prob")).drop("__top")


def full_coverage(df: DataFrame, by: Sequence[str], flag: str) -> DataFrame:
    """Rows of the groups in which every row has the flag."""
    worst = F.min(F.coalesce(F.col(flag).cast("int"), F.lit(0)))
    return add_group_stats(df, by, {"__w": worst}).filter("__w = 1").drop("__w")


def bin_counts(df: DataFrame, col: str, width: float) -> DataFrame:
    """Rows in bins of a fixed width, by the bin's lower bound."""
    return df.filter(F.col(col).isNotNull()).groupBy((F.floor(F.col(col) / width) * width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def route_length(lines: DataFrame, keys: Sequence[str], line: str = "line") -> DataFrame:
    """Metres along each route's points, inside the row's own array."""
    nxt = F.slice(F.col(line), 2, 1 << 20)
    legs = F.zip_with(F.slice(F.col(line), 1, F.greatest(F.size(line) - 1, F.lit(0))), nxt, lambda p, q: haversine(p["lat"], p["lon"], q["lat"], q["lon"]))
    return lines.select(*keys, F.aggregate(legs, F.lit(0.0), lambda a, x: a + x).alias("route_m"))


def route_efficiency(paths: DataFrame, routes: DataFrame, on: Sequence[str], path: str = "path_m") -> DataFrame:
    """Route length over the path that was run; null without a path."""
    return paths.join(routes, list(on)).withColumn("efficiency", F.try_divide(F.col("route_m"), F.col(path)))
