"""Window operators: W1-W24."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions.clock import micros, seconds
from stridelake.functions.geometry import haversine, line_lengths, line_place
from stridelake.operators import hot_keys
from stridelake.operators.joins import add_group_stats


def _series(keys: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*keys).orderBy(*order)


def kinematics(df: DataFrame, keys: Sequence[str], order: Sequence[str], speed: str, ts: str | None = None, dt: str | None = None, truncate: bool = False) -> DataFrame:
    """Time step, acceleration, jerk and distance of each point against the one before.

    The step is the difference of ``ts`` in seconds, or a column ``dt``. A step of
    0 gives null rates; the first point has none. ``truncate`` counts whole seconds.
    """
    w = _series(keys, order)
    if dt is None:
        at = F.floor(seconds(ts)) if truncate else seconds(ts)
        df = df.withColumn("dt", at - F.lag(at).over(w))
    else:
        df = df.withColumn("dt", F.col(dt))
    df = df.withColumn("acceleration", F.try_divide(F.col(speed) - F.lag(speed).over(w), F.when(F.col("dt") != 0, F.col("dt")).cast("double")))
    jerk = F.try_divide(F.col("acceleration") - F.lag("acceleration").over(w), F.when(F.col("dt") != 0, F.col("dt")).cast("double"))
    return df.withColumns({"jerk": jerk, "distance_segment": F.col(speed) * F.col("dt")})


def previous_event(df: DataFrame, entity: Sequence[str], order: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Columns of the entity's previous event, with sentinels, and event counts in all and before."""
    w = _series(entity, order)
    out = {f"prev_{c}": F.coalesce(F.lag(c).over(w), F.lit(v)) for c, v in defaults.items()}
    out["prior_count"] = F.row_number().over(w) - 1
    counted = add_group_stats(df.withColumns(out), entity, {"total_count": F.count(F.lit(1))})
    return counted.select(*df.columns, *(f"prev_{c}" for c in defaults), "total_count", "prior_count")


def prior_n(df: DataFrame, entity: Sequence[str], order: Sequence[str], n: int, aggs: Mapping[str, Column], hot_rows: int | None = None) -> DataFrame:
    """Aggregates over the n events before the current one, which is never in them.

    With ``hot_rows`` an entity of more rows is dealt over tasks by slots of the
    first ordering column, each led by copies of the n rows before it.
    """
    if hot_rows is None:
        w = _series(entity, order).rowsBetween(-n, -1)
        return df.withColumns({name: agg.over(w) for name, agg in aggs.items()})
    rows = hot_keys.with_rows_before(hot_keys.deal_out(df, entity, order[0], hot_rows), entity, order, n)
    w = _series([*entity, "__slot"], order).rowsBetween(-n, -1)
    return rows.withColumns({name: agg.over(w) for name, agg in aggs.items()}).filter("not __copy").drop("__slot", "__hot", "__copy")


def prior_avg_where(df: DataFrame, entity: Sequence[str], order: Sequence[str], n: int, cols: Sequence[str]) -> DataFrame:
    """Averages of the last n values that are neither null nor 0, among the n events before."""
    return prior_n(df, entity, order, n, {f"avg_{c}_{n}": F.avg(F.when(F.col(c) != 0, F.col(c))) for c in cols})


def prior_delta(df: DataFrame, entity: Sequence[str], order: Sequence[str], col: str, out: str) -> DataFrame:
    """Last value less the one before: 0 with one prior event, null with none."""
    w = _series(entity, order)
    one, two = F.lag(col, 1).over(w), F.lag(col, 2).over(w)
    return df.withColumn(out, F.when(one.isNull(), None).when(two.isNull(), F.lit(0).cast("double")).otherwise((one - two).cast("double")))


def days_since(df: DataFrame, entity: Sequence[str], order: Sequence[str], date: str) -> DataFrame:
    """Days since the previous event, and its layoff category."""
    days = F.datediff(F.col(date), F.lag(date).over(_series(entity, order)))
    df = df.withColumn("days_off", days)
    return df.withColumn("layoff", F.when(F.col("days_off").isNull(), "N/A").when(F.col("days_off") <= 14, "short").when(F.col("days_off") <= 45, "medium").otherwise("long"))


def topk_agg(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], k: int, aggs: Sequence[Column]) -> DataFrame:
    """Aggregates over the first k rows of each group."""
    ranked = df.withColumn("__rn", F.row_number().over(_series(by, order)))
    return ranked.filter(F.col("__rn") <= k).groupBy(*by).agg(*aggs)


def locf(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], include_current: bool = False, suffix: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Last value that is not null: strictly before (``_prev``), or up to the row itself (``_ffill``).

    With ``hot_rows`` a group of more rows is dealt over tasks by slots of the first
    ordering column, and the last values of the slots before are carried in.
    """
    ends = (Window.unboundedPreceding, 0 if include_current else -1)
    tail = suffix or ("_ffill" if include_current else "_prev")
    if hot_rows is None:
        w = _series(by, order).rowsBetween(*ends)
        return df.withColumns({c + tail: F.last(c, ignorenulls=True).over(w) for c in cols})
    dealt = hot_keys.carried(hot_keys.deal_out(df, by, order[0], hot_rows), by, order, {f"__last_{c}": F.col(c) for c in cols})
    w = _series([*by, "__slot"], order).rowsBetween(*ends)
    filled = dealt.withColumns({c + tail: F.coalesce(F.last(c, ignorenulls=True).over(w), f"__last_{c}") for c in cols})
    return filled.drop("__slot", "__hot", *(f"__last_{c}" for c in cols))


def fill_both(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Fill forward, then what is left backward.

    Only values before the first known one are filled backward, so that value is one
    aggregate of the group, joined back. With ``hot_rows`` a group of more rows is
    dealt over tasks, as in ``locf``.
    """
    filled = locf(df, by, order, cols, include_current=True, suffix="__ahead", hot_rows=hot_rows)
    place = F.struct(*order)
    filled = add_group_stats(filled, by, {f"__first_{c}": F.min_by(c, F.when(F.col(c).isNotNull(), place)) for c in cols})
    return filled.withColumns({c: F.coalesce(f"{c}__ahead", f"__first_{c}") for c in cols}).select(*df.columns)


def gate_spans(df: DataFrame, keys: Sequence[str], order: Sequence[str], duration: str, t0: str) -> DataFrame:
    """Half-open spans [start, end) of gates: a running sum of durations on a start time."""
    w = _series(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(F.coalesce(duration, F.lit(0.0))).over(w)
    df = df.withColumn("__upto", upto)
    add = lambda s: F.col(t0) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s.cast("decimal(18,6)"))
    return df.withColumns({"span_end": add(F.col("__upto")), "span_start": add(F.coalesce(F.lag("__upto").over(_series(keys, order)), F.lit(0.0)))}).drop("__upto")


def fatigue(df: DataFrame, keys: Sequence[str], order: Sequence[str], speed: str) -> DataFrame:
    """Extremes of a series, flags of the fastest and slowest gate, and how far the last falls short of the best."""
    whole = Window.partitionBy(*keys)
    last = F.last(speed).over(_series(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    df = df.withColumns({"max_speed": F.max(speed).over(whole), "min_speed": F.min(speed).over(whole), "final_speed": last})
    return df.withColumns({
        "is_fastest": F.when(F.col(speed) == F.col("max_speed"), 1).otherwise(0),
        "is_slowest": F.when(F.col(speed) == F.col("min_speed"), 1).otherwise(0),
        "fatigue_factor": F.when(F.col("max_speed") > 0, (F.col("max_speed") - F.col("final_speed")) / F.col("max_speed")),
    })


def path_length(df: DataFrame, keys: Sequence[str], order: Sequence[str], lon: str = "lon", lat: str = "lat", straight: str | None = None) -> DataFrame:
    """Metres run so far along the points, and the loss against a straight distance if one is given."""
    w = _series(keys, order)
    step = haversine(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))
    df = df.withColumn("step_m", F.coalesce(step, F.lit(0.0)))
    df = df.withColumn("path_m", F.sum("step_m").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.withColumn("ground_loss_m", F.col("path_m") - F.col(straight)) if straight else df


def place_on_route(df: DataFrame, routes: DataFrame, on: str, keys: Sequence[str], order: Sequence[str], lon: str = "lon", lat: str = "lat", line: str = "line") -> DataFrame:
    """Where on its route each point of a series is: offset_m, along_m, progress_m, path_m and ground_loss_m.

    ``routes`` has one line for each value of ``on``. A point is projected on the
    line, ``along_m`` from its start. A series does not run back: ``progress_m`` is
    the farthest place so far. ``ground_loss_m`` is what was run more than gained,
    both since the first point that has a place. Points without a place or route
    have nulls and the progress so far.
    """
    known = routes.select(on, F.col(line).alias("__line"), line_lengths(F.col(line)).alias("__lengths"))
    placed = df.join(known, on, "left").withColumn("__p", line_place(F.col(lon), F.col(lat), F.col("__line"), F.col("__lengths"))).drop("__line", "__lengths")
    w = _series(keys, order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    out = path_length(placed.withColumns({"offset_m": F.col("__p.offset_m"), "along_m": F.col("__p.along_m")}).drop("__p"), keys, order, lon, lat)
    out = out.withColumn("progress_m", F.max("along_m").over(upto))
    first = lambda c: F.first(F.when(F.col("along_m").isNotNull(), F.col(c)), ignorenulls=True).over(upto)
    return out.withColumn("ground_loss_m", (F.col("path_m") - first("path_m")) - (F.col("progress_m") - first("along_m"))).drop("step_m")


def running_speed(df: DataFrame, keys: Sequence[str], order: Sequence[str], distance: str, duration: str, digits: int = 2) -> DataFrame:
    """Average speed of each section and of all up to it, and the change of the former."""
    w = _series(keys, order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({
        "section_speed": F.round(F.try_divide(F.col(distance), F.col(duration)), digits),
        "running_speed": F.round(F.try_divide(F.sum(distance).over(upto), F.sum(duration).over(upto)), digits),
    })
    return df.withColumn("speed_change", F.round(F.col("section_speed") - F.lag("section_speed").over(w), digits))


def rank_in_group(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], method: str = "row_number", k: int | None = None, out: str = "rank") -> DataFrame:
    """Rank within a group, by row_number, rank or dense_rank; the first k only, if given."""
    kinds = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}
    ranked = df.withColumn(out, kinds[method]().over(_series(by, order)))
    return ranked if k is None else ranked.filter(F.col(out) <= k)


def softmax(df: DataFrame, by: Sequence[str], score: str, temperature: float | Column = 1.0, out: str = "prob") -> DataFrame:
    """Share of exp(score / T) in its group; scores are cut to +-50 and held against the group's best."""
    w = Window.partitionBy(*by)
    cut = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col(score)))
    df = df.withColumn("__e", F.exp((F.when(F.col(score).isNotNull(), cut) - F.max(cut).over(w)) / temperature))
    return df.withColumn(out, F.col("__e") / F.sum("__e").over(w)).drop("__e")


def score_gaps(df: DataFrame, by: Sequence[str], p: str, odds: str, tie: Sequence[str]) -> DataFrame:
    """Race-level gaps of a probability: best, second, their gap, deviation, favourite's and mean odds.

    Per runner: the gap to the leader, and to the next one; the last has -1.
    """
    w = Window.partitionBy(*by)
    ordered = w.orderBy(F.desc(p), *tie)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    second = F.coalesce(F.nth_value(p, 2).over(whole), F.lit(0.0))
    df = df.withColumns({"max_prob": F.max(p).over(w), "second_prob": second, "std_prob": F.stddev_pop(p).over(w), "fav_odds": F.min(odds).over(w), "avg_odds": F.avg(odds).over(w)})
    return df.withColumns({
        "prob_gap": F.col("max_prob") - F.col("second_prob"),
        "leader_gap": F.col("max_prob") - F.col(p),
        "trailing_gap": F.coalesce(F.col(p) - F.lead(p).over(ordered), F.lit(-1.0)),
    })


def running_ledger(df: DataFrame, by: Sequence[str], order: Sequence[str], cost: str = "cost", payoff: str = "payoff") -> DataFrame:
    """Bet number, cost, payoff, net and return so far; the order must be unique.

    The rows of each value of the first order column are summed first; the sums
    so far and the rows' places within that value add up. So a group is dealt over
    the values of that column, such as its days or races.
    """
    coarse, keys = order[0], [*by, order[0]]
    sums = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.count(F.lit(1)).alias("__n"), F.sum(cost).alias("__cost"), F.sum(payoff).alias("__payoff"))
    prior = Window.partitionBy(*(f"__{k}" for k in by)).orderBy(f"__{coarse}").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({c: F.coalesce(F.sum(c).over(prior), F.lit(0)) for c in ("__n", "__cost", "__payoff")})
    upto = _series(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    own = df.withColumns({"bet_no": F.row_number().over(_series(keys, order)), "cum_cost": F.sum(cost).over(upto), "cum_payoff": F.sum(payoff).over(upto)})
    joined = own.join(sums, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    added = {"bet_no": F.col("bet_no") + F.col("__n"), "cum_cost": F.coalesce("cum_cost", F.lit(0)) + F.col("__cost"), "cum_payoff": F.coalesce("cum_payoff", F.lit(0)) + F.col("__payoff")}
    df = joined.withColumns(added).drop("__n", "__cost", "__payoff", *(f"__{k}" for k in keys))
    df = df.withColumn("cum_net", F.col("cum_payoff") - F.col("cum_cost"))
    return df.withColumn("cum_roi", F.try_divide(F.col("cum_net"), F.col("cum_cost")))


def field_size(df: DataFrame, by: Sequence[str], out: str = "field_size") -> DataFrame:
    """Rows in the group."""
    return add_group_stats(df, by, {out: F.count(F.lit(1))})


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "gate_index") -> DataFrame:
    """1, 2, ... within a series."""
    return df.withColumn(out, F.row_number().over(_series(keys, order)))


def order_finish(df: DataFrame, keys: Sequence[str], gate: str, finish: float = 9999.0, out: str = "gate_order") -> DataFrame:
    """Gate order with the finish half a gate after the last other one."""
    last = F.max(F.when(F.col(gate) != finish, F.col(gate))).over(Window.partitionBy(*keys))
    return df.withColumn(out, F.when(F.col(gate) == finish, F.coalesce(last, F.lit(0.0)) + 0.5).otherwise(F.col(gate)))


def numbering_gaps(df: DataFrame, by: Sequence[str], num: str) -> DataFrame:
    """Rows of the groups whose numbers are not 1, 2, 3 and so on."""
    ranked = df.withColumn("expected", F.row_number().over(_series(by, [num])))
    bad = F.max(F.when(F.col(num) != F.col("expected"), 1).otherwise(0)).over(Window.partitionBy(*by))
    return ranked.withColumn("__bad", bad).filter("__bad = 1").drop("__bad")


def elapsed(df: DataFrame, keys: Sequence[str], ts: str, out: str = "elapsed_s") -> DataFrame:
    """Seconds since the first row of the series."""
    return df.withColumn(out, (micros(ts) - F.min(micros(ts)).over(Window.partitionBy(*keys))) / F.lit(1e6))
