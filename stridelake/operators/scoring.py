"""Scoring and ranking mathematics: M1-M23."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions.clock import seconds
from stridelake.functions.numeric import clamp_to, inv_norm, rate
from stridelake.operators.cleaning import impute_ladder, with_global, with_group
from stridelake.operators.quantiles import exact_quantiles, with_quantiles
from stridelake.operators.windows import elapsed, rank_in_group, softmax


def class_multiplier(df: DataFrame, rating: str, race: Sequence[str], low: float = 0.95, high: float = 1.15, tasks: int | None = None) -> DataFrame:
    """Class rating scaled to [low, high] over the table, and half its distance from the median. Many rows may be dealt over so many ``tasks``."""
    df = df.withColumn("__r", F.col(rating).cast("double"))
    df = impute_ladder(df, ["__r"], race, tasks=tasks)
    df = with_global(df, {"__lo": F.min("__r"), "__hi": F.max("__r")})
    df = with_quantiles(df, (), ["__r"], (0.5,), "__md").withColumn("__md", F.get("__md__r", F.lit(0))).drop("__md__r")
    scaled = low + F.try_divide((F.col("__r") - F.col("__lo")) * (high - low), F.col("__hi") - F.col("__lo"))
    return df.withColumns({"class_multiplier": scaled, "class_offset": (F.col("__r") - F.col("__md")) / 2}).drop("__r", "__lo", "__hi", "__md")


def raw_performance(df: DataFrame, par: Sequence[str], distance: str, time: str, ran: str, beaten: str, alpha: float = 50.0) -> DataFrame:
    """Speed x wide factor x class multiplier x (1 + alpha x par ratio), less a penalty of 10 at most."""
    df = with_group(df, par, {"par_time": F.avg(time)})
    ratio = F.try_divide(F.col("par_time") - F.col(time), F.col("par_time"))
    score = F.try_divide(F.col(distance), F.col(time)) * F.try_divide(F.col(distance), F.col(ran)) * F.col("class_multiplier") * (1 + alpha * ratio)
    return df.withColumns({"par_diff_ratio": ratio, "raw_performance": score - F.least(F.col(beaten) * 0.25, F.lit(10.0))})


def speed_index(df: DataFrame, entity: Sequence[str], col: str, slope: float = 1.0, eps: float = 1e-6) -> DataFrame:
    """z-score in the entity, logistic, clamped, through the inverse normal to 100 + 15 z in [0, 200].

    An entity without spread, or with one row, has z = 0.
    """
    df = with_group(df, entity, {"__m": F.avg(col), "__d": F.coalesce(F.stddev_samp(col), F.lit(0.0))})
    df = df.withColumn("z", F.when(F.col("__d") == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(col) - F.col("__m"), F.col("__d"))))
    share = clamp_to(1 / (1 + F.exp(-slope * F.col("z"))), eps, 1 - eps)
    return df.withColumn("__p", share).withColumn("speed_index", clamp_to(100 + 15 * inv_norm(F.col("__p")), 0.0, 200.0)).drop("__m", "__d", "__p")


def gps_composite(points: DataFrame, gates: DataFrame, keys: Sequence[str], ts: str, speed: str, stride: str, progress: str, gate: str, duration: str, ran: str, strides: str, back: str, sprint: float = 200.0, line: float = 1.0) -> DataFrame:
    """Inputs of a composite figure: times to the line and the sprint, sprint means, stride efficiency, beaten lengths.

    One conditional aggregate for each side, joined on the entry.
    """
    timed = elapsed(points, keys, ts, "__t")
    near = F.col(progress) <= sprint
    of_points = timed.groupBy(*keys).agg(
        F.min(F.when(F.col(progress) <= line, F.col("__t"))).alias("time_to_finish"), F.min(F.when(near, F.col("__t"))).alias("time_to_sprint"),
        F.avg(speed).alias("avg_speed"), F.stddev_samp(speed).alias("speed_stddev"), F.avg(stride).alias("avg_stride_freq"), F.avg(progress).alias("progress_rate"),
        F.avg(F.when(near, F.col(speed))).alias("final_sprint_speed"), F.avg(F.when(near, F.col(stride))).alias("sprint_stride_freq"),
    )
    of_gates = gates.groupBy(*keys).agg(
        F.avg(duration).alias("avg_sectional_time"), F.sum(ran).alias("total_distance"), F.avg(F.try_divide(F.col(ran), F.col(strides))).alias("stride_efficiency"),
        F.min(F.when(F.lower(gate) == "finish", F.col(back))).alias("beaten_lengths"),
    )
    return of_points.join(of_gates, list(keys), "full").filter(F.col("time_to_finish").isNotNull())


def time_to_reach(df: DataFrame, keys: Sequence[str], ts: str, speed: str, thresholds: Sequence[float]) -> DataFrame:
    """Seconds until the series first reaches each speed; null if it never does."""
    timed = elapsed(df, keys, ts, "__t")
    return timed.groupBy(*keys).agg(*(F.min(F.when(F.col(speed) >= t, F.col("__t"))).alias(f"t_{t:g}".replace(".", "_")) for t in thresholds))


def run_out(df: DataFrame, keys: Sequence[str], ts: str, speed: str, progress: str, within: float = 2.0, line: float = 1.0) -> DataFrame:
    """Mean speed in the seconds after the line is first reached."""
    at = seconds(ts)
    first = F.min(F.when(F.col(progress) <= line, at)).over(Window.partitionBy(*keys))
    after = df.withColumn("__d", at - first)
    return after.groupBy(*keys).agg(F.avg(F.when((F.col("__d") >= 0) & (F.col("__d") <= within), F.col(speed))).alias("run_out_speed"))


def peak(df: DataFrame, keys: Sequence[str], speed: str, stride: str, position: str, order: Sequence[str]) -> DataFrame:
    """Top speed, the stride at it (its first time), and the best position."""
    best = F.min_by(stride, F.struct((-F.col(speed)).alias("s"), *order))
    return df.groupBy(*keys).agg(F.max(speed).alias("peak_speed"), best.alias("stride_at_peak"), F.min(position).alias("best_position"))


def scaled_target(df: DataFrame, track: Sequence[str], race: Sequence[str], time: str, beaten: str | None = None, alpha: float = 0.1, lo: float = 40.0, hi: float = 120.0) -> DataFrame:
    """Par less effective time, scaled to [lo, hi] in each track; the par is the median winning time."""
    fastest = df.groupBy(*track, *race).agg(F.min(time).alias("__w"))
    winners = exact_quantiles(fastest, track, ["__w"], (0.5,)).select(*(F.col(f"__k{i}").alias(k) for i, k in enumerate(track)), F.get("__w", F.lit(0)).alias("par"))
    effective = F.col(time) + alpha * F.col(beaten) if beaten else F.col(time)
    joined = df.join(winners, list(track)).withColumn("speed_diff", F.col("par") - effective).filter(F.col("speed_diff").isNotNull())
    bounded = with_group(joined, track, {"__lo": F.min("speed_diff"), "__hi": F.max("speed_diff")})
    scaled = F.coalesce(lo + F.try_divide(F.col("speed_diff") - F.col("__lo"), F.col("__hi") - F.col("__lo")) * (hi - lo), F.lit(hi))
    return bounded.withColumn("target", scaled).drop("__lo", "__hi")


def ensemble(df: DataFrame, by: Sequence[str], item: str, model: str, score: str, models: Sequence[str]) -> DataFrame:
    """A column per model, their mean (null if one is missing), softmax in the race, and rank."""
    wide = df.groupBy(*by, item).agg(*(F.avg(F.when(F.col(model) == m, F.col(score))).alias(f"score_{m}") for m in models))
    mean = sum((F.col(f"score_{m}") for m in models), F.lit(0.0)) / len(models)
    shared = softmax(wide.withColumn("ensemble_score", mean), by, "ensemble_score", out="ensemble_prob")
    return rank_in_group(shared, by, [F.desc_nulls_last("ensemble_score"), item], out="ensemble_rank")


def fit_temperature(df: DataFrame, race: Sequence[str], score: str, win: str, low: float = 0.001, high: float = 100.0, steps: int = 16, rounds: int = 3) -> DataFrame:
    """Temperature with the least negative log likelihood of the winners, in [low, high].

    Each race becomes one row, its scores and its winners', which all rounds use.
    A grid on the logarithm is summed in one aggregate per round and refined around
    its best value; each round's state is one row. Returns temperature and nll.
    """
    eps = 1e-12
    cut = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.col(score)))
    races = df.groupBy(*race).agg(F.max(cut).alias("m"), F.collect_list(cut).alias("s"), F.collect_list(F.when(F.col(win) == 1, cut)).alias("w"))
    races = races.select(*(F.transform(c, lambda x: x - F.col("m")).alias(c) for c in ("s", "w"))).persist(StorageLevel.MEMORY_AND_DISK)
    lo, hi = low, high
    best = None
    for _ in range(rounds):
        grid = [lo * (hi / lo) ** (k / (steps - 1)) for k in range(steps)]
        got = races.agg(*(F.sum(_winner_loss(t, eps)).alias(f"l{k}") for k, t in enumerate(grid))).head()
        k = min(range(steps), key=lambda i: (got[f"l{i}"] if got[f"l{i}"] is not None else 0.0, i))
        best = (grid[k], got[f"l{k}"])
        lo, hi = grid[max(0, k - 1)], grid[min(steps - 1, k + 1)]
    races.unpersist()
    return df.sparkSession.createDataFrame([best], "temperature double, nll double")


def _winner_loss(temperature: float, eps: float) -> Column:
    """Negative log likelihood of a race's winners, ``w``, among its scores, ``s``."""
    total = F.aggregate("s", F.lit(eps), lambda a, x: a + F.exp(x / temperature))
    return F.aggregate("w", F.lit(0.0), lambda a, x: a - F.log(F.exp(x / temperature) / total + eps))


def calibrate(df: DataFrame, race: Sequence[str], score: str, temperature: float) -> DataFrame:
    """Calibrated probability and its logit."""
    out = softmax(df, race, score, temperature, "calibrated_prob")
    p = F.col("calibrated_prob")
    return out.withColumn("logit", F.log(p / (1 - p + 1e-12)))


def edge_kelly(df: DataFrame, p: str, ml: str, most: float = 0.999) -> DataFrame:
    """Edge over the morning line's probability, and the Kelly share, which may be negative."""
    line = F.least(F.col(ml), F.lit(most))
    gain = F.try_divide(F.lit(1.0), line) - 1
    return df.withColumns({"edge": F.col(p) - line, "kelly": F.try_divide(F.col(p) * gain - (1 - F.col(p)), gain)})


def rank_metrics(df: DataFrame, model: Sequence[str], race: Sequence[str], score: str, finish: str, tie: Sequence[str], min_field: int = 4) -> DataFrame:
    """Per model: top-1, top-3 and top-4 sets, exact order, top 3 in top 4, mean reciprocal rank, spread and errors.

    Errors and Spearman compare predicted rank with finish; races under
    ``min_field`` are left out. Ranks first, then one aggregate a race, then one a model.
    """
    keys = [*model, *race]
    ranked = rank_in_group(df, keys, [F.desc(score), *tie], out="__p")
    ranked = ranked.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).filter(F.col("__n") >= min_field)
    both = lambda a, b: F.count_if((F.col("__p") <= a) & (F.col(finish) <= b))
    races = ranked.groupBy(*keys).agg(
        both(1, 1).alias("top1"), both(3, 3).alias("top3"), both(4, 4).alias("top4"), both(4, 3).alias("box"),
        F.min((F.col("__p") == F.col(finish)).cast("int")).alias("exact"), F.max(F.when(F.col(finish) == 1, 1.0 / F.col("__p"))).alias("rr"),
        F.stddev_samp(score).alias("spread"),
    )
    out = races.groupBy(*model).agg(
        F.count(F.lit(1)).alias("races"), F.avg("top1").alias("top1_accuracy"), F.avg(F.col("top3") / 3).alias("top3_share"), F.avg((F.col("top4") == 4).cast("int")).alias("top4_accuracy"),
        F.avg((F.col("box") == 3).cast("int")).alias("top3_in_top4"), F.avg("exact").alias("perfect_order"), F.avg("rr").alias("mrr"), F.avg("spread").alias("avg_score_std"),
    )
    error = F.col("__p") - F.col(finish)
    rows = ranked.groupBy(*model).agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.corr(F.col("__p").cast("double"), F.col(finish).cast("double")).alias("spearman"))
    return out.join(rows, list(model))


def ndcg(df: DataFrame, by: Sequence[str], rel: str, score: str, k: int) -> DataFrame:
    """NDCG at k with linear gain; tied scores share the mean gain of their places."""
    w = Window.partitionBy(*by)
    place = F.row_number().over(w.orderBy(F.desc(score)))
    ideal = F.row_number().over(w.orderBy(F.desc(rel)))
    discount = lambda r: F.when(F.col(r) <= k, F.lit(1.0) / F.log2(F.col(r) + 1)).otherwise(0.0)
    placed = df.withColumn("__r", place).withColumn("__i", ideal)
    tied = placed.groupBy(*by, score).agg(F.avg(rel).alias("__g"), F.sum(discount("__r")).alias("__d"))
    got = tied.groupBy(*by).agg(F.sum(F.col("__g") * F.col("__d")).alias("__dcg"))
    best = placed.groupBy(*by).agg(F.sum(F.col(rel) * discount("__i")).alias("__idcg"))
    return got.join(best, list(by)).select(*by, rate(F.col("__dcg"), F.col("__idcg")).alias("ndcg"))


def top4_summary(df: DataFrame, model: Sequence[str], race: Sequence[str], item: str, rank: str, finish: str, by: Sequence[str] = ()) -> DataFrame:
    """Races whose predicted first four are the actual ones in any order, and in exact order."""
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c) <= 4, F.struct(F.col(c).alias("r"), F.col(item).alias("i"))))), lambda x: x["i"])
    races = df.groupBy(*model, *race, *by).agg(listed(rank).alias("__p"), listed(finish).alias("__f")).filter((F.size("__p") == 4) & (F.size("__f") == 4))
    any_order = F.array_sort("__p") == F.array_sort("__f")
    out = races.groupBy(*model, *by).agg(F.count(F.lit(1)).alias("races"), F.count_if(any_order).alias("any_order"), F.count_if(F.col("__p") == F.col("__f")).alias("exact_order"))
    return out.withColumns({"any_pct": rate(F.col("any_order") * 100, F.col("races")), "exact_pct": rate(F.col("exact_order") * 100, F.col("races"))})


def position_accuracy(df: DataFrame, model: Sequence[str], rank: str, finish: str, k: int = 4) -> DataFrame:
    """Share of finishers of each place that were ranked there, a column for each place."""
    share = lambda i: rate(F.count_if((F.col(finish) == i) & (F.col(rank) == i)), F.count_if(F.col(finish) == i))
    return df.groupBy(*model).agg(*(share(i).alias(f"hit_rate_{i}") for i in range(1, k + 1)))


def exact_match_races(df: DataFrame, race: Sequence[str], rank: str, finish: str, n: int) -> DataFrame:
    """Rows ranked as they finished, of the races with exactly n of them."""
    exact = df.filter(F.col(rank) == F.col(finish))
    return exact.withColumn("__c", F.count(F.lit(1)).over(Window.partitionBy(*race))).filter(F.col("__c") == n).drop("__c")


def order_match(df: DataFrame, race: Sequence[str], score: str, finish: str, tie: Sequence[str], excluded: DataFrame | None = None) -> DataFrame:
    """Share of places that the score's order gets right in each race; races named as excluded are left out."""
    if excluded is not None:
        df = df.join(excluded.select(*race).distinct(), list(race), "left_anti")
    w = Window.partitionBy(*race)
    df = df.withColumns({"__p": F.row_number().over(w.orderBy(F.desc(score), *tie)), "__f": F.row_number().over(w.orderBy(finish, *tie))})
    return df.groupBy(*race).agg((F.avg((F.col("__p") == F.col("__f")).cast("int")) * 100).alias("match_pct"), F.count(F.lit(1)).alias("runners"))


def score_with(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Rows through the caller's model, a function of a pandas frame, in Arrow batches."""

    def run(batches):
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def stride_synergy(df: DataFrame, length: str, frequency: str, speed: str) -> DataFrame:
    """Length x frequency, frequency over length, and the product over speed; 0 where a divisor is."""
    product = F.col(length) * F.col(frequency)
    return df.withColumns({"stride_product": product, "stride_ratio": rate(F.col(frequency), F.col(length)), "stride_to_speed": rate(product, F.col(speed))})
