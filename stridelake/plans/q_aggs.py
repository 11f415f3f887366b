"""Queries of aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.operators import aggregates as A
from stridelake.operators.windows import kinematics, path_length
from stridelake.plans.q_joins import ROUTES, routes
from stridelake.plans.q_windows import KINEMATICS, SERIES
from stridelake.plans.roles import POINTS, RUNNERS, Group, points, rounded, runner_tasks, runners, table

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R, P = f"WITH {RUNNERS}", f"WITH {POINTS}"


@add("a1_ntile_pivot", P + f", q AS (SELECT *, ntile(4) OVER ({SERIES}) AS q FROM points) SELECT runner, "
  + ", ".join(f"round(avg(CASE WHEN q = {i} THEN speed END), 6) AS speed_q{i}, round(sum(CASE WHEN q = {i} THEN stride END), 6) AS sum_stride_q{i}" for i in range(1, 5)) + " FROM q GROUP BY runner")
def _(spark, d):
    out = A.ntile_pivot(points(spark, d), ["runner"], ["ts", "id"], 4, {"speed": F.col("speed"), "sum_stride": F.col("stride")})
    return rounded(out, *(c for c in out.columns if c != "runner"))


@add("a2_series_summary", f"""{P}, {KINEMATICS} SELECT runner, round(avg(acceleration), 6) AS avg_acceleration, round(max(acceleration), 6) AS max_acceleration, round(avg(jerk), 6) AS avg_jerk, round(max(jerk), 6) AS max_jerk,
  round(sum(distance_segment), 2) AS total_distance, round(stddev_samp(speed), 6) AS speed_stddev, round(avg(speed / stride), 6) AS avg_stride_length, arg_max(id, ts) - arg_min(id, ts) AS net_progress FROM k GROUP BY runner""")  # fmt: skip
def _(spark, d):
    k = kinematics(points(spark, d), ["runner"], ["ts", "id"], "speed", "ts")
    out = A.series_summary(k, ["runner"], "ts", "speed", "stride", "id")
    return rounded(rounded(out, "avg_acceleration", "max_acceleration", "avg_jerk", "max_jerk", "speed_stddev", "avg_stride_length"), "total_distance", digits=2)


@add("a3_gate_totals", P + " SELECT runner, round(sum(speed), 4) AS total_distance, round(sum(stride), 4) AS total_time, count(*) AS gates FROM points WHERE kind IN ('click', 'view') GROUP BY runner")
def _(spark, d):
    return rounded(A.gate_totals(points(spark, d).filter("kind in ('click', 'view')"), ["runner"], "speed", "stride"), "total_distance", "total_time", digits=4)


@add("a4_gps_profile", P + """ SELECT runner, kind, round(avg(speed), 6) AS mean_speed, min(speed) AS min_speed, max(speed) AS max_speed, round(coalesce(stddev_samp(speed), 0), 6) AS std_speed,
  round(avg(stride), 6) AS mean_stride, round(coalesce(stddev_samp(stride), 0), 6) AS std_stride FROM points GROUP BY runner, kind""")  # fmt: skip
def _(spark, d):
    return rounded(A.gps_profile(points(spark, d), ["runner", "kind"], "speed", "stride"), "mean_speed", "std_speed", "mean_stride", "std_stride")


@add("a5_gate_snapshots", R + """, g AS (SELECT race, list(price ORDER BY num) AS p, list(score ORDER BY num) AS s FROM runners GROUP BY race)
  SELECT race, p[1] AS first_price, s[1] AS first_score, p[len(p) // 2 + 1] AS mid_price, s[len(s) // 2 + 1] AS mid_score, p[len(p)] AS last_price, s[len(s)] AS last_score FROM g""")  # fmt: skip
def _(spark, d):
    return A.gate_snapshots(runners(spark, d), ["race"], "num", ["price", "score"])


@add("a6_interval_profile", P + """ SELECT runner, kind, round(avg(speed), 6) AS avg_speed, round(avg(stride), 6) AS avg_stride, arg_min(id, ts) AS first_progress, arg_max(id, ts) AS last_progress, round(arg_min(lon, ts), 6) AS first_lon, round(arg_max(lon, ts), 6) AS last_lon,
  round(arg_min(lat, ts), 6) AS first_lat, round(arg_max(lat, ts), 6) AS last_lat, count(*) AS n_points, CASE WHEN count(*) >= 2 THEN 1 ELSE 0 END AS covered FROM points GROUP BY runner, kind""")  # fmt: skip
def _(spark, d):
    return rounded(A.interval_profile(points(spark, d), ["runner", "kind"], "ts", "speed", "stride", "id", "lon", "lat"), "avg_speed", "avg_stride", "first_lon", "last_lon", "first_lat", "last_lat")


@add("a7_rollup_entries", R + " SELECT race, round(avg(price), 4) AS avg_price, max(score) AS max_score, min(odds) AS min_odds, arg_min(track, num) AS track, arg_min(horse, num) AS horse FROM runners GROUP BY race")
def _(spark, d):
    out = A.rollup_entries(runners(spark, d), ["race"], [F.avg("price").alias("avg_price"), F.max("score").alias("max_score"), F.min("odds").alias("min_odds")], ["track", "horse"], "num")
    return rounded(out, "avg_price", digits=4)


@add("a8_net_sentiment", "SELECT source, count(CASE WHEN text LIKE '%the%' THEN 1 END) - count(CASE WHEN text LIKE '%ion%' THEN 1 END) AS net_sentiment FROM documents GROUP BY source")
def _(spark, d):
    return A.net_sentiment(table(spark, d, "documents"), "source", "text", "the", "ion")


@add("a9_par_value", R + " SELECT race, num, round(avg(CASE WHEN num % 5 <> 0 THEN price END) OVER (PARTITION BY track, surface) / 1000, 1) AS par FROM runners")
def _(spark, d):
    r = runners(spark, d).withColumn("t", F.when(F.col("num") % 5 != 0, F.col("price")).otherwise(0.0))
    return A.par_value(r, ["track", "surface"], "t").select("race", "num", F.round(F.col("par") / 1000, 1).alias("par"))


@add("a10_finish_time", P + " SELECT runner, max(speed) AS finish_time FROM points GROUP BY runner")
def _(spark, d):
    return A.finish_time(points(spark, d), ["runner"], "speed")


def _career_sql(keys: str) -> str:
    sums = ", ".join(f"sum(CASE WHEN finish = {i} THEN earnings END) AS e{i}, count(CASE WHEN finish = {i} THEN 1 END) AS n{i}" for i in (1, 2, 3, 4))
    return R + f""", g AS (SELECT {keys}, race_date, count(*) AS n, sum(earnings) AS e, {sums} FROM runners GROUP BY ALL),
  c AS (SELECT {keys}, race_date AS as_of_date, {', '.join(f'coalesce(sum({x}) OVER w, 0) AS {x}' for x in ('n', 'n1', 'n2', 'n3', 'n4', 'e', 'e1', 'e2', 'e3', 'e4'))} FROM g
    WINDOW w AS (PARTITION BY {keys} ORDER BY race_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT {keys}, as_of_date, CAST(n AS BIGINT) AS starts, CAST(n1 AS BIGINT) AS wins, CAST(n2 AS BIGINT) AS places, CAST(n3 AS BIGINT) AS shows, CAST(n4 AS BIGINT) AS fourths, round(e, 6) AS earnings, round(e1, 6) AS earnings_1, round(e2, 6) AS earnings_2,
    round(e3, 6) AS earnings_3, round(e4, 6) AS earnings_4, round(coalesce(n1 / nullif(n, 0)::DOUBLE, 0), 6) AS win_pct, round(coalesce((n1 + n2 + n3) / nullif(n, 0)::DOUBLE, 0), 6) AS itm_pct FROM c"""


def _career(spark, d, entity, by=()):
    tasks = runner_tasks(spark, d)
    out = A.career_stats(runners(spark, d, tasks), entity, "race_date", "finish", "earnings", by, tasks)
    return rounded(out, "earnings", "earnings_1", "earnings_2", "earnings_3", "earnings_4", "win_pct", "itm_pct")


@add("a11_career_horse", _career_sql("horse, surface"))
def _(spark, d):
    return _career(spark, d, ["horse"], ["surface"])


@add("a12_career_jockey_trainer", _career_sql("jockey, trainer"))
def _(spark, d):
    return _career(spark, d, ["jockey", "trainer"])


@add("a12_career_jockey_track", _career_sql("jockey, track"))
def _(spark, d):
    return _career(spark, d, ["jockey"], ["track"])


@add("a13_rates", R + " SELECT jockey, round(count(CASE WHEN finish = 1 THEN 1 END) / count(*)::DOUBLE, 6) AS win_pct, round(coalesce(count(CASE WHEN finish = 1 AND surface = 'P' THEN 1 END) / nullif(count(CASE WHEN surface = 'P' THEN 1 END), 0)::DOUBLE, 0), 6) AS p_win_pct FROM runners GROUP BY jockey")
def _(spark, d):
    from stridelake.functions.numeric import rate

    wins = lambda extra: F.count_if((F.col("finish") == 1) & extra)
    all_, on_p = F.lit(True), F.col("surface") == "P"
    out = runners(spark, d).groupBy("jockey").agg(rate(wins(all_), F.count(F.lit(1))).alias("win_pct"), rate(wins(on_p), F.count_if(on_p)).alias("p_win_pct"))
    return rounded(out, "win_pct", "p_win_pct")


@add("a14_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return A.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _health(c: str, kind: str) -> str:
    nan = f"count(CASE WHEN isnan({c}) THEN 1 END)" if kind == "real" else "0"
    blank = f"count(CASE WHEN trim({c}) = '' THEN 1 END)" if kind == "text" else "0"
    stats = f"round(avg({c}), 4) AS mean, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max" if kind != "text" else "NULL AS mean, NULL AS min, NULL AS max"
    return f"SELECT '{c}' AS column, count(*) AS n_rows, count(*) - count({c}) AS n_null, {nan} AS n_nan, {blank} AS n_blank, {stats} FROM points"


@add("a15_health_check", P + " " + " UNION ALL ".join(_health(c, k) for c, k in (("id", "whole"), ("kind", "text"), ("gappy", "real"), ("stride", "real"))))
def _(spark, d):
    return rounded(A.health_check(points(spark, d).select("id", "kind", "gappy", "stride")), "mean", digits=4)


@add("a16_fit_quality", R + " SELECT round(corr(score, odds), 6) AS correlation, round(sqrt(avg((score - odds) * (score - odds))), 6) AS rmse FROM runners")
def _(spark, d):
    return rounded(A.fit_quality(runners(spark, d), "score", "odds"), "correlation", "rmse")


@add("a17_group_summary", R + """ SELECT track, surface, CAST(grouping_id(track, surface) AS BIGINT) AS grain, count(price) AS n, round(avg(price), 3) AS mean, round(stddev_samp(price), 3) AS std, min(price) AS min, max(price) AS max
  FROM runners GROUP BY GROUPING SETS ((track), (track, surface))""")  # fmt: skip
def _(spark, d):
    return rounded(A.group_summary(runners(spark, d), [["track"], ["track", "surface"]], "price"), "mean", "std", digits=3)


BETS = "b AS (SELECT *, 2.0::DOUBLE AS cost, CASE WHEN finish = 1 THEN 2 / odds ELSE 0 END AS payoff, finish = 1 AS hit FROM runners)"
ROI = "count(*) AS bets, count(CASE WHEN hit THEN 1 END) AS wins, sum(cost) AS cost, round(sum(payoff), 4) AS payoff, round(sum(payoff) - sum(cost), 4) AS net, round((sum(payoff) - sum(cost)) / nullif(sum(cost), 0), 6) AS roi, round(count(CASE WHEN hit THEN 1 END) / count(*)::DOUBLE, 6) AS hit_rate"


def bets(spark, d):
    return runners(spark, d).withColumns({"cost": F.lit(2.0), "payoff": F.when(F.col("finish") == 1, 2 / F.col("odds")).otherwise(0.0), "hit": F.col("finish") == 1})


def _roi(out):
    return rounded(rounded(out, "payoff", "net", digits=4), "roi", "hit_rate")


@add("a18_roi_cube", f"{R}, {BETS} SELECT track, surface, {ROI} FROM b GROUP BY CUBE (track, surface)")
def _(spark, d):
    return _roi(A.roi_rollup(bets(spark, d), ["track", "surface"], cube=True))


@add("a19_roi_buckets", f"{R}, {BETS} SELECT CASE WHEN price <= 20000 THEN 'low' WHEN price <= 60000 THEN 'mid' ELSE 'high' END AS bucket, date_trunc('month', race_date)::DATE AS month, {ROI} FROM b GROUP BY ALL")
def _(spark, d):
    b = bets(spark, d).withColumns({"bucket": A.bucket_of(F.col("price"), [20000, 60000], ["low", "mid", "high"]), "month": F.trunc("race_date", "month")})
    return _roi(A.roi_rollup(b, ["bucket", "month"]))


@add("a20_threshold_sweep", f"{R}, {BETS} SELECT threshold, count(*) AS bets, sum(cost) AS cost, round(sum(payoff), 4) AS payoff, round((sum(payoff) - sum(cost)) / sum(cost), 6) AS roi FROM b, (VALUES (0.0::DOUBLE), (0.25), (0.5), (0.75), (0.9)) g(threshold) WHERE score > threshold GROUP BY threshold")
def _(spark, d):
    return rounded(rounded(A.threshold_sweep(bets(spark, d), "score", [0.0, 0.25, 0.5, 0.75, 0.9]), "payoff", digits=4), "roi")


@add("a21_distribution_by", f"{R}, {BETS} SELECT hit, round(avg(score), 6) AS score_mean, round(quantile_cont(score, 0.5), 6) AS score_p50, round(quantile_cont(score, 0.9), 6) AS score_p90, round(avg(price), 3) AS price_mean, round(quantile_cont(price, 0.5), 3) AS price_p50, round(quantile_cont(price, 0.9), 3) AS price_p90 FROM b GROUP BY hit")
def _(spark, d):
    out = A.distribution_by(bets(spark, d), ["hit"], ["score", "price"])
    return rounded(rounded(out, "score_mean", "score_p50", "score_p90"), "price_mean", "price_p50", "price_p90", digits=3)


@add("a22_histogram_share", R + ", s AS (SELECT race, count(DISTINCT num) AS size FROM runners GROUP BY race) SELECT size, count(*) AS groups, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS share_pct FROM s GROUP BY size")
def _(spark, d):
    return A.histogram_share(runners(spark, d), ["race"], "num").select("size", "groups", F.round(F.col("share_pct").cast("double"), 6).alias("share_pct"))


@add("a23_position_bias", R + " SELECT num, round(avg(price), 3) AS mean, round(quantile_cont(price, 0.5), 3) AS median, round(stddev_samp(price), 3) AS std, count(price) AS n, round(avg(price) - (SELECT avg(price) FROM runners), 3) AS bias FROM runners GROUP BY num")
def _(spark, d):
    return rounded(A.position_bias(runners(spark, d), "num", "price"), "mean", "median", "std", "bias", digits=3)


@add("a23_cross_tab", R + " SELECT track, " + ", ".join(f"count(CASE WHEN finish = {i} THEN 1 END) AS finish_{i}" for i in (1, 2, 3)) + " FROM runners GROUP BY track")
def _(spark, d):
    return A.cross_tab(runners(spark, d), "track", "finish", [1, 2, 3])


@add("a24_arm_rewards", f"{R}, {BETS} SELECT race, model AS arm, round(sum(payoff - cost), 4) AS reward FROM b GROUP BY ALL UNION ALL SELECT DISTINCT race, 'no_bet', 0.0 FROM runners")
def _(spark, d):
    b = bets(spark, d).withColumn("net", F.col("payoff") - F.col("cost"))
    return rounded(A.arm_rewards(b, b, ["race"], "model", "net"), "reward", digits=4)


@add("a25_race_context", R + """ SELECT race, count(*) AS field_size, min(odds) AS min_odds, round(avg(odds), 6) AS mean_odds, round(coalesce(stddev_samp(score), 0), 6) AS std_prob, max(score) AS max_prob,
  coalesce((list(score ORDER BY score DESC))[2], 0) AS second_prob, round(max(score) - coalesce((list(score ORDER BY score DESC))[2], 0), 6) AS prob_gap FROM runners GROUP BY race""")  # fmt: skip
def _(spark, d):
    return rounded(A.race_context(runners(spark, d), ["race"], "odds", "score"), "mean_odds", "std_prob", "prob_gap")


@add("a26_full_coverage", R + " SELECT race, num FROM runners WHERE race NOT IN (SELECT race FROM runners WHERE num % 6 = 0)")
def _(spark, d):
    return A.full_coverage(runners(spark, d).withColumn("ok", F.col("num") % 6 != 0), ["race"], "ok").select("race", "num")


@add("a27_bin_counts", P + " SELECT CAST(floor(gappy / 5) * 5 AS BIGINT) AS bin, count(*) AS n FROM points WHERE gappy IS NOT NULL GROUP BY 1")
def _(spark, d):
    return A.bin_counts(points(spark, d), "gappy", 5)


def _lengths() -> str:
    rows = []
    for kind, t, line in ROUTES:
        if t == "RUNNING_LINE":
            legs = " + ".join(f"2 * 6371.0 * 1000.0 * asin(sqrt(pow(sin(radians(({e}) - ({b})) / 2), 2) + cos(radians({b})) * cos(radians({e})) * pow(sin(radians(({c}) - ({a})) / 2), 2)))" for (a, b), (c, e) in zip(line, line[1:], strict=False))
            rows.append(f"SELECT '{kind}' AS kind, {legs} AS route_m")
    return " UNION ALL ".join(rows)


@add("a28_route_efficiency", P + f""", x AS (SELECT *, lag(lat) OVER (PARTITION BY runner, kind ORDER BY ts, id) AS la, lag(lon) OVER (PARTITION BY runner, kind ORDER BY ts, id) AS lo FROM points),
  y AS (SELECT runner, kind, sum(coalesce(2 * 6371.0 * 1000.0 * asin(sqrt(pow(sin((radians(lat) - radians(la)) / 2), 2) + cos(radians(la)) * cos(radians(lat)) * pow(sin(radians(lon - lo) / 2), 2))), 0)) AS path_m FROM x GROUP BY ALL), r AS ({_lengths()})
  SELECT runner, kind, round(route_m, 3) AS route_m, round(path_m, 3) AS path_m, round(route_m / nullif(path_m, 0), 6) AS efficiency FROM y JOIN r USING (kind)""")  # fmt: skip
def _(spark, d):
    paths = path_length(points(spark, d), ["runner", "kind"], ["ts", "id"]).groupBy("runner", "kind").agg(F.sum("step_m").alias("path_m"))
    lines = A.route_length(routes(spark).filter("line_type = 'RUNNING_LINE'"), ["kind"])
    return rounded(rounded(A.route_efficiency(paths, lines, ["kind"]).select("runner", "kind", "route_m", "path_m", "efficiency"), "route_m", "path_m", digits=3), "efficiency")
