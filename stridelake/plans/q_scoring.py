"""Queries of scoring and ranking mathematics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.functions.geometry import haversine, line_distance
from stridelake.functions.numeric import _A, _B, _C, _D, inv_norm
from stridelake.operators import scoring as S
from stridelake.operators.windows import rank_in_group
from stridelake.plans.roles import POINTS, RUNNERS, SECONDS, Group, points, rounded, runner_tasks, runners

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R, P = f"WITH {RUNNERS}", f"WITH {POINTS}"
TS = SECONDS.format("ts")


@add("m1_class_multiplier", R + """, g AS (SELECT race, num, CASE WHEN num % 4 = 0 THEN NULL ELSE price END AS r FROM runners), f AS (SELECT race, num, coalesce(r, avg(r) OVER (PARTITION BY race), avg(r) OVER ()) AS r FROM g),
  s AS (SELECT min(r) AS lo, max(r) AS hi, quantile_cont(r, 0.5) AS md FROM f)
  SELECT race, num, round(0.95::DOUBLE + (r - lo) * (1.15::DOUBLE - 0.95::DOUBLE) / (hi - lo), 6) AS class_multiplier, round((r - md) / 2, 3) AS class_offset FROM f, s""")  # fmt: skip
def _(spark, d):
    tasks = runner_tasks(spark, d)
    r = runners(spark, d, tasks).withColumn("rating", F.when(F.col("num") % 4 != 0, F.col("price")))
    return rounded(rounded(S.class_multiplier(r, "rating", ["race"], tasks=tasks).select("race", "num", "class_multiplier", "class_offset"), "class_multiplier"), "class_offset", digits=3)


@add("m2_haversine", P + """, y AS (SELECT id, pow(sin((radians(lat) - radians(38.1::DOUBLE)) / 2), 2) + cos(radians(38.1::DOUBLE)) * cos(radians(lat)) * pow(sin(radians(lon + 84.5::DOUBLE) / 2), 2) AS h FROM points)
  SELECT id, round(2 * 6371.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h)), 6) AS km, round(2 * 6371000.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h)), 3) AS m FROM y""")  # fmt: skip
def _(spark, d):
    at = (F.lit(38.1), F.lit(-84.5), F.col("lat"), F.col("lon"))
    return rounded(rounded(points(spark, d).select("id", haversine(*at, unit="km").alias("km"), haversine(*at).alias("m")), "km"), "m", digits=3)


@add("m3_line_distance", P + " SELECT id, round(abs(lat - 38.01::DOUBLE) * (6371000.0::DOUBLE * 3.141592653589793::DOUBLE / 180), 3) AS m FROM points")
def _(spark, d):
    p = lambda x: F.struct(F.lit(x).alias("lon"), F.lit(38.01).alias("lat"))
    return rounded(points(spark, d).select("id", line_distance(F.col("lon"), F.col("lat"), F.array(p(-85.0), p(-84.0))).alias("m")), "m", digits=3)


@add("m4_raw_performance", R + """, x AS (SELECT race, num, price, 60 + score * 10 AS t, 1200.0::DOUBLE AS dist, 1210 + num::DOUBLE AS ran, finish * 1.5::DOUBLE AS beaten, avg(60 + score * 10) OVER (PARTITION BY track, surface) AS par FROM runners)
  SELECT race, num, round((dist / t) * (dist / ran) * 1.05 * (1 + 50 * ((par - t) / par)) - least(beaten * 0.25, 10), 5) AS raw_performance, round((par - t) / par, 6) AS par_diff_ratio FROM x""")  # fmt: skip
def _(spark, d):
    r = runners(spark, d).select("race", "num", "track", "surface", (60 + F.col("score") * 10).alias("t"), F.lit(1200.0).alias("dist"), (1210 + F.col("num").cast("double")).alias("ran"), (F.col("finish") * 1.5).alias("beaten"), F.lit(1.05).alias("class_multiplier"))
    out = S.raw_performance(r, ["track", "surface"], "dist", "t", "ran", "beaten").select("race", "num", "raw_performance", "par_diff_ratio")
    return rounded(rounded(out, "raw_performance", digits=5), "par_diff_ratio")


def _horner(coefficients, x: str) -> str:
    out = f"({coefficients[0]!r}::DOUBLE)"
    for c in coefficients[1:]:
        out = f"({out} * {x} + ({c!r}::DOUBLE))"
    return out


def _icdf(p: str) -> str:
    low, high = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"
    return f"""CASE WHEN {p} < 0.02425 THEN {_horner(_C, low)} / {_horner(_D, low)} WHEN {p} > 1 - 0.02425 THEN -({_horner(_C, high)} / {_horner(_D, high)})
  ELSE ({p} - 0.5) * {_horner(_A, f'(({p} - 0.5) * ({p} - 0.5))')} / {_horner(_B, f'(({p} - 0.5) * ({p} - 0.5))')} END"""


@add("m5_speed_index", R + f""", z AS (SELECT race, num, CASE WHEN coalesce(stddev_samp(price) OVER w, 0) = 0 THEN 0 ELSE (price - avg(price) OVER w) / stddev_samp(price) OVER w END AS z FROM runners WINDOW w AS (PARTITION BY horse)),
  q AS (SELECT *, greatest(1e-6, least(1 - 1e-6, 1 / (1 + exp(-z)))) AS p FROM z)
  SELECT race, num, round(greatest(0, least(200, 100 + 15 * ({_icdf('p')}))), 4) AS speed_index FROM q""")  # fmt: skip
def _(spark, d):
    return rounded(S.speed_index(runners(spark, d), ["horse"], "price").select("race", "num", "speed_index"), "speed_index", digits=4)


@add("m6_inv_norm", P + f" SELECT id, round({_icdf('((id % 9999 + 1) / 10001::DOUBLE)')}, 6) AS z FROM points")
def _(spark, d):
    return rounded(points(spark, d).select("id", inv_norm((F.col("id") % 9999 + 1) / F.lit(10001.0)).alias("z")), "z")


@add("m7_gps_composite", P + f""", x AS (SELECT *, {TS} - min({TS}) OVER (PARTITION BY runner) AS t, (id % 400)::DOUBLE AS progress FROM points),
  a AS (SELECT runner, round(min(CASE WHEN progress <= 1 THEN t END), 4) AS time_to_finish, round(min(CASE WHEN progress <= 200 THEN t END), 4) AS time_to_sprint, round(avg(speed), 6) AS avg_speed, round(stddev_samp(speed), 6) AS speed_stddev,
    round(avg(stride), 6) AS avg_stride_freq, round(avg(progress), 6) AS progress_rate, round(avg(CASE WHEN progress <= 200 THEN speed END), 6) AS final_sprint_speed, round(avg(CASE WHEN progress <= 200 THEN stride END), 6) AS sprint_stride_freq FROM x GROUP BY runner),
  g AS (SELECT runner, round(avg(speed), 6) AS avg_sectional_time, round(sum(stride), 4) AS total_distance, round(avg(stride / (id % 9 + 1)), 6) AS stride_efficiency, min(CASE WHEN kind = 'view' THEN speed END) AS beaten_lengths FROM points WHERE kind IN ('click', 'view') GROUP BY runner)
  SELECT * FROM a FULL JOIN g USING (runner) WHERE time_to_finish IS NOT NULL""")  # fmt: skip
def _(spark, d):
    p = points(spark, d).withColumn("progress", (F.col("id") % 400).cast("double"))
    gates = p.filter("kind in ('click', 'view')").withColumns({"gate": F.when(F.col("kind") == "view", "Finish").otherwise("1f"), "n": F.col("id") % 9 + 1})
    out = S.gps_composite(p, gates, ["runner"], "ts", "speed", "stride", "progress", "gate", "speed", "stride", "n", "speed")
    out = rounded(out, "avg_speed", "speed_stddev", "avg_stride_freq", "progress_rate", "final_sprint_speed", "sprint_stride_freq", "avg_sectional_time", "stride_efficiency")
    return rounded(out, "time_to_finish", "time_to_sprint", "total_distance", digits=4)


@add("m8_time_to_reach", P + f", x AS (SELECT runner, speed, {TS} - min({TS}) OVER (PARTITION BY runner) AS t FROM points) SELECT runner, round(min(CASE WHEN speed >= 10 THEN t END), 4) AS t_10, round(min(CASE WHEN speed >= 49.5 THEN t END), 4) AS t_49_5, round(min(CASE WHEN speed >= 1000 THEN t END), 4) AS t_1000 FROM x GROUP BY runner")
def _(spark, d):
    return rounded(S.time_to_reach(points(spark, d), ["runner"], "ts", "speed", [10, 49.5, 1000]), "t_10", "t_49_5", "t_1000", digits=4)


@add("m9_run_out", P + f", x AS (SELECT runner, speed, {TS} - min(CASE WHEN id % 400 <= 1 THEN {TS} END) OVER (PARTITION BY runner) AS t FROM points) SELECT runner, round(avg(CASE WHEN t >= 0 AND t <= 86400 THEN speed END), 6) AS run_out_speed FROM x GROUP BY runner")
def _(spark, d):
    p = points(spark, d).withColumn("progress", F.col("id") % 400)
    return rounded(S.run_out(p, ["runner"], "ts", "speed", "progress", 86400.0), "run_out_speed")


@add("m10_peak", P + " SELECT runner, max(speed) AS peak_speed, round((list(stride ORDER BY speed DESC, id))[1], 6) AS stride_at_peak, min(id % 13) AS best_position FROM points GROUP BY runner")
def _(spark, d):
    return rounded(S.peak(points(spark, d).withColumn("position", F.col("id") % 13), ["runner"], "speed", "stride", "position", ["id"]), "stride_at_peak")


@add("m11_scaled_target", R + """, w AS (SELECT track, race, min(price) AS w FROM runners GROUP BY ALL), p AS (SELECT track, quantile_cont(w, 0.5) AS par FROM w GROUP BY track),
  x AS (SELECT race, num, track, par - (price + 0.1::DOUBLE * finish) AS diff FROM runners JOIN p USING (track))
  SELECT race, num, round(coalesce(40 + (diff - min(diff) OVER (PARTITION BY track)) / nullif(max(diff) OVER (PARTITION BY track) - min(diff) OVER (PARTITION BY track), 0) * 80, 120), 5) AS target FROM x""")  # fmt: skip
def _(spark, d):
    return rounded(S.scaled_target(runners(spark, d), ["track"], ["race"], "price", "finish").select("race", "num", "target"), "target", digits=5)


@add("m12_ensemble", R + """, s AS (SELECT race, jockey, avg(CASE WHEN model = 'A' THEN score END) AS a, avg(CASE WHEN model = 'N' THEN score END) AS n, avg(CASE WHEN model = 'R' THEN score END) AS r FROM runners GROUP BY ALL),
  m AS (SELECT *, (a + n + r) / 3 AS m FROM s), e AS (SELECT *, exp(m - max(m) OVER (PARTITION BY race)) AS e FROM m)
  SELECT race, jockey, round(a, 6) AS score_a, round(m, 6) AS ensemble_score, round(e / sum(e) OVER (PARTITION BY race), 6) AS ensemble_prob, row_number() OVER (PARTITION BY race ORDER BY m DESC NULLS LAST, jockey) AS ensemble_rank FROM e""")  # fmt: skip
def _(spark, d):
    out = S.ensemble(runners(spark, d), ["race"], "jockey", "model", "score", ["A", "N", "R"])
    out = out.select("race", "jockey", F.col("score_A").alias("score_a"), "ensemble_score", "ensemble_prob", F.col("ensemble_rank").cast("long").alias("ensemble_rank"))
    return rounded(out, "score_a", "ensemble_score", "ensemble_prob")


@add("m13_fit_temperature", R + """, x AS (SELECT race, score - max(score) OVER (PARTITION BY race) AS s, CASE WHEN finish = 1 THEN 1 ELSE 0 END AS win FROM runners),
  t AS (SELECT exp(ln(0.001::DOUBLE) + k * (ln(100::DOUBLE) - ln(0.001::DOUBLE)) / 1200) AS t FROM range(1201) r(k)),
  l AS (SELECT t, race, sum(exp(s / t)) AS e, max(CASE WHEN win = 1 THEN s END) AS w FROM x, t GROUP BY ALL),
  n AS (SELECT t, sum(-ln(exp(w / t) / (e + 1e-12) + 1e-12)) AS nll FROM l GROUP BY t)
  SELECT CAST(round(min(nll), 0) AS BIGINT) AS least_nll, CAST(round(10 * ln(arg_min(t, nll)), 0) AS BIGINT) AS tenths_of_log_t FROM n""")  # fmt: skip
def _(spark, d):
    out = S.fit_temperature(runners(spark, d).withColumn("win", (F.col("finish") == 1).cast("int")), ["race"], "score", "win")
    return out.select(F.round("nll", 0).cast("long").alias("least_nll"), F.round(10 * F.log("temperature")).cast("long").alias("tenths_of_log_t"))


@add("m14_calibrate", R + """, x AS (SELECT race, num, exp((score - max(score) OVER (PARTITION BY race)) / 0.7::DOUBLE) AS e FROM runners), y AS (SELECT race, num, e / sum(e) OVER (PARTITION BY race) AS p FROM x)
  SELECT race, num, round(p, 6) AS calibrated_prob, round(ln(p / (1 - p + 1e-12)), 4) AS logit FROM y""")  # fmt: skip
def _(spark, d):
    return rounded(rounded(S.calibrate(runners(spark, d), ["race"], "score", 0.7).select("race", "num", "calibrated_prob", "logit"), "calibrated_prob"), "logit", digits=4)


@add("m15_edge_kelly", R + ", x AS (SELECT race, num, score AS p, least(odds * 3, 0.999) AS ml FROM runners) SELECT race, num, round(p - ml, 6) AS edge, round((p * (1 / ml - 1) - (1 - p)) / (1 / ml - 1), 5) AS kelly FROM x")
def _(spark, d):
    return rounded(rounded(S.edge_kelly(runners(spark, d).withColumn("ml", F.col("odds") * 3), "score", "ml").select("race", "num", "edge", "kelly"), "edge"), "kelly", digits=5)


@add("m16_rank_metrics", R + """, x AS (SELECT status, race, num, score, finish, row_number() OVER (PARTITION BY race ORDER BY score DESC, num) AS p, count(*) OVER (PARTITION BY race) AS n FROM (SELECT 'm' AS status, race, num, score, finish FROM runners)),
  y AS (SELECT * FROM x WHERE n >= 4),
  g AS (SELECT race, count(CASE WHEN p <= 1 AND finish <= 1 THEN 1 END) AS t1, count(CASE WHEN p <= 3 AND finish <= 3 THEN 1 END) AS t3, count(CASE WHEN p <= 4 AND finish <= 4 THEN 1 END) AS t4, count(CASE WHEN p <= 4 AND finish <= 3 THEN 1 END) AS b,
    min(CASE WHEN p = finish THEN 1 ELSE 0 END) AS ex, max(CASE WHEN finish = 1 THEN 1.0::DOUBLE / p END) AS rr, stddev_samp(score) AS sp FROM y GROUP BY race),
  e AS (SELECT sqrt(avg((p - finish) * (p - finish))) AS rmse, avg(abs(p - finish)) AS mae, corr(p, finish) AS spearman FROM y)
  SELECT 'm' AS m, count(*) AS races, round(avg(t1), 6) AS top1_accuracy, round(avg(t3 / 3.0::DOUBLE), 6) AS top3_share, round(avg(CASE WHEN t4 = 4 THEN 1 ELSE 0 END), 6) AS top4_accuracy, round(avg(CASE WHEN b = 3 THEN 1 ELSE 0 END), 6) AS top3_in_top4,
    round(avg(ex), 6) AS perfect_order, round(avg(rr), 6) AS mrr, round(avg(sp), 6) AS avg_score_std, round(any_value(rmse), 6) AS rmse, round(any_value(mae), 6) AS mae, round(any_value(spearman), 6) AS spearman FROM g, e""")  # fmt: skip
def _(spark, d):
    out = S.rank_metrics(runners(spark, d).withColumn("m", F.lit("m")), ["m"], ["race"], "score", "finish", ["num"])
    return rounded(out, *(c for c in out.columns if c not in ("m", "races")))


@add("m17_ndcg", R + """, x AS (SELECT race, score, 1.0::DOUBLE / finish AS rel, row_number() OVER (PARTITION BY race ORDER BY score DESC) AS r, finish AS i FROM runners),
  t AS (SELECT race, score, avg(rel) AS g, sum(CASE WHEN r <= 4 THEN 1 / log2(r + 1) ELSE 0 END) AS d FROM x GROUP BY ALL), a AS (SELECT race, sum(g * d) AS dcg FROM t GROUP BY race),
  b AS (SELECT race, sum(CASE WHEN i <= 4 THEN rel / log2(i + 1) ELSE 0 END) AS idcg FROM x GROUP BY race)
  SELECT race, round(coalesce(dcg / nullif(idcg, 0), 0), 6) AS ndcg FROM a JOIN b USING (race)""")  # fmt: skip
def _(spark, d):
    return rounded(S.ndcg(runners(spark, d).withColumn("rel", F.lit(1.0) / F.col("finish")), ["race"], "rel", "score", 4), "ndcg")


RANKED = "k AS (SELECT *, row_number() OVER (PARTITION BY race ORDER BY score DESC, num) AS rank FROM runners)"


def _ranked(spark, d):
    return rank_in_group(runners(spark, d), ["race"], [F.desc("score"), "num"])


@add("m18_top4_summary", f"""{R}, {RANKED}, l AS (SELECT surface, race, list(num ORDER BY rank) FILTER (WHERE rank <= 4) AS p, list(num ORDER BY finish) FILTER (WHERE finish <= 4) AS f FROM k GROUP BY ALL HAVING count(*) >= 4)
  SELECT surface, count(*) AS races, count(CASE WHEN list_sort(p) = list_sort(f) THEN 1 END) AS any_order, count(CASE WHEN p = f THEN 1 END) AS exact_order,
    round(count(CASE WHEN list_sort(p) = list_sort(f) THEN 1 END) * 100.0::DOUBLE / count(*), 6) AS any_pct, round(count(CASE WHEN p = f THEN 1 END) * 100.0::DOUBLE / count(*), 6) AS exact_pct FROM l GROUP BY surface""")  # fmt: skip
def _(spark, d):
    return rounded(S.top4_summary(_ranked(spark, d), ["surface"], ["race"], "num", "rank", "finish"), "any_pct", "exact_pct")


@add("m19_position_accuracy", f"{R}, {RANKED} SELECT surface, " + ", ".join(f"round(count(CASE WHEN finish = {i} AND rank = {i} THEN 1 END) / nullif(count(CASE WHEN finish = {i} THEN 1 END), 0)::DOUBLE, 6) AS hit_rate_{i}" for i in (1, 2, 3, 4)) + " FROM k GROUP BY surface")
def _(spark, d):
    return rounded(S.position_accuracy(_ranked(spark, d), ["surface"], "rank", "finish"), *(f"hit_rate_{i}" for i in (1, 2, 3, 4)))


@add("m20_exact_match_races", f"{R}, {RANKED}, e AS (SELECT *, count(*) OVER (PARTITION BY race) AS c FROM k WHERE rank = finish) SELECT race, num FROM e WHERE c = 2")
def _(spark, d):
    return S.exact_match_races(_ranked(spark, d), ["race"], "rank", "finish", 2).select("race", "num")


@add("m21_order_match", f"{R}, {RANKED} SELECT race, round(avg(CASE WHEN rank = finish THEN 1 ELSE 0 END) * 100, 4) AS match_pct, count(*) AS runners FROM k WHERE race NOT IN (SELECT race FROM runners WHERE num = 5 AND odds = 0.3) GROUP BY race")
def _(spark, d):
    r = runners(spark, d)
    return rounded(S.order_match(r, ["race"], "score", "finish", ["num"], r.filter("num = 5 and odds = 0.3")), "match_pct", digits=4)


def _linear(frame):
    frame["model_score"] = (2 * frame["score"] - frame["odds"]).round(6)
    return frame[["race", "num", "model_score"]]


@add("m22_score_with", R + " SELECT race, num, round(2 * score - odds, 6) AS model_score FROM runners")
def _(spark, d):
    return S.score_with(runners(spark, d).select("race", "num", "score", "odds"), _linear, "race long, num int, model_score double")


@add("m23_stride_synergy", P + " SELECT id, round(stride * gappy, 6) AS stride_product, round(coalesce(gappy / nullif(stride, 0), 0), 6) AS stride_ratio, round(coalesce(stride * gappy / nullif(speed, 0), 0), 6) AS stride_to_speed FROM points")
def _(spark, d):
    return rounded(S.stride_synergy(points(spark, d), "stride", "gappy", "speed").select("id", "stride_product", "stride_ratio", "stride_to_speed"), "stride_product", "stride_ratio", "stride_to_speed")
