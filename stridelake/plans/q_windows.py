"""Queries of window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.operators import windows as W
from stridelake.plans.roles import POINTS, RUNNERS, SECONDS, Group, points, rounded, runners

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R, P = f"WITH {RUNNERS}", f"WITH {POINTS}"
TS = SECONDS.format("ts")
HORSE = "PARTITION BY horse ORDER BY race_date, race, num"
SERIES = "PARTITION BY runner ORDER BY ts, id"
ORDER = ["race_date", "race", "num"]

KINEMATICS = f"""k0 AS (SELECT *, {TS} - lag({TS}) OVER ({SERIES}) AS dt FROM points),
k1 AS (SELECT *, (speed - lag(speed) OVER ({SERIES})) / nullif(dt, 0) AS acceleration FROM k0),
k AS (SELECT *, (acceleration - lag(acceleration) OVER ({SERIES})) / nullif(dt, 0) AS jerk, speed * dt AS distance_segment FROM k1)"""


@add("w1_kinematics", f"{P}, {KINEMATICS} SELECT id, round(dt, 6) AS dt, round(acceleration, 6) AS acceleration, round(jerk, 6) AS jerk, round(distance_segment, 4) AS distance_segment FROM k")
def _(spark, d):
    k = W.kinematics(points(spark, d), ["runner"], ["ts", "id"], "speed", "ts").select("id", "dt", "acceleration", "jerk", "distance_segment")
    return rounded(rounded(k, "dt", "acceleration", "jerk"), "distance_segment", digits=4)


@add("w2_previous_event", R + f""" SELECT race, num, coalesce(lag(track) OVER w, 'NONE') AS prev_track, coalesce(lag(price) OVER w, -1.0) AS prev_price, coalesce(lag(surface) OVER w, 'NONE') AS prev_surface,
  count(*) OVER (PARTITION BY horse) AS total_count, row_number() OVER w - 1 AS prior_count FROM runners WINDOW w AS ({HORSE})""")  # fmt: skip
def _(spark, d):
    out = W.previous_event(runners(spark, d), ["horse"], ORDER, {"track": "NONE", "price": -1.0, "surface": "NONE"})
    return out.select("race", "num", "prev_track", "prev_price", "prev_surface", "total_count", F.col("prior_count").cast("long").alias("prior_count"))


@add("w3_prior_n", R + f""", f AS (SELECT race, num, jockey, race_date, avg(price) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS avg_price_5, max(score) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS max_score_5,
    min(finish) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS best_finish_5, count(price) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS n_5,
    CASE WHEN lag(score) OVER w IS NULL THEN NULL WHEN lag(score, 2) OVER w IS NULL THEN 0 ELSE lag(score) OVER w - lag(score, 2) OVER w END AS score_change,
    date_diff('day', lag(race_date) OVER w, race_date) AS days_off FROM runners WINDOW w AS ({HORSE})),
  s AS (SELECT jockey, race_date, count(*) AS n FROM runners GROUP BY ALL),
  c AS (SELECT jockey, race_date, sum(n) OVER (PARTITION BY jockey ORDER BY race_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS starts FROM s)
  SELECT race, num, round(avg_price_5, 4) AS avg_price_5, max_score_5, best_finish_5, n_5, round(score_change, 6) AS score_change, days_off, CAST(coalesce(starts, 0) AS BIGINT) AS jockey_starts
  FROM f JOIN c USING (jockey, race_date)""")  # fmt: skip
def _(spark, d):
    from stridelake.operators.aggregates import career_stats

    r = runners(spark, d)
    out = W.prior_n(r, ["horse"], ORDER, 5, {"avg_price_5": F.avg("price"), "max_score_5": F.max("score"), "best_finish_5": F.min("finish"), "n_5": F.count("price")})
    out = W.days_since(W.prior_delta(out, ["horse"], ORDER, "score", "score_change"), ["horse"], ORDER, "race_date")
    # Career figures have a row for every day on which the jockey rides, so an equi join finds it.
    stats = career_stats(r, ["jockey"], "race_date", "finish", "earnings").select("jockey", F.col("as_of_date").alias("race_date"), F.col("starts").alias("jockey_starts"))
    out = out.join(stats, ["jockey", "race_date"], "left")
    out = out.select("race", "num", "avg_price_5", "max_score_5", F.col("best_finish_5").cast("long").alias("best_finish_5"), "n_5", "score_change", F.col("days_off").cast("long").alias("days_off"), "jockey_starts")
    return rounded(rounded(out, "avg_price_5", digits=4), "score_change")


@add("w4_prior_avg_where", P + f" SELECT id, round(avg(CASE WHEN gappy <> 0 THEN gappy END) OVER ({SERIES} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS avg_gappy_5 FROM points")
def _(spark, d):
    return rounded(W.prior_avg_where(points(spark, d), ["runner"], ["ts", "id"], 5, ["gappy"]).select("id", "avg_gappy_5"), "avg_gappy_5")


@add("w5_prior_delta", P + f" SELECT id, round(CASE WHEN lag(speed) OVER w IS NULL THEN NULL WHEN lag(speed, 2) OVER w IS NULL THEN 0 ELSE lag(speed) OVER w - lag(speed, 2) OVER w END, 6) AS change FROM points WINDOW w AS ({SERIES})")
def _(spark, d):
    return rounded(W.prior_delta(points(spark, d), ["runner"], ["ts", "id"], "speed", "change").select("id", "change"), "change")


@add("w6_days_since", R + f""", x AS (SELECT race, num, date_diff('day', lag(race_date) OVER ({HORSE}), race_date) AS days_off FROM runners)
  SELECT race, num, days_off, CASE WHEN days_off IS NULL THEN 'N/A' WHEN days_off <= 14 THEN 'short' WHEN days_off <= 45 THEN 'medium' ELSE 'long' END AS layoff FROM x""")  # fmt: skip
def _(spark, d):
    return W.days_since(runners(spark, d), ["horse"], ORDER, "race_date").select("race", "num", F.col("days_off").cast("long").alias("days_off"), "layoff")


@add("w7_topk_agg", R + " SELECT horse, round(avg(price), 4) AS avg_price, count(*) AS n, min(race_date) AS since FROM (SELECT *, row_number() OVER (PARTITION BY horse ORDER BY race_date DESC, race DESC, num DESC) AS rn FROM runners) WHERE rn <= 3 GROUP BY horse")
def _(spark, d):
    out = W.topk_agg(runners(spark, d), ["horse"], [F.desc(c) for c in ORDER], 3, [F.avg("price").alias("avg_price"), F.count(F.lit(1)).alias("n"), F.min("race_date").alias("since")])
    return rounded(out, "avg_price", digits=4)


@add("w8_locf_prior", P + f" SELECT id, last_value(gappy IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gappy_prev FROM points")
def _(spark, d):
    return W.locf(points(spark, d), ["runner"], ["ts", "id"], ["gappy"]).select("id", "gappy_prev")


@add("w9_locf_current", P + f" SELECT id, last_value(gappy IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gappy_ffill FROM points")
def _(spark, d):
    return W.locf(points(spark, d), ["runner"], ["ts", "id"], ["gappy"], include_current=True).select("id", "gappy_ffill")


@add("w10_fill_both", P + f""" SELECT id, coalesce(last_value(gappy IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(gappy IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS gappy FROM points""")  # fmt: skip
def _(spark, d):
    return W.fill_both(points(spark, d), ["runner"], ["ts", "id"], ["gappy"]).select("id", "gappy")


@add("w12_fatigue", P + """, x AS (SELECT id, speed, max(speed) OVER (PARTITION BY runner) AS hi, min(speed) OVER (PARTITION BY runner) AS lo, last_value(speed) OVER (PARTITION BY runner ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fin FROM points)
  SELECT id, CASE WHEN speed = hi THEN 1 ELSE 0 END AS is_fastest, CASE WHEN speed = lo THEN 1 ELSE 0 END AS is_slowest, fin AS final_speed, round(CASE WHEN hi > 0 THEN (hi - fin) / hi END, 6) AS fatigue_factor FROM x""")  # fmt: skip
def _(spark, d):
    return rounded(W.fatigue(points(spark, d), ["runner"], ["ts", "id"], "speed").select("id", "is_fastest", "is_slowest", "final_speed", "fatigue_factor"), "fatigue_factor")


@add("w13_gate_acceleration", P + f" SELECT id, round((speed - lag(speed) OVER ({SERIES})) / stride, 6) AS acceleration FROM points")
def _(spark, d):
    return rounded(W.kinematics(points(spark, d), ["runner"], ["ts", "id"], "speed", dt="stride").select("id", "acceleration"), "acceleration")


STEP = "2 * 6371.0 * 1000.0 * atan2(sqrt(h), sqrt(1 - h))"


@add("w14_path_length", P + f""", x AS (SELECT *, lag(lat) OVER ({SERIES}) AS la, lag(lon) OVER ({SERIES}) AS lo FROM points),
  y AS (SELECT *, pow(sin((radians(lat) - radians(la)) / 2), 2) + cos(radians(la)) * cos(radians(lat)) * pow(sin(radians(lon - lo) / 2), 2) AS h FROM x),
  z AS (SELECT *, coalesce({STEP}, 0) AS step_m FROM y)
  SELECT id, round(step_m, 3) AS step_m, round(sum(step_m) OVER ({SERIES}), 3) AS path_m, round(sum(step_m) OVER ({SERIES}) - 1000, 3) AS ground_loss_m FROM z""")  # fmt: skip
def _(spark, d):
    out = W.path_length(points(spark, d).withColumn("route", F.lit(1000.0)), ["runner"], ["ts", "id"], straight="route")
    return rounded(out.select("id", "step_m", "path_m", "ground_loss_m"), "step_m", "path_m", "ground_loss_m", digits=3)


@add("w15_running_speed", P + f""", x AS (SELECT *, round(speed / stride, 8) AS s, round(sum(speed) OVER ({SERIES}) / sum(stride) OVER ({SERIES}), 8) AS r FROM points)
  SELECT id, s AS section_speed, r AS running_speed, round(s - lag(s) OVER ({SERIES}), 8) AS speed_change FROM x""")  # fmt: skip
def _(spark, d):
    return W.running_speed(points(spark, d), ["runner"], ["ts", "id"], "speed", "stride", digits=8).select("id", "section_speed", "running_speed", "speed_change")


@add("w16_rank_in_group", R + " SELECT race, num, rank() OVER (PARTITION BY race ORDER BY score DESC) AS rank FROM runners QUALIFY rank <= 4")
def _(spark, d):
    return W.rank_in_group(runners(spark, d), ["race"], [F.desc("score")], "rank", 4).select("race", "num", F.col("rank").cast("long").alias("rank"))


@add("w17_softmax", R + """, x AS (SELECT race, num, exp((score - max(score) OVER (PARTITION BY race)) / 0.5::DOUBLE) AS e FROM runners)
  SELECT race, num, round(e / sum(e) OVER (PARTITION BY race), 6) AS prob FROM x""")  # fmt: skip
def _(spark, d):
    return rounded(W.softmax(runners(spark, d), ["race"], "score", 0.5).select("race", "num", "prob"), "prob")


@add("w18_score_gaps", R + """ SELECT race, num, round(max(score) OVER w - coalesce(nth_value(score, 2) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0), 6) AS prob_gap, round(stddev_pop(score) OVER w, 6) AS std_prob,
  round(max(score) OVER w - score, 6) AS leader_gap, round(coalesce(score - lead(score) OVER o, -1.0), 6) AS trailing_gap, min(odds) OVER w AS fav_odds, round(avg(odds) OVER w, 6) AS avg_odds
  FROM runners WINDOW w AS (PARTITION BY race), o AS (PARTITION BY race ORDER BY score DESC, num)""")  # fmt: skip
def _(spark, d):
    out = W.score_gaps(runners(spark, d), ["race"], "score", "odds", ["num"]).select("race", "num", "prob_gap", "std_prob", "leader_gap", "trailing_gap", "fav_odds", "avg_odds")
    return rounded(out, "prob_gap", "std_prob", "leader_gap", "trailing_gap", "avg_odds")


@add("w19_running_ledger", R + """, b AS (SELECT track, race, num, 2.0::DOUBLE AS cost, CASE WHEN finish = 1 THEN 2 / odds ELSE 0 END AS payoff FROM runners)
  SELECT race, num, row_number() OVER w AS bet_no, round(sum(payoff) OVER w - sum(cost) OVER w, 4) AS cum_net, round((sum(payoff) OVER w - sum(cost) OVER w) / sum(cost) OVER w, 6) AS cum_roi
  FROM b WINDOW w AS (PARTITION BY track ORDER BY race, num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")  # fmt: skip
def _(spark, d):
    bets = runners(spark, d).withColumns({"cost": F.lit(2.0), "payoff": F.when(F.col("finish") == 1, 2 / F.col("odds")).otherwise(0.0)})
    out = W.running_ledger(bets, ["track"], ["race", "num"]).select("race", "num", F.col("bet_no").cast("long").alias("bet_no"), "cum_net", "cum_roi")
    return rounded(rounded(out, "cum_net", digits=4), "cum_roi")


@add("w20_field_size", R + " SELECT race, num, count(*) OVER (PARTITION BY race) AS field_size FROM runners")
def _(spark, d):
    return W.field_size(runners(spark, d), ["race"]).select("race", "num", "field_size")


@add("w21_gate_index", P + f" SELECT id, row_number() OVER ({SERIES}) AS gate_index FROM points")
def _(spark, d):
    return W.row_index(points(spark, d), ["runner"], ["ts", "id"]).select("id", F.col("gate_index").cast("long").alias("gate_index"))


@add("w22_order_finish", R + """, g AS (SELECT race, num, CASE WHEN finish = 1 THEN 9999.0::DOUBLE ELSE num::DOUBLE END AS gate FROM runners)
  SELECT race, num, CASE WHEN gate = 9999 THEN coalesce(max(CASE WHEN gate <> 9999 THEN gate END) OVER (PARTITION BY race), 0) + 0.5 ELSE gate END AS gate_order FROM g""")  # fmt: skip
def _(spark, d):
    g = runners(spark, d).select("race", "num", F.when(F.col("finish") == 1, 9999.0).otherwise(F.col("num").cast("double")).alias("gate"))
    return W.order_finish(g, ["race"], "gate").select("race", "num", "gate_order")


@add("w23_numbering_gaps", R + ", x AS (SELECT race, num, row_number() OVER (PARTITION BY race ORDER BY num) AS expected FROM runners) SELECT race, num, expected FROM x WHERE race IN (SELECT race FROM x WHERE num <> expected)")
def _(spark, d):
    return W.numbering_gaps(runners(spark, d), ["race"], "num").select("race", "num", F.col("expected").cast("long").alias("expected"))


@add("w24_elapsed", P + " SELECT id, round((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY runner)) / 1e6::DOUBLE, 6) AS elapsed_s FROM points")
def _(spark, d):
    return rounded(W.elapsed(points(spark, d), ["runner"], "ts").select("id", "elapsed_s"), "elapsed_s")


#: Rows of a key beyond which the queries of hot keys deal it over tasks.
HOT_ROWS = 1000
HOT = POINTS.replace("SELECT user_id AS runner", "SELECT CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS runner")


def hot_points(spark, d):
    """Points of which half belong to one runner."""
    return points(spark, d).withColumn("runner", F.when(F.col("runner") % 2 == 0, 0).otherwise(F.col("runner")))


@add("w3_prior_n_hot_key", f"""WITH {HOT} SELECT id, round(avg(speed) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS avg_speed_5, count(gappy) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS n_5,
  max(gappy) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS max_gappy_5 FROM points WINDOW w AS ({SERIES})""")  # fmt: skip
def _(spark, d):
    out = W.prior_n(hot_points(spark, d), ["runner"], ["ts", "id"], 5, {"avg_speed_5": F.avg("speed"), "n_5": F.count("gappy"), "max_gappy_5": F.max("gappy")}, HOT_ROWS)
    return rounded(out.select("id", "avg_speed_5", "n_5", "max_gappy_5"), "avg_speed_5")


@add("w8_locf_hot_key", f"WITH {HOT} SELECT id, last_value(rare IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rare_prev FROM (SELECT *, CASE WHEN id % 977 = 0 THEN speed END AS rare FROM points)")
def _(spark, d):
    """A value that most slots lack, so that it is carried over several."""
    rare = hot_points(spark, d).withColumn("rare", F.when(F.col("id") % 977 == 0, F.col("speed")))
    return W.locf(rare, ["runner"], ["ts", "id"], ["rare"], hot_rows=HOT_ROWS).select("id", "rare_prev")
