"""Queries of the wager back-test."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.operators import wager as B
from stridelake.plans.roles import RUNNERS, Group, rounded, runners, table

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R = f"WITH {RUNNERS}"
KEY = ["race", "track", "race_date"]

FRAME = R + """, f AS (SELECT race, track, race_date, list(CAST(num AS VARCHAR) ORDER BY score DESC, CAST(num AS VARCHAR)) AS items, list(score ORDER BY score DESC, CAST(num AS VARCHAR)) AS scores, count(*) AS field FROM runners GROUP BY ALL HAVING count(*) BETWEEN 4 AND 14),
g AS (SELECT *, scores[1] - scores[2] AS gap12, scores[2] - scores[3] AS gap23, scores[3] - scores[4] AS gap34, coalesce(scores[4] - scores[5], 0) AS gap45 FROM f)"""


def frame(spark, d, least=4):
    return B.race_frame(runners(spark, d), KEY, "num", "score", least, 14)


def results(spark, d, k):
    """Winners of the first k places, a list each, and what a winning ticket pays for a base of 2."""
    r = runners(spark, d).filter(F.col("finish") <= k)
    legs = F.transform(F.array_sort(F.collect_list(F.struct("finish", "num"))), lambda x: F.array(x["num"].cast("string")))
    return r.groupBy("race").agg(legs.alias("winners"), F.sum("price").alias("__p")).select("race", "winners", F.round(F.col("__p") / 1000, 2).alias("posted_payoff"), F.lit(2.0).alias("posted_base"))


@add("b1_race_frame", FRAME + " SELECT race, field, array_to_string(items, ',') AS items, round(gap12, 6) AS gap12, round(gap23, 6) AS gap23, round(gap34, 6) AS gap34, round(gap45, 6) AS gap45 FROM g")
def _(spark, d):
    out = frame(spark, d).select("race", F.col("field").cast("long").alias("field"), F.array_join(F.transform("runners", lambda x: x["item"]), ",").alias("items"), "gap12", "gap23", "gap34", "gap45")
    return rounded(out, "gap12", "gap23", "gap34", "gap45")


RULES = """CASE WHEN gap12 >= 0.3 AND gap23 >= 0.15 THEN 'STRAIGHT' WHEN gap12 >= 0.4 AND gap23 <= 0.15 THEN 'KEY12' WHEN gap12 <= 0.15 AND gap23 >= 0.25 THEN 'BOX12' END"""
TRI = """CASE WHEN gap12 >= 0.25 AND gap23 >= 0.15 AND gap34 >= 0.1 THEN 'STRAIGHT123' WHEN gap12 >= 0.18 AND gap23 <= 0.12 AND gap34 >= 0.08 THEN 'KEY1_23' WHEN gap12 <= 0.12 AND gap23 >= 0.12 AND gap34 >= 0.05 THEN 'KEY12_3' WHEN gap12 <= 0.12 AND gap23 <= 0.12 AND gap34 <= 0.12 THEN 'BOX123' END"""
#: Gaps are rounded before the rules, so that bounds such as 0.12 mean the same in every engine.
GAPS = "h AS (SELECT race, track, race_date, items, field, round(gap12, 6) AS gap12, round(gap23, 6) AS gap23, round(gap34, 6) AS gap34 FROM g)"


def _gaps(spark, d):
    return rounded(frame(spark, d), "gap12", "gap23", "gap34")


@add("b2_exacta_rules", f"{FRAME}, {GAPS}, m AS (SELECT race, {RULES} AS style FROM h) SELECT race, style FROM m WHERE style IS NOT NULL")
def _(spark, d):
    return B.match_rule(_gaps(spark, d), B.EXACTA_RULES).select("race", "style")


@add("b2_trifecta_rules", f"{FRAME}, {GAPS}, m AS (SELECT race, {TRI} AS style FROM h) SELECT race, style FROM m WHERE style IS NOT NULL")
def _(spark, d):
    return B.match_rule(_gaps(spark, d), B.TRIFECTA_RULES).select("race", "style")


@add("b3_monotone_rules", f"{FRAME}, {GAPS}, m AS (SELECT race, {RULES} AS style FROM h WHERE gap12 < gap23 AND gap23 < gap34) SELECT race, style FROM m WHERE style IS NOT NULL")
def _(spark, d):
    return B.match_rule(_gaps(spark, d), B.EXACTA_RULES, monotone=["gap12", "gap23", "gap34"]).select("race", "style")


TICKETS = f"""{FRAME}, {GAPS}, m AS (SELECT *, {TRI} AS style FROM h), s(style, a, b, c) AS (VALUES ('STRAIGHT123', 1, 2, 3), ('KEY1_23', 1, 2, 3), ('KEY1_23', 1, 3, 2), ('KEY12_3', 1, 2, 3), ('KEY12_3', 2, 1, 3),
  ('BOX123', 1, 2, 3), ('BOX123', 1, 3, 2), ('BOX123', 2, 1, 3), ('BOX123', 2, 3, 1), ('BOX123', 3, 1, 2), ('BOX123', 3, 2, 1)),
t AS (SELECT race, style, items[a] || '/' || items[b] || '/' || items[c] AS ticket FROM m JOIN s USING (style))"""


def _tickets(spark, d):
    return B.tickets(B.match_rule(_gaps(spark, d), B.TRIFECTA_RULES))


@add("b4_tickets", f"{TICKETS} SELECT race, style, ticket FROM t")
def _(spark, d):
    return _tickets(spark, d).select("race", "style", F.array_join("ticket", "/").alias("ticket"))


@add("b4_box_permutations", FRAME + " SELECT race, items[a] || '/' || items[b] AS ticket FROM g, (SELECT a, b FROM range(1, 5) x(a), range(1, 5) y(b) WHERE a <> b)")
def _(spark, d):
    boxed = frame(spark, d).withColumn("style", F.lit("BOX4"))
    return B.tickets(boxed, styles={"BOX4": B.box_style(4, 2)}).select("race", F.array_join("ticket", "/").alias("ticket"))


@add("b5_close_box", FRAME + ", c AS (SELECT race, list_filter(items, lambda x, i: scores[i] >= scores[1] - 0.05) AS box FROM g) SELECT race, array_to_string(box[1:4], ',') AS box FROM c WHERE len(box) >= 2")
def _(spark, d):
    return B.close_box(frame(spark, d)).select("race", F.array_join("box", ",").alias("box"))


@add("b6_multi_leg", FRAME + """, c AS (SELECT race // 4 AS card, race % 4 + 1 AS leg, items[1:2] AS two FROM g), w AS (SELECT DISTINCT card, 3 AS last FROM c),
  x AS (SELECT w.card, a.two AS ta, b.two AS tb, c.two AS tc FROM w JOIN c a ON a.card = w.card AND a.leg = 1 JOIN c b ON b.card = w.card AND b.leg = 2 JOIN c ON c.card = w.card AND c.leg = 3)
  SELECT card, ta[i] || '-' || tb[j] || '-' || tc[k] AS ticket FROM x, range(1, 3) p(i), range(1, 3) q(j), range(1, 3) r(k)""")  # fmt: skip
def _(spark, d):
    races = frame(spark, d).withColumns({"card": F.floor(F.col("race") / 4), "leg": (F.col("race") % 4 + 1).cast("int")})
    wagers = races.select("card").distinct().withColumn("leg", F.lit(3))
    return B.multi_leg(wagers, races, ["card"], "leg", 3).select("card", F.array_join("ticket", "-").alias("ticket"))


SETTLED = f"""{TICKETS}, res AS (SELECT race, string_agg(CAST(num AS VARCHAR), '/' ORDER BY finish) AS won, round(sum(price) / 1000, 2) AS pay FROM runners WHERE finish <= 3 GROUP BY race),
z AS (SELECT t.race, style, ticket, ticket = won AS hit, CASE WHEN ticket = won THEN pay * 1.0::DOUBLE / 2 ELSE 0 END AS payoff, 1.0::DOUBLE AS stake FROM t LEFT JOIN res ON t.race = res.race)"""


def _settled(spark, d):
    return B.settle(_tickets(spark, d).withColumn("stake", F.lit(1.0)), results(spark, d, 3), ["race"])


@add("b7_settle", f"{SETTLED} SELECT race, ticket, hit, round(payoff, 4) AS payoff FROM z")
def _(spark, d):
    return rounded(_settled(spark, d).select("race", F.array_join("ticket", "/").alias("ticket"), "hit", "payoff"), "payoff", digits=4)


METRICS = f"{SETTLED}, bm AS (SELECT race, count(*) AS combos, sum(stake) AS cost, sum(payoff) AS payoff, max(CASE WHEN hit THEN 1 ELSE 0 END) AS hit FROM z GROUP BY race)"


@add("b8_bet_metrics", f"{METRICS} SELECT race, combos, cost, round(payoff, 4) AS payoff, hit, round(payoff - cost, 4) AS net, round((payoff - cost) / cost, 5) AS roi FROM bm")
def _(spark, d):
    return rounded(rounded(B.bet_metrics(_settled(spark, d), ["race"]), "payoff", "net", digits=4), "roi", digits=5)


@add("b9_stake", f"""{FRAME}, {GAPS}, m AS (SELECT race, gap12, gap23, CASE WHEN gap12 >= 0.3 AND gap23 >= 0.15 THEN 0.05::DOUBLE ELSE 0.01 END AS pct, CASE WHEN gap12 >= 0.3 AND gap23 >= 0.15 THEN 1 ELSE 2 END AS combos FROM h WHERE ({RULES}) IS NOT NULL),
  s AS (SELECT race, greatest(1.0, 997.0 * pct * (1 + 0.5 * least(gap12 / 0.1, 1) + 0.5 * least(gap23 / 0.1, 1))) / combos AS w FROM m)
  SELECT race, round(round_even(w, 0), 2) AS stake FROM s""")  # fmt: skip
def _(spark, d):
    m = B.match_rule(_gaps(spark, d), B.EXACTA_RULES).withColumn("combos", F.when(F.col("style") == "STRAIGHT", 1).otherwise(2))
    return B.stake(m, 997.0, 1.0).select("race", "stake")




@add("b10_bankroll_fold", f"""{METRICS.replace('WITH li AS', 'WITH RECURSIVE li AS', 1)}, o AS MATERIALIZED (SELECT race % 10 AS strategy, row_number() OVER (PARTITION BY race % 10 ORDER BY race) AS i, cost, payoff FROM bm),
  p(strategy, i, money, placed, low) AS (SELECT DISTINCT strategy, 0::BIGINT, 25.0::DOUBLE, 0, 25.0::DOUBLE FROM o UNION ALL
    SELECT p.strategy, o.i, CASE WHEN money >= cost THEN money - cost + payoff ELSE money END, placed + CASE WHEN money >= cost THEN 1 ELSE 0 END, least(low, CASE WHEN money >= cost THEN money - cost + payoff ELSE money END)
    FROM p JOIN o ON o.strategy = p.strategy AND o.i = p.i + 1)
  SELECT strategy, CAST(max(i) AS INTEGER) AS bets, CAST(arg_max(placed, i) AS INTEGER) AS placed, round(arg_max(money, i), 4) AS final_bankroll, round(arg_max(low, i), 4) AS lowest_bankroll FROM p GROUP BY strategy""")  # fmt: skip
def _(spark, d):
    bets = B.bet_metrics(_settled(spark, d), ["race"]).withColumn("strategy", F.col("race") % 10)
    return rounded(B.bankroll_path(bets, "strategy", ["race"], 25.0), "final_bankroll", "lowest_bankroll", digits=4)


@add("b10_bankroll_blocks", f"""{METRICS.replace('WITH li AS', 'WITH RECURSIVE li AS', 1)}, o AS MATERIALIZED (SELECT row_number() OVER (ORDER BY race) AS i, cost, payoff FROM bm),
  p(i, money, placed, low) AS (SELECT 0::BIGINT, 40.0::DOUBLE, 0, 40.0::DOUBLE UNION ALL
    SELECT o.i, CASE WHEN money >= cost THEN money - cost + payoff ELSE money END, placed + CASE WHEN money >= cost THEN 1 ELSE 0 END, least(low, CASE WHEN money >= cost THEN money - cost + payoff ELSE money END)
    FROM p JOIN o ON o.i = p.i + 1)
  SELECT 'all' AS strategy, CAST(max(i) AS INTEGER) AS bets, CAST(arg_max(placed, i) AS INTEGER) AS placed, round(arg_max(money, i), 4) AS final_bankroll, round(arg_max(low, i), 4) AS lowest_bankroll FROM p""")  # fmt: skip
def _(spark, d):
    """One strategy of all bets, dealt over tasks in blocks."""
    bets = B.bet_metrics(_settled(spark, d), ["race"]).withColumn("strategy", F.lit("all"))
    return rounded(B.bankroll_blocks(bets, "strategy", ["race"], 40.0, 500), "final_bankroll", "lowest_bankroll", digits=4)


PLAIN = f"{FRAME}, {GAPS}, b AS (SELECT race, gap12, gap23, 2.0::DOUBLE AS cost, CASE WHEN items[1] = (SELECT CAST(num AS VARCHAR) FROM runners r WHERE r.race = h.race AND finish = 1) THEN 5.0::DOUBLE ELSE 0 END AS payoff FROM h)"


@add("b11_grid_search", f"{PLAIN} SELECT x AS min_gap12, y AS min_gap23, count(*) AS bets, sum(cost) AS cost, sum(payoff) AS payoff, round((sum(payoff) - sum(cost)) / sum(cost), 6) AS roi FROM b, (VALUES (0.0::DOUBLE), (0.1), (0.2)) p(x), (VALUES (0.0::DOUBLE), (0.05)) q(y) WHERE gap12 >= x AND gap23 >= y GROUP BY x, y")
def _(spark, d):
    won = runners(spark, d).filter("finish = 1").select("race", F.col("num").cast("string").alias("won"))
    b = _gaps(spark, d).join(won, "race").withColumns({"cost": F.lit(2.0), "payoff": F.when(F.get("runners", F.lit(0))["item"] == F.col("won"), 5.0).otherwise(0.0)})
    return rounded(B.grid_search(b, {"gap12": [0.0, 0.1, 0.2], "gap23": [0.0, 0.05]}), "roi")


@add("b12_advice", f"""{FRAME}, {GAPS}, a AS (SELECT race, race // 6 AS card, CASE WHEN gap12 > 0.1 AND gap23 > 0.05 THEN 'key 1 over 2' WHEN gap12 > 0.1 THEN 'key 1 over 2,3' ELSE 'box 1,2,3' END AS advice,
    CASE WHEN gap12 > 0.1 AND gap23 > 0.05 THEN 1 WHEN gap12 > 0.1 THEN 2 ELSE 6 END AS n_tickets, CASE WHEN gap12 > 0.1 THEN 1 ELSE 0 END AS c FROM h),
  n AS (SELECT *, coalesce(lead(c, 1) OVER w, 0) AS c1, coalesce(lead(c, 2) OVER w, 0) AS c2, coalesce(lead(c, 3) OVER w, 0) AS c3 FROM a WINDOW w AS (PARTITION BY card ORDER BY race))
  SELECT race, advice, n_tickets, CASE WHEN c + c1 + c2 + c3 = 4 THEN 'pick 4' WHEN c + c1 + c2 = 3 THEN 'pick 3' WHEN c + c1 = 2 THEN 'daily double' ELSE 'none' END AS multi_race FROM n""")  # fmt: skip
def _(spark, d):
    return B.advice(_gaps(spark, d).withColumn("card", F.floor(F.col("race") / 6)), ["card"], "race").select("race", "advice", "n_tickets", "multi_race")


@add("b13_upcoming", "SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= DATE '2001-01-01'")
def _(spark, d):
    return B.upcoming(table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")), "day", "2001-01-01", ["o_orderpriority", "day"])


@add("b14_best_arm", R + """, m AS (SELECT track, surface, model AS arm, avg(CASE WHEN finish = 1 THEN 2 / odds ELSE 0 END - 2) AS r, count(*) AS n FROM runners GROUP BY ALL)
  SELECT track, surface, (list(arm ORDER BY r DESC, arm))[1] AS chosen_arm, round(max(r), 6) AS mean_reward, (list(n ORDER BY r DESC, arm))[1] AS n FROM m GROUP BY ALL""")  # fmt: skip
def _(spark, d):
    rewards = runners(spark, d).select("track", "surface", F.col("model").alias("arm"), (F.when(F.col("finish") == 1, 2 / F.col("odds")).otherwise(0.0) - 2).alias("reward"))
    return rounded(B.best_arm(rewards, ["track", "surface"]), "mean_reward")
