"""Queries of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.functions.clock import micros
from stridelake.operators import joins
from stridelake.operators.aggregates import career_stats
from stridelake.operators.windows import gate_spans
from stridelake.plans.roles import POINTS, RUNNERS, Group, points, rounded, runner_tasks, runners, table

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R, P = f"WITH {RUNNERS}", f"WITH {POINTS}"
ROUTES = [("click", "RUNNING_LINE", [(-84.600, 38.000), (-84.595, 38.004), (-84.590, 38.006)]), ("click", "WINNING_LINE", [(-84.592, 38.000), (-84.592, 38.008)]), ("view", "RUNNING_LINE", [(-84.598, 38.001), (-84.591, 38.007)])]


def routes(spark):
    rows = [(k, t, [{"lon": x, "lat": y} for x, y in line]) for k, t, line in ROUTES]
    return spark.createDataFrame(rows, "kind string, line_type string, line array<struct<lon:double,lat:double>>")


@add("j1_join_prefixed", "SELECT n_nationkey AS k, n_name, s_suppkey AS s_id, s_acctbal AS s_bal FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey")
def _(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"))
    return joins.join_prefixed(n, s, ["k"], "left", "s_")


@add("j2_merge_races", """WITH a AS (SELECT o_orderkey AS race, o_totalprice AS purse FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey AS race, -o_totalprice AS purse, o_orderstatus AS surface FROM orders WHERE o_orderkey % 2 = 0),
  c AS (SELECT o_orderkey AS race, o_orderpriority AS track FROM orders WHERE o_orderkey % 5 = 0)
  SELECT DISTINCT race, coalesce(a.purse, b.purse) AS purse, surface, track FROM a FULL JOIN b USING (race) FULL JOIN c USING (race)""")  # fmt: skip
def _(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderkey", "race")
    card = o.filter("race % 3 <> 0").select("race", F.col("o_totalprice").alias("purse"))
    results = o.filter("race % 2 = 0").select("race", (-F.col("o_totalprice")).alias("purse"), F.col("o_orderstatus").alias("surface"))
    listed = o.filter("race % 5 = 0").select("race", F.col("o_orderpriority").alias("track"))
    return joins.merge_races(card, results, listed, ["race"])


def _asof(spark, d, **how):
    p = points(spark, d)
    left = p.filter("kind = 'click'").select("runner", "id", "ts")
    right = p.filter("kind = 'view'").select("runner", F.col("ts").alias("seen"), F.col("id").alias("view_id"), F.col("speed").alias("view_speed"))
    return joins.asof_join(left, right, ["runner"], "ts", "seen", ["view_id", "view_speed"], tie=["view_id"], **how).select("id", "view_id", "view_speed")


@add("j3_asof_join", P + " SELECT l.id, r.id AS view_id, r.speed AS view_speed FROM (SELECT * FROM points WHERE kind = 'click') l ASOF LEFT JOIN (SELECT * FROM points WHERE kind = 'view') r ON l.runner = r.runner AND l.ts >= r.ts")
def _(spark, d):
    return _asof(spark, d)


@add("j4_asof_strict", P + " SELECT l.id, r.id AS view_id, r.speed AS view_speed FROM (SELECT * FROM points WHERE kind = 'click') l ASOF JOIN (SELECT * FROM points WHERE kind = 'view') r ON l.runner = r.runner AND l.ts > r.ts")
def _(spark, d):
    return _asof(spark, d, strict=True, how="inner")


@add("j5_asof_forward", P + " SELECT l.id, r.id AS view_id, r.speed AS view_speed FROM (SELECT * FROM points WHERE kind = 'click') l ASOF LEFT JOIN (SELECT * FROM points WHERE kind = 'view') r ON l.runner = r.runner AND l.ts <= r.ts")
def _(spark, d):
    return _asof(spark, d, direction="forward")


@add("j3_asof_career", R + """, s AS (SELECT jockey, race_date, count(*) AS n FROM runners GROUP BY ALL),
  u AS (SELECT r.race, r.num, (SELECT coalesce(sum(s.n), 0) FROM s WHERE s.jockey = r.jockey AND s.race_date < r.race_date) AS starts FROM (SELECT DISTINCT race, num, jockey, race_date FROM runners) r)
  SELECT race, num, CAST(starts AS BIGINT) AS starts FROM u""")  # fmt: skip
def _(spark, d):
    r = runners(spark, d)
    stats = career_stats(r, ["jockey"], "race_date", "finish", "earnings").select("jockey", "as_of_date", "starts")
    return joins.asof_join(r.select("race", "num", "jockey", "race_date"), stats, ["jockey"], "race_date", "as_of_date", ["starts"]).select("race", "num", "starts")


@add("j3_asof_hot_key", """WITH e AS (SELECT CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS runner, event_id AS id, ts, event_type, value FROM events)
  SELECT l.id, r.id AS last_click, r.value AS click_value FROM e l LEFT JOIN LATERAL (SELECT id, value FROM e r WHERE r.runner = l.runner AND r.event_type = 'click' AND r.ts < l.ts ORDER BY ts DESC, id DESC LIMIT 1) r ON true WHERE l.event_type <> 'click'""")  # fmt: skip
def _(spark, d):
    """The click before each other event, where half of all events are one runner's."""
    e = points(spark, d).withColumn("runner", F.when(F.col("runner") % 2 == 0, 0).otherwise(F.col("runner")))
    clicks = e.filter("kind = 'click'").select("runner", F.col("ts").alias("at"), F.col("id").alias("last_click"), F.col("speed").alias("click_value"))
    others = e.filter("kind <> 'click'").select("runner", "id", "ts")
    return joins.asof_join(others, clicks, ["runner"], "ts", "at", ["last_click", "click_value"], strict=True, tie=["last_click"], hot_rows=1000).select("id", "last_click", "click_value")


@add("j6_interval_join", P + """, g AS (SELECT runner, id AS gate, ts AS a, coalesce(lead(ts) OVER (PARTITION BY runner ORDER BY ts, id), ts) AS b FROM points WHERE kind IN ('click', 'view'))
  SELECT p.id, g.gate FROM points p JOIN g ON p.runner = g.runner AND p.ts >= g.a AND p.ts < g.b WHERE p.kind NOT IN ('click', 'view')""")  # fmt: skip
def _(spark, d):
    from pyspark.sql import Window

    p = points(spark, d)
    w = Window.partitionBy("runner").orderBy("ts", "id")
    spans = p.filter("kind in ('click', 'view')").select("runner", F.col("id").alias("gate"), F.col("ts").alias("a"), F.coalesce(F.lead("ts").over(w), "ts").alias("b"))
    return joins.interval_join(p.filter("kind not in ('click', 'view')"), spans, ["runner"], "ts", "a", "b").select("id", "gate")


@add("j7_near_join", P + """ SELECT l.id, r.id AS view_id FROM (SELECT * FROM points WHERE kind = 'click') l LEFT JOIN (SELECT * FROM points WHERE kind = 'view') r
  ON l.runner = r.runner AND abs(epoch_us(l.ts) - epoch_us(r.ts)) <= 1800000000""")  # fmt: skip
def _(spark, d):
    p = points(spark, d)
    left = p.filter("kind = 'click'").select("runner", "id", "ts")
    right = p.filter("kind = 'view'").select("runner", "ts", F.col("id").alias("view_id"))
    return joins.near_join(left, right, ["runner"], "ts", 1_800_000, ["view_id"]).select("id", "view_id")


@add("j8_unmatched", R + ", known AS (SELECT DISTINCT horse FROM runners WHERE race_date < DATE '1995-06-01') SELECT race, num FROM runners WHERE race NOT IN (SELECT race FROM runners WHERE horse NOT IN (SELECT horse FROM known))")
def _(spark, d):
    r = runners(spark, d)
    return joins.fully_matched_groups(r, r.filter("race_date < date'1995-06-01'"), ["race"], ["horse"]).select("race", "num")


@add("j9_group_stats", R + " SELECT race, num, round(avg(price) OVER (PARTITION BY race), 6) AS mean_price, max(score) OVER (PARTITION BY race) AS best_score FROM runners")
def _(spark, d):
    out = joins.add_group_stats(runners(spark, d), ["race"], {"mean_price": F.avg("price"), "best_score": F.max("score")})
    return rounded(out.select("race", "num", "mean_price", "best_score"), "mean_price")


@add("j10_cartesian_legs", R + """, l AS (SELECT race // 3 AS ticket, race % 3 + 1 AS leg, num FROM runners WHERE finish <= 2)
  SELECT a.ticket, a.num || '-' || b.num || '-' || c.num AS combo FROM l a JOIN l b USING (ticket) JOIN l c USING (ticket) WHERE a.leg = 1 AND b.leg = 2 AND c.leg = 3""")  # fmt: skip
def _(spark, d):
    legs = runners(spark, d).filter("finish <= 2").select(F.floor(F.col("race") / 3).alias("ticket"), (F.col("race") % 3 + 1).alias("leg"), "num")
    return joins.cartesian_legs(legs, "ticket", "leg", "num", 3).select("ticket", F.array_join(F.transform("combo", lambda x: x.cast("string")), "-").alias("combo"))


def _segment(x1, y1, x2, y2):
    k = 6371.0 * 1000.0 * 3.141592653589793 / 180.0
    ax, ay = f"(({x1} - lon) * {k!r} * cos(radians(lat)))", f"(({y1} - lat) * {k!r})"
    bx, by = f"(({x2} - lon) * {k!r} * cos(radians(lat)))", f"(({y2} - lat) * {k!r})"
    t = f"greatest(0.0, least(1.0, -({ax} * ({bx} - {ax}) + {ay} * ({by} - {ay})) / (({bx} - {ax}) ** 2 + ({by} - {ay}) ** 2)))"
    return f"sqrt(({ax} + {t} * ({bx} - {ax})) ** 2 + ({ay} + {t} * ({by} - {ay})) ** 2)"


def _line_sql(kind, line_type):
    for k, t, line in ROUTES:
        if (k, t) == (kind, line_type):
            parts = [_segment(f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)", f"CAST({c} AS DOUBLE)", f"CAST({e} AS DOUBLE)") for (a, b), (c, e) in zip(line, line[1:], strict=False)]
            return f"least({', '.join(parts)})" if len(parts) > 1 else parts[0]
    return "NULL"


@add("j11_distance_to_lines", P + f""" SELECT id, round(CASE kind WHEN 'click' THEN {_line_sql('click', 'RUNNING_LINE')} WHEN 'view' THEN {_line_sql('view', 'RUNNING_LINE')} END, 4) AS running_line_m,
  round(CASE kind WHEN 'click' THEN {_line_sql('click', 'WINNING_LINE')} END, 4) AS winning_line_m FROM points""")  # fmt: skip
def _(spark, d):
    out = joins.distance_to_lines(points(spark, d), routes(spark), "kind").select("id", "running_line_m", "winning_line_m")
    return rounded(out, "running_line_m", "winning_line_m", digits=4)


_M = "(6371.0::DOUBLE * 1000 * 3.141592653589793 / 180)"
#: Metres from (lon, lat) to the leg (x1, y1, x2, y2), and how far along its foot is.
_LEG = f"""a AS (SELECT *, (x1 - lon) * {_M} * cos(radians(lat)) AS px, (y1 - lat) * {_M} AS py, (x2 - x1) * {_M} * cos(radians(lat)) AS dx, (y2 - y1) * {_M} AS dy FROM met),
  b AS (SELECT *, greatest(0, least(1, coalesce(-(px * dx + py * dy) / nullif(dx * dx + dy * dy, 0), 0))) AS t FROM a), c AS (SELECT *, sqrt(pow(px + t * dx, 2) + pow(py + t * dy, 2)) AS m FROM b)"""


@add("j11_nearest_segment", f"""WITH {POINTS}, s AS (SELECT s_suppkey AS k, -84.6 + (s_suppkey * 37 % 101) / 200.0::DOUBLE AS x, 38 + (s_suppkey * 53 % 89) / 150.0::DOUBLE AS y FROM supplier),
  legs AS (SELECT k, 0 AS segment, x AS x1, y AS y1, x + 0.01 AS x2, y + k % 7 / 500.0::DOUBLE AS y2 FROM s UNION ALL SELECT k, 1, x + 0.01, y + k % 7 / 500.0::DOUBLE, x - 0.002, y + 0.02 FROM s),
  met AS (SELECT p.id, -84.6 + p.id % 1009 / 2000.0::DOUBLE AS lon, 38 + p.id % 787 / 1500.0::DOUBLE AS lat, l.* FROM points p, legs l), {_LEG},
  r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, k, segment) AS o FROM c) SELECT id, round(m, 4) AS distance_m FROM r WHERE o = 1""")  # fmt: skip
def _(spark, d):
    """Each point's nearest leg of the lines of all suppliers, without a course."""
    from stridelake.operators.nearest import nearest_segment

    k = F.col("s_suppkey")
    at = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    x, y = -84.6 + (k * 37 % 101) / 200.0, 38 + (k * 53 % 89) / 150.0
    lines = table(spark, d, "supplier").select(k.alias("k"), F.array(at(x, y), at(x + 0.01, y + k % 7 / 500.0), at(x - 0.002, y + 0.02)).alias("line"))
    p = points(spark, d).select("id", (-84.6 + F.col("id") % 1009 / 2000.0).alias("lon"), (38 + F.col("id") % 787 / 1500.0).alias("lat"))
    return rounded(nearest_segment(p, lines, [], "k", cell_m=400.0).select("id", "distance_m"), "distance_m", digits=4)


def _running_legs() -> str:
    """The legs of the running lines with the metres before each, as SQL rows."""
    from math import asin, cos, radians, sin, sqrt

    rows = []
    for kind, name, line in ROUTES:
        if name == "RUNNING_LINE":
            upto = 0.0
            for k, ((x1, y1), (x2, y2)) in enumerate(zip(line, line[1:], strict=False)):
                h = sin(radians(y2 - y1) / 2) ** 2 + cos(radians(y1)) * cos(radians(y2)) * sin(radians(x2 - x1) / 2) ** 2
                long = 2 * 6371000.0 * asin(sqrt(h))
                rows.append(f"('{kind}', {k}, {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE, {upto}::DOUBLE, {long}::DOUBLE)")
                upto += long
    return ", ".join(rows)


@add("a28_route_place", f"""WITH {POINTS}, legs(kind, k, x1, y1, x2, y2, upto, long) AS (VALUES {_running_legs()}), met AS (SELECT p.*, l.* EXCLUDE (kind) FROM points p LEFT JOIN legs l USING (kind)), {_LEG},
  placed AS (SELECT *, upto + t * long AS along, row_number() OVER (PARTITION BY id ORDER BY m, k) AS o FROM c),
  x AS (SELECT *, lag(lat) OVER w AS la, lag(lon) OVER w AS lo FROM placed WHERE o = 1 WINDOW w AS (PARTITION BY runner ORDER BY ts, id)),
  y AS (SELECT *, coalesce(2 * 6371000.0 * asin(sqrt(pow(sin(radians(lat - la) / 2), 2) + cos(radians(la)) * cos(radians(lat)) * pow(sin(radians(lon - lo) / 2), 2))), 0) AS step FROM x),
  z AS (SELECT *, sum(step) OVER w AS path, max(along) OVER w AS progress FROM y WINDOW w AS (PARTITION BY runner ORDER BY ts, id))
  SELECT id, round(m, 3) AS offset_m, round(along, 3) AS along_m, round(progress, 3) AS progress_m,
    round(path - first_value(CASE WHEN along IS NOT NULL THEN path END IGNORE NULLS) OVER w - (progress - first_value(along IGNORE NULLS) OVER w), 3) AS ground_loss_m
  FROM z WINDOW w AS (PARTITION BY runner ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")  # fmt: skip
def _(spark, d):
    from stridelake.operators.windows import place_on_route

    lines = routes(spark).filter("line_type = 'RUNNING_LINE'")
    out = place_on_route(points(spark, d), lines, "kind", ["runner"], ["ts", "id"])
    return rounded(out.select("id", "offset_m", "along_m", "progress_m", "ground_loss_m"), "offset_m", "along_m", "progress_m", "ground_loss_m", digits=3)


@add("j12_restrict_history", R + """, h AS (SELECT * FROM runners WHERE race_date < DATE '2000-01-01'), f AS (SELECT * FROM runners WHERE race_date >= DATE '2000-01-01')
  SELECT race, num, 'historical' AS data_flag FROM h WHERE jockey IN (SELECT jockey FROM f) UNION ALL SELECT race, num, 'future' FROM f""")  # fmt: skip
def _(spark, d):
    tasks = runner_tasks(spark, d)
    r = runners(spark, d, tasks)
    return joins.restrict_history(r.filter("race_date < date'2000-01-01'"), r.filter("race_date >= date'2000-01-01'"), "jockey", tasks=tasks).select("race", "num", "data_flag")


@add("w11_gate_spans", P + """, s AS (SELECT *, sum(speed) OVER (PARTITION BY runner ORDER BY ts, id) AS upto, min(ts) OVER (PARTITION BY runner) AS t0 FROM points)
  SELECT id, epoch_us(t0) + CAST(round((upto - speed) * 1e6) AS BIGINT) AS a, epoch_us(t0) + CAST(round(upto * 1e6) AS BIGINT) AS b FROM s""")  # fmt: skip
def _(spark, d):
    from pyspark.sql import Window

    p = points(spark, d).withColumn("t0", F.min("ts").over(Window.partitionBy("runner")))
    out = gate_spans(p, ["runner"], ["ts", "id"], "speed", "t0")
    return out.select("id", micros("span_start").alias("a"), micros("span_end").alias("b"))
