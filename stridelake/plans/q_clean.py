"""Queries of imputation and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelake.functions.numeric import relevance
from stridelake.operators import cleaning as C
from stridelake.operators.windows import locf
from stridelake.plans.roles import POINTS, RUNNERS, Group, points, rounded, runner_tasks, runners, table

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add
R, P = f"WITH {RUNNERS}", f"WITH {POINTS}"
SERIES = "PARTITION BY runner ORDER BY ts, id"


@add("i1_impute_mean", P + " SELECT id, round(coalesce(gappy, avg(gappy) OVER (PARTITION BY kind), avg(gappy) OVER (), 0), 6) AS gappy FROM points")
def _(spark, d):
    return rounded(C.impute_ladder(points(spark, d), ["gappy"], ["kind"], final=0.0).select("id", "gappy"), "gappy")


@add("i2_impute_median", P + ", m AS (SELECT kind, quantile_cont(gappy, 0.5) AS m FROM points GROUP BY kind) SELECT id, round(coalesce(gappy, m, (SELECT quantile_cont(gappy, 0.5) FROM points)), 6) AS gappy FROM points JOIN m USING (kind)")
def _(spark, d):
    return rounded(C.impute_ladder(points(spark, d), ["gappy"], ["kind"], stat="median").select("id", "gappy"), "gappy")


@add("i3_impute_override", P + " SELECT id, round(coalesce(gappy, CASE WHEN kind = 'purchase' THEN 0 END, avg(gappy) OVER (PARTITION BY runner), avg(gappy) OVER ()), 6) AS gappy FROM points")
def _(spark, d):
    return rounded(C.impute_ladder(points(spark, d), ["gappy"], ["runner"], override=F.col("kind") == "purchase").select("id", "gappy"), "gappy")


@add("i4_locf_ladder", P + f" SELECT id, round(coalesce(gappy, last_value(gappy IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), avg(gappy) OVER (PARTITION BY kind), avg(gappy) OVER ()), 6) AS gappy FROM points")
def _(spark, d):
    carried = locf(points(spark, d), ["runner"], ["ts", "id"], ["gappy"], include_current=True)
    return rounded(C.impute_ladder(carried, ["gappy"], ["kind"], pre={"gappy": F.col("gappy_ffill")}).select("id", "gappy"), "gappy")


@add("i5_par_ladder", R + """, x AS (SELECT race, num, track, surface, race_date, CASE WHEN race % 3 = 0 THEN NULL ELSE price END AS par FROM runners),
  y AS (SELECT *, coalesce(last_value(par IGNORE NULLS) OVER (PARTITION BY track, surface ORDER BY race_date, race, num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(par IGNORE NULLS) OVER (PARTITION BY track, surface ORDER BY race_date, race, num ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS f FROM x)
  SELECT race, num, round(coalesce(f, (SELECT avg(par) FROM x)), 4) AS par FROM y""")  # fmt: skip
def _(spark, d):
    from stridelake.operators.windows import fill_both

    x = runners(spark, d).withColumn("par", F.when(F.col("race") % 3 != 0, F.col("price")))
    filled = fill_both(x.select("race", "num", "track", "surface", "race_date", "par"), ["track", "surface"], ["race_date", "race", "num"], ["par"], hot_rows=10_000)
    return rounded(C.impute_ladder(filled, ["par"], []).select("race", "num", "par"), "par", digits=4)


@add("i6_median_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN (SELECT DATE '1970-01-01' + CAST(floor(quantile_cont(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)), 0.5)) AS INTEGER) FROM orders WHERE o_orderkey % 5 <> 0) ELSE CAST(o_orderdate AS DATE) END AS day FROM orders")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.to_date("o_orderdate")).alias("day"))
    return C.impute_median_date(o, "day")


@add("i7_fill_defaults", P + " SELECT id, coalesce(gappy, -1.0) AS gappy, CASE WHEN gappy IS NULL THEN 1 ELSE 0 END AS gappy_was_missing, CASE WHEN kind = 'view' THEN 'NONE' ELSE kind END AS kind, CASE WHEN kind = 'view' THEN 1 ELSE 0 END AS kind_was_missing FROM points")
def _(spark, d):
    p = points(spark, d).select("id", "gappy", F.when(F.col("kind") == "view", "  ").otherwise(F.col("kind")).alias("kind"))
    return C.fill_defaults(p, {"gappy": -1.0, "kind": "NONE"}, flags=True)


@add("i8_complete_or_zero", P + " SELECT id, coalesce(gappy, 0) AS gappy FROM points WHERE kind <> 'click' OR gappy IS NOT NULL")
def _(spark, d):
    return C.complete_or_zero(points(spark, d), "kind", "click", ["gappy"]).select("id", "gappy")


@add("i9_finite_or_null", P + " SELECT id, CASE WHEN id % 10 IN (0, 1) THEN NULL ELSE speed END AS speed FROM points")
def _(spark, d):
    odd = F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).when(F.col("id") % 10 == 1, F.lit(float("-inf"))).otherwise(F.col("speed"))
    return C.finite_or_null(points(spark, d).select("id", odd.alias("speed")), ["speed"])


@add("i10_clamp", P + " SELECT id, CASE WHEN gappy IS NULL THEN NULL ELSE least(greatest(gappy, 5.0), 40.0) END AS gappy, greatest(stride, 1.2) AS stride FROM points")
def _(spark, d):
    return C.clamp(points(spark, d).select("id", "gappy", "stride"), {"gappy": (5.0, 40.0), "stride": (1.2, None)})


@add("i11_clamp_quantile", P + ", q AS (SELECT quantile_cont(gappy, 0.01) AS lo, quantile_cont(gappy, 0.99) AS hi FROM points) SELECT id, round(CASE WHEN gappy IS NOT NULL THEN least(greatest(gappy, lo), hi) END, 6) AS gappy FROM points, q")
def _(spark, d):
    return rounded(C.clamp_quantile(points(spark, d).select("id", "gappy"), ["gappy"]), "gappy")


QUARTILES = "q AS (SELECT quantile_cont(gappy, 0.25) AS a, quantile_cont(gappy, 0.75) AS b FROM points), x AS (SELECT id, kind, gappy, a - 1.5 * (b - a) AS lo, b + 1.5 * (b - a) AS hi FROM points, q)"


@add("i12_iqr_list", P + f", {QUARTILES} SELECT id, gappy FROM x WHERE gappy < lo OR gappy > hi")
def _(spark, d):
    return C.iqr(points(spark, d).select("id", "gappy"), "gappy")


@add("i12_iqr_remove", P + f", {QUARTILES} SELECT id, gappy FROM x WHERE NOT coalesce(gappy < lo OR gappy > hi, FALSE)")
def _(spark, d):
    return C.iqr(points(spark, d).select("id", "gappy"), "gappy", "remove")


@add("i12_iqr_cap", P + f", {QUARTILES} SELECT id, round(CASE WHEN gappy IS NOT NULL THEN least(greatest(gappy, lo), hi) END, 6) AS gappy FROM x")
def _(spark, d):
    return rounded(C.iqr(points(spark, d).select("id", "gappy"), "gappy", "cap"), "gappy")


@add("i12_iqr_mean", P + f", {QUARTILES} SELECT id, round(CASE WHEN gappy < lo OR gappy > hi THEN avg(CASE WHEN NOT (gappy < lo OR gappy > hi) THEN gappy END) OVER (PARTITION BY kind) ELSE gappy END, 6) AS gappy FROM x")
def _(spark, d):
    return rounded(C.iqr(points(spark, d).select("id", "kind", "gappy"), "gappy", "mean", group=["kind"]).select("id", "gappy"), "gappy")


@add("i13_seed_unseen", R + """, h AS (SELECT * FROM runners WHERE race_date < DATE '1996-01-01'), f AS (SELECT * FROM runners WHERE race_date >= DATE '1996-01-01')
  SELECT trainer, round(price, 4) AS price, 0 AS first_time FROM h UNION ALL SELECT trainer, (SELECT round(avg(price), 4) FROM h), 1 FROM (SELECT DISTINCT trainer FROM f WHERE trainer NOT IN (SELECT trainer FROM h))""")  # fmt: skip
def _(spark, d):
    r = runners(spark, d).select("trainer", "price", "race_date")
    out = C.seed_unseen(r.filter("race_date < date'1996-01-01'"), r.filter("race_date >= date'1996-01-01'"), "trainer", ["price"])
    return rounded(out.select("trainer", "price", "first_time"), "price", digits=4)


@add("i14_relevance", R + """ SELECT race, num, round(pow(0.8::DOUBLE, finish - 1), 6) AS decay, round(CASE finish WHEN 1 THEN 70 WHEN 2 THEN 56 WHEN 3 THEN 44 WHEN 4 THEN 34 ELSE 30 / ln(4 + finish) END, 6) AS points,
  CASE WHEN finish <= 4 THEN 1 ELSE 0 END AS top4, CAST(least(finish, 8) - 1 AS INTEGER) AS class8 FROM runners""")  # fmt: skip
def _(spark, d):
    out = runners(spark, d).select("race", "num", *(relevance(F.col("finish"), s).alias(s) for s in ("decay", "points", "top4", "class8")))
    return rounded(out, "decay", "points")


@add("i15_carry_score", R + """, h AS (SELECT * FROM runners WHERE race_date < DATE '1998-01-01'), f AS (SELECT race, num, trainer, race_date FROM runners WHERE race_date >= DATE '1998-01-01'),
  s AS (SELECT trainer, race_date, max(score) AS score FROM h GROUP BY ALL),
  j AS (SELECT f.race, f.num, s.score FROM f ASOF LEFT JOIN s ON f.trainer = s.trainer AND f.race_date >= s.race_date), m AS (SELECT race, quantile_cont(score, 0.5) AS m FROM j GROUP BY race)
  SELECT race, num, round(coalesce(score, m, (SELECT quantile_cont(score, 0.5) FROM h)), 6) AS score FROM j JOIN m USING (race)""")  # fmt: skip
def _(spark, d):
    tasks = runner_tasks(spark, d)
    r = runners(spark, d, tasks)
    future = r.filter("race_date >= date'1998-01-01'").select("race", "num", "trainer", "race_date")
    out = C.carry_score(r.filter("race_date < date'1998-01-01'"), future, "trainer", "race_date", "score", ["race"], tasks)
    return rounded(out.select("race", "num", "score"), "score")


@add("i16_past_sequences", R + """, x AS (SELECT race, num, list(price) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS p FROM runners WINDOW w AS (PARTITION BY horse ORDER BY race_date, race, num))
  SELECT race, num, CAST(len(p) AS INTEGER) AS n_events, CASE WHEN len(p) = 3 THEN p[1] ELSE -999.0 END AS third_last, p[len(p)] AS last FROM x WHERE len(p) >= 2""")  # fmt: skip
def _(spark, d):
    out = C.past_sequences(runners(spark, d), ["horse"], ["race_date", "race", "num"], ["price", "score"], 3, 2)
    return out.select("race", "num", "n_events", F.get("sequence", F.lit(0))["price"].alias("third_last"), F.get("sequence", F.lit(2))["price"].alias("last"))


@add("f15_cap_sequence", """WITH e AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), q AS (SELECT i, quantile_cont(CAST(v AS DOUBLE), 0.05) AS lo, quantile_cont(CAST(v AS DOUBLE), 0.95) AS hi FROM e GROUP BY i)
  SELECT vec_id, round(sum(least(greatest(v, lo), hi)), 4) AS total FROM e JOIN q USING (i) GROUP BY vec_id""")  # fmt: skip
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    capped = C.cap_sequence(e, "embedding", (0.05, 0.95))
    return capped.select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@add("i17_encode_pipeline", R + " SELECT race, num, (SELECT CAST(count(DISTINCT track) + count(DISTINCT surface) + 2 AS INTEGER) FROM runners WHERE race_date < DATE '1998-01-01') AS width, round(score / (SELECT stddev_samp(score) FROM runners WHERE race_date < DATE '1998-01-01'), 6) AS scaled_score FROM runners")
def _(spark, d):
    from pyspark.ml.functions import vector_to_array

    r = runners(spark, d).select("race", "num", "track", "surface", "price", "score", "race_date")
    model = C.encode_pipeline(["track", "surface"], ["price", "score"]).fit(r.filter("race_date < date'1998-01-01'"))
    values = vector_to_array("features")
    return model.transform(r).select("race", "num", F.size(values).alias("width"), F.round(F.element_at(values, -1), 6).alias("scaled_score"))
