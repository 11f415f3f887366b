"""Hand-computed frames: empty input, one row, nulls, ties, repeated keys, zero denominators."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stridelake.functions import geometry, numeric, parsing
from stridelake.operators import aggregates, cleaning, joins, scoring, sets, shaping, wager, windows
from stridelake.sources import tables

T0 = dt.datetime(2024, 1, 1, 12)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).head()


def test_asof_join_is_never_late_and_keeps_one_row(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 9, 3), (None, 5, 4), ("a", None, 5)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 5, 10), ("a", 5, 11), ("a", 3, 12), (None, 1, 13), ("a", 7, 14)], "k string, s int, v int")
    got = {r["id"]: r["v"] for r in joins.asof_join(left, right, ["k"], "t", "s", ["v"], tie=["v"]).collect()}
    assert got == {1: 11, 2: None, 3: None, 4: None, 5: None}
    strict = {r["id"]: r["v"] for r in joins.asof_join(left, right, ["k"], "t", "s", ["v"], strict=True, tie=["v"]).collect()}
    assert strict[1] == 12
    ahead = {r["id"]: r["v"] for r in joins.asof_join(left, right, ["k"], "t", "s", ["v"], direction="forward", tie=["v"]).collect()}
    assert ahead[1] == 10 and ahead[2] == 12
    assert joins.asof_join(left.limit(0), right, ["k"], "t", "s", ["v"]).count() == 0


def test_near_join_meets_bucket_edges_once_and_restores_the_rest(spark):
    left = spark.createDataFrame([("a", at(0.999)), ("a", at(50)), (None, at(1))], "k string, ts timestamp")
    right = spark.createDataFrame([("a", at(1.001), 1), ("a", at(0.749), 2), ("a", at(0.748), 3)], "k string, ts timestamp, v int")
    got = sorted((r["k"] or "", r["v"] or 0) for r in joins.near_join(left, right, ["k"], "ts", 250, ["v"]).collect())
    assert got == [("", 0), ("a", 0), ("a", 1), ("a", 2)]


def test_interval_join_counts_a_border_once(spark):
    points = spark.createDataFrame([("a", at(1)), ("a", at(2))], "k string, ts timestamp")
    spans = spark.createDataFrame([("a", at(0), at(1), 1), ("a", at(1), at(2), 2)], "k string, s timestamp, e timestamp, g int")
    assert [r["g"] for r in joins.interval_join(points, spans, ["k"], "ts", "s", "e").collect()] == [2]
    assert joins.interval_join(points, spans, ["k"], "ts", "s", "e", closed="both").count() == 3


def test_prior_windows_never_use_the_row_itself(spark):
    df = spark.createDataFrame([("h", i, v) for i, v in enumerate([10.0, None, 30.0, 0.0, 50.0])], "h string, d int, v double")
    got = windows.prior_n(df, ["h"], ["d"], 2, {"a": F.avg("v"), "n": F.count("v")}).orderBy("d").collect()
    assert [r["a"] for r in got] == [None, 10.0, 10.0, 30.0, 15.0] and [r["n"] for r in got] == [0, 1, 1, 1, 2]
    assert [r["avg_v_3"] for r in windows.prior_avg_where(df, ["h"], ["d"], 3, ["v"]).orderBy("d").collect()] == [None, 10.0, 10.0, 20.0, 30.0]
    assert [r["v_prev"] for r in windows.locf(df, ["h"], ["d"], ["v"]).orderBy("d").collect()] == [None, 10.0, 10.0, 30.0, 0.0]


def test_prior_delta_and_layoff(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 10), dt.date(2024, 3, 30)]
    df = spark.createDataFrame([("h", d, float(i)) for i, d in enumerate(days)], "h string, d date, v double")
    got = windows.days_since(windows.prior_delta(df, ["h"], ["d"], "v", "x"), ["h"], ["d"], "d").orderBy("d").collect()
    assert [r["x"] for r in got] == [None, 0.0, 1.0] and [r["layoff"] for r in got] == ["N/A", "short", "long"]


def test_kinematics_with_equal_times(spark):
    df = spark.createDataFrame([("a", 1, at(0), 1.0), ("a", 2, at(0), 3.0), ("a", 3, at(0.5), 4.0)], "k string, i int, ts timestamp, v double")
    got = windows.kinematics(df, ["k"], ["ts", "i"], "v", "ts").orderBy("i").collect()
    assert [r["dt"] for r in got] == [None, 0.0, 0.5] and [r["acceleration"] for r in got] == [None, None, 2.0]


def test_softmax_sums_to_one_and_stands_large_scores(spark):
    df = spark.createDataFrame([("r", 1, 1e9), ("r", 2, -1e9), ("s", 1, 0.0), ("s", 2, 0.0)], "r string, i int, s double")
    got = windows.softmax(df, ["r"], "s").groupBy("r").agg(F.sum("prob").alias("p")).collect()
    assert all(math.isclose(r["p"], 1.0) for r in got)


def test_career_stats_leave_out_the_day_itself(spark):
    d = [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 5)]
    df = spark.createDataFrame([("h", x, i + 1, 10.0) for i, x in enumerate(d)], "h string, d date, fin int, e double")
    got = {r["as_of_date"]: (r["starts"], r["wins"], r["earnings"], r["win_pct"]) for r in aggregates.career_stats(df, ["h"], "d", "fin", "e").collect()}
    assert got == {d[0]: (0, 0, 0.0, 0.0), d[2]: (2, 1, 20.0, 0.5)}


def test_ntile_pivot_needs_one_shuffle(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(8)], "k string, i int, v double")
    out = aggregates.ntile_pivot(df, ["k"], ["i"], 4, {"v": F.col("v")})
    assert [out.head()[f"v_q{q}"] for q in (1, 2, 3, 4)] == [0.5, 2.5, 4.5, 6.5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_parsers(spark):
    got = one(
        spark, a=parsing.gate_number(F.lit("6f5ft")), b=parsing.gate_number(F.lit("x")), c=parsing.odds_to_prob(F.lit("10/1")), d=parsing.odds_to_prob(F.lit("1/0")),
        e=parsing.parse_duration(F.lit("1:10.5")), f=parsing.parse_winners(F.lit("6-1/4/7-5")), g=parsing.cloth_number(F.lit("AB 7")), h=parsing.safe_num(F.lit("1e9"), max_abs=100.0),
        i=parsing.parse_date(F.lit("nonsense"), default="1970-01-01"), j=parsing.pad_array(F.array(F.lit(1), F.lit(2), F.lit(3)), 2, F.lit(0), "left"), k=parsing.parse_winners(F.lit(" ")),
    )
    assert got["a"] == 6 + 5 / 660 and got["b"] is None and got["c"] == pytest.approx(1 / 11) and got["d"] is None and got["e"] == 70.5
    assert got["f"] == [["6"], ["1", "4", "7"], ["5"]] and got["g"] == "7" and got["h"] is None and got["i"] == dt.date(1970, 1, 1) and got["j"] == [1, 2] and got["k"] == []


def test_race_identifier_round_trip(spark):
    coded = parsing.race_identifier(F.lit("cd"), F.lit("2024-05-04").cast("date"), F.lit(7))
    back = one(spark, x=parsing.decode_race_identifier(coded))["x"]
    assert (back["course"], back["date"], back["number"]) == ("CD", dt.date(2024, 5, 4), 7)


def test_geometry(spark):
    point = lambda x, y: F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat"))
    got = one(
        spark, km=geometry.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), "km"), m=geometry.line_distance(F.lit(0.0), F.lit(1.0), F.array(point(-1.0, 0.0), point(1.0, 0.0))),
        same=geometry.line_distance(F.lit(2.0), F.lit(0.0), F.array(point(2.0, 0.0))), none=geometry.haversine(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0)),
    )
    assert got["km"] == pytest.approx(111.195, abs=1e-3) and got["m"] == pytest.approx(111194.9, abs=1) and got["same"] == 0 and got["none"] is None


@pytest.mark.parametrize("p", [1e-9, 0.01, 0.3, 0.5, 0.975, 1 - 1e-6])
def test_inverse_normal(spark, p):
    z = one(spark, z=numeric.inv_norm(F.lit(p)))["z"]
    assert 0.5 * math.erfc(-z / math.sqrt(2)) == pytest.approx(p, rel=1e-6)


def test_imputation_ladder(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 3.0)], "g string, v double")
    assert sorted(r["v"] for r in cleaning.impute_ladder(df, ["v"], ["g"]).collect()) == [1.0, 1.0, 2.0, 3.0]
    nothing = spark.createDataFrame([("a", None)], "g string, v double")
    assert cleaning.impute_ladder(nothing, ["v"], ["g"], final=0.0).head()["v"] == 0.0
    assert cleaning.impute_ladder(nothing.limit(0), ["v"], ["g"]).count() == 0


def test_tickets_are_all_permutations_and_settle(spark):
    races = spark.createDataFrame([(1, str(n), s) for n, s in zip(range(1, 6), (0.9, 0.5, 0.45, 0.4, 0.1), strict=True)], "race int, num string, score double")
    frame = wager.race_frame(races, ["race"], "num", "score")
    boxed = wager.tickets(frame.withColumn("style", F.lit("BOX123")))
    assert boxed.count() == 6
    winners = spark.createDataFrame([(1, [["2"], ["1", "5"], ["3"]], 30.0, 2.0)], "race int, winners array<array<string>>, posted_payoff double, posted_base double")
    settled = wager.settle(boxed.withColumn("stake", F.lit(1.0)), winners, ["race"])
    assert settled.filter("hit").count() == 1 and settled.agg(F.sum("payoff")).head()[0] == 15.0
    assert wager.settle(boxed.withColumn("stake", F.lit(1.0)).repartition(7), winners, ["race"]).agg(F.sum("payoff")).head()[0] == 15.0


def test_bankroll_stops_betting_when_it_is_spent(spark):
    bets = spark.createDataFrame([("s", i, 10.0, p) for i, p in enumerate([0.0, 0.0, 50.0, 0.0])], "s string, i int, cost double, payoff double")
    got = wager.bankroll_path(bets, "s", ["i"], 15.0).head()
    assert (got["bets"], got["placed"], got["final_bankroll"], got["lowest_bankroll"]) == (4, 1, 5.0, 5.0)


def test_grid_and_sweep_match_plain_filters(spark):
    rows = [(i / 10, (i * 7 % 10) / 10, 2.0, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, cost double, payoff double")
    for r in wager.grid_search(df, {"a": [0.2, 0.5], "b": [0.3]}).collect():
        own = [x for x in rows if x[0] >= r["min_a"] and x[1] >= r["min_b"]]
        assert (r["bets"], r["payoff"]) == (len(own), sum(x[3] for x in own))
    for r in aggregates.threshold_sweep(df, "a", [0.1, 0.45]).collect():
        assert r["bets"] == sum(x[0] > r["threshold"] for x in rows)


def test_temperature_is_near_the_truth(spark):
    import random

    random.seed(0)
    rows = []
    for race in range(400):
        scores = [random.gauss(0, 2) for _ in range(5)]
        weights = [math.exp(s / 2.0) for s in scores]
        won = random.choices(range(5), weights)[0]
        rows += [(race, s, int(i == won)) for i, s in enumerate(scores)]
    got = scoring.fit_temperature(spark.createDataFrame(rows, "race int, s double, win int"), ["race"], "s", "win").head()
    assert 1.5 < got["temperature"] < 2.7


def test_sets_and_keys(spark):
    df = spark.createDataFrame([("10", 1), ("2", 1), ("1A", 1), ("1", 1), ("x", 2)], "p string, g int")
    assert [r["p"] for r in df.orderBy(sets.natural_key(F.col("p"))).collect()] == ["x", "1", "1A", "2", "10"]
    assert aggregates.duplicate_keys(df, ["g"]).collect()[0]["n"] == 4
    with pytest.raises(ValueError, match="repeat"):
        aggregates.assert_unique(df, ["g"])
    assert [r["p"] for r in sets.dedupe(df, ["g"], [F.desc("p")]).orderBy("g").collect()] == ["2", "x"]


def test_upsert_policies_and_ledger(spark):
    base, delta = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "k int, v string")
    assert sorted(map(tuple, tables.upsert(base, delta, ["k"], ["v"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, tables.upsert(base, delta, ["k"], ["v"], "nothing").collect())) == [(1, "a"), (2, "b"), (3, "d")]
    ledger = tables.ledger_rows(base, "k", "job")
    assert [r["k"] for r in tables.unprocessed(delta.select("k").distinct(), ledger, "k", "job").collect()] == [3]
    assert tables.unprocessed(base, ledger, "k", "other").count() == 2


def test_time_folds_and_trim(spark):
    df = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i // 2)) for i in range(8)], "g int, d date")
    got = shaping.time_folds(df, "g", "d", 3).groupBy("fold", "part").count().collect()
    assert {(r["fold"], r["part"]): r["count"] for r in got} == {(1, "train"): 2, (1, "valid"): 2, (2, "train"): 4, (2, "valid"): 2, (3, "train"): 6, (3, "valid"): 2}
    series = spark.createDataFrame([("a", i, v) for i, v in enumerate([3, 1, 0, 0])], "k string, i int, v int")
    assert shaping.trim_after_first(series, ["k"], "i", F.col("v") == 0).count() == 3
