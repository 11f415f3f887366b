"""Forms for hot groups and large tables give what the plain forms give."""

import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.functions import parsing
from stridelake.operators import aggregates, cleaning, joins, quantiles, scoring, shaping, wager, windows
from stridelake.sources import tables
from stridelake.streaming import feeds

T0 = dt.datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lone_windows(df):
    """Windows whose rows all come to one partition."""
    return re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*Sort", plan_of(df)) and "Window" in plan_of(df)


@pytest.mark.parametrize("accuracy", [4, 10, 10_000])
@pytest.mark.parametrize("kind", ["spread", "ties", "one"])
def test_exact_quantiles_match_numpy(spark, accuracy, kind):
    random.seed(3)
    draw = {"spread": lambda: random.gauss(0, 9), "ties": lambda: float(random.randint(0, 3)), "one": lambda: 5.0}[kind]
    rows = [(random.choice(["a", "b", None]), draw() if random.random() > 0.1 else None, draw()) for _ in range(400)] + [("lone", 1.5, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    ps = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    got = {r["__k0"]: r for r in quantiles.exact_quantiles(df, ["g"], ["x", "y"], ps, accuracy).collect()}
    assert got.keys() == {"a", "b", None, "lone"}
    for g, r in got.items():
        for i, c in ((1, "x"), (2, "y")):
            own = [row[i] for row in rows if row[0] == g and row[i] is not None]
            assert (r[c] is None) == (not own)
            if own:
                assert np.allclose(r[c], np.quantile(own, ps))
    whole = quantiles.exact_quantiles(df, [], ["x"], ps, accuracy).collect()
    assert len(whole) == 1 and np.allclose(whole[0]["x"], np.quantile([r[1] for r in rows if r[1] is not None], ps))
    assert quantiles.exact_quantiles(df.limit(0), ["g"], ["x"], ps).count() == 0
    assert quantiles.with_quantiles(df, ["g"], ["x"], ps, "q_").count() == len(rows)


def test_quantile_users_stand_empty_tables_and_groups(spark):
    df = spark.createDataFrame([], "g string, x double, d date")
    assert cleaning.impute_ladder(df, ["x"], ["g"], stat="median").count() == 0
    assert cleaning.clamp_quantile(df, ["x"]).count() == 0 and cleaning.iqr(df, "x").count() == 0
    nulls = spark.createDataFrame([("a", None, None), (None, None, None)], "g string, x double, d date")
    assert [r["x"] for r in cleaning.impute_ladder(nulls, ["x"], ["g"], stat="median", final=7.0).collect()] == [7.0, 7.0]
    assert {str(r["d"]) for r in cleaning.impute_median_date(nulls, "d").collect()} == {"1970-01-01"}
    assert aggregates.distribution_by(nulls, ["g"], ["x"]).count() == 2


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_by_buckets_matches_a_plain_join(spark, closed, how):
    random.seed(7)
    stamp = lambda s: T0 + dt.timedelta(seconds=s)
    points = [(i, random.choice(["a", "b", None]), stamp(random.randint(-50, 5000))) for i in range(150)]
    spans = []
    for i in range(80):
        s = random.randint(0, 4000)
        spans.append((random.choice(["a", "b"]), i, stamp(s), stamp(s + random.choice([0, 1, 5, 60]))))
    spans += [("a", 900, stamp(-10**7), stamp(10**7)), ("b", 901, stamp(10), stamp(5)), ("a", 902, None, stamp(5))]
    p = spark.createDataFrame(points, "id long, k string, t timestamp")
    s = spark.createDataFrame(spans, "k string, span long, a timestamp, b timestamp")
    got = joins.interval_join(p, s, ["k"], "t", "a", "b", closed, how)
    assert got.columns == ["id", "k", "t", "span", "a", "b"]
    inside = lambda t, a, b: a is not None and a <= t and (t <= b if closed == "both" else t < b)
    want = []
    for i, k, t in points:
        own = [x for kk, x, a, b in spans if k == kk and inside(t, a, b)]
        want += [(i, x) for x in own] or [(i, None)] * (how == "left")
    key = lambda x: (x[0], x[1] is None, x[1] or 0)
    assert sorted(((r["id"], r["span"]) for r in got.collect()), key=key) == sorted(want, key=key)
    assert joins.interval_join(p, s.limit(0), ["k"], "t", "a", "b", closed, how).count() == (len(points) if how == "left" else 0)


def test_asof_rows_of_a_null_key_stay_without_a_partner(spark):
    left = spark.createDataFrame([(1, None, T0), (2, "a", T0), (3, None, T0)], "id long, k string, t timestamp")
    right = spark.createDataFrame([(None, T0, 1), ("a", T0, 2)], "k string, t timestamp, v int")
    got = {r["id"]: r["v"] for r in joins.asof_join(left, right.withColumnRenamed("t", "rt"), ["k"], "t", "rt", ["v"]).collect()}
    assert got == {1: None, 2: 2, 3: None}
    inner = joins.asof_join(left, right.withColumnRenamed("t", "rt"), ["k"], "t", "rt", ["v"], how="inner")
    assert [r["id"] for r in inner.collect()] == [2]


def test_group_forms_match_windows(spark):
    random.seed(1)
    df = spark.createDataFrame([(random.choice(["a", "b", None]), i, random.random() * 10, random.random() > 0.01) for i in range(200)], "g string, i long, x double, ok boolean")
    w = Window.partitionBy("g")
    rows = lambda d, *c: sorted(map(str, d.select("i", *c).collect()))
    assert rows(windows.field_size(df, ["g"]), "field_size") == rows(df.withColumn("field_size", F.count(F.lit(1)).over(w)), "field_size")
    assert rows(windows.previous_event(df, ["g"], ["i"], {"x": -1.0}), "prev_x", "total_count", "prior_count") == rows(
        df.withColumns({"prev_x": F.coalesce(F.lag("x").over(w.orderBy("i")), F.lit(-1.0)), "total_count": F.count(F.lit(1)).over(w), "prior_count": F.row_number().over(w.orderBy("i")) - 1}), "prev_x", "total_count", "prior_count"
    )
    full = aggregates.full_coverage(df, ["g"], "ok")
    assert rows(full) == rows(df.withColumn("m", F.min(F.col("ok").cast("int")).over(w)).filter("m = 1"))
    for made in (windows.field_size(df, ["g"]), full, scoring.speed_index(df, ["g"], "x"), joins.add_group_stats(df, ["g"], {"m": F.avg("x")})):
        assert "Window" not in plan_of(made)


def test_running_ledger_by_days_matches_one_window(spark):
    random.seed(2)
    rows = [(random.choice(["a", None]), random.choice([1, 2, 3, None]), i, 2.0, random.choice([0.0, 5.0, None])) for i in range(120)]
    df = spark.createDataFrame(rows, "track string, day int, i long, cost double, payoff double")
    w = Window.partitionBy("track").orderBy("day", "i").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("i", F.row_number().over(Window.partitionBy("track").orderBy("day", "i")).alias("n"), F.sum("cost").over(w).alias("c"), F.coalesce(F.sum("payoff").over(w), F.lit(0.0)).alias("p"))
    got = windows.running_ledger(df, ["track"], ["day", "i"])
    assert sorted((r["i"], r["bet_no"], r["cum_cost"], r["cum_payoff"]) for r in got.collect()) == sorted((r["i"], r["n"], r["c"], r["p"]) for r in plain.collect())


def test_time_folds_have_no_lone_window(spark):
    df = spark.createDataFrame([(g, T0 + dt.timedelta(days=g % 4)) for g in range(23) for _ in range(2)], "g long, t timestamp")
    folds = shaping.time_folds(df, "g", "t", 3)
    assert not lone_windows(folds)
    ordered = sorted(range(23), key=lambda g: (g % 4, g))
    size, rest = divmod(23, 4)
    block = {g: (i // (size + 1) if i < rest * (size + 1) else rest + (i - rest * (size + 1)) // size) for i, g in enumerate(ordered)}
    want = sorted((f, "train" if block[g] < f else "valid", g) for f in (1, 2, 3) for g in range(23) if block[g] <= f for _ in range(2))
    assert sorted((r["fold"], r["part"], r["g"]) for r in folds.collect()) == want


def test_bankroll_streams_a_strategy_of_many_bets(spark):
    bets = spark.range(250_000).select((F.col("id") % 2).alias("s"), F.col("id").alias("i"), F.lit(1.0).alias("cost"), F.when(F.col("id") % 10 < 2, 3.0).otherwise(0.0).alias("payoff"))
    got = {r["s"]: r for r in wager.bankroll_path(bets, "s", ["i"], 10.0).collect()}
    for s in (0, 1):
        money, placed, low = 10.0, 0, 10.0
        for i in range(s, 250_000, 2):
            if money >= 1:
                money += (3.0 if i % 10 < 2 else 0.0) - 1
                placed, low = placed + 1, min(low, money)
        assert (got[s]["bets"], got[s]["placed"], got[s]["final_bankroll"], got[s]["lowest_bankroll"]) == (125_000, placed, money, low)
    assert "collect_list" not in plan_of(wager.bankroll_path(bets, "s", ["i"], 10.0))
    assert wager.bankroll_path(bets.limit(0), "s", ["i"], 10.0).count() == 0


@pytest.mark.parametrize(("name", "want"), [("6f", 6.0), ("5.5f", 5.5), ("6f5ft", 6 + 5 / 660), ("5.5f5.5ft", 5.5 + 5.5 / 660), (" Finish ", 9999.0), ("prefinish", None), ("6fxyz", None), ("finish2", None), ("6f5", None), ("", None), (None, None)])
def test_gate_names_are_read_whole(spark, name, want):
    got = spark.createDataFrame([(name,)], "g string").select(parsing.gate_number(F.col("g")).alias("x")).head()["x"]
    assert got == want if want is None else abs(got - want) < 1e-12


def test_card_children_and_stats(spark, tmp_path):
    stat = '<stats_data><stat type="LIFE"><starts>4</starts><wins>1</wins><roi>2.5</roi></stat><stat><starts>9</starts></stat></stats_data>'
    horse = f"<horsedata><program>1</program><axciskey>H1</axciskey>{stat}<jockey><jock_key>J1</jock_key><jock_disp>Jo</jock_disp>{stat}</jockey><trainer><tran_disp>no key</tran_disp></trainer><sire><sirename>S</sirename><stud_fee>5</stud_fee></sire><dam><damname>D</damname><damsire>X</damsire></dam></horsedata>"
    (tmp_path / "card.xml").write_text(f"<cards><racedata><track>AB</track><race>1</race><country>CAN</country><claimamt>5000</claimamt><partim>71.5</partim>{horse}{horse.replace('H1', 'H2')}</racedata></cards>")
    got = tables.read_xml_cards(spark, f"file://{tmp_path}/card.xml")
    assert got["races"].select("country", "claimamt", "partim").collect() == [("CAN", 5000.0, 71.5)]
    assert got["jockeys"].select("jock_key", "jock_disp").collect() == [("J1", "Jo")] and got["trainers"].count() == 0
    assert got["sires"].select("sirename", "stud_fee").collect() == [("S", "5")] and got["dams"].select("damsire").collect() == [("X",)]
    stats = {(r["owner"], r["owner_key"]): (r["type"], r["starts"], r["shows"], r["roi"]) for r in got["stats"].collect()}
    assert stats == {("horse", "H1"): ("LIFE", 4.0, 0.0, 2.5), ("horse", "H2"): ("LIFE", 4.0, 0.0, 2.5), ("jockey", "J1"): ("LIFE", 4.0, 0.0, 2.5)}
    assert got["horses"].columns == ["track", "race_date", "race", "number", "horse_name", "program", "morn_odds", "weight", "axciskey"]


def test_all_tables_of_a_folder_are_loaded(spark, tmp_path):
    spark.range(3).write.parquet(f"file://{tmp_path}/a.parquet")
    (tmp_path / "b.parquet").write_bytes(b"")
    (tmp_path / "c.txt").write_text("x")
    assert {n: f.count() for n, f in tables.load_tables(spark, f"file://{tmp_path}").items()} == {"a": 3}


def feed_of(spark, folder, files):
    """A stream of a file a trigger."""
    schema = "runner long, id long, ts timestamp, speed double"
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return feeds.gps_stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema, ["runner", "id"], "ts", "2 hours", max_files=1)


def test_streamed_profiles_and_sessions_over_triggers_equal_the_batch(spark, tmp_path):
    random.seed(4)
    stamp = lambda h: T0 + dt.timedelta(hours=h)
    days = [[(random.randint(1, 3), 100 * day + i, stamp(24 * day + i * 0.7), random.random()) for i in range(20)] for day in range(3)]
    days[1].append(days[1][0])  # a point that comes twice
    closing = [[(None, -1, stamp(10_000), 0.0)]]
    for name, form in (("p", lambda s: feeds.stream_profile(s, ["runner"], "ts", "speed", "6 hours")), ("s", lambda s: feeds.stream_sessions(s, ["runner"], "ts", "3 hours"))):
        at = f"file://{tmp_path}/{name}"
        stream = form(feed_of(spark, at, days + closing))
        query = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/check").trigger(availableNow=True).start()
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
        got = spark.read.schema(stream.schema).parquet(f"{at}/out").filter("runner is not null")
        batch = form(spark.createDataFrame([r for d in days for r in d], "runner long, id long, ts timestamp, speed double").dropDuplicates(["runner", "id"]))
        rounded = lambda df: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())
        assert rounded(got) == rounded(batch) and got.count() > 3


def test_streamed_upsert_over_triggers_keeps_the_last_rows_and_misses_no_version(spark, tmp_path):
    at = f"file://{tmp_path}/u"
    files = [[(1, 1, T0, 1.0), (2, 2, T0, 1.0)], [(1, 3, T0, 2.0)], [(3, 4, T0, 3.0), (2, 5, T0, 9.0)]]
    stream = feed_of(spark, at, files).select("runner", "id", "speed")
    feeds.stream_upsert(stream, f"{at}/table", ["runner"], [F.desc("id")], f"{at}/check").awaitTermination()
    assert sorted(map(tuple, feeds.current_version(spark, f"{at}/table").collect())) == [(1, 3, 2.0), (2, 5, 9.0), (3, 4, 3.0)]
    assert sorted(p.name for p in (tmp_path / "u" / "table").iterdir() if p.is_dir()) == ["table-v1", "table-v2"]
    (tmp_path / "u" / "table" / "table-v2" / "_SUCCESS").unlink()
    spark.createDataFrame([(9, 9, T0, 1.0)], "runner long, id long, ts timestamp, speed double").write.mode("append").parquet(f"{at}/in")
    with pytest.raises(Exception, match="version 2"):
        feeds.stream_upsert(stream, f"{at}/table", ["runner"], [F.desc("id")], f"{at}/check").awaitTermination()
