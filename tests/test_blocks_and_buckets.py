"""Bets in blocks, tables in buckets, kinds of columns by sketches, and joins that keep their left rows."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from stridelake.operators import cleaning, joins, shaping, wager
from stridelake.sources import tables
from stridelake.sources.shared import folder

T0 = dt.datetime(2024, 1, 1)
BETS = "s string, i long, cost double, payoff double"


def fold(bets, start):
    """In millionths, as sums of tenths as doubles depend on their order."""
    out, start = {}, round(start * 10**6)
    bets = [(s, i, round((c or 0) * 10**6), round((p or 0) * 10**6)) for s, i, c, p in bets]
    for s in {b[0] for b in bets}:
        money, placed, low = start, 0, start
        own = sorted(b[1:] for b in bets if b[0] == s)
        for _, cost, payoff in own:
            if money >= cost:
                money += payoff - cost
                placed, low = placed + 1, min(low, money)
        out[s] = (len(own), placed, pytest.approx(money / 10**6), pytest.approx(low / 10**6))
    return out


def bets_of_many_kinds():
    random.seed(9)
    bets = []
    for i in range(1500):
        bets.append(("rich", i, 2.0, random.choice([0.0, 5.0])))
        bets.append(("poor", i, random.choice([1.0, 3.0, 8.0]), random.choice([0.0, 0.0, 2.5])))
        bets.append(("ruined", i, 2.0, 0.0))
        bets.append((None, i // 3, random.choice([None, 0.1, 0.7]), random.choice([None, 0.3])))
    return bets + [("one", 1, 5.0, 1.0), ("dear", 1, 99.0, 500.0)]


@pytest.mark.parametrize(("block", "rounds"), [(100, 12), (100, 1), (40, 0), (10**6, 12)])
def test_bets_in_blocks_equal_the_fold(spark, monkeypatch, block, rounds):
    monkeypatch.setattr(wager, "BLOCK_ROUNDS", rounds)
    bets = bets_of_many_kinds()
    df = spark.createDataFrame(bets, BETS).repartition(4)
    got = wager.bankroll_blocks(df, "s", ["i"], 20.0, block)
    assert got.columns == wager.bankroll_path(df, "s", ["i"], 20.0).columns
    assert {r["s"]: tuple(r)[1:] for r in got.collect()} == fold(bets, 20.0)
    assert wager.bankroll_blocks(df.limit(0), "s", ["i"], 20.0, block).count() == 0


def test_buckets_that_no_delta_hits_keep_their_files(spark):
    at = folder(spark, "buckets")
    base = spark.range(2000).select(F.col("id").alias("k"), F.lit(1.0).alias("v"), F.lit("a").alias("note"))
    tables.save_buckets(base, at, ["k"], 16)
    files = lambda: {re.search(r"__bucket=(\d+)/(.*)", f).groups() for f in spark.read.parquet(at).inputFiles()}
    before = files()
    delta = spark.createDataFrame([(3, 2.0, "b"), (3, 9.0, "c"), (5000, 7.0, "d")], "k long, v double, note string")
    hit = tables.upsert_buckets(spark, at, delta, ["k"], 16, ["v"])
    assert 1 <= len(hit) <= 2
    spark.catalog.refreshByPath(at)
    after = files()
    assert {f for f in before if int(f[0]) not in hit} == {f for f in after if int(f[0]) not in hit}
    assert not {f for f in before if int(f[0]) in hit} & after
    want = sorted(map(tuple, tables.upsert(base, delta, ["k"], ["v"]).collect()))
    assert sorted(map(tuple, tables.read_buckets(spark, at).collect())) == want
    tables.upsert_buckets(spark, at, delta, ["k"], 16, ["v"])
    spark.catalog.refreshByPath(at)
    assert sorted(map(tuple, tables.read_buckets(spark, at).collect())) == want
    assert tables.upsert_buckets(spark, at, delta.limit(0), ["k"], 16) == []
    tables.upsert_buckets(spark, at, delta.withColumn("v", F.lit(0.5)), ["k"], 16, policy="nothing")
    spark.catalog.refreshByPath(at)
    assert sorted(map(tuple, tables.read_buckets(spark, at).collect())) == want


def test_kinds_by_sketches_without_an_expand(spark):
    df = spark.range(5000).select((F.col("id") % 20).alias("few"), (F.col("id") % 100).cast("string").alias("at"), (F.col("id") % 101).alias("over"), F.col("id").cast("double").alias("many"), F.lit(None).cast("date").alias("none"), F.array(F.col("id") % 3).alias("list"))
    got = {r["column"]: r for r in shaping.cardinality_kinds(df, 100).collect()}
    assert {c: r["kind"] for c, r in got.items()} == {"few": "categorical", "at": "categorical", "over": "continuous", "many": "continuous", "none": "categorical", "list": "categorical"}
    assert (got["at"]["distinct_values"], got["over"]["distinct_values"]) == (100, 101) and got["at"]["exact"] and not got["many"]["exact"]
    assert {r["kind"] for r in shaping.cardinality_kinds(df.limit(0), 5).collect()} == {"categorical"}


def test_near_join_keeps_rows_that_repeat_and_maps(spark):
    left = spark.createDataFrame([("a", T0, {"x": 1}), ("a", T0, {"x": 1}), ("b", T0, None), (None, T0, {}), ("a", None, {})], "k string, t timestamp, m map<string,int>")
    right = spark.createDataFrame([("a", T0 + dt.timedelta(milliseconds=200), 1), ("a", T0 - dt.timedelta(milliseconds=250), 2), ("a", T0 + dt.timedelta(milliseconds=251), 3), (None, T0, 4)], "k string, t timestamp, v int")
    rows = sorted((r["k"] or "", r["v"] or 0) for r in joins.near_join(left, right, ["k"], "t", 250, ["v"]).collect())
    assert rows == [("", 0), ("a", 0), ("a", 1), ("a", 1), ("a", 2), ("a", 2), ("b", 0)]


def test_interval_join_left_keeps_rows_that_repeat_and_maps(spark):
    s = lambda n: T0 + dt.timedelta(seconds=n)
    points = spark.createDataFrame([("a", s(1), {"x": 1}), ("a", s(1), {"x": 1}), ("a", s(99999), None), ("b", s(1), None), (None, s(1), None)], "k string, t timestamp, m map<string,int>")
    spans = spark.createDataFrame([("a", s(0), s(2), 1), ("a", s(1), s(1), 2), ("a", s(-10**6), s(50), 3)], "k string, f timestamp, u timestamp, g int")
    got = joins.interval_join(points, spans, ["k"], "t", "f", "u", how="left")
    assert got.columns == ["k", "t", "m", "f", "u", "g"]
    assert sorted((r["k"] or "", r["g"] or 0) for r in got.collect()) == [("", 0), ("a", 0), ("a", 1), ("a", 1), ("a", 3), ("a", 3), ("b", 0)]


def test_scores_are_carried_with_the_median_of_the_race(spark):
    day = lambda k: dt.date(2024, 1, k)
    history = spark.createDataFrame([("a", day(1), 1.0), ("a", day(3), 5.0), ("b", day(2), 3.0), ("c", day(9), 9.0)], "horse string, day date, score double")
    rows = [("a", day(4), "r1"), ("b", day(4), "r1"), ("new", day(4), "r1"), ("new", day(4), "r2"), ("c", day(4), None), ("a", day(2), None), (None, day(4), None)]
    future = spark.createDataFrame(rows, "horse string, day date, race string")
    got = cleaning.carry_score(history, future, "horse", "day", "score", ["race"])
    assert got.columns == ["horse", "day", "race", "score"]
    want = [("a", "r1", 5.0), ("b", "r1", 3.0), ("new", "r1", 4.0), ("new", "r2", 4.0), ("c", None, 1.0), ("a", None, 1.0), (None, None, 1.0)]
    assert sorted((str(r["horse"]), str(r["race"]), r["score"]) for r in got.collect()) == sorted((str(h), str(r), s) for h, r, s in want)
    assert "Window [percentile" not in got._jdf.queryExecution().executedPlan().toString()
