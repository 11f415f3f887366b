"""Scans that deal a hot key over tasks give what the plain windows give."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.operators import hot_keys, joins, windows

SCHEMA = "k string, at long, i long, v double, w string"


def rows_with_a_hot_key(n=600):
    random.seed(8)
    rows = []
    for i in range(n):
        key = "hot" if i % 2 else random.choice(["a", "b", None])
        at = None if random.random() < 0.03 else random.choice([random.randint(0, 300), 150])
        rows.append((key, at, i, random.choice([None, None, float(i)]), random.choice([None, f"w{i}"])))
    return rows


def same(got, want):
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("hot_rows", [1, 20, 10**6])
def test_locf_and_prior_n(spark, hot_rows):
    df = spark.createDataFrame(rows_with_a_hot_key(), SCHEMA).withColumn("m", F.create_map("k", "i") if hot_rows == 20 else F.lit(None))
    df = df.filter("k is not null") if hot_rows == 20 else df
    order = ["at", "i"]
    for current in (False, True):
        same(windows.locf(df, ["k"], order, ["v", "w"], current, hot_rows=hot_rows), windows.locf(df, ["k"], order, ["v", "w"], current))
    aggs = {"n": F.count("v"), "s": F.sum("v"), "l": F.max("w"), "f": F.first("i")}
    for n in (1, 5):
        same(windows.prior_n(df, ["k"], order, n, aggs, hot_rows=hot_rows), windows.prior_n(df, ["k"], order, n, aggs))


@pytest.mark.parametrize(("hot_rows", "direction", "strict"), [(1, "backward", False), (20, "backward", True), (20, "forward", False), (20, "forward", True), (10**6, "backward", False)])
def test_asof_join(spark, hot_rows, direction, strict):
    rows = rows_with_a_hot_key()
    left = spark.createDataFrame(rows[::2] + rows[1:200:2], SCHEMA).select("k", "at", "i")
    right = spark.createDataFrame(rows[1::2] + rows[200:300:2], SCHEMA).select("k", F.col("at").alias("since"), F.col("i").alias("tie"), "v")
    for how in ("left", "inner"):
        plain = joins.asof_join(left, right, ["k"], "at", "since", ["v", "since"], how, strict, direction, ["tie"])
        same(joins.asof_join(left, right, ["k"], "at", "since", ["v", "since"], how, strict, direction, ["tie"], hot_rows), plain)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(9,2)", "double"])
def test_ordering_columns_of_any_kind(spark, kind):
    df = spark.range(200).select(F.lit("hot").alias("k"), F.col("id").alias("i"), (F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")) if kind in ("date", "timestamp", "timestamp_ntz") else F.col("id") / 4).cast(kind).alias("at"), F.when(F.col("id") % 9 == 0, F.col("id")).alias("v"))
    same(windows.locf(df, ["k"], ["at"], ["v"], hot_rows=30), windows.locf(df, ["k"], ["at"], ["v"]))
    with pytest.raises(ValueError):
        hot_keys.deal_out(df.withColumn("t", F.lit("x")), ["k"], "t", 30)


def test_a_key_with_half_of_all_rows_is_dealt_over_tasks(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"), F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"))
    dealt = hot_keys.deal_out(df, ["k"], "at", 500)
    sizes = [r["count"] for r in dealt.filter("k = 0").groupBy("__slot").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 1200
    assert dealt.filter("k <> 0 and (__slot > 0 or __hot)").isEmpty()
    for frame in (windows.locf(df, ["k"], ["at"], ["v"], hot_rows=500), windows.prior_n(df, ["k"], ["at"], 3, {"s": F.sum("v")}, hot_rows=500), joins.asof_join(df, df.withColumnRenamed("v", "x"), ["k"], "at", "at", ["x"], hot_rows=500)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        # The exchange below the window over the rows deals them by key and slot.
        assert re.search(r"hashpartitioning\(k#\d+L?, __slot#\d+", plan)


def test_empty_tables_stay_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert windows.locf(df, ["k"], ["at"], ["v"], hot_rows=5).count() == 0
    assert windows.prior_n(df, ["k"], ["at"], 2, {"s": F.sum("v")}, hot_rows=5).count() == 0
    assert joins.asof_join(df, df.withColumnRenamed("v", "x"), ["k"], "at", "at", ["x"], hot_rows=5).count() == 0


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_filling_both_ways_gives_what_the_plain_windows_give(spark, hot_rows):
    df = spark.createDataFrame(rows_with_a_hot_key(), SCHEMA)
    w = Window.partitionBy("k").orderBy("at", "i")
    ahead, back = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(ahead), F.first(c, ignorenulls=True).over(back)) for c in ("v", "w")})
    same(windows.fill_both(df, ["k"], ["at", "i"], ["v", "w"], hot_rows), want)
    got = windows.fill_both(df, ["k"], ["at", "i"], ["v"], hot_rows)
    # A frame to the end of the group is evaluated anew for each row.
    assert "unboundedfollowing" not in got._jdf.queryExecution().executedPlan().toString().lower().replace("$()", "")


def test_a_row_finds_its_slot_by_halving(spark):
    borders = F.array(*(F.lit(float(k)) for k in (2, 3, 5, 8, 8.5)))
    got = spark.range(12).select("id", hot_keys._upto(borders, F.col("id").cast("double")).alias("n")).collect()
    assert {r["id"]: r["n"] for r in got} == {k: sum(b <= k for b in (2, 3, 5, 8, 8.5)) for k in range(12)}
    assert spark.range(1).select(hot_keys._upto(F.array().cast("array<double>"), F.lit(1.0))).head()[0] == 0
    many = F.transform(F.sequence(F.lit(1), F.lit(hot_keys.MOST_SLOTS)), lambda k: k.cast("double"))
    assert [r[0] for r in spark.range(998, 1003).select(hot_keys._upto(many, F.col("id").cast("double"))).collect()] == [998, 999, 1000, 1000, 1000]
    dealt = hot_keys.deal_out(spark.range(300).select(F.lit(1).alias("k"), F.col("id").alias("at")), ["k"], "at", 20)
    # A filter over the borders would look at each of them.
    assert "filter(__borders" not in dealt._jdf.queryExecution().optimizedPlan().toString()
