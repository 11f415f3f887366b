"""Rows are dealt over as many tasks as they need, and large groups do not meet in one."""

import random

import pytest
from pyspark.sql import functions as F

from stridelake.operators import aggregates, joins, quantiles, sets
from stridelake.plans import roles


def test_runners_are_dealt_by_race_once(spark, monkeypatch):
    monkeypatch.setattr(sets, "TASK_ROWS", 500)
    want = sets.tasks_for(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count())
    assert want > 4
    ranked = roles.runners(spark, "/root/testdata/sf0.001").groupBy("race").agg(F.max("finish").alias("n"))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all(f", {want}), REPARTITION_BY_NUM" in e for e in exchanges), plan


def test_values_do_not_meet_their_group_by_a_shuffle(spark):
    rows = [(k % 2, float(k * 7919 % 1009)) for k in range(3000)]
    df = spark.createDataFrame(rows, "g int, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = quantiles.exact_quantiles(df, ["g"], ["v"], (0.5, 0.9), accuracy=100)
        plan = got._jdf.queryExecution().executedPlan().toString()
        found = {r["__k0"]: list(r["v"]) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") <= 1  # of the groups' own figures alone
    for g in (0, 1):
        own = sorted(v for k, v in rows if k == g)
        at = lambda p: (lambda x, i: x[i] + (p * (len(x) - 1) - i) * (x[min(i + 1, len(x) - 1)] - x[i]))(own, int(p * (len(own) - 1)))  # noqa: B023, E731
        assert found[g] == pytest.approx([at(0.5), at(0.9)])


def test_dealt_forms_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(sets, "TASK_ROWS", 10)
    random.seed(3)
    rows = [(random.choice([None, 1, 2, 3]), random.choice("xy"), i % 40, i % 5, float(i % 13) if i % 6 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "ent int, kind string, d int, o int, v double").withColumn("d", F.date_from_unix_date("d"))
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(aggregates.career_stats(df, ["ent"], "d", "o", "v", ["kind"], 20), aggregates.career_stats(df, ["ent"], "d", "o", "v", ["kind"]))
    assert same(joins.add_group_stats(df, ["ent"], {"n": F.count("v")}, 20).select(*df.columns, "n"), joins.add_group_stats(df, ["ent"], {"n": F.count("v")}).select(*df.columns, "n"))
    assert same(joins.restrict_history(df, df.filter("o = 1"), "ent", tasks=20).select(*df.columns), joins.restrict_history(df, df.filter("o = 1"), "ent").select(*df.columns))
