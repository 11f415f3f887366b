"""Race-style roles on the star-schema tables, and the same as SQL.

Runners are distinct order lines, races are orders, horses are parts; time series
are the events of a user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.operators.sets import dealt, dedupe, tasks_for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def runner_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for the runners, by the number of order lines, which stands in the files' footers."""
    return tasks_for(table(spark, sf_dir, "lineitem").count())


def runners(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One row per (race, num). All that is done by race runs where a race's lines are dealt to, so it shuffles once."""
    tasks = runner_tasks(spark, sf_dir) if tasks is None else tasks
    lines = dealt(table(spark, sf_dir, "lineitem"), tasks, "l_orderkey")
    lines = dedupe(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    orders = dealt(table(spark, sf_dir, "orders"), tasks, "o_orderkey")
    finish = F.row_number().over(Window.partitionBy("race").orderBy(F.desc("price"), "num"))
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .select(
            F.col("l_orderkey").alias("race"), F.col("l_linenumber").alias("num"), F.col("l_partkey").alias("horse"),
            F.col("l_suppkey").alias("jockey"), F.col("o_custkey").alias("trainer"), F.to_date("o_orderdate").alias("race_date"),
            F.col("o_orderpriority").alias("track"), F.col("o_orderstatus").alias("surface"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("earnings"), F.col("l_extendedprice").alias("price"),
            ((F.col("l_linenumber") % 9 + 1) / F.lit(20.0)).alias("odds"), (F.col("l_quantity") / 50).alias("score"),
            F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("status"),
        )
        .withColumn("finish", finish)
    )


RUNNERS = """li AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem
),
runners AS (
  SELECT l_orderkey AS race, l_linenumber AS num, l_partkey AS horse, l_suppkey AS jockey, o_custkey AS trainer,
         CAST(o_orderdate AS DATE) AS race_date, o_orderpriority AS track, o_orderstatus AS surface,
         l_extendedprice * l_discount AS earnings, l_extendedprice AS price,
         (l_linenumber % 9 + 1) / CAST(20 AS DOUBLE) AS odds, l_quantity / 50 AS score, l_returnflag AS model, l_linestatus AS status,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS finish
  FROM li JOIN orders ON o_orderkey = l_orderkey WHERE rn = 1
)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time series of a user: one row per event, with a place and gaps in the speed."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("runner"), F.col("event_id").alias("id"), "ts", F.col("event_type").alias("kind"),
        F.col("value").alias("speed"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("gappy"),
        (1 + F.col("event_id") % 5 / F.lit(10.0)).alias("stride"),
        (F.lit(-84.6) + F.col("event_id") % 1000 / F.lit(1e5)).alias("lon"),
        (F.lit(38.0) + F.col("event_id") % 777 / F.lit(1e5)).alias("lat"),
    )


POINTS = """points AS (
  SELECT user_id AS runner, event_id AS id, ts, event_type AS kind, value AS speed,
         CASE WHEN event_id % 7 <> 0 THEN value END AS gappy, 1 + (event_id % 5) / CAST(10 AS DOUBLE) AS stride,
         CAST(-84.6 AS DOUBLE) + (event_id % 1000) / CAST(1e5 AS DOUBLE) AS lon, CAST(38.0 AS DOUBLE) + (event_id % 777) / CAST(1e5 AS DOUBLE) AS lat
  FROM events
)"""
#: Seconds of a timestamp, with fractions.
SECONDS = "(epoch_us({}) / CAST(1e6 AS DOUBLE))"


class Group:
    """A family's queries: name to (callable, SQL or None)."""

    def __init__(self):
        self.QUERIES: dict = {}

    def add(self, name: str, sql: str | None = None):
        def put(build):
            if name in self.QUERIES:
                raise ValueError(f"{name} is registered twice")
            self.QUERIES[name] = (build, sql)
            return build

        return put


def rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round named columns, so that engines that add in another order agree."""
    return frame.withColumns({c: F.round(c, digits) for c in columns})
