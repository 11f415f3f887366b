"""Queries of the incremental forms: the given events as a stream, run to its end."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stridelake.plans.roles import POINTS, RUNNERS, Group, points, rounded, runners, table
from stridelake.sources.shared import folder, stored
from stridelake.streaming import feeds as S
from stridelake.streaming import stateful

GROUP = Group()
QUERIES = GROUP.QUERIES
add = GROUP.add


#: Steps in which the feed comes, each of which is a trigger, and files of a step, each of which one task writes.
FILES, STEP_FILES = 3, 4
#: The feed's last file has one point long after all others, which closes every window and session; it has no runner.
CLOSING = "2100-01-01"


def _feed(spark, d, closing: bool = False):
    """Events as a stream of (runner, id, ts, speed) over several triggers, written to a folder in order of time first."""
    at = folder(spark, "feed")
    rows = table(spark, d, "events").select(F.col("user_id").alias("runner"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("speed"))
    edges = rows.agg(*(F.percentile_approx(F.col("ts").cast("double"), (k + 1) / FILES).alias(f"e{k}") for k in range(FILES - 1))).head()
    step = sum((F.when(F.col("ts").cast("double") > e, 1).otherwise(0) for e in edges), F.lit(0))
    for k in range(FILES):  # files are taken in the order in which they were written
        rows.filter(step == k).repartition(STEP_FILES).write.mode("append").parquet(f"{at}/in")
    if closing:
        end = spark.range(1).select(F.lit(None).cast("long").alias("runner"), F.lit(-1).cast("long").alias("id"), F.lit(CLOSING).cast("timestamp").alias("ts"), F.lit(0.0).alias("speed"))
        end.coalesce(1).write.mode("append").parquet(f"{at}/in")
    return S.gps_stream(spark, f"{at}/in", rows.schema, ["runner", "id"], "ts", "31 days", max_files=STEP_FILES), at


def _collected(spark, stream, at):
    """The stream's rows through a Parquet sink."""
    query = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/check").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


@add("s1_gps_stream", "SELECT user_id AS runner, event_id AS id, value AS speed FROM events")
def _(spark, d):
    stream, at = _feed(spark, d)
    return _collected(spark, stream.select("runner", "id", "speed"), at)


@add("s2_stream_profile", "SELECT epoch_us(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01')) AS window_start_us, user_id AS runner, count(*) AS n, round(avg(value), 6) AS mean_speed, min(value) AS min_speed, max(value) AS max_speed FROM events GROUP BY ALL")
def _(spark, d):
    stream, at = _feed(spark, d, closing=True)
    out = _collected(spark, S.stream_profile(stream, ["runner"], "ts", "speed", "6 hours"), at)
    return rounded(out.filter("runner is not null"), "mean_speed")


@add("s3_stream_sessions", """WITH x AS (SELECT user_id AS runner, epoch_us(ts) AS us, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= 7200000000 THEN 1 ELSE 0 END AS cut FROM events),
  y AS (SELECT *, sum(cut) OVER (PARTITION BY runner ORDER BY us ROWS UNBOUNDED PRECEDING) AS s FROM x) SELECT runner, count(*) AS n, min(us) AS first_us, max(us) AS last_us FROM y GROUP BY runner, s""")  # fmt: skip
def _(spark, d):
    stream, at = _feed(spark, d, closing=True)
    return _collected(spark, S.stream_sessions(stream, ["runner"], "ts", "2 hours"), at).filter("runner is not null")


@add("s4_stream_upsert", "SELECT user_id AS runner, max(event_id) AS id FROM events GROUP BY user_id")
def _(spark, d):
    stream, at = _feed(spark, d)
    S.stream_upsert(stream.select("runner", "id"), f"{at}/table", ["runner"], [F.desc("id")], f"{at}/check").awaitTermination()
    return S.current_version(spark, f"{at}/table")


@add("s5_stream_kinematics", """WITH k0 AS (SELECT event_id AS id, user_id, ts, value, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6::DOUBLE AS dt, lag(value) OVER w AS pv FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  k1 AS (SELECT *, (value - pv) / nullif(dt, 0) AS a FROM k0) SELECT id, round(dt, 6) AS dt, round(a, 6) AS acceleration FROM k1""")  # fmt: skip
def _(spark, d):
    stream, at = _feed(spark, d)
    stateful.keep_kinematics(stream, f"{at}/table", f"{at}/check").awaitTermination()
    return rounded(stateful.kept_kinematics(spark, f"{at}/table").select("id", "dt", "acceleration"), "dt", "acceleration")


def _in_steps(spark, rows, step, at: str, steps: int = FILES, closing=None):
    """A stream of the rows with a trigger for each step, in their order, and a last one for the closing rows."""
    for k in range(steps):
        rows.filter(step == k).repartition(STEP_FILES).write.mode("append").parquet(at)
    if closing is not None:
        closing.coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", STEP_FILES).parquet(at)


def _closing(spark, schema, **known):
    """One row long after all others, null but for the columns that are named. A join's needs a key, or it is filtered out before it moves the watermark."""
    return spark.range(1).select(*(F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields))


#: Kinds of career figures, with the columns of their entity.
KINDS = {"J": ["jockey"], "T": ["trainer"], "J_TRACK": ["jockey", "track"]}


def _running_sql() -> str:
    sums = ", ".join(f"count(CASE WHEN finish = {i} THEN 1 END) AS n{i}, coalesce(sum(CASE WHEN finish = {i} THEN earnings END), 0) AS e{i}" for i in (1, 2, 3, 4))
    each = " UNION ALL ".join(f"SELECT '{kind}' AS stat_type, concat_ws('|', {', '.join(cols)}) AS entity, * FROM runners" for kind, cols in KINDS.items())
    upto = ", ".join(f"coalesce(sum({x}) OVER w, 0) AS {x}" for x in ("n", "n1", "n2", "n3", "n4", "e", "e1", "e2", "e3", "e4"))
    names = ("starts", "wins", "places", "shows", "fourths")
    whole = ", ".join(f"CAST({x} AS BIGINT) AS {name}" for x, name in zip(("n", "n1", "n2", "n3", "n4"), names, strict=True))
    money = ", ".join(f"round({x}, 4) AS earnings{s}" for x, s in zip(("e", "e1", "e2", "e3", "e4"), ("", "_1", "_2", "_3", "_4"), strict=True))
    return f"""WITH {RUNNERS}, x AS ({each}), g AS (SELECT stat_type, entity, race_date, count(*) AS n, sum(earnings) AS e, {sums} FROM x GROUP BY ALL),
  c AS (SELECT stat_type, entity, race_date AS as_of_date, {upto} FROM g WINDOW w AS (PARTITION BY stat_type, entity ORDER BY race_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT stat_type, entity, as_of_date, {whole}, {money}, round(coalesce(n1 / nullif(n, 0)::DOUBLE, 0), 6) AS win_pct, round(coalesce((n1 + n2 + n3) / nullif(n, 0)::DOUBLE, 0), 6) AS itm_pct FROM c"""


@add("s4_running_career", _running_sql())
def _(spark, d):
    """Three triggers in order of date; the 13th of every month comes late, in the last one."""
    at = folder(spark, "s4")
    # Runners are made once and not for each trigger, as their shuffles are the most of the disk.
    r = stored(runners(spark, d).select("jockey", "trainer", "track", "race_date", "finish", "earnings"), f"{at}/all")
    edges = r.agg(*(F.percentile_approx(F.unix_date("race_date"), k / FILES).alias(f"e{k}") for k in range(1, FILES))).head()
    step = sum((F.when(F.unix_date("race_date") > e, 1).otherwise(0) for e in edges), F.lit(0))
    stream = _in_steps(spark, r, F.when(F.dayofmonth("race_date") == 13, FILES - 1).otherwise(step), f"{at}/in")
    whole = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/all")
    whole.getFileSystem(spark._jsc.hadoopConfiguration()).delete(whole, True)
    events = stateful.career_events(stream, KINDS, "race_date", "finish", "earnings")
    stateful.keep_career(events, f"{at}/table", f"{at}/check").awaitTermination()
    out = stateful.career_columns(S.current_version(spark, f"{at}/table"))
    return rounded(rounded(out, "earnings", "earnings_1", "earnings_2", "earnings_3", "earnings_4", digits=4), "win_pct", "itm_pct")


#: Hours by which points come late at most in the queries of unordered feeds.
LATE_H = 60


def _shuffled(ts: str, ident: str, edges) -> F.Column:
    """The trigger of each row when it comes up to ``LATE_H`` hours after its time."""
    arrives = F.col(ts).cast("timestamp").cast("double") + F.pmod(F.xxhash64(ident), F.lit(LATE_H)) * 3600
    return sum((F.when(arrives > e, 1).otherwise(0) for e in edges), F.lit(0))


def _edges(frame, ts: str, steps: int):
    return frame.agg(*(F.percentile_approx(F.col(ts).cast("timestamp").cast("double"), k / steps).alias(f"e{k}") for k in range(1, steps))).head()


@add("s5_late_points", """WITH k0 AS (SELECT event_id AS id, user_id, ts, value, (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1e6::DOUBLE AS dt, lag(value) OVER w AS pv FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  k1 AS (SELECT *, (value - pv) / nullif(dt, 0) AS a FROM k0), k2 AS (SELECT *, lag(a) OVER (PARTITION BY user_id ORDER BY ts, id) AS pa FROM k1)
  SELECT user_id AS runner, id, round(dt, 6) AS dt, round(a, 6) + 0 AS acceleration, round((a - pa) / nullif(dt, 0), 6) + 0 AS jerk FROM k2""")  # fmt: skip
def _(spark, d):
    """Points come up to some days late, over five triggers; they are let go in order."""
    at = folder(spark, "s5")
    rows = table(spark, d, "events").select(F.col("user_id").alias("runner"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("speed"))
    steps = 5
    stream = _in_steps(spark, rows, _shuffled("ts", "id", _edges(rows, "ts", steps)), f"{at}/in", steps, _closing(spark, rows.schema, ts=CLOSING, id=-1))
    stateful.keep_kinematics(stream, f"{at}/table", f"{at}/check", LATE_H * 3600).awaitTermination()
    out = stateful.kept_kinematics(spark, f"{at}/table")
    out = rounded(out.filter("id >= 0"), "dt", "acceleration", "jerk")
    return out.withColumns({c: F.col(c) + 0.0 for c in ("acceleration", "jerk")})  # no negative zeros


def _two_feeds(spark, d, how: str):
    """Events as two streams, points and the spans between clicks and views, each over four triggers and out of order."""
    at = folder(spark, "j6s")
    p = points(spark, d).select("runner", "id", F.col("ts").cast("timestamp").alias("ts"), "kind")
    w = Window.partitionBy("runner").orderBy("ts", "id")
    spans = p.filter("kind in ('click', 'view')").select("runner", F.col("id").alias("gate"), F.col("ts").alias("a"), F.coalesce(F.lead("ts").over(w), "ts").alias("b"))
    others = p.filter("kind not in ('click', 'view')").drop("kind")
    steps = 4
    edges = _edges(p, "ts", steps)
    left = _in_steps(spark, others, _shuffled("ts", "id", edges), f"{at}/points", steps, _closing(spark, others.schema, runner=-1, ts=CLOSING))
    spans = stored(spans, f"{at}/all-spans")
    right = _in_steps(spark, spans, _shuffled("a", "gate", edges), f"{at}/spans", steps, _closing(spark, spans.schema, runner=-1, a=CLOSING, b="2100-01-02"))
    stateful.keep_interval_join(left, right, ["runner"], "ts", "a", "b", f"{at}/table", f"{at}/check", LATE_H * 3600, 86400, how).awaitTermination()
    return stateful.kept_joins(spark, f"{at}/table").filter("runner >= 0").select("id", "gate")


_GATES = "g AS (SELECT runner, id AS gate, ts AS a, coalesce(lead(ts) OVER (PARTITION BY runner ORDER BY ts, id), ts) AS b FROM points WHERE kind IN ('click', 'view'))"
_HELD = "ON p.runner = g.runner AND p.ts >= g.a AND p.ts < g.b WHERE p.kind NOT IN ('click', 'view')"


@add("j6_stream_interval", f"WITH {POINTS}, {_GATES} SELECT p.id, g.gate FROM points p JOIN g {_HELD}")
def _(spark, d):
    return _two_feeds(spark, d, "inner")


@add("j6_stream_interval_left", f"WITH {POINTS}, {_GATES} SELECT p.id, g.gate FROM points p LEFT JOIN g {_HELD}")
def _(spark, d):
    return _two_feeds(spark, d, "left")
