"""Joins: J1-J12."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions.clock import micros
from stridelake.functions.geometry import line_distance
from stridelake.operators import hot_keys
from stridelake.operators.sets import dealt, union_by_name
from stridelake.sources.shared import folder, stored


def join_prefixed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", prefix: str = "r_") -> DataFrame:
    """Equi join with the right side's other columns prefixed."""
    named = right.select(*on, *(F.col(c).alias(prefix + c) for c in right.columns if c not in on))
    return left.join(named, list(on), how)


def merge_races(card: DataFrame, results: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full-outer merge of three race sources on coalesced keys; one row per race.

    A column that several sources have takes the first that is not null, in the
    order card, results, list.
    """
    out = card
    for other in (results, listed):
        shared = [c for c in other.columns if c in out.columns and c not in keys]
        renamed = other.select(*(F.col(c).alias(f"__{c}") if c in shared else F.col(c) for c in other.columns))
        joined = out.join(renamed, list(keys), "full")
        out = joined.withColumns({c: F.coalesce(c, f"__{c}") for c in shared}).drop(*(f"__{c}" for c in shared))
    return out.dropDuplicates(list(keys))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], l_ts: str, r_ts: str, columns: Sequence[str], how: str = "left", strict: bool = False, direction: str = "backward", tie: Sequence[str] = (), hot_rows: int | None = None, tasks: int | None = None) -> DataFrame:
    """For each left row the latest right row at or before it (``forward``: the first at or after).

    Both sides are united and sorted once per key, and the last right row is
    carried along: no pairs are made. ``strict`` leaves out rows of the same time.
    Of right rows of one time the last by ``tie`` counts. Null keys meet nothing.
    With ``hot_rows`` a key of more rows is dealt over tasks by slots of time, and
    the last right row of the slots before is carried in. Many rows may be dealt over
    so many ``tasks``.
    """
    ahead = direction == "forward"
    apart = left.filter(~_known(keys))  # rows of one null key would meet in one task
    left = left.filter(_known(keys))
    rows = left.select(F.struct("*").alias("__l"), *keys, F.col(l_ts).alias("__ts"), F.lit(0 if strict else 1).alias("__side"))
    values = F.struct(*columns)
    seen = right.filter(_known(keys)).select(values.alias("__r"), *keys, F.col(r_ts).alias("__ts"), F.lit(1 if strict else 0).alias("__side"), *(F.col(t).alias(f"__t{k}") for k, t in enumerate(tie)))
    both = union_by_name(rows, seen)
    at = F.col("__ts").desc() if ahead else F.col("__ts").asc()
    order = [at, F.col("__side"), *(F.col(f"__t{k}").desc() if ahead else F.col(f"__t{k}") for k in range(len(tie)))]
    if hot_rows is not None:
        both = hot_keys.deal_out(both, keys, "__ts", hot_rows)
        both = hot_keys.carried(both, keys, ["__ts", *(f"__t{k}" for k in range(len(tie)))], {"__far": F.col("__r")}, ahead)
    parts = [*keys, "__slot"] if hot_rows is not None else keys
    both = dealt(both, tasks, *parts)
    window = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = F.last("__r", ignorenulls=True).over(window)
    carried = both.withColumn("__m", near if hot_rows is None else F.coalesce(near, "__far")).filter(F.col("__l").isNotNull())
    if how == "inner":
        carried = carried.filter(F.col("__m").isNotNull())
    out = carried.select("__l.*", *(F.col(f"__m.{c}").alias(c) for c in columns))
    if how == "inner":
        return out
    kinds = {f.name: f.dataType for f in right.select(*columns).schema.fields}
    return out.unionByName(apart.withColumns({c: F.lit(None).cast(kinds[c]) for c in columns}))


def _known(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).isNotNull()
    return out


def interval_join(points: DataFrame, spans: DataFrame, keys: Sequence[str], ts: str, start: str, end: str, closed: str = "left", how: str = "inner") -> DataFrame:
    """Points with the spans of their key that hold them; half-open spans by default.

    Time is cut in buckets as wide as the mean span, so spans lie in two buckets
    on average, and a point looks into the one it is in: a hot key is split over
    its buckets. Spans of over a thousand buckets go by wider ones, a level up; a
    point looks into one bucket of each level that there is.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown kind of join {how}")
    columns = points.columns
    if how == "left":  # stored, as a row's number must be the same for its hits and its rest
        points = stored(points.withColumn("__no", F.monotonically_increasing_id()), folder(points.sparkSession, "interval"))
    named = spans.select(*(F.col(k).alias(f"__{k}") for k in keys), *(c for c in spans.columns if c not in keys)).filter(F.col(start) <= F.col(end))
    length = (micros(end) - micros(start)).cast("double")
    mean = F.broadcast(named.agg(F.greatest(F.avg(length), F.lit(1.0)).alias("__mean")))  # one row
    level = F.floor(F.log(F.greatest(length / F.col("__mean"), F.lit(1.0))) / F.log(F.lit(1024.0))).cast("int")
    at = lambda t: F.floor(micros(t) / (F.col("__mean") * F.pow(F.lit(1024.0), F.col("__level")))).cast("long")
    levelled = named.crossJoin(mean).withColumn("__level", level)
    dealt = levelled.withColumn("__at", F.explode(F.sequence(at(start), at(end)))).withColumnRenamed("__level", "__w").drop("__mean")
    used = F.broadcast(levelled.agg(F.max("__mean").alias("__mean"), F.collect_set("__level").alias("__levels")))  # one row
    asked = points.crossJoin(used).withColumn("__level", F.explode("__levels"))
    asked = asked.withColumn("__spot", at(ts)).withColumnRenamed("__level", "__look").drop("__levels", "__mean")
    on = (F.col("__look") == F.col("__w")) & (F.col("__spot") == F.col("__at")) & (F.col(start) <= F.col(ts))
    on &= F.col(ts) <= F.col(end) if closed == "both" else F.col(ts) < F.col(end)
    for k in keys:
        on &= F.col(k) == F.col(f"__{k}")
    found = asked.join(dealt, on).drop("__look", "__spot", "__w", "__at", *(f"__{k}" for k in keys))
    if how == "inner":
        return found
    rest = points.join(found.select("__no").distinct(), "__no", "left_anti")
    return union_by_name(found, rest).select(*columns, *(c for c in found.columns if c not in columns and c != "__no"))


def near_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, tol_ms: int = 250, columns: Sequence[str] = ()) -> DataFrame:
    """Left rows with every right row of their key within a tolerance; unmatched left rows stay.

    Time is cut in buckets of the tolerance's width. A right row stands in its own
    bucket and the two beside it, a left row looks into its own: each pair is met
    once, hot keys are split over their buckets, and one outer join gives the
    unmatched rows as well. Columns may be of any type, and rows may repeat.
    """
    at = lambda c: F.floor(micros(c) / (tol_ms * 1000))
    seen = right.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(ts).alias(f"r_{ts}"), F.explode(F.sequence(at(F.col(ts)) - 1, at(F.col(ts)) + 1)).alias("__b"), *(F.col(c).alias(f"__r_{c}") for c in columns))
    rows = left.withColumn("__a", at(F.col(ts)))
    on = (F.col("__a") == F.col("__b")) & (F.abs(micros(ts) - micros(f"r_{ts}")) <= tol_ms * 1000)
    for k in keys:
        on &= F.col(k) == F.col(f"__{k}")
    return rows.join(seen, on, "left").select(*left.columns, f"r_{ts}", *(F.col(f"__r_{c}").alias(c) for c in columns))


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows without a partner."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def fully_matched_groups(left: DataFrame, right: DataFrame, by: Sequence[str], on: Sequence[str]) -> DataFrame:
    """Left rows of the groups in which every row has a partner."""
    lacking = unmatched(left, right, on).select(*by).distinct()
    return left.join(lacking, list(by), "left_anti")


def add_group_stats(df: DataFrame, by: Sequence[str], aggs: dict[str, Column], tasks: int | None = None) -> DataFrame:
    """Group aggregates beside the rows, for groups of any size: summed map-side and joined back. Null keys are a group.

    With ``tasks`` both sides of the join may be dealt over so many. Keys are then a struct, in which nulls are equal.
    """
    if tasks is not None:
        keyed = df.withColumn("__by", F.struct(*by))
        stats = keyed.groupBy("__by").agg(*(a.alias(n) for n, a in aggs.items()))
        return dealt(keyed, tasks, "__by").join(dealt(stats, tasks, "__by"), "__by", "left").drop("__by")
    stats = df.groupBy(*(F.col(k).alias(f"__k_{k}") for k in by)).agg(*(a.alias(n) for n, a in aggs.items()))
    return df.join(stats, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in by], "left").drop(*(f"__k_{k}" for k in by))


def cartesian_legs(legs: DataFrame, ticket: str, leg: str, choice: str, n_legs: int) -> DataFrame:
    """Every combination of one choice for each leg of a ticket, as an array.

    Equi joins on the ticket, leg by leg: the output is the tickets' own product.
    """
    first = legs.filter(F.col(leg) == 1).select(ticket, F.array(choice).alias("combo"))
    for k in range(2, n_legs + 1):
        more = legs.filter(F.col(leg) == k).select(ticket, F.col(choice).alias("__c"))
        first = first.join(more, ticket).select(ticket, F.concat("combo", F.array("__c")).alias("combo"))
    return first


def distance_to_lines(points: DataFrame, routes: DataFrame, on: str, lon: str = "lon", lat: str = "lat", kind: str = "line_type", line: str = "line", kinds: Sequence[str] = ("RUNNING_LINE", "WINNING_LINE")) -> DataFrame:
    """Points with their distance to each type of line of their course, a column each.

    The lines of a course are gathered first, a few rows, so a point has one partner.
    """
    by_kind = routes.groupBy(on).agg(*(F.first(F.when(F.col(kind) == k, F.col(line)), ignorenulls=True).alias(f"__{k}") for k in kinds))
    joined = points.join(by_kind, on, "left")
    return joined.withColumns({f"{k.lower()}_m": line_distance(F.col(lon), F.col(lat), F.col(f"__{k}")) for k in kinds}).drop(*(f"__{k}" for k in kinds))


def restrict_history(history: DataFrame, future: DataFrame, key: str, flag: str = "data_flag", tasks: int | None = None) -> DataFrame:
    """History of the entities that are to come, stacked on them, with a flag. Many rows may be dealt over so many ``tasks``."""
    own = dealt(history, tasks, key).join(future.select(key).distinct(), key, "left_semi")
    return union_by_name(own.withColumn(flag, F.lit("historical")), future.withColumn(flag, F.lit("future")))
