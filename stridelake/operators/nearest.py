"""The nearest segment of many lines, by a grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions.geometry import METRES_PER_DEGREE, segment_distance
from stridelake.sources.shared import folder, stored

#: Legs that a point meets in its cell on average, and cells of a leg on average, at most; beyond the first, the first level's cells are
#: made finer as long as the second holds.
CELL_LEGS, LEG_CELLS = 64, 256
#: Each level's cells are so many times as wide as those of the level before; the last one's cover the globe.
STEP = 4
#: Legs, by all cells that they are put into, which are broadcast at most. Spark cannot tell their number, as it takes a leg with its cells
#: for one row, so it would send any that fit as they are stored.
SENT_LEGS = 1 << 16


def segments(lines: DataFrame, keys: Sequence[str], line_id: str, line: str = "line") -> DataFrame:
    """Legs of lines: keys, line_id, segment (from 0), lon1, lat1, lon2, lat2. A line of one point is a leg of no length."""
    last = F.greatest(F.size(line) - 2, F.lit(0))
    each = lines.filter(F.size(line) > 0).select(*keys, F.col(line_id).alias("line_id"), F.col(line).alias("__l"), F.explode(F.sequence(F.lit(0), last)).alias("segment"))
    at = lambda k: F.coalesce(F.get("__l", F.col("segment") + k), F.get("__l", F.col("segment")))
    legs = each.select(*keys, "line_id", "segment", at(0)["lon"].alias("lon1"), at(0)["lat"].alias("lat1"), at(1)["lon"].alias("lon2"), at(1)["lat"].alias("lat2"))
    return legs.dropna(subset=["lon1", "lat1", "lon2", "lat2"])


def _cell(x: Column, y: Column) -> Column:
    """A cell as one number, by which arrays are made distinct in one pass. Cells may share one if they are 2^32 apart, which only adds legs."""
    return F.shiftleft(x, 32).bitwiseXOR(y.bitwiseAND(F.lit(0xFFFFFFFF)))


def _cells(g: float) -> Column:
    """Cells of width ``g`` degrees that a leg touches, and those beside them, as an array of ``_cell``."""
    pieces = F.greatest(F.ceil(F.greatest(F.abs(F.col("lon2") - F.col("lon1")), F.abs(F.col("lat2") - F.col("lat1"))) / g), F.lit(1)).cast("int")
    part = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / pieces
    cell = lambda v: F.floor(v / g).cast("long")

    def around(k: Column) -> Column:
        """A piece is no longer than a cell, so the cells of its two ends and those beside them hold it."""
        def span(a: str, b: str) -> Column:
            one, two = cell(part(a, b, k)), cell(part(a, b, k + 1))
            return F.sequence(F.least(one, two) - 1, F.greatest(one, two) + 1)

        ys = span("lat1", "lat2")
        return F.flatten(F.transform(span("lon1", "lon2"), lambda x: F.transform(ys, lambda y: _cell(x, y))))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), pieces - 1), around)))


def _joinable(legs: DataFrame, g: float) -> DataFrame:
    """Legs by the cells of a grid that a point may look into, broadcast if they are few, else to be shuffled."""
    put = legs.agg(F.sum(F.size(_cells(g)))).head()[0] or 0
    return legs.withColumn("__cell", F.explode(_cells(g))).hint("broadcast" if put <= SENT_LEGS else "merge")


def _first_width(legs: DataFrame, keys: Sequence[str], g: float) -> float:
    """The width of the first grid's cells: finer where a cell has too many legs on average, all cells taken together."""
    while True:
        held = legs.select(*(f"__{k}" for k in keys), F.explode(_cells(g)).alias("c")).groupBy(*(f"__{k}" for k in keys), "c").agg(F.count(F.lit(1)).alias("n"))
        got = held.agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("cells")).head()
        if not got["cells"] or got["all"] <= CELL_LEGS * got["cells"]:
            return g
        n = legs.count()
        if got["all"] * STEP > LEG_CELLS * n:
            return g
        g /= STEP


def nearest_segment(points: DataFrame, lines: DataFrame, keys: Sequence[str], line_id: str, lon: str = "lon", lat: str = "lat", line: str = "line", cell_m: float = 200.0) -> DataFrame:
    """Points with the nearest leg of all lines of their keys: ``line_id``, ``segment`` and ``distance_m``; exact.

    Legs are put into the cells of a grid that they touch and those beside them, so
    a point looks into its own cell alone. What it finds there is the nearest if it
    is no farther than a cell is wide; the other points go on to a grid of wider
    cells, and the last grid has the globe in one cell. So a point meets the legs
    around it, not all of its course; without keys it looks among all lines. Where
    legs are dense the first grid is finer than ``cell_m``. Legs of one place count
    once, by the first of them, and so do points of one place.

    Distances are those of ``line_distance``. Ties go to the smaller line_id, then
    to the first leg. Points without a place, or whose keys have no line, get nulls.
    Rows may repeat; points that are met are stored in the shared folder on the way.
    """
    spark = points.sparkSession
    at = folder(spark, "nearest")
    legs = segments(lines, keys, line_id, line).select(*(F.col(k).alias(f"__{k}") for k in keys), "line_id", "segment", "lon1", "lat1", "lon2", "lat2")
    place = [*(f"__{k}" for k in keys), "lon1", "lat1", "lon2", "lat2"]
    least = legs.groupBy(*place).agg(F.min(F.struct("line_id", "segment")).alias("l"))
    # Legs and spots take few bytes but much work, so they are stored in as many files as a shuffle has tasks.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    legs = stored(least.select(*place, "l.line_id", "l.segment").repartition(tasks), f"{at}/legs")
    rows = points.select(F.struct(*points.columns).alias("__row"), *(F.col(k).alias(f"__k_{k}") for k in keys), F.col(lon).cast("double").alias("__lon"), F.col(lat).cast("double").alias("__lat"))
    rows = stored(rows, f"{at}/points")
    spots = [*(f"__k_{k}" for k in keys), "__lon", "__lat"]
    left = rows.filter("__lon is not null and __lat is not null").select(*spots).distinct().repartition(tasks)
    left = stored(left.withColumn("__no", F.monotonically_increasing_id()), f"{at}/spots")
    numbered = left
    found, level, g = None, 0, _first_width(legs, keys, cell_m / METRES_PER_DEGREE)
    while True:
        whole = g > 360
        here = left.withColumn("cell", _cell(F.floor(F.col("__lon") / g).cast("long"), F.floor(F.col("__lat") / g).cast("long")))
        on = [F.col(f"__k_{k}") == F.col(f"__{k}") for k in keys]
        met = here.join(_joinable(legs, g), [*on, F.col("cell") == F.col("__cell")])
        away = segment_distance(F.col("__lon"), F.col("__lat"), F.col("lon1"), F.col("lat1"), F.col("lon2"), F.col("lat2"))
        best = met.groupBy("__no").agg(F.min(F.struct(away.alias("distance_m"), "line_id", "segment")).alias("b"), F.first("__lat").alias("__lat"))
        # A leg in no cell beside the point's own is at least a cell away, as the point measures it.
        sure = F.lit(True) if whole else F.col("b.distance_m") <= g * METRES_PER_DEGREE * F.cos(F.radians("__lat"))
        done = stored(best.filter(sure).select("__no", "b.line_id", "b.segment", "b.distance_m"), f"{at}/found-{level}")
        found = done if found is None else found.unionByName(done)
        if whole:
            break
        left = stored(left.join(done.select("__no").hint("merge"), "__no", "left_anti"), f"{at}/left-{level}")
        if left.isEmpty():
            break
        g, level = g * STEP, level + 1
    of_spots = numbered.join(found.hint("merge"), "__no").select(*(F.col(c).alias(f"{c}_") for c in spots), "line_id", "segment", "distance_m")
    on = [F.col(c) == F.col(f"{c}_") for c in spots]
    return rows.join(of_spots, on, "left").select("__row.*", "line_id", "segment", "distance_m")
