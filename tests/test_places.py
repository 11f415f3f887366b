"""Places on lines: the nearest segment by a grid, and the place along a route."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stridelake.functions.geometry import line_distance, line_lengths, line_place
from stridelake.operators.nearest import nearest_segment
from stridelake.operators.windows import place_on_route

LINES = "course string, k long, line array<struct<lon:double,lat:double>>"
POINTS = "course string, id long, lon double, lat double, line_x string"
METRES = 6371000.0 * math.pi / 180


def metres(lon, lat, x1, y1, x2, y2):
    c = math.cos(math.radians(lat))
    px, py, qx, qy = (x1 - lon) * METRES * c, (y1 - lat) * METRES, (x2 - lon) * METRES * c, (y2 - lat) * METRES
    dx, dy = qx - px, qy - py
    n = dx * dx + dy * dy
    t = max(0.0, min(1.0, -(px * dx + py * dy) / n)) if n else 0.0
    return math.hypot(px + t * dx, py + t * dy)


@pytest.mark.parametrize("keys", [["course"], []])
def test_nearest_segment_equals_the_full_walk(spark, keys):
    random.seed(7)
    spot = lambda s: (random.uniform(-s, s), random.uniform(-s, s))
    lines, legs = [], []
    for k in range(330):
        x, y = spot(0.5)
        line = [(x, y)]
        for _ in range(random.choice([0, 1, 30, 60])):
            dx, dy = spot(random.choice([0.001, 0.001, 0.05]))
            line.append((line[-1][0] + dx, line[-1][1] + dy))
        course = random.choice(["a", "b"])
        lines.append((course, k, [{"lon": p[0], "lat": p[1]} for p in line]))
        legs += [(course, k, s, *p, *q) for s, (p, q) in enumerate(zip(line, line[1:] or line, strict=False))]
    lines += [("a", 900, []), ("a", 901, None), ("c", 902, [{"lon": None, "lat": 1.0}]), ("b", 1, lines[0][2])]
    points = [(random.choice(["a", "b"]), i, *spot(random.choice([0.5, 0.5, 3.0]))) for i in range(120)]
    points += [("a", 200, 100.0, -60.0), ("a", 201, None, 1.0), ("nowhere", 202, 0.0, 0.0), (None, 203, 0.0, 0.0), ("b", 204, 0.1, 0.1), ("b", 204, 0.1, 0.1)]
    got = nearest_segment(spark.createDataFrame([(*p, "x") for p in points], POINTS), spark.createDataFrame(lines, LINES), keys, "k", cell_m=300.0)
    assert got.columns == ["course", "id", "lon", "lat", "line_x", "line_id", "segment", "distance_m"]
    rows = got.collect()
    assert len(rows) == len(points) and len(legs) > 5000
    for r in rows:
        near = [] if r["lon"] is None else [metres(r["lon"], r["lat"], *leg[3:]) for leg in legs if not keys or leg[0] == r["course"]]
        assert (r["distance_m"] is None) == (not near)
        if near:
            assert r["distance_m"] == pytest.approx(min(near), rel=1e-9, abs=1e-6)


def test_nearest_of_no_lines_or_points(spark):
    lines, points = spark.createDataFrame([], LINES), spark.createDataFrame([("a", 1, 0.0, 0.0, "x")], POINTS)
    assert [r["distance_m"] for r in nearest_segment(points, lines, ["course"], "k").collect()] == [None]
    assert nearest_segment(points.limit(0), lines, ["course"], "k").count() == 0


def test_place_on_a_line(spark):
    line = [{"lon": 0.0, "lat": 0.0}, {"lon": 0.01, "lat": 0.0}, {"lon": 0.01, "lat": 0.01}]
    df = spark.createDataFrame([(0.005, 0.001, line), (0.02, 0.005, line), (-1.0, 0.0, line), (0.01, 0.0, line), (1.0, 1.0, []), (1.0, 1.0, line[:1]), (None, 1.0, line), (1.0, 1.0, None)], "lon double, lat double, line array<struct<lon:double,lat:double>>")
    out = df.select(line_place(F.col("lon"), F.col("lat"), F.col("line"), line_lengths(F.col("line"))).alias("p"), line_distance(F.col("lon"), F.col("lat"), F.col("line")).alias("d")).collect()
    leg = 0.01 * METRES
    want = [(0, leg / 2), (1, leg * 1.5), (0, 0.0), (0, leg), None, (0, 0.0), None, None]
    for r, w in zip(out, want, strict=True):
        assert (r["p"] is None) == (w is None)
        if w:
            assert r["p"]["segment"] == w[0] and r["p"]["along_m"] == pytest.approx(w[1], rel=1e-6, abs=1e-6) and r["p"]["offset_m"] == pytest.approx(r["d"])


def test_progress_does_not_run_back(spark):
    line = [{"lon": 0.0, "lat": 0.0}, {"lon": 0.1, "lat": 0.0}]
    routes = spark.createDataFrame([("a", line)], "course string, line array<struct<lon:double,lat:double>>")
    track = [0.01, 0.03, 0.02, None, 0.05]
    df = spark.createDataFrame([("a", "h", k, x, 0.0) for k, x in enumerate(track)] + [("b", "h2", 0, 0.01, 0.0), (None, "h3", 0, 0.01, 0.0)], "course string, horse string, t int, lon double, lat double")
    got = {(r["horse"], r["t"]): r for r in place_on_route(df, routes, "course", ["horse"], ["t"]).collect()}
    along = [got["h", k]["along_m"] for k in range(5)]
    progress = [got["h", k]["progress_m"] for k in range(5)]
    assert along[3] is None and along[2] < along[1] and progress == [along[0], along[1], along[1], along[1], along[4]]
    assert got["h", 0]["ground_loss_m"] == 0 and got["h", 2]["ground_loss_m"] == pytest.approx(0.01 * METRES, rel=1e-6)
    assert got["h2", 0]["along_m"] is None and got["h3", 0]["progress_m"] is None


def test_dense_legs_get_a_finer_grid_and_repeats_count_once(spark):
    from stridelake.operators import nearest

    shape = [((i % 20) * 1e-4, (i // 20) * 1e-4) for i in range(400)]
    lines = spark.createDataFrame([(k, [(x, y), (x + 1e-5, y + 1e-5)]) for k, (x, y) in enumerate(shape * 2)], "k int, line array<struct<lon:double,lat:double>>")
    legs = nearest.segments(lines, [], "k").drop("k")
    assert nearest._first_width(legs, [], 0.01) < 0.01
    points = spark.createDataFrame([(i, 5e-4, 5e-4) for i in range(9)] + [(9, 1e-4, 0.0), (10, None, 0.0)], "id int, lon double, lat double")
    got = {r["id"]: (r["line_id"], r["segment"]) for r in nearest_segment(points, lines, [], "k", cell_m=1000.0).collect()}
    assert got == {**{i: (105, 0) for i in range(9)}, 9: (1, 0), 10: (None, None)}


def test_legs_of_many_cells_are_shuffled_and_not_broadcast(spark):
    from stridelake.operators import nearest

    lines = spark.createDataFrame([(k, [(0.0, k * 1e-3), (1.0, k * 1e-3)]) for k in range(40)], "k int, line array<struct<lon:double,lat:double>>")
    legs = nearest.segments(lines, [], "k")
    points = spark.createDataFrame([(i, 0.0, i * 1e-3) for i in range(30)], "x long, lon double, lat double")
    for g, form in ((0.001, "SortMergeJoin"), (10.0, "BroadcastHashJoin")):
        plan = points.join(nearest._joinable(legs, g), F.col("x") == F.col("__cell"))._jdf.queryExecution().executedPlan().toString()
        assert form in plan and ("SortMergeJoin" in plan) == (form == "SortMergeJoin")
    far = points.withColumns({"x": F.lit("x"), "lat": F.col("lat") + 0.0004})
    got = nearest.nearest_segment(far, lines, [], "k", cell_m=100.0).collect()
    assert len(got) == 30 and all(r["line_id"] == round(r["lat"] * 1e3 - 0.4) and r["distance_m"] == pytest.approx(0.0004 * METRES) for r in got)
