"""Searches and overlays in the plane against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeledger.operators import spatial

PLACE = "cell int, cx double, cy double"


def searched(spark, points, cells, **options):
    p = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "point int, x double, y double")
    c = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(cells)], PLACE)
    out = spatial.nearest_cell(p, c, ["point"], "x", "y", "cx", "cy", **options)
    assert out.columns == ["point", "x", "y", "cx", "cy", "cell"]
    return {r["point"]: r["cell"] for r in out.collect()}


def plain(points, cells):
    d = np.round(((points[:, None, :] - cells[None]) ** 2).sum(axis=2), 12)
    return {k: int(np.lexsort((cells[:, 1], cells[:, 0], row))[0]) for k, row in enumerate(d)}


@pytest.mark.parametrize("leaf", [1, 4, 32])
def test_nearest_in_clusters(spark, leaf):
    """Places on a grid with ties, in a dense heap, in a line and alone; points among them, far away, and on the places."""
    rng = np.random.default_rng(leaf)
    grid = np.array([(i, j) for i in range(9) for j in range(9)], float)
    cells = np.unique(np.r_[grid, rng.normal(40, 1e-4, (60, 2)), np.c_[np.linspace(-500, -400, 50), np.full(50, 7.0)], [[1e5, -3.0]]], axis=0)
    points = np.r_[rng.uniform(-3, 12, (60, 2)), rng.integers(0, 18, (40, 2)) / 2, rng.normal(40, 2e-4, (30, 2)), rng.uniform(-1e4, 1e4, (40, 2)), cells[::9], [[2e6, 2e6]]]
    assert searched(spark, points, cells, leaf=leaf) == plain(points, cells)


def test_far_points_open_few_tiles(spark):
    """Two thousand points against four thousand cells far away: what a point opens grows with the logarithm of the cells."""
    rng = np.random.default_rng(0)
    cells, points = rng.uniform(0, 1, (4000, 2)), rng.uniform(0, 1, (2000, 2)) + [50, 30]
    assert searched(spark, points, cells) == plain(points, cells)
    centres = spark.createDataFrame(cells.tolist(), "_cx double, _cy double")
    _, tiles, levels = spatial._tile_tree(centres, spatial.LEAF)
    frame = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "point int, _x double, _y double")
    assert len(levels) <= 5 and spatial.candidate_tiles(frame, tiles, levels, ["point"]).count() < 6 * len(points)


def test_opened_tiles_are_one_row(spark, monkeypatch):
    """What a tile is opened to stays one row until it is sifted, also where points meet tiles in blocks."""
    rng = np.random.default_rng(1)
    cells, points = rng.uniform(0, 1, (3000, 2)), rng.uniform(0, 1, (500, 2)) / 50
    _, tiles, levels = spatial._tile_tree(spark.createDataFrame(cells.tolist(), "_cx double, _cy double"), 4)
    for level, _, _ in levels[1:]:
        sizes = spatial.opened_tiles(tiles, level).groupBy("_from").agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("_tiles")).alias("tiles")).collect()
        assert all(r["rows"] == 1 and r["tiles"] <= 16 for r in sizes)
    monkeypatch.setattr(spatial, "FEW_TILES", 20)
    assert searched(spark, points, cells, leaf=4) == plain(points, cells)


def test_nearest_of_odd_rows(spark):
    cells = spark.createDataFrame([(3, 1.0, 1.0), (2, 1.0, 1.0), (4, None, 1.0), (5, float("nan"), 0.0)], PLACE)
    points = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 0.0), (2, None, 0.0), (3, float("nan"), 1.0)], "point int, x double, y double")
    out = spatial.nearest_cell(points, cells, ["point"], "x", "y", "cx", "cy").collect()
    assert sorted((r["point"], r["cell"]) for r in out if r["cell"]) == [(1, 2), (1, 2)] and sum(r["cell"] is None for r in out) == 2
    out = spatial.nearest_cell(points, cells.where(F.lit(False)), ["point"], "x", "y", "cx", "cy").collect()
    assert len(out) == 4 and all(r["cell"] is None for r in out)


def squares(n, rng, side):
    """Small turned squares as edges, at random places within one degree, and their corners."""
    rows, corners = [], []
    for k in range(n):
        c, t = rng.uniform(0, 1, 2), rng.uniform(0, np.pi / 2)
        p = [(c[0] + side * np.cos(t + h * np.pi / 2), c[1] + side * np.sin(t + h * np.pi / 2)) for h in range(4)]
        corners.append(np.array(p))
        rows += [(k, h, *map(float, p[h]), *map(float, p[(h + 1) % 4])) for h in range(4)]
    return rows, corners


EDGE = "id int, seq int, x1 double, y1 double, x2 double, y2 double"


def inside(points, p):
    hit = np.zeros(len(points), bool)
    for (x1, y1), (x2, y2) in zip(p, np.roll(p, -1, axis=0), strict=True):
        spans = (y1 > points[:, 1]) != (y2 > points[:, 1])
        with np.errstate(divide="ignore", invalid="ignore"):
            hit ^= spans & (points[:, 0] < x1 + (points[:, 1] - y1) * (x2 - x1) / (y2 - y1))
    return hit


def test_many_polygons_in_one_degree(spark):
    """Ten thousand small squares and two large ones: points and tracks meet few boxes each."""
    rng = np.random.default_rng(2)
    rows, corners = squares(10_000, rng, 0.004)
    big = [np.array([(-0.5, -0.5), (1.5, -0.5), (1.5, 1.5), (-0.5, 1.5)]), np.array([(0.2, 0.2), (0.7, 0.25), (0.6, 0.8)])]
    for k, p in enumerate(big):
        corners.append(p)
        rows += [(10_000 + k, h, *map(float, p[h]), *map(float, p[(h + 1) % len(p)])) for h in range(len(p))]
    edges = spark.createDataFrame(rows, EDGE)
    points = rng.uniform(-0.2, 1.2, (2000, 2))
    want = {(int(i), k) for k, p in enumerate(corners) for i in np.flatnonzero(inside(points, p))}
    frame = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)], "point int, x double, y double")
    assert {tuple(r) for r in spatial.points_in_polygons(frame, edges, "point").collect()} == want
    tiled = spatial._tiled_boxes(spatial._box_rows(edges, "id")).cache()
    met = (frame.withColumn("_width", F.explode(spatial._widths(tiled))).withColumn("_tx", F.floor(F.col("x") / F.col("_width"))).withColumn("_ty", F.floor(F.col("y") / F.col("_width")))
           .join(tiled, ["_width", "_tx", "_ty"]).count())
    assert met < 20 * len(points)  # of 10,002 boxes each

    lines = np.c_[rng.uniform(-0.3, 1.3, (60, 2)), rng.uniform(-0.3, 1.3, (60, 2))]
    lines[0], lines[1] = (0.3, -1, 0.3, 2), (-1, 0.4, 2, 0.4)  # straight up and straight across
    tracks = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(lines)], "track int, x1 double, y1 double, x2 double, y2 double")
    got = {(r["track"], r["id"]): (r["min_lat"], r["max_lat"]) for r in spatial.track_crossings(tracks, edges).collect()}
    want = {}
    for k, (x1, y1, x2, y2) in enumerate(lines):
        for i, p in enumerate(corners):
            a, b, q = np.array([x1, y1]), np.array([x2 - x1, y2 - y1]), np.roll(p, -1, axis=0) - p
            det = b[0] * q[:, 1] - b[1] * q[:, 0]
            o = p - a
            s, t = (o[:, 0] * q[:, 1] - o[:, 1] * q[:, 0]) / det, (o[:, 0] * b[1] - o[:, 1] * b[0]) / det
            lat = list((y1 + s * b[1])[(s >= 0) & (s <= 1) & (t >= 0) & (t <= 1)]) + [e[1] for e in ((x1, y1), (x2, y2)) if inside(np.array([e]), p)[0]]
            if lat:
                want[k, i] = (min(lat), max(lat))
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=2e-6)


def test_many_points_near_many_centres(spark):
    """Six thousand points and nearly as many centres in one place: no task gets a third of the pairs, and all are found."""
    n = 6000
    points = spark.range(0, n, 1, 1).select(F.col("id").alias("point"), (F.col("id") * 37 % 601 / 1e5).alias("lat"), (F.col("id") * 53 % 599 / 1e5).alias("lon"))
    centres = points.select(F.col("point").alias("dam"), F.col("lat"), F.col("lon")).where("lat > 0.0003")
    out = spatial.within_distance(points, centres, "dam", 5000.0).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in out) == n * centres.count()
    assert max(r["count"] for r in out) < n * n / 3
