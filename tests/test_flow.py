"""Networks, forecasts, weather grids, geometry, pixels, files and streams."""

import datetime
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeledger.operators import curves, forcings, forecast, network, pixels, spatial
from lakeledger.sources import committed, readers, writers
from lakeledger.streaming import daily

D0 = datetime.date(2020, 1, 1)
day = lambda n: D0 + datetime.timedelta(days=int(n))


# --- network --------------------------------------------------------------------------------

def test_trace_with_loops_and_edges(spark):
    rng = np.random.default_rng(2)
    n = 12
    code = rng.integers(1, 9, (n, n)).astype(object)
    code[rng.random((n, n)) < 0.05] = None
    dam = rng.random((n, n)) < 0.15
    rows = [(x, y, None if code[y, x] is None else int(code[y, x]), bool(dam[y, x]), y * n + x) for y in range(n) for x in range(n)]
    want = set()
    for y in range(n):
        for x in range(n):
            if not dam[y, x]:
                continue
            cx, cy, seen = x, y, {(x, y)}
            while code[cy, cx] is not None:
                dy, dx = network.STEPS[code[cy, cx]]
                cx, cy = cx + dx, cy + dy
                if not (0 <= cx < n and 0 <= cy < n) or (cx, cy) in seen or code[cy, cx] is None:
                    break
                seen.add((cx, cy))
                if dam[cy, cx]:
                    want.add((y * n + x, cy * n + cx))
                    break
    df = spark.createDataFrame(rows, "x int, y int, code int, is_dam boolean, node long")
    got = {(r["src"], r["dst"]) for r in network.trace_flow(df).collect()}
    assert got == want and want


def loop_balance(edges, nodes, lag=False):
    up = {}
    for s, d, t in edges:
        up.setdefault(d, []).append((s, t))
    done = {}

    def solve(node, date):
        if (node, date) in done:
            return done[node, date]
        if (node, date) not in nodes:
            return None
        nat, ds = nodes[node, date]
        own, reg = nat, 0.0
        for s, t in up.get(node, []):
            when = date - datetime.timedelta(days=round(t)) if lag else date
            above = solve(s, when)
            if above is None or above[1] is None:
                done[node, date] = (None, None)
                return done[node, date]
            reg += above[1]
            own -= nodes[s, when][0]
        inflow = max(0, own + reg)
        done[node, date] = (inflow, max(0, inflow - ds))
        return done[node, date]
    return {k: solve(*k) for k in nodes}


@pytest.mark.parametrize("algorithm", ["wb", "wb_travel_time"])
def test_balance(spark, algorithm):
    rng = np.random.default_rng(4)
    edges = [(1, 3, 1.0), (2, 3, 2.5), (3, 5, 1.0), (4, 5, 0.4), (5, 6, 1.0), (1, 6, 3.0)]
    nodes = {(n, day(d)): (float(rng.uniform(5, 20) * n), float(rng.normal(0, 15))) for n in range(1, 8) for d in range(6)}
    del nodes[2, day(3)]
    e = spark.createDataFrame(edges, "src long, dst long, travel_time double")
    s = spark.createDataFrame([(n, d, *v) for (n, d), v in nodes.items()], "node long, date date, natural double, storage_change double")
    got = {(r["node"], r["date"]): (r["inflow"], r["outflow"]) for r in network.balance(e, s, algorithm).collect()}
    want = loop_balance(edges, nodes, algorithm == "wb_travel_time")
    assert set(got) == set(want)
    for k, (i, o) in want.items():
        assert got[k] == ((None, None) if i is None else (pytest.approx(i), pytest.approx(o)))


def test_cycle_is_rejected(spark):
    e = spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long")
    with pytest.raises(ValueError, match="cycle"):
        network.levels(spark.createDataFrame([(1,), (2,)], "node long"), e)
    with pytest.raises(ValueError, match="unknown algorithm"):
        network.balance(e, spark.createDataFrame([(1,)], "node long"), "hydraulic")


# --- forecast -------------------------------------------------------------------------------

CURVE = [(2.0, 100.0), (3.0, 101.0), (5.0, 102.0), (9.0, 103.0), (20.0, 104.0)]
RULE = [0.5, 0.55, 0.6, 0.62, 0.6, 0.55, 0.5, 0.4, 0.35, 0.35, 0.4, 0.45]


def loop_case(case, q, e, a0, value, target, legacy):
    area, level = [p[0] for p in CURVE], [p[1] for p in CURVE]
    z_of, a_of = (lambda a: np.interp(a, area, level)), (lambda z: np.interp(z, level, area))
    a, seen, left, out = a0, z_of(a0), value, []
    net = sum(q) - e * len(q)
    gap = value - seen if value is not None else 0
    surplus = 0 if gap > 0 else gap * a0 * 1e6 + e * len(q)
    for x in q:
        if case == "GC":
            o, ds = 0.0, x - e
        elif case == "CL":
            if seen > value:
                r = surplus / 16
                o, ds = (x - e, 0.0) if surplus == 0 else (x - r, r - x - e if legacy else r - e)
            else:
                o, ds = 0.0, x - e
        elif case == "RC":
            o = 0.0 if net < target else (net - target) / 15
            ds = x - e if net < target else (x - o if legacy else x - e - o)
        elif net < value:
            o, ds = 0.0, x - e
        else:
            ds = 0.0 if left <= 0 else min(x - e, left)
            o, left = x - e - ds, left - ds
        z = z_of(a)
        seen, new = z, z + ds / (a * 1e6)
        a = a_of(new)
        out.append((o, ds, new, a))
    return out


@pytest.mark.parametrize("legacy", [False, True])
def test_forecast_cases(spark, legacy):
    rng = np.random.default_rng(8)
    flow = {r: [float(v) for v in rng.uniform(0, 30, 16)] for r in (1, 2, 3)}
    base = datetime.date(2020, 12, 22)  # the window runs into January
    dates = [base + datetime.timedelta(days=i) for i in range(-3, 20)]
    inflow = spark.createDataFrame([(r, d, (flow[r] * 2)[i]) for r in flow for i, d in enumerate(dates)], "k int, date date, streamflow double")
    res = spark.createDataFrame([(1, base, 4.0, 5.0, 200.0, 101.0, 3.0), (2, base, 2.5, 3.0, 50.0, 103.5, None), (3, base, 30.0, 6.0, None, None, 5.0)],
                                "k int, basedate date, last_area double, last_evaporation double, smax double, wl double, cust double")
    curve = spark.createDataFrame([(r, *p) for r in flow for p in CURVE], "k int, area double, elevation double")
    rule = spark.createDataFrame([(r, m + 1, v) for r in (1, 2) for m, v in enumerate(RULE)], "k int, month int, s_by_smax double")
    out = forecast.forecast(inflow, res, curve, ["k"], rule=rule, cases=forecast.CASES, target_level="wl", custom_mcm="cust", legacy=legacy)
    got = {}
    for r in out.orderBy("date").collect():
        got.setdefault((r["k"], r["label"]), []).append(r)
    labels = {k: {lab for kk, lab in got if kk == k} for k in flow}
    st = {"ST 0.5%", "ST 1%", "ST 2.5%"}
    assert labels == {1: {"GC", "GO", "CL", "RC", "ST 3.0MCM"} | st, 2: {"GC", "GO", "CL", "RC"} | st, 3: {"GC", "GO", "ST 5.0MCM"}}
    info = {r["k"]: r for r in res.collect()}
    frac = lambda d: RULE[d.month - 1] + (RULE[d.month % 12] - RULE[d.month - 1]) * d.day / 30
    for (k, lab), rows in got.items():
        i = info[k]
        assert len(rows) == 16 and rows[0]["date"] == base
        q = [v * 86400 for v in (flow[k] * 2)[3:19]]
        e = i["last_evaporation"] * 1e-3 * i["last_area"] * 1e6
        if lab == "GO":
            assert [r["outflow"] for r in rows] == pytest.approx([x - e for x in q])
            continue
        value = {"CL": i["wl"], "ST 3.0MCM": 3e6, "ST 5.0MCM": 5e6}.get(lab)
        if lab.endswith("%"):
            value = float(lab[3:-1]) / 100 * i["smax"] * 1e6
        target = (frac(base + datetime.timedelta(days=15)) - frac(base)) * (i["smax"] or 0) * 1e6
        for r, (o, ds, z, a) in zip(rows, loop_case(lab[:2], q, e, i["last_area"], value, target, legacy)):
            assert (r["outflow"], r["dels"], r["elevation"], r["area"]) == pytest.approx((o, ds, z, a), rel=1e-9, abs=1e-6)
            if not legacy and lab not in ("GC",):
                assert r["outflow"] + r["dels"] + e == pytest.approx(r["inflow"], abs=1e-3)


def test_forecast_over_an_area_of_zero(spark):
    base = datetime.date(2021, 3, 1)
    inflow = spark.createDataFrame([(k, base + datetime.timedelta(days=i), 2.0 + i) for k in (1, 2) for i in range(16)], "k int, date date, streamflow double")
    res = spark.createDataFrame([(1, base, 4.0, 5.0, 200.0, 101.0), (2, base, 0.0, 5.0, 200.0, 101.0)],
                                "k int, basedate date, last_area double, last_evaporation double, smax double, wl double")
    curve = spark.createDataFrame([(k, *p) for k in (1, 2) for p in CURVE], "k int, area double, elevation double")
    rule = spark.createDataFrame([(k, m + 1, v) for k in (1, 2) for m, v in enumerate(RULE)], "k int, month int, s_by_smax double")
    out = forecast.forecast(inflow, res, curve, ["k"], rule=rule, cases=forecast.CASES, target_level="wl")
    n = {(r["k"], r["label"]): r["count"] for r in out.groupBy("k", "label").count().collect()}
    assert n == {(1, c): 16 for c in ("GC", "GO", "CL", "RC", "ST 0.5%", "ST 1%", "ST 2.5%")} | {(2, "GO"): 16}  # no level follows from an area of zero


def test_rule_fraction_in_december(spark):
    c = forecast.rule_fraction(F.array(*[F.lit(v) for v in RULE]), F.lit(datetime.date(2020, 12, 15)))
    assert spark.range(1).select(c).first()[0] == pytest.approx(0.45 + (0.5 - 0.45) * 0.5)


def test_wide_product_clamps(spark):
    df = spark.createDataFrame([(1, day(0), day(0), "GO", -5.0, 1.0, 2.0), (1, day(0), day(0), "GC", 3.0, 1.0, 2.0)],
                               "k int, basedate date, date date, label string, outflow double, dels double, area double")
    r = forecast.product_columns(df, ["k"], ["GO", "GC"]).first()
    assert r["outflow (m3/d) [case: GO]"] == 0.0 and r["outflow (m3/d) [case: GC]"] == 3.0


# --- weather --------------------------------------------------------------------------------

def test_axis_fill(spark):
    v = {3: 1.0, 4: None, 5: 3.0, 0: None, 8: None, 9: None}
    df = spark.createDataFrame([(1, n, x) for n, x in v.items()], "line int, x int, v double")
    got = {r["x"]: r["v"] for r in forcings.fill_axis(df, ["line"], "x", ["v"]).collect()}
    assert got == {0: -2.0, 3: 1.0, 4: 2.0, 5: 3.0, 8: 6.0, 9: 7.0}
    short = {r["x"]: r["v"] for r in forcings.fill_axis(df, ["line"], "x", ["v"], limit=1).collect()}
    assert short[8] == 6.0 and short[9] is None
    one = spark.createDataFrame([(1, 0, 5.0), (1, 1, None)], "line int, x int, v double")
    assert {r["v"] for r in forcings.fill_axis(one, ["line"], "x", ["v"]).collect()} == {5.0, None}


def test_imputation_stops_at_the_basin(spark):
    rows = [(x, y, day(0), None if (x, y) in ((1, 1), (3, 3)) else float(x + y), (x, y) != (3, 3)) for x in range(4) for y in range(4)]
    df = spark.createDataFrame(rows, "cell_x int, cell_y int, date date, precip double, extent boolean")
    got = {(r["cell_x"], r["cell_y"]): r["precip"] for r in forcings.impute(df, ["precip"]).collect()}
    assert got[1, 1] == 2.0 and got[3, 3] is None


def test_temperatures_swap_only_when_both_known(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (6.0, 2.0)], "tmax double, tmin double")
    assert [tuple(r) for r in forcings.check_temperatures(df).collect()] == [(5.0, 1.0), (None, 5.0), (6.0, 2.0)]


def test_lead_time_limit(spark):
    with pytest.raises(ValueError):
        forcings.forecast_days(spark.createDataFrame([(day(0),)], "basedate date"), lead=16)


# --- geometry -------------------------------------------------------------------------------

def ring(ident, pts):
    return [(ident, i, *pts[i], *pts[(i + 1) % len(pts)]) for i in range(len(pts))]


def test_polygons(spark):
    shapes = {1: [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (2.0, 1.0), (0.0, 3.0)], 2: [(0.11, 0.11), (0.19, 0.11), (0.15, 0.19)]}
    edges = spark.createDataFrame([r for k, p in shapes.items() for r in ring(k, p)], "id int, seq int, x1 double, y1 double, x2 double, y2 double")
    rng = np.random.default_rng(1)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-1, 5, (300, 2)))]

    def inside(x, y, p):
        hit = False
        for i in range(len(p)):
            (x1, y1), (x2, y2) = p[i], p[(i + 1) % len(p)]
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                hit = not hit
        return hit
    got = {(r["point"], r["id"]) for r in spatial.points_in_polygons(spark.createDataFrame(pts, "point int, x double, y double"), edges, "point").collect()}
    assert got == {(i, k) for i, x, y in pts for k, p in shapes.items() if inside(x, y, p)}
    cells = spark.createDataFrame([(i * 10 + j, i, j, i * 1.0, j * 1.0 + 0.25) for i in range(5) for j in range(4)], "cell int, i int, j int, x double, y double")
    near = spatial.cells_of_polygons(cells, edges, "cell", "x", "y").where("id = 2").collect()
    assert [(r["cell"], r["method"]) for r in near] == [(0, "nearest")]


def test_track_through_a_polygon(spark):
    edges = spark.createDataFrame(ring(1, [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]), "id int, seq int, x1 double, y1 double, x2 double, y2 double")
    tracks = spark.createDataFrame([(7, -1.0, -0.5, 1.0, 1.5), (7, 1.0, 1.5, 1.5, 5.0), (8, 5.0, 0.0, 6.0, 1.0)], "track int, x1 double, y1 double, x2 double, y2 double")
    got = [tuple(r) for r in spatial.track_crossings(tracks, edges).collect()]
    assert got == [(7, 1, pytest.approx(0.5), pytest.approx(2.0))]


def test_distance_join_at_high_latitude(spark):
    rng = np.random.default_rng(6)
    p = [(i, float(70 + a), float(20 + b)) for i, (a, b) in enumerate(rng.uniform(-0.02, 0.02, (200, 2)))]
    pts = spark.createDataFrame(p, "point int, lat double, lon double")
    c = spark.createDataFrame([(1, 70.0, 20.0)], "dam int, lat double, lon double")
    got = {r["point"] for r in spatial.within_distance(pts, c, "dam", 500.0).collect()}

    def dist(la, lo):
        a, b, c_, d = map(math.radians, (la, lo, 70.0, 20.0))
        return 2 * 6371000 * math.asin(math.sqrt(math.sin((c_ - a) / 2) ** 2 + math.cos(a) * math.cos(c_) * math.sin((d - b) / 2) ** 2))
    assert got == {i for i, la, lo in p if dist(la, lo) <= 500} and got


# --- pixels ---------------------------------------------------------------------------------

def test_disc_maximum(spark):
    rng = np.random.default_rng(9)
    cells = {(int(x), int(y)): float(v) for x, y, v in zip(rng.integers(0, 12, 70), rng.integers(0, 12, 70), rng.normal(0, 5, 70))}
    df = spark.createDataFrame([(1, x, y, v) for (x, y), v in cells.items()], "scene int, x int, y int, vv double")
    for radius in (1, 3):
        got = {(r["x"], r["y"]): r["m"] for r in pixels.disc_max(df, ["scene"], "vv", radius, "m").collect()}
        want = {(x, y): max(v for (a, b), v in cells.items() if (a - x) ** 2 + (b - y) ** 2 <= radius * radius) for x, y in cells}
        assert got == want


def test_radar_water_across_tiles(spark):
    """Images of two composites over the edges of tiles and below zero; pixels without a place or angle, copies of pixels. Nothing is ordered row by row."""
    rng = np.random.default_rng(11)
    rows = [(c, i, int(x), int(y), float(v), 35.0) for c in (1, 2) for i in "abcd" for x, y, v in zip(rng.integers(-9, 140, 300), rng.integers(55, 75, 300), rng.uniform(-45, -5, 300))]
    rows += rows[::7] + [(1, "a", None, 60, -20.0, 35.0), (1, "a", 5, None, -20.0, 35.0), (2, "a", 5, 60, -1.0, 50.0), (2, "b", 5, 60, None, 35.0), (3, "a", 5, 60, -20.0, 20.0), (None, "a", 5, 60, -20.0, 35.0)]
    out = pixels.sar_water_area(spark.createDataFrame(rows, "c int, image string, x int, y int, vv double, angle double").where("c is not null"), ["c"], "image")
    cells = {}
    for c, i, x, y, v, angle in rows:
        if None not in (c, x, y, v) and 31.66 < angle < 45.4:
            cells.setdefault((c, i), {})[x, y] = max(v, cells.get((c, i), {}).get((x, y), v))
    smooth = {}
    for (c, _), image in cells.items():
        for x, y in image:
            smooth.setdefault((c, x, y), []).append(max(v for (a, b), v in image.items() if (a - x) ** 2 + (b - y) ** 2 <= 9))
    want = {c: sum(k[0] == c and -32 < np.median(v) < -13 for k, v in smooth.items()) * 1e-4 for c in (1, 2)}
    assert {r["c"]: r["sarea"] for r in out.collect()} == {1: pytest.approx(want[1]), 2: pytest.approx(want[2]), 3: None}
    assert "Window" not in out._jdf.queryExecution().toString()


def test_pixels_in_blocks(spark):
    """A pass of the clustering adds up every pixel of scenes smaller and larger than a block, for all fits at once."""
    rng = np.random.default_rng(12)
    scenes = {1: rng.normal(size=(5000, 2)), 2: rng.normal(size=(3, 2))}
    df = spark.createDataFrame([(k, float(a), float(b)) for k, x in scenes.items() for a, b in x], "scene int, a double, b double")
    blocks = pixels._blocks(df, ["scene"], ["a", "b"])
    assert sum(len(r["_x"]) for r in blocks.collect()) == 2 * 5003
    centres = {k: [{"a": float(a), "b": float(b)} for a, b in rng.normal(size=(k, 2))] for k in (1, 2, 3)}
    fits = spark.createDataFrame([(s, k, c) for s in scenes for k, c in centres.items()], "scene int, _k int, _centres array<struct<a double, b double>>")
    got = {(r["scene"], r["_k"], r["_j"]): (r["_m"], r["_d"], r["_c"]["a"], r["_c"]["b"]) for r in pixels._sums(blocks, fits, ["scene"], ["a", "b"]).collect()}
    want = {}
    for scene, x in scenes.items():
        for k, cs in centres.items():
            d = np.array([[(p - [c["a"], c["b"]]) @ (p - [c["a"], c["b"]]) for c in cs] for p in x])
            for j in set(d.argmin(axis=1)):
                mine = d.argmin(axis=1) == j
                want[scene, k, j] = (mine.sum(), d[mine, j].sum(), *x[mine].mean(axis=0))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_runs_of_sorted_rows():
    """Batches become tables that end where a value ends, however many batches a value spans."""
    import pyarrow as pa
    values = [None] * 3 + [1] * 20 + [2] * 2 + [3] * 9
    batches = [pa.RecordBatch.from_pydict({"k": pa.array(values[i:i + 2], pa.int32())}) for i in range(0, len(values), 2)]
    out = [[t["k"][int(a)].as_py() for a in starts] for t, starts in pixels._whole_runs(batches, ["k"], 4)]
    assert sum(out, []) == [None, 1, 2, 3]


def test_clusters_separate_water(spark):
    rng = np.random.default_rng(10)
    rows = []
    for scene, share in ((1, 0.3), (2, 0.6)):
        for i in range(400):
            wet = i < 400 * share
            rows.append((scene, i, float(rng.normal(0.6 if wet else -0.4, 0.03)), float(rng.normal(0.1 if wet else 0.5, 0.02)), 1.0 if wet else -1.0))
    rows += [(3, i, None, None, None) for i in range(50)]  # a cloudy scene
    df = spark.createDataFrame(rows, "scene int, pix int, ndwi double, b7 double, mbwi double")
    out = pixels.scene_areas(pixels.classify_water(df, ["scene"], ["ndwi", "b7"], F.lit(900.0)), ["scene"], F.col("water"), F.lit(900.0))
    got = {r["scene"]: r["water_area"] for r in out.collect()}
    assert got == {1: pytest.approx(120 * 900e-6), 2: pytest.approx(240 * 900e-6), 3: 0.0}


def test_gap_correction_skips_cloudy_and_dry_scenes(spark):
    rows = [(1, True, 90), (1, True, 80), (1, None, 85), (1, None, 10), (1, False, 5)]
    rows += [(2, None, 50)] * 19 + [(2, True, 50)] + [(3, False, 50)]
    df = spark.createDataFrame(rows, "scene int, water boolean, occurrence int")
    got = {r["scene"]: r["corrected_area"] for r in pixels.gap_corrected_area(df, ["scene"], F.col("water"), F.lit(1e6)).collect()}
    assert got == {1: pytest.approx(3.0), 2: -1.0, 3: -1.0}


def test_composite_windows(spark):
    df = spark.createDataFrame([(day(n),) for n in (0, 4, 5, 14, 15, 16, 31)], "image_date date")
    first = day(0).isoformat()
    spans = lambda s: {((r["image_date"] - D0).days, (r["from_date"] - D0).days) for r in pixels.composite_windows(df, s, first).collect()}
    assert spans("l8") == {(0, 0), (4, 0), (5, 0), (14, 0), (16, 16)}  # the sixteenth day is not used
    assert spans("s2") == {(0, -4), (4, 1), (5, 1), (14, 11), (15, 11), (16, 16), (31, 31)}


# --- files and streams ----------------------------------------------------------------------

def test_readers(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)
    aec = put("aec/12_Dam.csv", "# fit\n# degree 2\nCumArea,Elevation,Storage,Storage (mil. m3),Elevation_Observed\n1.5,100,0,0,99.5\n2.5,101,500000,0.5,\n")
    rows = readers.curve(spark, aec).collect()
    assert [(r["reservoir_id"], r["area"], r["elevation"], r["elevation_srtm"]) for r in rows] == [("12_Dam", 1.5, 100.0, 99.5), ("12_Dam", 2.5, 101.0, None)]
    flow = put("rout/A.day", "  2020  1  2   100.0\n  2020  1  3   200.0\n")
    assert [(r["reservoir_id"], r["date"].isoformat(), r["streamflow"]) for r in readers.routed_flow(spark, flow).collect()] == [
        ("A", "2020-01-02", pytest.approx(2.8316847)), ("A", "2020-01-03", pytest.approx(5.6633694))]
    ext = put("ext/t1.txt", " ".join(["0"] * 9 + ["12", "55000.5", "30.1", "-2.5", "nan", "1.5", "0"]) + "\nshort line\n")
    (r,) = readers.altimeter_extract(spark, ext).collect()
    assert (r["source"], r["cycle"], r["mjd"], r["lat"], r["height"]) == ("t1", 12, 55000.5, -2.5, None)
    rule = put("rc/77.txt", "Month,S/Smax\n" + "".join(f"{m},{m / 12}\n" for m in range(1, 13)))
    assert [x["s_by_smax"] for x in readers.rule_curve(spark, rule).collect()][11] == 1.0
    sta = put("sta.tsv", "1\tfoo\t3\t4\t10.5\n1\tbar\t\t4\t2\n")
    assert [x["name"] for x in readers.stations(spark, sta).collect()] == ["foo"]
    sar = put("sar/9.csv", "time,sarea\n2020-01-01 00:00:00,5.5\n2020-01-13 00:00:00,nan\n")
    assert [x["sarea"] for x in readers.series(spark, sar, "sar").collect()] == [5.5, None]
    l8 = put("l8/9.csv", "mosaic_enddate,from_date,to_date,water_area_cordeiro,non_water_area_cordeiro,cloud_area,images,corrected_area_cordeiro\n2020-01-16,2020-01-01,2020-01-17,4,2,1,0,4.5\n2020-02-01,2020-01-17,2020-02-02,4,2,1,3,4.5\n")
    o = readers.optical(spark, l8, "l8")
    assert o.count() == 2 and readers.with_images(o).first()["corrected_area"] == 4.5


def test_yearly_rerun_replaces_only_its_years(spark, tmp_path):
    path = str(tmp_path / "y")
    old = spark.createDataFrame([(day(0), 1.0), (day(366), 2.0)], "date date, v double")
    writers.yearly(old, path)
    writers.yearly(spark.createDataFrame([(day(366), 5.0)], "date date, v double"), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1.0, 5.0]
    table = str(tmp_path / "t")
    writers.append_after(spark.read.parquet(path).select("date", "v"), table)
    for _ in range(2):
        writers.append_after(spark.createDataFrame([(day(366), 9.0), (day(367), 6.0)], "date date, v double"), table)
    assert sorted((r["v"], r["year"]) for r in committed.read(spark, table).collect()) == [(1.0, 2020), (5.0, 2021), (6.0, 2021)]


def test_late_rows_replace_and_too_late_rows_drop(spark, tmp_path):
    src, table, log = str(tmp_path / "src"), str(tmp_path / "t"), str(tmp_path / "c")
    schema = "reservoir_id int, ts timestamp, value double"
    at = lambda n: datetime.datetime(2020, 1, 1, 12) + datetime.timedelta(days=n)
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        s = daily.observations(spark, src, schema)
        daily.run_upsert(daily.daily_totals(s, ["reservoir_id"], "value"), table, log).awaitTermination()
    put([(1, at(0), 1.0), (1, at(1), 2.0)])
    run()
    put([(1, at(0), 10.0), (1, at(9), 5.0)])
    run()
    put([(1, at(0), 100.0), (1, at(9), 1.0)])  # nine days late
    run()
    got = {(r["date"] - D0).days: r["total"] for r in daily.latest(spark, table, ["reservoir_id", "date"]).collect()}
    assert got == {0: 11.0, 1: 2.0, 9: 6.0}
    daily.compact(spark, table, ["reservoir_id", "date"])
    assert len(committed.manifest(spark, table)["folders"]) == 1
    assert {(r["date"] - D0).days: r["total"] for r in daily.latest(spark, table, ["reservoir_id", "date"]).collect()} == got
    whole = spark.createDataFrame([(1, D0, 3), (1, D0 + datetime.timedelta(days=1), 1)], "reservoir_id int, date date, n long")
    assert [r["late"] for r in daily.late_rows(daily.latest(spark, table, ["reservoir_id", "date"]), whole, ["reservoir_id"]).collect()] == [1]


def test_balance_of_a_long_chain(spark, monkeypatch):
    """Ten thousand nodes one below the other, with a lag here and there, and a branch into the middle: fewer than twenty rounds."""
    n, rng = 10_000, np.random.default_rng(1)
    edges = [(k, k + 1, float(k % 97 == 0)) for k in range(n - 1)] + [(n, n // 2, 0.0)]
    nodes = {(k, day(d)): (5.0 * k + float(rng.uniform(0, 4)), float(rng.normal(0, 2))) for k in range(n + 1) for d in range(2)}
    del nodes[7000, day(1)]
    flow, up = {}, {}
    for s, d, t in edges:
        up.setdefault(d, []).append((s, int(t)))
    for k in [n, *range(n)]:
        for d in range(2):
            above = [(nodes.get((s, day(d - t))), flow.get((s, d - t))) for s, t in up.get(k, [])]
            if (k, day(d)) in nodes and all(x is not None and y is not None for x, y in above):
                nat, ds = nodes[k, day(d)]
                flow[k, d] = max(0.0, max(0.0, nat - sum(x[0] for x, _ in above) + sum(y for _, y in above)) - ds)
    rounds, cut = [], network.cut_lineage
    monkeypatch.setattr(network, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    e = spark.createDataFrame(edges, "src long, dst long, travel_time double")
    s = spark.createDataFrame([(k, d, *v) for (k, d), v in nodes.items()], "node long, date date, natural double, storage_change double")
    out = {(r["node"], (r["date"] - D0).days): r["outflow"] for r in network.balance(e, s, "wb_travel_time").collect()}
    assert len(rounds) < 3 * 20 and len(out) == len(nodes)
    assert all(out[k] == (pytest.approx(flow[k], abs=1e-6) if k in flow else None) for k in out)


def test_balance_rejects_a_cycle(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (3, 4)], "src long, dst long")
    s = spark.createDataFrame([(k, D0, 1.0, 0.0) for k in range(1, 5)], "node long, date date, natural double, storage_change double")
    with pytest.raises(ValueError, match="cycle"):
        network.balance(e, s)


def test_deep_network_and_cycle(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100 + k, 20) for k in range(3)]
    nodes = spark.createDataFrame([(k,) for k in [*range(41), 100, 101, 102]], "node long")
    out, depth = network.levels(nodes, spark.createDataFrame(chain, "src long, dst long"))
    assert depth == 40 and {r["node"]: r["level"] for r in out.collect()} == {**{k: k for k in range(41)}, 100: 0, 101: 0, 102: 0}
    with pytest.raises(ValueError, match="cycle"):
        network.levels(nodes, spark.createDataFrame([*chain, (30, 25)], "src long, dst long"))


def test_rule_curve_without_a_month(spark):
    rule = spark.createDataFrame([(m, m / 10) for m in range(1, 13) if m != 3], "month int, s_by_smax double")
    day = lambda d: rule.groupBy().agg(F.lit(1)).select(F.lit(d).cast("date").alias("d"))
    from lakeledger.operators import forecast
    at = lambda d: day(d).join(forecast.rule_maps(rule, []), how="cross").select(forecast.rule_fraction(F.col("rule"), F.col("d"))).first()[0]
    assert at("2020-07-15") == pytest.approx(0.75) and at("2020-03-02") is None and at("2020-02-10") is None


def test_polygon_with_very_many_edges(spark):
    a = np.linspace(0, 2 * np.pi, 4001)[:-1]
    r = 3 + 0.4 * np.sin(37 * a)
    shape = list(zip((10 + r * np.cos(a)).tolist(), (5 + r * np.sin(a)).tolist(), strict=True))
    edges = spark.createDataFrame(ring(1, shape), "id int, seq int, x1 double, y1 double, x2 double, y2 double")
    rng = np.random.default_rng(0)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform((6, 1), (14, 9), (600, 2)))]
    got = {r["point"] for r in spatial.points_in_polygons(spark.createDataFrame(pts, "point int, x double, y double"), edges, "point").collect()}
    sure = {i: np.hypot(x - 10, y - 5) - (3 + 0.4 * np.sin(37 * np.arctan2(y - 5, x - 10))) for i, x, y in pts}
    assert {i for i, d in sure.items() if d < -1e-3} <= got <= {i for i, d in sure.items() if d < 1e-3} and len(got) > 100


def test_distance_across_the_line(spark):
    p = spark.createDataFrame([(1, 179.99, 0.0), (2, -179.99, 0.0), (3, 0.0, 0.0)], "point int, lon double, lat double")
    c = spark.createDataFrame([("a", 179.99, 0.0)], "dam string, lon double, lat double")
    assert sorted(r["point"] for r in spatial.within_distance(p, c, "dam", 5000.0).collect()) == [1, 2]


def test_routed_lines_have_one_file_per_folder(spark, tmp_path):
    path = str(tmp_path / "routed")
    df = spark.createDataFrame([(k, 2020, 1, d, float(d)) for d in range(1, 29) for k in range(5)], "k int, y int, m int, d int, q double").repartition(8, "d")
    writers.lines(df, path, ["y", "m", "d", "q"], sep="  ", by="k")
    files = [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(files) == 5 and readers.routed_flow(spark, path).count() == 140


def test_many_small_files_are_written_by_many_tasks(spark):
    df = spark.range(2000).select((F.col("id") % 100).alias("k"))
    assert len({r[0] for r in writers.spread(df, F.col("k")).select(F.spark_partition_id()).collect()}) >= 6
