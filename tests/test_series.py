"""Calendar operators: small tables, numpy references, invariants."""

import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeledger.functions import columns as fn
from lakeledger.operators import balance, curves, products, series
from lakeledger.operators.incremental import incremental_update

K = ["k"]
D0 = datetime.date(2020, 1, 1)
day = lambda n: D0 + datetime.timedelta(days=int(n))
few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
points = st.dictionaries(st.integers(0, 60), st.one_of(st.none(), st.floats(-50, 50)), min_size=1, max_size=15)


def frame(spark, d, value="v"):
    return spark.createDataFrame([(1, day(n), v) for n, v in d.items()], f"k int, date date, {value} double")


def numbers(df, value="v"):
    return {(r["date"] - D0).days: r[value] for r in df.collect()}


@few
@given(points)
def test_fill_by_time(spark, d):
    got = numbers(series.fill_by_time(frame(spark, d), K, ["v"]))
    x = sorted(n for n, v in d.items() if v is not None)
    for n in d:
        want = None if not x or n < x[0] else np.interp(n, x, [d[i] for i in x])
        assert got[n] == (None if want is None else pytest.approx(want, abs=1e-9))
        if want is not None:
            assert min(d[i] for i in x) - 1e-9 <= got[n] <= max(d[i] for i in x) + 1e-9


@few
@given(points)
def test_spread_totals_keeps_the_total(spark, d):
    got = numbers(series.spread_totals(frame(spark, d), K, "v"))
    known = [v for v in d.values() if v is not None]
    if known:
        assert sorted(got) == list(range(min(d), max(d) + 1))
        assert sum(got.values()) == pytest.approx(sum(known), abs=1e-6)
    else:
        assert got == {}


@few
@given(st.lists(st.integers(0, 60), min_size=1, max_size=12, unique=True), points)
def test_value_at(spark, targets, d):
    t = spark.createDataFrame([(1, day(n)) for n in targets], "k int, date date")
    got = numbers(series.value_at(t, frame(spark, d), K, "v", "s"), "s")
    x = sorted(n for n, v in d.items() if v is not None)
    for n in targets:
        inside = x and x[0] <= n <= x[-1]
        assert got[n] == (pytest.approx(np.interp(n, x, [d[i] for i in x]), abs=1e-9) if inside else None)


@few
@given(st.lists(st.integers(0, 60), min_size=1, max_size=10, unique=True), points, st.booleans())
def test_interval_sums(spark, ends, flow, closed):
    e = spark.createDataFrame([(1, day(n), float(n)) for n in ends], "k int, date date, x double")
    got = numbers(series.interval_sums(e, frame(spark, flow), K, "v", "s", both_closed=closed), "s")
    ends = sorted(ends)
    assert got[ends[0]] is None
    for a, b in zip(ends, ends[1:]):
        want = sum(v for n, v in flow.items() if v is not None and (a <= n if closed else a < n) and n <= b)
        assert got[b] == pytest.approx(want, abs=1e-6)


def test_regular_grid_drops_off_grid_rows(spark):
    df = frame(spark, {0: 1.0, 5: 2.0, 7: 9.0, 15: 4.0, 18: 5.0})
    rows = series.regular_grid(df, K, 5, ["v"]).orderBy("date").collect()
    assert [((r["date"] - D0).days, r["v"], r["observed"]) for r in rows] == [(0, 1.0, True), (5, 2.0, True), (10, None, False), (15, 4.0, True)]
    assert numbers(series.regular_grid(frame(spark, {3: 1.0}), K, 5, ["v"])) == {3: 1.0}


def test_savgol_against_least_squares(spark):
    rng = np.random.default_rng(0)
    for n in (7, 8, 13):
        v = rng.normal(0, 5, n)
        got = numbers(frame(spark, dict(enumerate(map(float, v)))).withColumn("s", series.savgol_smooth(K, "v")), "s")
        for i in range(n):
            lo = min(max(i - 3, 0), n - 7)
            want = np.polyval(np.polyfit(np.arange(7), v[lo:lo + 7], 3), i - lo)
            assert got[i] == pytest.approx(want, abs=1e-8)
    assert set(numbers(frame(spark, {i: 1.0 for i in range(6)}).withColumn("s", series.savgol_smooth(K, "v")), "s").values()) == {None}


def test_weighted_smooth(spark):
    df = frame(spark, {0: 1.0, 1: 2.0, 2: None, 3: 4.0}).withColumn("w", F.lit(2.0))
    got = numbers(df.withColumn("s", series.weighted_smooth(K, "v", "w")), "s")
    assert got == {0: 1.5, 1: None, 2: None, 3: None}
    with pytest.raises(ValueError):
        series.weighted_smooth(K, "v", "w", window=4)


def test_trend_fill_unknown_step(spark):
    df = spark.createDataFrame([(1, day(0), None, 1.0, 0), (1, day(1), 5.0, 1.0, 1), (1, day(3), None, 1.0, 2), (1, day(4), None, None, 1),
                                (1, day(5), None, 1.0, 1), (1, day(6), 2.0, 1.0, 1), (1, day(7), None, -1.0, 1)],
                               "k int, date date, v double, t double, days int")
    assert numbers(series.trend_fill(df, K, "v", "t", "days", "f"), "f") == {0: None, 1: 5.0, 3: 7.0, 4: None, 5: None, 6: 2.0, 7: 1.0}


def test_neighbour_fill(spark):
    got = numbers(series.neighbour_fill(frame(spark, {0: 2.0, 2: 4.0, 5: 8.0}), K, ["v"]))
    assert got == {0: 2.0, 1: 3.0, 2: 4.0, 3: 4.0, 4: 8.0, 5: 8.0}


def test_clip_without_overlap(spark):
    a, b = frame(spark, {0: 1.0, 1: 1.0}), frame(spark, {5: 1.0})
    assert series.clip_to_overlap([a, b], K)[0].count() == 0
    with pytest.raises(Exception, match="no overlapping period"):
        series.clip_to_overlap([a, b], K, strict=True)[0].collect()
    with pytest.raises(ValueError):
        series.clip_to_overlap([a, b], K, "middle")


def test_extrapolate_needs_two_points(spark):
    assert numbers(series.extrapolate_step(frame(spark, {0: 1.0}), K, "v")) == {0: 1.0}
    assert numbers(series.extrapolate_step(frame(spark, {0: 1.0, 4: 3.0}), K, "v")) == {0: 1.0, 4: 3.0, 16: 9.0}


def test_week_ends_on_sunday(spark):
    df = frame(spark, {4: 1.0, 5: 3.0})  # 2020-01-05 is a Sunday
    got = {(r["period_end"].isoformat(), r["v"], r["dt"]) for r in series.period_means(df, K, ["v"], "weekly").collect()}
    assert got == {("2020-01-05", 1.0, 1), ("2020-01-12", 3.0, 1)}
    with pytest.raises(ValueError):
        series.period_means(df, K, ["v"], "hourly")


def test_incremental_update_is_idempotent(spark):
    src = frame(spark, {n: float(n) for n in range(0, 30, 5)})
    old = frame(spark, {0: 0.0, 5: 50.0, 10: 100.0})
    end, first = F.lit(day(30)), F.lit(day(0))
    once = incremental_update(old, src, K, 5, end, first)
    assert numbers(once) == {n: float(n) for n in range(0, 30, 5)}
    assert numbers(incremental_update(once, src, K, 5, end, first)) == numbers(once)


# --- curves and balance ---------------------------------------------------------------------

def test_curve_lookup_like_interp(spark):
    pts = [(0.0, 10.0), (1.0, 11.0), (1.0, 12.0), (4.0, 13.0), (4.0, 14.0)]
    curve = spark.createDataFrame([(1, *p) for p in pts] + [(2, 3.0, 7.0)], "k int, area double, elevation double")
    xs = [-1.0, 0.0, 0.5, 1.0, 2.5, 4.0, 9.0]
    df = spark.createDataFrame([(1, x) for x in xs] + [(2, 1.0), (2, 8.0), (3, 1.0), (1, None)], "k int, x double")
    out = curves.curve_lookup(df, curve, K, "x", "area", "elevation", "z").collect()
    got = {(r["k"], r["x"]): r["z"] for r in out}
    for x in xs:
        assert got[(1, x)] == pytest.approx(np.interp(x, [p[0] for p in pts], [p[1] for p in pts]))
    assert got[(2, 1.0)] == got[(2, 8.0)] == 7.0 and got[(3, 1.0)] is None and got[(1, None)] is None
    assert len(out) == len(xs) + 4
    arr = curves.curve_arrays(curve, K)
    by_array = {(r["k"], r["x"]): r["z"] for r in df.join(arr, "k").withColumn("z", curves.array_lookup(F.col("curve"), F.col("x"), "a", "z")).where("x is not null").collect()}
    assert all(by_array[k] == pytest.approx(got[k]) for k in by_array)


def test_curve_fit_with_fixed_intercept(spark):
    x = np.arange(1.0, 12.0)
    y = 100 + 2 * x + 0.1 * x * x
    rows = [(k, float(a), float(b), bottom) for k, bottom in ((1, 98.0), (2, 101.0), (3, 90.0)) for a, b in zip(x, y)]
    fits = {r["k"]: r for r in curves.fit_curve(spark.createDataFrame(rows, "k int, area double, elevation double, dam_bottom double"), K).collect()}
    assert (fits[1]["c0"], fits[1]["c1"], fits[1]["c2"]) == pytest.approx((100, 2, 0.1), abs=1e-6)
    for k, c0 in ((2, 101.0), (3, 95.0)):
        a = np.stack([x, x * x], axis=1)
        want = np.linalg.lstsq(a, y - c0, rcond=None)[0]
        assert fits[k]["c0"] == c0 and (fits[k]["c1"], fits[k]["c2"]) == pytest.approx(tuple(want), abs=1e-6)
    falling = [(1, float(a), float(50 - a), 48.0) for a in x]
    assert curves.fit_curve(spark.createDataFrame(falling, "k int, area double, elevation double, dam_bottom double"), K).count() == 0


def test_balance_closes(spark):
    areas = spark.createDataFrame([(1, day(n), a, 10.0) for n, a in ((0, 10.0), (5, 12.0), (10, 9.0))], "k int, date date, area double, nominal_area double")
    curve = spark.createDataFrame([(1, 5.0, 100.0), (1, 15.0, 110.0)], "k int, area double, elevation double")
    flow = frame(spark, {n: 3.0 for n in range(11)}, "streamflow")
    evap = frame(spark, {n: 4.0 for n in range(11)}, "evaporation")
    ds = balance.storage_change(areas, curve, K)
    for r in balance.outflow(ds, flow, evap, K, subtract_evaporation=True).collect():
        assert r["outflow_vol"] + r["ds"] * 1e9 + r["evap_vol"] == pytest.approx(r["inflow_vol"])
        assert r["inflow_vol"] == pytest.approx(5 * 3 * 86400)
    assert ds.where("date = '2020-01-06'").first()["ds"] == pytest.approx(2.0 * 11e6 * 1e-9)


def test_evaporation_with_daily_area(spark):
    cells = spark.createDataFrame([(1, day(n), 100.0 + c, 20.0, 2.0, 1.5, 100.0) for n in range(5) for c in (0, 10)],
                                  "k int, date date, net_radiation double, air_temp double, wind double, vapor_pressure double, pressure double")
    areas = frame(spark, {0: 10.0, 2: 20.0}, "area")
    out = balance.evaporation(cells, areas, K).orderBy("date").collect()
    assert [(r["date"] - D0).days for r in out] == [1, 2] and [r["area"] for r in out] == [15.0, 20.0]
    es = 0.6108 * np.exp(17.27 * 20 / 257.3)
    slope, gamma = 4098 * es / 257.3**2, 1000 * 100 / (0.622 * 2.45e6)
    want = slope * 105 / (28.34 * (slope + gamma)) + 1.26 * 15**-0.05 * gamma * 2 * (es - 1.5) / (slope + gamma)
    assert out[0]["evaporation"] == pytest.approx(want)
    longer = balance.evaporation(cells, areas, K, until=F.lit(day(4)))
    assert [(r["date"] - D0).days for r in longer.orderBy("date").collect()] == [1, 2, 3, 4]


def test_products_and_comparison(spark):
    df = frame(spark, {0: -2.0, 1: 1.0}, "outflow_rate")
    assert [r[0] for r in products.product(df, "outflow", K).orderBy("date").select("`outflow (m3/d)`").collect()] == [0.0, 86400.0]
    a = spark.createDataFrame([(1, day(0), 100.0), (2, day(0), 100.0), (3, day(0), 100.0)], "k int, date date, v double")
    b = spark.createDataFrame([(1, day(0), 104.0), (2, day(0), 94.0)], "k int, date date, v double")
    got = {r["k"]: r["status"] for r in products.compare(a, b, ["k", "date"], K, ["v"]).collect()}
    assert got == {1: "match", 2: "unmatch", 3: "missing"}
    assert products.forecast_product(df, F.lit(day(1))).count() == 1
    sarea = frame(spark, {0: 1.23456}, "area")
    assert products.product(sarea, "sarea", K).first()["area (km2)"] == 1.235
    assert products.product(sarea, "sarea", K, rounded=False).first()["area (km2)"] == 1.23456


def test_scalars(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(fn.round_away(F.lit(1.0000001), 6)) == 1.000001 and value(fn.round_away(F.lit(-1.0000001), 6)) == -1.000001
    assert value(fn.half_up_count(F.lit(2.5))) == 3
    assert value(fn.date_from_decimal_year(F.lit(2020.5))).isoformat() == "2020-07-02"
    assert value(fn.date_from_decimal_year(F.lit(2021.5))).isoformat() == "2021-07-02"
    assert value(fn.wrap_longitude(F.lit(190.0))) == -170.0 and value(fn.wrap_longitude(F.lit(10.0))) == 10.0
    assert value(fn.null_if(F.lit(float("nan")))) is None and value(fn.null_if(F.lit(-1.0), -1)) is None and value(fn.null_if(F.lit(2.0), -1)) == 2.0
    assert value(fn.recode_in_order(F.lit(1), [(1, 2), (2, 3)])) == 3
    assert value(fn.file_stem(F.lit("/a/b.c/name.x.csv"))) == "name.x"
    assert [list(r) for r in value(fn.chunks(F.array(*[F.lit(i) for i in range(5)]), 2))] == [[0, 1], [2, 3], [4]]
    assert [tuple(r) for r in value(fn.consecutive_pairs(F.array(F.lit(1), F.lit(2), F.lit(3))))] == [(1, 2), (2, 3)]
    assert value(fn.truncated_key(F.lit(-1.239))) == -1.23
    assert value(fn.kelvin_to_celsius(F.lit(300.0))) == pytest.approx(26.85)
