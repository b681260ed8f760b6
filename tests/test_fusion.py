"""Fusion and screens against step-by-step loops, and their special cases."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeledger.operators import fusion, screens

K = ["reservoir_id"]
D0 = datetime.date(2020, 1, 1)
day = lambda n: D0 + datetime.timedelta(days=int(n))


def clip_median(dev):
    dev = list(dev)
    while len(dev) > 1:
        m, s = np.mean(dev), np.std(dev)
        kept = [d for d in dev if m - 2 * s <= d <= m + 2 * s]
        if len(kept) == len(dev):
            break
        dev = kept
    return np.median(dev) if dev else None


def loop_correct(opt, sar, threshold):
    """opt and sar: sorted lists of (day number, area or None)."""
    sx, sy = [d for d, _ in sar], [a for _, a in sar]
    at = lambda d: float(np.interp(d, sx, sy)) if sx[0] <= d <= sx[-1] else None
    dev = [a - at(d) if a is not None and at(d) is not None else None for d, a in opt]
    bias = clip_median([x for x in dev if x is not None])
    filt = [None if a is None or (x is not None and abs(x - bias) > threshold) else a for (d, a), x in zip(opt, dev)]
    known = [(d, a) for (d, _), a in zip(opt, filt) if a is not None]
    start = max(known[0][0], sx[0]) if known else sx[0]
    cut = [(d, a) for d, a in sar if d >= start]
    cx, cy = [d for d, _ in cut], [a for _, a in cut]

    def trend(d1, d2):
        lo, hi = max(d1, cx[0]), min(d2, cx[-1])
        return None if d1 == d2 or hi < lo else (np.interp(hi, cx, cy) - np.interp(lo, cx, cy)) / (d2 - d1)

    slopes = {known[i][0]: (known[i][1] - known[i - 1][1]) / (known[i][0] - known[i - 1][0]) for i in range(1, len(known))}
    inside = [(d, a) for d, a in known if d >= start]
    cor, prev = {}, None
    for i, (d, a) in enumerate(inside):
        t = trend(inside[i - 1][0], d) if i else None
        wrong = t is not None and d in slopes and abs(slopes[d] - t) > 10
        cor[d] = prev + t * (d - inside[i - 1][0]) if wrong else a
        prev = cor[d]
    begin = max(min(cor) if cor else -1, cx[0], opt[0][0])
    out, last = {}, None
    for i, (d, _) in enumerate(opt):
        if d < begin:
            continue
        t = trend(opt[i - 1][0], d) if i else None
        if d in cor:
            last = cor[d]
        else:
            last = last + t * (d - opt[i - 1][0]) if last is not None and t is not None else None
        out[d] = last
    return out


@pytest.fixture(scope="module")
def cases():
    rng = np.random.default_rng(11)
    data = {}
    for rid in range(8):
        level = np.cumsum(rng.normal(0, 1.5, 200)) + 80
        od = sorted(rng.choice(np.arange(5 * (rid % 3), 190), 40, replace=False))
        opt = [(int(d), float(level[d] + rng.normal(0, 2) + (60 if rng.random() < 0.1 else 0))) for d in od]
        opt = [(d, None if rng.random() < 0.05 else a) for d, a in opt]
        sd = range(int(rng.integers(0, 20)), 160, 12)
        data[rid] = (opt, [(int(d), float(level[d] - 4)) for d in sd])
    return data


def test_trend_correction(spark, cases):
    o = spark.createDataFrame([(r, day(d), a) for r, (opt, _) in cases.items() for d, a in opt], "reservoir_id int, date date, area double")
    s = spark.createDataFrame([(r, day(d), a) for r, (_, sar) in cases.items() for d, a in sar], "reservoir_id int, date date, area double")
    got = {}
    for r in fusion.trend_correction(o, s, K, F.lit(12.0)).collect():
        got.setdefault(r["reservoir_id"], {})[(r["date"] - D0).days] = r["filled_area"]
    for rid, (opt, sar) in cases.items():
        want = loop_correct(opt, sar, 12.0)
        assert set(got[rid]) == set(want)
        for d, v in want.items():
            assert got[rid][d] == (pytest.approx(v, abs=1e-6) if v is not None else None), (rid, d)


def test_legacy_correction_starts_from_the_second_row(spark, cases):
    opt, sar = cases[0]
    o = spark.createDataFrame([(0, day(d), a) for d, a in opt], "reservoir_id int, date date, area double")
    s = spark.createDataFrame([(0, day(d), a) for d, a in sar], "reservoir_id int, date date, area double")
    new = fusion.trend_correction(o, s, K, F.lit(12.0)).where("corrected_area is not null").orderBy("date").collect()
    old = fusion.trend_correction(o, s, K, F.lit(12.0), legacy=True).where("corrected_area is not null").orderBy("date").collect()
    assert old[0]["corrected_area"] == new[1]["filtered_area"]


def test_methods_and_special_cases(spark):
    optical, sar, res = [], [], [(i, 50.0) for i in range(5)]
    for n in range(0, 200, 5):
        for rid in range(5):
            cloud = 95.0 if rid == 4 else 10.0  # 4: clouds only
            optical.append((rid, "s2", day(n), 40.0 + n / 50, 5.0, 1000.0 if rid == 4 else cloud, 40.0 + n / 50))
    for n in range(0, 200, 12):
        sar.append((1, day(n), 39.0 + n / 50))           # overlaps from the start
        if n > 90:
            sar.append((2, day(n), 39.0 + n / 50))       # begins late
    sar += [(3, day(0), 10.0), (3, day(12), 10.0)]       # too short
    o = spark.createDataFrame(optical, "reservoir_id int, sat string, date date, water_area double, non_water_area double, cloud_area double, corrected_area double")
    s = spark.createDataFrame(sar, "reservoir_id int, date date, sarea double")
    r = spark.createDataFrame(res, "reservoir_id int, nominal_area double")
    rows = fusion.fuse(o, s, r, K).collect()
    method = {x["reservoir_id"]: x["method"] for x in rows}
    assert method == {0: "Optical", 1: "Trend", 2: "Combine", 3: "Optical", 4: "Optical"}
    assert all(x["filled_area"] is None and x["quality"] == 1 for x in rows if x["reservoir_id"] == 4)
    assert all(x["filled_area"] == pytest.approx(40 + (x["date"] - D0).days / 50, abs=0.5) for x in rows if x["reservoir_id"] in (0, 1, 2, 3))
    assert len({(x["reservoir_id"], x["date"]) for x in rows}) == len(rows)


def test_thresholds(spark):
    df = spark.createDataFrame([(5.0,), (50.0,), (500.0,)], "a double")
    got = lambda legacy: [r[0] for r in df.select(fusion.area_threshold(F.col("a"), legacy)).collect()]
    assert got(False) == [1.25, 5.0, 25.0]
    assert got(True) == [0.5, 5.0, 25.0]


def test_jump_screen(spark):
    rows = [(1, day(12 * i), 100.0) for i in range(6)]
    rows[3] = (1, day(36), 180.0)
    df = spark.createDataFrame([(*r, 100.0) for r in rows], "reservoir_id int, date date, sarea double, nominal_area double")
    got = [r["sarea"] for r in fusion.jump_screen(df, K).orderBy("date").collect()]
    # The row after the jump also changed by more than the limit, and both are interpolated.
    assert got == pytest.approx([100.0] * 6)


def clipped(spark, groups):
    rows = [(k, None if x is None else float(x)) for k, v in groups.items() for x in v]
    return {r["k"]: r for r in fusion.clipped_medians(spark.createDataFrame(rows, "k int, v double"), ["k"], "v").collect()}


def test_sigma_clip(spark):
    v = [1.0, 1.1, 0.9, 1.05, 0.95, 1.0, 1.02, 30.0, -20.0]
    out = clipped(spark, {1: v, 2: [None, None], 3: [4.5], 4: [2.0] * 7, 5: [1.0, 2.0, None], 6: [1e12, 1.0, 1.1, 0.9, 1.0, 1.05, 0.95, 1.02, 1.01]})
    assert out[1]["median"] == pytest.approx(clip_median(v)) and out[1]["kept"] == 7
    assert 2 not in out and [out[k]["median"] for k in (3, 4, 5)] == [4.5, 2.0, 1.5] and out[6]["highest"] == pytest.approx(1.1)


def loop_trend(opt, sar, months, sigmas):
    st = [None] + [sar[i] / sar[i - 1] - 1 for i in range(1, len(sar))]
    ot = [None] + [opt[i] / opt[i - 1] - 1 for i in range(1, len(opt))]
    dev = pd.Series([abs(a - b) if a is not None else np.nan for a, b in zip(ot, st)])
    std = dev.groupby(pd.Series(months)).transform("std")
    cor = list(opt)
    for i in range(3, len(opt)):
        recent = (cor[i] / cor[i - 1] - 1 + cor[i - 1] / cor[i - 2] - 1) / 2
        if abs(recent - st[i]) > sigmas * std[i]:
            av = (st[i - 1] + st[i - 2]) / 2
            cor[i] = (cor[i - 1] + cor[i - 2]) / 2 * (1 + av)
    return cor


def test_trend_screen(spark):
    rng = np.random.default_rng(5)
    opt = list(np.abs(rng.normal(50, 12, 80)) + 1)
    sar = list(np.abs(rng.normal(50, 2, 80)) + 1)
    df = spark.createDataFrame([(1, day(i), float(o), float(s)) for i, (o, s) in enumerate(zip(opt, sar))], "reservoir_id int, date date, optical double, sar double")
    got = [r["optical"] for r in screens.trend_screen(df, K, 0.8).orderBy("date").collect()]
    assert got == pytest.approx(loop_trend(opt, sar, [day(i).strftime("%Y%m") for i in range(80)], 0.8))


def test_strengths():
    assert screens.limit("outlier", 9) == 0.5 and screens.limit("outlier", 1) == 4.0
    assert screens.limit("bias", 9) == 5.0 and screens.limit("bias", 1) == 20.0
    assert screens.limit("trend", 9) == pytest.approx(0.1) and screens.limit("trend", 0) == screens.OFF
    with pytest.raises(ValueError):
        screens.limit("bias", 10)


def test_write_back_and_reset(spark):
    fused = spark.createDataFrame([(1, day(0), 10.0), (1, day(5), 11.0), (1, day(9), 12.0)], "reservoir_id int, date date, area double")
    new = spark.createDataFrame([(1, day(0), 9.0), (1, day(9), 13.0)], "reservoir_id int, date date, area double")
    once = screens.write_back(fused, new, K)
    rows = once.orderBy("date").collect()
    assert [r["area"] for r in rows] == [9.0, None, 13.0] and [r["area_fused"] for r in rows] == [10.0, 11.0, 12.0]
    assert [r["days_passed"] for r in rows] == [0, 5, 4]
    again = screens.write_back(once, new, K)
    assert [r["area_fused"] for r in again.orderBy("date").collect()] == [10.0, 11.0, 12.0]
    assert [r["area"] for r in screens.reset(again).orderBy("date").collect()] == [10.0, 11.0, 12.0]


def test_bias_legacy_sign(spark):
    df = spark.createDataFrame([(1, 50.0, 80.0, 100.0), (1, 99.0, 80.0, 100.0)], "reservoir_id int, optical double, sar double, nominal_area double")
    assert [r["optical"] for r in screens.bias_screen(df, 10.0).collect()] == [70.0, 90.0]
    assert [r["optical"] for r in screens.bias_screen(df, 10.0, legacy=True).collect()] == [90.0, 90.0]


def test_sign_correction(spark):
    df = spark.createDataFrame([(1, day(0), 10.0, None, None, 0), (1, day(2), 14.0, 2.0, -1.0, 2), (1, day(4), 16.0, 1.0, 1.0, 2)],
                               "reservoir_id int, date date, corrected_area double, trend double, sar_trend double, days_passed int")
    assert [r["sign_area"] for r in fusion.sign_correction(df, K).orderBy("date").collect()] == [10.0, 8.0, 16.0]


def loop_clip(v):
    kept, rounds = np.array(v), 0
    while len(kept) > 1:
        inside = kept[np.abs(kept - kept.mean()) <= 2 * kept.std()]
        if len(inside) == len(kept):
            break
        kept, rounds = inside, rounds + 1
    return np.sort(kept), rounds


def test_sigma_clip_until_stable(spark):
    """Many rounds, and five thousand values: growing powers lose a few at a time."""
    rng = np.random.default_rng(6)
    groups = {1: [1.6 ** k for k in range(700)], 2: list(np.exp(rng.normal(0, 2.5, 5000))), 3: [1.03 ** k for k in range(5000)][:1500] + list(rng.normal(0, 1, 3500)),
              4: [10.0 ** k for k in range(16)], 5: list(rng.normal(1e8, 1e-2, 300)) + [0.0, 2e8]}
    out, most = clipped(spark, groups), 0
    for k, v in groups.items():
        kept, rounds = loop_clip(v)
        assert (out[k]["n"], out[k]["kept"]) == (len(v), len(kept)), k
        assert out[k]["lowest"] == pytest.approx(kept[0]) and out[k]["highest"] == pytest.approx(kept[-1]) and out[k]["median"] == pytest.approx(np.median(kept))
        most = max(most, rounds)
    assert most > 150


def test_spike_beside_nine_equal_values(spark, days):
    """Exactly three deviations out: rounding of a running mean and spread in date order decides, in any order of the rows."""
    series = {1: (1.99, 13.5), 2: (14.99, 4.66), 3: (66.77, 4.51)}
    rows = [(k, days(i), spike if i == 0 else rest) for k, (spike, rest) in series.items() for i in range(10)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, date date, sarea double").repartition(3, "sarea")
        got = {r["k"]: r["sarea"] for r in fusion.spike_screen(df, ["k"]).where(F.col("date") == days(0)).collect()}
        assert got == {1: None, 2: None, 3: 66.77}


def test_threshold_is_the_share_times_the_area(spark):
    """A deviation that lies on the threshold is decided as by the share, 0.1 * 14 = 1.4000000000000001, not by 10 * 14 / 100 = 1.4."""
    areas = [6.0, 12.0, 14.0, 17.0, 99.0, 102.0, 111.0]
    df = spark.createDataFrame([(a,) for a in areas], "a double").select("a", fusion.area_threshold(F.col("a")), fusion.area_threshold(F.col("a"), legacy=True))
    for a, new, old in df.collect():
        assert new == a * (0.25 if a < 10 else 0.1 if a < 100 else 0.05) and old == a * (0.1 if a < 100 else 0.05)
