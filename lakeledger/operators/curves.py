"""Area-elevation curves: lookup, building, fitting, storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import let
from lakeledger.operators.scale import exact_quantiles
from lakeledger.operators.series import START, HERE, ordered, running_trapezoid

PIXEL_AREA_M2 = 900.0  # 30 m pixels


def segments(curve: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Half-open pieces ``[_lo, _hi)`` that cover the whole axis, one per curve point.

    The first piece reaches down and the last one up without limit, so that a lookup outside the
    curve takes the end value and every input meets exactly one piece.
    """
    w = ordered(keys, x, y)
    pts = curve.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *keys, F.col(x).cast("double").alias("_x0"), F.col(y).cast("double").alias("_y0"))
    w = ordered(keys, "_x0", "_y0")
    pts = pts.select("*", F.lead("_x0").over(w).alias("_x1"), F.lead("_y0").over(w).alias("_y1"),
                     F.row_number().over(w).alias("_i"))
    lo = F.when(F.col("_i") == 1, F.lit(float("-inf"))).otherwise(F.col("_x0"))
    hi = F.coalesce(F.col("_x1"), F.lit(float("inf")))
    return pts.select(*keys, "_x0", "_y0", "_x1", "_y1", lo.alias("_lo"), hi.alias("_hi"))


def curve_lookup(df: DataFrame, curve: DataFrame, keys: Sequence[str], x: str, curve_x: str, curve_y: str,
                 out: str) -> DataFrame:
    """Piecewise-linear value of each key's curve at ``x``, held constant beyond its ends.

    An equi-join on the curve key with a range test inside: the curves are broadcast only when
    their measured size allows it, else both sides are partitioned by key. Rows without a curve
    or with a NULL ``x`` keep a NULL.
    """
    pieces = segments(curve, keys, curve_x, curve_y)
    at = F.col(x).cast("double")
    cond = (at >= F.col("_lo")) & (at < F.col("_hi"))
    for k in keys:
        cond = cond & (df[k] == pieces[k])
    joined = df.join(pieces, cond, "left").drop(*[pieces[k] for k in keys])
    inside = F.greatest(at, F.col("_x0"))
    slope = (F.col("_y1") - F.col("_y0")) / (F.col("_x1") - F.col("_x0"))
    value = F.when(F.col("_x1").isNull() | (F.col("_x1") == F.col("_x0")), F.col("_y0")).otherwise(
        F.col("_y0") + slope * (inside - F.col("_x0")))
    return joined.withColumn(out, F.when(at.isNotNull(), value)).drop("_x0", "_y0", "_x1", "_y1", "_lo", "_hi")


def curve_arrays(curve: DataFrame, keys: Sequence[str], area: str = "area", elevation: str = "elevation") -> DataFrame:
    """One row per key with its sorted curve points, for lookups inside a fold.

    A curve has one point per whole metre between its lowest and highest level, so the array is
    small whatever the size of the pixel table behind it.
    """
    pt = F.struct(F.col(area).cast("double").alias("a"), F.col(elevation).cast("double").alias("z"))
    return curve.groupBy(*keys).agg(F.array_sort(F.collect_list(pt)).alias("curve"))


def array_lookup(points: Column, x: Column, frm: str, to: str) -> Column:
    """The same lookup on an array of sorted points."""
    def at(p):
        below = F.filter(points, lambda q: q[frm] <= p)
        above = F.filter(points, lambda q: q[frm] > p)
        return let(F.struct(F.try_element_at(below, F.lit(-1)).alias("lo"), F.get(above, F.lit(0)).alias("hi")), lambda s: (
            F.when(s["lo"].isNull(), s["hi"][to])
            .when(s["hi"].isNull(), s["lo"][to])
            .otherwise(s["lo"][to] + (s["hi"][to] - s["lo"][to]) / (s["hi"][frm] - s["lo"][frm]) * (p - s["lo"][frm]))))
    return let(x, at)


def observed_curve(dem: DataFrame, keys: Sequence[str], elevation: str = "elevation",
                   pixel_area_m2: float = PIXEL_AREA_M2) -> DataFrame:
    """Area at or below each whole metre from the lowest to the highest pixel.

    Pixels are counted per level before the shuffle; only the short histogram is ordered.
    """
    hist = (dem.where(F.col(elevation).isNotNull()).groupBy(*keys, F.ceil(elevation).alias("elevation"))
            .agg(F.count(F.lit(1)).alias("_n")))
    w = ordered(keys, "elevation")
    run = hist.withColumn("_cum", F.sum("_n").over(w.rowsBetween(START, HERE))).withColumn(
        "_next", F.coalesce(F.lead("elevation").over(w) - 1, F.col("elevation")))
    filled = run.select(*keys, F.explode(F.sequence("elevation", "_next")).alias("elevation"), "_cum")
    return filled.select(*keys, F.col("elevation").cast("int").alias("elevation"),
                         F.round(F.col("_cum") * F.lit(pixel_area_m2) / 1e6, 3).alias("area"))


def above_water_surface(curve: DataFrame, keys: Sequence[str], area: str = "area", elevation: str = "elevation") -> DataFrame:
    """The part of the curve from its largest step upwards (the first one on a tie)."""
    w = ordered(keys, elevation)
    staged = curve.withColumn("_step", F.round(F.col(area) - F.lag(area).over(w), 6))
    rank = F.struct(F.col("_step"), -F.col(elevation))
    top = F.max_by(F.when(F.col("_step").isNotNull(), F.col(elevation)),
                   F.when(F.col("_step").isNotNull(), rank)).over(Window.partitionBy(*keys))
    return staged.withColumn("_from", top).where(F.col(elevation) >= F.col("_from")).drop("_step", "_from")


def dam_bottom(pixels_near_dam: DataFrame, keys: Sequence[str], elevation: str = "elevation",
               percents: Sequence[int] = (1, 2, 3, 4, 5, 10)) -> DataFrame:
    """Low percentiles, minimum and maximum of the terrain around a dam; ``p1`` is the dam bottom."""
    stats = exact_quantiles(pixels_near_dam, keys, elevation, {f"p{p}": p / 100.0 for p in percents})
    ends = pixels_near_dam.groupBy(*keys).agg(F.min(elevation).alias("min"), F.max(elevation).alias("max"))
    return stats.select(*keys, *[F.col(f"p{p}_lin").alias(f"p{p}") for p in percents]).join(ends, list(keys))


def between_dam_levels(curve: DataFrame, dams: DataFrame, keys: Sequence[str], elevation: str = "elevation") -> DataFrame:
    """Keep levels above the dam bottom and up to bottom plus dam height."""
    joined = curve.join(dams.select(*keys, "dam_bottom", "dam_height"), list(keys))
    return joined.where((F.col(elevation) > F.col("dam_bottom"))
                        & (F.col(elevation) <= F.col("dam_bottom") + F.col("dam_height")))


def fit_curve(curve: DataFrame, keys: Sequence[str], area: str = "area", elevation: str = "elevation",
              slack: float = 5.0) -> DataFrame:
    """Least-squares elevation as a polynomial of area: degree two, else one.

    Needs a ``dam_bottom`` column. The intercept must lie in ``[dam_bottom, dam_bottom + slack]``;
    where the free fit leaves that range it is fixed at the nearer bound and the rest is solved
    again. A fit must not fall between zero and the largest area. Moments are plain sums, so every
    curve is reduced before the shuffle. Returns ``c0, c1, c2, degree`` and ``max_area``.
    """
    x, y = F.col(area).cast("double"), F.col(elevation).cast("double")
    m = curve.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.first("dam_bottom").cast("double").alias("b"),
        F.max(x).alias("max_area"), F.countDistinct(x).alias("levels"),
        *[F.sum(F.pow(x, F.lit(float(k)))).alias(f"s{k}") for k in (1, 2, 3, 4)],
        *[F.sum(F.pow(x, F.lit(float(k))) * y).alias(f"t{k}") for k in (0, 1, 2)])
    c = F.col
    det3 = lambda a, b_, c_, d, e, f, g, h, i: a * (e * i - f * h) - b_ * (d * i - f * g) + c_ * (d * h - e * g)
    n, s1, s2, s3, s4, t0, t1, t2 = (c(k) for k in ("n", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))
    m = m.withColumn("_d3", det3(n, s1, s2, s1, s2, s3, s2, s3, s4)).withColumn("_d2", n * s2 - s1 * s1)
    free = {
        2: (F.try_divide(det3(t0, s1, s2, t1, s2, s3, t2, s3, s4), c("_d3")),
            F.try_divide(det3(n, t0, s2, s1, t1, s3, s2, t2, s4), c("_d3")),
            F.try_divide(det3(n, s1, t0, s1, s2, t1, s2, s3, t2), c("_d3"))),
        1: (F.try_divide(t0 * s2 - s1 * t1, c("_d2")), F.try_divide(n * t1 - s1 * t0, c("_d2")), F.lit(0.0)),
    }
    fits = []
    for degree, (f0, f1, f2) in free.items():
        fixed0 = F.least(F.greatest(f0, c("b")), c("b") + slack)
        stay = fixed0 == f0
        r1, r2 = t1 - fixed0 * s1, t2 - fixed0 * s2
        if degree == 2:
            d = s2 * s4 - s3 * s3
            g1, g2 = F.try_divide(r1 * s4 - r2 * s3, d), F.try_divide(s2 * r2 - s3 * r1, d)
        else:
            g1, g2 = F.try_divide(r1, s2), F.lit(0.0)
        c1, c2 = F.when(stay, f1).otherwise(g1), F.when(stay, f2).otherwise(g2)
        # The slope is linear in the area, so its sign at both ends decides.
        ok = (c("levels") > degree) & (c1 >= 0) & (c1 + 2 * c2 * c("max_area") >= 0)
        fits.append(F.when(ok, F.struct(fixed0.alias("c0"), c1.alias("c1"), c2.alias("c2"), F.lit(degree).alias("degree"))))
    return m.withColumn("_fit", F.coalesce(*fits)).where(F.col("_fit").isNotNull()).select(*keys, "_fit.*", "max_area")


def predicted_curve(fits: DataFrame, curve: DataFrame, keys: Sequence[str], area: str = "area",
                    elevation: str = "elevation", step: float = 0.25) -> DataFrame:
    """Fitted elevation at areas ``0, step, ...`` below the largest and at every observed area.

    Observed elevations are attached where the area was observed.
    """
    count = F.ceil(F.col("max_area") / step).cast("int")
    grid = fits.select(*keys, F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))).alias("_k"))
    grid = grid.select(*keys, (F.col("_k") * F.lit(float(step))).alias("area"), F.lit(None).cast("double").alias("_z"))
    seen = curve.select(*keys, F.col(area).cast("double").alias("area"), F.col(elevation).cast("double").alias("_z"))
    points = grid.unionByName(seen).groupBy(*keys, "area").agg(F.max("_z").alias("elevation_observed"))
    joined = points.join(fits.select(*keys, "c0", "c1", "c2"), list(keys))
    return joined.select(*keys, "area",
                         (F.col("c0") + F.col("c1") * F.col("area") + F.col("c2") * F.col("area") * F.col("area")).alias("elevation"),
                         "elevation_observed")


def curve_storage(curve: DataFrame, keys: Sequence[str], area: str = "area", elevation: str = "elevation") -> DataFrame:
    """Cumulative storage: height above the lowest level integrated over area in m2."""
    bottom = F.min(elevation).over(Window.partitionBy(*keys))
    staged = curve.withColumn("_h", F.col(elevation) - bottom).withColumn("_m2", F.col(area) * 1e6)
    out = running_trapezoid(staged, keys, "_m2", F.col("_h"), "storage")
    return out.withColumn("storage_mcm", F.col("storage") * 1e-6).drop("_h", "_m2")
