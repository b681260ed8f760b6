"""Outlier, bias and trend screens of optical area against radar, with adjustable strength."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.operators.fusion import by_sensor
from lakeledger.operators.scale import pick_rows
from lakeledger.operators.series import days_passed, fill_by_position, ordered, percent_change, value_at

# A strength of 0 switches a screen off; 1..9 maps to a span from loose to strict.
OFF = 9999.0
SPANS = {"outlier": (3.5, 0.5), "bias": (15.0, 5.0), "trend": (2.9, 0.1)}
ORDER = {"l8": 1, "s2": 2, "l9": 3}


def limit(kind: str, strength: float) -> float:
    """Standard deviations (outlier, trend) or percent of nominal area (bias) for a strength 0..9."""
    if not 0 <= strength <= 9:
        raise ValueError("strength must lie between 0 and 9")
    span, base = SPANS[kind]
    return OFF if strength == 0 else span / 8 * (9 - strength) + base


def align(optical: DataFrame, sar: DataFrame, keys: Sequence[str], legacy: bool = False) -> DataFrame:
    """One optical row per date (missing area is zero) with the radar area of that date.

    Radar is interpolated in time; ``legacy`` keeps shared dates only and interpolates by row.
    """
    keys = list(keys)
    opt = optical.select(*keys, "date", "sat", F.coalesce(F.col("area"), F.lit(0.0)).alias("optical"))
    opt = pick_rows(opt.withColumn("_o", by_sensor(ORDER)), [*keys, "date"], "_o", ["optical"], keep="first").drop("_o")
    s = sar.select(*keys, "date", F.col("sarea").alias("sar"))
    if not legacy:
        return value_at(opt, s, keys, "sar", "sar")
    return fill_by_position(opt.join(s, [*keys, "date"], "left"), keys, ["sar"])


def month(keys: Sequence[str]):
    return Window.partitionBy(*keys, F.date_format("date", "yyyyMM"))


def outlier_screen(df: DataFrame, keys: Sequence[str], sigmas: float) -> DataFrame:
    """Values outside the monthly mean +- ``sigmas`` standard deviations take the raw value before."""
    w = month(keys)
    mean, std = F.avg("optical").over(w), F.stddev_samp("optical").over(w)
    before = F.lag("optical").over(ordered(keys, "date"))
    far = F.abs(F.col("optical") - mean) > std * sigmas
    return df.withColumn("optical", F.when(F.coalesce(far, F.lit(False)), before).otherwise(F.col("optical")))


def bias_screen(df: DataFrame, percent: float, nominal: str = "nominal_area", legacy: bool = False) -> DataFrame:
    """Deviations from radar beyond a share of the nominal area are cut back to that share."""
    dev = F.col("optical") - F.col("sar")
    edge = F.col(nominal) * (percent / 100.0)
    side = F.lit(1.0) if legacy else F.signum(dev)
    return df.withColumn("optical", F.when(F.coalesce(F.abs(dev) > edge, F.lit(False)), F.col("sar") + side * edge)
                         .otherwise(F.col("optical")))


RUN = 64  # values of the fold that are copied together


def trend_screen(df: DataFrame, keys: Sequence[str], sigmas: float) -> DataFrame:
    """Replace values whose recent change departs from radar's by the mean of the two corrected values
    before, moved along with radar.

    Each value depends on the corrected ones before it, so the sorted series of a key (one element
    per date) is folded once.
    """
    keys = list(keys)
    staged = percent_change(percent_change(df, keys, "sar", "sar_trend"), keys, "optical", "_ot")
    staged = staged.withColumn("_std", F.stddev_samp(F.abs(F.col("_ot") - F.col("sar_trend"))).over(month(keys)))
    extra = [c for c in df.columns if c not in keys and c not in ("date", "optical")]
    cell = F.struct("date", "optical", "sar_trend", "_std", *extra)
    rows = staged.groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("_rows"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(None).cast("double").alias("c1"), F.lit(None).cast("double").alias("c2"),
                    F.lit(None).cast("double").alias("t1"), F.lit(None).cast("double").alias("t2"),
                    F.array().cast("array<double>").alias("run"), F.array().cast("array<array<double>>").alias("runs"))

    def step(a, r):
        recent = (F.try_divide(r["optical"], a["c1"]) - 1 + F.try_divide(a["c1"], a["c2"]) - 1) / 2
        moved = (a["c1"] + a["c2"]) / 2 * (F.lit(1.0) + (a["t1"] + a["t2"]) / 2)
        departs = (a["i"] >= 3) & (F.abs(recent - r["sar_trend"]) > r["_std"] * sigmas)
        value = F.when(F.coalesce(departs, F.lit(False)), F.coalesce(moved, r["optical"])).otherwise(r["optical"])
        # Values gather in short runs, so that a step copies one run and not the whole series.
        full = F.size(a["run"]) >= RUN
        new = lambda v: F.struct((a["i"] + 1).alias("i"), v.alias("c1"), a["c1"].alias("c2"), r["sar_trend"].alias("t1"), a["t1"].alias("t2"),
                                 F.when(full, F.array(v)).otherwise(F.concat(a["run"], F.array(v))).alias("run"),
                                 F.when(full, F.concat(a["runs"], F.array(a["run"]))).otherwise(a["runs"]).alias("runs"))
        return F.element_at(F.transform(F.array(value), new), 1)

    folded = rows.withColumn("_out", F.aggregate("_rows", zero, step, lambda a: F.concat(F.flatten(a["runs"]), a["run"])))
    zipped = F.zip_with("_rows", "_out", lambda r, v: F.struct(
        r["date"].alias("date"), v.alias("optical"), *[r[c].alias(c) for c in extra]))
    return folded.select(*keys, F.inline(zipped))


def screen(optical: DataFrame, sar: DataFrame, reservoirs: DataFrame, keys: Sequence[str], outlier: float = 0,
           bias: float = 0, trend: float = 0, legacy: bool = False) -> DataFrame:
    """All three screens in order; the result column is ``area``."""
    keys = list(keys)
    aligned = align(optical, sar, keys, legacy).join(reservoirs.select(*keys, "nominal_area"), keys)
    one = outlier_screen(aligned, keys, limit("outlier", outlier))
    two = bias_screen(one, limit("bias", bias), legacy=legacy)
    three = trend_screen(two, keys, limit("trend", trend))
    return three.select(*keys, "date", F.col("optical").alias("area"))


def write_back(fused: DataFrame, screened: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put screened areas into the fused series; the areas before are kept in ``area_fused``."""
    keys = list(keys)
    kept = fused if "area_fused" in fused.columns else fused.withColumn("area_fused", F.col("area"))
    joined = kept.drop("area").join(screened.select(*keys, "date", "area"), [*keys, "date"], "left")
    return joined.withColumn("days_passed", days_passed(keys))


def reset(fused: DataFrame) -> DataFrame:
    """Undo the screens: the area becomes the fused one again."""
    return fused.withColumn("area", F.col("area_fused")) if "area_fused" in fused.columns else fused
