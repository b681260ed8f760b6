"""Optical and radar surface area: cleaning, merging, and trend-based correction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import let, null_if
from lakeledger.operators.scale import pick_rows
from lakeledger.operators.series import (HERE, START, days_passed, extrapolate_step, fill_by_position, fill_by_time,
                                         lookback_first, ordered, regular_grid, savgol_smooth, trend_fill, weighted_smooth,
                                         with_z_score)

# Fixed values.
REVISIT_DAYS = {"s2": 5, "l8": 16, "l9": 16}
SAR_REVISIT_DAYS = 12
PRIORITY = {"l8": 1, "l9": 2, "s2": 3}
CLOUD_LIMIT = 90.0
TREND_LIMIT = 10.0
MIN_DATE = "2019-01-01"
MEASURES = ["water_area", "non_water_area", "cloud_area", "corrected_area", "cloud_percent", "quality"]


def by_sensor(values: dict[str, int], sat: str = "sat") -> Column:
    out = F.lit(None).cast("int")
    for name, v in values.items():
        out = F.when(F.col(sat) == name, F.lit(v)).otherwise(out)
    return out


def screen_clouds(obs: DataFrame, limit: float = CLOUD_LIMIT) -> DataFrame:
    """Cloud percent, sentinel removal, and the quality flag (0 good, 1 cloudy)."""
    clean = obs.select(*[null_if(F.col(c), -1).alias(c) if c in MEASURES else F.col(c) for c in obs.columns])
    total = F.col("water_area") + F.col("non_water_area") + F.col("cloud_area")
    clean = clean.withColumn("cloud_percent", F.try_divide(F.col("cloud_area") * 100, total))
    cloudy = F.coalesce(F.col("cloud_percent") >= limit, F.lit(False))
    for c in ("water_area", "non_water_area", "corrected_area"):
        clean = clean.withColumn(c, F.when(~cloudy, F.col(c)))
    return clean.withColumn("quality", F.when(cloudy, 1).otherwise(0))


def clean_optical(obs: DataFrame, keys: Sequence[str], limit: float = CLOUD_LIMIT) -> DataFrame:
    """Screen, put on each sensor's revisit grid, mark missing rows and fill the corrected area.

    ``obs`` holds one row per key, sensor and date. All sensors go through in one pass.
    """
    part = [*keys, "sat"]
    most = F.max("cloud_area").over(Window.partitionBy(*part))
    screened = screen_clouds(obs, limit).withColumn("_step", by_sensor(REVISIT_DAYS)).withColumn("_most", most)
    grid = regular_grid(screened, part, "_step", MEASURES)
    grid = (grid.withColumn("quality", F.coalesce("quality", F.lit(2)))
            .withColumn("cloud_area", F.coalesce("cloud_area", "_most"))
            .withColumn("cloud_percent", F.coalesce("cloud_percent", F.lit(100.0)))
            .withColumn("non_water_area", F.coalesce("non_water_area", F.lit(0.0)))
            .withColumn("water_area", F.coalesce("water_area", F.lit(0.0))))
    return fill_by_position(grid.drop("_step", "_most", "observed"), part, ["corrected_area"])


def merge_sensors(cleaned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and date; the sensor with the highest priority wins."""
    ranked = cleaned.withColumn("_priority", by_sensor(PRIORITY))
    return pick_rows(ranked, [*keys, "date"], "_priority").drop("_priority").withColumnRenamed("corrected_area", "area")


def jump_screen(sar: DataFrame, keys: Sequence[str], percent: float = 15.0, days: int = 14) -> DataFrame:
    """Drop radar areas that changed by more than a share of the nominal area in two weeks; refill by time."""
    back = lookback_first(sar, keys, "sarea", "_then", days)
    jump = F.abs(F.col("sarea") - F.col("_then")) > F.col("nominal_area") * (percent / 100.0)
    kept = back.withColumn("sarea", F.when(~F.coalesce(jump, F.lit(False)), F.col("sarea"))).drop("_then")
    return fill_by_time(kept, keys, ["sarea"])


def spike_screen(sar: DataFrame, keys: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Drop radar areas beyond ``limit`` population z-scores; refill by position."""
    scored = with_z_score(sar, keys, "sarea", "_z")
    kept = scored.withColumn("sarea", F.when(~F.coalesce(F.abs("_z") > limit, F.lit(False)), F.col("sarea"))).drop("_z")
    return fill_by_position(kept, keys, ["sarea"])


def clean_sar(sar: DataFrame, reservoirs: DataFrame, keys: Sequence[str], min_date: str = MIN_DATE,
              min_points: int = 3) -> DataFrame:
    """Radar series after both screens, extended by one revisit; keys with too few points are left out."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    enough = sar.withColumn("_n", n).where(F.col("_n") >= min_points).drop("_n")
    joined = enough.join(reservoirs.select(*keys, "nominal_area"), list(keys))
    screened = spike_screen(jump_screen(joined, keys), keys).where(F.col("date") >= F.lit(min_date).cast("date"))
    longer = extrapolate_step(screened.select(*keys, "date", "sarea"), keys, "sarea", SAR_REVISIT_DAYS)
    return longer.withColumnRenamed("sarea", "area")


def area_threshold(area: Column, legacy: bool = False) -> Column:
    """Allowed deviation in km2: 25, 10 or 5 percent of the nominal area by size.

    ``legacy`` leaves out the tier of the smallest reservoirs.
    """
    share = F.when(area < 100, 0.10).otherwise(0.05)
    if not legacy:
        share = F.when(area < 10, 0.25).otherwise(share)
    return area * share


def _first_at(x: Column, low: Column, high: Column, past: Callable[[Column], Column]) -> Column:
    """The first index from ``low`` on, and below ``high``, whose element is ``past`` a limit; ``high`` if none is. Elements ascend."""
    def halve(s, _):
        middle = F.floor((s["a"] + s["b"]) / 2).cast("int")
        over = past(F.get(x, middle))
        return F.when(s["a"] >= s["b"], s).when(over, F.struct(s["a"].alias("a"), middle.alias("b"))).otherwise(F.struct((middle + 1).alias("a"), s["b"].alias("b")))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(high - low + 1)).cast("int") + 1)
    return F.aggregate(steps, F.struct(low.alias("a"), high.alias("b")), halve)["a"]


def clipped_medians(df: DataFrame, keys: Sequence[str], value: str, low: float = 2.0, high: float = 2.0) -> DataFrame:
    """``keys, n, kept, lowest, highest, median`` of the values that iterated clipping leaves of each key.

    Values outside mean - low*std .. mean + high*std of those that are left go (population standard deviation), until none
    does. They are ordered once; as what is left is always a range of that order, a round needs the sums of a range, which are
    differences of running sums, and two binary searches for its new ends. Running sums are of deviations from the median and run outwards
    from it, so that far values do not blur them; where the spread is small beside the distance from the median, the
    range is summed anew. Rows with a NULL value do not count; a key without a value has no row.
    """
    keys = list(keys)
    whole, up, down = (Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_v"), Window.partitionBy(*keys).orderBy(F.col("_i").desc()))
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    rows = rows.withColumn("_i", F.row_number().over(up) - 1).withColumn("_n", F.count(F.lit(1)).over(whole).cast("int"))
    middle = F.floor(F.col("_n") / 2)
    rows = rows.withColumn("_centre", F.max(F.when(F.col("_i") == middle, F.col("_v"))).over(whole)).withColumn("_x", F.col("_v") - F.col("_centre"))
    above = F.col("_i") >= middle
    by = Window.partitionBy(*keys).orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"_g": F.col("_x"), "_h": F.col("_x") * F.col("_x")}
    for name, part in sums.items():
        over, under = F.when(above, part).otherwise(F.lit(0.0)), F.when(above, F.lit(0.0)).otherwise(part)
        rows = rows.withColumn(name, F.when(above, F.coalesce(F.sum(over).over(by), F.lit(0.0))).otherwise(-F.sum(under).over(down.rowsBetween(Window.unboundedPreceding, 0))))
    last = F.max(F.struct("_i", (F.col("_g") + F.col("_x")).alias("_g"), (F.col("_h") + F.col("_x") * F.col("_x")).alias("_h")))
    held = rows.groupBy(*keys).agg(F.max("_n").alias("_n"), F.max("_centre").alias("_centre"), F.sort_array(F.collect_list(F.struct("_i", "_v", "_g", "_h"))).alias("_rows"), last.alias("_end"))
    field = lambda c: F.transform("_rows", lambda r: r[c])
    held = held.select(*keys, "_n", "_centre", field("_v").alias("_v"), *[F.concat(field(c), F.array(F.col("_end")[c])).alias(c) for c in sums])
    v = F.col("_v")

    def once(s, _):
        size = s["b"] - s["a"]
        total = lambda c: (F.get(F.col(c), s["b"]) - F.get(F.col(c), s["a"])) / size

        def spread(r):
            left = F.slice(v, s["a"] + 1, size)
            anew = let(F.aggregate(left, F.lit(0.0), lambda t, e: t + e) / size, lambda m: F.struct(
                m.alias("m"), F.sqrt(F.aggregate(left, F.lit(0.0), lambda t, e: t + (e - m) * (e - m)) / size).alias("d")))
            near = r["q"] - r["m"] * r["m"] > r["q"] * 1e-6
            return F.when(near, F.struct((r["m"] + F.col("_centre")).alias("m"), F.sqrt(r["q"] - r["m"] * r["m"]).alias("d"))).otherwise(anew)

        def ends(r):
            return F.struct(_first_at(v, s["a"], s["b"], lambda e: e >= r["m"] - F.lit(low) * r["d"]).alias("a"),
                            _first_at(v, s["a"], s["b"], lambda e: e > r["m"] + F.lit(high) * r["d"]).alias("b"))

        def checked(r):
            return F.struct(r["a"].alias("a"), r["b"].alias("b"), (((r["a"] == s["a"]) & (r["b"] == s["b"])) | (r["b"] - r["a"] < 2)).alias("stable"))
        sums_ = F.struct(total("_g").alias("m"), total("_h").alias("q"))
        return F.when(s["stable"], s).otherwise(let(let(let(sums_, spread), ends), checked))

    start = F.struct(F.lit(0).alias("a"), F.col("_n").alias("b"), (F.col("_n") < 2).alias("stable"))
    out = held.withColumn("_s", F.aggregate(F.sequence(F.lit(1), F.col("_n")), start, once))
    at = lambda i: F.get(v, i)
    a, b = F.col("_s.a"), F.col("_s.b")
    return out.select(*keys, F.col("_n").alias("n"), (b - a).alias("kept"), at(a).alias("lowest"), at(b - 1).alias("highest"),
                      ((at(F.floor((a + b - 1) / 2).cast("int")) + at(F.floor((a + b) / 2).cast("int"))) / 2).alias("median"))


def _stream(optical: DataFrame, sar: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Optical and radar rows of a key in one date-ordered stream, with the radar value at each date.

    Radar rows are kept (``_radar``). ``s`` is linear between radar dates and NULL outside them.
    Everything after this works on the same partitioning, so the pair is shuffled once.
    """
    o = optical.withColumn("_radar", F.lit(False)).withColumn("_v", F.lit(None).cast("double"))
    r = sar.select(*keys, "date", F.col("area").cast("double").alias("_v"), F.lit(True).alias("_radar"))
    both = o.unionByName(r, allowMissingColumns=True)
    point = F.when(F.col("_radar"), F.struct(F.unix_date("date").alias("x"), F.col("_v").alias("v")))
    up = ordered(keys, F.col("date"), F.col("_radar").desc()).rowsBetween(START, HERE)
    down = ordered(keys, F.col("date").desc(), F.col("_radar").desc()).rowsBetween(START, HERE)
    both = both.withColumn("_p", F.last(point, ignorenulls=True).over(up))
    both = both.withColumn("_n", F.last(point, ignorenulls=True).over(down))
    p, n, x = F.col("_p"), F.col("_n"), F.unix_date("date")
    s = (F.when(p.isNull() | n.isNull(), F.lit(None).cast("double")).when(p["x"] == n["x"], p["v"])
         .otherwise(p["v"] + (n["v"] - p["v"]) * (x - p["x"]) / (n["x"] - p["x"])))
    return both.withColumn("s", s).withColumn("deviation", F.when(~F.col("_radar"), F.col("area") - F.col("s")))


def _with_bias(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the clipped median deviation of each key: only the deviations are gathered, and both sides keep the key's partitioning."""
    bias = clipped_medians(stream.where(F.col("deviation").isNotNull()), keys, "deviation").select(*keys, F.col("median").alias("bias"))
    return stream.join(bias, list(keys), "left")


def sar_bias(optical: DataFrame, sar: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Optical rows with their deviation from radar and the key's median deviation after clipping."""
    marked = _with_bias(_stream(optical, sar, keys), keys).where(~F.col("_radar"))
    return marked.select(*optical.columns, F.col("s").alias("sar_area"), "deviation", "bias")


def _far(threshold: Column) -> Column:
    return F.coalesce(F.abs(F.col("deviation") - F.col("bias")) > threshold, F.lit(False))


def deviation_filter(optical: DataFrame, sar: DataFrame, keys: Sequence[str], threshold: Column) -> DataFrame:
    """``filtered_area`` is NULL where the bias-corrected deviation from radar is beyond ``threshold``."""
    return sar_bias(optical, sar, keys).withColumn("filtered_area", F.when(~_far(threshold), F.col("area")))


def _correct(optical: DataFrame, sar: DataFrame, keys: list[str], threshold: Column, trend_limit: float, legacy: bool) -> DataFrame:
    """All optical rows; those before the first usable one have ``_keep`` false, ``_s0`` is the first radar date."""
    base = _with_bias(_stream(optical, sar, keys), keys)
    usable = ~F.col("_radar") & F.col("area").isNotNull() & ~_far(threshold)
    base = base.withColumn("filtered_area", F.when(usable, F.col("area")))
    whole = Window.partitionBy(*keys)
    base = base.select(
        "*", F.min(F.when(F.col("filtered_area").isNotNull(), F.col("date"))).over(whole).alias("_f"),
        F.min(F.when(~F.col("_radar"), F.col("date"))).over(whole).alias("_o"),
        F.min(F.when(F.col("_radar"), F.col("date"))).over(whole).alias("_s0"))
    base = base.withColumn("_from", F.greatest("_f", "_s0"))
    start = F.when(F.col("_radar") & (F.col("date") >= F.col("_from")), F.struct(F.col("date").alias("d"), F.col("_v").alias("v")))
    base = base.withColumn("_first", F.min(start).over(whole)).where(~F.col("_radar"))
    # Radar counts from its first date inside the common period; its end values hold outside.
    early = F.coalesce(F.col("date") < F.col("_first.d"), F.lit(True))
    late = F.col("_first").isNull() | F.col("_n").isNull()
    held = F.when(early, F.col("_first.v")).otherwise(F.coalesce(F.col("s"), F.col("_p.v")))
    base = base.withColumn("s_early", early).withColumn("s_late", late).withColumn("_held", held)

    # Rows that take part in the trend comparison form their own sequence inside a key.
    base = base.withColumn("_known", F.col("filtered_area").isNotNull())
    among = ordered([*keys, "_known"], "date")
    gap = F.datediff(F.col("date"), F.lag("date").over(among))
    base = base.withColumn("trend", F.when(F.col("_known"), (F.col("filtered_area") - F.lag("filtered_area").over(among)) / gap))
    base = base.withColumn("_in", F.col("_known") & F.coalesce(F.col("date") >= F.col("_from"), F.lit(False)))

    def radar_trend(w):
        overlap = ~F.col("s_early") & ~F.lag("s_late").over(w)
        return F.when(overlap, (F.col("_held") - F.lag("_held").over(w)) / F.datediff(F.col("date"), F.lag("date").over(w)))

    part = [*keys, "_in"]
    inner = ordered(part, "date")
    base = base.withColumn("_rt", F.when(F.col("_in"), radar_trend(inner)))
    base = base.withColumn("_gap", F.datediff(F.col("date"), F.lag("date").over(inner)))
    bad = F.coalesce(F.abs(F.col("trend") - F.col("_rt")) > trend_limit, F.lit(False))
    base = base.withColumn("erroneous", F.col("_in") & bad)
    base = base.withColumn("corrected_trend", F.when(F.col("_in"), F.when(bad, F.col("_rt")).otherwise(F.col("trend"))))
    own = F.col("filtered_area")
    if legacy:
        own = F.when(F.row_number().over(inner) == 1, F.coalesce(F.lead("filtered_area").over(inner), own)).otherwise(own)
        base = base.withColumn("_gap", F.lit(1))
    base = base.withColumn("_own", F.when(F.col("_in") & ~F.col("erroneous"), own))
    base = trend_fill(base, part, "_own", "_rt", "_gap", "_cor")
    base = base.withColumn("corrected_area", F.when(F.col("_in"), F.col("_cor")))

    base = base.withColumn("sar_trend", radar_trend(ordered(keys, "date"))).withColumn("days_passed", days_passed(keys, first=None))
    begin = F.min(F.when(F.col("corrected_area").isNotNull(), F.col("date"))).over(whole)
    base = base.withColumn("_begin", begin)
    begin = F.greatest(F.col("_begin"), F.col("_first.d"), F.col("_o"))
    base = base.withColumn("_keep", F.coalesce(F.col("date") >= begin, F.lit(False)))
    return trend_fill(base, [*keys, "_keep"], "corrected_area", "sar_trend", "days_passed", "filled_area")


def trend_correction(optical: DataFrame, sar: DataFrame, keys: Sequence[str], threshold: Column,
                     trend_limit: float = TREND_LIMIT, legacy: bool = False) -> DataFrame:
    """Correct optical areas with radar trends and fill the gaps; only keys with radar remain.

    Steps: drop deviating rows; where the optical trend departs from the radar trend by more than
    ``trend_limit``, continue from the row before with the radar trend; fill the remaining gaps
    with the radar trend between consecutive optical dates. ``legacy`` starts from the second
    row's value and adds a trend once instead of once per day.
    """
    out = _correct(optical, sar, list(keys), threshold, trend_limit, legacy)
    return out.where(F.col("_keep") & F.col("_s0").isNotNull()).select(
        *optical.columns, "filtered_area", "erroneous", "corrected_area", "corrected_trend", "trend",
        "sar_trend", "days_passed", "filled_area")


def sign_correction(df: DataFrame, keys: Sequence[str], value: str = "corrected_area", out: str = "sign_area") -> DataFrame:
    """Where optical and radar trends point in opposite directions, continue with the radar trend."""
    opposite = F.coalesce(F.col("trend") * F.col("sar_trend") < 0, F.lit(False))
    staged = df.withColumn("_own", F.when(~opposite, F.col(value)))
    return trend_fill(staged, keys, "_own", "sar_trend", "days_passed", out).drop("_own")


def fuse(optical_obs: DataFrame, sar_obs: DataFrame, reservoirs: DataFrame, keys: Sequence[str],
         limit: float = CLOUD_LIMIT, min_date: str = MIN_DATE, lead_days: int = 15, legacy: bool = False) -> DataFrame:
    """Fused daily-overpass area for every reservoir, with the method used.

    ``Optical`` without radar, ``Combine`` when the optical series begins more than ``lead_days``
    before radar, else ``Trend``.
    """
    keys = list(keys)
    optical = merge_sensors(clean_optical(optical_obs, keys, limit), keys)
    optical = optical.join(reservoirs.select(*keys, "nominal_area"), keys)
    sar = clean_sar(sar_obs, reservoirs, keys, min_date)
    base = _correct(optical, sar, keys, area_threshold(F.col("nominal_area"), legacy), TREND_LIMIT, legacy)
    method = (F.when(F.col("_s0").isNull(), "Optical")
              .when(F.datediff(F.col("_s0"), F.col("_o")) > lead_days, "Combine").otherwise("Trend"))
    base = base.withColumn("method", method)
    # Rows without radar are smoothed among themselves, the others keep the corrected area.
    alone = (F.col("method") == "Optical") | ((F.col("method") == "Combine") & (F.col("date") <= F.col("_s0")))
    base = base.withColumn("_alone", alone).where(F.col("_alone") | F.col("_keep"))
    part = [*keys, "_alone"]
    enough = F.count(F.lit(1)).over(Window.partitionBy(*part)) > 7
    weighted = F.when(enough, weighted_smooth(part, "area", F.lit(101) - F.col("cloud_percent")))
    base = base.withColumn("filled_area", F.when(F.col("_alone"), weighted).otherwise(F.col("filled_area")))
    base = base.withColumn("days_passed", F.when(F.col("_alone"), F.coalesce("days_passed", F.lit(0))).otherwise(F.col("days_passed")))
    least = F.when(F.col("method") == "Optical", 7).otherwise(9)
    many = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > least
    smooth = F.when((F.col("method") != "Trend") & many, savgol_smooth(keys, "filled_area")).otherwise(F.col("filled_area"))
    return base.withColumn("filled_area", smooth).select(
        *keys, "date", "sat", "area", "cloud_percent", "quality", "days_passed", "filled_area", "method")
