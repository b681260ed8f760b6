"""Water level from radar-altimeter returns.

A pass over a large lake and the years of one track may hold most of the returns, so order
statistics and running sums over returns use the bucketed forms of ``scale``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import (date_from_decimal_year, decimal_year_from_mjd, mjd_from_seconds)
from lakeledger.operators.scale import exact_quantiles, running_sums, select_ranks
from lakeledger.session import cut_lineage

# Fixed values.
ELLIPSOID_OFFSET = 0.7
RANGE_LIMIT = 5.0
STD_LIMIT = 0.3
PART = 4096  # distinct heights of a cycle that one bucket holds
DIGITS = 9  # differences below a nanometre are rounding noise of the summation order


def heights(high_rate: DataFrame, low_rate: DataFrame, keys: Sequence[str], index: str,
            fills: dict[str, float], offset: float = ELLIPSOID_OFFSET, drop_flagged: bool = False) -> DataFrame:
    """Surface height per high-rate return, with its corrections looked up from the low-rate record.

    high_rate: alt, range, dry, wet, seconds, lat, lon, quality; low_rate: iono, solid_tide,
    pole_tide, state. ``fills`` names the fill value of each correction; a value equal to its fill
    raises a flag, and so do a state or quality other than zero. The older series uses offset 0
    and drops flagged rows.
    """
    joined = high_rate.join(low_rate, [*keys, index])
    media = F.col("dry") + F.col("wet") + F.col("iono") + F.col("solid_tide") + F.col("pole_tide")
    flag = lambda c: F.coalesce(c, F.lit(True)).cast("int")
    filled = [flag(F.col(c) == F.lit(v)).alias(f"{c}_flag") for c, v in fills.items()]
    others = [flag(F.col("state") != 0).alias("state_flag"), flag(F.col("quality") != 0).alias("quality_flag")]
    names = [f"{c}_flag" for c in fills] + ["state_flag", "quality_flag"]
    out = joined.select("*", *filled, *others).withColumn("flags", sum((F.col(n) for n in names), F.lit(0)))
    out = out.withColumn("mjd", mjd_from_seconds(F.col("seconds"))).withColumn(
        "height", F.col("alt") - (media + F.col("range")) + F.lit(offset))
    return out.where(F.col("flags") == 0) if drop_flagged else out


def iqr_filter(df: DataFrame, keys: Sequence[str], value: str = "height", short: bool = False) -> DataFrame:
    """Values inside the quartiles widened by one and a half midpoint interquartile ranges.

    ``short`` groups (one row per cycle, say) are ranked in one window; others use exact quantiles
    that never order a whole group.
    """
    keys = list(keys)
    limits = lambda lin1, mid1, lin3, mid3: (lin1 - (mid3 - mid1) * 1.5, lin3 + (mid3 - mid1) * 1.5)
    if short:
        whole = Window.partitionBy(*keys)
        ranked = df.where(F.col(value).isNotNull()).withColumn("_i", F.row_number().over(whole.orderBy(value)) - 1).withColumn(
            "_n", F.count(F.lit(1)).over(whole))
        at = lambda rank: F.max(F.when(F.col("_i") == rank, F.col(value))).over(whole)
        ends = []
        for p in (0.25, 0.75):
            pos = (F.col("_n") - 1) * p
            lo, hi = at(F.floor(pos)), at(F.ceil(pos))
            ends += [lo + (hi - lo) * (pos - F.floor(pos)), (lo + hi) / 2]
        ranked = ranked.select("*", *[c.alias(f"_q{i}") for i, c in enumerate(ends)])
        low, high = limits(*[F.col(f"_q{i}") for i in range(4)])
        return ranked.where((F.col(value) > low) & (F.col(value) < high)).select(*df.columns)
    q = exact_quantiles(df, keys, value, {"q1": 0.25, "q3": 0.75})
    low, high = limits(F.col("q1_lin"), F.col("q1_mid"), F.col("q3_lin"), F.col("q3_mid"))
    bounds = q.select(*keys, low.alias("_low"), high.alias("_high"))
    return df.join(bounds, keys).where((F.col(value) > F.col("_low")) & (F.col(value) < F.col("_high"))).drop("_low", "_high")


def _dealt(df: DataFrame, cycle: Sequence[str], value: str, part: int) -> DataFrame:
    """Adds ``_b``: buckets of about ``part`` rows in the order of ``value``, with exact edges. A cycle of fewer rows is one
    bucket; only the values of larger ones are looked at for edges."""
    sizes = df.groupBy(*cycle).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > part)
    if sizes.isEmpty():
        return df.withColumn("_b", F.lit(0))
    edges = select_ranks(df.join(sizes, list(cycle), "left_semi"), cycle, value, lambda n: F.sequence(F.lit(part).cast("long"), n - 1, F.lit(part).cast("long")))
    cuts = edges.groupBy(*cycle).agg(F.collect_set("value").alias("_cuts"))
    return df.join(cuts, list(cycle), "left").withColumn("_b", F.coalesce(_bucket(F.col(value)), F.lit(0))).drop("_cuts")


def _bucket(value: Column, cuts: str = "_cuts") -> Column:
    """Number of edges below a value; never falls as the value rises."""
    return F.size(F.filter(cuts, lambda c: c < value))


def _split_gain(n1: Column, s1: Column, rest: Column) -> Column:
    """How much a cut into two groups lowers the squared error, sums taken about the common mean."""
    return F.round(s1 * s1 * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), rest)), DIGITS)


def _prefix_std(k: Column, s: Column, q: Column) -> Column:
    mean = s / k
    return F.round(F.sqrt(F.greatest(q / k - mean * mean, F.lit(0.0))), DIGITS)


def clean_cycles(df: DataFrame, cycle: Sequence[str], value: str = "height", range_limit: float = RANGE_LIMIT,
                 std_limit: float = STD_LIMIT, part: int = PART) -> DataFrame:
    """Accepted returns of each cycle.

    Where heights spread more than ``range_limit``, the best split into two groups (least squares)
    is cut and the larger group kept, the lower on a tie. Then returns leave in order of distance
    from the mean of that group until the population standard deviation is within ``std_limit``;
    equal distances leave together. Equal heights are merged, and running sums go bucket by bucket, so that no task
    orders a cycle; only a few numbers per cycle come back to the returns.
    """
    cycle, h = list(cycle), F.col(value)
    levels = cut_lineage(df.where(h.isNotNull()).groupBy(*cycle, value).agg(F.count(F.lit(1)).alias("_c")))
    spread = levels.groupBy(*cycle).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.sum("_c").alias("_n"),
                                        (F.sum(h * F.col("_c")) / F.sum("_c")).alias("_avg"))
    wide = _dealt(levels.join(spread, cycle).where(F.col("_hi") - F.col("_lo") > range_limit), cycle, value, part)
    run = running_sums(wide, cycle, "_b", value, {"_n1": F.col("_c"), "_s1": (h - F.col("_avg")) * F.col("_c")})
    rest = F.col("_n") - F.col("_n1")
    cut = run.where(rest > 0).groupBy(*cycle).agg(F.max_by(
        F.struct(h.alias("h"), (F.col("_n1") * 2 >= F.col("_n")).alias("lower")),
        F.struct(_split_gain(F.col("_n1"), F.col("_s1"), rest), -h)).alias("_cut"))
    # One row per cycle, read by everything below.
    cut = cut_lineage(spread.select(*cycle).join(cut, cycle, "left"))
    side = F.when(F.col("_cut").isNull(), True).otherwise((h <= F.col("_cut.h")) == F.col("_cut.lower"))
    kept = levels.join(cut, cycle).where(side)
    centre = kept.groupBy(*cycle).agg((F.sum(h * F.col("_c")) / F.sum("_c")).alias("_centre"))
    dist = kept.join(centre, cycle).withColumn("_d", h - F.col("_centre")).withColumn("_e", F.round(F.abs("_d"), DIGITS))
    run = running_sums(_dealt(dist, cycle, "_e", part), cycle, "_b", "_e", {"_k": F.col("_c"), "_s": F.col("_d") * F.col("_c"), "_q": F.col("_d") * F.col("_d") * F.col("_c")})
    reach = run.groupBy(*cycle).agg(F.max(F.when(_prefix_std(F.col("_k"), F.col("_s"), F.col("_q")) <= std_limit, F.col("_e"))).alias("_reach"))
    limits = cut.join(centre, cycle).join(reach, cycle)
    near = F.round(F.abs(h - F.col("_centre")), DIGITS) <= F.col("_reach")
    return df.join(limits, cycle).where(side & near).select(*df.columns)


def cycle_levels(df: DataFrame, cycle: Sequence[str], value: str = "height") -> DataFrame:
    """Mean position, time and height of each cycle, its standard deviation and uncertainty."""
    out = df.groupBy(*cycle).agg(
        F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.avg("mjd").alias("mjd"), F.avg(value).alias(value),
        F.stddev_pop(value).alias("std"), F.var_samp(value).alias("_var"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("uncertainty", F.when(F.col("n") > 1, F.sqrt(F.col("_var") / F.col("n")))).drop("_var").withColumn(
        "year_fraction", decimal_year_from_mjd(F.col("mjd")))


def datum_levels(levels: DataFrame, geoid_height: str = "geoid", value: str = "height", offset: float = ELLIPSOID_OFFSET) -> DataFrame:
    """Level above the geoid and its date."""
    return (levels.withColumn("level", F.col(value) - F.col(geoid_height) - offset)
            .withColumn("date", date_from_decimal_year(F.col("year_fraction"))))


def water_levels(returns: DataFrame, station: Sequence[str], cycle: str, min_lat: Column, max_lat: Column) -> DataFrame:
    """Cleaned level of every cycle of every station, before the geoid is taken off."""
    inside = returns.where((F.col("lat") > min_lat) & (F.col("lat") < max_lat))
    cleaned = clean_cycles(iqr_filter(inside, station), [*station, cycle])
    return iqr_filter(cycle_levels(cleaned, [*station, cycle]), station, short=True)
