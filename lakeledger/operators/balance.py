"""Mass balance of a reservoir: storage change, evaporation, outflow, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.functions.columns import (SECONDS_PER_DAY, bcm_to_m3, cms_to_m3_per_day, m3_to_bcm,
                                          mm_over_km2_to_m3, penman)
from lakeledger.operators.curves import curve_lookup
from lakeledger.operators.series import interval_sums, ordered, to_daily, extend_forward


def storage_change(areas: DataFrame, curve: DataFrame, keys: Sequence[str], curve_keys: Sequence[str] | None = None,
                   area: str = "area", date: str = "date") -> DataFrame:
    """Water level from the curve and the storage change since the row before, in BCM.

    ``areas`` holds one row per key and date, in km2.
    """
    leveled = curve_lookup(areas, curve, curve_keys or keys, area, "area", "elevation", "level")
    w = ordered(keys, date)
    rise = F.col("level") - F.lag("level").over(w)
    mean_m2 = (F.col(area) + F.lag(area).over(w)) * 1e6 / 2
    return leveled.withColumn("ds", m3_to_bcm(rise * mean_m2))


def evaporation(cells: DataFrame, areas: DataFrame, keys: Sequence[str], date: str = "date",
                constant_area: Column | None = None, until: Column | None = None) -> DataFrame:
    """Daily evaporation in mm from cell weather averaged over each reservoir.

    ``cells`` has net_radiation, air_temp, wind, vapor_pressure and pressure per key, date and
    cell. The area is the daily interpolated series, or a constant. The first day of a key is
    dropped, and so are days that lack any input.
    """
    names = ["net_radiation", "air_temp", "wind", "vapor_pressure", "pressure"]
    daily = cells.groupBy(*keys, date).agg(*[F.avg(n).alias(n) for n in names])
    w = ordered(keys, date)
    daily = daily.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") > 1).drop("_rn")
    if constant_area is None:
        filled = to_daily(areas, keys, ["area"], date)
        if until is not None:
            filled = extend_forward(filled, keys, ["area"], until, date)
        daily = daily.join(filled.select(*keys, date, "area"), [*keys, date], "left")
    else:
        daily = daily.withColumn("area", constant_area)
    complete = daily.dropna(subset=[*names, "area"])
    return complete.withColumn("evaporation", penman(*[F.col(n) for n in names], F.col("area")))


def outflow(changes: DataFrame, inflow: DataFrame, evap: DataFrame | None, keys: Sequence[str],
            date: str = "date", subtract_evaporation: bool = False, both_closed: bool = False) -> DataFrame:
    """Outflow between consecutive storage observations from the water balance.

    ``changes`` has ds (BCM) and area (km2) per key and date, ``inflow`` streamflow (m3/s) and
    ``evap`` evaporation (mm). Volumes are sums over ``(date before, date]``; ``both_closed``
    counts the starting day of the inflow as well. The rate is in m3/s.
    """
    vol = inflow.select(*keys, date, cms_to_m3_per_day(F.col("streamflow")).alias("_in"))
    out = interval_sums(changes, vol, keys, "_in", "inflow_vol", date, both_closed)
    if evap is not None:
        out = interval_sums(out, evap.select(*keys, date, "evaporation"), keys, "evaporation", "_mm", date)
        out = out.withColumn("evap_vol", mm_over_km2_to_m3(F.col("_mm"), F.col("nominal_area"))).drop("_mm")
    volume = F.col("inflow_vol") - bcm_to_m3(F.col("ds"))
    if subtract_evaporation:
        volume = volume - F.col("evap_vol")
    gap = F.datediff(F.col(date), F.lag(date).over(ordered(keys, date)))
    return (out.withColumn("outflow_vol", volume).withColumn("days_passed", gap)
            .withColumn("outflow_rate", F.col("outflow_vol") / (F.col("days_passed") * SECONDS_PER_DAY))
            .where(F.col("days_passed").isNotNull()))


def completeness(reservoirs: DataFrame, keys: Sequence[str], **inputs: DataFrame) -> DataFrame:
    """Which inputs each reservoir lacks, and which results can therefore be made."""
    out = reservoirs.select(*keys).distinct()
    for name, df in inputs.items():
        have = df.select(*keys).distinct().withColumn(f"has_{name}", F.lit(True))
        out = out.join(have, list(keys), "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
    lacking = F.array_compact(F.array(*[F.when(~F.col(f"has_{n}"), F.lit(n)) for n in inputs]))
    return out.withColumn("missing", F.concat_ws(",", lacking)).withColumn("complete", F.size(lacking) == 0)


def status_counts(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
