"""Scalar functions: cleaning, units, rounding, dates, physics, geometry.

All are plain Column expressions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (units and physical constants).
SECONDS_PER_DAY = 86400
M3_PER_BCM = 1e9
M2_PER_KM2 = 1e6
M3_PER_MCM = 1e6
CMS_PER_CFS = 0.028316847
KELVIN_OFFSET = 273.15
PRECIP_SCALE = 0.1
WIND_FACTOR = 0.75
EARTH_RADIUS_M = 6371000.0
MJD_OF_2000 = 51544
JULIAN_YEAR_DAYS = 365.25


# --- cleaning -------------------------------------------------------------------------------

def null_if(c: Column, *sentinels: float) -> Column:
    """Sentinel values and NaN become NULL."""
    out = F.when(~F.isnan(c.cast("double")), c)
    for s in sentinels:
        out = F.when(out != F.lit(s), out)
    return out


def non_negative(c: Column) -> Column:
    """Negative values become zero; NULL stays NULL."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def recode_in_order(c: Column, pairs: Sequence[tuple[int, int]]) -> Column:
    """Replace values pair by pair, each on the result of the one before."""
    for old, new in pairs:
        c = F.when(c == old, F.lit(new)).otherwise(c)
    return c


def ordered_pair(high: Column, low: Column) -> tuple[Column, Column]:
    """Swap the two where the high one is below the low one; a NULL on either side swaps nothing."""
    wrong = high < low
    return F.when(wrong, low).otherwise(high), F.when(wrong, high).otherwise(low)


# --- units ----------------------------------------------------------------------------------

def cms_to_m3_per_day(c: Column) -> Column:
    return c * SECONDS_PER_DAY


def cfs_to_cms(c: Column) -> Column:
    return c * CMS_PER_CFS


def bcm_to_m3(c: Column) -> Column:
    return c * M3_PER_BCM


def m3_to_bcm(c: Column) -> Column:
    return c * 1e-9


def mm_over_km2_to_m3(depth_mm: Column, area_km2: Column) -> Column:
    return depth_mm * 0.001 * area_km2 * M2_PER_KM2


def kelvin_to_celsius(c: Column) -> Column:
    return c - KELVIN_OFFSET


def scaled_precip(c: Column) -> Column:
    return c * PRECIP_SCALE


def wind_speed(u: Column, v: Column) -> Column:
    """Wind at reference height from its two components."""
    return F.lit(WIND_FACTOR) * F.sqrt(u * u + v * v)


def wrap_longitude(lon: Column) -> Column:
    """0..360 degrees to -180..180."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


# --- rounding -------------------------------------------------------------------------------

def round_away(c: Column, decimals: int) -> Column:
    """Round away from zero."""
    scale = float(10**decimals)
    return F.signum(c) * F.ceil(F.abs(c) * scale) / scale


def half_up_count(c: Column) -> Column:
    """Cell count: fractions of one half and more round up."""
    return F.floor(c + 0.5)


def truncated_key(c: Column, decimals: int = 2) -> Column:
    """Coordinate truncated towards zero, for use as a file key."""
    scale = float(10**decimals)
    return F.signum(c) * F.floor(F.abs(c) * scale) / scale


# --- dates ----------------------------------------------------------------------------------

def day_number(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def days_between(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def is_leap_year(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def mjd_from_seconds(seconds_since_2000: Column) -> Column:
    return seconds_since_2000 / SECONDS_PER_DAY + MJD_OF_2000


def decimal_year_from_mjd(mjd: Column) -> Column:
    return (mjd + 2108 - 50000) / JULIAN_YEAR_DAYS + 1990


def date_from_decimal_year(value: Column) -> Column:
    """Fractional year to a date, with 366 days in leap years."""
    year = F.floor(value).cast("int")
    length = F.lit(365) + is_leap_year(year).cast("int")
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), F.floor((value - year) * length).cast("int"))


def month_fraction(d: Column) -> Column:
    """Day of month over thirty."""
    return F.dayofmonth(d) / F.lit(30.0)


# --- strings --------------------------------------------------------------------------------

def station_name(ident: Column, name: Column) -> Column:
    return F.concat_ws("_", ident.cast("string"), F.replace(name, F.lit(" "), F.lit("_")))


def padded(c: Column, width: int = 3) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def coordinate_text(c: Column, decimals: int = 5) -> Column:
    return F.format_string(f"%.{decimals}f", c)


# --- bands ----------------------------------------------------------------------------------

def bit_set(c: Column, bit: int) -> Column:
    return c.bitwiseAND(F.lit(1 << bit)) != 0


def normalized_difference(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


# --- physics --------------------------------------------------------------------------------

def penman(net_radiation: Column, air_temp: Column, wind: Column, vapor_pressure: Column,
           pressure: Column, area: Column) -> Column:
    """Open-water evaporation in mm per day (combined energy and mass-transfer form).

    W/m2, degrees C, m/s, kPa, kPa and km2.
    """
    # Fixed values of the published equation.
    latent = 28.34
    saturation = F.lit(0.6108) * F.exp(F.lit(17.27) * air_temp / (F.lit(237.3) + air_temp))
    slope = F.lit(4098.0) * saturation / F.pow(F.lit(237.3) + air_temp, F.lit(2.0))
    gamma = F.lit(1000.0) * pressure / F.lit(0.622 * 2.45 * 1e6)
    transfer = F.lit(1.26) * F.pow(area, F.lit(-0.05))
    weight = slope + gamma
    return (slope * net_radiation / (F.lit(latent) * weight)
            + transfer * gamma * wind * (saturation - vapor_pressure) / weight)


# --- geometry -------------------------------------------------------------------------------

def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between points in degrees."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), F.lit(2.0))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(h))


def cell_index(value: Column, origin: float | Column, size: float | Column) -> Column:
    """Nearest cell of a regular axis."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.floor((value - lit(origin)) / lit(size) + 0.5).cast("int")


# --- arrays ---------------------------------------------------------------------------------

def consecutive_pairs(values: Column) -> Column:
    """[a, b, c] to [(a, b), (b, c)]."""
    n = F.size(values)
    return F.zip_with(F.slice(values, F.lit(1), F.greatest(n - 1, F.lit(0))),
                      F.slice(values, F.lit(2), F.greatest(n - 1, F.lit(0))),
                      lambda a, b: F.struct(a.alias("first"), b.alias("second")))


def chunks(values: Column, size: int) -> Column:
    """Split an array into groups of ``size``; the last one may be shorter."""
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(values, s, F.lit(size)))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)
