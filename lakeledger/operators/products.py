"""Final products, their comparison and chart data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.functions.columns import SECONDS_PER_DAY, bcm_to_m3, non_negative

# Product name -> (input column, output column).
PRODUCTS = {
    "sarea": ("area", "area (km2)"),
    "inflow": ("streamflow", "inflow (m3/d)"),
    "dels": ("ds", "dS (m3)"),
    "evaporation": ("evaporation", "evaporation (mm)"),
    "outflow": ("outflow_rate", "outflow (m3/d)"),
    "altimeter": ("height", "height (m)"),
}
# Curve columns as delivered -> product columns.
CURVE_NAMES = {
    "Elevation": "elevation",
    "CumArea": "area",
    "Storage": "storage",
    "Storage (mil. m3)": "storage (mil. m3)",
    "Elevation_Observed": "elevation_srtm",
}
# Chart -> product, x and y column.
CHARTS = {
    "Storage Change": ("dels", "date", "dS (m3)"),
    "Inflow": ("inflow", "date", "inflow (m3/d)"),
    "Outflow": ("outflow", "date", "outflow (m3/d)"),
    "Surface Area": ("sarea", "date", "area (km2)"),
    "Evaporation": ("evaporation", "date", "evaporation (mm)"),
    "A-E Curve": ("aec", "area", "elevation"),
}


def product_value(kind: str, rounded: bool = True) -> Column:
    """The product column of a kind, in its published unit."""
    source, _ = PRODUCTS[kind]
    c = F.col(source)
    if kind == "sarea":
        return F.round(c, 3) if rounded else c
    if kind == "altimeter":
        return F.round(c, 2)
    if kind == "inflow":
        return c * SECONDS_PER_DAY
    if kind == "dels":
        return bcm_to_m3(c)
    if kind == "outflow":
        return non_negative(c) * SECONDS_PER_DAY
    return c


def product(df: DataFrame, kind: str, keys: Sequence[str], date: str = "date", rounded: bool = True) -> DataFrame:
    """Project a series to its final product layout; ``rounded=False`` gives the second layout."""
    return df.select(*keys, F.col(date).alias("date"), product_value(kind, rounded).alias(PRODUCTS[kind][1]))


def curve_product(curve: DataFrame) -> DataFrame:
    return curve.withColumnsRenamed(CURVE_NAMES)


def forecast_product(df: DataFrame, base: Column, date: str = "date") -> DataFrame:
    """Rows from the base date on."""
    return df.where(F.col(date) >= base)


def compare(truth: DataFrame, estimate: DataFrame, keys: Sequence[str], entity: Sequence[str],
            values: Sequence[str], percent: float = 5.0) -> DataFrame:
    """Match, unmatched or missing per entity, by relative difference of each value column.

    A value present on one side only is a mismatch; an entity without any estimate is missing.
    """
    t = truth.select(*keys, *[F.col(v).alias(f"_t_{v}") for v in values], F.lit(True).alias("_in_t"))
    e = estimate.select(*keys, *[F.col(v).alias(f"_e_{v}") for v in values], F.lit(True).alias("_in_e"))
    both = t.join(e, list(keys), "full")
    same = F.lit(True)
    for v in values:
        tv, ev = F.col(f"_t_{v}"), F.col(f"_e_{v}")
        close = F.abs(ev - tv) <= F.abs(tv) * (percent / 100.0)
        same = same & F.when(tv.isNull() & ev.isNull(), F.lit(True)).otherwise(F.coalesce(close, F.lit(False)))
    per_row = both.withColumn("_same", same & F.coalesce("_in_t", F.lit(False)) & F.coalesce("_in_e", F.lit(False)))
    agg = per_row.groupBy(*entity).agg(
        F.bool_and("_same").alias("_all"), F.count("_in_e").alias("_ne"), F.count("_in_t").alias("_nt"),
        F.sum((~F.col("_same")).cast("long")).alias("differing_rows"))
    status = (F.when((F.col("_ne") == 0) | (F.col("_nt") == 0), "missing")
              .when(F.col("_all"), "match").otherwise("unmatch"))
    return agg.select(*entity, status.alias("status"), "differing_rows")


def chart_data(df: DataFrame, chart: str, keys: Sequence[str], x_scale: float = 1.0, y_scale: float = 1.0) -> DataFrame:
    """x and y of a chart, scaled; a date axis is not scaled."""
    _, x, y = CHARTS[chart]
    xs = F.col(f"`{x}`") if x == "date" else F.col(f"`{x}`") * x_scale
    return df.select(*keys, xs.alias("x"), (F.col(f"`{y}`") * y_scale).alias("y"))
