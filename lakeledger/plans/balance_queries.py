"""Curve, storage, evaporation, outflow and product queries."""

from pyspark.sql import functions as F

from lakeledger.functions.columns import CMS_PER_CFS
from lakeledger.operators import balance, curves, products
from lakeledger.operators.scale import pick_rows
from lakeledger.operators.series import to_daily
from lakeledger.plans.registry import query
from lakeledger.plans.tables import Tables, check_sql

R = ["reservoir_id"]

LEVELS = """with leveled as (
  select a.reservoir_id, a.date, a.area,
    case when s.x1 is null then s.z0 else s.z0 + (s.z1 - s.z0) / (s.x1 - s.x0) * (least(greatest(a.area, s.amin), s.amax) - s.x0) end as level
  from s2_daily a join reservoirs r using (reservoir_id)
  left join curve_seg s on s.curve_id = r.curve_id
    and least(greatest(a.area, s.amin), s.amax) >= s.x0
    and (s.x1 is null or least(greatest(a.area, s.amin), s.amax) < s.x1)
), changes as (
  select *, (level - lag(level) over w) * (area + lag(area) over w) * 1e6 / 2 * 1e-9 as ds
  from leveled window w as (partition by reservoir_id order by date))
"""


def leveled_areas(t: Tables):
    return t.s2_daily.select("*", *t.reservoir_columns())


def storage(t: Tables):
    return balance.storage_change(leveled_areas(t), t.curve, R, ["curve_id"])


@query("storage_change", check_sql("s2_daily reservoirs curve_seg", LEVELS + """
select reservoir_id, date, area, round(level, 4) as level, round(ds * 1e6, 4) + 0.0 as ds_thousand_m3 from changes"""))
def storage_change(t: Tables):
    """Area to level to storage change for every reservoir."""
    return storage(t).select("reservoir_id", "date", "area", F.round("level", 4).alias("level"),
                             F.round(F.col("ds") * 1e6, 4).alias("ds_thousand_m3"))


OUTFLOW = LEVELS + """, ends as (
  select c.*, lag(date) over (partition by reservoir_id order by date) as before from changes c)
"""


@query("outflow", check_sql("s2_daily reservoirs curve_seg flow", OUTFLOW + """
select e.reservoir_id, e.date, round(coalesce(sum(f.streamflow), 0) * 86400 / 1e6, 8) as inflow_mcm,
  round((coalesce(sum(f.streamflow), 0) * 86400 - any_value(e.ds) * 1e9) / 1e6, 8) + 0.0 as outflow_mcm,
  date_diff('day', any_value(e.before), e.date) as days_passed,
  round((coalesce(sum(f.streamflow), 0) * 86400 - any_value(e.ds) * 1e9) / (date_diff('day', any_value(e.before), e.date) * 86400) / 0.028316847, 4) + 0.0 as outflow_cfs
from ends e left join flow f on f.reservoir_id = e.reservoir_id and f.date > e.before and f.date <= e.date
where e.before is not null group by e.reservoir_id, e.date"""))
def outflow(t: Tables):
    """Interval inflow minus storage change, half-open intervals."""
    out = balance.outflow(storage(t), t.flow, None, R)
    return out.select("reservoir_id", "date", F.round(F.col("inflow_vol") / 1e6, 8).alias("inflow_mcm"),
                      F.round(F.col("outflow_vol") / 1e6, 8).alias("outflow_mcm"),
                      F.col("days_passed").cast("bigint").alias("days_passed"),
                      F.round(F.col("outflow_rate") / CMS_PER_CFS, 4).alias("outflow_cfs"))


@query("outflow_closed_interval", check_sql("s2_daily reservoirs curve_seg flow", OUTFLOW + """
select e.reservoir_id, e.date, round(coalesce(sum(f.streamflow), 0) * 86400 / 1e6, 8) as inflow_mcm
from ends e left join flow f on f.reservoir_id = e.reservoir_id and f.date >= e.before and f.date <= e.date
where e.before is not null group by e.reservoir_id, e.date"""))
def outflow_closed(t: Tables):
    """The same with the starting day counted too."""
    out = balance.outflow(storage(t), t.flow, None, R, both_closed=True)
    return out.select("reservoir_id", "date", F.round(F.col("inflow_vol") / 1e6, 8).alias("inflow_mcm"))


PENMAN = """with daily as (
  select reservoir_id, date, avg(net_radiation) as rn, avg(air_temp) as tair, avg(wind) as wind, avg(vapor_pressure) as vp,
    avg(pressure) as pres, 10.0 + reservoir_id % 90 as area, row_number() over (partition by reservoir_id order by date) as i
  from cell_flux group by 1, 2),
terms as (select *, 0.6108 * exp(17.27 * tair / (237.3 + tair)) as es, 1000 * pres / (0.622 * 2.45 * 1e6) as gamma,
  1.26 * pow(area, -0.05) as ke from daily where i > 1),
slopes as (select *, 4098 * es / pow(237.3 + tair, 2) as delta from terms),
evap as (select reservoir_id, date, area, delta * rn / (28.34 * (delta + gamma)) + ke * gamma * wind * (es - vp) / (delta + gamma) as evaporation from slopes)
"""


def evaporation(t: Tables):
    return balance.evaporation(t.cell_flux, t.reservoirs, R,
                               constant_area=(F.col("reservoir_id") % 90 + 10.0))


@query("penman_evaporation", check_sql("cell_flux", PENMAN + """
select reservoir_id, date, round(evaporation, 4) + 0.0 as evaporation from evap"""))
def penman_evaporation(t: Tables):
    """Cell averages per reservoir and day, then the combined evaporation equation."""
    return evaporation(t).select("reservoir_id", "date", F.round("evaporation", 4).alias("evaporation"))


@query("evaporation_volume", check_sql("cell_flux", PENMAN + """
select reservoir_id, round(sum(evaporation * 0.001 * area * 1e6) / 1e6, 4) + 0.0 as volume_mcm from evap group by 1"""))
def evaporation_volume(t: Tables):
    from lakeledger.functions.columns import mm_over_km2_to_m3
    vol = mm_over_km2_to_m3(F.col("evaporation"), F.col("area"))
    return evaporation(t).groupBy("reservoir_id").agg(F.round(F.sum(vol) / 1e6, 4).alias("volume_mcm"))


@query("outflow_with_evaporation", check_sql("s2_daily reservoirs curve_seg flow sar_daily", OUTFLOW + """,
evap_in as (select reservoir_id, date, sarea / 10 as mm from sar_daily),
inflow_v as (select e.reservoir_id, e.date, coalesce(sum(f.streamflow), 0) * 86400 as v from ends e
  left join flow f on f.reservoir_id = e.reservoir_id and f.date > e.before and f.date <= e.date where e.before is not null group by 1, 2),
evap_v as (select e.reservoir_id, e.date, coalesce(sum(x.mm), 0) as mm from ends e
  left join evap_in x on x.reservoir_id = e.reservoir_id and x.date > e.before and x.date <= e.date where e.before is not null group by 1, 2)
select reservoir_id, date, round(mm * 0.001 * nominal_area * 1e6 / 1e6, 8) as evap_mcm,
  round((v - ds * 1e9 - mm * 0.001 * nominal_area * 1e6) / 1e6, 8) + 0.0 as outflow_mcm
from ends join inflow_v using (reservoir_id, date) join evap_v using (reservoir_id, date) join reservoirs using (reservoir_id)"""))
def outflow_with_evaporation(t: Tables):
    """Outflow with the evaporated volume taken off."""
    evap = t.sar_daily.select("reservoir_id", "date", (F.col("sarea") / 10).alias("evaporation"))
    out = balance.outflow(storage(t), t.flow, evap, R, subtract_evaporation=True)
    return out.select("reservoir_id", "date", F.round(F.col("evap_vol") / 1e6, 8).alias("evap_mcm"),
                      F.round(F.col("outflow_vol") / 1e6, 8).alias("outflow_mcm"))


@query("completeness", check_sql("reservoirs flow s2_daily sar_daily", """
select r.reservoir_id, concat_ws(',', case when f.reservoir_id is null then 'inflow' end, case when a.reservoir_id is null then 'area' end,
  case when s.reservoir_id is null then 'sar' end) as missing,
  f.reservoir_id is not null and a.reservoir_id is not null and s.reservoir_id is not null as complete
from reservoirs r left join (select distinct reservoir_id from flow) f using (reservoir_id)
left join (select distinct reservoir_id from s2_daily) a using (reservoir_id)
left join (select distinct reservoir_id from sar_daily) s using (reservoir_id)"""))
def completeness(t: Tables):
    """Missing inputs per reservoir."""
    out = balance.completeness(t.reservoirs, R, inflow=t.flow, area=t.s2_daily, sar=t.sar_daily)
    return out.select("reservoir_id", "missing", "complete")


# --- curves ---------------------------------------------------------------------------------

@query("aec_curve", check_sql("curve", "select curve_id, elevation, area from curve"))
def aec_curve(t: Tables):
    """Observed curve from terrain pixels."""
    return t.curve


@query("aec_clip", check_sql("curve", """with steps as (
  select *, round(area - lag(area) over (partition by curve_id order by elevation), 6) as step from curve),
top as (select curve_id, elevation as from_z from steps where step is not null
  qualify row_number() over (partition by curve_id order by step desc, elevation) = 1)
select curve_id, elevation, area from curve join top using (curve_id) where elevation >= from_z"""))
def aec_clip(t: Tables):
    """Part of the curve above the water surface."""
    return curves.above_water_surface(t.curve, ["curve_id"])


@query("aec_storage", check_sql("curve", """with h as (
  select *, elevation - min(elevation) over (partition by curve_id) as height from curve),
piece as (select *, (height + lag(height) over w) / 2.0 * (area - lag(area) over w) * 1e6 as v from h window w as (partition by curve_id order by area, elevation))
select curve_id, elevation, area, round(sum(coalesce(v, 0)) over (partition by curve_id order by area, elevation rows unbounded preceding) * 1e-6, 4) as storage_mcm from piece
where elevation in (select elevation from h)"""))
def aec_storage(t: Tables):
    """Cumulative storage along the curve."""
    stored = curves.curve_storage(t.curve, ["curve_id"], "area", "elevation")
    return stored.select("curve_id", "elevation", "area", F.round("storage_mcm", 4).alias("storage_mcm"))


FIT = """with dam as (select curve_id, quantile_cont(elevation, 0.01) as b from dem group by 1),
x as (select c.curve_id, c.area as a, c.elevation as z, d.b from curve c join dam d using (curve_id) where c.elevation > d.b and c.elevation <= d.b + 40),
m as (select curve_id, any_value(b) as b, max(a) as amax, count(distinct a) as levels, cast(count(*) as double) as n, sum(a) as s1, sum(a*a) as s2, sum(a*a*a) as s3,
  sum(a*a*a*a) as s4, cast(sum(z) as double) as t0, sum(a*z) as t1, sum(a*a*z) as t2 from x group by 1),
d as (select *, n*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2) as d3, n*s2-s1*s1 as d2 from m),
f as (select *, (t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2))/nullif(d3,0) as p0, (n*(t1*s4-s3*t2) - t0*(s1*s4-s3*s2) + s2*(s1*t2-t1*s2))/nullif(d3,0) as p1,
  (n*(s2*t2-t1*s3) - s1*(s1*t2-t1*s2) + t0*(s1*s3-s2*s2))/nullif(d3,0) as p2, (t0*s2-s1*t1)/nullif(d2,0) as l0, (n*t1-s1*t0)/nullif(d2,0) as l1 from d),
g as (select *, least(greatest(p0, b), b+5) as q0, least(greatest(l0, b), b+5) as k0 from f),
h as (select *, case when q0 = p0 then p1 else ((t1-q0*s1)*s4-(t2-q0*s2)*s3)/nullif(s2*s4-s3*s3,0) end as q1,
  case when q0 = p0 then p2 else (s2*(t2-q0*s2)-s3*(t1-q0*s1))/nullif(s2*s4-s3*s3,0) end as q2,
  case when k0 = l0 then l1 else (t1-k0*s1)/nullif(s2,0) end as k1 from g),
fit as (select curve_id, amax, case when levels > 2 and q1 >= 0 and q1 + 2*q2*amax >= 0 then 2 else 1 end as degree, q0, q1, q2, k0, k1, levels from h
  where (levels > 2 and q1 >= 0 and q1 + 2*q2*amax >= 0) or (levels > 1 and k1 >= 0))
"""


def fitted(t: Tables):
    dams = curves.dam_bottom(t.dem, ["curve_id"]).select("curve_id", F.col("p1").alias("dam_bottom"), F.lit(40.0).alias("dam_height"))
    part = curves.between_dam_levels(t.curve, dams, ["curve_id"])
    return curves.fit_curve(part, ["curve_id"]), part


@query("aec_fit", check_sql("curve", FIT + """
select curve_id, degree, round(case degree when 2 then q0 else k0 end, 3) as c0, round(case degree when 2 then q1 else k1 end, 3) as c1,
  round(case degree when 2 then q2 else 0 end, 3) + 0.0 as c2 from fit"""))
def aec_fit(t: Tables):
    """Polynomial fit with the intercept held near the dam bottom."""
    fits, _ = fitted(t)
    return fits.select("curve_id", "degree", F.round("c0", 3).alias("c0"), F.round("c1", 3).alias("c1"), F.round("c2", 3).alias("c2"))


@query("aec_predict", check_sql("curve", FIT + """, pts as (
  select curve_id, unnest(generate_series(0, cast(ceil(amax / 0.25) as int) - 1)) * 0.25 as area, null::double as z from fit
  union all select curve_id, a, z from x where curve_id in (select curve_id from fit)),
u as (select curve_id, area, max(z) as elevation_observed from pts group by 1, 2)
select curve_id, round(u.area, 3) as area, elevation_observed, round(case degree when 2 then q0 + q1*u.area + q2*u.area*u.area else k0 + k1*u.area end, 3) as elevation
from u join fit using (curve_id)"""))
def aec_predict(t: Tables):
    """Predicted curve on a quarter-km2 grid and at observed areas."""
    fits, part = fitted(t)
    out = curves.predicted_curve(fits, part, ["curve_id"])
    return out.select("curve_id", F.round("area", 3).alias("area"), "elevation_observed", F.round("elevation", 3).alias("elevation"))


@query("dam_bottom", check_sql("dem", """select curve_id, cast(min(elevation) as int) as lowest, cast(max(elevation) as int) as highest, round(quantile_cont(elevation, 0.01), 4) as p1,
  round(quantile_cont(elevation, 0.05), 4) as p5, round(quantile_cont(elevation, 0.1), 4) as p10 from dem group by 1"""))
def dam_bottom(t: Tables):
    """Low terrain percentiles."""
    s = curves.dam_bottom(t.dem, ["curve_id"])
    return s.select("curve_id", F.col("min").alias("lowest"), F.col("max").alias("highest"), *[F.round(f"p{p}", 4).alias(f"p{p}") for p in (1, 5, 10)])


@query("curve_lookup", check_sql("s2_daily reservoirs curve_seg", LEVELS + "select reservoir_id, date, round(level, 4) as level from leveled"))
def curve_lookup(t: Tables):
    """Piecewise-linear level at each area, held constant beyond the curve."""
    out = curves.curve_lookup(leveled_areas(t), t.curve, ["curve_id"], "area", "area", "elevation", "level")
    return out.select("reservoir_id", "date", F.round("level", 4).alias("level"))


# --- products -------------------------------------------------------------------------------

@query("final_products", check_sql("s2_daily reservoirs curve_seg flow", OUTFLOW + """, o as (
select e.reservoir_id, e.date, any_value(e.area) as area, any_value(e.level) as level, any_value(e.ds) as ds,
  (coalesce(sum(f.streamflow), 0) * 86400 - any_value(e.ds) * 1e9) / (date_diff('day', any_value(e.before), e.date) * 86400) as rate
from ends e left join flow f on f.reservoir_id = e.reservoir_id and f.date > e.before and f.date <= e.date
where e.before is not null group by e.reservoir_id, e.date)
select reservoir_id, date, round(area, 3) as area_km2, round(ds * 1e9, 2) + 0.0 as ds_m3, round(greatest(rate, 0) * 86400 / 0.028316847, 2) as outflow_cfd from o"""))
def final_products(t: Tables):
    """Published units and rounding, one row per reservoir and date."""
    o = balance.outflow(storage(t), t.flow, None, R)
    return o.select("reservoir_id", "date", products.product_value("sarea").alias("area_km2"),
                    F.round(products.product_value("dels"), 2).alias("ds_m3"),
                    F.round(products.product_value("outflow") / CMS_PER_CFS, 2).alias("outflow_cfd"))


@query("compare_products", check_sql("sensor_daily", """with a as (select reservoir_id, date, water_area as v from sensor_daily where sat = 's2'),
b as (select reservoir_id, date, water_area as v from sensor_daily where sat = 'l8'),
j as (select coalesce(a.reservoir_id, b.reservoir_id) as reservoir_id, a.reservoir_id as ra, b.reservoir_id as rb,
  coalesce(a.v is not null and b.v is not null and abs(b.v - a.v) <= abs(a.v) * 0.05, false) as same
  from a full join b on a.reservoir_id = b.reservoir_id and a.date = b.date)
select reservoir_id, case when count(ra) = 0 or count(rb) = 0 then 'missing' when bool_and(same) then 'match' else 'unmatch' end as status,
  cast(sum(cast(not same as int)) as bigint) as differing_rows from j group by 1"""))
def compare_products(t: Tables):
    """Two area products against each other, five percent tolerance."""
    pick = lambda s: t.sensor_daily.where(F.col("sat") == s).select("reservoir_id", "date", F.col("water_area").alias("v"))
    return products.compare(pick("s2"), pick("l8"), ["reservoir_id", "date"], R, ["v"])


@query("chart_data", check_sql("flow", "select reservoir_id, date as x, round(streamflow * 86400 * 1e-6, 4) as y from flow"))
def chart_data(t: Tables):
    """Scaled chart axes of the inflow product."""
    p = products.product(t.flow, "inflow", R)
    return products.chart_data(p, "Inflow", R, y_scale=1e-6).withColumn("y", F.round("y", 4))
