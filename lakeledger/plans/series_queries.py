"""Resampling, interpolation, smoothing, fusion and screening queries."""

from pyspark.sql import functions as F

from lakeledger.functions.columns import day_number
from lakeledger.operators import fusion, screens, series
from lakeledger.plans.registry import query
from lakeledger.plans.tables import Tables, check_sql

R = ["reservoir_id"]
S = ["reservoir_id", "sat"]


def r(c: str, d: int = 6):
    return F.round(c, d).alias(c)


def neighbours(src: str, part: str, x: str, v: str) -> str:
    """SQL: previous and next known value (pv, nv) with their positions (px, nx)."""
    return f"""select *, last_value({v} ignore nulls) over up as pv, max(case when {v} is not null then {x} end) over up as px,
  first_value({v} ignore nulls) over dn as nv, min(case when {v} is not null then {x} end) over dn as nx from {src}
  window up as (partition by {part} order by {x} rows between unbounded preceding and current row),
    dn as (partition by {part} order by {x} rows between current row and unbounded following)"""


LINEAR = "case when {v} is not null then {v} when nv is null then pv else pv + (nv - pv) * ({x} - px) / (nx - px) end"


# --- cleaning and merging -------------------------------------------------------------------

@query("cloud_screen", check_sql("optical", """with s as (select reservoir_id, sat, date, cloud_area * 100 / (water_area + non_water_area + cloud_area) as cp,
  water_area, nullif(corrected_area, -1) as c from optical)
select reservoir_id, sat, date, round(cp, 6) as cloud_percent, case when cp >= 90 then null else water_area end as water_area,
  case when cp >= 90 then null else c end as corrected_area, case when cp >= 90 then 1 else 0 end as quality from s"""))
def cloud_screen(t: Tables):
    """Cloud percent, sentinel removal and quality flag."""
    return fusion.screen_clouds(t.optical).select(*S, "date", r("cloud_percent"), "water_area", "corrected_area", "quality")


@query("regular_grid_fill", check_sql("cleaned", """select reservoir_id, sat, date, quality, cloud_area, round(cloud_percent, 6) as cloud_percent,
  non_water_area, water_area, round(corrected_area, 6) as corrected_area from cleaned"""))
def regular_grid_fill(t: Tables):
    """Every sensor on its revisit grid, missing rows marked, corrected area filled by position."""
    return fusion.clean_optical(t.optical, R).select(
        *S, "date", "quality", "cloud_area", r("cloud_percent"), "non_water_area", "water_area", r("corrected_area"))


@query("sensor_merge", check_sql("merged", "select reservoir_id, date, sat, round(area, 6) as area, quality from merged"))
def sensor_merge(t: Tables):
    """One optical row per date by sensor priority."""
    return fusion.merge_sensors(fusion.clean_optical(t.optical, R), R).select(*R, "date", "sat", r("area"), "quality")


# --- filling --------------------------------------------------------------------------------

GAPPED = "gapped as (select reservoir_id, date, case when cast(area * 100 as bigint) % 4 = 0 then null else area end as v from s2_daily)"


def gapped(t: Tables):
    return t.s2_daily.withColumn("v", F.when(F.round(F.col("area") * 100).cast("bigint") % 4 != 0, F.col("area"))).drop("area")


@query("time_fill", check_sql("s2_daily", f"with {GAPPED}, x as (select *, date_diff('day', date '1970-01-01', date) as x from gapped), "
       f"n as ({neighbours('x', 'reservoir_id', 'x', 'v')}) select reservoir_id, date, round({LINEAR.format(v='v', x='x')}, 6) as v from n"))
def time_fill(t: Tables):
    """Linear by time, ends as the time interpolation defines them."""
    return series.fill_by_time(gapped(t), R, ["v"]).select(*R, "date", r("v"))


@query("position_fill", check_sql("s2_daily", f"with {GAPPED}, x as (select *, row_number() over (partition by reservoir_id order by date) as x from gapped), "
       f"n as ({neighbours('x', 'reservoir_id', 'x', 'v')}) select reservoir_id, date, round({LINEAR.format(v='v', x='x')}, 6) as v from n"))
def position_fill(t: Tables):
    return series.fill_by_position(gapped(t), R, ["v"]).select(*R, "date", r("v"))


DAILY = """b as (select reservoir_id, min(date) as d0, max(date) as d1 from {src} group by 1),
cal as (select reservoir_id, cast(unnest(generate_series(cast(d0 as timestamp), cast(d1 as timestamp), interval 1 day)) as date) as date from b)"""


@query("daily_upsample", check_sql("area_obs", f"""with m as (select reservoir_id, date, avg(water_area) as v from area_obs group by 1, 2),
{DAILY.format(src='m')}, x as (select c.reservoir_id, c.date, m.v, date_diff('day', date '1970-01-01', c.date) as x from cal c left join m using (reservoir_id, date)),
n as ({neighbours('x', 'reservoir_id', 'x', 'v')}) select reservoir_id, date, round({LINEAR.format(v='v', x='x')}, 6) as area from n"""))
def daily_upsample(t: Tables):
    """All sensors averaged per day, then every day in between."""
    return series.to_daily(t.area_obs.withColumnRenamed("water_area", "area"), R, ["area"]).select(*R, "date", r("area"))


@query("forward_extension", check_sql("s2_daily", """with l as (select reservoir_id, max(date) as d, arg_max(area, date) as area from s2_daily group by 1),
x as (select reservoir_id, area, cast(unnest(generate_series(cast(d as timestamp) + interval 1 day, timestamp '2024-02-14', interval 1 day)) as date) as date from l)
select reservoir_id, date, area from s2_daily union all select reservoir_id, date, area from x"""))
def forward_extension(t: Tables):
    """Last area repeated up to a fixed end date."""
    return series.extend_forward(t.s2_daily, R, ["area"], F.lit("2024-02-14").cast("date")).select(*R, "date", "area")


@query("daily_frame", check_sql("s2_daily", f"with {DAILY.format(src='s2_daily')} select reservoir_id, date, area from cal left join s2_daily using (reservoir_id, date)"))
def daily_frame(t: Tables):
    """Daily calendar without filling."""
    return series.daily_frame(t.s2_daily, R, ["area"])


@query("daily_spread", check_sql("s2_daily", f"""with {GAPPED}, {DAILY.format(src='gapped')},
j as (select c.reservoir_id, c.date, g.v from cal c left join gapped g using (reservoir_id, date)),
k as (select *, count(v) over (partition by reservoir_id order by date desc) as grp from j)
select reservoir_id, date, round(avg(coalesce(v, 0)) over (partition by reservoir_id, grp), 6) as v from k
where reservoir_id in (select reservoir_id from gapped where v is not null)"""))
def daily_spread(t: Tables):
    """Each interval total divided over its days."""
    return series.spread_totals(gapped(t), R, "v").select(*R, "date", r("v"))


@query("neighbour_fill", check_sql("flow", f"""with {DAILY.format(src='flow')}, j as (select c.reservoir_id, c.date, f.streamflow as v from cal c left join flow f using (reservoir_id, date)),
p as (select *, lag(v) over w as a, lead(v) over w as b from j window w as (partition by reservoir_id order by date))
select reservoir_id, date, round(coalesce(v, (a + b) / 2, a, b), 6) as streamflow from p"""))
def neighbour_fill(t: Tables):
    """Missing days from the days beside them."""
    return series.neighbour_fill(t.flow, R, ["streamflow"]).select(*R, "date", r("streamflow"))


# --- as-of ----------------------------------------------------------------------------------

@query("asof_bracket", check_sql("s2_daily sar_daily", """with seg as (select reservoir_id, date as d0, sarea as v0, lead(date) over w as d1, lead(sarea) over w as v1
  from sar_daily window w as (partition by reservoir_id order by date))
select a.reservoir_id, a.date, a.area, round(case when a.date = s.d0 then s.v0 else s.v0 + (s.v1 - s.v0) * date_diff('day', s.d0, a.date) / date_diff('day', s.d0, s.d1) end, 6) as sar_area
from s2_daily a left join seg s on s.reservoir_id = a.reservoir_id and a.date >= s.d0 and (a.date < s.d1 or a.date = s.d0)"""))
def asof_bracket(t: Tables):
    """Radar area at optical dates by linear interpolation."""
    return series.value_at(t.s2_daily, t.sar_daily, R, "sarea", "sar_area").select(*R, "date", "area", r("sar_area"))


@query("lookback_change", check_sql("sar_daily", """select a.reservoir_id, a.date, round(a.sarea - arg_min(b.sarea, b.date), 6) + 0.0 as change from sar_daily a
join (select reservoir_id, min(date) as d0 from sar_daily group by 1) f using (reservoir_id)
left join sar_daily b on b.reservoir_id = a.reservoir_id and b.date between a.date - 14 and a.date and a.date - 14 >= f.d0 group by a.reservoir_id, a.date, a.sarea"""))
def lookback_change(t: Tables):
    """Change since the first observation of the last two weeks."""
    out = series.lookback_first(t.sar_daily, R, "sarea", "_then")
    return out.select(*R, "date", F.round(F.col("sarea") - F.col("_then"), 6).alias("change"))


# --- smoothing and trends -------------------------------------------------------------------

@query("weighted_smooth", check_sql("sensor_daily", """select reservoir_id, date, round(sum(water_area * (101 - cloud_percent)) over w / sum(101 - cloud_percent) over w, 10) as smooth
from sensor_daily where sat = 's2' window w as (partition by reservoir_id order by date rows between 1 preceding and 1 following)"""))
def weighted_smooth(t: Tables):
    """Cloud-weighted centred mean of three."""
    one = t.sensor_daily.where("sat = 's2'")
    return one.select(*R, "date", F.round(series.weighted_smooth(R, "water_area", F.lit(101) - F.col("cloud_percent")), 10).alias("smooth"))


@query("savgol_smooth", check_sql("s2_daily", """with n as (select *, row_number() over (partition by reservoir_id order by date) as i, count(*) over (partition by reservoir_id) as n from s2_daily),
c as (select reservoir_id, list(area order by i) as a from n where n >= 7 group by 1)
select n.reservoir_id, n.date, round(case when n.n < 7 then null
  when i = 1 then (39*a[1] + 8*a[2] - 4*a[3] - 4*a[4] + a[5] + 4*a[6] - 2*a[7]) / 42
  when i = 2 then (8*a[1] + 19*a[2] + 16*a[3] + 6*a[4] - 4*a[5] - 7*a[6] + 4*a[7]) / 42
  when i = 3 then (-4*a[1] + 16*a[2] + 19*a[3] + 12*a[4] + 2*a[5] - 4*a[6] + a[7]) / 42
  when i = n.n then (39*a[n.n] + 8*a[n.n-1] - 4*a[n.n-2] - 4*a[n.n-3] + a[n.n-4] + 4*a[n.n-5] - 2*a[n.n-6]) / 42
  when i = n.n - 1 then (8*a[n.n] + 19*a[n.n-1] + 16*a[n.n-2] + 6*a[n.n-3] - 4*a[n.n-4] - 7*a[n.n-5] + 4*a[n.n-6]) / 42
  when i = n.n - 2 then (-4*a[n.n] + 16*a[n.n-1] + 19*a[n.n-2] + 12*a[n.n-3] + 2*a[n.n-4] - 4*a[n.n-5] + a[n.n-6]) / 42
  else (-2*a[i-3] + 3*a[i-2] + 6*a[i-1] + 7*a[i] + 6*a[i+1] + 3*a[i+2] - 2*a[i+3]) / 21 end, 6) + 0.0 as smooth
from n left join c using (reservoir_id)"""))
def savgol_smooth(t: Tables):
    """Seven-row cubic smoothing."""
    return t.s2_daily.select(*R, "date", F.round(series.savgol_smooth(R, "area"), 6).alias("smooth"))


@query("trend_fill", check_sql("s2_daily sar_daily", """with recursive j as (
  select a.reservoir_id, a.date, case when cast(a.area * 100 as bigint) % 4 = 0 then null else a.area end as v,
    coalesce(date_diff('day', lag(a.date) over w, a.date), 0) as days, (s.sarea - 20) / 10 as trend,
    row_number() over w as i from s2_daily a left join sar_daily s using (reservoir_id, date) window w as (partition by a.reservoir_id order by a.date)),
f as (select reservoir_id, date, i, cast(v as double) as filled from j where i = 1
  union all select j.reservoir_id, j.date, j.i, coalesce(j.v, f.filled + j.trend * j.days) from f join j on j.reservoir_id = f.reservoir_id and j.i = f.i + 1)
select reservoir_id, date, round(filled, 6) + 0.0 as filled from f""", ).replace("with area_obs", "with recursive area_obs").replace("recursive j as", "j as"))
def trend_fill(t: Tables):
    """Gaps continued with a radar-derived trend."""
    j = gapped(t).join(t.sar_daily, [*R, "date"], "left").withColumn("trend", (F.col("sarea") - 20) / 10)
    j = j.withColumn("days", series.days_passed(R))
    return series.trend_fill(j, R, "v", "trend", "days", "filled").select(*R, "date", r("filled"))


@query("series_changes", check_sql("s2_daily", """select reservoir_id, date, coalesce(date_diff('day', lag(date) over w, date), 0) as days_passed,
  round((area - lag(area) over w) / date_diff('day', lag(date) over w, date), 6) + 0.0 as trend, round(area / nullif(lag(area) over w, 0) - 1, 6) + 0.0 as relative
from s2_daily window w as (partition by reservoir_id order by date)"""))
def series_changes(t: Tables):
    """Days passed, trend per day and relative change."""
    out = t.s2_daily.withColumn("trend", F.round(series.daily_trend(R, "area"), 6)).withColumn("days_passed", series.days_passed(R).cast("bigint"))
    return series.percent_change(out, R, "area", "relative").select(*R, "date", "days_passed", "trend", r("relative"))


@query("zscore_clean", check_sql("sar_daily", f"""with z as (select *, (sarea - avg(sarea) over w) / nullif(stddev_pop(sarea) over w, 0) as z, row_number() over (partition by reservoir_id order by date) as x
  from sar_daily window w as (partition by reservoir_id)),
k as (select *, case when abs(z) > 2 then null else sarea end as v from z), n as ({neighbours('k', 'reservoir_id', 'x', 'v')})
select reservoir_id, date, round({LINEAR.format(v='v', x='x')}, 6) as sarea from n"""))
def zscore_clean(t: Tables):
    """Spikes beyond two standard deviations replaced by interpolation."""
    return fusion.spike_screen(t.sar_daily, R, 2.0).select(*R, "date", r("sarea"))


@query("extrapolate_step", check_sql("sar_daily", """with n as (select *, row_number() over (partition by reservoir_id order by date desc) as i from sar_daily),
l as (select reservoir_id, max(date) as d1, min(date) as d0, max(case when i = 1 then sarea end) as v1, max(case when i = 2 then sarea end) as v0 from n where i <= 2 group by 1 having count(*) = 2)
select reservoir_id, date, round(sarea, 6) as sarea from sar_daily union all
select reservoir_id, d1 + 12, round(v1 + (v1 - v0) / date_diff('day', d0, d1) * 12, 6) + 0.0 from l"""))
def extrapolate_step(t: Tables):
    """Radar series extended by one revisit."""
    return series.extrapolate_step(t.sar_daily, R, "sarea").select(*R, "date", r("sarea"))


@query("clip_overlap", check_sql("s2_daily sar_daily", """with b as (select reservoir_id, greatest(min(a.date), min(s.date)) as lo, least(max(a.date), max(s.date)) as hi
  from s2_daily a join sar_daily s using (reservoir_id) group by 1)
select reservoir_id, date, area from s2_daily join b using (reservoir_id) where date between lo and hi"""))
def clip_overlap(t: Tables):
    """Optical rows inside the common period with radar."""
    return series.clip_to_overlap([t.s2_daily, t.sar_daily], R, "both")[0].select(*R, "date", "area")


@query("last_seven", check_sql("s2_daily", """select reservoir_id, date, area from s2_daily qualify row_number() over (partition by reservoir_id order by date desc) <= 7"""))
def last_seven(t: Tables):
    """The seven latest rows per reservoir."""
    return series.last_n(t.s2_daily, R, 7)


@query("percentile_of_score", check_sql("s2_daily", """with l as (select reservoir_id, arg_max(area, date) as score from s2_daily group by 1)
select reservoir_id, round((sum(cast(area < score as int)) + sum(cast(area <= score as int)) + case when sum(cast(area <= score as int)) > sum(cast(area < score as int)) then 1 else 0 end) * 50.0 / count(*), 6) as percentile
from s2_daily join l using (reservoir_id) group by 1"""))
def percentile_of_score(t: Tables):
    """Percentile of the latest area."""
    last = t.s2_daily.groupBy(*R).agg(F.max_by("area", "date").alias("score"))
    return series.percentile_of_score(t.s2_daily, last, R, "area", "score").select(*R, r("percentile"))


@query("month_stats", check_sql("s2_daily", """select reservoir_id, strftime(date, '%Y%m') as year_month, round(avg(area), 6) as month_mean, round(stddev_samp(area), 6) as month_std from s2_daily group by 1, 2"""))
def month_stats(t: Tables):
    return series.month_stats(t.s2_daily, R, "area").select(*R, "year_month", r("month_mean"), r("month_std"))


@query("period_volume", check_sql("flow", """with m as (select 'weekly' as frequency, reservoir_id, cast(date_trunc('week', date) as date) + 6 as period_end, avg(streamflow) as v, count(distinct date) as dt from flow group by 2, 3
  union all select 'monthly', reservoir_id, last_day(date), avg(streamflow), count(distinct date) from flow group by 2, 3
  union all select 'annual', reservoir_id, make_date(year(date), 12, 31), avg(streamflow), count(distinct date) from flow group by 2, 3)
select frequency, reservoir_id, period_end, dt, round(v * dt, 6) as volume from m"""))
def period_volume(t: Tables):
    """Weekly, monthly and annual means times their number of days."""
    out = None
    for f in ("weekly", "monthly", "annual"):
        m = series.volumes(series.period_means(t.flow, R, ["streamflow"], f), ["streamflow"])
        m = m.select(F.lit(f).alias("frequency"), *R, "period_end", "dt", F.round("streamflow", 6).alias("volume"))
        out = m if out is None else out.unionByName(m)
    return out


# --- set operations -------------------------------------------------------------------------

@query("upsert_last_wins", check_sql("sensor_daily", """with o as (select reservoir_id, date, water_area as v, 'l8' as source from sensor_daily where sat = 'l8'),
n as (select reservoir_id, date, water_area as v, 's2' as source from sensor_daily where sat = 's2')
select reservoir_id, date, coalesce(n.v, o.v) as v, coalesce(n.source, o.source) as source from o full join n using (reservoir_id, date)"""))
def upsert_last_wins(t: Tables):
    """New rows replace old ones by date."""
    pick = lambda s: t.sensor_daily.where(F.col("sat") == s).select(*R, "date", F.col("water_area").alias("v"), F.col("sat").alias("source"))
    return series.upsert(pick("l8"), pick("s2"), [*R, "date"])


@query("merge_columns", check_sql("sensor_daily sar_daily", """with o as (select reservoir_id, date, water_area as area, cloud_percent from sensor_daily where sat = 's2'),
n as (select reservoir_id, date, sarea as area from sar_daily)
select reservoir_id, date, n.area, o.cloud_percent from o full join n using (reservoir_id, date)"""))
def merge_columns(t: Tables):
    """Outer merge in which the new column replaces the old one."""
    old = t.sensor_daily.where("sat = 's2'").select(*R, "date", F.col("water_area").alias("area"), "cloud_percent")
    return series.merge_columns(old, t.sar_daily.withColumnRenamed("sarea", "area"), [*R, "date"])


@query("cutover_union", check_sql("sensor_daily", """select reservoir_id, date, sat, water_area from sensor_daily where (sat = 's2' and date < date '2024-01-10')
  or (sat = 'l8' and date >= date '2024-01-10' and date < date '2024-01-20') or (sat = 'l9' and date >= date '2024-01-20')"""))
def cutover_union(t: Tables):
    """Observed, then low-latency, then forecast source by cut-over date."""
    pick = lambda s: t.sensor_daily.where(F.col("sat") == s).select(*R, "date", "sat", "water_area")
    return series.cut_over([pick("s2"), pick("l8"), pick("l9")], ["2024-01-10", "2024-01-20"])


@query("carry_over", check_sql("flow", """with new as (select * from flow where date >= date '2024-01-10' + cast(reservoir_id % 7 as int) and reservoir_id % 5 <> 0),
f as (select reservoir_id, min(date) as d from new group by 1), e as (select reservoir_id, max(date) + 1 as d from flow group by 1)
select o.reservoir_id, date, streamflow, 'old' as part from flow o left join f using (reservoir_id) join e using (reservoir_id) where date >= coalesce(f.d, e.d) - 7 and date < coalesce(f.d, e.d)
union all select reservoir_id, date, streamflow, 'new' from new"""))
def carry_over(t: Tables):
    """A week of earlier state of every reservoir before its new run; runs begin on different days, some have none."""
    rid = F.col("reservoir_id")
    new = t.flow.where((F.col("date") >= F.date_add(F.lit("2024-01-10").cast("date"), (rid % 7).cast("int"))) & (rid % 5 != 0)).withColumn("part", F.lit("new"))
    return series.carry_over(t.flow.withColumn("part", F.lit("old")), new, 7, keys=R)


@query("whole_row_dedupe", check_sql("area_obs", "select distinct reservoir_id, sat, date, cloud_percent from area_obs"))
def whole_row_dedupe(t: Tables):
    """Rows that are equal in every column once."""
    one = t.area_obs.select(*R, "sat", "date", "cloud_percent")
    return series.drop_repeats(one.unionByName(one))


# --- screens --------------------------------------------------------------------------------

ALIGNED = """oneday as (select reservoir_id, date, coalesce(water_area, 0) as optical from sensor_daily
  qualify row_number() over (partition by reservoir_id, date order by case sat when 'l8' then 1 when 's2' then 2 else 3 end) = 1),
sseg as (select reservoir_id, date as d0, sarea as v0, lead(date) over w as d1, lead(sarea) over w as v1 from sar_daily window w as (partition by reservoir_id order by date)),
aligned as (select a.reservoir_id, a.date, a.optical, case when a.date = s.d0 then s.v0 else s.v0 + (s.v1 - s.v0) * date_diff('day', s.d0, a.date) / date_diff('day', s.d0, s.d1) end as sar, r.nominal_area
  from oneday a join reservoirs r using (reservoir_id) left join sseg s on s.reservoir_id = a.reservoir_id and a.date >= s.d0 and (a.date < s.d1 or a.date = s.d0))"""
OUTLIER = """outl as (select reservoir_id, date, sar, nominal_area, case when abs(optical - avg(optical) over m) > stddev_samp(optical) over m * 2.25 then lag(optical) over w else optical end as optical
  from aligned window m as (partition by reservoir_id, strftime(date, '%Y%m')), w as (partition by reservoir_id order by date))"""
BIAS = """bias as (select reservoir_id, date, sar, nominal_area, case when abs(optical - sar) > nominal_area * 0.125 then sar + sign(optical - sar) * nominal_area * 0.125 else optical end as optical from outl)"""
TREND = """prep as (select *, row_number() over w as i, sar_pad / nullif(lag(sar_pad) over w, 0) - 1 as st, opt_pad / nullif(lag(opt_pad) over w, 0) - 1 as ot from (
    select *, last_value(sar ignore nulls) over u as sar_pad, last_value(optical ignore nulls) over u as opt_pad from bias
    window u as (partition by reservoir_id order by date rows between unbounded preceding and current row)) window w as (partition by reservoir_id order by date)),
p as (select *, stddev_samp(abs(ot - st)) over (partition by reservoir_id, strftime(date, '%Y%m')) as sd from prep),
f as (select reservoir_id, i, date, optical as c1, cast(null as double) as c2, st as t1, cast(null as double) as t2 from p where i = 1
  union all select p.reservoir_id, p.i, p.date,
    case when p.i >= 4 and coalesce(abs((p.optical / nullif(f.c1, 0) - 1 + f.c1 / nullif(f.c2, 0) - 1) / 2 - p.st) > p.sd * 1.55, false)
      then coalesce((f.c1 + f.c2) / 2 * (1 + (f.t1 + f.t2) / 2), p.optical) else p.optical end, f.c1, p.st, f.t1
  from f join p on p.reservoir_id = f.reservoir_id and p.i = f.i + 1)"""


def aligned(t: Tables):
    a = screens.align(t.sensor_daily.withColumnRenamed("water_area", "area"), t.sar_daily, R)
    return a.join(t.reservoirs.select(*R, "nominal_area"), R)


@query("monthly_outlier", check_sql("sensor_daily sar_daily reservoirs", f"with {ALIGNED}, {OUTLIER} select reservoir_id, date, round(optical, 6) as area from outl"))
def monthly_outlier(t: Tables):
    """Values far from their monthly mean take the value before (strength 5)."""
    return screens.outlier_screen(aligned(t), R, screens.limit("outlier", 5)).select(*R, "date", F.round("optical", 6).alias("area"))


@query("bias_filter", check_sql("sensor_daily sar_daily reservoirs", f"with {ALIGNED}, {OUTLIER}, {BIAS} select reservoir_id, date, round(optical, 6) + 0.0 as area from bias"))
def bias_filter(t: Tables):
    """Deviation from radar limited to a share of the nominal area (strength 5)."""
    one = screens.outlier_screen(aligned(t), R, screens.limit("outlier", 5))
    return screens.bias_screen(one, screens.limit("bias", 5)).select(*R, "date", F.round("optical", 6).alias("area"))


@query("trend_filter", check_sql("sensor_daily sar_daily reservoirs", f"with {ALIGNED}, {OUTLIER}, {BIAS}, {TREND} select reservoir_id, date, round(c1, 6) + 0.0 as area from f", recursive=True))
def trend_filter(t: Tables):
    """All three screens at strength 5."""
    return screens.screen(t.sensor_daily.withColumnRenamed("water_area", "area"), t.sar_daily, t.reservoirs, R, 5, 5, 5).select(
        *R, "date", r("area"))


# --- fusion ---------------------------------------------------------------------------------

DEVIATION = """seg as (select reservoir_id, date as d0, sarea as v0, lead(date) over w as d1, lead(sarea) over w as v1 from sar_daily window w as (partition by reservoir_id order by date)),
dev as (select a.reservoir_id, a.date, a.area, a.area - case when a.date = s.d0 then s.v0 else s.v0 + (s.v1 - s.v0) * date_diff('day', s.d0, a.date) / date_diff('day', s.d0, s.d1) end as deviation
  from merged a left join seg s on s.reservoir_id = a.reservoir_id and a.date >= s.d0 and (a.date < s.d1 or a.date = s.d0)),
clip as (select reservoir_id, list(deviation) as l, 0 as it, 999999 as before from dev where deviation is not null group by 1
  union all select reservoir_id, list_filter(l, lambda x: x >= m - 2 * s and x <= m + 2 * s), it + 1, len(l)
    from (select *, list_avg(l) as m, list_stddev_pop(l) as s from clip) where len(l) < before),
bias as (select reservoir_id, list_median(arg_max(l, it)) as bias from clip group by 1)"""


@query("sigma_clip", check_sql("merged sar_daily reservoirs", f"with {DEVIATION} select reservoir_id, round(bias, 6) + 0.0 as bias from bias", recursive=True))
def sigma_clip(t: Tables):
    """Bias of the optical series against radar after iterated clipping."""
    opt = fusion.merge_sensors(fusion.clean_optical(t.optical, R), R)
    out = fusion.sar_bias(opt, t.sar_daily.withColumnRenamed("sarea", "area"), R)
    return out.where("bias is not null").groupBy(*R).agg(F.round(F.first("bias"), 6).alias("bias"))


@query("deviation_filter", check_sql("merged sar_daily reservoirs", f"""with {DEVIATION} select d.reservoir_id, d.date, case when coalesce(abs(d.deviation - b.bias) > r.nominal_area *
  case when r.nominal_area < 10 then 0.25 when r.nominal_area < 100 then 0.10 else 0.05 end, false) then null else round(d.area, 6) end as filtered_area
from dev d join reservoirs r using (reservoir_id) left join bias b using (reservoir_id)""", recursive=True))
def deviation_filter(t: Tables):
    """Optical values too far from bias-corrected radar removed."""
    opt = fusion.merge_sensors(fusion.clean_optical(t.optical, R), R).join(t.reservoirs.select(*R, "nominal_area"), R)
    out = fusion.deviation_filter(opt, t.sar_daily.withColumnRenamed("sarea", "area"), R, fusion.area_threshold(F.col("nominal_area")))
    return out.select(*R, "date", r("filtered_area"))


SAR_CLEAN = f"""sj as (select s.*, r.nominal_area, count(*) over p as n, min(date) over p as d0 from sar_daily s join reservoirs r using (reservoir_id) window p as (partition by reservoir_id)),
jt as (select a.reservoir_id, a.date, date_diff('day', date '1970-01-01', a.date) as x, case when coalesce(abs(a.sarea - arg_min(b.sarea, b.date)) > 0.15 * a.nominal_area, false) then null else a.sarea end as v
  from sj a left join sj b on b.reservoir_id = a.reservoir_id and b.date between a.date - 14 and a.date and a.date - 14 >= a.d0 where a.n >= 3 group by a.reservoir_id, a.date, a.sarea, a.nominal_area),
jn as ({neighbours('jt', 'reservoir_id', 'x', 'v')}), jf as (select reservoir_id, date, {LINEAR.format(v='v', x='x')} as v from jn),
zs as (select reservoir_id, date, row_number() over (partition by reservoir_id order by date) as x, case when coalesce(abs((v - avg(v) over p) / nullif(stddev_pop(v) over p, 0)) > 3, false) then null else v end as v
  from jf window p as (partition by reservoir_id)),
zn as ({neighbours('zs', 'reservoir_id', 'x', 'v')}), zf as (select reservoir_id, date, {LINEAR.format(v='v', x='x')} as area, row_number() over (partition by reservoir_id order by date desc) as i from zn),
ze as (select reservoir_id, max(date) as d1, min(date) as d0, max(case when i = 1 then area end) as v1, max(case when i = 2 then area end) as v0 from zf where i <= 2 group by 1),
sarc as (select reservoir_id, date, area as sarea from zf union all select reservoir_id, d1 + 12, v1 + (v1 - v0) / date_diff('day', d0, d1) * 12 from ze)"""


@query("sar_clean", check_sql("sar_daily reservoirs", f"with {SAR_CLEAN} select reservoir_id, date, round(sarea, 6) + 0.0 as area from sarc"))
def sar_clean(t: Tables):
    """Radar series after both screens and the extension."""
    return fusion.clean_sar(t.sar_daily, t.reservoirs, R).select(*R, "date", r("area"))


CORRECTION = DEVIATION.replace("from sar_daily", "from sarc") + """,
filt as (select d.reservoir_id, d.date, d.area, case when coalesce(abs(d.deviation - b.bias) > r.nominal_area * case when r.nominal_area < 10 then 0.25 when r.nominal_area < 100 then 0.10 else 0.05 end, false) then null else d.area end as v
  from dev d join reservoirs r using (reservoir_id) left join bias b using (reservoir_id) where d.reservoir_id in (select reservoir_id from sarc)),
lim as (select f.reservoir_id, min(case when v is not null then date end) as f0, min(date) as o0, any_value(s0) as s0, any_value(s1) as s1 from filt f join (select reservoir_id, min(date) as s0, max(date) as s1 from sarc group by 1) using (reservoir_id) group by 1),
beg as (select l.*, greatest(coalesce(f0, s0), s0) as frm, (select min(date) from sarc s where s.reservoir_id = l.reservoir_id and s.date >= greatest(coalesce(f0, s0), s0)) as sf from lim l),
held as (select f.*, b.frm, b.sf, b.s1, b.o0, greatest(least(f.date, b.s1), b.sf) as hd from filt f join beg b using (reservoir_id)),
hv as (select h.*, case when h.hd = g.d0 then g.v0 else g.v0 + (g.v1 - g.v0) * date_diff('day', g.d0, h.hd) / date_diff('day', g.d0, g.d1) end as s
  from held h left join seg g on g.reservoir_id = h.reservoir_id and h.hd >= g.d0 and (h.hd < g.d1 or (h.hd = g.d0 and g.d1 is null))),
kn as (select *, (v - lag(v) over w) / date_diff('day', lag(date) over w, date) as trend from hv where v is not null window w as (partition by reservoir_id order by date)),
ins as (select *, row_number() over w as i, date_diff('day', lag(date) over w, date) as gap, case when date >= sf and lag(date) over w <= s1 then (s - lag(s) over w) / date_diff('day', lag(date) over w, date) end as rt
  from kn where date >= frm window w as (partition by reservoir_id order by date)),
cor as (select reservoir_id, date, i, v as c from ins where i = 1 union all
  select n.reservoir_id, n.date, n.i, case when coalesce(abs(n.trend - n.rt) > 10, false) then c.c + n.rt * n.gap else n.v end from cor c join ins n on n.reservoir_id = c.reservoir_id and n.i = c.i + 1),
allr as (select h.reservoir_id, h.date, h.sf, h.o0, c.c, date_diff('day', lag(h.date) over w, h.date) as gap, case when h.date >= sf and lag(h.date) over w <= s1 then (s - lag(s) over w) / date_diff('day', lag(h.date) over w, h.date) end as rt,
  min(c.date) over (partition by h.reservoir_id) as c0 from hv h left join cor c on c.reservoir_id = h.reservoir_id and c.date = h.date window w as (partition by h.reservoir_id order by h.date)),
kept as (select *, row_number() over (partition by reservoir_id order by date) as i from allr where date >= greatest(coalesce(c0, sf), sf, o0)),
fil as (select reservoir_id, date, i, c as filled from kept where i = 1 union all
  select k.reservoir_id, k.date, k.i, coalesce(k.c, f.filled + k.rt * k.gap) from fil f join kept k on k.reservoir_id = f.reservoir_id and k.i = f.i + 1)"""


@query("trend_correction", check_sql("merged sar_daily reservoirs", f"""with {SAR_CLEAN}, {CORRECTION} select k.reservoir_id, k.date, round(k.c, 6) + 0.0 as corrected_area, round(f.filled, 6) + 0.0 as filled_area
from kept k join fil f using (reservoir_id, date)""", recursive=True))
def trend_correction(t: Tables):
    """Deviation filter, trend correction and filling against the cleaned radar series."""
    opt = fusion.merge_sensors(fusion.clean_optical(t.optical, R), R).join(t.reservoirs.select(*R, "nominal_area"), R)
    out = fusion.trend_correction(opt, fusion.clean_sar(t.sar_daily, t.reservoirs, R), R, fusion.area_threshold(F.col("nominal_area")))
    return out.select(*R, "date", r("corrected_area"), r("filled_area"))


@query("sign_correction", check_sql("merged sar_daily reservoirs", f"""with sarc as (select reservoir_id, date, sarea from sar_daily), {CORRECTION},
own as (select k.*, case when coalesce(n.trend * k.rt < 0, false) then null else k.c end as v from kept k left join kn n using (reservoir_id, date)),
sg as (select reservoir_id, date, i, v from own where i = 1 union all
  select o.reservoir_id, o.date, o.i, coalesce(o.v, s.v + o.rt * o.gap) from sg s join own o on o.reservoir_id = s.reservoir_id and o.i = s.i + 1)
select reservoir_id, date, round(v, 6) + 0.0 as sign_area from sg""", recursive=True))
def sign_correction(t: Tables):
    """Radar trend wherever the optical trend has the opposite sign."""
    opt = fusion.merge_sensors(fusion.clean_optical(t.optical, R), R).join(t.reservoirs.select(*R, "nominal_area"), R)
    out = fusion.trend_correction(opt, t.sar_daily.withColumnRenamed("sarea", "area"), R, fusion.area_threshold(F.col("nominal_area")))
    return fusion.sign_correction(out, R).select(*R, "date", r("sign_area"))


@query("screen_write_back", check_sql("sensor_daily sar_daily reservoirs", f"""with {ALIGNED}, {OUTLIER}, s2 as (select reservoir_id, date, water_area from sensor_daily where sat = 's2')
select s.reservoir_id, s.date, s.water_area as area_fused, round(o.optical, 6) as area, coalesce(date_diff('day', lag(s.date) over (partition by s.reservoir_id order by s.date), s.date), 0) as days_passed
from s2 s left join outl o on o.reservoir_id = s.reservoir_id and o.date = s.date"""))
def screen_write_back(t: Tables):
    """Screened areas put into a series that keeps its areas from before."""
    fused = t.s2_daily
    screened = screens.outlier_screen(aligned(t), R, screens.limit("outlier", 5)).select(*R, "date", F.col("optical").alias("area"))
    out = screens.write_back(fused, screened, R)
    return out.select(*R, "date", "area_fused", r("area"), F.col("days_passed").cast("bigint").alias("days_passed"))


FUSED = """first as (select m.reservoir_id, min(m.date) as o0, any_value(s.s0) as s0 from merged m join reservoirs using (reservoir_id) left join (select reservoir_id, min(date) as s0 from sarc group by 1) s using (reservoir_id) group by 1),
meth as (select *, case when s0 is null then 'Optical' when date_diff('day', o0, s0) > 15 then 'Combine' else 'Trend' end as method from first),
rowsx as (select m.*, t.method, t.method = 'Optical' or (t.method = 'Combine' and m.date <= t.s0) as alone, k.reservoir_id is not null as keep, f.filled,
  date_diff('day', lag(m.date) over (partition by m.reservoir_id order by m.date), m.date) as gap
  from merged m join meth t using (reservoir_id) left join kept k on k.reservoir_id = m.reservoir_id and k.date = m.date left join fil f on f.reservoir_id = m.reservoir_id and f.date = m.date),
wei as (select *, count(*) over (partition by reservoir_id, alone) as na, sum(area * (101 - cloud_percent)) over w / sum(101 - cloud_percent) over w as sm, count(area) over w = count(*) over w as complete
  from rowsx where alone or keep window w as (partition by reservoir_id, alone order by date rows between 1 preceding and 1 following)),
raw as (select *, case when alone then case when na > 7 and complete then sm end else filled end as v, case when alone then coalesce(gap, 0) else gap end as dp,
  row_number() over (partition by reservoir_id order by date) as i, count(*) over (partition by reservoir_id) as n from wei),
ser as (select reservoir_id, list(v order by i) as a from raw group by 1),
fused as (select r.reservoir_id, date, sat, area, quality, dp as days_passed, method, case when method <> 'Trend' and n > case when method = 'Optical' then 7 else 9 end then case
  when i = 1 then (39*a[1] + 8*a[2] - 4*a[3] - 4*a[4] + a[5] + 4*a[6] - 2*a[7]) / 42
  when i = 2 then (8*a[1] + 19*a[2] + 16*a[3] + 6*a[4] - 4*a[5] - 7*a[6] + 4*a[7]) / 42
  when i = 3 then (-4*a[1] + 16*a[2] + 19*a[3] + 12*a[4] + 2*a[5] - 4*a[6] + a[7]) / 42
  when i = n then (39*a[n] + 8*a[n-1] - 4*a[n-2] - 4*a[n-3] + a[n-4] + 4*a[n-5] - 2*a[n-6]) / 42
  when i = n - 1 then (8*a[n] + 19*a[n-1] + 16*a[n-2] + 6*a[n-3] - 4*a[n-4] - 7*a[n-5] + 4*a[n-6]) / 42
  when i = n - 2 then (-4*a[n] + 16*a[n-1] + 19*a[n-2] + 12*a[n-3] + 2*a[n-4] - 4*a[n-5] + a[n-6]) / 42
  else (-2*a[i-3] + 3*a[i-2] + 6*a[i-1] + 7*a[i] + 6*a[i+1] + 3*a[i+2] - 2*a[i+3]) / 21 end else v end as filled_area from raw r join ser using (reservoir_id))"""
FUSED_VIEWS = f"with {SAR_CLEAN}, {CORRECTION}, {FUSED}"


@query("fusion", check_sql("merged sar_daily reservoirs", FUSED_VIEWS + """ select reservoir_id, date, sat, round(area, 6) + 0.0 as area, quality, days_passed, round(filled_area, 6) + 0.0 as filled_area, method from fused""", recursive=True))
def fuse(t: Tables):
    """Fused area of every reservoir with its method."""
    out = fusion.fuse(t.optical, t.sar_daily, t.reservoirs, R)
    return out.select(*R, "date", "sat", r("area"), "quality", "days_passed", r("filled_area"), "method")


LATE = "with late as (select reservoir_id, date + cast(reservoir_id % 3 * 20 as int) as date, sarea from sar_daily where reservoir_id % 7 <> 0), " + FUSED_VIEWS[5:].replace("from sar_daily", "from late")


@query("fusion_methods", check_sql("merged sar_daily reservoirs", LATE + " select method, count(distinct reservoir_id) as n, round(sum(filled_area), 3) as filled_area from fused group by 1", recursive=True))
def fusion_methods(t: Tables):
    """Reservoirs per method, where radar begins later for two thirds of them and is missing for some."""
    rid = F.col("reservoir_id")
    late = t.sar_daily.where(rid % 7 != 0).withColumn("date", F.date_add("date", (rid % 3 * 20).cast("int")))
    fused = fusion.fuse(t.optical, late, t.reservoirs, R)
    return fused.groupBy("method").agg(F.countDistinct(*R).alias("n"), F.round(F.sum("filled_area"), 3).alias("filled_area"))


@query("fusion_status", check_sql("merged sar_daily reservoirs", LATE + " select method, count(distinct reservoir_id) as n from fused group by 1", recursive=True))
def fusion_status(t: Tables):
    """The same as status counts."""
    from lakeledger.operators.balance import status_counts
    rid = F.col("reservoir_id")
    late = t.sar_daily.where(rid % 7 != 0).withColumn("date", F.date_add("date", (rid % 3 * 20).cast("int")))
    return status_counts(fusion.fuse(t.optical, late, t.reservoirs, R).select(*R, "method").distinct(), "method")
