"""Weather grid and geometry queries."""

from pyspark.sql import functions as F

from lakeledger.functions import columns as fn
from lakeledger.operators import forcings, spatial
from lakeledger.plans.registry import query
from lakeledger.plans.tables import Tables, check_sql

CELL = ["cell_x", "cell_y"]


@query("wind_swap", check_sql("forcing", """select cell_x, cell_y, date, greatest(tmax, tmin) as tmax, least(tmax, tmin) as tmin, round(0.75 * sqrt(u * u + v * v), 6) as wind from forcing"""))
def wind_swap(t: Tables):
    """Wind speed from components; temperatures put the right way round."""
    f = forcings.check_temperatures(forcings.with_wind(t.forcing))
    return f.select(*CELL, "date", "tmax", "tmin", F.round("wind", 6).alias("wind"))


@query("combine_variables", check_sql("forcing", """select date, cell_x, cell_y, case when precip > 1 then precip end as precip, case when tmax > 20 then tmax end as tmax from forcing"""))
def combine_variables(t: Tables):
    """Separate variable tables put together by date and cell; a cell and day that both leave out is in the third."""
    f = t.forcing
    return forcings.combine({"precip": f.where("precip > 1").select("date", *CELL, "precip"), "tmax": f.where("tmax > 20").select("date", *CELL, "tmax"),
                             "tmin": f.select("date", *CELL, "tmin")}).drop("tmin")


@query("daily_means", check_sql("", """select l_suppkey as cell, cast(l_shipdate as date) as date, round(avg(100.0 - l_discount * 100), 6) as pressure from lineitem group by 1, 2"""))
def daily_means(t: Tables):
    """Sub-daily pressure averaged per day."""
    p = t.raw("lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_shipdate").alias("ts"), (F.lit(100.0) - F.col("l_discount") * 100).alias("pressure"))
    return forcings.daily_mean(p, ["cell"], "ts", ["pressure"]).select("cell", "date", F.round("pressure", 6).alias("pressure"))


CLIM = """logs as (select *, weekofyear(date) as week, case when precip > 0 then ln(precip) end as lp from forcing),
clim as (select cell_x, cell_y, week, avg(lp) as m, stddev_pop(lp) as s from logs group by 1, 2, 3)"""


@query("iso_week_climatology", check_sql("forcing", f"with {CLIM} select cell_x, cell_y, week, round(m, 6) + 0.0 as log_mean, round(s, 6) as log_std from clim"))
def iso_week_climatology(t: Tables):
    """Weekly log-precipitation statistics per cell."""
    c = forcings.week_climatology(t.forcing)
    return c.select(*CELL, F.col("week").cast("bigint").alias("week"), F.round("log_mean", 6).alias("log_mean"), F.round("log_std", 6).alias("log_std"))


@query("climatology_correction", check_sql("forcing", f"""with {CLIM} select l.cell_x, l.cell_y, l.date, round(case when abs((lp - m) / nullif(s, 0)) > 2 then exp(m) else precip end, 8) as precip
from logs l join clim using (cell_x, cell_y, week)"""))
def climatology_correction(t: Tables):
    """Precipitation beyond two deviations of its week replaced by the weekly mean."""
    f = t.forcing.select(*CELL, "date", "precip")
    out = forcings.climatology_correction(f, forcings.week_climatology(f), limit=2.0)
    return out.select(*CELL, "date", F.round("precip", 8).alias("precip"))


def axis_sql(src: str, part: str, x: str, limit: str = "") -> str:
    """SQL: linear fill with extrapolation along one axis of ``src`` (column v); a known point also carries the one
    before it (x2, v2) and the one after it (x3, v3)."""
    known = f"""select {part}, {x}, v, lag({x}) over w as x2, lag(v) over w as v2, lead({x}) over w as x3, lead(v) over w as v3 from {src} where v is not null window w as (partition by {part} order by {x})"""
    line = lambda a, b, c, d: f"{b} + ({d} - {b}) * ({x} - {a}) / ({c} - {a})"
    return f"""(select * exclude (v, k, p, n, i, pi), coalesce(v, case when {limit or 'true'} then
  case when p.x is not null and n.x is not null then {line('p.x', 'p.v', 'n.x', 'n.v')}
       when p.x is not null and p.x2 is not null then {line('p.x', 'p.v', 'p.x2', 'p.v2')}
       when n.x is not null and n.x3 is not null then {line('n.x', 'n.v', 'n.x3', 'n.v3')} end end) as v
  from (select *, i - coalesce(pi, 0) as run from (select *, last_value(k ignore nulls) over up as p, first_value(k ignore nulls) over dn as n, max(case when v is not null then i end) over up as pi
    from (select s.*, row_number() over (partition by {part} order by {x}) as i, case when s.v is not null then struct_pack(x := {x}, v := s.v, x2 := k.x2, v2 := k.v2, x3 := k.x3, v3 := k.v3) end as k
      from {src} s left join ({known}) k using ({part}, {x}))
    window up as (partition by {part} order by {x} rows between unbounded preceding and 1 preceding), dn as (partition by {part} order by {x} rows between 1 following and unbounded following))) q)"""


@query("grid_impute", check_sql("forcing", f"""with cells as (select distinct cell_x, cell_y from forcing),
days as (select cast(unnest(generate_series(cast(min(date) as timestamp), cast(max(date) as timestamp), interval 1 day)) as date) as date from forcing),
g as (select c.cell_x, c.cell_y, d.date, date_diff('day', date '1970-01-01', d.date) as dn, f.precip as v, f.precip as raw from cells c cross join days d left join forcing f using (cell_x, cell_y, date)),
a as (select * exclude (run) from {axis_sql('g', 'cell_x, cell_y', 'dn', 'run <= 30')}),
b as (select * exclude (run) from {axis_sql('a', 'date, cell_y', 'cell_x')}),
c as (select * exclude (run) from {axis_sql('b', 'date, cell_x', 'cell_y')})
select cell_x, cell_y, date, round(case when cell_x + cell_y < 15 then v else raw end, 3) + 0.0 as precip from c"""))
def grid_impute(t: Tables):
    """The full grid of all days filled along time, longitude and latitude inside the basin."""
    f = t.forcing.select(*CELL, "date", "precip")
    first, last = f.agg(F.min("date"), F.max("date")).first()
    grid = forcings.full_grid(f, f.select(*CELL).distinct(), ["precip"], str(first), str(last))
    grid = grid.withColumn("extent", F.col("cell_x") + F.col("cell_y") < 15)
    return forcings.impute(grid, ["precip"]).select(*CELL, "date", F.round("precip", 3).alias("precip"))


@query("state_split", check_sql("forcing", """select case when date < date '1998-01-01' then 'state' else 'run' end as part, count(*) as n, min(date) as first, max(date) as last
from forcing where date >= date '1998-01-01' - 90 and date <= date '1998-06-30' group by 1"""))
def state_split(t: Tables):
    """Ninety days of state before the run, and the run."""
    state, run = forcings.state_and_forcing(t.forcing, "1998-01-01", "1998-06-30")
    both = state.select("date", F.lit("state").alias("part")).unionByName(run.select("date", F.lit("run").alias("part")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))


@query("extend_history", check_sql("forcing", """with o as (select * from forcing where date < date '1999-01-01' - cast(cell_x * 9 + cell_y as int) and cell_x + cell_y > 0),
l as (select cell_x, cell_y, max(date) as last from o group by 1, 2)
select cell_x, cell_y, date, round(precip, 8) as precip from o where date >= date '1999-01-01' - 120 union all
select f.cell_x, f.cell_y, date, round(precip, 8) from forcing f left join l using (cell_x, cell_y) where last is null or date > last"""))
def extend_history(t: Tables):
    """Recent history of every cell followed by its rows not yet stored; cells end on different days, one is new."""
    f = t.forcing.select(*CELL, "date", F.round("precip", 8).alias("precip"))
    stored = f.where((F.col("date") < F.date_sub(F.lit("1999-01-01").cast("date"), F.col("cell_x") * 9 + F.col("cell_y"))) & (F.col("cell_x") + F.col("cell_y") > 0))
    return forcings.extend_history(stored, f, "1999-01-01", keys=CELL)


@query("keep_recent", check_sql("forcing", """select cell_x, cell_y, date, tmax from (select *, max(date) over (partition by cell_x, cell_y) as last from forcing
  where date < date '2001-01-01' - cast(cell_x * 31 as int)) where date > last - 365"""))
def keep_recent(t: Tables):
    """The last year of every cell; cells end on different days."""
    f = t.forcing.select(*CELL, "date", "tmax").where(F.col("date") < F.date_sub(F.lit("2001-01-01").cast("date"), F.col("cell_x") * 31))
    return forcings.keep_recent(f, keys=CELL)


@query("forecast_calendar", check_sql("reservoirs", """select reservoir_id, date '2024-01-20' as basedate, cast(unnest(generate_series(timestamp '2024-01-20', timestamp '2024-02-04', interval 1 day)) as date) as date from reservoirs"""))
def forecast_calendar(t: Tables):
    """Forecast dates of every reservoir."""
    return forcings.forecast_days(t.reservoirs.select("reservoir_id", F.lit("2024-01-20").cast("date").alias("basedate")))


@query("reduce_grids", check_sql("forcing", "select cell_x, cell_y, max(tmax) as tmax from (select cell_x, cell_y, tmax from forcing where date < date '1998-01-01' union all select cell_x, cell_y, tmin from forcing) group by 1, 2"))
def reduce_grids(t: Tables):
    """Elementwise maximum over several grids."""
    f = t.forcing
    return forcings.reduce_grids([f.where("date < '1998-01-01'"), f.select(*CELL, F.col("tmin").alias("tmax"))], "tmax", F.max)


NEAREST = """p as (select cell_x, cell_y, date, tmax, cell_x * 0.1 + 0.03 as lon, cell_y * 0.1 + 0.07 as lat from forcing), src as (select distinct lon, lat from p),
tg as (select cast(i as int) as cell_x, cast(j as int) as cell_y, {west} + (i + 0.5) * {step} as x, {west} + (j + 0.5) * {step} as y from range({n}) a(i), range({n}) b(j)),
near as (select tg.cell_x, tg.cell_y, lon, lat from tg cross join src qualify row_number() over (partition by tg.cell_x, tg.cell_y
  order by round((lon - x) * (lon - x) + (lat - y) * (lat - y), 12), lon, lat) = 1)
select p.date, near.cell_x, near.cell_y, p.tmax from near join p using (lon, lat)"""


def placed(t: Tables):
    return t.forcing.select("date", "tmax", (F.col("cell_x") * 0.1 + 0.03).alias("lon"), (F.col("cell_y") * 0.1 + 0.07).alias("lat"))


@query("regrid", check_sql("forcing", "with " + NEAREST.format(west=0.1, step=0.25, n=3)))
def regrid(t: Tables):
    """Nearest source cell on a coarser grid."""
    return spatial.regrid(placed(t), ["date"], ["tmax"], "lon", "lat", 0.25, (0.1, 0.1, 0.85, 0.85))


@query("regrid_finer", check_sql("forcing", "with " + NEAREST.format(west=-0.25, step=0.0625, n=24)))
def regrid_finer(t: Tables):
    """Nearest source cell on a finer grid that also reaches beyond the sources."""
    return spatial.regrid(placed(t), ["date"], ["tmax"], "lon", "lat", 0.0625, (-0.25, -0.25, 1.25, 1.25))


# --- scalar functions -----------------------------------------------------------------------

@query("scalar_functions", check_sql("", """select o_orderkey, round(date_diff('second', timestamp '2000-01-01', o_orderdate) / 86400 + 51544, 6) as mjd,
  round((date_diff('second', timestamp '2000-01-01', o_orderdate) / 86400 + 51544 + 2108 - 50000) / 365.25 + 1990, 8) as decimal_year,
  abs(date_diff('day', cast(o_orderdate as date), date '1998-06-01')) as days, day(o_orderdate) % 30 / 30.0 + floor(day(o_orderdate) / 30) as month_part,
  weekofyear(o_orderdate) as week, dayofyear(o_orderdate) as yday, (year(o_orderdate) % 4 = 0 and year(o_orderdate) % 100 <> 0) or year(o_orderdate) % 400 = 0 as leap,
  o_orderkey || '_' || replace(o_orderpriority, ' ', '_') as station, lpad(cast(o_custkey % 1000 as varchar), 3, '0') as padded,
  case when o_custkey * 1.7 % 360 >= 180 then round(o_custkey * 1.7 % 360 - 360, 6) else round(o_custkey * 1.7 % 360, 6) end as lon,
  round(sign(o_totalprice - 200000) * ceil(round(abs(o_totalprice - 200000) * 10, 6)) / 10, 2) + 0.0 as away,
  sign(o_totalprice / 1000 - 200) * floor(abs(o_totalprice / 1000 - 200) * 100) / 100 + 0.0 as cell_key,
  case when (case o_custkey % 4 when 1 then 2 else o_custkey % 4 end) = 2 then 3 else o_custkey % 4 end as code from orders"""))
def scalar_functions(t: Tables):
    """Date, string, rounding, wrapping and recoding functions over the orders."""
    o, d = t.raw("orders"), F.to_date("o_orderdate")
    seconds = F.datediff(d, F.lit("2000-01-01")).cast("double") * 86400
    mjd = fn.mjd_from_seconds(seconds)
    part = fn.month_fraction(d)
    price = F.col("o_totalprice")
    return o.select(
        "o_orderkey", F.round(mjd, 6).alias("mjd"), F.round(fn.decimal_year_from_mjd(mjd), 8).alias("decimal_year"),
        fn.days_between(d, F.lit("1998-06-01").cast("date")).cast("bigint").alias("days"),
        (F.dayofmonth(d) % 30 / F.lit(30.0) + F.floor(part)).alias("month_part"),
        F.weekofyear(d).cast("bigint").alias("week"), F.dayofyear(d).cast("bigint").alias("yday"), fn.is_leap_year(F.year(d)).alias("leap"),
        fn.station_name(F.col("o_orderkey"), F.col("o_orderpriority")).alias("station"), fn.padded(F.col("o_custkey") % 1000).alias("padded"),
        F.round(fn.wrap_longitude(F.col("o_custkey") * F.lit(1.7) % 360), 6).alias("lon"),
        F.round(F.signum(price - 200000) * F.ceil(F.round(F.abs(price - 200000) * 10, 6)) / 10, 2).alias("away"),
        fn.truncated_key(price / 1000 - 200).alias("cell_key"),
        fn.recode_in_order(F.col("o_custkey") % 4, [(1, 2), (2, 3)]).alias("code"))


@query("round_away", check_sql("s2_daily", """select reservoir_id, date, sign(area / 7) * ceil(abs(area / 7) * 100000) / 100000 as up5, floor(area / 3 + 0.5) as cells from s2_daily"""))
def round_away(t: Tables):
    """Rounding away from zero and half-up cell counts."""
    a = F.col("area")
    return t.s2_daily.select("reservoir_id", "date", fn.round_away(a / 7, 5).alias("up5"), fn.half_up_count(a / 3).cast("double").alias("cells"))


# --- geometry -------------------------------------------------------------------------------

@query("point_in_polygon", check_sql("polygon points", "select point, id from points join polygon on x > x0 and x < x0 + 1 and y > y0 and y < y0 + 1"))
def point_in_polygon(t: Tables):
    """Points inside unit squares by crossing count."""
    return spatial.points_in_polygons(t.points, t.polygon_edges, "point")


@query("nearest_cell", check_sql("points", """with g as (select n_nationkey, n_nationkey % 5 + 0.5 as cx, floor(n_nationkey / 5) + 0.5 as cy from nation where n_nationkey % 7 <> 3)
select point, n_nationkey from points cross join g qualify row_number() over (partition by point order by round((x - cx) * (x - cx) + (y - cy) * (y - cy), 12), cx, cy) = 1"""))
def nearest_cell(t: Tables):
    """Cell nearest to each point, in a grid with holes; some points lie outside."""
    k = F.col("n_nationkey")
    cells = t.raw("nation").where(k % 7 != 3).select(k, (k % 5 + 0.5).alias("cx"), (F.floor(k / 5) + 0.5).alias("cy"))
    return spatial.nearest_cell(t.points, cells, ["point"], "x", "y", "cx", "cy").select("point", "n_nationkey")


@query("nearest_cell_far", check_sql("points flow_dir", """with t as (select distinct x * 0.15 as cx, y * 0.2 as cy, x * 1000 + y as cell from flow_dir),
c as (select * from t union all select cx + 1000, cy - 800, cell + 1000000 from t), p as (select point, x, y from points union all select point + 1000000, x + 300, y + 40 from points)
select point, cell from p cross join c qualify row_number() over (partition by point order by round((x - cx) * (x - cx) + (y - cy) * (y - cy), 12), cx, cy) = 1"""))
def nearest_cell_far(t: Tables):
    """Cells in two places far apart, and as many points far from both as next to one."""
    moved = lambda df, x, y, ident, dx, dy: df.unionByName(df.select((F.col(ident) + 1000000).alias(ident), (F.col(x) + dx).alias(x), (F.col(y) + dy).alias(y)))
    cells = t.flow_dir.select((F.col("x") * 1000 + F.col("y")).alias("cell"), (F.col("x") * 0.15).alias("cx"), (F.col("y") * 0.2).alias("cy")).distinct()
    return spatial.nearest_cell(moved(t.points.select("point", "x", "y"), "x", "y", "point", 300, 40), moved(cells, "cx", "cy", "cell", 1000, -800),
                                ["point"], "x", "y", "cx", "cy").select("point", "cell")


@query("cells_or_nearest", check_sql("polygon", """with cell as (select distinct cast(p_size % 9 as int) as i, cast(floor(p_size / 9) as int) as j from part),
c as (select i * 100 + j as cell, i, j, 0.6 * i + 0.3 as x, 0.9 * j + 0.13 as y from cell),
far as (select id, x0, y0 from polygon union all select id + 100, x0 + 40, y0 - 30 from polygon where id % 6 = 0),
ins as (select cell, id from c join far on x > x0 and x < x0 + 1 and y > y0 and y < y0 + 1),
em as (select id, x0 + 0.5 as cx, y0 + 0.5 as cy from far where id not in (select id from ins)),
ne as (select cell, id from em cross join c qualify row_number() over (partition by id order by round((x - cx) * (x - cx) + (y - cy) * (y - cy), 12), x, y) = 1)
select cell, id, 'inside' as method from ins union all select cell, id, 'nearest' from ne"""))
def cells_or_nearest(t: Tables):
    """Cells of every polygon, with the cell nearest the centroid where none lies inside; some polygons are far from all cells."""
    s, e = F.col("p_size"), t.polygon_edges
    c = t.raw("part").select((s % 9).cast("int").alias("i"), F.floor(s / 9).cast("int").alias("j")).distinct()
    c = c.select((F.col("i") * 100 + F.col("j")).alias("cell"), (F.col("i") * 0.6 + 0.3).alias("x"), (F.col("j") * 0.9 + 0.13).alias("y"))
    far = e.where("id % 6 = 0").select((F.col("id") + 100).alias("id"), "seq", *[(F.col(n) + d).alias(n) for n, d in (("x1", 40), ("y1", -30), ("x2", 40), ("y2", -30))])
    return spatial.cells_of_polygons(c, e.unionByName(far), "cell", "x", "y")


@query("track_crossing", check_sql("polygon", """with tr as (select s_suppkey as track, s_suppkey * 5.0 / (select count(*) from supplier) + 0.0131 as x from supplier)
select track, id, case when id = 7 then 1.25 else y0 end as min_lat, case when id = 7 then 1.75 else y0 + 1 end as max_lat from tr join polygon on x > x0 and x < x0 + 1"""))
def track_crossing(t: Tables):
    """Satellite tracks across polygons and the latitude range inside, with one range given by the user."""
    n = t.raw("supplier").agg(F.count(F.lit(1))).scalar()
    x = F.col("s_suppkey") * 5.0 / n + 0.0131
    tr = t.raw("supplier").select(F.col("s_suppkey").alias("track"), x.alias("x1"), F.lit(-0.5).alias("y1"), F.lit(5.5).alias("y2"))
    tr = tr.withColumn("x2", F.col("x1"))
    given = t.raw("nation").where("n_nationkey = 7").select(F.col("n_nationkey").alias("id"), F.lit(1.25).alias("min_lat"), F.lit(1.75).alias("max_lat"))
    return spatial.track_crossings(tr, t.polygon_edges, overrides=given)


HAV = "2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))"


@query("within_distance", check_sql("points", f"""with a as (select point, x as lon, y as lat from points), b as (select s_suppkey as dam, s_suppkey * 7 % 50 / 10.0 + 0.013 as lon, s_suppkey * 3 % 50 / 10.0 + 0.017 as lat from supplier)
select point, dam, round({HAV}, 3) as distance from a join b on abs(a.lat - b.lat) < 0.2 and abs(a.lon - b.lon) < 0.2 and {HAV} <= 15000"""))
def within_distance(t: Tables):
    """Terrain points within fifteen kilometres of each dam."""
    p = t.points.select("point", F.col("x").alias("lon"), F.col("y").alias("lat"))
    k = F.col("s_suppkey")
    dams = t.raw("supplier").select(k.alias("dam"), (k * 7 % 50 / 10.0 + 0.013).alias("lon"), (k * 3 % 50 / 10.0 + 0.017).alias("lat"))
    return spatial.within_distance(p, dams, "dam", 15000.0).select("point", "dam", F.round("distance", 3).alias("distance"))


@query("within_distance_line", check_sql("points", f"""with a as (select point, case when x > 2.5 then x - 182.5 else x + 177.5 end as lon, y as lat from points),
b as (select s_suppkey as dam, case when s_suppkey % 2 = 0 then 179.95 else -179.95 end as lon, s_suppkey * 3 % 50 / 10.0 + 0.017 as lat from supplier)
select point, dam, round({HAV}, 3) as distance from a join b on abs(a.lat - b.lat) < 0.2 and (abs(a.lon - b.lon) < 0.2 or abs(a.lon - b.lon) > 359.8) and {HAV} <= 15000"""))
def within_distance_line(t: Tables):
    """The same around the line of 180 degrees, with points and dams on both sides of it."""
    p = t.points.select("point", F.when(F.col("x") > 2.5, F.col("x") - 182.5).otherwise(F.col("x") + 177.5).alias("lon"), F.col("y").alias("lat"))
    k = F.col("s_suppkey")
    dams = t.raw("supplier").select(k.alias("dam"), F.when(k % 2 == 0, 179.95).otherwise(-179.95).alias("lon"), (k * 3 % 50 / 10.0 + 0.017).alias("lat"))
    return spatial.within_distance(p, dams, "dam", 15000.0).select("point", "dam", F.round("distance", 3).alias("distance"))


@query("within_box", check_sql("polygon points", "select point, id from points join polygon on x between x0 - 0.1 and x0 + 1.1 and y between y0 - 0.1 and y0 + 1.1"))
def within_box(t: Tables):
    """Points inside widened bounding boxes."""
    p = t.points.select("point", F.col("x").alias("lon"), F.col("y").alias("lat"))
    return spatial.within_box(p, spatial.polygon_boxes(t.polygon_edges), "id").select("point", "id")


@query("basin_grid", check_sql("polygon", """select id, i as "row", j as col, round(x0 + (j + 0.5) * 0.0625, 5) as lon, round(y0 + 1 - (i + 0.5) * 0.0625, 5) as lat
from polygon, range(16) a(i), range(16) b(j)"""))
def basin_grid(t: Tables):
    """Grid of every polygon's box at the common resolution."""
    return spatial.grid_cells(spatial.polygon_boxes(t.polygon_edges), ["id"])


@query("grid_row_col", check_sql("points", """select point, 10 - cast(floor((4.6 - y) / 0.5) as int) as "row", cast(floor((x + 0.2) / 0.5) as int) + 1 as col from points"""))
def grid_row_col(t: Tables):
    """Row counted from the bottom and column from one, of points inside and outside the grid."""
    row, col = spatial.row_col(F.col("x"), F.col("y"), -0.2, 4.6, 0.5, 10)
    return t.points.select("point", row.alias("row"), col.alias("col"))


@query("reservoir_weather", check_sql("forcing polygon", """with c as (select distinct cell_x, cell_y from forcing), m as (select cell_x, cell_y, id from c join polygon on cell_x / 2.0 + 0.2 > x0 and cell_x / 2.0 + 0.2 < x0 + 1
  and cell_y / 2.0 + 0.2 > y0 and cell_y / 2.0 + 0.2 < y0 + 1) select id, date, round(avg(precip) / 25.4, 4) as precip_inches, round(avg(tmax), 6) as tmax from forcing join m using (cell_x, cell_y) group by 1, 2"""))
def reservoir_weather(t: Tables):
    """Weather averaged over the cells of every polygon."""
    c = t.forcing.select(*CELL).distinct().select(*CELL, F.struct("cell_x", "cell_y").alias("cell"), (F.col("cell_x") / 2.0 + 0.2).alias("x"), (F.col("cell_y") / 2.0 + 0.2).alias("y"))
    m = spatial.points_in_polygons(c, t.polygon_edges, "cell").select("id", "cell.cell_x", "cell.cell_y")
    out = forcings.cell_mean(t.forcing, m, "id", ["precip", "tmax"])
    return out.select("id", "date", F.round(F.col("precip") / 25.4, 4).alias("precip_inches"), F.round("tmax", 6).alias("tmax"))
