"""Network, forecast, incremental, file and stream queries."""

from pyspark.sql import functions as F

from lakeledger.functions import columns
from lakeledger.operators import forecast, forcings, incremental, network, products
from lakeledger.operators.series import interval_sums
from lakeledger.plans.registry import query
from lakeledger.plans.tables import Tables, check_sql
from lakeledger.session import scratch_table
from lakeledger.sources import committed, readers, schemas, writers
from lakeledger.streaming import daily

R = ["reservoir_id"]

# --- network --------------------------------------------------------------------------------

NEXT = """nx as (select *, x + case when code in (2, 3, 4) then 1 when code in (6, 7, 8) then -1 else 0 end as tx,
  y + case when code in (4, 5, 6) then 1 when code in (8, 1, 2) then -1 else 0 end as ty from flow_dir),
walk as (select n.node as src, c.x, c.y from nx n join flow_dir c on c.x = n.tx and c.y = n.ty where n.is_dam
  union select w.src, c.x, c.y from walk w join nx n on n.x = w.x and n.y = w.y and not n.is_dam join flow_dir c on c.x = n.tx and c.y = n.ty)"""


@query("flow_trace", check_sql("flow_dir", f"with {NEXT} select distinct w.src, d.node as dst from walk w join flow_dir d on d.x = w.x and d.y = w.y and d.is_dam where w.src <> d.node", recursive=True))
def flow_trace(t: Tables):
    """Network edges from a flow-direction grid with loops."""
    return network.trace_flow(t.flow_dir)


@query("network_levels", check_sql("edges", """with lv as (select s_suppkey as node, 0 as level from supplier union select e.dst, l.level + 1 from lv l join edges e on e.src = l.node where e.src <> e.dst)
select node, max(level) as level from lv group by 1""", recursive=True))
def network_levels(t: Tables):
    """Longest path above each node."""
    return network.levels(t.raw("supplier").select(F.col("s_suppkey").alias("node")), t.edges)[0]


def state(t: Tables):
    return t.node_days.withColumn("obs_outflow", F.when(F.col("natural") % 3 != 0, F.col("natural") * 0.9)).withColumn(
        "obs_inflow", F.when(F.col("natural") % 2 != 0, F.col("natural") * 1.1))


STATE = """st as (select node, date, natural_flow as t, storage_change as ds, case when natural_flow % 3 <> 0 then natural_flow * 0.9 end as oo,
  case when natural_flow % 2 <> 0 then natural_flow * 1.1 end as oi from node_days),
deg as (select dst as node, count(*) as k from edges where src <> dst group by 1)"""
COLS = ["natural_runoff", "regulated_runoff", "inflow", "outflow", "regulation"]


def unrolled(depth: int, lag: str = "0", head_out: str = "greatest(t - ds, 0)", head_in: str = "greatest(t, 0)") -> str:
    """SQL: one statement per level, as deep as the binary tree of the check data."""
    out = [f"""lv as (select s_suppkey as node, floor(log2(s_suppkey + 0.5)) as up from supplier),
h as (select e.src, e.dst, e.travel_time from edges e where src <> dst),
lev as (select node, max(l) as l from (select s_suppkey as node, 0 as l from supplier union all select node, l from paths) group by 1),
b0 as (select node, date, t, ds, t as nat, cast(0 as double) as reg, {head_in} as i, {head_out} as o from st where node in (select node from lev where l = 0))"""]
    for k in range(1, depth + 1):
        out.append(f"""u{k} as (select h.dst as node, date + cast({lag} as int) as date, count(*) as n, sum(o) as o, sum(t) as t, count(o) as co, count(t) as ct
  from b{k - 1} join h on h.src = b{k - 1}.node group by 1, 2),
b{k} as (select * from b{k - 1} union all select node, date, t, ds, nat, reg, greatest(nat + reg, 0), case when nat + reg is not null then greatest(greatest(nat + reg, 0) - ds, 0) end from (
  select s.node, s.date, s.t, s.ds, s.t - u.t as nat, u.o as reg from st s join lev on lev.node = s.node and lev.l = {k} join deg on deg.node = s.node
  left join (select node, date, case when n = co then o end as o, t, n from u{k}) u on u.node = s.node and u.date = s.date and u.n = deg.k))""")
    body = ",\n".join(out)
    return f"""{STATE}, paths as (select dst as node, 1 as l from edges where src <> dst union select e.dst, p.l + 1 from paths p join edges e on e.src = p.node where e.src <> e.dst),
{body} select node, date, round(nat, 6) + 0.0 as natural_runoff, round(reg, 6) + 0.0 as regulated_runoff, case when nat + reg is null then null else round(i, 6) end as inflow,
  round(o, 6) + 0.0 as outflow, case when nat + reg is null then null else round(t - i, 6) + 0.0 end as regulation from b{depth}"""


def rounded(df):
    return df.select("node", "date", *[F.round(c, 6).alias(c) for c in COLS])


@query("network_balance", check_sql("node_days edges", "with " + unrolled(7), recursive=True))
def network_balance(t: Tables):
    """Water balance from headwaters down."""
    return rounded(network.balance(t.edges, t.node_days))


@query("network_lag", check_sql("node_days edges", ("with " + unrolled(7, lag="h.travel_time")).replace("select node, date, natural_flow as t", "select node, date '2000-01-01' + cast((year(date) - 1995) * 12 + month(date) as int) as date, natural_flow as t"), recursive=True))
def network_lag(t: Tables):
    """The same with travel times in days, each month of the data standing for one day."""
    month = (F.year("date") - 1995) * 12 + F.month("date")
    days = t.node_days.withColumn("date", F.date_add(F.lit("2000-01-01").cast("date"), month))
    return rounded(network.balance(t.edges, days, "wb_travel_time"))


HEAD_OUT = "coalesce(oo, case when oi is not null then greatest(oi - ds, 0) end, greatest(t - ds, 0))"


@query("network_head_outflow", check_sql("node_days edges", "with " + unrolled(7, head_out=HEAD_OUT, head_in=f"{HEAD_OUT} + ds"), recursive=True))
def network_head_outflow(t: Tables):
    """Observed outflow at head dams."""
    return rounded(network.balance(t.edges, state(t), "wb_obs_outflow_upstream"))


HEAD_IN = "case when oi is not null then greatest(oi - ds, 0) end"


@query("network_head_inflow", check_sql("node_days edges", "with " + unrolled(7, head_out=HEAD_IN, head_in=f"case when oi is not null then greatest({HEAD_IN} + ds, 0) end").replace(
    "case when nat + reg is null then null else round(i, 6) end", "round(i, 6)").replace("case when nat + reg is null then null else round(t - i, 6) + 0.0 end", "round(t - i, 6) + 0.0").replace(
    "greatest(nat + reg, 0), case", "case when nat + reg is not null then greatest(nat + reg, 0) end, case"), recursive=True))
def network_head_inflow(t: Tables):
    """Observed inflow at head dams."""
    return rounded(network.balance(t.edges, state(t), "wb_obs_inflow_upstream"))


@query("network_obs", check_sql("node_days edges", f"""with {STATE}, u as (select e.dst as node, date, count(*) as n, case when count(oo) = count(*) then sum(oo) end as o, sum(t) as t from st join edges e on e.src = st.node and e.src <> e.dst group by 1, 2),
j as (select s.node, s.date, s.t, s.ds, case when u.n is null then s.t else s.t - u.t end as nat, case when u.n is null then 0 else u.o end as reg from st s left join u using (node, date))
select node, date, round(nat, 6) + 0.0 as natural_runoff, round(reg, 6) + 0.0 as regulated_runoff, case when nat + reg is not null then round(greatest(nat + reg, 0), 6) end as inflow,
  case when nat + reg is not null then round(greatest(greatest(nat + reg, 0) - ds, 0), 6) + 0.0 end as outflow, case when nat + reg is not null then round(t - greatest(nat + reg, 0), 6) + 0.0 end as regulation from j"""))
def network_obs(t: Tables):
    """Balance with observed outflow above every node."""
    return rounded(network.balance(t.edges, state(t), "wb_obs_outflow"))


@query("network_forcings", check_sql("flow s2_daily", """with i as (select reservoir_id as node, date, streamflow * 86400 as natural_flow from flow),
b as (select reservoir_id as node, min(date) as d0, max(date) as d1 from s2_daily group by 1),
cal as (select node, cast(unnest(generate_series(cast(d0 as timestamp), cast(d1 as timestamp), interval 1 day)) as date) as date from b),
j as (select c.node, c.date, s.area as v from cal c left join s2_daily s on s.reservoir_id = c.node and s.date = c.date),
g as (select *, count(v) over (partition by node order by date desc) as grp from j),
s as (select node, date, avg(coalesce(v, 0)) over (partition by node, grp) as storage_change from g),
f as (select coalesce(i.node, s.node) as node, coalesce(i.date, s.date) as date, natural_flow, storage_change from i full join s on i.node = s.node and i.date = s.date)
select node, cast(date_trunc('week', date) as date) + 6 as period_end, round(avg(natural_flow) * count(*), 4) as natural_flow, round(avg(storage_change) * count(*), 6) as storage_change, count(*) as dt from f group by 1, 2"""))
def network_forcings(t: Tables):
    """Weekly runoff and storage-change volumes per node."""
    name = F.col("reservoir_id").cast("string").alias("name")
    nodes = t.reservoirs.select(F.col("reservoir_id").alias("node"), name)
    i = t.flow.select(name, "date", (F.col("streamflow") * 86400).alias("inflow"))
    s = t.s2_daily.select(name, "date", F.col("area").alias("ds"))
    out = network.node_forcings(i, s, nodes, "weekly")
    return out.select("node", "period_end", F.round("natural", 4).alias("natural_flow"), F.round("storage_change", 6).alias("storage_change"), "dt")


@query("regulated_nodes", check_sql("node_days edges", "select node, date, storage_change from node_days where node in (select src from edges) or node in (select dst from edges)"))
def regulated_nodes(t: Tables):
    """Rows of nodes that touch an edge."""
    return network.regulated_outputs(t.node_days, t.edges).select("node", "date", "storage_change")


@query("network_text_ids", check_sql("node_days edges", "with " + unrolled(7).replace("select node, date, round(nat", "select 'dam-' || node as node, date, round(nat"), recursive=True))
def network_text_ids(t: Tables):
    """The same balance where nodes have text ids."""
    name = lambda c: F.concat(F.lit("dam-"), F.col(c).cast("string")).alias(c)
    edges = t.edges.select(name("src"), name("dst"), "travel_time")
    return rounded(network.balance(edges, t.node_days.withColumn("node", name("node"))))


@query("node_elevation", check_sql("points flow_dir", """with t as (select distinct x * 0.15 as x, y * 0.2 as y, x * 7 + y * 3 as elevation from flow_dir)
select point as node, elevation from points p cross join t qualify row_number() over (partition by point order by round((p.x - t.x) * (p.x - t.x) + (p.y - t.y) * (p.y - t.y), 12), t.x, t.y) = 1"""))
def node_elevation(t: Tables):
    """Elevation of every node from the nearest terrain point."""
    terrain = t.flow_dir.select((F.col("x") * 0.15).alias("tx"), (F.col("y") * 0.2).alias("ty"), (F.col("x") * 7 + F.col("y") * 3).alias("elevation")).distinct()
    nodes = t.points.select(F.col("point").alias("node"), F.col("x").alias("lon"), F.col("y").alias("lat"))
    return network.node_elevation(nodes, terrain, terrain_x="tx", terrain_y="ty").select("node", F.col("elevation").cast("bigint").alias("elevation"))


@query("edge_lengths", check_sql("edges", """with n as (select s_suppkey as node, s_suppkey % 17 + 0.5 as lat, s_suppkey % 23 + 0.25 as lon from supplier)
select src, dst, round(2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))), 3) as length
from edges join n a on a.node = src join n b on b.node = dst"""))
def edge_lengths(t: Tables):
    """Great-circle length of every edge."""
    k = F.col("s_suppkey")
    n = t.raw("supplier").select(k.alias("node"), (k % 17 + 0.5).alias("lat"), (k % 23 + 0.25).alias("lon"))
    return network.edge_lengths(t.edges, n).select("src", "dst", F.round("length", 3).alias("length"))


# --- forecast -------------------------------------------------------------------------------

def forecast_inputs(t: Tables):
    base = F.lit("2024-01-10").cast("date")
    last = t.s2_daily.where(F.col("date") <= base).groupBy(*R).agg((F.max_by("area", "date") / 10).alias("last_area"))
    rid = F.col("reservoir_id")
    return last.select(*R, "last_area", *t.reservoir_columns(), base.alias("basedate"), (rid % 5 + 4.0).alias("last_evaporation"),
                       (rid % 20 + 20.0).alias("target_level"), F.when(rid % 3 != 0, rid % 4 + 2.0).alias("custom_mcm"),
                       (rid % 9 * 0.3).alias("room_percent"))


def run_forecast(t: Tables, *cases, legacy: bool = False):
    return forecast.forecast(t.flow, forecast_inputs(t), t.curve, R, ["curve_id"], rule=t.rule_curve, rule_keys=[], cases=cases, legacy=legacy,
                             target_level="target_level", custom_mcm="custom_mcm", room_percent="room_percent")


def case_rows(df):
    return df.select(*R, "label", "date", F.round(F.col("outflow") / 1e6, 11).alias("outflow_mcm"), F.round(F.col("dels") / 1e6, 11).alias("dels_mcm"),
                     F.round("elevation", 9).alias("elevation"), F.round("area", 12).alias("area"))


def case_sql(cases: str) -> str:
    return f"""with inp as (select reservoir_id, arg_max(area, date) / 10 as a0, 'Brand#' || (reservoir_id % 25 + 1) as curve_id, reservoir_id % 50 + 100.0 as smax,
  reservoir_id % 5 + 4.0 as mm, reservoir_id % 20 + 20.0 as wl, case when reservoir_id % 3 <> 0 then reservoir_id % 4 + 2.0 end as cust, reservoir_id % 9 * 0.3 as room
  from s2_daily where date <= date '2024-01-10' group by 1),
pts as (select curve_id, area, elevation, row_number() over w as rn, lead(area) over w as x1, lead(elevation) over w as z1 from curve window w as (partition by curve_id order by area, elevation)),
aseg as (select curve_id, area as x0, elevation as z0, x1, z1, case when rn = 1 then -1e300 else area end as lo, coalesce(x1, 1e300) as hi from pts),
zseg as (select curve_id, area as x0, elevation as z0, x1, z1, case when rn = 1 then -1e300 else elevation end as lo, coalesce(z1, 1e300) as hi from pts),
ev as (select *, mm * 0.001 * a0 * 1e6 as e from inp),
days as (select f.reservoir_id, f.date, streamflow * 86400 as q, row_number() over (partition by f.reservoir_id order by f.date) as i from flow f join inp using (reservoir_id)
  where f.date between date '2024-01-10' and date '2024-01-25'),
tot as (select reservoir_id, sum(q) - any_value(e) * count(*) as net, any_value(e) * count(*) as esum from days join ev using (reservoir_id) group by 1),
rc as (select list(s_by_smax order by month) as r from rule_curve),
p as (select ev.*, net, esum, case when x1 is null or x1 = x0 then z0 else z0 + (z1 - z0) / (x1 - x0) * (greatest(a0, x0) - x0) end as zstart,
  ((r[1] + (r[2] - r[1]) * 25 / 30.0) - (r[1] + (r[2] - r[1]) * 10 / 30.0)) * smax * 1e6 as target
  from ev join tot using (reservoir_id) cross join rc join aseg s on s.curve_id = ev.curve_id and a0 >= lo and a0 < hi),
c as ({cases}),
f as (select reservoir_id, label, scenario, value, curve_id, e, net, target, case when value - zstart > 0 then 0 else (value - zstart) * a0 * 1e6 + esum end as surplus, cast(0 as bigint) as i,
    date '2024-01-09' as date, a0 as area, zstart as seen, value as lft, cast(0 as double) as o, cast(0 as double) as ds, cast(0 as double) as z from c
  union all
  select m.reservoir_id, label, scenario, value, m.curve_id, e, net, target, surplus, ni, ndate,
    case when s.z1 is null then s.x0 else s.x0 + (s.x1 - s.x0) / (s.z1 - s.z0) * (greatest(m.nz, s.z0) - s.z0) end, m.zc, m.nl, m.no, m.nds, m.nz
  from (select *, zc + nds / (area * 1e6) as nz from (
    select f.*, d.i as ni, d.date as ndate, case when s.x1 is null or s.x1 = s.x0 then s.z0 else s.z0 + (s.z1 - s.z0) / (s.x1 - s.x0) * (greatest(f.area, s.x0) - s.x0) end as zc,
      case scenario when 'GC' then 0 when 'CL' then case when seen > value then case when surplus = 0 then q - e else q - surplus / 16 end else 0 end
        when 'RC' then case when net < target then 0 else (net - target) / 15 end
        else case when net < value then 0 else q - e - case when lft <= 0 then 0 when q - e <= lft then q - e else lft end end end as no,
      case scenario when 'GC' then q - e when 'CL' then case when seen > value then case when surplus = 0 then 0 else surplus / 16 - e end else q - e end
        when 'RC' then case when net < target then q - e else q - e - (net - target) / 15 end
        else case when net < value then q - e when lft <= 0 then 0 when q - e <= lft then q - e else lft end end as nds,
      case when scenario = 'ST' and net >= value then lft - case when lft <= 0 then 0 when q - e <= lft then q - e else lft end else lft end as nl
    from f join days d on d.reservoir_id = f.reservoir_id and d.i = f.i + 1 join aseg s on s.curve_id = f.curve_id and f.area >= s.lo and f.area < s.hi)) m
  join zseg s on s.curve_id = m.curve_id and m.nz >= s.lo and m.nz < s.hi)
select reservoir_id, label, date, round(o / 1e6, 11) + 0.0 as outflow_mcm, round(ds / 1e6, 11) + 0.0 as dels_mcm, round(z, 9) + 0.0 as elevation, round(area, 12) + 0.0 as area from f where i > 0"""


VIEWS = "flow s2_daily curve rule_curve"
NULLV = "cast(null as double) as value"


@query("gates_closed", check_sql(VIEWS, case_sql(f"select *, 'GC' as label, 'GC' as scenario, {NULLV} from p"), recursive=True))
def gates_closed(t: Tables):
    """All water stored."""
    return case_rows(run_forecast(t, "GC"))


@query("gates_open", check_sql("flow s2_daily curve", """with inp as (select reservoir_id, arg_max(area, date) / 10 as a0, reservoir_id % 5 + 4.0 as mm from s2_daily where date <= date '2024-01-10' group by 1)
select f.reservoir_id, 'GO' as label, date, round((streamflow * 86400 - mm * 0.001 * a0 * 1e6) / 1e6, 11) + 0.0 as outflow_mcm, 0.0 as dels_mcm, cast(null as double) as elevation, round(a0, 12) as area
from flow f join inp using (reservoir_id) where date between date '2024-01-10' and date '2024-01-25'"""))
def gates_open(t: Tables):
    """Inflow minus evaporation released."""
    return case_rows(run_forecast(t, "GO"))


@query("target_level", check_sql(VIEWS, case_sql("select *, 'CL' as label, 'CL' as scenario, wl as value from p"), recursive=True))
def target_level(t: Tables):
    """Stored up to a level, released above it."""
    return case_rows(run_forecast(t, "CL"))


@query("rule_curve", check_sql(VIEWS, case_sql(f"select *, 'RC' as label, 'RC' as scenario, {NULLV} from p"), recursive=True))
def rule_curve(t: Tables):
    """Storage follows the monthly rule curve."""
    return case_rows(run_forecast(t, "RC"))


ST = """select *, 'ST ' || x || '%' as label, 'ST' as scenario, smax * y * 1e6 as value from p cross join (values ('0.5', 0.005), ('1', 0.01), ('2.5', 0.025)) v(x, y)
union all select *, null, null, 'ST ' || format('{:.1f}', room) || '% room', 'ST', room / 100.0 * smax * 1e6 from p
union all select *, null, null, 'ST ' || format('{:.1f}', cust) || 'MCM', 'ST', cust * 1e6 from p where cust is not null"""


@query("storage_fraction", check_sql(VIEWS, case_sql(ST), recursive=True))
def storage_fraction(t: Tables):
    """Shares of the capacity, the room left and a given volume filled first."""
    return case_rows(run_forecast(t, "ST"))


LEGACY = (case_sql("select *, 'CL' as label, 'CL' as scenario, wl as value from p union all select *, 'RC', 'RC', null from p")
          .replace("else surplus / 16 - e end", "else surplus / 16 - q - e end").replace("else q - e - (net - target) / 15 end", "else q - (net - target) / 15 end"))


@query("forecast_legacy", check_sql(VIEWS, LEGACY, recursive=True))
def forecast_legacy(t: Tables):
    """Level and rule-curve cases with the older storage terms."""
    return case_rows(run_forecast(t, "CL", "RC", legacy=True))


@query("forecast_totals", check_sql("flow s2_daily curve", """with inp as (select reservoir_id, arg_max(area, date) / 10 as a0, reservoir_id % 5 + 4.0 as mm from s2_daily where date <= date '2024-01-10' group by 1)
select f.reservoir_id, round(sum(streamflow * 86400) / 1e6, 6) as inflow, round(sum(mm * 0.001 * a0 * 1e6) / 1e6, 6) as evaporation, round((sum(streamflow * 86400) - sum(mm * 0.001 * a0 * 1e6)) / 1e6, 6) + 0.0 as net_inflow
from flow f join inp using (reservoir_id) where date between date '2024-01-10' and date '2024-01-25' group by 1"""))
def forecast_totals(t: Tables):
    """Net inflow over the forecast window."""
    out = forecast.window_totals(run_forecast(t, "GO"), R)
    return out.select(*R, *[F.round(F.col(c) / 1e6, 6).alias(c) for c in ("inflow", "evaporation", "net_inflow")])


WIDE = case_sql(f"select *, 'GC' as label, 'GC' as scenario, {NULLV} from p union all select *, 'RC', 'RC', null from p").replace(
    "select reservoir_id, label, date, round(o", "select reservoir_id, date '2024-01-10' as basedate, date, " + ", ".join(
        f"""round(max(case when label = '{c}' then greatest(o, 0) end), 3) + 0.0 as "outflow (m3/d)_{c}", round(max(case when label = '{c}' then ds end), 3) + 0.0 as "delS (m)_{c}", round(max(case when label = '{c}' then area end), 3) + 0.0 as "area (km2)_{c}" """
        for c in ("GC", "RC")) + " from f where i > 0 group by 1, 2, 3 --")


@query("forecast_product", check_sql(VIEWS, WIDE, recursive=True))
def forecast_product(t: Tables):
    """Wide forecast product, one set of columns per case."""
    out = forecast.product_columns(run_forecast(t, "GC", "RC"), R, ["GC", "RC"])
    wide = [n for n in out.columns if "[" in n]
    return out.select(*R, "basedate", "date", *[F.round(f"`{n}`", 3).alias(n.replace(" [case: ", "_").replace("]", "")) for n in wide])


@query("room_left", check_sql("s2_daily", """with l as (select reservoir_id, arg_max(area, date) as s from s2_daily group by 1),
q as (select reservoir_id, (sum(cast(area < s as int)) + sum(cast(area <= s as int)) + case when sum(cast(area <= s as int)) > sum(cast(area < s as int)) then 1 else 0 end) * 50.0 / count(*) as pc from s2_daily join l using (reservoir_id) group by 1)
select reservoir_id, round(100 * (1 - pc / 100), 1) + 0.0 as room_percent from q"""))
def room_left(t: Tables):
    """Room left by the distribution of areas."""
    return forecast.room_left(t.s2_daily, R)


@query("forecast_dams", check_sql("reservoirs flow", "select reservoir_id from reservoirs where reservoir_id in (select reservoir_id from flow)"))
def forecast_dams(t: Tables):
    """Reservoirs with observed outflow."""
    return forecast.observed_dams(t.reservoirs, t.flow, R).select(*R)


# --- incremental ----------------------------------------------------------------------------

@query("incremental_resume", check_sql("s2_daily reservoirs", """with o as (select * from s2_daily where date <= date '2024-01-20' - cast(reservoir_id % 5 as int) and reservoir_id % 7 <> 0),
w as (select distinct reservoir_id from s2_daily), l as (select w.reservoir_id, max(o.date) as last_date from w left join o using (reservoir_id) group by 1)
select reservoir_id, last_date, coalesce(last_date - 10, date '2019-01-01') as start_date from l where last_date is null or date_diff('day', last_date, date '2024-01-21') >= 5"""))
def incremental_resume(t: Tables):
    """Where the next run starts, two revisits back; fresh keys from the beginning."""
    rid = F.col("reservoir_id")
    stored = t.s2_daily.where((F.col("date") <= F.date_sub(F.lit("2024-01-20").cast("date"), (rid % 5).cast("int"))) & (rid % 7 != 0))
    return incremental.resume_from(stored, R, 5, F.lit("2024-01-21").cast("date"), F.lit("2019-01-01").cast("date"), wanted=t.s2_daily)


@query("incremental_update", check_sql("s2_daily", """with o as (select reservoir_id, date, 0.0 as area from s2_daily where date <= date '2024-01-15'), l as (select reservoir_id, max(date) as m from o group by 1),
due as (select s.* from s2_daily s left join l using (reservoir_id) where (m is null or date_diff('day', m, date '2024-01-30') >= 5) and (m is null or s.date >= m - 10))
select reservoir_id, date, coalesce(d.area, o.area) as area from o full join due d using (reservoir_id, date)"""))
def incremental_update(t: Tables):
    """Stored rows with the overlap and everything later replaced."""
    stored = t.s2_daily.where("date <= '2024-01-15'").withColumn("area", F.lit(0.0))
    return incremental.incremental_update(stored, t.s2_daily, R, 5, F.lit("2024-01-30").cast("date"), F.lit("2019-01-01").cast("date")).select(*R, "date", "area")


@query("new_cycles", check_sql("returns", """with l as (select track, max(cycle) as m from returns where cycle < 100 + track group by 1)
select r.track, r.cycle, count(*) as n from returns r left join l using (track) where m is null or r.cycle >= m group by 1, 2"""))
def new_cycles(t: Tables):
    """Cycles at or after the last stored one of every track."""
    stored = t.returns.where(F.col("cycle") < F.col("track") + 100)
    return incremental.new_cycles(t.returns, stored).groupBy("track", "cycle").agg(F.count(F.lit(1)).alias("n"))


# --- files ----------------------------------------------------------------------------------

@query("routed_flow_scan", check_sql("flow", "select reservoir_id, date, round(streamflow * 0.028316847, 11) as streamflow from flow"))
def routed_flow_scan(t: Tables):
    """Flow written as routed text lines and read back."""
    path = scratch_table(t.spark, "routed")
    df = t.flow.select("reservoir_id", F.year("date").alias("y"), F.month("date").alias("m"), F.dayofmonth("date").alias("d"), F.round("streamflow", 9).alias("q"))
    writers.lines(df, path, ["y", "m", "d", "q"], sep="  ", by="reservoir_id")
    out = readers.routed_flow(t.spark, path)
    return out.select(F.regexp_extract(F.col("_metadata.file_path"), "reservoir_id=([0-9]+)", 1).cast("bigint").alias("reservoir_id"), "date", F.round("streamflow", 11).alias("streamflow"))


@query("altimeter_scan", check_sql("returns", "select cycle, round(lat, 4) as lat, round(height, 6) as height, count(*) as n from returns group by all"))
def altimeter_scan(t: Tables):
    """Returns written as sixteen text columns and read back."""
    path = scratch_table(t.spark, "extract")
    zeros = [F.lit(0).alias(f"f{i}") for i in range(9)]
    df = t.returns.select(*zeros, "cycle", "mjd", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat"), F.round("height", 6).alias("height"), F.lit(1.5).alias("sig0"), F.lit(0).alias("qual"))
    writers.lines(df, path, df.columns)
    back = readers.altimeter_extract(t.spark, path)
    return back.groupBy("cycle", "lat", "height").agg(F.count(F.lit(1)).alias("n"))


@query("series_csv_scan", check_sql("flow", "select cast(reservoir_id as varchar) as reservoir_id, date, streamflow from flow"))
def series_csv_scan(t: Tables):
    """Flow series written as CSV, one file name per reservoir, and read back through the reader with its missing-value rules."""
    path = scratch_table(t.spark, "series")
    writers.series_csv(t.flow.select("reservoir_id", "date", "streamflow"), path)
    return readers.series(t.spark, path, "inflow", "file").select(F.col("reservoir_id").cast("string").alias("reservoir_id"), "date", "streamflow")


@query("zero_image_scan", check_sql("optical", """select date, water_area, cloud_area, cast(floor(cloud_area) % 4 as int) as images, count(*) as n from optical where sat = 'l8' and floor(cloud_area) % 4 > 0 group by all"""))
def zero_image_scan(t: Tables):
    """Landsat composites written as CSV and read back without those made from no image."""
    path = scratch_table(t.spark, "landsat")
    o = t.optical.where("sat = 'l8'")
    o.select(F.col("date").alias("mosaic_enddate"), F.col("date").alias("from_date"), F.col("date").alias("to_date"), F.col("water_area").alias("water_area_cordeiro"),
             F.col("non_water_area").alias("non_water_area_cordeiro"), "cloud_area", (F.floor("cloud_area") % 4).cast("int").alias("images"),
             F.col("corrected_area").alias("corrected_area_cordeiro")).write.option("header", True).csv(path)
    back = readers.with_images(readers.optical(t.spark, path, "l8"))
    return back.groupBy("date", "water_area", "cloud_area", "images").agg(F.count(F.lit(1)).alias("n"))


@query("array_functions", check_sql("s2_daily", """with o as (select reservoir_id, date, lead(date) over w as second, row_number() over w as i, count(*) over (partition by reservoir_id) as n from s2_daily window w as (partition by reservoir_id order by date))
select reservoir_id, 'pair' as kind, date as first, second as last, cast(2 as bigint) as n from o where second is not null union all
select reservoir_id, 'chunk', min(date), max(date), count(*) from o group by reservoir_id, floor((i - 1) / 4)"""))
def array_functions(t: Tables):
    """Neighbouring dates, and dates in groups of four."""
    days = t.s2_daily.groupBy(*R).agg(F.sort_array(F.collect_list("date")).alias("d"))
    pairs = days.select(*R, F.explode(columns.consecutive_pairs(F.col("d"))).alias("p")).select(
        *R, F.lit("pair").alias("kind"), F.col("p.first").alias("first"), F.col("p.second").alias("last"), F.lit(2).cast("bigint").alias("n"))
    groups = days.select(*R, F.explode(columns.chunks(F.col("d"), 4)).alias("c")).select(
        *R, F.lit("chunk").alias("kind"), F.array_min("c").alias("first"), F.array_max("c").alias("last"), F.size("c").cast("bigint").alias("n"))
    return pairs.unionByName(groups)


@query("forecast_from_base", check_sql("flow", "select reservoir_id, date, streamflow from flow where date >= date '2024-01-10' + cast(reservoir_id % 3 as int)"))
def forecast_from_base(t: Tables):
    """Forecast rows from each reservoir's base date on."""
    base = F.date_add(F.lit("2024-01-10").cast("date"), (F.col("reservoir_id") % 3).cast("int"))
    return products.forecast_product(t.flow, base).select(*R, "date", "streamflow")


@query("curve_names", check_sql("curve", "select curve_id, elevation, area from curve"))
def curve_names(t: Tables):
    """Observed curves in product column names."""
    return products.curve_product(t.curve.select("curve_id", F.col("elevation").alias("Elevation"), F.col("area").alias("CumArea")))


@query("yearly_split", check_sql("cell_flux", """select year(date) as year, count(*) as n, min(date) as first, max(date) as last, round(sum(net_radiation), 2) as radiation from cell_flux group by 1"""))
def yearly_split(t: Tables):
    """Weather written by year, the rest of every reservoir appended after its own last stored day, twice, and read back."""
    path, rid = scratch_table(t.spark, "yearly"), F.col("reservoir_id")
    df = t.cell_flux.select("reservoir_id", "date", "net_radiation")
    first = df.where((F.col("date") < F.date_sub(F.lit("1999-01-01").cast("date"), (rid % 50 * 9).cast("int"))) & (rid % 11 != 0))
    writers.yearly(first, path)
    table = scratch_table(t.spark, "yearly-table")
    writers.append_after(t.spark.read.parquet(path).select(*df.columns), table, keys=["reservoir_id"])
    for _ in range(2):  # a run that is repeated adds nothing
        writers.append_after(df, table, keys=["reservoir_id"])
    back = committed.read(t.spark, table)
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"), F.round(F.sum("net_radiation"), 2).alias("radiation")).withColumn("year", F.col("year").cast("bigint"))


@query("cell_split", check_sql("forcing", """select printf('%.2f', sign(cell_y * 0.0625 - 0.303) * floor(abs(cell_y * 0.0625 - 0.303) * 100) / 100) as lat_key, printf('%.2f', floor(cell_x * 0.0625 * 100) / 100) as lon_key,
  count(*) as n, round(sum(round(tmax, 5)), 4) as tmax from forcing group by 1, 2"""))
def cell_split(t: Tables):
    """Flux text per grid cell, keyed by the coordinate cut to two decimals."""
    path = scratch_table(t.spark, "cells")
    df = t.forcing.select("date", (F.col("cell_y") * 0.0625 - 0.303).alias("lat"), (F.col("cell_x") * 0.0625).alias("lon"), "tmax", "tmin")
    writers.cell_tables(df, path, ["tmax", "tmin"])
    back = t.spark.read.schema("value string, lat_key string, lon_key string").text(path)
    return back.groupBy("lat_key", "lon_key").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.get(F.split("value", "\t"), F.lit(0)).cast("double")), 4).alias("tmax"))


@query("curve_scan", check_sql("curve", "select curve_id, elevation, area from curve"))
def curve_scan(t: Tables):
    """Curves written with comment lines and a header and read back in product names."""
    path = scratch_table(t.spark, "curves")
    row = F.concat_ws(",", F.col("area"), F.col("elevation"), F.lit("0"), F.lit("0"), F.col("elevation"))
    body = t.curve.select("curve_id", (F.col("elevation") + 2).alias("line"), row.alias("value"))
    top = t.curve.select("curve_id").distinct().select("curve_id", F.explode(F.array(
        F.struct(F.lit(0).alias("line"), F.lit("# polynomial degree: 2").alias("value")),
        F.struct(F.lit(1).alias("line"), F.lit("CumArea,Elevation,Storage,Storage (mil. m3),Elevation_Observed").alias("value")))).alias("h")).select("curve_id", "h.line", "h.value")
    (top.unionByName(body).repartition("curve_id").sortWithinPartitions("curve_id", "line").select("curve_id", "value")
     .write.partitionBy("curve_id").text(path))
    back = readers.curve(t.spark, path)
    return back.select("curve_id", F.col("elevation").cast("int").alias("elevation"), "area")


@query("rule_curve_scan", check_sql("rule_curve", "select month, round(s_by_smax, 9) as s_by_smax from rule_curve"))
def rule_curve_scan(t: Tables):
    """Rule curve written as a headed CSV and read back."""
    path = scratch_table(t.spark, "rule")
    t.rule_curve.select(F.col("month").alias("Month"), F.col("s_by_smax").alias("S/Smax")).write.option("header", True).csv(path)
    return readers.rule_curve(t.spark, path).select(F.col("month").cast("bigint").alias("month"), F.round("s_by_smax", 9).alias("s_by_smax"))


@query("station_scan", check_sql("", """select s_name as name, s_suppkey % 50 + 0.5 as x, s_nationkey + 0.25 as y, s_acctbal as area from supplier where s_acctbal > 0"""))
def station_scan(t: Tables):
    """Tab-separated stations read back without the incomplete ones."""
    path = scratch_table(t.spark, "stations")
    s = t.raw("supplier").select(F.lit(1).alias("run"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 50 + 0.5).alias("x"), (F.col("s_nationkey") + 0.25).alias("y"),
                                 F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("area"))
    s.write.option("sep", "\t").csv(path)
    return readers.stations(t.spark, path).select("name", "x", "y", "area")


@query("product_table", check_sql("flow", "select reservoir_id % 5 as basin_id, reservoir_id, date, round(streamflow * 86400, 3) as inflow from flow"))
def product_table(t: Tables):
    """Product written by basin and read back."""
    path = scratch_table(t.spark, "product")
    df = t.flow.select((F.col("reservoir_id") % 5).alias("basin_id"), "reservoir_id", "date", F.round(F.col("streamflow") * 86400, 3).alias("inflow"))
    writers.product(df, path)
    return readers.product(t.spark, path).withColumn("basin_id", F.col("basin_id").cast("bigint"))


# --- streams --------------------------------------------------------------------------------

def events(t: Tables, kind: str):
    s = daily.observations(t.spark, t.folder, schemas.EVENTS, "events.parquet")
    return s.where(F.col("event_type") == kind).select(F.col("user_id").alias("reservoir_id"), "event_id", "ts", "value")


def finished(t: Tables, stream, keys):
    table, check = scratch_table(t.spark, "stream"), scratch_table(t.spark, "stream-log")
    q = daily.run_upsert(stream, table, check)
    ended(q)
    return daily.latest(t.spark, table, keys)


def ended(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def backfill(t: Tables, kind: str) -> str:
    """Events of a kind as files from the newest day to the oldest; a file stream takes them in the order they were written."""
    folder = scratch_table(t.spark, "backfill")
    e = t.raw("events").where(F.col("event_type") == kind)
    for first, last in ((23, 31), (16, 22), (8, 15), (1, 7)):
        e.where(F.dayofmonth("ts").between(first, last)).coalesce(1).write.mode("append").parquet(folder)
    return folder


@query("stream_backfill", check_sql("", """select user_id as reservoir_id, cast(ts as date) as date, round(sum(value), 6) as total, count(*) as n, arg_max(value, ts) as latest from events where event_type = 'error' group by 1, 2"""))
def stream_backfill(t: Tables):
    """Daily flow from files that come newest first, one in each batch."""
    table, check = scratch_table(t.spark, "stream"), scratch_table(t.spark, "stream-log")
    s = daily.observations(t.spark, backfill(t, "error"), schemas.EVENTS, files_per_batch=1)
    ended(daily.run_partial_totals(s.withColumnRenamed("user_id", "reservoir_id"), R, "value", table, check))
    return daily.total_of_parts(t.spark, table, R).select(*R, "date", F.round("total", 6).alias("total"), "n", "latest")


@query("stream_daily", check_sql("", """select user_id as reservoir_id, cast(ts as date) as date, round(sum(value), 6) as total, count(*) as n, arg_max(value, ts) as latest from events where event_type = 'error' group by 1, 2"""))
def stream_daily(t: Tables):
    """Daily flow from an event stream, last version of each day."""
    out = finished(t, daily.daily_totals(events(t, "error"), R, "value"), [*R, "date"])
    return out.select(*R, "date", F.round("total", 6).alias("total"), "n", "latest")


@query("stream_composites", check_sql("", """with e as (select user_id as reservoir_id, date_diff('day', date '2023-12-28', cast(ts as date)) as off, value from events where event_type = 'view')
select reservoir_id, date '2023-12-28' + cast(floor(off / 5) * 5 as int) as from_date, date '2023-12-28' + cast(floor(off / 5) * 5 as int) + 5 as to_date, max(value) as best, count(*) as n from e group by 1, 2, 3"""))
def stream_composites(t: Tables):
    """Five-day composites from an event stream."""
    return finished(t, daily.composites(events(t, "view"), R, "s2", "value", "2024-01-01"), [*R, "from_date", "to_date"])


@query("stream_scenes", check_sql("", """select user_id as reservoir_id, event_id, value from events where event_type = 'click'"""))
def stream_scenes(t: Tables):
    """Scenes delivered twice are kept once."""
    s = events(t, "click")
    twice = s.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return finished(t, daily.drop_duplicate_scenes(twice, ["event_id"]), ["event_id"]).select("reservoir_id", "event_id", "value")


@query("committed_upserts", check_sql("", """select user_id as reservoir_id, cast(ts as date) as date, round(sum(value), 6) as total, count(*) as n from events where event_type = 'error' group by 1, 2"""))
def committed_upserts(t: Tables):
    """Batches of corrections, one of them delivered twice, folded into one state by a compaction that a reader of the version before it outlives."""
    table = scratch_table(t.spark, "upserts")
    e = t.raw("events").where(F.col("event_type") == "error").withColumnRenamed("user_id", "reservoir_id")
    days = lambda df: df.groupBy(*R, F.to_date("ts").alias("date")).agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    for version, (rows, name) in enumerate([(e.where(F.hour("ts") < 9), "morning"), (e.where(F.hour("ts") < 17), "day"), (e.where(F.hour("ts") < 9), "morning"), (e, "evening")]):
        committed.append(days(rows).withColumn("version", F.lit(version)), table, name)
    before = daily.latest(t.spark, table, [*R, "date"])
    daily.compact(t.spark, table, [*R, "date"])
    committed.vacuum(t.spark, table, keep=2)
    both = before.join(daily.latest(t.spark, table, [*R, "date"]).withColumnRenamed("total", "_after").drop("n"), [*R, "date"])
    return both.where(F.col("total") == F.col("_after")).select(*R, "date", F.round("total", 6).alias("total"), "n")


@query("stream_provisional", check_sql("", """with e as (select user_id as reservoir_id, cast(ts as date) as d, value, event_id, dayofmonth(ts) as k from events where event_type = 'view'),
p as (select reservoir_id, d, max(value) as v from e where event_id % 5 <> 0 group by 1, 2), o as (select reservoir_id, d, min(value) - 1 as v from e where event_id % 3 <> 0 group by 1, 2)
select coalesce(p.reservoir_id, o.reservoir_id) as reservoir_id, coalesce(p.d, o.d) as date, coalesce(o.v, p.v) as value, case when o.v is null then 'provisional' else 'observed' end as source
from p full join o on p.reservoir_id = o.reservoir_id and p.d = o.d"""))
def stream_provisional(t: Tables):
    """Provisional values replaced by observed ones; of each two weeks one source comes first, in files of a batch each."""
    e = t.raw("events").where(F.col("event_type") == "view").withColumnRenamed("user_id", "reservoir_id")
    daily_ = lambda df, f: df.groupBy(*R, F.date_trunc("day", "ts").alias("ts")).agg(f("value").alias("value"))
    sources = {"provisional": daily_(e.where(F.col("event_id") % 5 != 0), F.max), "observed": daily_(e.where(F.col("event_id") % 3 != 0), F.min).withColumn("value", F.col("value") - 1)}
    folders = {name: scratch_table(t.spark, name) for name in sources}
    last = e.agg(F.date_add(F.to_date(F.max("ts")), 40).cast("timestamp")).first()[0]
    end = t.spark.createDataFrame([(-1, last, 0.0)], "reservoir_id long, ts timestamp, value double")  # moves the watermark past all days
    cuts = [F.dayofmonth("ts").between(a, b) for a, b in ((1, 4), (5, 9), (10, 14), (15, 19), (20, 24), (25, 31))]
    for name, df in sources.items():
        df = df.select(F.col("reservoir_id").cast("long").alias("reservoir_id"), "ts", F.col("value").cast("double").alias("value"))
        order = cuts if name == "observed" else [cuts[0], F.lit(False), *cuts[1:]]  # from the second file on one side is a file behind
        for part in [*[df.where(c) for c in order], *[end] * (3 if name == "observed" else 2)]:
            part.coalesce(1).write.mode("append").parquet(folders[name])
    read = lambda name: daily.observations(t.spark, folders[name], "reservoir_id long, ts timestamp, value double", files_per_batch=1)
    joined = daily.replace_provisional(read("provisional"), read("observed"), R, "value", lateness="40 days")
    table, log = scratch_table(t.spark, "provisional-table"), scratch_table(t.spark, "provisional-log")
    ended(daily.run_upsert(joined, table, log, "append"))
    out = committed.read(t.spark, table).where("reservoir_id >= 0")
    return out.select(*R, F.to_date("ts").alias("date"), "value", "source")
