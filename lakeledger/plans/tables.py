"""Reservoir-shaped views over the shared test tables, in Spark and as SQL text."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SENSOR_OF_EVENT = {"view": "s2", "click": "l8", "purchase": "l9"}


class Tables:
    """Lazy views; only the columns a query uses are read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- series -----------------------------------------------------------------------------
    @cached_property
    def area_obs(self) -> DataFrame:
        """Every optical observation; several per sensor and day."""
        e = self.raw("events")
        sat = F.when(F.col("event_type") == "view", "s2").when(F.col("event_type") == "click", "l8").otherwise("l9")
        return e.where(F.col("event_type").isin(*SENSOR_OF_EVENT)).select(
            F.col("user_id").alias("reservoir_id"), sat.alias("sat"), F.to_date("ts").alias("date"),
            "event_id", F.col("value").alias("water_area"),
            F.get_json_object("props", "$.k").cast("double").alias("cloud_percent"))

    @cached_property
    def sensor_daily(self) -> DataFrame:
        """One row per reservoir, sensor and date: the latest event."""
        from lakeledger.operators.scale import pick_rows
        return pick_rows(self.area_obs, ["reservoir_id", "sat", "date"], "event_id", ["water_area", "cloud_percent"])

    @cached_property
    def s2_daily(self) -> DataFrame:
        from lakeledger.operators.scale import pick_rows
        one = self.area_obs.where(F.col("sat") == "s2")
        return (pick_rows(one, ["reservoir_id", "date"], "event_id", ["water_area"])
                .select("reservoir_id", "date", F.col("water_area").alias("area")))

    @cached_property
    def optical(self) -> DataFrame:
        """Sensor observations with all area measures; every tenth corrected area is the sentinel -1."""
        k = F.col("cloud_percent")
        return self.sensor_daily.select(
            "reservoir_id", "sat", "date", "water_area", ((F.lit(100.0) - k) / 10).alias("non_water_area"), k.alias("cloud_area"),
            F.when(k % 10 == 9, F.lit(-1.0)).otherwise(F.col("water_area")).alias("corrected_area"))

    @cached_property
    def sar_daily(self) -> DataFrame:
        from lakeledger.operators.scale import pick_rows
        e = self.raw("events").where(F.col("event_type") == "signup").select(
            F.col("user_id").alias("reservoir_id"), F.to_date("ts").alias("date"), "event_id",
            F.col("value").alias("sarea"))
        return pick_rows(e, ["reservoir_id", "date"], "event_id", ["sarea"]).drop("event_id")

    @cached_property
    def flow(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "error")
        return e.groupBy(F.col("user_id").alias("reservoir_id"), F.to_date("ts").alias("date")).agg(
            F.sum("value").alias("streamflow"))

    @cached_property
    def reservoirs(self) -> DataFrame:
        ids = self.raw("events").select(F.col("user_id").alias("reservoir_id")).distinct()
        return ids.select("reservoir_id", *self.reservoir_columns())

    @staticmethod
    def reservoir_columns():
        rid = F.col("reservoir_id")
        return [(rid % 120 + 5).cast("double").alias("nominal_area"), (rid % 50 + 100).cast("double").alias("smax"),
                F.concat(F.lit("Brand#"), rid % 25 + 1).alias("curve_id")]

    # --- terrain ----------------------------------------------------------------------------
    @cached_property
    def dem(self) -> DataFrame:
        return self.raw("part").select(F.col("p_brand").alias("curve_id"), F.col("p_partkey").alias("pixel"),
                                       F.col("p_size").alias("elevation"))

    @cached_property
    def curve(self) -> DataFrame:
        """Per-brand curve; 0.1 km2 per pixel."""
        from lakeledger.operators.curves import observed_curve
        return observed_curve(self.dem, ["curve_id"], pixel_area_m2=1e5)

    # --- weather ----------------------------------------------------------------------------
    @cached_property
    def cell_flux(self) -> DataFrame:
        q = F.col("l_quantity")
        return self.raw("lineitem").select(
            F.col("l_suppkey").alias("reservoir_id"), F.to_date("l_shipdate").alias("date"),
            (q * 4).alias("net_radiation"), (q / 2).alias("air_temp"),
            (F.col("l_linenumber") + 1.0).alias("wind"), (F.col("l_tax") * 10 + 0.5).alias("vapor_pressure"),
            (F.lit(100.0) - F.col("l_discount") * 100).alias("pressure"))

    @cached_property
    def forcing(self) -> DataFrame:
        """Daily grid: cell (x, y), precipitation, temperatures and wind components."""
        k = F.col("o_orderkey")
        cust = F.col("o_custkey")
        return self.raw("orders").groupBy(
            (cust % 10).cast("int").alias("cell_x"), (F.floor(cust / 10) % 10).cast("int").alias("cell_y"),
            F.to_date("o_orderdate").alias("date")).agg(
            (F.sum("o_totalprice") / 100000).alias("precip"),
            F.max(k % 35).cast("double").alias("tmax"), F.max(F.floor(k / 7) % 35).cast("double").alias("tmin"),
            F.max(k % 11).cast("double").alias("u"), F.max(k % 13).cast("double").alias("v"))

    # --- pixels -----------------------------------------------------------------------------
    @cached_property
    def pixels(self) -> DataFrame:
        """Band values per scene (month) and pixel; repeated pixels are separate images of the scene."""
        return self.raw("lineitem").select(
            (F.col("l_suppkey") % 7).cast("int").alias("reservoir_id"),
            F.to_date("l_shipdate").alias("image_date"),
            F.date_trunc("month", "l_shipdate").cast("date").alias("scene"),
            F.col("l_partkey").alias("pix"), F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("line"),
            F.col("l_quantity").alias("b3"), (F.col("l_discount") * 100).alias("b4"),
            (F.col("l_tax") * 100).alias("b5"), F.col("l_linenumber").cast("double").alias("b6"),
            (F.col("l_partkey") % 50).cast("double").alias("b7"),
            (F.col("l_orderkey") % 64).cast("int").alias("qa"),
            (F.col("l_partkey") % 101).cast("int").alias("occurrence"))

    @cached_property
    def sar_images(self) -> DataFrame:
        """Radar backscatter per composite window, pass and pixel."""
        day = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01"))
        return self.raw("lineitem").select(
            (F.col("l_suppkey") % 2).cast("int").alias("reservoir_id"), F.to_date("l_shipdate").alias("image_date"),
            F.col("l_returnflag").alias("image"), (F.col("l_partkey") % 100).cast("int").alias("x"),
            F.floor(F.col("l_partkey") / 100).cast("int").alias("y"), (F.col("l_quantity") * -0.7).alias("vv"),
            (F.col("l_discount") * 200 + 30).alias("angle"))

    # --- altimetry --------------------------------------------------------------------------
    @cached_property
    def returns(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_linenumber").alias("track"),
            F.floor(F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01")) / 10).cast("int").alias("cycle"),
            (F.col("l_discount") * 100).alias("lat"), (F.col("l_tax") * 100).alias("lon"),
            (F.col("l_extendedprice") / 1000).alias("height"),
            (F.datediff(F.to_date("l_shipdate"), F.lit("1858-11-17"))).cast("double").alias("mjd"))

    # --- network ----------------------------------------------------------------------------
    @cached_property
    def flow_dir(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            (k % 40).cast("int").alias("x"), F.floor(k / 40).cast("int").alias("y"),
            (k % 8 + 1).cast("int").alias("code"), (F.col("c_mktsegment") == "MACHINERY").alias("is_dam"),
            k.alias("node"))

    @cached_property
    def edges(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.raw("supplier").where(k >= 1).select(
            k.alias("src"), F.floor(k / 2).cast("bigint").alias("dst"), (k % 3 + 1).cast("double").alias("travel_time"))

    @cached_property
    def node_days(self) -> DataFrame:
        """Runoff and storage change per network node and month."""
        return (self.raw("lineitem").groupBy(F.col("l_suppkey").alias("node"),
                                            F.date_trunc("month", "l_shipdate").cast("date").alias("date"))
                .agg(F.sum("l_quantity").alias("natural"), (F.sum("l_extendedprice") / 10000).alias("price"))
                .select("node", "date", "natural", (F.col("price") - F.col("natural") / 2).alias("storage_change")))

    # --- shapes -----------------------------------------------------------------------------
    @cached_property
    def polygon_edges(self) -> DataFrame:
        """Unit squares on a five-by-five grid, one per nation, as closed rings."""
        k = F.col("n_nationkey")
        x, y = (k % 5).cast("double"), F.floor(k / 5).cast("double")
        one = F.lit(1.0)
        corner = lambda a, b: F.struct((x + one * a).alias("x"), (y + one * b).alias("y"))
        corners = F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))
        ring = self.raw("nation").select(k.alias("id"), corners.alias("c"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("seq"))
        a, b = F.get("c", F.col("seq")), F.get("c", (F.col("seq") + 1) % 4)
        return ring.select("id", "seq", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))

    @cached_property
    def points(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            k.alias("point"), ((k * 37 % 601) / 100.0 - 0.503).alias("x"), ((k * 53 % 599) / 100.0 - 0.497).alias("y"))

    @cached_property
    def rule_curve(self) -> DataFrame:
        o = self.raw("orders")
        per_month = o.groupBy(F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))
        total = o.agg(F.count(F.lit(1))).scalar()
        return per_month.select("month", (F.col("n") / total * 6).alias("s_by_smax"))


# The same views for the checking engine.
SQL = {
    "area_obs": """select user_id as reservoir_id, case event_type when 'view' then 's2' when 'click' then 'l8' else 'l9' end as sat,
        cast(ts as date) as date, event_id, value as water_area, cast(json_extract_string(props, '$.k') as double) as cloud_percent
        from events where event_type in ('view', 'click', 'purchase')""",
    "sensor_daily": """select reservoir_id, sat, date, event_id, water_area, cloud_percent from area_obs
        qualify row_number() over (partition by reservoir_id, sat, date order by event_id desc) = 1""",
    "s2_daily": """select reservoir_id, date, water_area as area from sensor_daily where sat = 's2'""",
    "optical": """select reservoir_id, sat, date, water_area, (100.0 - cloud_percent) / 10 as non_water_area, cloud_percent as cloud_area,
        case when cloud_percent % 10 = 9 then -1.0 else water_area end as corrected_area from sensor_daily""",
    "cleaned": """select * from (
        with screened as (select reservoir_id, sat, date, case sat when 's2' then 5 else 16 end as step,
            cloud_area * 100 / (water_area + non_water_area + cloud_area) as cp, water_area, non_water_area, cloud_area,
            nullif(corrected_area, -1) as corrected_area from optical),
        bounds as (select reservoir_id, sat, step, min(date) as d0, max(date) as d1, max(cloud_area) as most from screened group by all),
        grid as (select reservoir_id, sat, most, cast(unnest(generate_series(cast(d0 as timestamp), cast(d1 as timestamp), step * interval 1 day)) as date) as date from bounds),
        j as (select g.reservoir_id, g.sat, g.date, case when s.date is null then 2 when s.cp >= 90 then 1 else 0 end as quality,
            coalesce(s.cloud_area, g.most) as cloud_area, coalesce(s.cp, 100) as cloud_percent,
            coalesce(case when s.cp >= 90 then null else s.non_water_area end, 0) as non_water_area,
            coalesce(case when s.cp >= 90 then null else s.water_area end, 0) as water_area,
            case when s.cp >= 90 then null else s.corrected_area end as v
            from grid g left join screened s using (reservoir_id, sat, date)),
        n as (select *, row_number() over (partition by reservoir_id, sat order by date) as x from j),
        f as (select *, last_value(v ignore nulls) over up as pv, max(case when v is not null then x end) over up as px,
            first_value(v ignore nulls) over dn as nv, min(case when v is not null then x end) over dn as nx from n
            window up as (partition by reservoir_id, sat order by x rows between unbounded preceding and current row),
              dn as (partition by reservoir_id, sat order by x rows between current row and unbounded following))
        select reservoir_id, sat, date, quality, cloud_area, cloud_percent, non_water_area, water_area,
          case when v is not null then v when nv is null then pv else pv + (nv - pv) * (x - px) / (nx - px) end as corrected_area from f)""",
    "merged": """select reservoir_id, date, sat, corrected_area as area, cloud_percent, quality from cleaned
        qualify row_number() over (partition by reservoir_id, date order by case sat when 's2' then 3 when 'l9' then 2 else 1 end desc) = 1""",
    "sar_daily": """select user_id as reservoir_id, cast(ts as date) as date, value as sarea from events where event_type = 'signup'
        qualify row_number() over (partition by user_id, cast(ts as date) order by event_id desc) = 1""",
    "flow": """select user_id as reservoir_id, cast(ts as date) as date, sum(value) as streamflow from events
        where event_type = 'error' group by 1, 2""",
    "reservoirs": """select distinct user_id as reservoir_id, cast(user_id % 120 + 5 as double) as nominal_area,
        cast(user_id % 50 + 100 as double) as smax, 'Brand#' || (user_id % 25 + 1) as curve_id from events""",
    "dem": """select p_brand as curve_id, p_partkey as pixel, p_size as elevation from part""",
    "curve": """select r.curve_id, e.elevation, round(count(*) * 0.1, 3) as area
        from (select curve_id, unnest(generate_series(min(elevation), max(elevation))) as elevation from dem group by curve_id) e
        join dem r on r.curve_id = e.curve_id and r.elevation <= e.elevation group by 1, 2""",
    "curve_seg": """select curve_id, area as x0, elevation as z0, lead(area) over w as x1, lead(elevation) over w as z1,
        min(area) over (partition by curve_id) as amin, max(area) over (partition by curve_id) as amax from curve
        window w as (partition by curve_id order by area, elevation)""",
    "cell_flux": """select l_suppkey as reservoir_id, cast(l_shipdate as date) as date, l_quantity * 4 as net_radiation,
        l_quantity / 2 as air_temp, l_linenumber + 1.0 as wind, l_tax * 10 + 0.5 as vapor_pressure,
        100.0 - l_discount * 100 as pressure from lineitem""",
    "forcing": """select cast(o_custkey % 10 as int) as cell_x, cast(cast(floor(o_custkey / 10) as bigint) % 10 as int) as cell_y,
        cast(o_orderdate as date) as date, sum(o_totalprice) / 100000 as precip, cast(max(o_orderkey % 35) as double) as tmax,
        cast(max(cast(floor(o_orderkey / 7) as bigint) % 35) as double) as tmin, cast(max(o_orderkey % 11) as double) as u,
        cast(max(o_orderkey % 13) as double) as v from orders group by 1, 2, 3""",
    "pixels": """select cast(l_suppkey % 7 as int) as reservoir_id, cast(l_shipdate as date) as image_date,
        cast(date_trunc('month', l_shipdate) as date) as scene, l_partkey as pix, l_orderkey as image, l_linenumber as line,
        l_quantity as b3, l_discount * 100 as b4, l_tax * 100 as b5, cast(l_linenumber as double) as b6,
        cast(l_partkey % 50 as double) as b7, cast(l_orderkey % 64 as int) as qa, cast(l_partkey % 101 as int) as occurrence from lineitem""",
    "sar_images": """select cast(l_suppkey % 2 as int) as reservoir_id, cast(l_shipdate as date) as image_date, l_returnflag as image,
        cast(l_partkey % 100 as int) as x, cast(floor(l_partkey / 100) as int) as y, l_quantity * -0.7 as vv, l_discount * 200 + 30 as angle from lineitem""",
    "mosaic": """select reservoir_id, scene, pix, occurrence, n_images, best.ndwi as ndwi, best.mbwi as mbwi, best.b3 as b3, best.b7 as b7, clear from (
        with m as (select *, (qa & 24) = 0 as clear, case when (qa & 24) = 0 then (b5 - b6) / nullif(b5 + b6, 0) end as ndwi,
            case when (qa & 24) = 0 then b3 * 3 - b4 - b5 - b6 - b7 end as mbwi from pixels)
        select reservoir_id, scene, pix, occurrence, count(*) as n_images, max(cast(ndwi is not null as int)) = 1 as clear,
          arg_max(struct_pack(ndwi := ndwi, mbwi := mbwi, b3 := b3, b7 := b7), case when ndwi is not null then struct_pack(ndwi := ndwi, image := image, line := line, d := image_date, b3 := b3, b4 := b4, b5 := b5) end) as best
        from m group by 1, 2, 3, 4)""",
    "returns": """select l_linenumber as track, cast(floor(date_diff('day', date '1995-01-01', cast(l_shipdate as date)) / 10) as int) as cycle,
        l_discount * 100 as lat, l_tax * 100 as lon, l_extendedprice / 1000 as height,
        cast(date_diff('day', date '1858-11-17', cast(l_shipdate as date)) as double) as mjd from lineitem""",
    "flow_dir": """select cast(c_custkey % 40 as int) as x, cast(floor(c_custkey / 40) as int) as y, cast(c_custkey % 8 + 1 as int) as code,
        c_mktsegment = 'MACHINERY' as is_dam, c_custkey as node from customer""",
    "edges": """select s_suppkey as src, cast(floor(s_suppkey / 2) as bigint) as dst, cast(s_suppkey % 3 + 1 as double) as travel_time
        from supplier where s_suppkey >= 1""",
    "node_days": """select l_suppkey as node, cast(date_trunc('month', l_shipdate) as date) as date, sum(l_quantity) as natural_flow,
        sum(l_extendedprice) / 10000 - sum(l_quantity) / 2 as storage_change from lineitem group by 1, 2""",
    "polygon": """select n_nationkey as id, cast(n_nationkey % 5 as double) as x0, floor(n_nationkey / 5) as y0 from nation""",
    "points": """select c_custkey as point, (c_custkey * 37 % 601) / 100.0 - 0.503 as x, (c_custkey * 53 % 599) / 100.0 - 0.497 as y
        from customer""",
    "rule_curve": """select month(o_orderdate) as month, count(*) * 6.0 / (select count(*) from orders) as s_by_smax from orders group by 1""",
}
NEEDS = {"mosaic": ["pixels"], "optical": ["sensor_daily"], "cleaned": ["optical"], "merged": ["cleaned"], "sensor_daily": ["area_obs"], "s2_daily": ["sensor_daily"], "curve": ["dem"], "curve_seg": ["curve"]}


def check_sql(views: str, body: str, recursive: bool = False) -> str:
    """``body`` with the named views (and what they need) in front as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in views.split():
        add(name)
    ctes = ",\n".join(f"{n} as ({SQL[n]})" for n in order)
    body = body.strip()
    if body.lower().startswith("with "):
        body = body[5:]
        return f"with {'recursive ' if recursive else ''}{ctes},\n{body}" if ctes else f"with {'recursive ' if recursive else ''}{body}"
    return f"with {ctes}\n{body}" if ctes else body
