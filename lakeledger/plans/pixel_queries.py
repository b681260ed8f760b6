"""Image and altimeter queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.operators import altimetry, pixels
from lakeledger.plans.registry import query
from lakeledger.plans.tables import Tables, check_sql
from lakeledger.session import cut_lineage

SCENE = ["reservoir_id", "scene"]
PIXEL_M2 = 900.0


def area():
    """Pixel areas differ, so that sums depend on which pixels are taken."""
    return F.lit(PIXEL_M2) + F.col("occurrence")


def masked(t: Tables):
    bands = ["b3", "b4", "b5", "b6", "b7"]
    return pixels.landsat_indices(pixels.mask_and_scale(t.pixels, bands, pixels.landsat_cloud(F.col("qa")), 1.0))


def mosaic(t: Tables):
    return pixels.quality_mosaic(masked(t), [*SCENE, "pix", "occurrence"], ["ndwi", "mndwi", "mbwi", "b3", "b7"],
                                 ties=["image", "line", "image_date", "b3", "b4", "b5"])


def water(t: Tables):
    return mosaic(t).withColumn("water", pixels.ndwi_water(F.col("ndwi")))


@query("water_indices", check_sql("pixels", """with m as (select *, (qa & 8) <> 0 or (qa & 16) <> 0 as cloud from pixels)
select reservoir_id, scene, count(*) as n, sum(cast(cloud as int)) as cloudy, round(sum(case when not cloud then b3 * 0.0000275 - 0.2 end), 8) as b3,
  round(sum(case when not cloud then ((b5 - b6) * 0.0000275) / ((b5 + b6) * 0.0000275 - 0.4) end), 8) as ndwi,
  round(sum(case when not cloud then (b3 * 3 - b4 - b5 - b6 - b7) * 0.0000275 - 0.2 * (3 - 4) end), 8) as mbwi from m group by 1, 2"""))
def water_indices(t: Tables):
    """Cloud bits, reflectance scaling and water indices."""
    bands = ["b3", "b4", "b5", "b6", "b7"]
    m = pixels.mask_and_scale(t.pixels, bands, pixels.landsat_cloud(F.col("qa")), pixels.LANDSAT_SCALE, pixels.LANDSAT_OFFSET)
    m = pixels.landsat_indices(m)
    return m.groupBy(*SCENE).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("cloud").cast("int")).alias("cloudy"), F.round(F.sum("b3"), 8).alias("b3"),
        F.round(F.sum("ndwi"), 8).alias("ndwi"), F.round(F.sum("mbwi"), 8).alias("mbwi"))


@query("sentinel_indices", check_sql("pixels", """with m as (select *, qa % 12 in (3, 8, 9, 10) as cloud from pixels)
select reservoir_id, scene, sum(cast(cloud as int)) as cloudy, round(sum(case when not cloud then (b3 - b5) / nullif(b3 + b5, 0) end), 6) + 0.0 as ndwi,
  round(sum(case when not cloud then (b3 - b7) / nullif(b3 + b7, 0) end), 6) + 0.0 as mndwi, round(sum(case when not cloud then (b3 * 3 - b4 - b5 - b6 - b7) * 0.0001 end), 6) + 0.0 as mbwi from m group by 1, 2"""))
def sentinel_indices(t: Tables):
    """Scene-class mask and indices of the second optical sensor."""
    p = t.pixels.select(*SCENE, (F.col("qa") % 12).alias("scl"), "b3", "b4", F.col("b5").alias("b8"), F.col("b6").alias("b11"), F.col("b7").alias("b12"))
    m = pixels.mask_and_scale(p, ["b3", "b4", "b8", "b11", "b12"], pixels.sentinel2_cloud(F.col("scl")), pixels.SENTINEL2_SCALE)
    m = pixels.sentinel2_indices(m)
    return m.groupBy(*SCENE).agg(F.sum(F.col("cloud").cast("int")).alias("cloudy"), *[F.round(F.sum(c), 6).alias(c) for c in ("ndwi", "mndwi", "mbwi")])


@query("composite_windows", check_sql("pixels", """with d as (select reservoir_id, image_date, unnest(['s2', 'l8', 'sar']) as sensor from pixels),
o as (select *, case sensor when 's2' then 5 when 'l8' then 16 else 12 end as step, case sensor when 's2' then 5 when 'l8' then 15 else 12 end as used,
  date '1994-12-05' - case sensor when 's2' then 4 else 0 end as b from d),
k as (select *, floor(date_diff('day', b, image_date) / step) as k from o where image_date >= b)
select sensor, reservoir_id, b + cast(k * step as int) as from_date, b + cast(k * step as int) + used - 1 as mosaic_end, count(*) as n
from k where date_diff('day', b, image_date) - k * step < used group by all"""))
def composite_windows(t: Tables):
    """Images per composite for three sensors."""
    out = None
    for s in ("s2", "l8", "sar"):
        w = pixels.composite_windows(t.pixels.select("reservoir_id", "image_date"), s, "1994-12-05")
        w = w.groupBy(F.lit(s).alias("sensor"), "reservoir_id", "from_date", pixels.mosaic_end_date(F.col("to_date")).alias("mosaic_end")).agg(F.count(F.lit(1)).alias("n"))
        out = w if out is None else out.unionByName(w)
    return out


@query("quality_mosaic", check_sql("mosaic", "select reservoir_id, scene, pix, n_images, round(ndwi, 6) + 0.0 as ndwi, b3, clear from mosaic"))
def quality_mosaic(t: Tables):
    """Best image per pixel by water index."""
    return mosaic(t).select(*SCENE, "pix", "n_images", F.round("ndwi", 6).alias("ndwi"), "b3", F.col("ndwi").isNotNull().alias("clear"))


AREAS = """areas as (select reservoir_id, scene, sum(900.0 + occurrence) * 1e-6 as aoi, sum(case when ndwi >= 0.3 then 900.0 + occurrence else 0 end) * 1e-6 as water,
  sum(case when ndwi < 0.3 then 900.0 + occurrence else 0 end) * 1e-6 as land, sum(case when ndwi is null then 900.0 + occurrence else 0 end) * 1e-6 as cloud from mosaic group by 1, 2)"""


@query("cloud_percent", check_sql("mosaic", f"with {AREAS} select reservoir_id, scene, round(cloud, 9) as cloud_area, round(cloud * 100 / aoi, 6) as cloud_percent from areas"))
def cloud_percent(t: Tables):
    """Cloud area and percent per scene."""
    a = pixels.scene_areas(water(t), SCENE, F.col("water"), area())
    return a.select(*SCENE, F.round("cloud_area", 9).alias("cloud_area"), F.round("cloud_percent", 6).alias("cloud_percent"))


@query("water_area", check_sql("mosaic", f"with {AREAS} select reservoir_id, scene, round(water, 9) as water_area, round(land, 9) as non_water_area from areas"))
def water_area(t: Tables):
    """Water and non-water area per scene by index threshold."""
    a = pixels.scene_areas(water(t), SCENE, F.col("water"), area())
    return a.select(*SCENE, F.round("water_area", 9).alias("water_area"), F.round("non_water_area", 9).alias("non_water_area"))


@query("gap_correction", check_sql("mosaic", f"""with {AREAS}, h as (select reservoir_id, scene, occurrence, count(*) as n from mosaic where ndwi >= 0.3 group by 1, 2, 3),
q as (select *, avg(n) over (partition by reservoir_id, scene) as m from h),
th as (select reservoir_id, scene, min(occurrence) as threshold from q where n > 0.17 * m group by 1, 2),
gain as (select reservoir_id, scene, sum(900.0 + occurrence) * 1e-6 as gain from mosaic join th using (reservoir_id, scene) where ndwi is null and occurrence >= threshold group by 1, 2)
select reservoir_id, scene, threshold as occurrence_threshold, round(case when cloud * 100 < aoi * 90 and water > 0 then water + coalesce(gain, 0) else -1 end, 9) as corrected_area
from areas left join th using (reservoir_id, scene) left join gain using (reservoir_id, scene)"""))
def gap_correction(t: Tables):
    """Cloudy pixels filled from water occurrence."""
    g = pixels.gap_corrected_area(water(t), SCENE, F.col("water"), area())
    return g.select(*SCENE, "occurrence_threshold", F.round("corrected_area", 9).alias("corrected_area"))


@query("water_cluster")
def water_cluster(t: Tables):
    """Unsupervised water area per scene."""
    m = cut_lineage(mosaic(t))  # a product of its own, which the classification reads several times
    c = pixels.classify_water(m, SCENE, ["ndwi", "mndwi", "b7"], area())
    a = pixels.scene_areas(c, SCENE, F.col("water"), area())
    return a.select(*SCENE, F.round("water_area", 9).alias("water_area"), F.round("non_water_area", 9).alias("non_water_area"))


def apart(t: Tables) -> DataFrame:
    """Pixels whose features lie apart for water and land, with noise that is small beside that."""
    k = F.col("pix")
    noise = lambda a, b: (k * a % b) / (b * 20.0)
    water = lambda w, l: F.when(k % 3 == 0, F.lit(w)).otherwise(F.lit(l))
    return t.pixels.select("reservoir_id", "pix").distinct().select(
        "reservoir_id", "pix", (k % 101).alias("occurrence"), (water(0.6, -0.4) + noise(7919, 1009)).alias("ndwi"), (water(0.5, -0.6) + noise(6101, 997)).alias("mndwi"),
        (water(0.2, 1.1) + noise(4993, 1013)).alias("b7"), (water(3.0, 1.0) + noise(3989, 991)).alias("mbwi"))


def apart_areas(pix: DataFrame) -> DataFrame:
    c = pixels.classify_water(pix, ["reservoir_id"], ["ndwi", "mndwi", "b7"], area())
    a = pixels.scene_areas(c, ["reservoir_id"], F.col("water"), area())
    return a.select("reservoir_id", F.round("water_area", 9).alias("water_area"), F.round("non_water_area", 9).alias("non_water_area"))


@query("water_cluster_apart", check_sql("pixels", """with d as (select distinct reservoir_id, pix from pixels)
select reservoir_id, round(sum(case when pix % 3 = 0 then 900.0 + pix % 101 else 0 end) * 1e-6, 9) as water_area, round(sum(case when pix % 3 <> 0 then 900.0 + pix % 101 else 0 end) * 1e-6, 9) as non_water_area from d group by 1"""))
def water_cluster_apart(t: Tables):
    """Unsupervised water area where water and land lie apart in all features."""
    return apart_areas(apart(t))


@query("water_cluster_far", check_sql("pixels", """with d as (select distinct reservoir_id, pix from pixels), r as (select distinct reservoir_id from pixels),
a as (select reservoir_id, 900.0 + pix % 101 as area, pix % 3 = 0 as water from d union all select reservoir_id, 900.0 + (f * 7) % 101, false from r, (values (1), (2), (3)) v(f))
select reservoir_id, round(sum(case when water then area else 0 end) * 1e-6, 9) as water_area, round(sum(case when not water then area else 0 end) * 1e-6, 9) as non_water_area from a group by 1"""))
def water_cluster_far(t: Tables):
    """The same with three pixels of every reservoir far from all others, as an index with a denominator near zero gives them."""
    d = apart(t)
    f = F.explode(F.array(*map(F.lit, (1, 2, 3))))
    far = d.select("reservoir_id").distinct().withColumn("f", f).select(
        "reservoir_id", (-F.col("f")).cast(d.schema["pix"].dataType).alias("pix"), (F.col("f") * 7 % 101).cast(d.schema["occurrence"].dataType).alias("occurrence"),
        (F.col("f") * F.col("f") * 90.0).alias("ndwi"), (F.col("f") * -130.0).alias("mndwi"), F.lit(0.5).alias("b7"), F.lit(-2.0).alias("mbwi"))
    return apart_areas(d.unionByName(far))


@query("pixel_sample", check_sql("pixels", """with d as (select reservoir_id, scene, pix, count(*) as n from pixels group by 1, 2, 3)
select reservoir_id, scene, pix, n from d qualify row_number() over (partition by reservoir_id, scene order by n desc, pix) <= 25"""))
def pixel_sample(t: Tables):
    """The 25 most often imaged pixels of every scene ."""
    from lakeledger.operators.scale import lowest_k
    d = t.pixels.groupBy(*SCENE, "pix").agg(F.count(F.lit(1)).alias("n"))
    return lowest_k(d, SCENE, [F.col("n").desc(), F.col("pix")], 25)


SAMPLED = """select reservoir_id, scene, pix, n from (select reservoir_id, scene, pix, count(*) as n from pixels group by 1, 2, 3)
qualify row_number() over (partition by reservoir_id, scene order by ('0x' || substr(md5(reservoir_id || ':' || scene || ':' || pix), 1, 13))::bigint, pix) <= {k}"""


def sampled(t: Tables, k: int) -> DataFrame:
    from lakeledger.operators.scale import sample_rows
    return sample_rows(t.pixels.groupBy(*SCENE, "pix").agg(F.count(F.lit(1)).alias("n")), SCENE, ["pix"], k)


@query("scene_sample", check_sql("pixels", SAMPLED.format(k=4999)))
def scene_sample(t: Tables):
    """A sample of at most 4,999 pixels of every scene."""
    return sampled(t, 4999)


@query("scene_sample_few", check_sql("pixels", SAMPLED.format(k=7)))
def scene_sample_few(t: Tables):
    """A sample of at most seven pixels of every scene."""
    return sampled(t, 7)


SAR = """w as (select reservoir_id, image, cast(floor(date_diff('day', date '1995-01-01', image_date) / 12) as int) as k, x, y, max(vv) as vv from sar_images
  where angle > 31.66 and angle < 45.4 and image_date >= date '1995-01-01' group by all),
f as (select a.reservoir_id, a.k, a.image, a.x, a.y, max(b.vv) as v from w a join w b on a.reservoir_id = b.reservoir_id and a.k = b.k and a.image = b.image
  and abs(a.x - b.x) <= 3 and abs(a.y - b.y) <= 3 and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 9 group by all),
m as (select reservoir_id, k, x, y, median(v) as v from f group by all),
a as (select reservoir_id, k, sum(cast(v > -32 and v < -13 as int)) * 1e-4 as sarea from m group by 1, 2),
e as (select distinct reservoir_id, cast(floor(date_diff('day', date '1995-01-01', image_date) / 12) as int) as k from sar_images where image_date >= date '1995-01-01')"""


@query("sar_water", check_sql("sar_images", f"with {SAR} select e.reservoir_id, date '1995-01-01' + e.k * 12 as composite_date, round(a.sarea, 6) as sarea from e left join a using (reservoir_id, k)"))
def sar_water(t: Tables):
    """Radar water area: angle screen, disc maximum, median, backscatter range."""
    w = pixels.composite_windows(t.sar_images, "sar", "1995-01-01")
    a = pixels.sar_water_area(w, ["reservoir_id", "composite_date"], "image")
    return a.select("reservoir_id", "composite_date", F.round("sarea", 6).alias("sarea"))


# --- altimetry ------------------------------------------------------------------------------

@query("altimeter_heights", check_sql("", """select l_linenumber as track, l_orderkey as record, l_partkey as pass, round(l_extendedprice - (l_tax + l_discount + o_totalprice / 1e5 + o_custkey % 10 / 10.0 + o_custkey % 7 / 10.0 + l_quantity) + 0.7, 8) as height,
  cast(l_tax = 0.08 as int) + cast(l_discount = 0.1 as int) + cast(o_custkey % 10 = 9 as int) + cast(o_orderstatus = 'P' as int) + cast(l_returnflag = 'R' as int) as flags,
  round(date_diff('second', timestamp '2000-01-01', l_shipdate) / 86400 + 51544, 6) as mjd from lineitem join orders on l_orderkey = o_orderkey"""))
def altimeter_heights(t: Tables):
    """Height per return with looked-up corrections, flags and time."""
    return height_table(t).select("track", "record", "pass", F.round("height", 8).alias("height"), "flags", F.round("mjd", 6).alias("mjd"))


@query("altimeter_heights_older", check_sql("", """select l_linenumber as track, l_orderkey as record, l_partkey as pass, round(l_extendedprice - (l_tax + l_discount + o_totalprice / 1e5 + o_custkey % 10 / 10.0 + o_custkey % 7 / 10.0 + l_quantity), 8) as height
from lineitem join orders on l_orderkey = o_orderkey where l_tax <> 0.08 and l_discount <> 0.1 and o_custkey % 10 <> 9 and o_orderstatus <> 'P' and l_returnflag <> 'R'"""))
def altimeter_heights_older(t: Tables):
    """The older series: no offset, flagged returns dropped."""
    return height_table(t, offset=0.0, drop_flagged=True).select("track", "record", "pass", F.round("height", 8).alias("height"))


def height_table(t: Tables, **kind):
    li, o = t.raw("lineitem"), t.raw("orders")
    fast = li.select(F.col("l_linenumber").alias("track"), F.col("l_orderkey").alias("record"), F.col("l_partkey").alias("pass"),
                     F.col("l_extendedprice").alias("alt"), F.col("l_quantity").alias("range"), F.col("l_tax").alias("dry"),
                     F.col("l_discount").alias("wet"), (F.datediff(F.to_date("l_shipdate"), F.lit("2000-01-01")).cast("double") * 86400).alias("seconds"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("quality"))
    slow = o.select(F.col("o_orderkey").alias("record"), (F.col("o_totalprice") / 1e5).alias("iono"), (F.col("o_custkey") % 10 / 10.0).alias("solid_tide"),
                    (F.col("o_custkey") % 7 / 10.0).alias("pole_tide"), F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("state"))
    return altimetry.heights(fast, slow, [], "record", {"dry": 0.08, "wet": 0.1, "solid_tide": 0.9}, **kind)


IQR = """inside as (select * from returns where lat > 0.5 and lat < 9.5),
q as (select track, quantile_cont(height, 0.25) as q1, quantile_cont(height, 0.75) as q3,
  list_sort(list(height)) as l, count(*) as n from inside group by 1),
b as (select track, q1, q3, (l[cast(floor((n-1)*0.75) as int)+1] + l[cast(ceil((n-1)*0.75) as int)+1]) / 2 - (l[cast(floor((n-1)*0.25) as int)+1] + l[cast(ceil((n-1)*0.25) as int)+1]) / 2 as iqr from q),
good as (select i.* from inside i join b using (track) where height > q1 - 1.5 * iqr and height < q3 + 1.5 * iqr)"""


@query("iqr_filter", check_sql("returns", f"with {IQR} select track, cycle, count(*) as n, round(sum(height), 5) as total from good group by 1, 2"))
def iqr_filter(t: Tables):
    """Latitude band and interquartile screen."""
    inside = t.returns.where((F.col("lat") > 0.5) & (F.col("lat") < 9.5))
    return altimetry.iqr_filter(inside, ["track"]).groupBy("track", "cycle").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("height"), 5).alias("total"))


@query("exact_quartiles", check_sql("returns", """select track, count(*) as n, round(quantile_cont(height, 0.25), 8) as q1, round(quantile_cont(height, 0.5), 8) as q2, round(quantile_cont(height, 0.75), 8) as q3 from returns group by 1"""))
def exact_quartiles(t: Tables):
    """Exact quartiles of very large groups through a bracketing sketch."""
    from lakeledger.operators.scale import exact_quantiles
    q = exact_quantiles(t.returns, ["track"], "height", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return q.select("track", "n", *[F.round(f"{c}_lin", 8).alias(c) for c in ("q1", "q2", "q3")])


CYCLES = IQR + """, lev as (select track, cycle, height as h, count(*) as c from good group by 1, 2, 3),
sp as (select track, cycle, min(h) as lo, max(h) as hi, sum(c) as n, sum(h * c) / sum(c) as av from lev group by 1, 2),
rr as (select l.*, sp.n, sp.av, sum(c) over w as n1, sum(c * (h - av)) over w as s1 from lev l join sp using (track, cycle) where hi - lo > 5 window w as (partition by track, cycle order by h)),
cut as (select track, cycle, h as cut, n1 * 2 >= n as lower from rr where n - n1 > 0
  qualify row_number() over (partition by track, cycle order by round(s1 * s1 * (1.0 / n1 + 1.0 / (n - n1)), 9) desc, h) = 1),
kept as (select l.* from lev l left join cut using (track, cycle) where cut is null or (h <= cut) = lower),
ce as (select track, cycle, sum(h * c) / sum(c) as m from kept group by 1, 2),
de as (select k.*, h - m as d, round(abs(h - m), 9) as e from kept k join ce using (track, cycle)),
ru as (select *, sum(c) over w as k, sum(c * d) over w as s, sum(c * d * d) over w as q from de window w as (partition by track, cycle order by e)),
re as (select track, cycle, max(e) as reach from ru where round(sqrt(greatest(q / k - (s / k) * (s / k), 0)), 9) <= 0.3 group by 1, 2),
fin as (select g.* from good g left join cut using (track, cycle) join ce using (track, cycle) join re using (track, cycle)
  where (cut is null or (g.height <= cut) = lower) and round(abs(g.height - m), 9) <= reach),
lv as (select track, cycle, count(*) as n, avg(lat) as lat, avg(lon) as lon, avg(mjd) as mjd, avg(height) as height, stddev_pop(height) as std,
  case when count(*) > 1 then sqrt(var_samp(height) / count(*)) end as uncertainty from fin group by 1, 2)"""


@query("cycle_levels", check_sql("returns", f"with {CYCLES} select track, cycle, n, round(lat, 6) as lat, round(height, 6) as height, round(std, 6) as std, round(uncertainty, 6) as uncertainty from lv"))
def cycle_levels(t: Tables):
    """Two-group split, removal of the farthest returns and statistics of every cycle."""
    inside = t.returns.where((F.col("lat") > 0.5) & (F.col("lat") < 9.5))
    cleaned = altimetry.clean_cycles(altimetry.iqr_filter(inside, ["track"]), ["track", "cycle"])
    out = altimetry.cycle_levels(cleaned, ["track", "cycle"])
    return out.select("track", "cycle", "n", *[F.round(c, 6).alias(c) for c in ("lat", "height", "std", "uncertainty")])


GEOID = """geo as (select cast(n_nationkey % 5 as int) as i, cast(floor(n_nationkey / 5) as int) as j, n_regionkey + n_nationkey / 10.0 as g from nation),
q2 as (select track, quantile_cont(height, 0.25) as q1, quantile_cont(height, 0.75) as q3, list_sort(list(height)) as l, count(*) as n from lv group by 1),
b2 as (select track, q1, q3, (l[cast(floor((n-1)*0.75) as int)+1] + l[cast(ceil((n-1)*0.75) as int)+1]) / 2 - (l[cast(floor((n-1)*0.25) as int)+1] + l[cast(ceil((n-1)*0.25) as int)+1]) / 2 as iqr from q2),
lf as (select lv.*, least(greatest(lon / 2.0, 0), 4) as gx, least(greatest(lat / 2.5, 0), 4) as gy from lv join b2 using (track) where height > q1 - 1.5 * iqr and height < q3 + 1.5 * iqr),
ci as (select *, cast(least(floor(gx), 3) as int) as i, cast(least(floor(gy), 3) as int) as j from lf),
ge as (select c.*, (1 - (gx - c.i)) * (1 - (gy - c.j)) * a.g + (gx - c.i) * (1 - (gy - c.j)) * b.g + (1 - (gx - c.i)) * (gy - c.j) * d.g + (gx - c.i) * (gy - c.j) * e.g as geoid
  from ci c join geo a on a.i = c.i and a.j = c.j join geo b on b.i = c.i + 1 and b.j = c.j join geo d on d.i = c.i and d.j = c.j + 1 join geo e on e.i = c.i + 1 and e.j = c.j + 1),
ye as (select *, (mjd + 2108 - 50000) / 365.25 + 1990 as yf from ge)"""


@query("water_levels", check_sql("returns", f"""with {CYCLES}, {GEOID} select track, cycle, round(height - geoid - 0.7, 8) as level,
make_date(cast(floor(yf) as int), 1, 1) + cast(floor((yf - floor(yf)) * (365 + cast((floor(yf) % 4 = 0 and floor(yf) % 100 <> 0) or floor(yf) % 400 = 0 as int))) as int) as date from ye"""))
def water_levels(t: Tables):
    """Complete altimetry chain: screens, cycles, geoid and date."""
    from lakeledger.operators.spatial import bilinear
    lv = altimetry.water_levels(t.returns, ["track"], "cycle", F.lit(0.5), F.lit(9.5))
    k = F.col("n_nationkey")
    geoid = t.raw("nation").select((k % 5).cast("int").alias("i"), F.floor(k / 5).cast("int").alias("j"),
                                   (F.col("n_regionkey") + k / 10.0).alias("g"))
    placed = bilinear(lv, geoid, "lon", "lat", "i", "j", "g", "geoid", origin=(0.0, 0.0), size=(2.0, 2.5), shape=(5, 5))
    return altimetry.datum_levels(placed).select("track", "cycle", F.round("level", 8).alias("level"), "date")
