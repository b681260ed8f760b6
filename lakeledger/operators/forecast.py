"""Outflow forecasts under operating scenarios.

All scenarios of all reservoirs form one long grid. The at most sixteen days of one case are
folded in order with the reservoir's curve at hand, so each case is one row until its result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.functions.columns import M2_PER_KM2, M3_PER_MCM, SECONDS_PER_DAY, let, mm_over_km2_to_m3, non_negative
from lakeledger.operators.curves import array_lookup, curve_arrays

# Fixed values.
SURPLUS_DAYS = 16
RELEASE_DAYS = 15
STORAGE_PERCENTS = (0.5, 1.0, 2.5)
CASES = ("GC", "GO", "CL", "RC", "ST")


def rule_fraction(rule: Column, date: Column) -> Column:
    """Stored fraction on a date, from a map of monthly values; December runs into January. NULL where a month is missing."""
    m, part = F.month(date), F.dayofmonth(date) / F.lit(30.0)
    here, there = F.try_element_at(rule, m), F.try_element_at(rule, m % 12 + 1)
    return here + (there - here) * part


def rule_maps(rule: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fractions by month per key."""
    return rule.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("month").cast("int"), "s_by_smax"))).alias("rule"))


def scenario_grid(reservoirs: DataFrame, cases: Sequence[str] = ("GC", "GO", "RC", "ST"), percents: Sequence[float] = STORAGE_PERCENTS,
                  target_level: str | None = None, custom_mcm: str | None = None, room_percent: str | None = None,
                  smax: str = "smax", rule: str | None = "rule") -> DataFrame:
    """One row per reservoir and applicable case with its label and value.

    A storage case needs the capacity, a rule-curve case the curve, a level case the target. The
    named columns hold per-reservoir targets: a level in metres, a volume in million m3, the room
    left in percent.
    """
    rows = []
    none = F.lit(None).cast("double")
    case = lambda code, label, value, ok: F.when(ok, F.struct(F.lit(code).alias("scenario"), label.alias("label"), value.alias("value")))
    has_smax = F.col(smax).isNotNull() & ~F.isnan(smax)
    if "GC" in cases:
        rows.append(case("GC", F.lit("GC"), none, F.lit(True)))
    if "GO" in cases:
        rows.append(case("GO", F.lit("GO"), none, F.lit(True)))
    if "CL" in cases and target_level:
        rows.append(case("CL", F.lit("CL"), F.col(target_level).cast("double"), F.col(target_level).isNotNull()))
    if "RC" in cases and rule:
        rows.append(case("RC", F.lit("RC"), none, has_smax & F.col(rule).isNotNull()))
    if "ST" in cases:
        for p in percents:
            rows.append(case("ST", F.lit(f"ST {p:g}%"), F.col(smax) * (p / 100.0 * M3_PER_MCM), has_smax))
        if room_percent:
            label = F.concat(F.lit("ST "), F.format_string("%.1f", F.col(room_percent)), F.lit("% room"))
            rows.append(case("ST", label, F.col(room_percent) / 100.0 * F.col(smax) * M3_PER_MCM, has_smax & F.col(room_percent).isNotNull()))
        if custom_mcm:
            label = F.concat(F.lit("ST "), F.format_string("%.1f", F.col(custom_mcm)), F.lit("MCM"))
            rows.append(case("ST", label, F.col(custom_mcm) * M3_PER_MCM, F.col(custom_mcm).isNotNull()))
    return reservoirs.withColumn("_case", F.explode(F.array_compact(F.array(*rows)))).select("*", "_case.*").drop("_case")


def forecast_days(inflow: DataFrame, starts: DataFrame, keys: Sequence[str], lead: int = 15) -> DataFrame:
    """The forecast window of each base date as one sorted array of (date, inflow m3/day)."""
    j = inflow.join(starts.select(*keys, "basedate"), list(keys))
    j = j.where((F.col("date") >= F.col("basedate")) & (F.col("date") <= F.date_add("basedate", lead)))
    day = F.struct("date", (F.col("streamflow") * SECONDS_PER_DAY).alias("inflow"))
    return j.groupBy(*keys, "basedate").agg(F.sort_array(F.collect_list(day)).alias("days"))


def fold_case(scenario: Column, value: Column, days: Column, curve: Column, area0: Column, evap: Column, target: Column,
              surplus_days: int, release_days: int, legacy: bool) -> Column:
    """Daily rows of one case.

    The state is the area, the level that was known the day before (the one a target level is
    tested against) and the storage still to be filled. Over an area of zero a change of storage
    gives no level, so a case that follows the level ends with the day before.
    """
    level = lambda a: array_lookup(curve, a, "a", "z")
    total = F.aggregate(days, F.lit(0.0), lambda s, d: s + d["inflow"] - evap)
    evap_sum = evap * F.size(days)
    row = "struct<date:date,inflow:double,outflow:double,dels:double,delh:double,elevation:double,area:double>"

    def run(start):
        z0, net = start["z0"], start["net"]
        surplus = F.when(value - z0 > 0, F.lit(0.0)).otherwise((value - z0) * area0 * M2_PER_KM2 + evap_sum)
        zero = F.struct(area0.cast("double").alias("area"), z0.alias("seen"), value.cast("double").alias("left"), F.array().cast(f"array<{row}>").alias("rows"))

        def step(s, d):
            gain = d["inflow"] - evap
            store = F.struct(F.lit(0.0).alias("o"), gain.alias("ds"), s["left"].alias("left"))
            release = surplus / surplus_days
            above = F.when(surplus == 0, F.struct(gain.alias("o"), F.lit(0.0).alias("ds"), s["left"].alias("left"))).otherwise(F.struct(
                (d["inflow"] - release).alias("o"), ((release - d["inflow"] - evap) if legacy else (release - evap)).alias("ds"), s["left"].alias("left")))
            even = (net - target) / release_days
            curve_rule = F.struct(even.alias("o"), ((d["inflow"] - even) if legacy else (gain - even)).alias("ds"), s["left"].alias("left"))
            fill = F.when(s["left"] <= 0, F.lit(0.0)).when(gain <= s["left"], gain).otherwise(s["left"])
            fraction = F.struct((gain - fill).alias("o"), fill.alias("ds"), (s["left"] - fill).alias("left"))
            move = (F.when(scenario == "GC", store)
                    .when(scenario == "CL", F.when(s["seen"] > value, above).otherwise(store))
                    .when(scenario == "RC", F.when(net < target, store).otherwise(curve_rule))
                    .otherwise(F.when(net < value, store).otherwise(fraction)))

            def settle(m):
                def place(p):
                    def close(a):
                        new = F.struct(d["date"].alias("date"), d["inflow"].alias("inflow"), m["o"].alias("outflow"), m["ds"].alias("dels"),
                                       p["dh"].alias("delh"), (p["z"] + p["dh"]).alias("elevation"), a.alias("area"))
                        return F.struct(a.alias("area"), p["z"].alias("seen"), m["left"].alias("left"), F.concat(s["rows"], F.array(new)).alias("rows"))
                    return let(array_lookup(curve, p["z"] + p["dh"], "z", "a"), close)
                return let(F.struct(F.try_divide(m["ds"], s["area"] * M2_PER_KM2).alias("dh"), level(s["area"]).alias("z")), place)
            return let(move, settle)

        return F.filter(F.aggregate(days, zero, step)["rows"], lambda r: r["elevation"].isNotNull())

    folded = let(F.struct(level(area0.cast("double")).alias("z0"), total.alias("net")), run)
    null = F.lit(None).cast("double")
    opened = F.transform(days, lambda d: F.struct(
        d["date"].alias("date"), d["inflow"].alias("inflow"), (d["inflow"] - evap).alias("outflow"), F.lit(0.0).alias("dels"),
        null.alias("delh"), null.alias("elevation"), area0.cast("double").alias("area")))
    return F.when(scenario == "GO", opened).otherwise(folded)


def forecast(inflow: DataFrame, reservoirs: DataFrame, curve: DataFrame, keys: Sequence[str], curve_keys: Sequence[str] | None = None,
             rule: DataFrame | None = None, rule_keys: Sequence[str] | None = None, lead: int = 15, surplus_days: int = SURPLUS_DAYS,
             release_days: int = RELEASE_DAYS, legacy: bool = False, **grid) -> DataFrame:
    """Daily forecast of every applicable case.

    reservoirs: keys, basedate, last_area (km2), last_evaporation (mm) and smax (million m3);
    inflow: keys, date, streamflow (m3/s). Evaporation stays at its last value. Released water,
    storage change and evaporation close the balance; ``legacy`` uses the storage terms of the
    older rule for level and rule-curve cases, which do not. An empty ``rule_keys`` means one
    rule curve for all.
    """
    keys = list(keys)
    base = reservoirs
    if rule is None:
        base = base.withColumn("rule", F.lit(None).cast("map<int,double>"))
    elif rule_keys is not None and not rule_keys:
        base = base.withColumn("rule", rule_maps(rule, []).scalar())
    else:
        base = base.join(rule_maps(rule, rule_keys or keys), list(rule_keys or keys), "left")
    days = forecast_days(inflow, base, keys, lead)
    ready = base.join(days, [*keys, "basedate"]).join(curve_arrays(curve, curve_keys or keys), curve_keys or keys)
    ready = ready.withColumn("evaporation", mm_over_km2_to_m3(F.col("last_evaporation"), F.col("last_area")))
    end = F.date_add("basedate", lead)
    ready = ready.withColumn("_target", (rule_fraction(F.col("rule"), end) - rule_fraction(F.col("rule"), F.col("basedate"))) * F.col("smax") * M3_PER_MCM)
    cases = scenario_grid(ready, **grid)
    rows = fold_case(F.col("scenario"), F.col("value"), F.col("days"), F.col("curve"), F.col("last_area"), F.col("evaporation"),
                     F.col("_target"), surplus_days, release_days, legacy)
    return cases.withColumn("_rows", rows).select(*keys, "basedate", "scenario", "label", "value", "evaporation", F.inline("_rows"))


def room_left(areas: DataFrame, keys: Sequence[str], area: str = "area", date: str = "date") -> DataFrame:
    """Percent of the area distribution above the latest area, one decimal."""
    from lakeledger.operators.series import percentile_of_score
    last = areas.groupBy(*keys).agg(F.max_by(area, date).alias("_score"))
    p = percentile_of_score(areas, last, keys, area, "_score")
    return p.select(*keys, F.round(100 * (1 - F.col("percentile") / 100), 1).alias("room_percent"))


def observed_dams(reservoirs: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reservoirs with observed outflow; gauges without it are not forecast."""
    return reservoirs.join(observed.select(*keys).distinct(), list(keys), "left_semi")


def window_totals(fc: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inflow minus evaporation over the window of each case."""
    return fc.groupBy(*keys, "basedate", "label").agg(
        F.sum("inflow").alias("inflow"), F.sum("evaporation").alias("evaporation"),
        (F.sum("inflow") - F.sum("evaporation")).alias("net_inflow"))


def product_columns(fc: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Wide product: one outflow, storage and area column per case, outflow not below zero."""
    wide = []
    for lab in labels:
        pick = lambda c: F.max(F.when(F.col("label") == lab, c))
        wide += [pick(non_negative(F.col("outflow"))).alias(f"outflow (m3/d) [case: {lab}]"),
                 pick(F.col("dels")).alias(f"delS (m) [case: {lab}]"), pick(F.col("area")).alias(f"area (km2) [case: {lab}]")]
    return fc.groupBy(*keys, "basedate", "date").agg(*wide)
