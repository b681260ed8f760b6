"""Gridded weather: combining, imputing, climatology correction, cut-over between sources.

A cell table has integer keys ``cell_x`` and ``cell_y`` and one row per cell and day, so a window
over a cell is bounded by the calendar and a window over a grid line by the grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.functions.columns import day_number, ordered_pair, wind_speed
from lakeledger.operators.series import START, after_last, calendar, cut_over, joined_by, ordered

CELL = ["cell_x", "cell_y"]
# Fixed values.
STATE_DAYS = 90
HISTORY_DAYS = 120
LEAD_DAYS = 15
Z_LIMIT = 3.0
GAP_LIMIT = 30


def combine(variables: dict[str, DataFrame], keys: Sequence[str] = ("date", *CELL)) -> DataFrame:
    """One row per key with a column per variable; a variable missing at a key is NULL.

    Stacked and grouped once, instead of one join per variable.
    """
    names = list(variables)
    out = None
    for n, df in variables.items():
        part = df.select(*keys, *[(F.col(n) if n == m else F.lit(None)).cast("double").alias(m) for m in names])
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])


def check_temperatures(df: DataFrame) -> DataFrame:
    """Swap the temperature extremes where they are the wrong way round."""
    high, low = ordered_pair(F.col("tmax"), F.col("tmin"))
    return df.select(*[high.alias("tmax") if c == "tmax" else low.alias("tmin") if c == "tmin" else F.col(c) for c in df.columns])


def with_wind(df: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    return df.withColumn("wind", wind_speed(F.col(u), F.col(v)))


def daily_mean(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """Sub-daily values averaged per day."""
    return df.groupBy(*keys, F.to_date(ts).alias("date")).agg(*[F.avg(v).alias(v) for v in values])


def cell_mean(df: DataFrame, cells: DataFrame, ident: str, values: Sequence[str], date: str = "date") -> DataFrame:
    """Mean over the cells of each reservoir and day."""
    return df.join(cells, CELL).groupBy(ident, date).agg(*[F.avg(v).alias(v) for v in values])


def fill_axis(df: DataFrame, lines: Sequence[str], pos: str | Column, values: Sequence[str], limit: int | None = None) -> DataFrame:
    """Linear fill along one axis, continued beyond both ends by the two nearest known points.

    ``lines`` identify a line of the grid. With ``limit`` only the first so many gaps of a run are
    filled. A line with fewer than two known points stays as it is.
    """
    x = F.col(pos) if isinstance(pos, str) else pos
    staged = df.withColumn("_x", x.cast("double"))
    up, down = ordered(lines, "_x"), ordered(lines, F.col("_x").desc())
    before, after = up.rowsBetween(START, -1), down.rowsBetween(START, -1)
    for v in values:
        c = F.col(v).cast("double")
        point = F.when(c.isNotNull(), F.struct(F.col("_x").alias("x"), c.alias("v")))
        for side, w in (("p", before), ("n", after)):
            staged = staged.withColumn(f"_{side}1_{v}", F.last(point, ignorenulls=True).over(w))
            pair = F.when(c.isNotNull(), F.struct(F.col("_x").alias("x"), c.alias("v"), F.col(f"_{side}1_{v}.x").alias("x2"), F.col(f"_{side}1_{v}.v").alias("v2")))
            staged = staged.withColumn(f"_{side}_{v}", F.last(pair, ignorenulls=True).over(w))
        run = F.row_number().over(up) - F.last(F.when(c.isNotNull(), F.col("_i")), ignorenulls=True).over(before)
        staged = staged.withColumn("_i", F.row_number().over(up))
        staged = staged.withColumn(f"_run_{v}", F.coalesce(run, F.col("_i")))
    out = []
    for name in df.columns:
        if name not in values:
            out.append(F.col(name))
            continue
        p, n = F.col(f"_p_{name}"), F.col(f"_n_{name}")
        line = lambda x1, v1, x2, v2: v1 + (v2 - v1) * (F.col("_x") - x1) / (x2 - x1)
        guess = (F.when(p.isNotNull() & n.isNotNull(), line(p["x"], p["v"], n["x"], n["v"]))
                 .when(p.isNotNull() & p["x2"].isNotNull(), line(p["x"], p["v"], p["x2"], p["v2"]))
                 .when(n.isNotNull() & n["x2"].isNotNull(), line(n["x"], n["v"], n["x2"], n["v2"])))
        if limit is not None:
            guess = F.when(F.col(f"_run_{name}") <= limit, guess)
        out.append(F.coalesce(F.col(name).cast("double"), guess).alias(name))
    return staged.select(*out)


def impute(df: DataFrame, values: Sequence[str], extent: str = "extent", limit: int = GAP_LIMIT) -> DataFrame:
    """Fill along time, then longitude, then latitude; cells outside the basin keep their values."""
    originals = [F.col(v).alias(f"_raw_{v}") for v in values]
    staged = df.select("*", *originals)
    staged = fill_axis(staged, CELL, day_number(F.col("date")), values, limit)
    staged = fill_axis(staged, ["date", "cell_y"], "cell_x", values)
    staged = fill_axis(staged, ["date", "cell_x"], "cell_y", values)
    return staged.select(*[F.when(F.col(extent), F.col(c)).otherwise(F.col(f"_raw_{c}")).alias(c) if c in values else F.col(c)
                           for c in df.columns])


def full_grid(df: DataFrame, cells: DataFrame, values: Sequence[str], start: str, end: str) -> DataFrame:
    """Every cell on every day, NULL where the table has no row."""
    days = calendar(cells.select(*CELL, F.lit(start).cast("date").alias("_a"), F.lit(end).cast("date").alias("_b")), "_a", "_b").drop("_a", "_b")
    return days.join(df.select(*CELL, "date", *values), [*CELL, "date"], "left")


def week_climatology(df: DataFrame, value: str = "precip") -> DataFrame:
    """Mean and population standard deviation of the log of positive values per cell and ISO week."""
    logs = F.when(F.col(value) > 0, F.log(value))
    return df.groupBy(*CELL, F.weekofyear("date").alias("week")).agg(F.avg(logs).alias("log_mean"), F.stddev_pop(logs).alias("log_std"))


def climatology_correction(df: DataFrame, climatology: DataFrame, value: str = "precip", limit: float = Z_LIMIT) -> DataFrame:
    """Values whose log is beyond ``limit`` deviations of their week take the climatological mean.

    Values that are not positive have no logarithm and stay as they are.
    """
    joined = df.withColumn("week", F.weekofyear("date")).join(climatology, [*CELL, "week"], "left")
    logv = F.when(F.col(value) > 0, F.log(value))
    z = F.try_divide(logv - F.col("log_mean"), F.col("log_std"))
    extreme = F.coalesce(F.abs(z) > limit, F.lit(False))
    return joined.withColumn(value, F.when(extreme, F.exp("log_mean")).otherwise(F.col(value))).select(*df.columns)


def source_cut_over(parts: Sequence[DataFrame], starts: Sequence[str]) -> DataFrame:
    """Observed, low-latency and forecast tables joined at their cut-over dates."""
    return cut_over(parts, starts)


def state_and_forcing(df: DataFrame, start: str, end: str, days: int = STATE_DAYS) -> tuple[DataFrame, DataFrame]:
    """The days before ``start`` that define the initial state, and the run itself."""
    d, s = F.col("date"), F.lit(start).cast("date")
    return (df.where((d >= F.date_sub(s, days)) & (d < s)), df.where((d >= s) & (d <= F.lit(end).cast("date"))))


def extend_history(existing: DataFrame, new: DataFrame, start: str, days: int = HISTORY_DAYS, keys: Sequence[str] = ()) -> DataFrame:
    """Existing rows of the last ``days`` days before ``start``, and of every key the new rows after its last existing
    date; a key that is new gives all its rows. Without keys the table is one series."""
    tail = existing.where(F.col("date") >= F.date_sub(F.lit(start).cast("date"), days))
    return tail.unionByName(after_last(existing, new, keys), allowMissingColumns=True)


def keep_recent(df: DataFrame, days: int = 365, keys: Sequence[str] = ()) -> DataFrame:
    """The last ``days`` days of every key, counted from its own last date."""
    last = df.groupBy(*keys).agg(F.max("date").alias("_last"))
    return joined_by(df, last, keys, "inner").where(F.col("date") > F.date_sub("_last", days)).select(*df.columns)


def forecast_days(bases: DataFrame, base: str = "basedate", lead: int = LEAD_DAYS) -> DataFrame:
    """The dates a forecast covers, base date included."""
    if not 0 <= lead <= LEAD_DAYS:
        raise ValueError(f"the lead time must lie between 0 and {LEAD_DAYS} days")
    return calendar(bases.withColumn("_end", F.date_add(base, lead)), base, "_end").drop("_end")


def reduce_grids(grids: Sequence[DataFrame], value: str, how=F.avg, keys: Sequence[str] = CELL) -> DataFrame:
    """Cell by cell reduction of several grids with any aggregate function."""
    out = grids[0].select(*keys, value)
    for g in grids[1:]:
        out = out.unionByName(g.select(*keys, value))
    return out.groupBy(*keys).agg(how(value).alias(value))


