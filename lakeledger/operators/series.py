"""Calendar operators on per-key daily series.

Every function expects at most one row per key and date (see ``scale.pick_rows``), so a window
over one key is bounded by the length of the calendar and never by the number of raw rows.
Frames run from the start of the partition; look-ahead uses a second, descending order, because a
frame that is open at its end costs quadratic time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.functions.columns import day_number, let

START = Window.unboundedPreceding
HERE = Window.currentRow


def ordered(keys: Sequence[str], *order) -> "Window":
    return Window.partitionBy(*keys).orderBy(*order)


# --- differences ----------------------------------------------------------------------------

def days_passed(keys: Sequence[str], date: str = "date", first: int | None = 0) -> Column:
    """Days since the row before; ``first`` for the first row of a key."""
    gap = F.datediff(F.col(date), F.lag(date).over(ordered(keys, date)))
    return gap if first is None else F.coalesce(gap, F.lit(first))


def change(keys: Sequence[str], value: str, date: str = "date") -> Column:
    return F.col(value) - F.lag(value).over(ordered(keys, date))


def percent_change(df: DataFrame, keys: Sequence[str], value: str, out: str, date: str = "date") -> DataFrame:
    """Relative change to the row before; a gap takes the last known value first."""
    w = ordered(keys, date)
    padded = F.last(value, ignorenulls=True).over(w.rowsBetween(START, HERE))
    return (df.withColumn("_pad", padded)
            .withColumn(out, F.try_divide(F.col("_pad"), F.lag("_pad").over(w)) - 1).drop("_pad"))


def daily_trend(keys: Sequence[str], value: str, date: str = "date") -> Column:
    """Change per day over two rows."""
    w = ordered(keys, date)
    return change(keys, value, date) / F.datediff(F.col(date), F.lag(date).over(w))


# --- calendars ------------------------------------------------------------------------------

def regular_grid(df: DataFrame, keys: Sequence[str], step: int | str, values: Sequence[str],
                 date: str = "date", flag: str = "observed") -> DataFrame:
    """Rows every ``step`` days from the first to the last date of a key.

    Observations off the grid are dropped, missing grid dates get NULL values and ``flag`` false.
    Each grid observation emits the empty dates that follow it, so no calendar join is needed.
    ``step`` is a number of days or the name of a column that is constant within a key.
    """
    every = F.col(step) if isinstance(step, str) else F.lit(int(step))
    whole = Window.partitionBy(*keys)
    on_grid = (df.withColumn("_first", F.min(date).over(whole)).withColumn("_last", F.max(date).over(whole))
               .where(F.pmod(F.datediff(F.col(date), F.col("_first")), every) == 0))
    following = F.lead(date).over(ordered(keys, date))
    stop = F.coalesce(F.date_sub(following, 1), F.col("_last"))
    count = F.floor(F.datediff(F.col("_stop"), F.col(date)) / every)
    spread = (on_grid.withColumn("_stop", stop)
              .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), count))))
    keep = [c for c in df.columns if c not in set(values) and c != date]
    return spread.select(
        *keep, F.date_add(F.col(date), (F.col("_k") * every).cast("int")).alias(date),
        *[F.when(F.col("_k") == 0, F.col(c)).alias(c) for c in values],
        (F.col("_k") == 0).alias(flag))


def daily_frame(df: DataFrame, keys: Sequence[str], values: Sequence[str], date: str = "date") -> DataFrame:
    """Every day between the first and the last date, without filling."""
    return regular_grid(df, keys, 1, values, date).drop("observed")


def calendar(bounds: DataFrame, start: str, end: str, step: int = 1, out: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` of each row of ``bounds``."""
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"), F.make_dt_interval(F.lit(step)))
    return bounds.withColumn(out, F.explode(days))


# --- linear fills ---------------------------------------------------------------------------

def _linear(value: str, pos: str, prev: str, nxt: str) -> Column:
    p, n = F.col(prev), F.col(nxt)
    between = p["v"] + (n["v"] - p["v"]) * (F.col(pos) - p["x"]) / (n["x"] - p["x"])
    return (F.when(F.col(value).isNotNull(), F.col(value))
            .when(p.isNull(), F.lit(None).cast("double"))
            .when(n.isNull(), p["v"]).otherwise(between))


def _fill(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: str, pos: Column) -> DataFrame:
    up, down = ordered(keys, F.col(order)), ordered(keys, F.col(order).desc())
    staged = df.withColumn("_x", pos)
    point = lambda v: F.when(F.col(v).isNotNull(), F.struct(F.col("_x").alias("x"), F.col(v).cast("double").alias("v")))
    staged = staged.select("*", *[F.last(point(v), ignorenulls=True).over(up.rowsBetween(START, HERE)).alias(f"_p_{v}") for v in values])
    staged = staged.select("*", *[F.last(point(v), ignorenulls=True).over(down.rowsBetween(START, HERE)).alias(f"_n_{v}") for v in values])
    return staged.select(*[_linear(c, "_x", f"_p_{c}", f"_n_{c}").alias(c) if c in values else F.col(c) for c in df.columns])


def fill_by_position(df: DataFrame, keys: Sequence[str], values: Sequence[str], date: str = "date") -> DataFrame:
    """Linear between neighbours by row number; leading gaps stay, trailing ones take the last value."""
    return _fill(df, keys, values, date, F.row_number().over(ordered(keys, date)))


def fill_by_time(df: DataFrame, keys: Sequence[str], values: Sequence[str], date: str = "date") -> DataFrame:
    """Linear between neighbours by day; leading gaps stay, trailing ones take the last value."""
    return _fill(df, keys, values, date, day_number(F.col(date)))


def to_daily(df: DataFrame, keys: Sequence[str], values: Sequence[str], date: str = "date") -> DataFrame:
    """Mean per day, then linear between observed days."""
    means = df.groupBy(*keys, date).agg(*[F.avg(v).alias(v) for v in values])
    return fill_by_time(daily_frame(means, keys, values, date), keys, values, date)


def extend_forward(daily: DataFrame, keys: Sequence[str], values: Sequence[str], end: Column,
                   date: str = "date") -> DataFrame:
    """Repeat the last row of a key day by day up to ``end``."""
    following = F.lead(date).over(ordered(keys, date))
    copies = F.when(following.isNull(), F.greatest(F.datediff(end, F.col(date)), F.lit(0))).otherwise(F.lit(0))
    return (daily.withColumn("_n", copies).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n"))))
            .withColumn(date, F.date_add(F.col(date), F.col("_k"))).drop("_n", "_k"))


def spread_totals(df: DataFrame, keys: Sequence[str], value: str, date: str = "date") -> DataFrame:
    """Divide each total evenly over the days since the one before (the first: since the series began).

    Days after the last total get zero.
    """
    whole = Window.partitionBy(*keys)
    framed = df.withColumn("_first", F.min(date).over(whole)).withColumn("_last", F.max(date).over(whole))
    known = framed.where(F.col(value).isNotNull())
    w = ordered(keys, date)
    start = F.coalesce(F.date_add(F.lag(date).over(w), 1), F.col("_first"))
    tail = F.when(F.lead(date).over(w).isNull(), F.datediff("_last", date)).otherwise(F.lit(0))
    spans = known.select(*keys, date, value, start.alias("_from"), tail.alias("_tail"))
    length = F.datediff(F.col(date), F.col("_from")) + 1
    spans = spans.withColumn("_len", length).withColumn(
        "_k", F.explode(F.sequence(F.lit(0), F.col("_len") + F.col("_tail") - 1)))
    return spans.select(*keys, F.date_add("_from", F.col("_k")).alias(date),
                        F.when(F.col("_k") < F.col("_len"), F.col(value) / F.col("_len")).otherwise(F.lit(0.0)).alias(value))


def neighbour_fill(df: DataFrame, keys: Sequence[str], values: Sequence[str], date: str = "date") -> DataFrame:
    """A missing day takes the mean of the days beside it, else the day before, else the day after."""
    framed = daily_frame(df, keys, values, date)
    w = ordered(keys, date)
    picks = []
    for v in values:
        p, n = F.lag(v).over(w), F.lead(v).over(w)
        picks.append(F.coalesce(F.col(v), (p + n) / 2, p, n).alias(v))
    return framed.select(*[c for c in framed.columns if c not in values], *picks)


# --- as-of ----------------------------------------------------------------------------------

def value_at(targets: DataFrame, series: DataFrame, keys: Sequence[str], value: str, out: str,
             date: str = "date") -> DataFrame:
    """Linear value of ``series`` at the dates of ``targets``; NULL outside its range.

    Both sides are put in one ordered stream, so each key is shuffled once and no pairs are built.
    """
    extra = [c for c in targets.columns if c not in keys and c != date]
    side = F.struct(*[F.col(c) for c in extra]) if extra else F.struct(F.lit(1).alias("_one"))
    t = targets.select(*keys, date, side.alias("_t"), F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_q"))
    s = series.where(F.col(value).isNotNull()).select(
        *keys, date, F.lit(None).cast(t.schema["_t"].dataType).alias("_t"),
        F.col(value).cast("double").alias("_v"), F.lit(0).alias("_q"))
    x = day_number(F.col(date))
    both = t.unionByName(s).withColumn("_x", x).withColumn(
        "_pt", F.when(F.col("_q") == 0, F.struct(F.col("_x").alias("x"), F.col("_v").alias("v"))))
    up = ordered(keys, F.col(date), F.col("_q")).rowsBetween(START, HERE)
    down = ordered(keys, F.col(date).desc(), F.col("_q")).rowsBetween(START, HERE)
    both = both.withColumn("_p", F.last("_pt", ignorenulls=True).over(up))
    both = both.withColumn("_n", F.last("_pt", ignorenulls=True).over(down)).where(F.col("_q") == 1)
    p, n = F.col("_p"), F.col("_n")
    value_col = (F.when(p.isNull() | n.isNull(), F.lit(None).cast("double"))
                 .when(p["x"] == n["x"], p["v"])
                 .otherwise(p["v"] + (n["v"] - p["v"]) * (F.col("_x") - p["x"]) / (n["x"] - p["x"])))
    return both.select(*keys, date, *[F.col("_t")[c].alias(c) for c in extra], value_col.alias(out))


def lookback_first(df: DataFrame, keys: Sequence[str], value: str, out: str, days: int = 14,
                   date: str = "date") -> DataFrame:
    """First value within the last ``days`` days; NULL while the series is younger than that."""
    staged = df.withColumn("_d", day_number(F.col(date)))
    w = Window.partitionBy(*keys).orderBy("_d").rangeBetween(-days, 0)
    begin = F.min("_d").over(ordered(keys, "_d").rowsBetween(START, HERE))
    first = F.first(value).over(w)
    return staged.withColumn(out, F.when(F.col("_d") - days >= begin, first)).drop("_d")


def interval_sums(ends: DataFrame, flow: DataFrame, keys: Sequence[str], value: str, out: str,
                  date: str = "date", both_closed: bool = False) -> DataFrame:
    """Sum of a daily flow over ``(date before, date]`` for each row of ``ends``.

    One running sum over both sides in date order; an interval is the difference of two ends.
    ``both_closed`` also counts the day the interval starts on. The first row of a key is NULL.
    """
    extra = [c for c in ends.columns if c not in keys and c != date]
    side = F.struct(*[F.col(c) for c in extra]) if extra else F.struct(F.lit(1).alias("_one"))
    e = ends.select(*keys, date, side.alias("_t"), F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_end"))
    f = flow.select(*keys, date, F.lit(None).cast(e.schema["_t"].dataType).alias("_t"),
                    F.col(value).cast("double").alias("_v"), F.lit(0).alias("_end"))
    upto = ordered(keys, date, "_end").rowsBetween(START, HERE)
    same_day = F.sum(F.coalesce("_v", F.lit(0.0))).over(Window.partitionBy(*keys, date))
    run = e.unionByName(f).withColumn("_run", F.sum(F.coalesce("_v", F.lit(0.0))).over(upto))
    if both_closed:
        run = run.withColumn("_day", same_day)
    at_end = run.where(F.col("_end") == 1)
    w = ordered(keys, date)
    total = F.col("_run") - F.lag("_run").over(w)
    if both_closed:
        total = total + F.lag("_day").over(w)
    return at_end.select(*keys, date, *[F.col("_t")[c].alias(c) for c in extra], total.alias(out))


# --- smoothing ------------------------------------------------------------------------------

def weighted_smooth(keys: Sequence[str], value: str, weight: str | Column, date: str = "date", window: int = 3) -> Column:
    """Centred weighted mean; short at both ends, NULL where the frame holds a NULL."""
    if window < 1 or window % 2 == 0:
        raise ValueError("the window must be a positive odd number")
    half = window // 2
    frame = ordered(keys, date).rowsBetween(-half, half)
    w = F.col(weight) if isinstance(weight, str) else weight
    total = F.try_divide(F.sum(F.col(value) * w).over(frame), F.sum(w).over(frame))
    complete = F.count(F.col(value) * w).over(frame) == F.count(F.lit(1)).over(frame)
    return F.when(complete, total)


# Least-squares cubic over seven points, centre and first three positions.
SG_CENTRE = ([-2, 3, 6, 7, 6, 3, -2], 21)
SG_EDGE = (
    ([39, 8, -4, -4, 1, 4, -2], 42),
    ([8, 19, 16, 6, -4, -7, 4], 42),
    ([-4, 16, 19, 12, 2, -4, 1], 42),
)


def savgol_smooth(keys: Sequence[str], value: str, date: str = "date") -> Column:
    """Cubic smoothing over seven rows; the ends use the fit of the outermost seven rows."""
    w = ordered(keys, date)
    shifted = {k: (F.col(value) if k == 0 else F.lag(value, -k).over(w) if k < 0 else F.lead(value, k).over(w))
               for k in range(-6, 7)}
    dot = lambda coef, base, offsets: sum((F.lit(float(c)) * shifted[o] for c, o in zip(coef, offsets)), F.lit(0.0)) / base
    rn = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    out = F.when(n < 7, F.lit(None).cast("double"))
    for i, (coef, base) in enumerate(SG_EDGE):
        out = out.when(rn == i + 1, dot(coef, base, [k - i for k in range(7)]))
        out = out.when(n - rn == i, dot(coef, base, [i - k for k in range(7)]))
    coef, base = SG_CENTRE
    return out.otherwise(dot(coef, base, range(-3, 4)))


def running_trapezoid(df: DataFrame, keys: Sequence[str], x: str, y: Column, out: str) -> DataFrame:
    """Cumulative trapezoid of ``y`` over ``x``, zero at the first point."""
    w = ordered(keys, x)
    staged = df.withColumn("_y", y)
    piece = (F.col("_y") + F.lag("_y").over(w)) / 2 * (F.col(x) - F.lag(x).over(w))
    return (staged.withColumn("_piece", F.coalesce(piece, F.lit(0.0)))
            .withColumn(out, F.sum("_piece").over(w.rowsBetween(START, HERE))).drop("_y", "_piece"))


def trend_fill(df: DataFrame, keys: Sequence[str], value: str, trend: str, days: str, out: str,
               date: str = "date") -> DataFrame:
    """Fill gaps forward by ``trend * days`` from the last known value.

    The recurrence is a running sum that starts again at every known value; an unknown step makes
    the rest of the gap NULL.
    """
    w = ordered(keys, date).rowsBetween(START, HERE)
    gap = F.col(value).isNull()
    step = F.col(trend) * F.col(days)
    staged = (df.withColumn("_sum", F.sum(F.when(gap, F.coalesce(step, F.lit(0.0))).otherwise(F.lit(0.0))).over(w))
              .withColumn("_unknown", F.sum((gap & step.isNull()).cast("int")).over(w)))
    base = F.last(F.when(~gap, F.struct(F.col(value).cast("double").alias("v"), F.col("_sum").alias("s"),
                                       F.col("_unknown").alias("u"))), ignorenulls=True).over(w)
    staged = staged.withColumn("_base", base)
    b = F.col("_base")
    filled = (F.when(~gap, F.col(value).cast("double"))
              .when(F.col("_unknown") > b["u"], F.lit(None).cast("double"))
              .otherwise(b["v"] + (F.col("_sum") - b["s"])))
    return staged.withColumn(out, filled).drop("_sum", "_unknown", "_base")


# --- statistics over a key ------------------------------------------------------------------

def with_z_score(df: DataFrame, keys: Sequence[str], value: str, out: str, date: str = "date") -> DataFrame:
    """Add the population z-score within a key, from one running mean and spread in date order.

    A value beside nine equal ones lies exactly three deviations out, so that rounding decides whether it is beyond
    three; a fixed order of the sums decides it the same way in every run, whatever way the rows came.
    """
    points = F.sort_array(F.collect_list(F.struct(F.col(date), F.col(value).cast("double").alias("v"))))
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"))

    def add(t, v):
        n = t["n"] + 1
        return let(t["m"] + (v - t["m"]) / n, lambda m: F.struct(
            n.alias("n"), (t["s"] + v).alias("s"), m.alias("m"), (t["q"] + (v - m) * (v - t["m"])).alias("q")))

    known = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(points.alias("_points"))
    t = F.col("_t")
    moments = known.select(*keys, F.aggregate("_points", zero, lambda t, p: add(t, p["v"])).alias("_t")).select(
        *keys, (t["s"] / t["n"]).alias("_mean"), F.sqrt(t["q"] / t["n"]).alias("_spread"))
    z = F.try_divide(F.col(value) - F.col("_mean"), F.col("_spread"))
    return df.join(moments, list(keys), "left").withColumn(out, z).drop("_mean", "_spread")


def month_stats(df: DataFrame, keys: Sequence[str], value: str, date: str = "date") -> DataFrame:
    """Mean and sample standard deviation per calendar month."""
    return (df.groupBy(*keys, F.date_format(date, "yyyyMM").alias("year_month"))
            .agg(F.avg(value).alias("month_mean"), F.stddev_samp(value).alias("month_std")))


def percentile_of_score(values: DataFrame, scores: DataFrame, keys: Sequence[str], value: str, score: str,
                        out: str = "percentile") -> DataFrame:
    """Percent of a key's values below its score, ties counted half (plus half of one)."""
    joined = values.where(F.col(value).isNotNull()).join(scores.select(*keys, score), list(keys))
    n = F.count(F.lit(1))
    below = F.sum((F.col(value) < F.col(score)).cast("int"))
    upto = F.sum((F.col(value) <= F.col(score)).cast("int"))
    return joined.groupBy(*keys).agg(
        ((below + upto + (upto > below).cast("int")) * 50.0 / n).alias(out))


# --- selection ------------------------------------------------------------------------------

def last_n(df: DataFrame, keys: Sequence[str], n: int, date: str = "date") -> DataFrame:
    w = ordered(keys, F.col(date).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def extrapolate_step(df: DataFrame, keys: Sequence[str], value: str, days: int = 12, date: str = "date") -> DataFrame:
    """Append one row per key, ``days`` after the last, on the line through the last two points."""
    w = ordered(keys, date)
    slope = (F.col(value) - F.lag(value).over(w)) / F.datediff(F.col(date), F.lag(date).over(w))
    ends = F.lead(date).over(w).isNull() & F.lag(date).over(w).isNotNull()
    staged = df.withColumn("_slope", slope).withColumn("_copies", F.when(ends, 1).otherwise(0))
    staged = staged.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_copies"))))
    new = F.col("_k") == 1
    cells = {date: F.when(new, F.date_add(F.col(date), days)).otherwise(F.col(date)),
             value: F.when(new, F.col(value) + F.col("_slope") * days).otherwise(F.col(value))}
    return staged.select(*[cells[c].alias(c) if c in cells else F.col(c) if c in keys
                           else F.when(~new, F.col(c)).alias(c) for c in df.columns])


def clip_to_overlap(series: Sequence[DataFrame], keys: Sequence[str], which: str = "left",
                    date: str = "date", strict: bool = False) -> list[DataFrame]:
    """Cut several series to their common start (left), end (right) or both, per key.

    Keys without overlap are dropped, or rejected when ``strict``.
    """
    if which not in ("left", "right", "both"):
        raise ValueError(f"unknown side {which!r}; use left, right or both")
    bounds = None
    for s in series:
        one = s.groupBy(*keys).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
        bounds = one if bounds is None else bounds.unionByName(one)
    limits = bounds.groupBy(*keys).agg(F.max("_lo").alias("_from"), F.min("_hi").alias("_to"),
                                       F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(series)).drop("_n")
    overlap = F.col("_from") <= F.col("_to")
    if strict:
        limits = limits.where(F.when(overlap, F.lit(True)).otherwise(
            F.raise_error(F.lit("no overlapping period")).cast("boolean")))
    else:
        limits = limits.where(overlap)
    inside = F.lit(True)
    if which in ("left", "both"):
        inside = inside & (F.col(date) >= F.col("_from"))
    if which in ("right", "both"):
        inside = inside & (F.col(date) <= F.col("_to"))
    return [s.join(limits, list(keys)).where(inside).drop("_from", "_to") for s in series]


# --- set operations -------------------------------------------------------------------------

def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; later duplicates win inside each.

    The version is the only order, so each input must hold one row per key.
    """
    both = old.withColumn("_version", F.lit(0)).unionByName(new.withColumn("_version", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys and c != "_version"]
    picked = both.groupBy(*keys).agg(*[F.max_by(c, "_version").alias(c) for c in rest])
    return picked.select(*[c for c in both.columns if c != "_version"])


def merge_columns(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join in which the columns of ``new`` replace those of ``old`` and other columns stay."""
    kept = [c for c in old.columns if c not in new.columns]
    return new.join(old.select(*keys, *kept), list(keys), "full")


def cut_over(parts: Sequence[DataFrame], starts: Sequence[str], date: str = "date") -> DataFrame:
    """Use part ``i`` from ``starts[i-1]`` up to the day before ``starts[i]``; starts are dates."""
    if len(starts) != len(parts) - 1:
        raise ValueError("one start is needed for every part but the first")
    out = None
    for i, part in enumerate(parts):
        if i > 0:
            part = part.where(F.col(date) >= F.lit(starts[i - 1]).cast("date"))
        if i < len(starts):
            part = part.where(F.col(date) < F.lit(starts[i]).cast("date"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def joined_by(df: DataFrame, grouped: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join a table of one row per key; without keys it holds a single row, which every row gets."""
    return df.join(grouped, list(keys), how) if keys else df.crossJoin(F.broadcast(grouped))


def after_last(stored: DataFrame, new: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """Rows of ``new`` later than the last stored date of their key, and all rows of keys that are not stored."""
    last = stored.groupBy(*keys).agg(F.max(date).alias("_last"))
    return joined_by(new, last, keys, "left").where(F.col("_last").isNull() | (F.col(date) > F.col("_last"))).select(*new.columns)


def carry_over(previous: DataFrame, new: DataFrame, days: int, date: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """Of every key the ``days`` days of ``previous`` before the first date of ``new``, followed by ``new``.

    A key without new rows keeps the last ``days`` days it has."""
    first = new.groupBy(*keys).agg(F.min(date).alias("_first"))
    end = previous.groupBy(*keys).agg(F.date_add(F.max(date), 1).alias("_end"))
    old = joined_by(joined_by(previous, end, keys, "left"), first, keys, "left").withColumn("_first", F.coalesce("_first", "_end"))
    tail = old.where((F.col(date) >= F.date_sub("_first", days)) & (F.col(date) < F.col("_first"))).select(*previous.columns)
    return tail.unionByName(new, allowMissingColumns=True)


def drop_repeats(df: DataFrame) -> DataFrame:
    """Each distinct row once; reduced next to the data before it is shuffled."""
    return df.distinct()


def period_means(df: DataFrame, keys: Sequence[str], values: Sequence[str], frequency: str, date: str = "date") -> DataFrame:
    """Mean per week (labelled by its Sunday), month or year (labelled by the last day) and its number of days."""
    d = F.col(date)
    label = {
        "daily": d,
        "weekly": F.date_add(F.date_trunc("week", d).cast("date"), 6),
        "monthly": F.last_day(d),
        "annual": F.make_date(F.year(d), F.lit(12), F.lit(31)),
    }
    if frequency not in label:
        raise ValueError(f"frequency {frequency} not supported")
    return (df.withColumn("period_end", label[frequency]).groupBy(*keys, "period_end")
            .agg(*[F.avg(v).alias(v) for v in values], F.countDistinct(date).alias("dt")))


def volumes(df: DataFrame, fluxes: Sequence[str], dt: str = "dt") -> DataFrame:
    """Rates times the length of their period."""
    return df.select(*[(F.col(c) * F.col(dt)).alias(c) if c in fluxes else F.col(c) for c in df.columns])
