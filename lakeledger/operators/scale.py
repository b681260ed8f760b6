"""Building blocks that stay exact and balanced when one key holds a large share of the rows.

Each of them reduces rows next to the data first (partial aggregation), and splits whatever
cannot be reduced by a second key, so that no task or aggregation buffer holds a whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.session import cut_lineage, drop_steps

DIGIT = 11  # bits of a key that one pass settles
SMALL = 4096  # values that may be ordered at once
BLOCK = 2048  # rows of a key that meet as many of the other side in one place
TASK_PAIRS = 1 << 24  # pairs of rows that a task looks at, on average


def pick_rows(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str] | None = None,
              keep: str = "last") -> DataFrame:
    """One row per key: the one with the highest (or lowest) ``order``.

    ``order`` must be unique within a key. Uses map-side combined ``max_by``, not a window, so a
    key with very many rows is reduced before it is shuffled.
    """
    values = list(values) if values is not None else [c for c in df.columns if c not in keys and c != order]
    by = F.max_by if keep == "last" else F.min_by
    extreme = F.max if keep == "last" else F.min
    aggs = [by(F.col(c), F.col(order)).alias(c) for c in values]
    return df.groupBy(*keys).agg(extreme(order).alias(order), *aggs)


def lowest_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` first rows of every key, found shard by shard and then among the shard winners.

    A key has about one shard for every ``64 * k`` of its rows, so that shards stay small however many rows it has.
    """
    sizes = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / (64 * k)).alias("_shards"))
    shard = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_shards"))
    part = df.join(sizes, list(keys)).withColumn("_shard", shard)
    inner = Window.partitionBy(*keys, "_shard").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(*order)
    winners = part.withColumn("_rn", F.row_number().over(inner)).where(F.col("_rn") <= k)
    return winners.withColumn("_rn", F.row_number().over(outer)).where(F.col("_rn") <= k).select(*df.columns)


def sample_rows(df: DataFrame, keys: Sequence[str], ident: Sequence[str], k: int) -> DataFrame:
    """At most ``k`` rows of every key, the ones with the lowest hash: the same in every run, and as good as drawn at random.

    The hash is that of the keys and ``ident`` as text (the first 13 digits of MD5 as a number), so that other engines find the
    same rows; rows of equal hashes go by ``ident``. From the number of a key's rows follows a limit that few more than ``k``
    hashes lie below; only those rows are shuffled and trimmed. A key that has too few below it is looked at again with a
    wider limit, so that the sample is exact; NULLs in ``ident`` count as empty text.
    """
    keys, ident, whole = list(keys), list(ident), 1 << 52
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*keys, *ident)])
    hashed = df.withColumn("_h", F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long"))
    sizes = cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in keys]
    margin, found = 8 * k ** 0.5 + 64, None
    while True:
        limits = sizes.withColumn("_limit", F.when(F.col("_n") <= k + margin, F.lit(whole)).otherwise(F.ceil((k + margin) / F.col("_n") * whole)))
        near = cut_lineage(hashed.join(limits, same(hashed, limits)).where(F.col("_h") < F.col("_limit")).select(hashed["*"]))
        first = Window.partitionBy(*keys).orderBy("_h", *ident)
        kept = near.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k).select(*df.columns)
        got = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("_got"))
        short = sizes.join(got, same(sizes, got), "left").where(F.coalesce("_got", F.lit(0)) < F.least(F.col("_n"), F.lit(k))).select(*[sizes[c] for c in sizes.columns])
        if short.isEmpty():
            return kept if found is None else found.unionByName(kept)
        kept = kept.join(short, same(kept, short), "left_anti")
        found = kept if found is None else found.unionByName(kept)
        sizes, margin = cut_lineage(short), 4 * (margin + k)


def running_sums(df: DataFrame, keys: Sequence[str], bucket: str, order: str,
                 sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums per key in ``order``, computed bucket by bucket.

    ``bucket`` must not decrease with ``order``. Bucket totals are added up first (few rows), and
    each bucket then runs on its own, starting from the total of the buckets before it.
    """
    keys = list(keys)
    staged = df.select("*", *[c.alias(f"_in_{n}") for n, c in sums.items()])
    totals = staged.groupBy(*keys, bucket).agg(*[F.sum(f"_in_{n}").alias(f"_tot_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, bucket, *[
        F.coalesce(F.sum(f"_tot_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in sums])
    inside = Window.partitionBy(*keys, bucket).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    joined = staged.join(offsets, [*keys, bucket])
    run = joined.select(*df.columns, *[
        (F.col(f"_off_{n}") + F.sum(f"_in_{n}").over(inside)).alias(n) for n in sums])
    return run


def block_join(left: DataFrame, right: DataFrame, on: Sequence[str], block: int = BLOCK, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """``left.join(right, on)`` for keys that very many rows of both sides may have.

    The rows of such a key are cut into blocks by their hash, and each pair of blocks meets in one place, so that no task gets a
    whole key. The number of tasks follows the number of pairs. What a side sends grows with the blocks of the other side only.
    Both sides are read twice, once to be counted.
    """
    on = list(on)
    count = lambda df, n: df.groupBy(*on).agg(F.count(F.lit(1)).alias(n))
    sizes = cut_lineage(count(left, "_nl").join(count(right, "_nr"), on))
    pairs = sizes.agg(F.sum(F.col("_nl").cast("double") * F.col("_nr"))).first()[0] or 0.0
    if pairs <= task_pairs:
        drop_steps(sizes)
        return left.join(right, on)
    blocks = lambda n: F.ceil(F.col(n) / block)
    hot = F.broadcast(sizes.where(F.greatest("_nl", "_nr") > block).select(*on, blocks("_nl").alias("_ml"), blocks("_nr").alias("_mr")))  # at most rows / block
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -int(-pairs // task_pairs))

    def dealt(df: DataFrame, mine: str, own: str, other: str, others: str) -> DataFrame:
        parts = lambda n: F.coalesce(n, F.lit(1).cast("long"))
        return (df.withColumn("_h", F.xxhash64(*[F.col(c) for c in df.columns])).join(hot, on, "left")
                .select(*df.columns, F.pmod("_h", parts(own)).alias(mine), F.explode(F.sequence(F.lit(0).cast("long"), parts(others) - 1)).alias(other))
                .repartition(tasks, *on, "_bl", "_br"))

    return dealt(left, "_bl", "_ml", "_br", "_mr").join(dealt(right, "_br", "_mr", "_bl", "_ml"), [*on, "_bl", "_br"]).drop("_bl", "_br")


def order_key(value: Column) -> Column:
    """A long for a double, in the same order: the bits of the number, with those of negative numbers turned round."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` digits of a key."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftright(key, max(64 - DIGIT * depth, 0))


def select_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Callable[[Column], Column], small: int = SMALL) -> DataFrame:
    """``keys, n, rank, value``: exact order statistics of every key, for the ranks (from 0) that ``ranks(n)`` lists for n values.

    All values are keys of 64 bits in their order. A pass counts, next to the data, the values that agree with a wanted
    rank's digits so far, by their next digit of 11 bits; so six passes settle all ranks of all groups, whatever
    the values. A rank is settled earlier where only equal values are left; where at most ``small`` are, these are
    ordered. No group is held or shuffled as a whole, and a pass shuffles at most 2048 counts for each open rank and task.
    NULLs do not count.
    """
    keys = list(keys)
    source = cut_lineage(df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()).withColumn("_k", order_key(F.col("_v"))))
    sizes = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    open_ = cut_lineage(sizes.withColumn("rank", F.explode(F.array_distinct(ranks(F.col("n")))))
                        .select(*keys, "n", "rank", F.lit(0).alias("_depth"), F.lit(0).cast("long").alias("_at"), F.col("rank").alias("_inside"), F.col("n").alias("_c"), "_low", "_high"))
    settled, equal = [], F.col("_low") == F.col("_high")
    for depth in range(1, -(-64 // DIGIT) + 1):
        settled.append(open_.where(equal | (F.col("_c") <= small)))
        wide = open_.where(~equal & (F.col("_c") > small))
        if wide.isEmpty():
            break
        asked = wide.groupBy(*keys).agg(F.collect_set("_at").alias("_asked"))
        counted = (source.join(asked, keys).where(F.array_contains("_asked", _prefix(F.col("_k"), depth - 1)))
                   .groupBy(*keys, _prefix(F.col("_k"), depth - 1).alias("_at"), _prefix(F.col("_k"), depth).alias("_next"))
                   .agg(F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_l"), F.max("_v").alias("_h")))
        upto = counted.withColumn("_upto", F.sum("_m").over(Window.partitionBy(*keys, "_at").orderBy("_next").rowsBetween(Window.unboundedPreceding, 0)))
        before = F.col("_upto") - F.col("_m")
        open_ = cut_lineage(wide.join(upto, [*keys, "_at"]).where((F.col("_inside") >= before) & (F.col("_inside") < F.col("_upto")))
                            .select(*keys, "n", "rank", F.lit(depth).alias("_depth"), F.col("_next").alias("_at"), (F.col("_inside") - before).alias("_inside"),
                                    F.col("_m").alias("_c"), F.col("_l").alias("_low"), F.col("_h").alias("_high")))
    else:
        settled.append(open_)  # all digits are known, so that values are equal
    known = settled[0]
    for part in settled[1:]:
        known = known.unionByName(part)
    few = known.where(~equal)
    places = few.groupBy(*keys).agg(F.collect_set(F.struct("_depth", "_at")).alias("_places"))
    here = F.lit(False)
    for depth in range(-(-64 // DIGIT) + 1):
        here = F.when(F.col("_p._depth") == depth, F.col("_p._at") == _prefix(F.col("_k"), depth)).otherwise(here)
    lists = (source.join(places, keys).withColumn("_p", F.explode("_places")).where(here)
             .groupBy(*keys, F.col("_p._depth").alias("_depth"), F.col("_p._at").alias("_at")).agg(F.sort_array(F.collect_list("_v")).alias("_list")))
    picked = few.join(lists, [*keys, "_depth", "_at"]).select(*keys, "n", "rank", F.get("_list", F.col("_inside").cast("int")).alias("value"))
    return picked.unionByName(known.where(equal).select(*keys, "n", "rank", F.col("_low").alias("value")))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], small: int = SMALL) -> DataFrame:
    """Exact quantiles per key without holding or shuffling a key's values (``select_ranks``).

    For every name in ``probs`` the result has ``<name>_lo`` and ``<name>_hi`` (the neighbours of position ``(n-1)p``),
    ``<name>_lin`` (linear) and ``<name>_mid`` (midpoint), and ``n``.
    """
    keys = list(keys)
    if not keys:
        return exact_quantiles(df.withColumn("_all", F.lit(1)), ["_all"], value, probs, small).drop("_all")
    ends = lambda n, p: [f((n - 1) * F.lit(float(p))) for f in (F.floor, F.ceil)]
    found = select_ranks(df, keys, value, lambda n: F.array(*[e for p in probs.values() for e in ends(n, p)]), small)
    held = found.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"))
    out = [F.col("n")]
    for name, p in probs.items():
        lo, hi = (F.element_at("_at", e) for e in ends(F.col("n"), p))
        pos = (F.col("n") - 1) * F.lit(float(p))
        out += [lo.alias(f"{name}_lo"), hi.alias(f"{name}_hi"), (lo + (hi - lo) * (pos - F.floor(pos))).alias(f"{name}_lin"), ((lo + hi) / 2).alias(f"{name}_mid")]
    return held.select(*keys, *out)
