"""Near-duplicate embeddings by counting collisions on many one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.components import connected_components
from lakeledger.llm.simhash import join_labels
from lakeledger.llm.vectors import matrix, sound, unit
from lakeledger.session import cut_lineage

COSINE = 0.9
PROJECTIONS = 32
COLLIDE = 0.93  # probability that a pair at the least cosine collides on one projection; sets the window's width
RECALL = 0.9999  # probability that such a pair reaches the count that is verified
SEED = 5
BLOCK = 8192  # vectors, at most, in a block
STRIP = 1024  # rows of a block that are counted at once


def normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


def window(least: float = COSINE, collide: float = COLLIDE) -> float:
    """Half the width at which two unit vectors with cosine ``least`` collide with probability ``collide``: their
    projections on a standard normal direction differ by a normal number of variance 2 - 2 * least."""
    return normal_quantile((1 + collide) / 2) * math.sqrt(2 - 2 * least)


def needed(projections: int = PROJECTIONS, collide: float = COLLIDE, recall: float = RECALL) -> int:
    """The highest count that a pair at the least cosine reaches with probability ``recall``; closer pairs do so
    more often. Projections are independent, so that counts are binomial."""
    tail = 0.0
    for count in range(projections, -1, -1):
        tail += math.comb(projections, count) * collide ** count * (1 - collide) ** (projections - count)
        if tail >= recall:
            return count
    return 0


def directions(dimension: int, projections: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, projections))


def colliding(rows: np.ndarray, others: np.ndarray, width: float, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row, other) whose projections lie within ``width`` of each other at least ``count`` times, in strips of rows.

    For each projection, the others are sorted, and a row's window is a range of that order: the others in it are
    the difference of two prefixes, taken from a table of prefixes as bits. Counts of all pairs are kept as bits as
    well, one plane for each binary digit, so that one operation adds up 64 pairs.
    """
    n, projections = len(others), rows.shape[1]
    if not n or not len(rows):
        return
    words, digits = -(-n // 64), projections.bit_length()
    strips = [slice(at, min(at + STRIP, len(rows))) for at in range(0, len(rows), STRIP)]
    planes = np.zeros((digits, len(rows), words), np.uint64)
    for t in range(projections):
        order = np.argsort(others[:, t], kind="stable")
        ordered = others[order, t]
        prefix = np.zeros((n + 1, words), np.uint64)
        prefix[np.arange(1, n + 1), order >> 6] = np.uint64(1) << (order & 63).astype(np.uint64)
        np.bitwise_or.accumulate(prefix, axis=0, out=prefix)
        low = np.searchsorted(ordered, rows[:, t] - width, "left")
        high = np.searchsorted(ordered, rows[:, t] + width, "right")
        for strip in strips:
            carry = prefix[high[strip]]
            carry ^= prefix[low[strip]]
            for plane in planes[:(t + 1).bit_length(), strip]:
                both = plane & carry
                plane ^= carry
                carry = both
    for strip in strips:
        above, equal = np.zeros_like(planes[0, strip]), np.full_like(planes[0, strip], ~np.uint64(0))
        for k in range(digits - 1, -1, -1):
            if count >> k & 1:
                equal &= planes[k, strip]
            else:
                above |= equal & planes[k, strip]
                equal &= ~planes[k, strip]
        passed = above | equal
        r, w = np.nonzero(passed)
        bits = np.unpackbits(passed[r, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, bit = np.nonzero(bits)
        other = w[k] * 64 + bit
        yield r[k][other < n] + strip.start, other[other < n]


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", least: float = COSINE,
                    projections: int = PROJECTIONS, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row with an id: how many other vectors are linked by a
    cosine of at least ``least``, the least id reachable over links, and whether that is its own.

    Equal vectors are one, counted as often as they are there. Vectors are cut into blocks along their first projection, at quantiles;
    two blocks meet in a group of their own if their projections come within reach. A group counts collisions of
    its pairs, verifies those that reach the calibrated count by their cosine in double precision, and gives each
    vector's number of links and a spanning forest, not the links: rows out never outnumber rows in.
    Unsound vectors, and those of another dimension, link with nothing. Rows that repeat an id with an equal vector are one vector;
    with different vectors they are one node, and every row is returned.
    """
    ids = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"))
    given = cut_lineage(sound(rows, id_col, vector).distinct().groupBy("v").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("copies")))
    width, count = window(least), needed(projections, recall=recall)
    # Beyond this, a pair at the least cosine is as unlikely as one that fails the count.
    reach = normal_quantile(1 - (1 - recall) / 2) * math.sqrt(2 - 2 * least)

    @F.pandas_udf("double")
    def leading(v: pd.Series) -> pd.Series:
        return pd.Series([float(unit(np.array([x]))[0] @ directions(len(x), projections)[:, 0]) for x in v], dtype=float)

    placed = cut_lineage(given.withColumn("p", leading("v")).withColumn("d", F.size("v")))
    blocks = max(1, -(-placed.count() // block))
    cuts = sorted(set(placed.approxQuantile("p", [k / blocks for k in range(1, blocks)], 0.1 / blocks))) if blocks > 1 else []

    # A block meets a range of blocks, as they follow each other along the projection.
    edges = np.array([-math.inf, *cuts, math.inf])
    first = np.maximum(np.searchsorted(edges[1:], edges[:-1] - reach, "left"), 0)
    last = np.minimum(np.searchsorted(edges[:-1], edges[1:] + reach, "right") - 1, len(cuts))

    @F.pandas_udf("b int, first int, last int")
    def block_of(p: pd.Series) -> pd.DataFrame:
        b = np.searchsorted(cuts, p.to_numpy(), "right")
        return pd.DataFrame({"b": b, "first": first[b], "last": last[b]})

    tiles = (placed.withColumn("at", block_of("p")).withColumn("other", F.explode(F.sequence("at.first", "at.last")))
             .select("c", "v", "copies", "d", "at.b", F.least("at.b", "other").alias("i"), F.greatest("at.b", "other").alias("j")))

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("c", ignore_index=True)
        units = unit(matrix(part["v"]))
        places = (units @ directions(units.shape[1], projections)).astype(np.float32)
        i, j, _ = key
        side = part["b"].to_numpy()
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        copies, links, label = part["copies"].to_numpy(), np.zeros(len(part), np.int64), np.arange(len(part))
        for a, b in colliding(places[left], places[right], width, count):
            a, b = left[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            for k in range(0, len(a), 100_000):
                x, y = a[k:k + 100_000], b[k:k + 100_000]
                sure = (units[x] * units[y]).sum(axis=1) >= least
                x, y = x[sure], y[sure]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                join_labels(label, x, y)
        at = np.flatnonzero(links)
        c = part["c"].to_numpy()
        return pd.DataFrame({"c": c[at], "links": links[at], "root": c[label[at]]})

    linked = cut_lineage(tiles.groupBy("i", "j", "d").applyInPandas(compare, "c long, links long, root long"))
    members = sound(rows, id_col, vector).distinct().join(given.select("v", "c", "copies"), "v").select("id", "c", "copies")
    several = members.groupBy("id").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x != y").select("id")
    tied = members.join(several, "id").select(F.col("id").alias("a"), F.col("c").alias("b"))
    parts = connected_components(linked.select(F.col("c").alias("a"), F.col("root").alias("b")).unionByName(tied))
    number = linked.groupBy("c").agg(F.sum("links").alias("links"))
    classes = given.select("c", "copies").distinct().join(number, "c", "left").join(parts.withColumnRenamed("node", "c"), "c", "left")
    by_id = (members.join(classes.select("c", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "c").alias("component")), "c")
             .groupBy("id").agg(F.sum(F.col("copies") - 1 + F.col("links")).alias("n_links"), F.min("component").alias("component_id")))
    out = ids.join(by_id, "id", "left").select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                                               F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))
