"""Nearest neighbours by randomly rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.vectors import matrix, sound, unit
from lakeledger.session import cut_lineage

BITS = 512  # of a code; vectors are padded with zeros to as many dimensions before they are rotated
WIDTHS = 1.9  # error bounds reach so many standard deviations of the estimate, as published for these codes
SEED = 11
QUERIES = 16384  # in a block
ROWS = 65536  # in a block
SLICE = 8192  # codes that are unpacked at once


def rotation(dimension: int, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """``dimension`` orthonormal directions of a random rotation of ``bits`` dimensions: those that vectors padded
    with zeros need."""
    bits = max(bits, -(-dimension // 8) * 8)
    q, r = np.linalg.qr(np.random.default_rng([seed, dimension]).standard_normal((bits, dimension)))
    return (q * np.sign(np.diag(r))).T


def encode(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and the inner product of each with its own code."""
    turned = units @ turn
    signs = turned > 0
    return np.packbits(signs, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1])


def estimate(turned: np.ndarray, codes: np.ndarray, fit: np.ndarray, widths: float = WIDTHS) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x codes) of rotated unit queries with coded unit vectors, and each code's
    error bound. A code's inner product with the query over its inner product with its own vector is unbiased; the
    error is that of a random direction orthogonal to the vector."""
    bits = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32) * 2 - 1
    dots = turned.astype(np.float32) @ signs.T
    return dots / (np.sqrt(bits) * fit).astype(np.float32), widths * np.sqrt((1 - fit ** 2) / fit ** 2 / (bits - 1))


def chosen(turned: np.ndarray, codes: np.ndarray, fit: np.ndarray, k: int, widths: float = WIDTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, code, lower, upper bound) of the pairs that may be among a query's k best: those whose upper bound
    reaches the query's k-th highest lower bound. Codes are taken in slices, against the k-th highest so far, and what
    a later slice has shown to be too low goes at the end."""
    out = []
    for at in range(0, len(turned), 512):
        part = turned[at:at + 512]
        best = np.full((len(part), k), -np.inf, np.float32)
        held = []
        for first in range(0, len(fit), SLICE):
            value, error = estimate(part, codes[first:first + SLICE], fit[first:first + SLICE], widths)
            low, high = value - error, value + error
            best = -np.partition(-np.hstack([best, low]), k - 1, axis=1)[:, :k]
            q, c = np.nonzero(high >= best.min(axis=1)[:, None])
            held.append((q, c + first, low[q, c], high[q, c]))
        q, c, low, high = (np.concatenate(x) for x in zip(*held, strict=True))
        sure = high >= best.min(axis=1)[q]
        out.append((q[sure] + at, c[sure], low[sure], high[sure]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding",
           bits: int = BITS, widths: float = WIDTHS) -> DataFrame:
    """The ``k`` nearest by cosine of every row for which ``is_query`` (of a column ``id``) holds, among all other
    rows: ``query_id, rank, vec_id, score``, ties to the smaller id.

    Equal vectors are one candidate with its ``k + 1`` least ids, which is all of them that any query can return.
    Codes, corrections and ids of all candidates meet blocks of queries; a group holds one block of each, so its
    size is bounded. Within a group and then over all groups of a query, only candidates whose upper bound reaches the
    k-th highest lower bound go on to their original vectors and the exact cosine. Vectors of another dimension
    than the query's are no candidates; unsound vectors and rows without an id take no part; a row that repeats id and
    vector counts once.
    """
    need = k + 1  # the query itself may be among them
    place = Window.partitionBy("v").orderBy("id")
    given = cut_lineage(sound(rows, id_col, vector))
    first = given.distinct().withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= need)
    vectors = cut_lineage(first.groupBy("v").agg(F.min("id").alias("c"), F.array_sort(F.collect_list("id")).alias("ids")))
    asked = given.where(is_query).distinct()
    queries = cut_lineage(asked.join(vectors.select("v", "c"), "v").select("id", "c"))
    wanted = vectors.join(queries.select("c").distinct(), "c", "left_semi").select("c", "v")

    blocks = max(1, -(-vectors.count() // ROWS))
    sides = max(1, -(-wanted.count() // QUERIES))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["v"].map(len).to_numpy()
            for d in np.unique(sizes):
                part = batch[sizes == d]
                codes, fit = encode(unit(matrix(part["v"])), rotation(int(d), bits))
                yield pd.DataFrame({"c": part["c"], "d": int(d), "code": [x.tobytes() for x in codes], "fit": fit})

    dealt = lambda n, c="c": F.pmod(F.xxhash64(c, F.lit(3)), F.lit(n))
    index = (vectors.select("c", "v").mapInPandas(code, "c long, d int, code binary, fit double")
             .withColumn("row", dealt(blocks)).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))))
    sent = (wanted.withColumn("d", F.size("v")).withColumn("side", dealt(sides).cast("int"))
            .withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "c": [], "low": [], "high": []})
        turn = rotation(int(left["d"].iloc[0]), bits)
        codes = np.frombuffer(b"".join(right["code"]), np.uint8).reshape(len(right), -1)
        q, c, low, high = chosen(unit(matrix(left["v"])) @ turn, codes, right["fit"].to_numpy(), need, widths)
        return pd.DataFrame({"q": left["c"].to_numpy()[q], "c": right["c"].to_numpy()[c], "low": low, "high": high})

    near = cut_lineage(sent.groupBy("side", "row", "d").cogroup(index.groupBy("side", "row", "d"))
                       .applyInPandas(meet, "q long, c long, low double, high double"))
    best = Window.partitionBy("q").orderBy(F.desc("low"))
    bars = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= need).groupBy("q").agg(F.min("low").alias("bar"), F.count(F.lit(1)).alias("n"))
    few = near.join(bars, "q").where((F.col("high") >= F.col("bar")) | (F.col("n") < need)).select("q", "c")
    pairs = few.join(wanted.select(F.col("c").alias("q"), F.col("v").alias("qv")), "q").join(vectors, "c")

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=float)
        out = np.empty(len(a))
        sizes = a.map(len).to_numpy()
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            out[at] = np.clip((unit(matrix(a.iloc[at])) * unit(matrix(b.iloc[at]))).sum(axis=1), -1, 1)
        return pd.Series(out)

    exact = pairs.select("q", "c", "ids", cosine("qv", "v").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    top = (exact.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= need)
           .select("q", F.posexplode("ids").alias("p", "vec_id"), "score")
           .groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("found")))
    found = (queries.withColumnRenamed("c", "q").join(top, "q")
             .select(F.col("id").alias("query_id"), F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("id")), 1, k).alias("found")))
    return found.select("query_id", F.posexplode("found").alias("p", "f")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.s")).alias("score"))
