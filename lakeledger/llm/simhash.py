"""SimHash near-duplicates: fingerprints of word shingles, linked through shared blocks of bits."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.components import connected_components
from lakeledger.llm.memory import released
from lakeledger.session import cut_lineage

SHINGLE_WORDS = 3
DISTANCE = 3
BLOCKS = 6  # any pair within DISTANCE bits agrees on BLOCKS - DISTANCE whole blocks
TILE = 1024  # fingerprints of one bucket that are compared at once


def bit_majority(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:  # sums of 255 bits fit a byte, which keeps the additions narrow
            ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """SimHash over word shingles, repeats included; zero for a text without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes.lower and bytes.split know ASCII only
    if not words:
        return 0
    parts = [b" ".join(words)] if len(words) < size else map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return bit_majority(np.fromiter(map(partial(xxh64_intdigest, seed=42), parts), np.uint64))


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """Adds the fingerprint as a signed long. A null text counts as empty."""
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))
    return docs.withColumn(out, prints(F.col(text)))


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """One mask for every choice of ``blocks - distance`` of the blocks that 64 bits are cut into."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(block, blocks - distance)]


def forest(fps: np.ndarray, groups: np.ndarray, distance: int) -> np.ndarray:
    """For every row the first row of its group it is connected with by links of at most ``distance`` bits.

    Rows of a group lie together. Shift by shift, each row meets the row ``shift`` below it, so a group of n rows
    costs n * n / 2 comparisons and never holds more than its own links.
    """
    n = len(fps)
    label = np.arange(n)
    if not n:
        return label
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    left = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n])) - np.arange(n)  # rows to the group's end
    rows, shift, found, held = np.arange(n), 1, [], 0
    while True:
        rows = rows[left[rows] > shift]
        if len(rows):
            near = rows[np.bitwise_count(fps[rows] ^ fps[rows + shift]) <= distance]
            found.append((near, near + shift))
            held += len(near)
        if found and (held > 2_000_000 or not len(rows)):
            join_labels(label, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
            found, held = [], 0
        if not len(rows):
            return label
        shift += 1


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the rows that links (a, b) connect one label, in place: the least of them."""
    while True:
        while not np.array_equal(label[label], label):
            label[:] = label[label]
        la, lb = label[a], label[b]
        if np.array_equal(la, lb):
            return
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """``prints(fp, node)`` with distinct fp; gives edges (a, b) of nodes that connect exactly the fingerprints
    which links of at most ``distance`` bits connect.

    Every fingerprint goes to one bucket for each choice of blocks. A bucket of n fingerprints is cut into
    ceil(n / tile) parts and each pair of parts is compared in a group of its own, so that no task holds a bucket,
    and a group gives a spanning forest of the links it has verified, not the links: rows out never outnumber rows in.
    """
    masks = block_masks(blocks, distance)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keyed = prints.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "node", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / tile)
    tiled = (keyed.join(sizes, ["t", "key"])
             .withColumn("mine", F.pmod(F.xxhash64("fp"), parts))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
             .select("fp", "node", F.xxhash64("t", "key", F.least("mine", "other"), F.greatest("mine", "other")).alias("g")))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            cut = int(rows["g"].searchsorted(rows["g"].iloc[-1], "left")) if len(rows) else 0
            kept = rows.iloc[cut:]
            yield solve(rows.iloc[:cut])
        if kept is not None:
            yield solve(kept)

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        label = forest(rows["fp"].to_numpy().view(np.uint64), rows["g"].to_numpy(), distance)
        node = rows["node"].to_numpy()
        at = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": node[at], "b": node[label[at]]})

    return tiled.repartition("g").sortWithinPartitions("g", "fp").mapInPandas(released(compare), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", distance: int = DISTANCE,
                    blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Class of every document by SimHash: ``id_col``, ``fp`` (signed long) and ``component_id``, the least id
    reachable over fingerprints that differ in at most ``distance`` bits.

    Exact copies share a fingerprint and are one node, whatever their number. A null text counts as empty; texts
    without words have fingerprint zero and link like any other. Rows without an id are left out; rows that repeat
    an id are all returned, and the id is one node. Other columns do not matter.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    prints = cut_lineage(with_fingerprint(rows).select("id", "fp"))
    nodes = prints.groupBy("fp").agg(F.min("id").alias("node"))
    # An id that repeats with several texts ties their fingerprints together.
    several = prints.groupBy("id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x != y").select("id")
    tied = prints.join(several, "id").join(nodes, "fp").select(F.col("id").alias("a"), F.col("node").alias("b"))
    parts = connected_components(links(nodes, distance, blocks, tile).unionByName(tied))
    # As a table of its own, so that the join below can split the rows of a fingerprint that very many copies share.
    classes = cut_lineage(nodes.join(parts, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")))
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The documents that are the first of their class, with all their columns; rows without an id stay.

    Of rows that repeat an id each stays if the id is the first of its class."""
    firsts = near_duplicates(docs, **options).where("doc_id = component_id").select("doc_id").distinct()
    lonely = docs.where(F.col("doc_id").isNull())
    return docs.join(firsts, "doc_id", "left_semi").unionByName(lonely)
