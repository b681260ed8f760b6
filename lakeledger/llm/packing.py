"""Tokenising documents into pieces and packing the pieces into sequences by best-two-fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeledger.llm.memory import released
from lakeledger.llm.vocabulary import Encoder, forget
from lakeledger.session import cut_lineage

SEQUENCE = 1024
END = 2  # the id that ends a document
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SHARDS = 64  # into which the pieces of one length are dealt to be numbered


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole ones of ``limit``, before them one with what is over."""
    first = n % limit or min(n, limit)
    return [(0, first), *((at, limit) for at in range(first, n, limit))]


def pieces(docs: DataFrame, vocabulary: str, limit: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """Token pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A document is its whole text's ids and then ``END``; only one of more than ``limit`` ids is cut. A null text is
    empty and gives a piece of one id. Rows are documents each, also where doc_id is null or repeated.
    """
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*encoder.ids(text or ""), END], "<u4")
                for k, (at, n) in enumerate(cut(len(ids), limit)):
                    part = ids[at:at + n]
                    rows.append((None if pd.isna(doc_id) else int(doc_id), k, at, n, zlib.crc32(part.tobytes()), *([part.astype(np.int64)] * with_ids)))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    schema = PIECES + (", ids array<long>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(released(encode, forget), schema)


def best_two_fit(counts: dict[int, int], limit: int) -> list[tuple[int, list[int]]]:
    """Bins for ``counts[length]`` pieces of each length: (number of equal bins, the lengths in such a bin).

    A bin is filled greedily, the longest piece that fits first. Then its smallest piece is replaced by two
    unpacked pieces that together fill the gap it leaves more tightly, while such a pair exists. As a bin depends
    on the lengths left alone, it is repeated until one of its lengths runs out: the work depends on the number
    of lengths, at most ``limit``, and not on the number of pieces. Short pieces are kept out of this and go, longest
    first, into the bin with the least room that takes them. Which are short is tried out: the plan with the fewest
    bins is taken, of equal ones the first.
    """
    plans = (fill_gaps(two_fit({n: c for n, c in counts.items() if n > short}, limit),
                       {n: c for n, c in counts.items() if n <= short}, limit) for short in (0, limit // 6, limit // 4, limit // 3, limit // 2))
    return min(plans, key=lambda bins: sum(times for times, _ in bins))


def fill_gaps(bins: list[tuple[int, list[int]]], counts: dict[int, int], limit: int) -> list[tuple[int, list[int]]]:
    """Put the counted pieces into the bins, the longest first, each into the fullest bin it fits; then into new ones."""
    groups = sorted((limit - sum(lengths), times, tuple(lengths)) for times, lengths in bins)
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left > 0:
            at = bisect_left(groups, (n,))
            if at == len(groups):  # new bins, each filled with this length before the next is begun
                each = limit // n
                if left >= each:
                    insort(groups, (limit - each * n, left // each, (n,) * each))
                if left % each:
                    insort(groups, (limit - left % each * n, 1, (n,) * (left % each)))
                break
            room, times, lengths = groups.pop(at)
            most = min(times, left)
            if times > most:
                insort(groups, (room, times - most, lengths))
            insort(groups, (room - n, most, (*lengths, n)))
            left -= most
    return [(times, list(lengths)) for _, times, lengths in groups]


def two_fit(counts: dict[int, int], limit: int) -> list[tuple[int, list[int]]]:
    """Greedy bins, improved by replacing their smallest pieces by pairs."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    out = []
    while lengths:
        used: dict[int, int] = {}
        chosen: list[int] = []

        def take(n: int, used=used, chosen=chosen) -> None:
            used[n] = used.get(n, 0) + 1
            chosen.append(n)

        free = lambda n, used=used: left[n] - used.get(n, 0)
        room = limit
        at = len(lengths) - 1
        while at >= 0 and room:
            at = min(at, bisect_right(lengths, room) - 1)
            while at >= 0 and free(lengths[at]) <= 0:
                at -= 1
            if at >= 0:
                take(lengths[at])
                room -= lengths[at]
        while room and len(chosen) > 1:
            small = min(chosen)
            pair = tightest_pair(lengths, free, small, room + small)
            if pair is None:
                break
            used[small] -= 1
            chosen.remove(small)
            for n in pair:
                take(n)
            room -= sum(pair) - small
        times = min(left[n] // c for n, c in used.items() if c)
        out.append((times, chosen))
        for n, c in used.items():
            left[n] -= c * times
        lengths = [n for n in lengths if left[n]]
    return out


def tightest_pair(lengths: list[int], free, small: int, gap: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is largest among those over ``small`` and up to ``gap``."""
    lo, hi, best, found = 0, bisect_right(lengths, gap) - 1, small, None
    while lo <= hi and hi >= 0:
        a, b = lengths[lo], lengths[hi]
        if free(a) <= 0:
            lo += 1
        elif free(b) <= 0:
            hi -= 1
        elif a + b > gap:
            hi -= 1
        else:
            if a + b > best and (a != b or free(a) >= 2):
                best, found = a + b, (b, a)
                if best == gap:
                    break
            lo += 1
    return found


def numbered(parts: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds ``rank``, the place of a piece among those of its length, from 0. Pieces of one length are dealt into
    shards by hash, which are numbered each on its own from where the shards before it end."""
    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    return (dealt.withColumn("nth", F.row_number().over(inside)).join(F.broadcast(starts), ["length", "shard"])
            .withColumn("rank", F.col("base") + F.col("nth") - 1).drop("shard", "nth", "base"))


def places(bins: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length, slots by the first rank that goes into them: (first ranks, first sequences, offsets)."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for times, lengths in bins:
        offset = 0
        for n in lengths:
            slots.setdefault(n, []).append((taken.get(n, 0), sequence, offset))
            taken[n] = taken.get(n, 0) + times
            offset += n
        sequence += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for n, rows in slots.items()}


def pack(parts: DataFrame, limit: int = SEQUENCE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``limit`` ids; places in a sequence have no gaps.

    The bins are planned from the number of pieces of each length, at most ``limit`` numbers, and a piece finds
    its bin by its rank among the pieces of its length: nothing that grows with the input reaches the driver.
    """
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = places(best_two_fit(counts, limit))
    ranked = numbered(parts)
    columns = parts.columns

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                first, base, start = slots[int(n)]
                k = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at], offset[at] = base[k] + ranks[at] - first[k], start[k]
            yield batch[columns].assign(sequence_id=sequence, offset=offset)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema.fields)
    return ranked.mapInPandas(place, f"{types}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, limit: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places; the pieces are written once, as they are read twice."""
    return pack(cut_lineage(pieces(docs, vocabulary, limit, with_ids)), limit)
