"""Removing repeated strings of bytes, found by merging Burrows-Wheeler transforms of shards."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.phrases import outcome
from lakeledger.llm.recurring import Kind, placed, removed, rolling, solved, stretches

WINDOW = 100  # bytes
GRAM = 28  # bytes of an anchor
LETTER = 20  # bytes that the transforms take as one letter; divides WINDOW
PART = 1 << 20  # bytes of an owner that are merged together
CHUNK = 1 << 19  # bytes of small groups that are merged together
SHARD = 1 << 18  # bytes of one transform

SPREAD = np.random.default_rng(3).integers(1, 1 << 63, 256, np.uint64)


def kind(window: int = WINDOW, gram: int = GRAM) -> Kind:
    data = lambda items: SPREAD[np.frombuffer(b"".join(items), np.uint8)]
    return Kind(str.encode, data, lambda text, a, b: text[a:b], window, min(gram, window), within=True)


def in_order(ranks: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2 ** 31: they are sorted together with their places, which is faster than by reference."""
    keys = ranks.astype(np.uint64)
    keys <<= np.uint64(32)
    keys |= np.arange(len(ranks), dtype=np.uint32)
    keys.sort()
    keys &= np.uint64(0xFFFFFFFF)
    return keys.view(np.int64)


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each key, from 0, and for each rank a place that has it."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(keys) else np.zeros(0, bool)
    del ordered
    ranks = np.empty(len(keys), np.int32)
    ranks[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return ranks, order[new]


def dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Ranks of pairs, from 0; pairs that begin with 0 are all rank 0."""
    keys = np.where(high > 0, (high.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64), np.uint64(0))
    return ranked(np.r_[np.uint64(0), keys])[0][1:]


def exact_letters(data: np.ndarray, size: int) -> np.ndarray:
    """Rank of the ``size`` bytes at every place, from 1, in an order that is fixed but not that of bytes. By a hash, all whose equals
    are compared with each other; should two letters ever share one, another hash is drawn."""
    spread, draw = SPREAD, 3
    while True:
        ranks, holder = ranked(rolling(spread[data], size))
        same = holder[ranks]
        if size >= 8:
            eight = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,))
            offsets = [*range(0, size - 7, 8), size - 8]
        else:
            eight, offsets = data, range(size)
        if all(np.array_equal(eight[k:k + len(ranks)], eight[same + k]) for k in offsets):
            return ranks + np.int32(1)
        draw += 1
        spread = np.random.default_rng(draw).integers(1, 1 << 63, 256, np.uint64)


def transform(letters: np.ndarray, before: np.ndarray, depth: int, step: int, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of a shard: its suffixes in order of their first ``depth`` letters, and the letter
    before each (0: none). ``letters[i]`` is that of suffix i, 0 at an end; suffix i goes on at ``i + step`` while
    that is within ``room[i]`` places."""
    def later(ranks: np.ndarray, places: int) -> np.ndarray:
        out = np.zeros_like(ranks)
        at = np.flatnonzero(room >= places)
        out[at] = ranks[at + places]
        return out

    # Ranks by 1, 2, 4, ... letters, put together to ``depth``.
    ranks, have, whole, done = letters, 1, None, 0
    while True:
        if depth & have:
            whole, done = (ranks, have) if whole is None else (dense(whole, later(ranks, done * step)), done + have)
        if 2 * have > depth:
            break
        ranks, have = dense(ranks, later(ranks, have * step)), 2 * have
    order = in_order(whole).astype(np.int32)
    return order, before[order]


def merge(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms by refining their interleave: for every place of the merged order the shard its suffix is
    from, and the block of suffixes that share their first ``depth`` letters.

    At first all of the first shard's suffixes stand before the second's, and so on. A round sorts the interleave by the letters that stand before
    its suffixes, stably: after ``h`` rounds the suffixes are in order of ``h`` letters, and a new block
    begins where the letter or the block it came from differs. Ends (letter 0) are equal to nothing.
    """
    sizes = list(map(len, shards))
    letters = np.concatenate(shards)
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint16 if len(shards) < 65536 else np.int64), sizes)
    block = np.zeros(len(letters), np.int32)
    for _ in range(depth):
        there = np.empty(len(letters), letters.dtype)
        there[np.argsort(interleave, kind="stable")] = letters
        order = in_order(there)
        interleave, sorted_letters, came = interleave[order], there[order], block[order]
        del there, order
        new = np.r_[True, (sorted_letters[1:] != sorted_letters[:-1]) | (came[1:] != came[:-1])] | (sorted_letters == 0)
        block = np.cumsum(new, dtype=np.int32)
    return interleave, block


def repeats(rows: pd.DataFrame, window: int, letter: int, shard: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Ranges of bytes that windows cover which start earlier, among stretches of bytes."""
    rows, line, base = placed(rows.assign(size=rows["data"].map(len)))
    depth, sizes = window // letter, rows["size"].to_numpy()
    data = np.frombuffer(b"".join(rows["data"]), np.uint8)
    n = len(data)
    ends = np.cumsum(sizes)
    row_of = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    # A stretch of m bytes has m + 1 suffixes: one at each whole letter, and the ends of its chains of letters.
    slots = sizes + 1
    first = np.cumsum(slots) - slots
    row = np.repeat(np.arange(len(rows), dtype=np.int32), slots)
    short = lambda x: x.astype(np.int32)  # a chunk has far fewer than 2 ** 31 bytes; its arrays are what a task needs memory for
    inside = np.arange(len(row), dtype=np.int32) - short(first)[row]
    room = short(sizes)[row] - inside
    byte = short(ends - sizes)[row] + inside
    letters = np.zeros(len(row), np.int32)
    has = np.flatnonzero(room >= letter)
    letters[has] = exact_letters(data, letter)[byte[has]]
    before = np.zeros(len(row), np.int32)
    back = np.flatnonzero(inside >= letter)
    before[back] = letters[back - letter]
    slots = len(row)
    del has, back, row, inside
    # Shards of whole stretches, each with its own transform.
    cut = np.flatnonzero(np.diff(first // shard, prepend=-1))
    edges = [*first[cut].tolist(), slots]
    built = [transform(letters[a:b], before[a:b], depth, letter, room[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    del letters, before, room
    orders = np.concatenate([o + np.int32(a) for (o, _), a in zip(built, edges, strict=False)])
    shards = [x for _, x in built]
    del built
    interleave, block = merge(shards, depth)
    suffix = np.empty(slots, np.int32)
    suffix[np.argsort(interleave, kind="stable")] = orders
    del shards, interleave, orders
    # Repeated intervals: blocks of two and more. In each, by place on the line of documents.
    many = np.flatnonzero((np.bincount(block) > 1)[block])
    place = (line - (ends - sizes))[row_of] + np.arange(n)
    where, blocks = byte[suffix[many]], block[many]
    del suffix, byte, block, many
    order = np.lexsort((place[where], blocks))
    where, blocks = where[order], blocks[order]
    del order
    heads = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else np.array([], int)
    head = np.repeat(heads, np.diff(np.r_[heads, len(blocks)]))
    doc = rows["doc"].to_numpy()[row_of[where]]
    which = np.searchsorted(base, place[where], "right") - 1
    same = np.r_[False, (blocks[1:] == blocks[:-1]) & (which[1:] == which[:-1])] if len(blocks) else np.array([], bool)
    del which
    # Of one document's equal windows the first place is kept; a place may lie in the chunk twice.
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(blocks)))) if len(blocks) else head
    gone_at = (doc > doc[head]) | (place[where] > place[where][lead])
    gone = np.zeros(n + 1, bool)
    gone[where[gone_at]] = True
    del doc, same, lead, head, gone_at, where, blocks
    at = np.flatnonzero(np.arange(n) + window <= ends[row_of])
    # A place that lies in the chunk several times is in one block each time, and gone each time or not at all.
    return outcome(rows, place, base, np.flatnonzero(gone[:n]), window, row_of, at, gone, SPREAD[data], min(GRAM, window))


def repeated_strings(docs: DataFrame, window: int = WINDOW, letter: int = LETTER, part: int = PART, chunk: int = CHUNK, shard: int = SHARD) -> DataFrame:
    """``doc, ranges(ver, start, end)``: bytes of documents that strings of ``window`` bytes cover which also start earlier."""
    if window % letter:
        raise ValueError("letters have to divide the window")
    k = kind(window)
    return solved(*stretches(docs, k, part), k, lambda rows: repeats(rows, window, letter, shard), chunk)


def remove_repeats(docs: DataFrame, window: int = WINDOW, digests: bool = False, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and the remaining bytes, as ``kept`` (binary) or as ``kept_sha256``.

    Texts are their UTF-8 bytes, null ones empty. Strings are judged on the input; earlier is a smaller doc_id, or an earlier start in
    the same row. Rows without an id are left out; of rows that repeat an id none is earlier than the other.
    """
    def rest(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple:
        data = text.encode()
        kept, at = [], 0
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            kept.append(data[at:a])
            at = b
        left = b"".join([*kept, data[at:]])
        return len(data), len(data) - len(left), len(starts), hashlib.sha256(left).hexdigest() if digests else left

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digests else "kept binary")
    return removed(docs, repeated_strings(docs, window, **options), rest, schema)


def keep_rest(docs: DataFrame, **options) -> DataFrame:
    """All documents with what remains of their texts, and their other columns. ``n_chars`` follows the text where there is one.
    A character of which bytes are removed goes as a whole. A document of which nothing remains goes; one that was empty stays."""
    text, ver = F.coalesce(F.col("text").cast("string"), F.lit("")), "_ver_" + "_".join(docs.columns)

    @F.pandas_udf("string")
    def without(texts: pd.Series, vers: pd.Series, ranges: pd.Series) -> pd.Series:
        out = []
        for t, v, found in zip(texts, vers, ranges, strict=True):
            data, at, kept = t.encode(), 0, []
            for a, b in sorted((r["start"], r["end"]) for r in found if r["ver"] == v):
                kept.append(data[at:max(a, at)])
                at = max(at, b)
            out.append(b"".join([*(k.decode("utf-8", "ignore").encode() for k in kept), data[at:].decode("utf-8", "ignore").encode()]).decode())
        return pd.Series(out, dtype=object)

    ranges = repeated_strings(docs, **options).select(F.col("doc").alias(ver), F.col("ranges").alias(ver + "r"))
    joined = docs.withColumn(ver + "v", F.xxhash64(text)).join(ranges, F.col("doc_id") == F.col(ver), "left")
    rest = F.when(F.col(ver).isNull(), F.col("text")).otherwise(without(text, F.col(ver + "v"), F.coalesce(ver + "r", F.array().cast("array<struct<ver:bigint,start:bigint,end:bigint>>"))))
    out = joined.withColumn("text", rest).where(F.col(ver).isNull() | (F.col("text") != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(ver).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
