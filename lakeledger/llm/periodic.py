"""Periodic runs: stretches of words that repeat with a short period, found by frequency splitting and a scan of lags."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.memory import released

LEAST_WORDS = 6
LEAST_PERIODS = 4
CHUNK_WORDS = 1 << 17  # words split together; a longer text is a chunk of its own
SCAN_BLOCKS = 1 << 19  # blocks of a segment that are held at once while lags are scanned
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that no power of it is zero


def stable_segments(codes: np.ndarray, starts: np.ndarray, least: int, periods: int) -> np.ndarray:
    """Rows (start, end) of the segments that may hold runs, in order; ``starts`` are the texts' first places.

    A run of ``periods`` periods holds each of its words that often. Words which their segment holds less often
    therefore stand in no run and split it; what is left splits again, until each word of a segment is frequent in it.
    """
    at = np.arange(len(codes))
    part = np.zeros(len(codes), np.int64)
    part[starts[starts < len(codes)]] = 1
    part = part.cumsum()
    width, settled = int(codes.max(initial=0)) + 1, []
    while len(at):
        _, which, times = np.unique(part * width + codes[at], return_inverse=True, return_counts=True)
        frequent = times[which] >= periods
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        whole = np.logical_and.reduceat(frequent, first)
        ends = np.r_[first[1:], len(at)]
        settled.append(np.c_[at[first[whole]], at[ends[whole] - 1] + 1])
        left = frequent & ~np.repeat(whole, ends - first)
        at, part = at[left], part[left]
        if len(at):
            fresh = np.r_[True, (np.diff(at) > 1) | (np.diff(part) > 0)]
            first = np.flatnonzero(fresh)
            sizes = np.diff(np.r_[first, len(at)])
            long = np.repeat(sizes >= least, sizes)
            at, part = at[long], fresh.cumsum()[long]
    found = np.concatenate(settled) if settled else np.zeros((0, 2), np.int64)
    return found[np.lexsort((found[:, 0],))] if len(found) else found


def agreeing(w: np.ndarray, q: int, at: int, step: int) -> int:
    """How many words from ``at`` on, forwards or backwards, equal the one q places before them (backwards: behind them)."""
    total, size = 0, 64
    while True:
        if step > 0:
            x = w[at + total:at + total + size]
            differ = np.flatnonzero(x != w[at + total - q:at + total - q + len(x)])
        else:
            x = w[max(at - total - size + 1, 0):max(at - total + 1, 0)][::-1]
            differ = np.flatnonzero(x != w[at - total - len(x) + 1 + q:at - total + 1 + q][::-1])
        if len(differ):
            return total + int(differ[0])
        total += len(x)
        if len(x) < size:
            return total
        size *= 4


def agreeing_blocks(w: np.ndarray, periods: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each lag q, ascending, the aligned blocks of q words that equal the ``periods - 2`` blocks after them, by hash.

    A run of period q agrees with itself q places on over at least (periods - 1) * q places, which hold that many whole
    blocks wherever they lie. Blocks of all lags number about n log n.
    """
    n = len(w)
    power = np.full(n + 1, BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    mixed = (w.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    total = np.r_[np.uint64(0), np.cumsum((mixed ^ (mixed >> np.uint64(32))) * power[:n], dtype=np.uint64)]
    low, high = 1, n // periods
    while low <= high:
        upto = low
        held = 0
        while upto <= high and (held == 0 or held + n // upto <= SCAN_BLOCKS):
            held += n // upto
            upto += 1
            if upto > 64 and upto <= high:  # larger lags have few blocks each: take as many as fit at once
                more = max(1, min(high + 1 - upto, (SCAN_BLOCKS - held) // (n // upto)))
                held += more * (n // upto)
                upto += more
        lags = np.arange(low, upto)
        blocks = n // lags
        q = np.repeat(lags, blocks)
        at = (np.arange(len(q)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * q
        content = total[at + q] - total[at]
        same = (content[:-1] * power[q[:-1]] == content[1:]) & (q[1:] == q[:-1])
        for _ in range(periods - 3):
            same = same[:-1] & same[1:] & (q[1:len(same)] == q[:len(same) - 1])
        hits = np.flatnonzero(same)
        for group in np.split(hits, np.flatnonzero(np.diff(q[hits])) + 1) if len(hits) else []:
            yield int(q[group[0]]), at[group]
        low = upto


def lag_scan(w: np.ndarray, least: int, periods: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment, whole and with their smallest period."""
    found, cover = [], np.zeros(len(w) + 1, np.int64)
    for q, at in agreeing_blocks(w, periods):
        # An area inside a run of a smaller period has that period, and so has all that its own period reaches.
        at = at[cover[at] < at + (periods - 1) * q]
        k = 0
        while k < len(at):
            start, end = int(at[k]), int(at[k]) + (periods - 1) * q
            k += 1
            if not np.array_equal(w[start:end - q], w[start + q:end]):
                continue  # equal hashes of different words
            end += agreeing(w, q, end, 1)
            start -= agreeing(w, q, start - 1, -1)
            if end - start >= max(least, periods * q):
                found.append((start, end - start, q))
                np.maximum(cover[start:end], end, out=cover[start:end])
            k = max(k, int(at.searchsorted(end - (periods - 1) * q, "right")))
    return found


def find_runs(texts: list[list[bytes]], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words: (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    codes, number = np.empty(int(sizes.sum()), np.int64), {}
    for t, s in zip(texts, starts, strict=True):
        codes[s:s + len(t)] = [number.setdefault(w, len(number)) for w in t]
    for a, b in stable_segments(codes, starts, least, periods).tolist():
        if b - a >= least:
            k = int(starts.searchsorted(a, "right")) - 1
            shift = a - int(starts[k])
            out[k] += [(s + shift, n, q) for s, n, q in lag_scan(codes[a:b], least, periods)]
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; of equal ones the first, then the one with the smallest period."""
    best = None
    for r in runs:  # by start, then period, so that only a greater one takes the place
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[k] for k in np.flatnonzero(change.cumsum()[:-1] == 0)]


def loop_tail(doc_id: int, words: list[bytes]) -> list[bytes]:
    """A test load: in every tenth document by the CRC-32 of its id, the tail is replaced by repeats of its first words."""
    h, n = crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a]


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, periods: int = LEAST_PERIODS,
                  alter: Callable[[int, list[bytes]], list[bytes]] | None = None, digests: bool = False) -> DataFrame:
    """Runs of each document and its text without their repeats.

    Words are what ASCII white space separates. A run is a stretch of at least ``least`` words and ``periods`` (3 or
    more) times its smallest period that no neighbouring word continues; words that a run holds after its first period go.
    Gives ``id_col``, ``n_runs``, the run with the greatest length / period as ``start, length, period,
    exponent_milli`` (nulls without a run), ``runs`` (start, length, period; by start, then period) and ``kept`` (the
    words that stay, joined by one space); with ``digests`` the SHA-256 of both as ``runs_sha256, collapsed_sha256`` instead.
    ``alter(id, words)`` may change a document's words first.

    A null, empty or blank text has no words, no run and an empty ``kept``. Rows without an id are left out; rows that
    repeat an id are documents of their own, one row each. Other columns do not matter. A document is one row of one task:
    texts are never gathered, and nothing is shuffled. Splitting looks again only at segments that have changed, and lags
    of a segment of n words cost about n log n.
    """
    assert periods >= 3 and least >= 1

    def solve(ids: list[int], texts: list[list[bytes]]) -> Iterator[tuple]:
        for d, words, runs in zip(ids, texts, find_runs(texts, least, periods), strict=True):
            best = greatest(runs)
            kept = b" ".join(collapsed(words, runs))
            last = (hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest()) if digests else (
                [{"start": s, "length": n, "period": q} for s, n, q in runs], kept.decode())
            yield (d, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, *last)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", "n_runs", "start", "length", "period", "exponent_milli", *last_names]
        numbers = dict.fromkeys(names[2:6], "Int64")
        for batch in batches:
            rows, ids, texts, held = [], [], [], 0
            for d, t in zip(batch["id"].tolist(), batch["t"], strict=True):
                words = t.encode().split() if t else []  # bytes.split knows ASCII white space only
                ids.append(d)
                texts.append(alter(d, words) if alter else words)
                held += len(words)
                if held >= CHUNK_WORDS:
                    rows += solve(ids, texts)
                    ids, texts, held = [], [], 0
            rows += solve(ids, texts)
            yield pd.DataFrame(rows, columns=names).astype(numbers)

    last_names = ["runs_sha256", "collapsed_sha256"] if digests else ["runs", "kept"]
    kinds = ["string", "string"] if digests else ["array<struct<start: long, length: long, period: long>>", "string"]
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("t"))
    schema = "id long, n_runs long, start long, length long, period long, exponent_milli long, " + ", ".join(f"{n} {k}" for n, k in zip(last_names, kinds, strict=True))
    return rows.mapInPandas(released(run), schema).withColumnRenamed("id", id_col)
