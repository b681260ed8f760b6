"""What the substring operators share: which stretches of documents may recur, brought together exactly once.

A window is ``window`` consecutive symbols of a document (words or bytes). Anchors are ``gram`` symbols long and chosen
by winnowing: in every window the grams with the least hash. Equal windows choose equal anchors, so a window can only
recur if its anchor does, and anchors are few. Each anchor that recurs has an owner, the least id of a document that holds it;
the stretches of all documents around an owner's anchors go to the owner's group, where equal windows meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.memory import released
from lakeledger.session import cut_lineage, drop_steps

BASE = 0x2545F4914F6CDD1D  # odd; of the rolling hash
SLICE = 1 << 18  # symbols that are hashed at once
BUCKET = 1 << 18  # bytes or words of stretches with several parts, for whose windows there is a bucket


def rolling(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive symbols (64-bit numbers), by doubling: h(a + b) = h(a) * BASE ** len(b) + h(b)."""
    power = lambda n: np.uint64(pow(BASE, n, 1 << 64))
    out, have, block, width = None, 0, symbols, 1
    while True:
        if size & width:
            if out is None:
                out, have = block, width
            else:
                n = len(symbols) - have - width + 1
                out, have = block[:n] * power(have) + out[width:width + n], have + width
        width *= 2
        if width > size:
            break
        n = len(symbols) - width + 1
        half = width // 2
        block = block[:n] * power(half) + block[half:half + n]
    return out ^ (out >> np.uint64(29))


def over(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``size`` consecutive values."""
    block, width = values, 1
    while 2 * width <= size:
        block, width = pick(block[:len(block) - width], block[width:]), 2 * width
    return pick(block[:len(values) - size + 1], block[size - width:]) if width < size else block


def anchors(symbols: np.ndarray, sizes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the anchors of documents that lie one after the other in ``symbols``."""
    if len(symbols) < window:
        return np.array([], np.uint64), np.array([], np.int64)
    hashes = rolling(symbols, gram)
    hashes = (hashes * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)  # never zero
    span = window - gram + 1
    least = over(hashes, span, np.minimum)
    # Windows that reach into the next document choose nothing.
    ends = np.repeat(np.cumsum(sizes), sizes)[:len(least)]
    least = np.where(np.arange(len(least)) + window <= ends, least, np.uint64(0))
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    at = np.flatnonzero(over(padded, span, np.maximum) == hashes)
    return hashes[at], at


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of half-open ranges; ranges that touch are one run."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return start[new], reach[np.r_[new[1:] - 1, len(start) - 1]]


@dataclass
class Kind:
    """What a symbol is, and the sizes that go with it."""

    symbols: Callable  # text -> whatever the two below take
    hashed: Callable  # list of those -> one array of 64-bit numbers
    packed: Callable  # (symbols, from, to) -> bytes
    window: int
    gram: int
    within: bool  # whether a window may recur within its own document


def rows_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("ver"), text.alias("text"))


def slices(items: list, size: Callable, most: int) -> Iterator[slice]:
    """Consecutive slices of about ``most`` symbols."""
    at = total = 0
    for k, x in enumerate(items):
        total += size(x)
        if total >= most:
            yield slice(at, k + 1)
            at, total = k + 1, 0
    if at < len(items):
        yield slice(at, len(items))


def placed(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Stretches in the order of (doc, ver, start), each with the place of its first symbol on one line on which all
    documents of the chunk follow each other in that order; the line's first places of documents, to tell them apart."""
    rows = rows.sort_values(["doc", "ver", "start"], ignore_index=True)
    doc, ver, start = (rows[c].to_numpy() for c in ("doc", "ver", "start"))
    new = np.r_[True, (doc[1:] != doc[:-1]) | (ver[1:] != ver[:-1])]
    number = np.cumsum(new) - 1
    reach = np.maximum.reduceat(start + rows["size"].to_numpy(), np.flatnonzero(new))
    base = np.cumsum(reach) - reach
    return rows, base[number] + start, base


def stretches(docs: DataFrame, kind: Kind, part: int) -> tuple[DataFrame, int, DataFrame]:
    """Stretches (``g, doc, ver, start, data, parts``) of all documents around anchors that recur, how many symbols are in
    stretches of several parts, and the ranges of documents that are whole copies of an earlier one.

    ``g`` is a group: an owner's stretches, dealt by hash into ``parts`` of about ``part`` symbols. A document that is
    a copy is removed as a whole if it has a window, and gives no stretches: those of the first copy do for it.
    """
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            items, ids = [kind.symbols(t) for t in batch["text"]], batch["doc"].to_numpy()
            for s in slices(items, len, SLICE):
                sizes = np.fromiter(map(len, items[s]), np.int64)
                h, at = anchors(kind.hashed(items[s]), sizes, kind.window, kind.gram)
                starts = np.cumsum(sizes) - sizes
                of = np.searchsorted(starts + sizes, at, "right")
                yield pd.DataFrame({"h": h.view(np.int64), "doc": ids[s][of], "pos": at - starts[of]})

    rows = rows_of(docs)
    found = cut_lineage(rows.select("doc", "text").mapInPandas(released(find), "h long, doc long, pos long"))
    owners = found.groupBy("h").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    # As a table of its own, so that the join can split the rows of an anchor that very many documents share.
    owners = cut_lineage(owners.where("n > 1" if kind.within else "owner < last").select("h", "owner"))
    lists = found.join(owners, "h").groupBy("doc").agg(F.collect_list("pos").alias("pos"), F.collect_list("owner").alias("owner"))
    # First holders of texts: by the hash of the text and its length, confirmed by a digest.
    texts = rows.select("doc", "ver", F.length("text").alias("n"), F.sha2("text", 256).alias("digest"))
    firsts = texts.groupBy("ver", "n", "digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    copies = texts.join(firsts, ["ver", "n", "digest"]).where("doc > first").select("doc", F.col("ver").alias("copied")).distinct()
    copies = copies.groupBy("doc").agg(F.collect_list("copied").alias("copied"))
    given = rows.join(lists.join(copies, "doc", "full"), "doc")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, ver, text, places, owned, copied in zip(*(batch[c] for c in ("doc", "ver", "text", "pos", "owner", "copied")), strict=True):
                symbols = kind.symbols(text)
                n = len(symbols)
                if copied is not None and ver in copied:
                    if n >= kind.window:
                        out.append((None, doc, ver, 0, n, b""))
                    continue
                if places is None or n < kind.window:
                    continue
                at, owner = np.asarray(places, np.int64), np.asarray(owned, np.int64)
                order = np.lexsort((at, owner))
                at, owner = at[order], owner[order]
                low, high = np.maximum(at + kind.gram - kind.window, 0), np.minimum(at + kind.window, n)
                new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (low[1:] > high[:-1])])
                for k, a, b in zip(owner[new], low[new], high[np.r_[new[1:] - 1, len(at) - 1]], strict=True):
                    # Long stretches are cut, so that each window is whole in a piece.
                    for x in range(a, max(b - kind.window + 1, a + 1), max(part // 4, kind.window)):
                        y = min(b, x + max(part // 4, kind.window) + kind.window - 1)
                        out.append((k, doc, ver, x, y, kind.packed(symbols, x, y)))
            yield pd.DataFrame(out, columns=["owner", "doc", "ver", "start", "end", "data"]).astype({"owner": "Int64"})

    taken = cut_lineage(given.select("doc", "ver", "text", "pos", "owner", "copied")
                        .mapInPandas(released(take), "owner long, doc long, ver long, start long, end long, data binary"))
    drop_steps(found, owners)
    whole = taken.where("owner is null").select("doc", "ver", "start", "end")
    sent = taken.where("owner is not null")
    parts = (sent.groupBy("owner").agg(F.sum(F.col("end") - F.col("start")).alias("n"))
             .select("owner", "n", F.ceil(F.col("n") / part).alias("parts")))
    dealt = sent.join(parts.drop("n"), "owner").withColumn("g", F.xxhash64("owner", F.pmod(F.xxhash64("doc", "ver", "start"), "parts")))
    many = parts.where("parts > 1").agg(F.sum("n")).first()[0] or 0
    return dealt.select("g", "doc", "ver", "start", "data", "parts"), many, whole


def choices(symbols: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For the window at every place the least hash of its grams: equal windows have equal ones, and neighbours often."""
    return over(rolling(symbols, gram) * np.uint64(0x9E3779B97F4A7C15), window - gram + 1, np.minimum)


def packed(left: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Windows as one row for each bucket that has some; ``key`` decides the bucket."""
    bucket = (left["key"].to_numpy().view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    columns = {c: left[c].to_numpy(np.int64)[order] for c in WINDOWS}
    return pd.DataFrame({"bucket": bucket[order][cuts], "windows": [
        b"".join(columns[c][a:b].tobytes() for c in WINDOWS) for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True)]})


WINDOWS = ["doc", "ver", "start", "h1", "h2"]


def again(blocks: list[bytes], window: int, within: bool) -> pd.DataFrame:
    """Ranges of the windows of a bucket that an earlier equal one, by 128 bits of hash, makes go."""
    parts = [np.frombuffer(b, np.int64).reshape(len(WINDOWS), -1) for b in blocks]
    doc, ver, start, h1, h2 = np.concatenate(parts, axis=1)
    order = np.lexsort((start, ver, doc, h2, h1))
    doc, ver, start, h1, h2 = (x[order] for x in (doc, ver, start, h1, h2))
    new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
    head = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
    other = new | np.r_[True, (doc[1:] != doc[:-1]) | (ver[1:] != ver[:-1])]
    own = np.maximum.accumulate(np.where(other, np.arange(len(doc)), 0))
    gone = (doc > doc[head]) | (within & (start > start[own]))
    doc, ver, start = doc[gone], ver[gone], start[gone]
    order = np.lexsort((start, ver, doc))
    doc, ver, start = doc[order], ver[order], start[order]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (ver[1:] != ver[:-1]) | (start[1:] > start[:-1] + 1)]) if len(doc) else np.zeros(0, int)
    last = np.r_[cut[1:] - 1, len(doc) - 1] if len(doc) else cut
    return pd.DataFrame({"doc": doc[cut], "ver": ver[cut], "start": start[cut], "end": start[last] + window})


def solved(dealt: DataFrame, many: int, whole: DataFrame, kind: Kind, solve: Callable[[pd.DataFrame], tuple[pd.DataFrame, pd.DataFrame]], chunk: int) -> DataFrame:
    """Ranges of all documents that ``solve`` or the step between parts removes: ``doc, ranges(ver, start, end)``.

    ``solve(stretches)`` gives removed ranges, and, of windows that it keeps in stretches with more than one part,
    ``doc, ver, start, key`` and two independent hashes of the window. Groups follow each other in a task and are solved
    together in chunks of at most ``chunk`` bytes, or one group if it has more: what meets besides its group does no harm, since every match is true.
    Windows that one part keeps meet those of the other parts in buckets: a chunk sends them packed, one row a bucket,
    and there is a bucket for about every ``BUCKET`` symbols of such stretches.
    """
    buckets = max(1, -(-many // BUCKET))
    schema = "bucket long, windows binary, doc long, ver long, start long, end long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, group, more = [], 0, [], 0  # whole groups, and the one that may go on
        for batch in batches:
            cuts = np.flatnonzero(np.r_[True, batch["g"].to_numpy()[1:] != batch["g"].to_numpy()[:-1]]) if len(batch) else []
            for a, b in zip(cuts, [*cuts[1:], len(batch)], strict=False):
                piece = batch.iloc[a:b]
                if group and piece["g"].iloc[0] != group[-1]["g"].iloc[-1]:
                    if held and size + more > chunk:
                        yield from told(pd.concat(held, ignore_index=True))
                        held, size = [], 0
                    held, size, group, more = [*held, *group], size + more, [], 0
                group.append(piece)
                more += int(piece["data"].map(len).sum())
        if held and size + more > chunk:
            yield from told(pd.concat(held, ignore_index=True))
            held = []
        if group:
            yield from told(pd.concat([*held, *group], ignore_index=True))

    def told(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        ranges, left = solve(rows)
        yield ranges.assign(bucket=-1, windows=None)[names]
        if len(left):
            yield packed(left, buckets).assign(doc=0, ver=0, start=0, end=0)[names]

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, blocks = None, []
        for batch in batches:
            for b, w in zip(batch["bucket"], batch["windows"], strict=True):
                if b != bucket:
                    if blocks:
                        yield again(blocks, kind.window, kind.within)
                    bucket, blocks = b, []
                blocks.append(w)
        if blocks:
            yield again(blocks, kind.window, kind.within)

    out = cut_lineage(dealt.repartition("g").sortWithinPartitions("g", "doc", "ver", "start").mapInPandas(released(run), schema))
    cross = (out.where("bucket >= 0").select("bucket", "windows").repartition("bucket").sortWithinPartitions("bucket")
             .mapInPandas(released(meet), "doc long, ver long, start long, end long"))
    ranges = out.where("bucket < 0").select("doc", "ver", "start", "end").unionByName(cross).unionByName(whole)
    return ranges.groupBy("doc").agg(F.collect_list(F.struct("ver", "start", "end")).alias("ranges"))


def removed(docs: DataFrame, ranges: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(doc, text, starts, ends)`` gives the rest of a row of ``schema``, from the merged removed ranges of a document."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, ver, text, found in zip(batch["doc"], batch["ver"], batch["text"], batch["ranges"], strict=True):
                pairs = np.array([(r["start"], r["end"]) for r in found if r["ver"] == ver] if found is not None else [], np.int64).reshape(-1, 2)
                out.append((doc, *fn(text, *merged(pairs[:, 0], pairs[:, 1]))))
            yield pd.DataFrame(out, columns=names)

    return rows_of(docs).join(ranges, "doc", "left").select("doc", "ver", "text", "ranges").mapInPandas(released(run), schema)
