"""Removing repeated passages of words, located by automata of recurring phrases."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from lakeledger.llm.recurring import Kind, choices, merged, placed, removed, rolling, solved, stretches

WINDOW = 50  # words
GRAM = 12  # words of an anchor
PART = 400_000  # words of an owner that are matched together
CHUNK = 4 << 20  # bytes of stretches that are matched together


class Hashes(dict):
    """64-bit hashes of words, remembered; forgotten when there are very many."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) > 500_000:
            self.clear()
        out = self[word] = xxh64_intdigest(word, 1)
        return out


HASHES = Hashes()


def words_of(text: str) -> list[bytes]:
    return text.encode().split()  # at ASCII white space


def hashed(items: list[list[bytes]]) -> np.ndarray:
    return np.array([HASHES[w] for words in items for w in words], np.uint64)


def kind(window: int = WINDOW, gram: int = GRAM) -> Kind:
    return Kind(words_of, hashed, lambda words, a, b: b" ".join(words[a:b]), window, min(gram, window), within=False)


def locate(rows: pd.DataFrame, window: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Ranges of words that stand in a document with a smaller id, among stretches of words.

    Recurring windows are found by their hashes. Where a run of windows that follow an earlier document's begins, its
    first window, as it stands in that document, becomes a phrase of the automaton. All stretches are streamed through the automaton; each
    occurrence is followed to the right word by word as far as it goes on like the earlier document.
    """
    import ahocorasick

    lists = [d.split(b" ") for d in rows["data"]]
    rows, line, base = placed(rows.assign(size=list(map(len, lists)), words=lists))
    lists, sizes = list(rows["words"]), rows["size"].to_numpy()
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for words in lists for w in words], np.int64)
    table = np.fromiter((HASHES[w] for w in number), np.uint64, len(number))
    symbols = table[ids]
    ends = np.cumsum(sizes)
    row_of = np.repeat(np.arange(len(rows)), sizes)
    doc = rows["doc"].to_numpy()
    n = len(ids)
    h = np.zeros(n, np.uint64)
    if n >= window:
        h[:n - window + 1] = rolling(symbols, window)
    at = np.flatnonzero(np.arange(n) + window <= ends[row_of])
    # Rows lie in the order of documents, so that the first of equal windows is the one in the least document.
    _, first, back = np.unique(h[at], return_index=True, return_inverse=True)
    source = at[first[back]]
    late = doc[row_of[source]] < doc[row_of[at]]
    follows = np.r_[False, late[:-1] & (at[1:] == at[:-1] + 1) & (source[1:] == source[:-1] + 1) & (row_of[at[1:]] == row_of[at[:-1]]) & (row_of[source[1:]] == row_of[source[:-1]])] if len(at) else late
    phrases = np.unique(source[late & ~follows])
    gone = np.zeros(n + 1, bool)  # windows
    if len(phrases):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for p in phrases.tolist():
            automaton.add_word(tuple(ids[p:p + window].tolist()), p)
        automaton.make_automaton()
        for r, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
            followed: dict[int, int] = {}  # how far the stretch was followed along each earlier place, by their distance
            for end, p in automaton.iter(tuple(ids[a:b].tolist())):
                q = a + end - window + 1
                if followed.get(q - p, -1) >= q or doc[row_of[p]] >= doc[r]:
                    continue
                most = min(b - q, int(ends[row_of[p]]) - p) - window
                unlike = np.flatnonzero(ids[q + window:q + window + most] != ids[p + window:p + window + most])
                followed[q - p] = last = q + (int(unlike[0]) if len(unlike) else most)
                gone[q:last + 1] = True
    begin = (ends - sizes)[row_of]
    place = line[row_of] + np.arange(n) - begin
    return outcome(rows, place, base, np.flatnonzero(gone[:n]), window, row_of, at, gone, symbols, min(GRAM, window))


def outcome(rows: pd.DataFrame, place: np.ndarray, base: np.ndarray, found: np.ndarray, window: int, row_of: np.ndarray,
            at: np.ndarray, gone: np.ndarray, symbols: np.ndarray, gram: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Removed ranges, from windows (indexes ``found``) on the line of documents, and the windows that are left in
    stretches of several parts. Where a document lies several times in a chunk, the places are the same."""
    ids = rows.drop_duplicates(["doc", "ver"])[["doc", "ver"]].reset_index(drop=True)
    a, b = merged(place[found], place[found] + window)
    of = np.searchsorted(base, a, "right") - 1
    # Ranges of one document do not reach the next, but may touch it on the line.
    starts, ends, which = [], [], []
    for x, y, k in zip(a.tolist(), b.tolist(), of.tolist(), strict=True):
        while k + 1 < len(base) and y > base[k + 1]:
            starts.append(x - base[k])
            ends.append(base[k + 1] - base[k])
            which.append(k)
            x, k = base[k + 1], k + 1
        starts.append(x - base[k])
        ends.append(y - base[k])
        which.append(k)
    ranges = ids.iloc[which].reset_index(drop=True).assign(start=np.array(starts, np.int64), end=np.array(ends, np.int64))
    several = rows["parts"].to_numpy() > 1
    left = at[several[row_of[at]] & ~gone[at]] if len(at) else at
    if not len(left):
        return ranges, pd.DataFrame({"doc": [], "ver": [], "start": [], "h1": [], "h2": [], "key": []}, dtype="int64")
    one = rolling(symbols, window)[left]
    two = rolling((symbols ^ np.uint64(0x5851F42D4C957F2D)) * np.uint64(0xD6E8FEB86659FD93), window)[left]
    owner = row_of[left]
    return ranges, pd.DataFrame({"doc": rows["doc"].to_numpy()[owner], "ver": rows["ver"].to_numpy()[owner],
                                 "start": place[left] - base[np.searchsorted(base, place[left], "right") - 1],
                                 "h1": one.view(np.int64), "h2": two.view(np.int64), "key": choices(symbols, window, gram)[left].view(np.int64)})


def repeated_passages(docs: DataFrame, window: int = WINDOW, part: int = PART, chunk: int = CHUNK) -> DataFrame:
    """``doc, ranges(ver, start, end)``: words of documents that passages of ``window`` words cover which also start
    in a document with a smaller id; only documents that have some."""
    k = kind(window)
    return solved(*stretches(docs, k, part), k, lambda rows: locate(rows, window), chunk)


def remove_repeats(docs: DataFrame, window: int = WINDOW, part: int = PART, chunk: int = CHUNK, digests: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed`` and the kept words joined by one space, as ``kept`` or as ``kept_sha256``.

    Words are cut at ASCII white space and kept as they are. A null text is empty. Windows are judged on the input. Rows without an id are left
    out; of rows that repeat an id none is earlier than the other.
    """
    def rest(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple:
        words = words_of(text)
        kept, at = [], 0
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            kept += words[at:a]
            at = b
        kept += words[at:]
        data = b" ".join(kept)
        return len(words), len(words) - len(kept), hashlib.sha256(data).hexdigest() if digests else data.decode()

    schema = "doc_id long, n_words long, n_removed long, " + ("kept_sha256 string" if digests else "kept string")
    return removed(docs, repeated_passages(docs, window, part, chunk), rest, schema)
