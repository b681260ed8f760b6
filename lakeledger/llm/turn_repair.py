"""Repair of conversations: the cheapest edits after which roles alternate, by dynamic programming over runs of equal rows."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.memory import released
from lakeledger.session import cut_lineage

SPACE = " \t\n\x0b\x0c\r"
FINE, BLANK, TRUNCATED = 0, 1, 2
#: What came last: 0 nothing, 1 system, 2 user, 3 assistant; a conversation may end in 0 and 3.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = "uuau"  # the one role that may be inserted or given in each state
ROLE = {"u": "user", "a": "assistant"}
TAIL = (0, 4, 2, 0)  # cost of the inserts that a state still needs at the end
FAR = 1 << 40
LEGAL = {"su", "ua", "au"}
PIECE = 1024  # rows, or runs of rows, whose costs are held at once while choices are unrolled

# A symbol stands for all rows that allow the same edits: the letter of a role, or "x" of none that the pattern knows,
# and 1 if keeping it costs one more; "d" for a row that has to go.
DELETED = ("d", 0)
SYMBOLS = [DELETED, *((c, t) for c in "suax" for t in (0, 1))]
NUMBER = {symbol: k for k, symbol in enumerate(SYMBOLS)}


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def options(symbol: tuple[str, int], state: int) -> list[tuple[str, int, int]]:
    """What may be done with a row in a state: (letter, cost, state after it), by letter."""
    letter, extra = symbol
    out = [("D", 3, state)]
    if letter != "d":
        if letter in STEP[state]:
            out.append(("K", extra, STEP[state][letter]))
        out.append(("R", 2 + extra, STEP[state][WANTED[state]]))
    return out


@cache
def insertions() -> np.ndarray:
    """Cost of getting from state to state by inserts alone."""
    m = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(m, 0)
    for s in range(4):
        m[s, STEP[s][WANTED[s]]] = 2
    return times(m, m)


@cache
def power(symbol: int, bit: int) -> np.ndarray:
    """Cost of getting from state to state over 2 ** bit rows of a symbol, inserts before each row included."""
    if bit:
        half = power(symbol, bit - 1)
        return times(half, half)
    m = np.full((4, 4), FAR, np.int64)
    for s in range(4):
        for _, cost, after in options(SYMBOLS[symbol], s):
            m[s, after] = min(m[s, after], cost)
    return times(insertions(), m)


def level(costs: np.ndarray) -> tuple[tuple[int, ...], int]:
    least = int(costs.min())
    return tuple((costs - least).tolist()), least


@cache
def _back(symbol: int, bit: int, costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    return level((power(symbol, bit) + np.array(costs)[None, :]).min(axis=1))


def back(symbol: int, count: int, costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs to go before ``count`` rows of a symbol, given those after them; as differences from the least, and that."""
    total, bit = 0, 0
    while count:
        if count & 1:
            costs, more = _back(symbol, bit, costs)
            total += more
        count, bit = count >> 1, bit + 1
    return costs, total


@cache
def choose(symbol: int, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """Letters of the cheapest edits up to and with one row, ASCII-least, and the state after it. A state has one role to
    insert or to give, so a letter says what follows, and the least letter that is on a cheapest way is the choice."""
    start, letters = power(symbol, 0) + np.array(after)[None, :], ""
    togo = start.min(axis=1)
    while True:
        found = [(letter, to, False) for letter, cost, to in options(SYMBOLS[symbol], state) if cost + after[to] == togo[state]]
        to = STEP[state][WANTED[state]]
        if 2 + togo[to] == togo[state]:
            found.append(("I", to, True))
        letter, state, again = min(found)
        letters += letter
        if not again:
            return letters, state


def cheapest(symbols: bytes | array, counts: list[int] | array) -> tuple[int, str]:
    """Cost and audit of a conversation given as runs of equal symbols.

    Backwards, each run is one step through cached powers of its transition. The costs between runs are kept at every
    ``PIECE``-th run only, and inside a run at every ``PIECE``-th row, and are stepped through once more for the choices.
    """
    n, kept = len(symbols), []
    costs, cost = level(np.array(TAIL))
    for k in range(n - 1, -1, -1):
        if k % PIECE == PIECE - 1 or k == n - 1:
            kept.append(costs)
        costs, more = back(symbols[k], counts[k], costs)
        cost += more
    cost += costs[0]
    state, audit = 0, []
    for first in range(0, n, PIECE):
        last = min(first + PIECE, n)
        after = [kept.pop()]
        for k in range(last - 1, first, -1):
            after.append(back(symbols[k], counts[k], after[-1])[0])
        for k in range(first, last):
            symbol, left, end = symbols[k], counts[k], after.pop()
            while left:
                piece = min(left, PIECE)
                left -= piece
                rows = [back(symbol, left, end)[0] if left else end]
                for _ in range(piece - 1):
                    rows.append(_back(symbol, 0, rows[-1])[0])
                while rows:
                    letters, state = choose(symbol, rows.pop(), state)
                    audit.append(letters)
    while TAIL[state]:
        audit.append("I")
        state = STEP[state][WANTED[state]]
    return cost, "".join(audit)


class Conversation:
    """What is kept of a conversation while its rows pass: a few numbers, and a byte and a count for each run of equal symbols."""

    def __init__(self, key: str) -> None:
        self.key, self.turns, self.low, self.high = key, 0, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.symbols, self.counts = array("B"), array("q")
        self.before, self.initial = None, None

    def put(self, symbol: tuple[str, int], count: int) -> None:
        s = NUMBER[symbol]
        if self.symbols and self.symbols[-1] == s:
            self.counts[-1] += count
        elif count:
            self.symbols.append(s)
            self.counts.append(count)

    def add(self, has_turn: bool, turn: int, initial: str, digest: bytes, fault: int, seen: bool, copies: int) -> None:
        if not copies:
            return
        if has_turn:
            self.low = turn if not self.turns else self.low
            self.turns += not self.turns or turn != self.high
            self.high = turn
        here = (has_turn, turn, digest)
        self.illegal += copies - 1 + (self.initial is not None and self.initial + initial not in LEGAL)
        if fault == BLANK:
            self.blank += copies
            self.put(DELETED, copies)
        else:
            first = not seen and here != self.before
            self.duplicate += copies - first
            if first:
                self.truncated += fault == TRUNCATED
                self.put((initial if initial in {"s", "u", "a"} else "x", int(fault == TRUNCATED)), 1)
            self.put(DELETED, copies - first)
        self.before, self.initial = here, initial

    def row(self) -> tuple:
        cost, audit = cheapest(self.symbols, self.counts)
        return (self.key, self.high - self.low + 1 - self.turns if self.turns else 0, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _key(conversation: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conversation.cast("string")), F.lit(""))


def rows_of(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """The columns that the passes share. ``place`` orders rows of one turn: by role, then by a digest of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    left = F.rtrim(F.col("text"), F.lit(SPACE))
    return (turns.select(_key(F.col("conv_id")).alias("key"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                         role.alias("role"), text.alias("text"), (F.col(copies).cast("long") if copies else F.lit(1)).alias("copies"))
            .withColumns({"digest": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))), "left": left})
            .withColumn("fault", F.when(F.col("left") == "", BLANK).when(F.substring("left", -1, 1).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)).drop("left"))


def audits(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` to one row a conversation: ``key``, the counts of its faults, and the cheapest
    edits as ``cost`` and ``audit``.

    Whether a row came earlier is decided by the first turn of each (conversation, role, text), a grouped minimum. The
    rows of a conversation then pass one task in order, without their texts; it keeps a byte and a number for each run
    of equal rows, and the audit, which is a value of the result.
    """
    rows = rows_of(turns, copies).select("key", "has_turn", "turn", "role", F.substring("role", 1, 1).alias("initial"), "digest", "fault", "copies")
    first = rows.where("copies > 0").groupBy("key", "digest").agg(F.min(F.struct("has_turn", "turn")).alias("first"))
    seen = rows.join(first, ["key", "digest"], "left").withColumn("seen", F.coalesce(F.struct("has_turn", "turn") > F.col("first"), F.lit(False)))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            done = []
            for key, *row in batch[["key", "has_turn", "turn", "initial", "digest", "fault", "seen", "copies"]].itertuples(index=False, name=None):
                if now is None or now.key != key:
                    if now is not None:
                        done.append(now.row())
                    now = Conversation(key)
                now.add(*row)
            yield pd.DataFrame(done, columns=["key", *COUNTS, "audit"])
        if now is not None:
            yield pd.DataFrame([now.row()], columns=["key", *COUNTS, "audit"])

    return _together(seen, "has_turn", "turn", "role", "digest").mapInPandas(
        released(solve), "key string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string")


def _together(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a key in one partition and in order. The number of partitions is given, since what a task does is not
    seen by the size of its rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key").sortWithinPartitions("key", *order)


def repaired(turns: DataFrame, found: DataFrame, copies: str | None = None) -> DataFrame:
    """The conversations after the edits of ``found`` (of ``audits``): ``key, nth, edit, turn, role, text`` in order within
    a partition. An audit comes before the rows of its conversation, which stream past it."""
    rows = rows_of(turns, copies).where("copies > 0").select(
        "key", F.lit(1).alias("kind"), "has_turn", "turn", "role", "digest", "text", "copies", F.lit(None).cast("string").alias("audit"))
    head = found.select("key", F.lit(0).alias("kind"), F.lit(False).alias("has_turn"), F.lit(0).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), "audit")

    def edit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, audit, at, state, nth = None, "", 0, 0, 0

        def inserts(out: list) -> None:
            nonlocal at, state, nth
            while at < len(audit) and audit[at] == "I":
                out.append((key, nth, "I", None, ROLE[WANTED[state]], ""))
                state, at, nth = STEP[state][WANTED[state]], at + 1, nth + 1

        for batch in batches:
            out: list = []
            for k, kind, has_turn, turn, role, text, n, letters in batch[["key", "kind", "has_turn", "turn", "role", "text", "copies", "audit"]].itertuples(index=False, name=None):
                if kind == 0:
                    inserts(out)
                    key, audit, at, state, nth = k, letters, 0, 0, 0
                for _ in range(n):
                    inserts(out)
                    letter, at = audit[at], at + 1
                    if letter != "D":
                        role = ROLE[WANTED[state]] if letter == "R" else role
                        out.append((key, nth, letter, turn if has_turn else None, role, text))
                        state, nth = STEP[state][role[0]], nth + 1
            yield pd.DataFrame(out, columns=["key", "nth", "edit", "turn", "role", "text"]).astype({"turn": "Int64"})
        out = []
        inserts(out)
        yield pd.DataFrame(out, columns=["key", "nth", "edit", "turn", "role", "text"]).astype({"turn": "Int64"})

    return _together(rows.unionByName(head), "kind", "has_turn", "turn", "role", "digest").mapInPandas(
        released(edit), "key string, nth long, edit string, turn long, role string, text string")


def text_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text``, joined by new lines, of each key; rows as ``repaired`` leaves them, a row at a time."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, nth, role, text in batch[["key", "nth", "role", "text"]].itertuples(index=False, name=None):
                if nth == 0:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(f"{chr(10) if nth else ''}{role}:{text}".encode())
            yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
        if state is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "repaired_sha256"])

    return rows.mapInPandas(released(digest), "key string, repaired_sha256 string")


def with_id(rows: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv_id`` in place of ``key``, in the type it has in ``turns``."""
    number = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(turns.schema["conv_id"].dataType)
    return rows.select(number.alias("conv_id"), *[c for c in rows.columns if c != "key"])


def repair(turns: DataFrame, copies: str | None = None, digests: bool = False) -> DataFrame:
    """The cheapest repair of every conversation of ``turns(conv_id, turn, role, text)``.

    Rows stand by turn, null turns first; rows of one turn by role, then by a digest of their text. A null role or text
    counts as one space, rows without a ``conv_id`` are one conversation with a null id, and rows that repeat are
    duplicates. The first letter of a role decides, in this case: "S", an empty role and a space are none that the
    pattern ``(s?(ua)+)?`` knows. A row's first fault counts: blank (only ASCII white space), duplicate (role and text
    came earlier in the conversation), truncated (does not end in ``.``, ``!`` or ``?``). Blank and duplicate rows have
    to be deleted (3); other rows are kept (0), get the role user or assistant (2) or are deleted (3), and a truncated
    one that stays costs 1 more; inserting an empty user or assistant row costs 2. Of the cheapest edits that give the
    pattern, the letters D, I, K, R in order are ASCII-least.

    ``copies`` names a column that says how often a row stands there; 0 leaves the row out, but not its conversation,
    which then has zeros and an empty audit. Gives the repaired rows (``conv_id, nth, edit, turn, role, text``); with
    ``digests`` a row a conversation: the counts, ``cost``, ``audit`` and the SHA-256 of the repaired ``role:text`` lines.
    Other columns of ``turns`` do not matter; an empty table gives an empty one. A conversation is in order in one task
    (its hash takes its bytes one after another), but passes through it: its texts are never held together.
    """
    found = cut_lineage(audits(turns, copies))
    rows = repaired(turns, found, copies)
    if not digests:
        return with_id(rows, turns)
    nothing = F.lit(hashlib.sha256().hexdigest())
    both = found.join(text_digests(rows), "key", "left").withColumn("repaired_sha256", F.coalesce("repaired_sha256", nothing))
    return with_id(both, turns)


def damage(conversations: DataFrame) -> DataFrame:
    """A test load: by the CRC-32 of ``conv_id:turn``, every twentieth row each is dropped, emptied, left without its stops,
    repeated, or given the role user; ``copies`` says how often a row stands there. Nulls become one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    return conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
                                F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text")).alias("text"),
                                F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
