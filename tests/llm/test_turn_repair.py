"""Repair of conversations against all edits."""

import brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeledger.llm import queries
from lakeledger.llm import turn_repair as tr

FOLDER = "/root/testdata/sf0.001"
TURN = "conv_id long, turn long, role string, text string"


def edits(symbols, counts=None):
    return tr.cheapest(bytes(symbols), counts or [1] * len(symbols))


@given(st.lists(st.integers(0, len(tr.SYMBOLS) - 1), max_size=12))
@settings(max_examples=500, deadline=None)
def test_any_symbols(symbols):
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
    rows = tuple((role[c], "text", "blank" if c == "d" else "truncated" if t else "") for c, t in (tr.SYMBOLS[k] for k in symbols))
    cost, audit, _ = brute.cheapest_edits(rows)
    assert edits(symbols) == (cost, audit)


@given(st.lists(st.tuples(st.integers(0, len(tr.SYMBOLS) - 1), st.integers(1, 9)), min_size=1, max_size=9))
@settings(max_examples=300, deadline=None)
def test_runs_are_their_rows(runs):
    assert edits([s for s, _ in runs], [n for _, n in runs]) == edits([s for s, n in runs for _ in range(n)])


def test_long_runs():
    """More rows than a piece, in one run and in very many; costs by powers are those of single steps."""
    user = tr.NUMBER["u", 0]
    cost, audit = edits([user], [100_000])
    assert cost == 100_000 * 2 // 2 and len(audit) == 100_000 and set(audit) == {"K", "R"}
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, len(tr.SYMBOLS), 5000).tolist()
    cost, audit = edits(symbols)
    costs, total = tr.level(np.array(tr.TAIL))
    for s in reversed(symbols):
        costs, more = tr._back(s, 0, costs)
        total += more
    assert cost == total + costs[0] and sum(c != "I" for c in audit) == 5000
    assert edits([]) == (0, "")


def same(out, want):
    assert {r["conv_id"]: tuple(r)[1:] for r in out} == want


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = queries.QUERIES["op11_run_length_repair"](spark, FOLDER)
    assert out.columns == ["conv_id", *tr.COUNTS, "audit", "repaired_sha256"]
    same(out.collect(), {c: (0, 0, 0, 0, 0, 0, "", brute.sha(b"")) for c, *_ in rows} | brute.repairs(rows))


ODD = [(1, None, None, None), (1, None, "user", "hello."), (1, 3, "assistant", None), (1, 4, None, "x."), (2, 1, "", "."), (2, 2, "User", "hm"),
       (None, 1, "user", "q?"), (None, 2, "assistant", "é ü.\x0b"), (3, 1, "system", "s."), (3, 2, "system", "s."), (3, 2, "system", "s."),
       (3, 9, "user", "u!"), (3, 10, "assistant", "no stop"), (4, 7, "assistant", " \t\x0c"), (5, 1, "user", "w. " * 60_000), (5, 2, "assistant", "v" * 90_000),
       *[(6, k, "user", "again.") for k in range(1500)], *[(7, k, ("user", "assistant")[k % 2], f"t{k}.") for k in range(200)]]


def test_odd_rows(spark):
    """Nulls in every column, ties and repeated rows, other roles, very long texts, a hot conversation, clashing names, empty tables."""
    frame = spark.createDataFrame(ODD, TURN).withColumns({c: F.lit("x") for c in ("key", "audit", "cost", "copies", "digest", "text2")})
    want = {c: (0, 0, 0, 0, 0, 0, "", brute.sha(b"")) for c, *_ in ODD} | brute.repairs(ODD)
    same(tr.repair(tr.damage(frame), copies="copies", digests=True).collect(), want)
    for digests in (True, False):
        assert tr.repair(frame.limit(0), digests=digests).collect() == []


def test_repaired_rows(spark):
    """Without damage: the rows themselves, in order, and a pattern that holds. Deleting "b" costs what keeping it and an insert do."""
    rows = [(1, 1, "user", "a."), (1, 2, "user", "b"), (1, 3, "assistant", "c."), (2, 1, "assistant", "d."), (3, 1, "user", "e.")]
    out = tr.repair(spark.createDataFrame(rows, TURN)).orderBy("conv_id", "nth").collect()
    assert [tuple(r) for r in out if r["conv_id"] != 2] == [
        (1, 0, "K", 1, "user", "a."), (1, 1, "K", 3, "assistant", "c."),
        (3, 0, "K", 1, "user", "e."), (3, 1, "I", None, "assistant", "")]
    assert [r["role"] for r in out if r["conv_id"] == 2] == ["user", "assistant"]


def test_check_on_odd_rows(spark, tmp_path):
    """The SQL that the query is held against, on the same rows."""
    import duckdb
    from check_queries import table

    from lakeledger.llm import checks
    few = [r for r in ODD if r[0] not in (5, 6)] + [r for r in ODD if r[0] == 6][:40]
    spark.createDataFrame(few, TURN).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    out = queries.QUERIES["op11_run_length_repair"](spark, str(tmp_path))
    cur = con.execute(checks.REPAIRS)
    assert table([d[0] for d in cur.description], cur.fetchall()) == table(out.columns, [tuple(r) for r in out.collect()])
