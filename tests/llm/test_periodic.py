"""Periodic runs against all lags of all words."""

import brute
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeledger.llm import periodic, queries

FOLDER = "/root/testdata/sf0.001"
TAILS = [k for k in range(400) if brute.looped(k, list("abcdefgh" * 9)) != list("abcdefgh" * 9)]


@given(st.lists(st.builds(lambda a, b, n: a + b * n, st.text("abc", max_size=12), st.text("abcd", max_size=7), st.integers(0, 7)), max_size=6),
       st.sampled_from([(6, 4), (6, 3), (1, 5), (9, 4)]))
@settings(max_examples=400, deadline=None)
def test_any_words(texts, sizes):
    words = [[c.encode() for c in t] for t in texts]
    assert periodic.find_runs(words, *sizes) == [brute.periodic_runs(t, *sizes) for t in words]


def test_runs_inside_runs():
    words = (b"a a a a a a b " * 5 + b"c d " * 9 + b"x y z " * 5 + b"x y y").split()
    assert periodic.find_runs([words]) == [brute.periodic_runs(words)]
    assert any(q == 1 for _, _, q in periodic.find_runs([words])[0]) and any(q == 7 for _, _, q in periodic.find_runs([words])[0])


def test_splitting_keeps_runs_whole():
    rng = np.random.default_rng(2)
    codes = np.r_[rng.integers(0, 500, 300), np.tile([1, 2, 3, 4, 5], 5), rng.integers(0, 500, 300)]
    found = periodic.stable_segments(codes, np.array([0]), 6, 4)
    assert any(a <= 300 and b >= 325 for a, b in found.tolist()) and int((found[:, 1] - found[:, 0]).sum()) < 200
    for a, b in found.tolist():
        assert np.unique(codes[a:b], return_counts=True)[1].min() >= 4


def test_long_texts():
    """Two words at random, one word alone, and a long period: far more words than any lag may be tried against."""
    rng = np.random.default_rng(3)
    assert periodic.find_runs([[b"a"] * 100_000]) == [[(0, 100_000, 1)]]
    period = [b"%d" % k for k in rng.integers(0, 10**6, 12_345)]
    assert periodic.find_runs([[b"x"] + period * 5 + [b"y"]]) == [[(1, 5 * 12_345, 12_345)]]
    words = [b"%d" % k for k in rng.integers(0, 2, 3000)]
    assert periodic.find_runs([words]) == [brute.periodic_runs(words)]


def test_query(spark, doc_rows):
    out = queries.QUERIES["op12_frequency_splitting"](spark, FOLDER)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {r["doc_id"]: tuple(r) for r in out.collect()}
    assert rows == {d: brute.runs_row(d, t) for d, t in doc_rows} and any(r[1] for r in rows.values())


def test_odd_rows(spark):
    """Null, empty and blank texts, null and repeated ids, ties of two runs, columns that clash, an empty table."""
    tail = TAILS[0]
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "a " * 9), (5, "a " * 9), (5, "a " * 9), (5, "b c d " * 6),
            (6, "a " * 8 + "b " * 8), (tail, "k l m n o p " * 40), (7, "é é " * 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "t", "runs", "start", "kept", "n_runs")})
    out = sorted(tuple(r) for r in periodic.collapse_runs(frame, alter=periodic.loop_tail, digests=True).fillna(-1).collect())
    want = [brute.runs_row(d, t) for d, t in rows if d is not None]
    assert out == sorted(tuple(-1 if x is None else x for x in r) for r in want)
    plain = periodic.collapse_runs(frame).where("doc_id = 6").first()
    assert (plain["n_runs"], plain["start"], plain["period"], plain["kept"]) == (2, 0, 1, "a b") and [tuple(r) for r in plain["runs"]] == [(0, 8, 1), (8, 8, 1)]
    assert periodic.collapse_runs(frame.limit(0), digests=True).collect() == []
