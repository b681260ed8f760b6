"""The pipeline's near copies, held against the similarity of all pairs."""

import brute
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lakeledger.llm import near_copies as nc

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


def kept(spark, docs):
    return {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(docs, DOC), FOLDER).collect()}


def test_against_all_pairs(spark, documents, doc_rows):
    out = corpus_pipeline.drop_near_copies(spark, documents, FOLDER)
    assert out.columns == documents.columns
    assert {r["doc_id"] for r in out.collect()} == brute.first_of_similar(doc_rows)


def test_edited_copies(spark):
    """Copies with words changed here and there: most have a similarity of 0.8 to 0.95, others less."""
    rng, docs = np.random.default_rng(3), [(1000, None), (1001, ""), (1002, "one two"), (1003, "One  two")]
    for k in range(60):
        words = [f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(150, 900)))]
        docs.append((2 * k, " ".join(words)))
        for at in rng.choice(len(words), max(1, round(len(words) * rng.uniform(0.004, 0.03))), replace=False):
            words[at] = "changed"
        docs.append((2 * k + 1, " ".join(words)))
    want = brute.first_of_similar(docs)
    assert kept(spark, docs) == want
    assert 70 < len(want) < 110


def test_one_large_group(spark, monkeypatch):
    """A text, copies of it with one to nine edits each, and pieces of it: chains of links through the base, and copies that
    are like it but not like each other. Pairs that are verified stay few."""
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in rng.integers(0, 5000, 150)]
    docs = [(500, " ".join(base))]
    for k in range(300):
        words = list(base)
        for at in rng.choice(150, int(rng.integers(1, 10)), replace=False):
            words[at] = [f"e{rng.integers(10**6)}", "", f"{words[at]} i{rng.integers(10**6)}"][int(rng.integers(3))]
        docs.append((k, " ".join(words)))
    docs += [(600 + k, " ".join(base[:150 - 9 * k])) for k in range(1, 12)]
    seen, pairs = nc.verified, []
    monkeypatch.setattr(nc, "verified", lambda p, s: pairs.append(p.count()) or seen(p, s))
    assert kept(spark, docs) == brute.first_of_similar(docs)
    assert sum(pairs) < 10 * len(docs)


def test_prefixes_meet():
    """Of any two similar sets in one order, both prefixes hold a common element."""
    rng = np.random.default_rng(5)
    ceil = lambda a, b: -(-a // b)
    for _ in range(20_000):
        n, m = sorted(rng.integers(1, 60, 2).tolist())
        shared = int(rng.integers(ceil(4 * (n + m), 9), n + 1)) if ceil(4 * (n + m), 9) <= n else 0
        if not shared:
            continue
        order = rng.permutation(n + m - shared)
        a, b = np.sort(order[:n]), np.sort(np.r_[order[:shared], order[n:]])
        reach = lambda size, partner: size - ceil(4 * (size + partner), 9) + 1
        low = max(nc.EDGES[np.searchsorted(nc.EDGES, m, "right") - 1], ceil(4 * n, 5))
        lower = max(nc.EDGES[np.searchsorted(nc.EDGES, n, "right") - 1], ceil(4 * m, 5))
        assert set(a[:reach(n, low)]) & set(b[:reach(m, lower)])


def test_odd_rows(spark):
    """Null and empty texts are one class, repeated ids tie their texts, rows without an id stay; long texts; clashing names; an empty table."""
    rng = np.random.default_rng(6)
    long = [f"w{x}" for x in rng.integers(0, 10**6, 40_000)]
    other = " ".join(f"v{x}" for x in rng.integers(0, 10**6, 50))
    docs = [(5, None), (4, ""), (6, " \n"), (None, None), (None, "x y z"), (7, " ".join(long)), (8, " ".join(long[:-4000])), (9, " ".join(long[:28_000])),
            (11, other), (12, other), (12, "x y z"), (13, "X y\tz"), (14, "x y")]
    frame = spark.createDataFrame(docs, DOC).withColumns({c: F.lit("x") for c in ("node", "id", "part", "key", "size", "token", "g", "a")})
    out = nc.keep_first(frame)
    assert out.columns == frame.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in out.collect()) == [(False, 0), (False, 0), (True, 4), (True, 7), (True, 9), (True, 11), (True, 14)]
    assert nc.keep_first(frame.limit(0)).collect() == []
