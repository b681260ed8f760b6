"""The forms for very large groups give the same as the plain ones."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeledger.operators import altimetry, scale


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, with repeated and far-off values."""
    rng = np.random.default_rng(7)
    rows = [(1, float(v)) for v in np.round(rng.normal(50, 3, 4000), 1)] + [(1, 1e6), (1, -1e6)]
    rows += [(2, float(v)) for v in rng.uniform(0, 1, 37)] + [(3, 4.5)] + [(4, 1.0), (4, 2.0)]
    return spark.createDataFrame(rows, "k int, v double"), rows


def test_exact_quantiles(skewed):
    df, rows = skewed
    probs = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}
    out = {r["k"]: r for r in scale.exact_quantiles(df, ["k"], "v", probs).collect()}
    for k in (1, 2, 3, 4):
        v = np.array([x for j, x in rows if j == k])
        assert out[k]["n"] == len(v)
        for name, p in probs.items():
            assert out[k][f"{name}_lin"] == pytest.approx(np.quantile(v, p), abs=1e-9)
            assert out[k][f"{name}_mid"] == pytest.approx(np.quantile(v, p, method="midpoint") if len(v) > 1 else v[0], abs=1e-9)


@pytest.mark.parametrize("small", [1, 40])
def test_quantiles_by_digits(skewed, small):
    """So few values may be ordered at once that all digits are counted."""
    df, rows = skewed
    out = {r["k"]: r for r in scale.exact_quantiles(df, ["k"], "v", {"q": 0.25, "m": 0.5}, small=small).collect()}
    for k in (1, 2, 3, 4):
        for name, p in (("q", 0.25), ("m", 0.5)):
            assert out[k][f"{name}_lin"] == pytest.approx(np.quantile([x for j, x in rows if j == k], p), abs=1e-9)


@pytest.mark.parametrize("small", [1, 4096])
def test_ranks_of_any_numbers(spark, small):
    rng = np.random.default_rng(4)
    values = {1: [*rng.normal(0, 1, 200), *(-np.exp(rng.normal(0, 200, 100))), *np.exp(rng.normal(0, 200, 100)), 0.0, -0.0, 5e-324, -5e-324, float("inf"), -float("inf")],
              2: [7.5] * 300, 3: [1.0, np.nextafter(1.0, 2), np.nextafter(1.0, 0)] * 50, 4: [-3.0]}
    rows = [(k, float(x)) for k, v in values.items() for x in v] + [(1, None), (5, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    out = scale.select_ranks(df, ["k"], "v", lambda n: F.sequence(F.lit(0).cast("long"), n - 1), small).collect()
    got = {(r["k"], r["rank"]): (r["n"], r["value"]) for r in out}
    assert got == {(k, i): (len(v), x) for k, v in values.items() for i, x in enumerate(sorted(v))}


def test_running_sums(skewed):
    df, _ = skewed
    levels = df.groupBy("k", "v").agg(F.count("*").alias("c")).withColumn("b", F.floor(F.col("v") / 2))
    plain = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r["k"], r["v"]): r["s"] for r in levels.withColumn("s", F.sum("c").over(plain)).collect()}
    got = {(r["k"], r["v"]): r["s"] for r in scale.running_sums(levels, ["k"], "b", "v", {"s": F.col("c")}).collect()}
    assert got == want


def test_lowest_k(skewed):
    df, rows = skewed
    got = scale.lowest_k(df.distinct(), ["k"], [F.col("v")], 5).collect()
    for k in (1, 2, 3, 4):
        assert sorted(r["v"] for r in got if r["k"] == k) == sorted({x for j, x in rows if j == k})[:5]


@pytest.mark.parametrize("k", [1, 20, 4000, 10**6])
def test_sample(skewed, k, monkeypatch):
    """The rows of the lowest hashes of each key, also where the first limit leaves too few."""
    import hashlib

    df, rows = skewed
    df = df.distinct().withColumn("i", F.col("v").cast("string"))
    every = [tuple(r) for r in df.collect()]
    digest = lambda r: (int(hashlib.md5(f"{r[0]}:{r[2]}".encode()).hexdigest()[:13], 16), r[2])
    want = {r for key in {x[0] for x in every} for r in sorted((x for x in every if x[0] == key), key=digest)[:k]}
    assert {tuple(r) for r in scale.sample_rows(df, ["k"], ["i"], k).collect()} == want


def test_sample_with_narrow_limits(spark, monkeypatch):
    """Rows whose hashes all lie high, so that the first limit holds none."""
    import hashlib

    digest = lambda i: int(hashlib.md5(f"1:{i}".encode()).hexdigest()[:13], 16)
    high = [i for i in range(4000) if digest(i) > 3 << 50]
    df = spark.createDataFrame([(1, i) for i in high] + [(2, 5), (None, 6), (None, 7)], "k int, i int")
    out = [tuple(r) for r in scale.sample_rows(df, ["k"], ["i"], 10).collect()]
    assert sorted(i for k, i in out if k == 1) == sorted(sorted(high, key=digest)[:10]) and sorted(i for k, i in out if k != 1) == [5, 6, 7]


def loop_clean(h):
    """One cycle, step by step."""
    h = sorted(h)
    if h[-1] - h[0] > 5:
        best = max(range(1, len(h)), key=lambda i: (round(sum(h[:i]) ** 2 / i + sum(h[i:]) ** 2 / (len(h) - i) - sum(h) ** 2 / len(h), 6), -h[i - 1]))
        low, high = h[:best], h[best:]
        h = low if len(low) >= len(high) else high
    mean = np.mean(h)
    while len(h) and np.std(h) > 0.3:
        far = max(round(abs(x - mean), 9) for x in h)
        h = [x for x in h if round(abs(x - mean), 9) < far]
    return sorted(h)


def test_cycles_in_buckets(spark):
    rng = np.random.default_rng(3)
    groups = {c: list(np.round(rng.normal(100, 0.5, 60), 3)) + list(np.round(rng.normal(112, 2, 25), 3)) for c in range(6)}
    groups[7] = [1.0, 1.1, 1.2, 1.15]
    groups[8] = [1.0, 3.0]  # both leave together
    groups[9] = [5.0]
    groups[10] = [*groups[0], 1e9]  # one value far from all others
    df = spark.createDataFrame([(c, float(v)) for c, vs in groups.items() for v in vs], "cycle int, height double")
    by_cycle = lambda d: {c: sorted(r["height"] for r in rows) for c, rows in _group(d.collect()).items()}
    small = by_cycle(altimetry.clean_cycles(df, ["cycle"]))
    assert by_cycle(altimetry.clean_cycles(df, ["cycle"], part=7)) == small
    assert small == {c: loop_clean(v) for c, v in groups.items() if loop_clean(v)}
    assert 8 not in small


def _group(rows):
    out = {}
    for r in rows:
        out.setdefault(r["cycle"], []).append(r)
    return out


def test_block_join(spark):
    """The same pairs as a plain join, repeated rows, null keys and keys of one side included; a hot key is dealt out."""
    rng = np.random.default_rng(2)
    left = [(int(k), int(v)) for k, v in zip(np.where(rng.random(500) < 0.8, 7, rng.integers(0, 20, 500)), rng.integers(0, 400, 500), strict=True)] + [(None, 1)]
    right = [(int(k), int(v)) for k, v in zip(np.where(rng.random(300) < 0.7, 7, rng.integers(10, 30, 300)), rng.integers(0, 400, 300), strict=True)] + [(None, 2)]
    a, b = spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b int")
    want = sorted((k, x, y) for k, x in left for j, y in right if k is not None and k == j)
    for block, pairs in ((2048, 1 << 24), (16, 1000), (1, 1 << 14)):
        out = scale.block_join(a, b, ["k"], block, pairs)
        assert out.columns == ["k", "a", "b"] and sorted(map(tuple, out.collect())) == want
    tasks = scale.block_join(a, b, ["k"], 16, 1000).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < len(want) / 10
