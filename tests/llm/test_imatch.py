"""I-Match fingerprints against a plain version, and what they tell apart."""

import hashlib
from collections import Counter

import brute
import numpy as np
from pyspark.sql import functions as F

from lakeledger.llm import imatch, queries

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
OPTIONS = {"rarest": 40, "commonest": 2}


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def plain(docs, rarest=imatch.RAREST, commonest=imatch.COMMONEST):
    """Sorted rows of the contract, for (doc_id, text) pairs."""
    docs = sorted(((d, t or "") for d, t in docs if d is not None), key=lambda r: (r[0], brute.sha(r[1].encode())))
    df = Counter(w for _, t in docs for w in set(brute.WORDS.findall(t)))
    band = {w for w, n in df.items() if n * rarest >= len(docs) and n * commonest <= len(docs)}

    def pieces(text):
        own = sorted(set(brute.WORDS.findall(text)) & band, key=str.encode)
        if not own:
            return [brute.sha(text.encode())[:8]] * 33
        bits = {w: int(md5(w)[:8], 16) for w in own}
        parts = [own] + [[w for w in own if (bits[w] >> 8 * f) % 2 ** level == 0] for f in range(4) for level in range(1, 9)]
        return [md5(" ".join(p))[:8] if p else "0" * 8 for p in parts]

    def like(a, b):
        held = [(x, y) for x, y in zip(a, b, strict=True) if (x, y) != ("0" * 8, "0" * 8)]
        return sum(x == y for x, y in held) / len(held)

    out = []
    for k, (d, t) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, b, c = pieces(t), pieces(edited), pieces(after)
        out.append((d, len(t), brute.sha(edited.encode()), "".join(a), "".join(b), like(a, b), like(a, c)))
    return sorted(out)


def rows(df):
    assert df.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(tuple(r) for r in df.collect())


def test_query(spark, doc_rows):
    assert rows(queries.QUERIES["op13_imatch_bands"](spark, FOLDER)) == plain(doc_rows)


def test_buckets_and_joins(spark, doc_rows):
    """Many buckets, so that the next document often lies in another one; a lexicon too large to travel."""
    docs = spark.createDataFrame(doc_rows, DOC)
    want = plain(doc_rows, 100, 3)
    assert rows(imatch.fingerprints(docs, rarest=100, commonest=3, bucket_chars=20_000)) == want
    assert rows(imatch.fingerprints(docs, rarest=100, commonest=3, broadcast_bytes=0, bucket_chars=100_000)) == want


def test_odd_rows(spark):
    """Nulls, empty and very long texts, text without words, repeated rows and ids, characters beyond the basic plane, clashing names."""
    rng = np.random.default_rng(4)
    words = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 3000, n))
    long = words(60_000)
    docs = [(7, None), (3, ""), (None, "no id at all"), (5, "one"), (5, "one"), (5, "two words"), (9, long), (10, long + " end"), (11, " \t\n"), (12, "\U0001f600é" * 301),
            (-4, words(80)), *[(100 + k, words(60)) for k in range(40)]]
    frame = spark.createDataFrame(docs, DOC).withColumns({c: F.lit("x") for c in ("bucket", "guard", "row", "term", "mask", "next", "n_chars")})
    for chars in (1000, 1 << 20):
        assert rows(imatch.fingerprints(frame, bucket_chars=chars, **OPTIONS)) == plain(docs, **OPTIONS)
    assert rows(imatch.fingerprints(frame.limit(0))) == []
    single = spark.createDataFrame([(1, "a b c d")], DOC)
    assert rows(imatch.fingerprints(single)) == plain([(1, "a b c d")])


def test_plan(spark, documents):
    """One exchange of texts; the spread terms are neither exchanged nor sorted; no Python."""
    plan = imatch.fingerprints(documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "ArrowEval" not in plan
    assert plan.count("Sort [") == 2 and "SortMergeJoin" not in plan and "SortAggregate" not in plan


def test_likeness_tells_copies(spark):
    """A text with a few words changed is much more like it than an unrelated one; equal texts are equal."""
    rng = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(4000)]
    docs = []
    for k in range(150):
        w = list(rng.choice(vocabulary, 300))
        docs += [(4 * k, " ".join(w)), (4 * k + 1, " ".join(w))]
        w[int(rng.integers(300))] = "changed"
        docs += [(4 * k + 2, " ".join(w)), (4 * k + 3, " ".join(rng.choice(vocabulary, 300)))]
    out = {r["doc_id"]: r for r in imatch.fingerprints(spark.createDataFrame(docs, DOC), rarest=2000, commonest=2).collect()}
    equal, close, other = ([out[4 * k + j]["near_next"] for k in range(150)] for j in (0, 1, 2))
    assert min(equal) == 1 and np.mean(close) > 0.6 and max(other) < 0.2
    assert np.mean([r["near_edited"] for r in out.values()]) > 0.02
