"""Language identification against a Kneser-Ney model of plain dictionaries, and on odd columns."""

import math
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeledger.llm import language, queries

FOLDER = "/root/testdata/sf0.001"
LABELLED = "doc_id long, text string, lang string"
ORDER = 5


class Plain:
    """Interpolated Kneser-Ney of order 5 on words with their counts; every n-gram is a string, the latest character last."""

    def __init__(self, words):
        numbers = Counter()
        for w, n in words.items():
            for gram in self.grams(w):
                numbers[gram] += n
        self.orders = {}
        for n in range(ORDER, 0, -1):
            once, twice = (sum(x == k for x in numbers.values()) for k in (1, 2))
            off = once / (once + 2 * twice) if once and twice else 0.5
            total, left = defaultdict(float), defaultdict(float)
            for gram, x in numbers.items():
                total[gram[:-1]] += x
                left[gram[:-1]] += min(x, off)
            self.orders[n] = ({g: max(x - off, 0) / total[g[:-1]] for g, x in numbers.items()}, {c: left[c] / total[c] for c in total})
            numbers = Counter(g[1:] for g in numbers)  # how many characters a shorter one follows

    @staticmethod
    def grams(word):
        text = language.BEFORE * (ORDER - 1) + word + language.AFTER
        return [text[i:i + ORDER] for i in range(len(word) + 1)]

    def cost(self, gram):
        p = 1 / language.ALPHABET
        for n in range(1, ORDER + 1):
            shares, left = self.orders[n]
            p = shares.get(gram[-n:], 0.0) + left.get(gram[-n:-1], 1.0) * p
        return -math.log(p)

    def entropy(self, words):
        grams = [g for w in words for g in self.grams(w)]
        return sum(map(self.cost, grams)) / len(grams) if grams else None


def test_query_against_plain_models(spark, documents):
    rows = documents.select("doc_id", "text", "lang", F.xxhash64(F.col("doc_id").cast("string")).alias("key"), (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("out")).collect()
    models = {}
    for lang in {r["lang"] for r in rows if r["lang"]}:
        learned = sorted((r for r in rows if r["lang"] == lang and r["text"] is not None and not r["out"]), key=lambda r: (r["key"], r["doc_id"]))[:language.SAMPLE_ROWS]
        bags = [b for b in (Counter(language.words_of(r["text"])) for r in learned) if b]
        used = [b for k, b in enumerate(bags) if k % language.CALIBRATION] if len(bags) >= 2 * language.CALIBRATION else bags
        models[lang] = Plain(sum(used, Counter()))
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_kneser_ney_language"](spark, FOLDER).collect()}
    assert len(got) == len(rows)
    for r in rows:
        costs = {lang: m.entropy(language.words_of(r["text"] or "")) for lang, m in models.items()}
        mine = got[r["doc_id"]]
        assert mine["held_out"] == r["out"]
        if None in costs.values():
            assert (mine["lang_pred"], mine["score"]) == ("und", 0.0)
        else:
            best = min(costs, key=lambda k: (costs[k], k))
            assert mine["cross_entropy"] == pytest.approx(costs[best], rel=1e-9)
            assert mine["lang_pred"] == best or costs[mine["lang_pred"]] == pytest.approx(costs[best], rel=1e-9)
            assert mine["score"] == pytest.approx(1 / sum(math.exp(-language.SHARPNESS * (c - costs[best])) for c in costs.values()))


def test_remembered_windows():
    """Costs do not depend on what has been looked up before, nor on how much may be remembered."""
    words = brute.WORDS.findall("the cat sat on the mat and the dog ate thin cake there that then thus hen " * 3)
    model = language.fit(sorted(set(words)), np.ones(len(set(words))), ORDER)
    texts = ["the cat", "a thistle sat", "zzz the mat", "hat cat bat", "the cat"]
    known = language.Identifier({"x": model, "y": model})
    first = known.entropies(texts)[0]
    alone = np.vstack([language.Identifier({"x": model, "y": model}).entropies([t])[0] for t in texts])
    assert np.array_equal(first, alone) and np.array_equal(known.entropies(texts)[0], alone)
    few = language.Identifier({"x": model, "y": model})
    language.WINDOWS, kept = 3, language.WINDOWS
    try:
        assert np.array_equal(np.vstack([few.entropies([t])[0] for t in texts]), alone)
    finally:
        language.WINDOWS = kept


def test_clashing_columns_and_many_languages(spark, documents):
    docs = documents.select("doc_id", "text", "lang")
    want = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()}
    odd = docs.withColumns({c: F.lit("x") for c in ("tag", "nth", "key", "lang_pred", "p", "size", "id")})
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(odd).collect()} == want
    assert language.keep_identified(odd).columns == odd.columns
    # Languages with fewest rows are left out where there are more than may be learned.
    sizes = Counter(r["lang"] for r in docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).collect() if r["lang"])
    top = {lang for lang, _ in sorted(sizes.items(), key=lambda x: (-x[1], x[0]))[:2]}
    assert {r["lang_pred"] for r in language.identify(odd, most_languages=2).collect()} - {"und"} == top
