"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.memory import trim

ORDER = 5
SAMPLE_ROWS = 400  # labelled rows of each language that the models are fitted to: the bound of the sample
CALIBRATION = 5  # every fifth of them is kept from the counts, to set the limit of rejection
ALPHABET = 1000  # characters among which the unigram model spreads what it has not seen
SHARPNESS = 10.0  # of the score: how far a nat per character tells two languages apart
KEPT = 200_000  # words whose likelihoods a worker remembers
WINDOWS = 400_000  # windows of characters whose likelihoods it remembers
MOST_LANGUAGES = 500  # languages that are learned, those with the most labelled rows: bounds what travels to the tasks
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
BEFORE, AFTER = "\x02", "\x03"
LAGS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1) ** 5) | 1 for k in range(32)], dtype=object) % (1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def windows(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the last ``order`` characters at every place where a character is predicted (the latest first), and
    the word of each place. A word starts after ``order - 1`` marks and ends with one that is predicted too."""
    pad = BEFORE * (order - 1)
    text = "".join([pad + w + AFTER for w in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(sizes + order - 1) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[word]
    return codes[at[:, None] - np.arange(order)], word


def gram_keys(codes: np.ndarray, first: int, last: int) -> np.ndarray:
    """One hash for the characters at distances ``first`` to ``last`` back."""
    key = np.full(len(codes), last - first + 1, np.uint64)
    for k in range(first, last + 1):
        key += mixed((codes[:, k] + np.uint64(1)) * np.uint64(int(LAGS[k])))
    return key


@dataclass
class Model:
    """Sorted hashes of n-grams with their discounted shares, and of contexts with what they leave to shorter ones."""

    grams: list[np.ndarray]
    shares: list[np.ndarray]
    contexts: list[np.ndarray]
    rest: list[np.ndarray]
    limit: float = np.inf  # cross-entropy above which a text is rejected

    @property
    def order(self) -> int:
        return len(self.grams)

    def surprise(self, codes: np.ndarray) -> np.ndarray:
        """Minus the log probability of the latest character in each row."""
        p = np.full(len(codes), 1.0 / ALPHABET)
        for n in range(1, self.order + 1):
            left = found(self.contexts[n - 1], self.rest[n - 1], gram_keys(codes, 1, n - 1), 1.0)
            p = found(self.grams[n - 1], self.shares[n - 1], gram_keys(codes, 0, n - 1), 0.0) + left * p
        return -np.log(p)


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def fit(words: list[str], counts: np.ndarray, order: int = ORDER) -> Model:
    """Interpolated Kneser-Ney: the longest n-grams by how often they occur, shorter ones by how many characters
    they follow; one absolute discount an order, from how many were seen once and twice."""
    codes, word = windows(words, order)
    grams, shares, contexts, rest = [], [], [], []
    types, where, back = np.unique(gram_keys(codes, 0, order - 1), return_index=True, return_inverse=True)
    number = np.bincount(back, weights=counts[word])
    rows = codes[where]
    for n in range(order, 0, -1):
        once, twice = (number == 1).sum(), (number == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        keys, of = np.unique(gram_keys(rows, 1, n - 1), return_inverse=True)
        total = np.bincount(of, weights=number)
        grams.insert(0, types)
        shares.insert(0, np.maximum(number - discount, 0) / total[of])
        contexts.insert(0, keys)
        rest.insert(0, np.bincount(of, weights=np.minimum(number, discount)) / total)
        if n > 1:
            types, where, back = np.unique(gram_keys(rows, 0, n - 2), return_index=True, return_inverse=True)
            number, rows = np.bincount(back).astype(float), rows[where]
    return Model(grams, shares, contexts, rest)


def calibrated(model: Model, texts: list[tuple[list[str], np.ndarray]]) -> float:
    """The limit of rejection: half way from the highest cross-entropy of a kept text of the language to that of
    characters drawn evenly from the ones it uses."""
    highest = 0.0
    for words, counts in texts:
        codes, word = windows(words, model.order)
        weight = counts[word]
        if weight.sum() >= 20:  # a shorter text says little about the limit
            highest = max(highest, float((model.surprise(codes) * weight).sum() / weight.sum()))
    even = np.log(max(len(model.grams[0]), 2)) * 1.5
    return highest + max(even - highest, 1.0) / 2


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def train(docs: DataFrame, usable: Column, order: int = ORDER, sample_rows: int = SAMPLE_ROWS, most_languages: int = MOST_LANGUAGES) -> dict[str, Model]:
    """A model for each language among ``text, lang, doc_id`` rows that are ``usable`` and have both; other columns do not matter.

    Fitted to at most ``sample_rows`` rows of each language, the first by a hash of the id: a bound that does not
    grow with the input. Each of them counts as a whole text. Of more than ``most_languages`` values of ``lang`` those
    with the most rows are learned, ties by name.
    """
    docs = docs.select("doc_id", "text", "lang")
    key = F.xxhash64(F.col("doc_id").cast("string"))
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", key.alias("key"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    learned = [r["lang"] for r in sizes.orderBy(F.desc("size"), "lang").limit(most_languages).collect()]
    first = Window.partitionBy("lang").orderBy("key", "doc_id")
    sample = (rows.where(F.col("lang").isin(learned)).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample_rows)
              .select("doc_id", F.col("lang").alias("tag"), "nth"))
    # The ids are at most most_languages times sample_rows, so that their texts are found without moving the others.
    texts = docs.join(F.broadcast(sample), "doc_id").where(F.col("lang") == F.col("tag")).select("tag", "nth", "text")

    def one(tag: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["nth", "text"])
        bags = []
        for text in part["text"]:
            words, n = np.unique(np.array(words_of(text), dtype=object), return_counts=True)
            if len(words):
                bags.append((list(words), n.astype(float)))
        kept = bags[::CALIBRATION] if len(bags) >= 2 * CALIBRATION else []
        total: dict[str, float] = {}
        for words, n in bags if not kept else [b for k, b in enumerate(bags) if k % CALIBRATION]:
            for w, c in zip(words, n, strict=True):
                total[w] = total.get(w, 0) + c
        if not total:
            return pd.DataFrame({"tag": [], "n": [], "limit": [], "grams": [], "shares": [], "contexts": [], "rest": []})
        model = fit(list(total), np.fromiter(total.values(), float), order)
        limit = calibrated(model, kept or bags)
        return pd.DataFrame([(tag[0], n, limit, model.grams[n].tobytes(), model.shares[n].tobytes(),
                              model.contexts[n].tobytes(), model.rest[n].tobytes()) for n in range(order)],
                            columns=["tag", "n", "limit", "grams", "shares", "contexts", "rest"])

    parts = texts.groupBy("tag").applyInPandas(one, "tag string, n int, limit double, grams binary, shares binary, contexts binary, rest binary").collect()
    models = {}
    for tag in sorted({r["tag"] for r in parts}):
        own = sorted((r for r in parts if r["tag"] == tag), key=lambda r: r["n"])
        array = lambda column, kind, own=own: [np.frombuffer(r[column], kind) for r in own]
        models[tag] = Model(array("grams", np.uint64), array("shares", float), array("contexts", np.uint64), array("rest", float), own[0]["limit"])
    return models


class Identifier:
    """Cross-entropies of texts under all models. Words are scored once and remembered, and so is each window of
    characters that words share: a sorted array of their hashes, with the cost of the last character under each model."""

    def __init__(self, models: dict[str, Model]):
        self.tags, self.models = list(models), list(models.values())
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.costs = np.zeros((0, len(self.models) + 1))  # of each word: its cost under each model, its characters
        self.windows, self.window_costs = np.zeros(0, np.uint64), np.zeros((0, len(self.models)))

    def surprises(self, codes: np.ndarray) -> np.ndarray:
        """Of each window and model, the cost of its latest character."""
        keys, first, back = np.unique(gram_keys(codes, 0, codes.shape[1] - 1), return_index=True, return_inverse=True)
        at = np.searchsorted(self.windows, keys)
        new = at == len(self.windows)
        new[~new] = self.windows[at[~new]] != keys[~new]
        if new.any():
            fresh = codes[first[new]]
            if len(self.windows) + len(fresh) > max(WINDOWS, 2 * len(keys)):  # start again with those of this call
                self.windows, self.window_costs = keys, np.column_stack([m.surprise(codes[first]) for m in self.models])
            else:
                self.windows = np.insert(self.windows, at[new], keys[new])
                self.window_costs = np.insert(self.window_costs, at[new], np.column_stack([m.surprise(fresh) for m in self.models]), axis=0)
            at = np.searchsorted(self.windows, keys)
        return self.window_costs[at][back]

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text and model, nats a character; whether the text has a letter."""
        if len(self.known) > KEPT:
            self.forget()
        lists = [[self.known.setdefault(w, len(self.known)) for w in words_of(t or "")] for t in texts]
        new = list(self.known)[len(self.costs):]
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            codes, word = windows(part, self.models[0].order)
            surprise = self.surprises(codes)
            cost = [np.bincount(word, weights=surprise[:, k], minlength=len(part)) for k in range(len(self.models))]
            self.costs = np.vstack([self.costs, np.column_stack([*cost, np.bincount(word, minlength=len(part))])])
        sums = np.array([self.costs[x].sum(axis=0) if x else np.zeros(len(self.models) + 1) for x in lists])
        sums = sums.reshape(len(texts), len(self.models) + 1)
        return sums[:, :-1] / np.maximum(sums[:, -1:], 1), sums[:, -1] > 0


def language(text: Column, models: dict[str, Model], spark) -> Column:
    """A struct of ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` and ``rejected`` for a text column.

    The language whose model gives the lowest cross-entropy a character over the letters of the whole text. A text
    without a letter, or null, is ``und`` with score 0, and rejected; so is any text if no language was learned.
    A text whose lowest cross-entropy is above its language's limit keeps its language and is rejected.
    """
    shared = spark.sparkContext.broadcast(models)  # bounded by the sample

    @F.pandas_udf("lang_pred string, score double, cross_entropy double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            yield from answers(batches)
        finally:
            trim()

    def answers(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Identifier(shared.value)
        limits = np.array([m.limit for m in known.models])
        for texts in batches:
            if not known.models:
                yield pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "cross_entropy": np.nan, "rejected": True})
                continue
            cost, letters = known.entropies(list(texts))
            best = cost.argmin(axis=1)
            lowest = cost.min(axis=1)
            score = 1 / np.exp(-SHARPNESS * (cost - lowest[:, None])).sum(axis=1)
            yield pd.DataFrame({
                "lang_pred": np.where(letters, np.array(known.tags, dtype=object)[best], UNKNOWN),
                "score": np.where(letters, score, 0.0), "cross_entropy": np.where(letters, lowest, np.nan),
                "rejected": ~letters | (lowest > limits[best])})

    return predict(text)


def held_out() -> Column:
    """Documents that nothing is learned from; false where there is no id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, cross_entropy, rejected`` of every row, also of null or repeated ids."""
    models = train(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2, **options)
    return docs.select("doc_id", held_out().alias("held_out"), language(F.col("text"), models, docs.sparkSession).alias("p")).select("doc_id", "held_out", "p.*")


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    models = train(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2, **options)
    name = "_language_" + "_".join(docs.columns)
    return docs.withColumn(name, language(F.col("text"), models, docs.sparkSession)).where(~F.col(f"`{name}`.rejected")).drop(name)
