"""Masked pseudo-likelihood: a network over a window of both neighbours scores every word of a document.

The network predicts a word's class. Words that share a class are told apart by their share of it, counted over all
documents, so that the probabilities of all words between two neighbours sum to one."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.session import cut_lineage

CLASSES = 256  # 0 stands outside a document, then the frequent words, then buckets for the others
BUCKETS = 64
WIDTH, HIDDEN = 16, 32
ROUNDS = 2  # of local training and averaging
EPOCHS = 4
STEP = 0.01
CHUNK = 2048  # contexts in a step
WORD = re.compile(r"\w+|[^\w\s]")
SUMMERS = 16  # tasks that add up the weights of all partitions
CARRIED = 1 << 16  # words whose numbers every task has; the numbers of the others are joined
UNSEEN = 1  # occurrences that each bucket keeps for words that were never counted
HELD = 600_000  # words that a worker remembers


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n`` over all documents; tasks count what they read before anything is shuffled."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch["text"]:
                seen.update(words_of(t))
                if len(seen) > 200_000:
                    yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())}).astype({"word": object, "n": "int64"})

    return (docs.select(F.col(text).cast("string").alias("text")).mapInPandas(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary(docs: DataFrame, classes: int = CLASSES, buckets: int = BUCKETS) -> dict[str, int]:
    """Classes 1, 2, ... of the most frequent words, ties by the word; their number is fixed."""
    return most_frequent(word_counts(docs), classes, buckets)


def most_frequent(counts: DataFrame, classes: int = CLASSES, buckets: int = BUCKETS) -> dict[str, int]:
    top = counts.orderBy(F.desc("n"), "word").limit(classes - buckets - 1).collect()
    return {r["word"]: k + 1 for k, r in enumerate(top)}


class Shares(NamedTuple):
    """What tells the words of a class apart: ``counts(word, n)`` of all words, a table; the frequent ones of it; and
    the logarithm of each class's occurrences, those kept for unseen words included (0 where a class is one word)."""
    counts: DataFrame
    carried: dict[str, int]
    totals: np.ndarray


def shares_of(counts: DataFrame, known: dict[str, int], classes: int = CLASSES, buckets: int = BUCKETS, carried: int = CARRIED) -> Shares:
    """``counts`` is read several times. A word that is not carried has at most one of ``carried`` parts of all occurrences."""
    step = F.floor(F.log2("n") * 16)  # at most 16 steps for each doubling, so that few numbers reach the driver
    least, room = None, carried
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():
        if (room := room - r["words"]) < 0:
            break
        least = r["step"]
    often = {} if least is None else {r["word"]: r["n"] for r in counts.where(step >= least).collect()}
    sums = np.zeros(classes)
    for r in counts.groupBy(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(buckets)).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        sums[classes - buckets + r["bucket"]] = r["n"]
    top = {r["word"]: r["n"] for r in counts.where(F.col("word").isin(list(known))).collect()}
    for word, n in top.items():  # words with a class of their own are in no bucket
        sums[classes - buckets + zlib.crc32(word.encode()) % buckets] -= n
    totals = np.zeros(classes)
    totals[classes - buckets:] = np.log(sums[classes - buckets:] + UNSEEN)
    return Shares(counts, {w: n for w, n in often.items() if w not in known}, totals)


class Classes:
    """Class of a word: its own, or one of the buckets by a hash."""

    def __init__(self, known: dict[str, int], classes: int, buckets: int):
        self.known, self.first, self.buckets = dict(known), classes - buckets, buckets
        self.frequent = len(known)

    def of(self, text: str | None) -> np.ndarray:
        known = self.known
        if len(known) > self.frequent + 500_000:
            self.known = known = dict(list(known.items())[:self.frequent])
        out = []
        for w in words_of(text):
            c = known.get(w)
            if c is None:
                c = known[w] = self.first + zlib.crc32(w.encode()) % self.buckets
            out.append(c)
        return np.array(out, np.int64)


def encode(docs: DataFrame, known: dict[str, int], classes: int = CLASSES, buckets: int = BUCKETS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, codes``: the classes of every document's words, a byte each."""
    if classes > 256:
        raise ValueError("classes are coded in a byte")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Classes(known, classes, buckets)
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "codes": [find.of(t).astype(np.uint8).tobytes() for t in batch["text"]]})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInPandas(run, "id long, codes binary")


class Lexicon:
    """Classes of a text's words, the sum of the logarithms of the carried words' numbers, and the words that are
    neither carried nor a class of their own."""

    def __init__(self, known: dict[str, int], carried: dict[str, int], classes: int, buckets: int, held: int = HELD):
        self.first, self.buckets = classes - buckets, buckets
        self.at = {w: k for k, w in enumerate([*known, *carried])}
        self.words = list(self.at)
        self.always, self.held = len(self.words), max(held, len(self.words) + 1)
        self.code = np.zeros(self.held, np.uint8)
        self.log = np.zeros(self.held)
        self.code[:self.always] = [*known.values(), *map(self.bucket, carried)]
        self.log[len(known):self.always] = np.log([float(n) for n in carried.values()])

    def bucket(self, word: str) -> int:
        return self.first + zlib.crc32(word.encode()) % self.buckets

    def of(self, text: str | None) -> tuple[bytes, float, list[str]]:
        codes, total, rare = [], 0.0, []
        words, at = words_of(text), self.at
        for start in range(0, len(words), 100_000):
            slots = []
            for w in words[start:start + 100_000]:
                k = at.get(w)
                if k is None:
                    if len(self.words) == self.held:  # what the part has so far is settled first
                        codes, total, rare = self.settle(slots, codes, total, rare)
                        slots, self.words = [], self.words[:self.always]
                        self.at = at = {w: k for k, w in enumerate(self.words)}
                    k = at[w] = len(self.words)
                    self.code[k] = self.bucket(w)
                    self.words.append(w)
                slots.append(k)
            codes, total, rare = self.settle(slots, codes, total, rare)
        return b"".join(codes), total, rare

    def settle(self, slots: list[int], codes: list[bytes], total: float, rare: list[str]) -> tuple[list[bytes], float, list[str]]:
        places = np.array(slots, np.int64)
        return ([*codes, self.code[places].tobytes()], total + float(self.log[places].sum()),
                [*rare, *(self.words[k] for k in places[places >= self.always])])


def encode_words(docs: DataFrame, known: dict[str, int], shares: Shares, classes: int = CLASSES, buckets: int = BUCKETS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` with ``row, carried, rare`` for ``score`` with shares. To be written before it is read, as ``row`` is
    the row's place."""
    if classes > 256:
        raise ValueError("classes are coded in a byte")
    shared = docs.sparkSession.sparkContext.broadcast((known, shares.carried))  # of fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Lexicon(*shared.value, classes, buckets)
        for batch in batches:
            found = [find.of(t) for t in batch["text"]]
            yield pd.DataFrame({"row": batch["row"], "id": batch["id"].astype("Int64"), "codes": [c for c, _, _ in found],
                                "carried": [x for _, x, _ in found], "rare": [r for _, _, r in found]}).astype({"carried": "float64"})

    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
            .mapInPandas(run, "row long, id long, codes binary, carried double, rare array<string>"))


def windows(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left neighbour, word and right neighbour at every word of documents that follow each other; 0 stands between them."""
    line = np.frombuffer(b"\0" + b"\0".join(codes) + b"\0", np.uint8).astype(np.int32)
    at = np.flatnonzero(line)
    return line[at - 1], line[at], line[at + 1]


def start(classes: int = CLASSES, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shape = {"left": (classes, width), "right": (classes, width), "w": (2 * width, hidden), "b": (hidden,), "out": (hidden, classes), "bias": (classes,)}
    scale = {"left": 0.3, "right": 0.3, "w": (2 * width) ** -0.5, "b": 0, "out": hidden ** -0.5, "bias": 0}
    return {k: (rng.standard_normal(s) * scale[k]).astype(np.float32) for k, s in shape.items()}


def log_probabilities(net: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Log probability of every class between the two given ones, a row for each context."""
    hidden = np.tanh(np.hstack([net["left"][left], net["right"][right]]) @ net["w"] + net["b"])
    z = hidden @ net["out"] + net["bias"]
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def gradient(net: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean surprise over the words that ``counts`` holds for each context."""
    x = np.hstack([net["left"][left], net["right"][right]])
    hidden = np.tanh(x @ net["w"] + net["b"])
    z = hidden @ net["out"] + net["bias"]
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    number = counts.sum(axis=1, keepdims=True)
    dz = (p * number - counts) / number.sum()
    dh = (dz @ net["out"].T) * (1 - hidden * hidden)
    dx = dh @ net["w"].T
    width = net["left"].shape[1]
    out = {"left": np.zeros_like(net["left"]), "right": np.zeros_like(net["right"]), "w": x.T @ dh, "b": dh.sum(axis=0), "out": hidden.T @ dz, "bias": dz.sum(axis=0)}
    np.add.at(out["left"], left, dx[:, :width])
    np.add.at(out["right"], right, dx[:, width:])
    return out


def trained(net: dict[str, np.ndarray], counts: np.ndarray, epochs: int = EPOCHS, step: float = STEP, chunk: int = CHUNK, seed: int = 0) -> dict[str, np.ndarray]:
    """Adam over the contexts that occur, each with all the words counted in it. ``counts[left, word, right]``."""
    classes = len(counts)
    by_context = counts.transpose(0, 2, 1).reshape(classes * classes, classes)
    contexts = np.flatnonzero(by_context.any(axis=1))
    net = {k: v.copy() for k, v in net.items()}
    one, two = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    rng, t = np.random.default_rng(seed), 0
    for _ in range(epochs):
        rng.shuffle(contexts)
        for at in range(0, len(contexts), chunk):
            part = contexts[at:at + chunk]
            g, t = gradient(net, part // classes, part % classes, by_context[part].astype(np.float32)), t + 1
            for k, v in g.items():
                one[k] = 0.9 * one[k] + 0.1 * v
                two[k] = 0.99 * two[k] + 0.01 * v * v
                net[k] -= (step * (one[k] / (1 - 0.9 ** t)) / (np.sqrt(two[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return net


def train(encoded: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """The network after ``rounds`` passes over all documents. In a pass each task counts every (left, word, right)
    of its documents, trains the current network on those counts, and returns its weights times its words; the next
    network is their mean over all words. Sums run in ``SUMMERS`` tasks, one network a task at a time, and the driver
    gets one network from each of those."""
    net = start(classes)
    names, shapes = list(net), {k: v.shape for k, v in net.items()}

    def learn(current: bytes):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts = np.zeros(classes ** 3, np.int32)
            for batch in batches:
                left, word, right = windows(list(batch["codes"]))
                np.add.at(counts, (left * classes + word) * classes + right, 1)
            total = int(counts.sum(dtype=np.int64))
            if total:
                after = trained(unpacked(current), counts.reshape(classes, classes, classes), epochs)
                yield pd.DataFrame({"n": [total], "weights": [packed(after, total)]})
        return run

    def packed(net: dict[str, np.ndarray], times: float = 1) -> bytes:
        return np.concatenate([net[k].ravel() for k in names]).astype(np.float64).__mul__(times).tobytes()

    def unpacked(data: bytes) -> dict[str, np.ndarray]:
        flat, out = np.frombuffer(data), {}
        for k in names:
            size = int(np.prod(shapes[k]))
            out[k], flat = flat[:size].reshape(shapes[k]).astype(np.float32), flat[size:]
        return out

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for batch in batches:
            for k, w in zip(batch["n"], batch["weights"], strict=True):
                n, total = n + k, np.frombuffer(w) + (0 if total is None else total)
        if n:
            yield pd.DataFrame({"n": [n], "weights": [total.tobytes()]})

    schema = "n long, weights binary"
    for _ in range(rounds):
        sums = encoded.select("codes").mapInPandas(learn(packed(net)), schema).repartition(SUMMERS).mapInPandas(add, schema).collect()
        if sums:
            total = sum(r["n"] for r in sums)
            net = unpacked((sum(np.frombuffer(r["weights"]) for r in sums) / total).tobytes())
    return net


def score(encoded: DataFrame, net: dict[str, np.ndarray], classes: int = CLASSES, id_col: str = "doc_id", shares: Shares | None = None) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_prob, perplexity``: the sum over all words of the log probability
    of each, given the words on both sides. A text without words, or null, has sum 0 and null mean and perplexity.

    Without ``shares`` the probability is that of the word's class. With them, and ``encode_words``, it is the word's
    own: that of its class times its share of the class. A word that was not counted has the share of ``UNSEEN`` occurrences."""
    totals = np.zeros(classes, np.float32) if shares is None else shares.totals.astype(np.float32)
    shared = encoded.sparkSession.sparkContext.broadcast(net)  # of fixed size
    names = ["id"] if shares is None else ["row", "id", "carried"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared.value
        table = np.zeros((classes * classes, classes), np.float32)  # filled as contexts turn up
        done = np.zeros(classes * classes, bool)
        for batch in batches:
            codes = list(batch["codes"])
            sizes = np.fromiter(map(len, codes), np.int64, len(codes))
            left, word, right = windows(codes)
            context = left * classes + right
            met = np.zeros(classes * classes, bool)
            met[context] = True
            new = np.flatnonzero(met & ~done)
            for at in range(0, len(new), CHUNK):
                part = new[at:at + CHUNK]
                table[part] = log_probabilities(net, part // classes, part % classes) - totals
            done[new] = True
            upto = np.r_[0.0, np.cumsum(table[context, word], dtype=np.float64)]
            ends = np.cumsum(sizes)
            yield pd.DataFrame({**{k: batch[k].astype("Int64") if k == "id" else batch[k] for k in names},
                                "n_tokens": sizes, "log_likelihood": upto[ends] - upto[ends - sizes]})

    kinds = {"row": "long", "id": "long", "carried": "double"}
    scored = encoded.select(*names, "codes").mapInPandas(run, ", ".join([f"{k} {kinds[k]}" for k in names] + ["n_tokens long", "log_likelihood double"]))
    if shares is not None:
        rare = (encoded.select("row", F.explode("rare").alias("word")).join(shares.counts, "word", "left")
                .groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(UNSEEN)))).alias("rare")))
        scored = (scored.join(rare, "row", "left")
                  .withColumn("log_likelihood", F.col("log_likelihood") + F.col("carried") + F.coalesce("rare", F.lit(0.0))))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.select(F.col("id").alias(id_col), "n_tokens", "log_likelihood", mean.alias("mean_log_prob"), F.exp(-mean).alias("perplexity"))


def score_documents(docs: DataFrame) -> DataFrame:
    """Vocabulary, network and the words' shares of their classes from all documents, then every document's score, one
    row for each row. The numbers of all words and the classes of the documents' words, a byte a word, are written
    once, since they are read several times."""
    counts = cut_lineage(word_counts(docs))
    known = most_frequent(counts)
    shares = shares_of(counts, known)
    encoded = cut_lineage(encode_words(docs, known, shares))
    return score(encoded, train(encoded), shares=shares)
