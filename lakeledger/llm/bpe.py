"""BPE encoding and decoding; long text without white space is encoded as a tree of halves."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from unicodedata import category

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.memory import released
from lakeledger.llm.vocabulary import forget, tokenizer

LEAF = 4096  # characters that are encoded in one go
AGREE = 2  # tokens that a window and its neighbour must share at each end
KEPT = 400_000  # pre-tokens and short runs whose ids a worker remembers
# How the public vocabulary with word ends prepares texts, as its file says.
PREPARES = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pre_tokenizer": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
#: Characters that are alone in normal form, have one lower case among them, and whose kind no version of the tables disputes.
PLAIN = [c for c in map(chr, range(0x180)) if c != "\u0130"]
SPACES = "\t-\r \x85\xa0"
WHITE = re.compile("[\x20\x09-\x0d]+")

Tokens = tuple[list[int], list[tuple[int, int]]]  # ids, and the characters each stands for


def clings(c: str) -> bool:
    """Whether normalisation may join a character with the one before it: marks and the later letters of a syllable block."""
    return c >= "\u0300" and (category(c)[0] == "M" or "\u1160" <= c <= "\u11ff")


def of_kind(kind: str) -> str:
    return "".join(re.escape(c) for c in PLAIN if category(c)[0] == kind)


UNUSUAL = re.compile("[^" + "".join(map(re.escape, PLAIN)) + "]")
PARTS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{of_kind('L')}]+|[{of_kind('N')}]|[^{of_kind('L')}{of_kind('N')}{SPACES}]+")


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(others)) for b in range(256)]


class PreTokens(dict):
    """(number of ids, ids as text, what they decode to) of a pre-token, encoded when it is first met."""

    def __init__(self, encoder: TreeEncoder):
        super().__init__()
        self.encoder, self.letters, self.model = encoder, byte_letters(), encoder.lib.model

    def __missing__(self, part: str) -> tuple[int, str, str]:
        if len(self) >= KEPT:
            self.clear()
        if len(part) > self.encoder.leaf:
            return self.encoder.entry(self.encoder.tree(part))
        ids = [t.id for t in self.model.tokenize("".join(self.letters[b] for b in part.encode()))]
        self[part] = out = self.encoder.entry(ids)
        return out


class TreeEncoder:
    """Encodes and decodes whole texts as the tokenizers library does, without special tokens added.

    A text is cut at special tokens that stand in it and at ASCII white space, where no pre-token of the vocabulary
    may reach across (``white`` says whether that holds; without it a text is one run). Runs up to ``leaf`` characters are encoded
    whole, and short ones remembered. Texts of ``PLAIN`` characters are cut further, into the vocabulary's pre-tokens,
    which are remembered by themselves. A longer run becomes a tree: its leaves are encoded in one batch, and neighbours joined
    bottom up. At a join, a window around it is encoded again, and grown to twice as many tokens on the side that fails, until its first and
    last tokens are those the two sides had there, or it reaches their ends. A token sequence is the encoding of its text if every two
    neighbours are, so agreement of whole tokens at both ends settles the join.
    """

    def __init__(self, vocabulary: str, leaf: int = LEAF, white: bool = True):
        self.lib, self.leaf, self.white, self.known = tokenizer(vocabulary), leaf, white, {}
        said = json.loads(self.lib.to_str())
        first = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        as_known = ((said.get("normalizer") or {}).get("normalizers") == PREPARES["normalizer"]
                    and first.get("pattern") == {"Regex": PREPARES["pre_tokenizer"]} and self.lib.decoder is None)
        self.parts = PreTokens(self) if as_known else None
        self.special = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def cut(self, text: str) -> list[tuple[str, bool]]:
        """The text between special tokens, and those."""
        return [(p, bool(k % 2)) for k, p in enumerate(self.marks.split(text) if self.marks else [text]) if p]

    def runs(self, text: str) -> list[str]:
        return [r for part, mark in self.cut(text) for r in ([part] if mark else WHITE.split(part) if self.white else [part]) if r]

    def remember(self, runs: set[str]) -> None:
        """Encode what isn't known yet: short runs as one batch, long ones by their trees."""
        new = [r for r in runs if r not in self.known]
        if len(self.known) + len(new) > KEPT:
            self.known = {}
            new = list(runs)
        short = [r for r in new if len(r) <= self.leaf and r not in self.special]
        self.known |= {r: self.entry([self.special[r]]) for r in new if r in self.special}
        for r, e in zip(short, self.lib.encode_batch_fast(short, add_special_tokens=False), strict=True):
            self.known[r] = self.entry(e.ids)

    def entry(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def entries(self, texts: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """Of each text: of each part the number of ids, the ids as text, and what they decode to."""
        at = 0
        while at < len(texts):
            cut, upto, size = [], at, 0
            while upto < len(texts) and (size < 4 << 20 or upto == at):  # characters cut at once
                plain = self.parts is not None and not UNUSUAL.search(texts[upto])
                cut.append(None if plain else self.runs(texts[upto]))
                size += len(texts[upto])
                upto += 1
            self.remember({r for c in cut if c for r in c if len(r) <= self.leaf})
            for text, c in zip(texts[at:upto], cut, strict=True):
                if c is not None:
                    yield [self.known[r] if len(r) <= self.leaf else self.entry(self.tree(r)) for r in c]
                    continue
                out: list[tuple[int, str, str]] = []
                for part, mark in self.cut(text):
                    out += [self.entry([self.special[part]])] if mark else map(self.parts.__getitem__, PARTS.findall(part.lower()))
                yield out
            at = upto

    def ids(self, text: str) -> list[int]:
        entries = next(self.entries([text]))
        return [int(x) for _, ids, _ in entries for x in ids.split()]

    def decode(self, ids: list[int]) -> str:
        if len(ids) == 1 and self.lib.decoder is None:
            return self.lib.id_to_token(ids[0])
        return self.lib.decode(ids, skip_special_tokens=False)

    def decoded(self, entries: list[tuple[int, str, str]]) -> str:
        """What all ids decode to. A vocabulary without a decoder joins its tokens by spaces, so parts can be joined."""
        if self.lib.decoder is None:
            return " ".join(d for n, _, d in entries if n)
        return self.decode([int(x) for _, ids, _ in entries for x in ids.split()])

    def tree(self, run: str) -> list[int]:
        """Ids of one run by halves."""
        parts = [run]
        while len(parts[0]) > self.leaf:
            parts = [h for p in parts for h in ((p[:(len(p) + 1) // 2], p[(len(p) + 1) // 2:]) if len(p) > 1 else (p, ""))]
        tokens: list[Tokens] = [(e.ids, e.offsets) for e in self.lib.encode_batch(parts, add_special_tokens=False)]
        while len(parts) > 1:
            tokens = [self.join(parts[k] + parts[k + 1], len(parts[k]), tokens[k], tokens[k + 1]) for k in range(0, len(parts), 2)]
            parts = [parts[k] + parts[k + 1] for k in range(0, len(parts), 2)]
        return tokens[0][0]

    def join(self, text: str, middle: int, left: Tokens, right: Tokens) -> Tokens:
        a, spans_a = left
        b, spans_b = right[0], [(x + middle, y + middle) for x, y in right[1]]
        i, j = max(0, len(a) - 2 * AGREE), min(len(b), 2 * AGREE)
        while True:
            # Only between tokens that do not share a character, and not before one that normalisation may move or join.
            while 0 < i < len(a) and (spans_a[i][0] < spans_a[i - 1][1] or clings(text[spans_a[i][0]])):
                i -= 1
            while 0 < j < len(b) and (spans_b[j][0] < spans_b[j - 1][1] or clings(text[spans_b[j - 1][1]])):
                j += 1
            start, end = spans_a[i][0] if 0 < i < len(a) else 0, spans_b[j - 1][1] if 0 < j < len(b) else len(text)
            if not start:
                i = 0
            if end == len(text):
                j = len(b)
            again = self.lib.encode(text[start:end], add_special_tokens=False)
            ids, spans = again.ids, [(x + start, y + start) for x, y in again.offsets]
            ok_left = i == 0 or (ids[:AGREE] == a[i:i + AGREE] and spans[:AGREE] == spans_a[i:i + AGREE])
            ok_right = j == len(b) or (ids[-AGREE:] == b[max(j - AGREE, 0):j] and spans[-AGREE:] == spans_b[max(j - AGREE, 0):j])
            if ok_left and ok_right:
                return a[:i] + ids + b[j:], spans_a[:i] + spans + spans_b[j:]
            if not ok_left:
                i = max(0, len(a) - 2 * (len(a) - i))
            if not ok_right:
                j = min(len(b), 2 * j)


def encode_documents(docs: DataFrame, vocabulary: str, digests: bool = False, leaf: int = LEAF) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every document, or ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``vocabulary`` is a tokenizers file or the name of a public one whose pre-tokens do not hold white space. A null
    text is empty: no ids, an empty string. Rows are documents each, also where doc_id is null or repeated.
    """
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = TreeEncoder(vocabulary, leaf)
        for batch in batches:
            rows = []
            for entries in encoder.entries([t or "" for t in batch["text"]]):
                ids, text = " ".join(i for n, i, _ in entries if n), encoder.decoded(entries)
                rows.append((sum(n for n, _, _ in entries), *((sha(ids), sha(text)) if digests else ([int(x) for x in ids.split()], text))))
            out = pd.DataFrame(rows, columns=names[1:])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(released(encode, forget), schema)


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``text``, decoded from an ``ids`` column; null ids give a null text."""
    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        lib = tokenizer(vocabulary)
        return pd.Series([None if i is None else lib.decode(list(map(int, i)), skip_special_tokens=False) for i in ids])
    return encoded.withColumn("text", decode("ids"))
