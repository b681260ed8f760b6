"""Public vocabularies in tasks: loaded once a worker, by name or path."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

#: Below this code point all versions of the character tables agree on what is a letter, digit or space.
SETTLED = 0x250
ODD = re.compile(f"[^\x00-{chr(SETTLED - 1)}]")


def located(vocabulary: str) -> str:
    """A path as it is; a bare name is one of the installed public vocabularies."""
    if os.path.dirname(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task a core
    out = Tokenizer.from_file(located(vocabulary))
    out.no_truncation()
    out.no_padding()
    return out


@lru_cache(maxsize=4)
def _ranked(vocabulary: str):
    """The same byte-level vocabulary for the faster library, if it lies beside the file; else None."""
    import public_tokenizers
    import tiktoken

    ranks = os.path.splitext(located(vocabulary))[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return None
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {t.content: i for i, t in tokenizer(vocabulary).get_added_tokens_decoder().items()}
    return tiktoken.Encoding("beside", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)


def forget() -> None:
    """Drop the loaded vocabularies, which take a hundred megabytes and more: a worker lives on after its task."""
    tokenizer.cache_clear()
    _ranked.cache_clear()


class Encoder:
    """Ids of whole texts under a byte-level vocabulary, as the tokenizers library gives them without special tokens
    added. Texts of settled characters take a faster library with the same merges and pattern; others take the library
    itself, since the two may know different versions of the character tables."""

    def __init__(self, vocabulary: str):
        self.plain, self.fast = tokenizer(vocabulary), _ranked(vocabulary)

    def ids(self, text: str) -> list[int]:
        if self.fast is None or ODD.search(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")
