"""Byte-level BPE ids of whole columns of texts, by a public vocabulary file."""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from .words import pieces

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own}
    for i, b in enumerate(b for b in range(256) if b not in own):
        letters[chr(256 + i)] = b
    return letters


class Encoder:
    """Ids as ``tokenizers`` gives them with ``add_special_tokens=False``.

    Texts are encoded by a faster engine over the same vocabulary file; those that hold a special token's string go to the
    library itself, which reads it as that token.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [t["content"] for t in described.get("added_tokens", [])]
        letters = _bytes_of_letters()
        ranks = {bytes(letters[c] for c in word): i for word, i in described["model"]["vocab"].items() if word not in self.special}
        self.engine = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.engine.encode_ordinary(text)

    def encode(self, texts: list[str], end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """All ids with ``end`` behind each text, and where those of each text begin; one more offset than texts."""
        flat, first = array("I"), [0]
        for text in texts:
            flat.extend(self.ids(text))
            flat.extend(end)
            first.append(len(flat))
        return np.frombuffer(flat, np.uint32) if flat else np.zeros(0, np.uint32), np.array(first)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_end(column: pa.Array, path: str, end: int = 0):
    """For slices of a column of texts: position of the slice, ids with ``end`` behind each text, offsets. Null: empty."""
    for low, part in pieces(column, 1 << 20):
        ids, first = encoder(path).encode([t or "" for t in part.to_pylist()], [end])
        yield low, ids.astype("<u4"), first
