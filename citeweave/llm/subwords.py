"""Texts as ids of a public byte-level BPE vocabulary; the file's path is a parameter."""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np
import tiktoken

VOCABULARY = os.environ.get("CORPUS_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the pattern that parts text before the merges of these vocabularies apply.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY_SIZE = 50_256
END_OF_TEXT = 50_256  # free in the file, so an id below 2^16 remains for the end of a text


@cache
def encoder(path: str = VOCABULARY, merges: int | None = None) -> tiktoken.Encoding:
    """Loaded once per worker process; with `merges`, only the single bytes and so many of the first merges."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if merges is not None:
        ranks = {token: rank for token, rank in ranks.items() if rank < 256 + merges}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, path: str = VOCABULARY, merges: int | None = None) -> np.ndarray:
    """Ids as 16-bit numbers; text that looks like a special token is ordinary text."""
    return np.array(encoder(path, merges).encode_ordinary(text), np.uint16)
