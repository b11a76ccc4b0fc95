"""Encoders made of public vocabulary files; a path is a parameter and the file is read in each worker."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np


def vocabulary_path(name: str) -> str:
    """Where an executor has a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _ranked(ranks: str, spec: str):
    import public_tokenizers
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary_path(ranks), "rb"))}
    special = {t["content"]: t["id"] for t in json.load(open(vocabulary_path(spec)))["added_tokens"]}
    return tiktoken.Encoding(spec, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=special)


@lru_cache(maxsize=4)
def _library(spec: str):
    import tokenizers

    held = tokenizers.Tokenizer.from_file(vocabulary_path(spec))
    held.no_truncation()
    held.no_padding()
    return held


def byte_bpe(ranks: str = "byte_bpe_50k.tiktoken", spec: str = "byte_bpe_50k.json") -> Callable[[], Callable[[str], np.ndarray]]:
    """Ids as the tokenizers library gives them for ``spec``, special strings in texts being special ids.

    Texts of any length are encoded whole. A run of some 700,000 white-space characters or more is beyond the
    fast encoder's pattern search; such a text goes through the library itself.
    """

    def encode(text: str) -> np.ndarray:
        try:
            return _ranked(ranks, spec).encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(_library(spec).encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return lambda: encode
