"""Public byte-level BPE vocabularies, loaded once per Python process."""

from __future__ import annotations

import json
from functools import lru_cache

import public_tokenizers
import regex
import tiktoken

END_OF_TEXT = "<|endoftext|>"


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=None)
def unicode_to_byte() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE files use for bytes, by their published rule."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=None)
def load(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file as an encoder that gives the same ids.

    In such files an id is the rank of the merge that makes it, so the vocabulary alone fixes
    the merges. Added special tokens keep their ids; their strings in a text become that id,
    as the library does by default.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    to_byte = unicode_to_byte()
    ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=None)
def splitter() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


def encode(path: str, text: str | None):
    """Token ids of a whole text (null: empty) as a uint32 array."""
    return load(path).encode_to_numpy(text or "", allowed_special="all")
