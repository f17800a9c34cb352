"""Byte-level BPE vocabularies read from a tokenizer.json, and what reading one yields.

Vocabulary files are named by path and opened on each worker, once per process.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# Fixed value: the published pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself where it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in prints}
    others = [b for b in range(256) if chr(b) not in table]
    return table | {chr(256 + n): b for n, b in enumerate(others)}


@dataclass(frozen=True)
class ByteBpe:
    """tokens: bytes by id (b"" where an id is free); merges: ids (left, right, merged) by rank."""

    tokens: tuple[bytes, ...]
    byte_ids: np.ndarray
    merges: np.ndarray
    special: dict[str, int]


@lru_cache(maxsize=4)
def read_byte_bpe(path: str) -> ByteBpe:
    """Read a byte-level BPE file; a file that asks for more than this reader does raises ValueError."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, split = content["model"], content["pre_tokenizer"] or {}
    plain = (
        model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and content.get("normalizer") is None
    )
    added = content.get("added_tokens", [])
    if not plain or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"not a plain byte-level BPE file: {path}")
    raw = alphabet()
    special = {t["content"]: t["id"] for t in added}
    tokens = [b""] * (1 + max([*model["vocab"].values(), *special.values()]))
    for token, number in model["vocab"].items():
        tokens[number] = bytes(raw[c] for c in token)
    for token, number in special.items():
        tokens[number] = token.encode()
    ids = {t: n for n, t in enumerate(tokens) if t and n not in special.values()}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    sides = [(bytes(raw[c] for c in a), bytes(raw[c] for c in b)) for a, b in pairs]
    merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in sides], np.int64).reshape(-1, 3)
    return ByteBpe(tuple(tokens), np.array([ids[bytes([b])] for b in range(256)], np.int64), merges, special)


# The fast library gives up on white space of several hundred thousand characters.
LONG_RUN = 50_000
_LONG_RUN = re.compile(rf"\s{{{LONG_RUN}}}")


def encode(path: str, text: str) -> list[int]:
    """Ids of a text, as the tokenizers library gives them."""
    if len(text) >= LONG_RUN and _LONG_RUN.search(text):
        return library(path).encode(text, add_special_tokens=False).ids
    return fast_encoding(path).encode(text, allowed_special="all")


@lru_cache(maxsize=4)
def library(path: str):
    from tokenizers import Tokenizer

    read_byte_bpe(path)  # refuses files that ask for more
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=4)
def fast_encoding(path: str):
    """The same vocabulary in a library that encodes several times as fast and gives the same ids.

    It picks merges by the rank of the merged token, so the file's merges must come in
    the order of the ids they make; that is checked.
    """
    import tiktoken

    bpe = read_byte_bpe(path)
    if len(bpe.merges) > 1 and not (np.diff(bpe.merges[:, 2]) > 0).all():
        raise ValueError(f"the merges of {path} are not in the order of their ids")
    special = set(bpe.special.values())
    ranks = {t: n for n, t in enumerate(bpe.tokens) if t and n not in special}
    return tiktoken.Encoding(name=path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=bpe.special)
