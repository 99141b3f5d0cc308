"""Byte-level BPE tables and the split of texts into chunks that merge alone.

The pre-tokenizer of byte-level BPE always starts a piece at a single space or
line feed, unless it stands inside a longer run of white space. So a text
without runs of three white-space characters, and without two at its end, can
be encoded chunk by chunk, and equal chunks have equal ids. Other texts, and
those with a special token's string, take the whole-text path.
"""

from __future__ import annotations

import json
import re
from functools import cached_property, lru_cache

import numpy as np

#: Three white-space characters in a row, or two at the end; the class holds all that the tokenizers' \\s holds and more, so this errs to the safe side.
UNSAFE = r"[\t-\r\x{1c}-\x{20}\x{85}\pZ]{2}(?:[\t-\r\x{1c}-\x{20}\x{85}\pZ]|\z)"

#: Punctuation that, after an ASCII letter or digit and at the end of a chunk, is a piece of its own.
TAIL = ".,;:!?"

#: The split pattern of byte-level BPE, as public_tokenizers states it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tables:
    """Merges of a byte-level BPE file as arrays and dictionaries."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path}: not a byte-level BPE without normalizer")
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(symbols[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.byte_id = np.zeros(256, np.uint32)
        for c, b in symbols.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.uint64)
        right = np.array([vocab[b] for _, b in pairs], np.uint64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        keys = left << np.uint64(32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.merged = keys[order], np.arange(len(keys), dtype=np.int64)[order], merged[order]
        self.by_rank = merged  # id of the merge of each rank
        # a merge uses only bytes and results of earlier merges; then all places of the lowest pair can merge in one round
        made = {int(x): -1 for x in self.byte_id}
        for i, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), merged.tolist(), strict=True)):
            if made.get(a, i) >= i or made.get(b, i) >= i:
                raise ValueError(f"{path}: merge {i} uses a later token")
            made.setdefault(c, i)
        self.pairs = left.astype(np.uint32), right.astype(np.uint32)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None


    @cached_property
    def pair_rank(self) -> dict[tuple[int, int], int]:
        """The rank of each pair, for those who look pairs up one by one."""
        return {p: i for i, p in enumerate(zip(*(x.tolist() for x in self.pairs), strict=True))}


@lru_cache(maxsize=4)
def tables(path: str) -> Tables:
    return Tables(path)


@lru_cache(maxsize=1)
def splitter():
    import regex

    return regex.compile(PATTERN)


def chunk_text(chunk: str) -> str:
    """What a chunk stands for: itself if it begins with a line feed, otherwise itself with a space before it."""
    return chunk if chunk.startswith("\n") else " " + chunk
