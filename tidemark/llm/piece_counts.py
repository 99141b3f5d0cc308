"""Token counts for the other tokenizer files: BPE with word ends (.json) and SentencePiece BPE (.model).

Merges are made as token_counts makes them, with a heap and a linked list and
no ids; normalising and splitting are the file's own, by its library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa

#: Words up to this many characters are looked up in a cache of CACHED results.
SHORT, CACHED = 100, 50_000
SPACE = "▁"  # stands for a space in SentencePiece


def left_after_merging(symbols: list[str], order) -> list[str]:
    """The symbols left when again and again the pair with the lowest order merges, from the left among equals. order(left, right): of a pair, None if it never merges."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := order(symbols[i], symbols[i + 1])) is not None]
    heapify(heap)
    while heap:
        _, i, a, b = heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue  # one of the two has merged meanwhile
        symbols[i], symbols[j] = a + b, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := order(symbols[i], symbols[k])) is not None:
                heappush(heap, (r, i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (r := order(symbols[h], symbols[i])) is not None:
            heappush(heap, (r, h, symbols[h], symbols[i]))
    return [s for s in symbols if s]


class Pieces:
    """apply(texts): the number of tokens of each text of an Arrow array; null counts as empty."""

    def __init__(self):
        self.short = lru_cache(CACHED)(self.word)

    def word(self, w: str) -> int:
        raise NotImplementedError

    def words(self, text: str) -> Iterator[str | None]:
        """What merges alone; None stands for a special token."""
        raise NotImplementedError

    def apply(self, texts: pa.Array) -> pa.Array:
        def count(w):
            return 1 if w is None else self.short(w) if len(w) <= SHORT else self.word(w)

        return pa.array([sum(map(count, self.words(x.as_py() or ""))) for x in texts], pa.int64())


class WordEnds(Pieces):
    """BPE whose last symbol of a word carries a suffix."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        bad = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        tokens = spec.get("added_tokens", [])
        odd = [t["content"] for t in tokens if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]]
        if model["type"] != "BPE" or bad or odd or not spec.get("pre_tokenizer"):
            raise ValueError(f"{path}: a kind of tokenizer that isn't done: {model['type']} {bad} {odd}")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.vocabulary = frozenset(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        names = sorted((t["content"] for t in tokens), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None

    def plain(self, text: str) -> Iterator[str]:
        if text:
            text = self.normalizer.normalize_str(text) if self.normalizer else text
            yield from (w for w, _ in self.splitter.pre_tokenize_str(text))

    def words(self, text: str) -> Iterator[str | None]:
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self.plain(text[at : m.start()])
            yield None
            at = m.end()
        yield from self.plain(text[at:])

    def word(self, w: str) -> int:
        symbols = [*w[:-1], w[-1] + self.suffix]
        left = left_after_merging(symbols, lambda a, b: self.rank.get((a, b)))
        return sum(s in self.vocabulary for s in left)  # without an unknown token, what isn't there is left out


class SentencePieces(Pieces):
    """SentencePiece BPE: two neighbours merge if both together are a piece, by score; characters that are no piece count by bytes."""

    def __init__(self, path: str):
        super().__init__()
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        t, n = model.trainer_spec, model.normalizer_spec
        kinds = proto.ModelProto.SentencePiece
        if t.model_type != t.BPE or t.treat_whitespace_as_suffix or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError(f"{path}: a kind of SentencePiece model that isn't done")
        if not t.byte_fallback:
            raise ValueError(f"{path}: no byte fallback")
        self.prefix = SPACE if n.add_dummy_prefix else ""
        self.order = {p.piece: -p.score for p in model.pieces if p.type == kinds.NORMAL}
        # a space that only begins pieces always begins a new one behind other characters
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+") if all(SPACE not in p.lstrip(SPACE) for p in self.order) else re.compile("(?s:.+)")

    def words(self, text: str) -> Iterator[str]:
        if text:
            yield from (m[0] for m in self.cut.finditer(self.prefix + text.replace(" ", SPACE)))

    def word(self, w: str) -> int:
        left = left_after_merging(list(w), lambda a, b: self.order.get(a + b))
        return sum(1 if s in self.order else len(s.encode()) for s in left)
