"""Byte-level BPE with a public vocabulary of ranks; runs in Python workers, one encoder for each worker.

A text is cut where the vocabulary's pattern cuts it whatever lies around (before the last white space ahead of other
text), so equal pieces always have equal ids and are looked up in a bounded memory of pieces; pieces not held there are
cut by the pattern, and words not held are merged. Merging keeps a segment tree over the ranks of adjacent pairs: its
root is the lowest rank, leftmost first; a merge changes two pairs and so two paths to the root. A word of n bytes takes
O(n log n), however long it is. Words of few bytes are merged in a plain list of ranks, which is quicker there.
"""

from __future__ import annotations

import base64
import os
import re
from array import array

import numpy as np
import regex

#: The pattern that comes with the vocabulary of ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where vocabulary files lie unless a path is given.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Entries after which a memory is emptied; and bytes of the longest piece or word held.
HELD, HELD_BYTES = 400_000, 64
#: Bytes of a word from which the tree is quicker than a search through the list.
FEW = 96

#: White space of the pattern: Python's, but for the four separators of ASCII. A piece is other text with the white space
#: just before it, or a run of white space up to there.
SPACE, OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
pieces_of = re.compile(f"{SPACE}?{OTHER}+|{SPACE}+(?={SPACE}{OTHER})|{SPACE}+").findall


class Merger:
    """Merges the bytes of one word. ranks: the id of each token's bytes, lower merges first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __call__(self, word: bytes) -> list[int]:
        ranks, n = self.ranks, len(word)
        if n < 2:
            return [ranks[word]] if n else []
        if n < FEW:
            return self._few(word)
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        none = 1 << 62
        get = ranks.get
        ends = list(range(1, n + 1))  # of the token that begins at each place
        prev = list(range(-1, n - 1))
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = get(word[i : i + 2])
            if r is not None:
                tree[size + i] = r << 32 | i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    return
                tree[k] = low
                k >>= 1

        while (root := tree[1]) != none:
            i = root & 0xFFFFFFFF
            j = ends[i]  # the right token of the pair, which goes
            e = ends[i] = ends[j]
            right = None if e == n else get(word[i : ends[e]])
            put(i, none if right is None else right << 32 | i)
            if j < n - 1:
                put(j, none)
            if e < n:
                prev[e] = i
            if (p := prev[i]) >= 0:
                left = get(word[p:e])
                put(p, none if left is None else left << 32 | p)
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : ends[i]]])
            i = ends[i]
        return out

    def _few(self, word: bytes) -> list[int]:
        ranks, none = self.ranks, 1 << 62
        get, at = ranks.get, list(range(len(word) + 1))
        pairs = [get(word[i : i + 2], none) for i in range(len(word) - 1)]
        while pairs and (low := min(pairs)) != none:
            i = pairs.index(low)
            del at[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(word[at[i] : at[i + 2]], none)
            if i:
                pairs[i - 1] = get(word[at[i - 1] : at[i + 1]], none)
        return [ranks[word[a:b]] for a, b in zip(at, at[1:])]


class _Pieces(dict):
    def __init__(self, encoder: "Encoder"):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.merged(piece)
        if len(piece) <= HELD_BYTES:
            if len(self) >= HELD:
                self.clear()
            self[piece] = ids
        return ids


class _Sizes(dict):
    """Of a piece: tokens << 18 | bytes << 9 | characters; 0 of one that is too long to be held."""

    def __init__(self, encoder: "Encoder"):
        self.encoder = encoder

    def __missing__(self, piece: str) -> int:
        if len(piece) > HELD_BYTES:
            return 0
        if len(self) >= HELD:
            self.clear()
        size = self[piece] = len(self.encoder.merged(piece)) // 4 << 18 | len(piece.encode("utf-8", "surrogatepass")) << 9 | len(piece)
        return size


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.merge, self.find, self.words = Merger(self.ranks), regex.compile(PATTERN).findall, {}
        self.pieces, self.sizes = _Pieces(self), _Sizes(self)
        self.longest = max(map(len, self.ranks))  # bytes of a token
        self.lengths = np.zeros(max(self.ranks.values()) + 1, np.int64)
        for token, i in self.ranks.items():
            self.lengths[i] = len(token)

    def merged(self, piece: str) -> bytes:
        """Ids of a piece as 32-bit integers in this machine's order."""
        ids, words = [], self.words
        for w in self.find(piece):
            got = words.get(w)
            if got is None:
                got = self.merge(w.encode("utf-8", "surrogatepass"))
                if len(w) <= HELD_BYTES:
                    if len(words) >= HELD:
                        words.clear()
                    words[w] = got
            ids += got
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, pieces_of(text)))

    def size(self, text: str) -> int:
        return len(self.encode(text)) // 4


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str = "byte_bpe_50k") -> Encoder:
    """This process's encoder for a vocabulary: a name among TOKENIZERS, or the path of a file of ranks."""
    path = vocabulary if os.sep in vocabulary else os.path.join(TOKENIZERS, f"{vocabulary}.tiktoken")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
