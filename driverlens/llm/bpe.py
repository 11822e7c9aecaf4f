"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern and every piece is encoded on its own. Inside a piece
an Aho-Corasick pass (bytes mapped to Latin-1 characters) gives the longest token at every
offset. The encoder takes longest matches, falls back to shorter prefixes where two neighbours
could not stand side by side after the merges, and steps back from offsets that turn out to be
dead ends. No offset is left twice, so a piece takes time linear in its length, and the result
is what the merges in rank order give.

Null text counts as empty: no ids, no bytes. Rows are independent, so repeated rows, ties and
empty tables need nothing special. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import base64
from itertools import chain, islice, pairwise

import ahocorasick
import regex
from pyspark.sql import DataFrame

from driverlens.llm.common import with_columns

CACHED_PIECES = 1 << 19  # distinct pieces remembered per task, short ones only
CACHED_CHARS = 24
CACHED_PAIRS = 1 << 20
BLOCK = 1 << 16  # pieces handled at a time, so that a long text takes bounded memory beside its ids


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of "base64 rank" lines."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * len(pairs)
    for word, rank in pairs:
        tokens[int(rank)] = base64.b64decode(word)
    return tokens


def merge_halves(tokens: list[bytes]) -> list[tuple[int, int]]:
    """The two tokens whose merge makes each token; a token that no merge makes is its own half."""
    rank = {token: i for i, token in enumerate(tokens)}
    halves = []
    for i, token in enumerate(tokens):
        parts = [bytes([b]) for b in token]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda k: rank.get(parts[k] + parts[k + 1], i))
            if rank.get(parts[best] + parts[best + 1], i) >= i:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        halves.append((rank[parts[0]], rank[parts[1]]) if len(parts) == 2 else (i, i))
    return halves


class Encoder:
    """Exact BPE over one vocabulary."""

    def __init__(self, tokens: list[bytes], halves: list[tuple[int, int]], pattern: str):
        self.tokens, self.halves = tokens, halves
        self.rank = {token: i for i, token in enumerate(tokens)}
        self.merged = {pair: i for i, pair in enumerate(halves) if pair[0] != i}
        self.lengths = [len(token) for token in tokens]
        self.shorter = [next((r for n in range(len(t) - 1, 0, -1) if (r := self.rank.get(t[:n])) is not None), -1) for t in tokens]
        self.reach = max(self.lengths, default=1)
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(tokens):
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.compatible = _Pairs(self)
        self.pieces = _Pieces(self)

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side, instead of merging across the seam."""
        # Undo the merges next to the seam, latest first. The pair must not have a merge
        # that comes before the one just undone.
        before = len(self.tokens)
        while True:
            if self.merged.get((left, right), before) < before:
                return False
            inner_left, inner_right = self.halves[left][1], self.halves[right][0]
            can_left, can_right = inner_left != left, inner_right != right
            if can_left and (left > right or not can_right):
                before, left = left, inner_left
            elif can_right:
                before, right = right + 1, inner_right
            else:
                return True

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.rank.get(piece)
        if whole is not None:
            return (whole,)
        spelled = piece.decode("latin-1")
        longest = self.automaton.iter_long
        out = [token for _, token in longest(spelled)]
        compatible = self.compatible
        for seam, pair in enumerate(pairwise(out), 1):
            if not compatible[pair]:
                break
        else:
            return tuple(out)  # every longest match holds
        n, lengths, shorter = len(piece), self.lengths, self.shorter
        token = out[seam]
        del out[seam:]
        at = sum(map(lengths.__getitem__, out))
        open_end = bytearray(b"\x01") * (n + 1)
        while at < n:
            if out:
                left = out[-1]
                while token >= 0 and not (open_end[at + lengths[token]] and compatible[left, token]):
                    token = shorter[token]
            else:
                while token >= 0 and not open_end[at + lengths[token]]:
                    token = shorter[token]
            if token >= 0:
                out.append(token)
                at += lengths[token]
                token = next(longest(spelled[at : at + self.reach]))[1] if at < n else -1
            elif out:
                open_end[at] = 0
                token = out.pop()
                at -= lengths[token]
            else:
                raise ValueError("the vocabulary can't spell these bytes")
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if len(text) < BLOCK:
            return list(chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(text))))
        ids: list[int] = []
        found = (match.group() for match in self.pattern.finditer(text))
        while block := list(islice(found, BLOCK)):
            ids.extend(chain.from_iterable(map(self.pieces.__getitem__, block)))
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Pairs(dict):
    """Compatibility of adjacent tokens, remembered up to a bound."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= CACHED_PAIRS:
            self.clear()
        known = self[pair] = self.encoder.side_by_side(*pair)
        return known


class _Pieces(dict):
    """Encoded pieces; short ones are remembered, up to a bound."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.encoder.encode_piece(piece.encode("utf-8"))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None, drop: tuple[str, ...] = ()
) -> DataFrame:
    """Add the token ids of a text column and, if named, the bytes that the ids decode to.

    The vocabulary file is read once, on the driver; its size is the vocabulary's. ``ids`` is an
    array of ints, empty for null or empty text.
    """
    tokens = read_ranks(path)
    vocabulary = docs.sparkSession.sparkContext.broadcast((tokens, merge_halves(tokens)))
    added = f"`{ids}` ARRAY<INT>" + (f", `{decoded}` BINARY" if decoded else "")

    def make():
        encoder = Encoder(*vocabulary.value, pattern)

        def row(value):
            found = encoder.encode(value or "")
            return (found, encoder.decode(found)) if decoded else (found,)

        return row

    return with_columns(docs, [text], added, make, drop)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes of an array of ids; null ids give no bytes."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        tokens = vocabulary.value
        return lambda value: (b"".join(map(tokens.__getitem__, value or ())),)

    return with_columns(df, [ids], f"`{decoded}` BINARY", make)
