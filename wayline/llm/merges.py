"""Byte-pair vocabularies: merge ranks, derivations of tokens and the compatibility of neighbours.

A sequence of tokens is what merging yields for its text exactly when every
token is what merging yields for its own text and every two neighbours are
compatible: merging their joined text would leave the border between them
alone. So each prefix of a text has one last token, and that token can be found
from the last tokens of shorter prefixes.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

NEVER = 1 << 60


class Merges:
    """`pieces`: id to symbol string, None where the id is never merged to; `pairs`: (left id, right id) to rank."""

    def __init__(self, pieces: list[str | None], pairs: dict[tuple[int, int], int], limit: int = 400_000):
        self.pieces, self._pairs, self._limit = pieces, pairs, limit
        self.ids = {p: i for i, p in enumerate(pieces) if p is not None}
        self.longest = max(map(len, self.ids), default=0)
        self._right: dict[int, tuple] = {}
        self._left: dict[int, tuple] = {}
        self.known: dict[int, bool] = {}

    def merge(self, text: str) -> list[tuple[int, int, tuple]]:
        """Plain merging of a short text: (id, rank of its last merge, its two parts) of each symbol left."""
        row = [(self.ids[c], -1, ()) for c in text]
        while len(row) > 1:
            rank, at = min((self._pairs.get((row[k][0], row[k + 1][0]), NEVER), k) for k in range(len(row) - 1))
            if rank == NEVER:
                break
            joined = self.ids[self.pieces[row[at][0]] + self.pieces[row[at + 1][0]]]
            row[at : at + 2] = [(joined, rank, (row[at], row[at + 1]))]
        return row

    def _edges(self, token: int) -> None:
        """The symbols at the right and at the left end of a token while it is merged, with the rank that ends each."""
        row = self.merge(self.pieces[token])
        if len(row) != 1 or row[0][0] != token:
            self._right[token] = self._left[token] = ()
            return
        for side, store in ((1, self._right), (0, self._left)):
            symbols, ends, at = [], [NEVER], row[0]
            while True:
                symbols.append(at[0])
                if not at[2]:
                    break
                ends.append(at[1])
                at = at[2][side]
            store[token] = tuple(zip(reversed(symbols), reversed(ends)))

    def whole(self, token: int) -> bool:
        """Whether merging the token's own text gives the token."""
        if token not in self._right:
            self._edges(token)
        return bool(self._right[token])

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        if key not in self.known:
            if len(self.known) >= self._limit:
                self.known.clear()
            self.known[key] = self._compare(left, right)
        return self.known[key]

    def _compare(self, left: int, right: int) -> bool:
        """Replay both derivations in order of rank; at no time may the two symbols at the border merge.

        Equal ranks are merged from the left: first inside `left`, then at the border, then inside `right`.
        """
        if not (self.whole(left) and self.whole(right)):
            return False
        ends, starts, pairs = self._right[left], self._left[right], self._pairs
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = ends[i], starts[j]
            rank = pairs.get((x, y), NEVER)
            if rank < x_ends and rank <= y_ends:
                return False
            if x_ends == NEVER and y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1


# Byte-level files -----------------------------------------------------------

def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def read_byte_level(content: bytes) -> tuple[Merges, dict[str, int]]:
    """Merges of a byte-level tokenizer file and its special strings with their ids."""
    spec = json.loads(content)
    vocab = spec["model"]["vocab"]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    pieces: list[str | None] = [None] * (1 + max([*vocab.values(), *added.values()]))
    for piece, i in vocab.items():
        if piece not in added:
            pieces[i] = piece
    pairs = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        pairs.setdefault((vocab[a], vocab[b]), rank)
    return Merges(pieces, pairs), added


# Scored piece files ---------------------------------------------------------

def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbered fields of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _number(data, at)
        else:
            length = {1: 8, 5: 4}.get(kind)
            if length is None:
                length, at = _number(data, at)
            value = data[at : at + length]
            at += length
        yield key >> 3, value


def read_scored_pieces(content: bytes) -> Merges:
    """Merges of a scored piece model: any two pieces merge whose joined text is a piece, best score first.

    Only models with plain text, a blank put in front, kept blanks and byte
    fallback are taken; others raise ValueError.
    """
    pieces: list[str | None] = []
    scores: list[float] = []
    rules: dict[int, int | bytes] = {}
    trainer: dict[int, int | bytes] = {}
    for field, value in _fields(content):
        if field == 1:
            parts = dict(_fields(value))
            pieces.append(parts[1].decode() if parts.get(3, 1) == 1 else None)
            scores.append(struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0)
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            rules = dict(_fields(value))
    plain = rules.get(1) == b"identity" and rules.get(3, 1) == 1 and rules.get(4, 1) == 0 and rules.get(5, 1) == 1
    if not plain or trainer.get(3) != 2 or trainer.get(35) != 1:
        raise ValueError("only merged pieces over plain text with byte fallback are supported")
    order = {s: k for k, s in enumerate(sorted({s for p, s in zip(pieces, scores) if p is not None}, reverse=True))}
    ids = {p: i for i, p in enumerate(pieces) if p is not None}
    pairs = {}
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
            if a is not None and b is not None:
                pairs[a, b] = order[scores[i]]
    return Merges(pieces, pairs)
