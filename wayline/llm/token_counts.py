"""Token counts by a compiled finite-state transducer and a scan over state maps of text chunks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayline.llm.common import record, small_batches, two_columns
from wayline.llm.merges import Merges, read_scored_pieces

MARK = "▁"
#: Characters in a chunk; longer texts are counted in chunks that run in parallel.
CHUNK_CHARS = 1 << 14
#: States, and words, that a worker keeps; beyond that they are compiled, or counted, again when met.
MAX_STATES = 250_000
REMEMBERED = 200_000

_MAPS = "id long, row long, n_bytes long, part int, head string, open boolean, n long, state string"


class Transducer:
    """Deterministic transducer from symbols to changes of the token count, compiled as states are met.

    A state is the longest end of the text that begins some token, together
    with the last token and the relative token count of every prefix that a
    later token may still be appended to. So the state decides all that
    follows, and there are finitely many.
    """

    START = ("", (-1,), (0,))

    def __init__(self, merges: Merges):
        self.merges = merges
        self._begins = {p[:k] for p in merges.ids for k in range(1, len(p) + 1)}
        self._bigrams = {p[k : k + 2] for p in merges.ids for k in range(len(p) - 1)}
        if any(b[1] == MARK != b[0] for b in self._bigrams):
            raise ValueError("a token reaches over the start of a word")
        self._states: dict[tuple, dict] = {}
        self._words: dict[str, int] = {}
        self._older: dict[str, int] = {}

    def state(self, key: tuple) -> dict:
        found = self._states.get(key)
        if found is None:
            if len(self._states) >= MAX_STATES:
                self._states.clear()
            found = self._states[key] = {None: key}
        return found

    def _compile(self, state: dict, symbol: str) -> tuple[dict, int]:
        """The transition of a state under a symbol: next state and change of the count."""
        suffix, tokens, counts = state[None]
        ids = self.merges.ids
        if symbol not in ids:
            # Unknown symbols become one token per byte, and nothing joins over them.
            return self.state(self.START), len(symbol.encode())
        if suffix and suffix[-1] + symbol not in self._bigrams:
            suffix, tokens, counts = self.START  # no token spans this border
        text = suffix + symbol
        for start in range(len(text)):
            token = ids.get(text[start:])
            # tokens[d] is the last token of the prefix that ends d symbols before here.
            before = tokens[len(suffix) - start] if token is not None else None
            if token is not None and (self.merges.whole(token) if before < 0 else self.merges.compatible(before, token)):
                change = counts[len(suffix) - start] + 1
                break
        while text not in self._begins:
            text = text[1:]
        keep, begins = len(text), self._begins
        # Only prefixes at which some token may start are told apart.
        open_ = [text[keep - d :] in begins for d in range(1, keep + 1)]
        told = tuple(t if o else -2 for t, o in zip(tokens, open_))
        moved = tuple(c - change if o else 0 for c, o in zip(counts, open_))
        return self.state((text, (token, *told), (0, *moved))), change

    def run(self, state: dict, text: str) -> tuple[dict, int]:
        total = 0
        for symbol in text:
            step = state.get(symbol)
            if step is None:
                step = state[symbol] = self._compile(state, symbol)
            state, change = step
            total += change
        return state, total

    def word(self, word: str) -> int:
        """Count of a piece of text that starts and ends at borders no token spans."""
        n = self._words.get(word)
        if n is None:
            n = self._older.get(word)
            if n is None:
                n = self.run(self.state(self.START), word)[1]
            if len(word) <= 64:
                if len(self._words) >= REMEMBERED:
                    self._older, self._words = self._words, {}
                self._words[word] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text, with the blank that the tokenizer puts in front of it."""
        if not text:
            return 0
        words = text.split(" ")
        if "" in words or MARK in text:
            return sum(map(self.word, _words(MARK + text)))
        return sum(map(self._blank_word, words))

    def _blank_word(self, word: str) -> int:
        n = self._words.get(MARK + word)
        return self.word(MARK + word) if n is None else n

    def chunk_map(self, text: str, first: bool) -> tuple[str, bool, int, str]:
        """How a chunk acts on any state before it: (head, open, n, state).

        The head is what stands before the chunk's first border; it is read in
        the state that comes in. From the border on, count and end state are
        fixed. An open map has no border: the head is the whole chunk.
        """
        head = "" if first else _HEAD.match(text.replace(" ", MARK)).group()
        words = _words(MARK + text if first else text[len(head) :])
        if not words:
            return head, True, 0, ""
        n = sum(map(self.word, words[:-1]))
        state, last = self.run(self.state(self.START), words[-1])
        return head, False, n + last, json.dumps(state[None])

    def apply(self, key: tuple, head: str, is_open: bool, n: int, end: str) -> tuple[tuple, int]:
        """Next state and count after a chunk whose map is given."""
        state, before = self.run(self.state(key), head)
        if is_open:
            return state[None], before
        suffix, tokens, counts = json.loads(end)
        return (suffix, tuple(tokens), tuple(counts)), before + n


#: A word is a run of marks and what follows up to the next mark.
_WORD = re.compile(f"{MARK}+[^{MARK}]*|^[^{MARK}]+")
_HEAD = re.compile(f"{MARK}*[^{MARK}]*")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.replace(" ", MARK))


@lru_cache(maxsize=1)
def transducer(content: bytes) -> Transducer:
    return Transducer(read_scored_pieces(content))


def token_counts(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `n_bytes` (UTF-8) and `n_tokens` of every row's whole text under a scored piece model.

    Null texts count as empty: 0 bytes, 0 tokens. Null ids and repeated rows
    give one result row each; further columns are ignored, whatever their
    names. Texts of up to `CHUNK_CHARS` characters are counted where they are
    read. Longer ones are cut; the chunks' state maps are made in parallel, and
    a scan in chunk order, which holds one state at a time, composes them.
    """
    rows = two_columns(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    size = F.char_length("text")
    result = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for batch in batches:
            counts = [own.count(t) for t in batch.column(1).to_pylist()]
            yield record(result, (batch.column(0), batch.column(2), counts))

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    maps = pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in _MAPS.split(", "))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            id_, text, n_bytes, row = (c[0].as_py() for c in batch.columns)
            for part, start in enumerate(range(0, len(text), CHUNK_CHARS)):
                chunk = text[start : start + CHUNK_CHARS]
                yield record(maps, ([id_], [row], [n_bytes], [part], [chunk], [True], [0], [""]))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for batch in small_batches(batches):
            parts, texts = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            acts = [own.chunk_map(t, p == 0) for t, p in zip(texts, parts)]
            yield record(maps, (*batch.columns[:4], *zip(*acts)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        at, state, total, kept = None, Transducer.START, 0, (None, 0)
        for batch in small_batches(batches):
            done = []
            for id_, row, n_bytes, _, head, is_open, n, end in zip(*(c.to_pylist() for c in batch.columns)):
                if row != at:
                    if at is not None:
                        done.append((*kept, total))
                    at, state, total, kept = row, Transducer.START, 0, (id_, n_bytes)
                state, more = own.apply(state, head, is_open, n, end)
                total += more
            if done:
                yield record(result, tuple(zip(*done)))
        if at is not None:
            yield record(result, ([kept[0]], [kept[1]], [total]))

    out = "id long, n_bytes long, n_tokens long"
    short = rows.filter(size <= CHUNK_CHARS).mapInArrow(whole, out)
    chunks = rows.filter(size > CHUNK_CHARS).withColumn("row", F.monotonically_increasing_id()).mapInArrow(cut, _MAPS)
    long = (
        chunks.repartition("row", "part").mapInArrow(mapped, _MAPS)
        .repartition("row").sortWithinPartitions("row", "part").mapInArrow(scan, out)
    )
    return short.union(long)
