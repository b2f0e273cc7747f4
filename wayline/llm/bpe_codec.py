"""BPE encoding and decoding by one last token per prefix."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from wayline.llm.common import small_batches, two_columns
from wayline.llm.merges import byte_symbols, read_byte_level

#: Fixed value: how the byte-level files split a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A worker remembers the ids of at most this many words; the older half goes when there are more.
REMEMBERED = 200_000

_RESULT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("decoded", T.StringType(), False),
])


class Codec(dict):
    """Exact ids of a byte-level tokenizer file, and texts of ids.

    As a dict it remembers words met lately with their ids, packed as 32-bit numbers.
    """

    def __init__(self, content: bytes):
        super().__init__()
        self.merges, self.special = read_byte_level(content)
        merges = self.merges
        self._symbols = byte_symbols()
        self._shown = str.maketrans({b: s for b, s in enumerate(self._symbols)})
        self._length = [len(p) if p is not None else 0 for p in merges.pieces]
        byte_of = {s: b for b, s in enumerate(self._symbols)}
        self._bytes = [bytes(byte_of[c] for c in p) if p is not None else b"" for p in merges.pieces]
        for text, i in self.special.items():
            self._bytes[i] = text.encode()
        # Every token that ends at a place is met on the chain of suffixes of the automaton's state there.
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in merges.ids.items():
            if merges.whole(i):
                self._automaton.add_word(piece, i)
        self._automaton.make_automaton()
        self._split = regex.compile(SPLIT)
        self._loose = re.compile(r"^\s| \s|\s |\s$|\0")
        names = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of one split piece: the last token of each prefix, then the way back from the end."""
        symbols = piece.encode().decode("latin-1").translate(self._shown)
        length, known, compatible = self._length, self.merges.known, self.merges.compatible
        last = [-1] * (len(symbols) + 1)
        done = 0  # matches come by their end, so only the newest prefix can be open
        for end, token in self._automaton.iter(symbols):
            if end >= done:
                start = end + 1 - length[token]
                if start:
                    before = last[start]
                    fits = known.get(before << 32 | token)
                    if fits is None:
                        fits = compatible(before, token)
                    if not fits:
                        continue
                done = end + 1
                last[done] = token
        ids, at = [], len(symbols)
        while at:
            ids.append(last[at])
            at -= length[last[at]]
        ids.reverse()
        return ids

    def __missing__(self, word: str) -> bytes:
        pieces = self._split.findall(word)
        if len(pieces) > 1:  # a word with signs: its parts are met far more often than the whole
            return b"".join(map(self.__getitem__, pieces))
        ids = np.array(self.piece_ids(word), np.int32).tobytes()
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                for old in list(islice(self, REMEMBERED // 2)):
                    del self[old]
            self[word] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if self._loose.search(text):
            # Blanks beside blanks: let the pattern decide what belongs together.
            words = self._split.findall(text)
        else:
            # A single blank between two words always opens the piece of the second one.
            words = text.replace(" ", "\0 ").split("\0")
        return b"".join(map(self.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        parts = []
        at = 0
        for found in self._special.finditer(text) if self._special else ():
            parts.append(self._plain(text[at : found.start()]))
            parts.append(np.int32(self.special[found.group()]).tobytes())
            at = found.end()
        parts.append(self._plain(text[at:]))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self._bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def codec(content: bytes) -> Codec:
    return Codec(content)


def read_file(path: str) -> bytes:
    """A tokenizer file, read where the query is built; its bytes travel with the tasks (a few MB at most)."""
    with open(path, "rb") as f:
        return f.read()


def encode_decode(df: DataFrame, tokenizer: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `ids` (array of int) and `decoded` (the text of these ids) of every row.

    Null texts count as empty and give an empty list; null ids, repeated rows
    and ties are kept as they are, one result row per input row. Further
    columns are ignored, whatever their names. Special strings inside a text
    become their special id. Rows never leave their task: there is no shuffle.
    """
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in small_batches(batches):
            ids = [own.encode(t or "") for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            packed = pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else np.empty(0, np.int32))
            decoded = pa.array([own.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed, decoded], schema=schema)

    return two_columns(df, id_col, text_col).mapInArrow(run, _RESULT)


def digests(encoded: DataFrame, id_name: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Token count and digests of the ids and of the decoded text, and the columns named in `keep`."""
    return encoded.select(
        F.col("id").alias(id_name),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        *keep,
    )
