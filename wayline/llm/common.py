"""Helpers shared by the training-data operators: Arrow batches, stored intermediates, columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Texts are handled in slices of about this many bytes, so that one very long text needs no large temporary lists.
SLICE_BYTES = 1 << 20
#: Rows are unpacked in slices of about this many bytes.
BATCH_BYTES = 4 << 20
_BLANKS = b" \t\n\r\x0b\x0c"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under the fixed names `id` and `text`; other columns are left behind."""
    return df.select(df[id_col].cast("long").alias("id"), df[text_col].alias("text"))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of few rows and bytes, which bounds what is unpacked at once; a longer text comes alone."""
    for batch in batches:
        lengths = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
                lengths += pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        after = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            before = after[start - 1] if start else 0
            end = max(start + 1, min(start + rows, int(np.searchsorted(after, before + size, "right"))))
            yield batch.slice(start, end - start)
            start = end


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null becomes empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def word_slices(text: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text in slices of at least `size` bytes that end where a word ends."""
    start, end = 0, len(text)
    while end - start > size:
        cut = start + size
        while cut < end and text[cut] not in _BLANKS:
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def record(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def check_kept(keep: Sequence[str], *results: str) -> None:
    """Kept columns must not have the name of a result column."""
    clashing = sorted({c.lower() for c in keep} & {c.lower() for c in results})
    if clashing or len({c.lower() for c in keep}) < len(keep):
        raise ValueError(f"columns to keep clash with result columns or each other: {clashing or list(keep)}")
