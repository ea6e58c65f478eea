"""Arrow batches in bounded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters (bytes) of text that a worker holds decoded at a time; one longer text is a piece of its own.
PIECE = 1 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each piece holds about ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        a = 0
        while a < len(size):
            total = np.cumsum(size[a:])
            n = max(1, int(np.searchsorted(total, limit, side="right")))
            yield batch.slice(a, n)
            a += n


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, null as empty."""
    return [x or "" for x in batch[column].to_pylist()]


def with_columns(df: DataFrame, column: str, fields: list[T.StructField], make: Callable[[], Callable[[list[str]], list]], keep: list[str] | None = None, limit: int = PIECE) -> DataFrame:
    """df's ``keep`` columns (default: all) and new ones that a function of the texts gives.

    ``make()`` runs once in each task and returns a function from a list of texts to one list or array for each field.
    A new field whose name a kept column has replaces that column.
    """
    names = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    source = df.select(*[df[c] for c in dict.fromkeys([*kept, column])])
    schema = T.StructType([*[source.schema[c] for c in kept], *fields])
    types = [to_arrow_schema(T.StructType([f])).field(0).type for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for piece in pieces(batches, column, limit):
            new = call(texts(piece, column))
            arrays = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(new, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*[piece[c] for c in kept], *arrays], names=[*kept, *(f.name for f in fields)])

    return source.mapInArrow(run, schema)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        k = batch[key].to_numpy()
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut or held and held[-1][key][0].as_py() != k[0]:
            if cut:
                held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def each(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table for each group of batches sorted by key."""
    for table in grouped(batches, key):
        k = table[key].to_numpy()
        start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])).tolist()
        for a, b in zip(start, [*start[1:], len(k)], strict=True):
            yield table.slice(a, b - a)
