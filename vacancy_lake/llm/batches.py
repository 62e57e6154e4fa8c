"""Arrow batches in tasks: run a function over the texts of a table, keep other columns as they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Delimiters of a word in most contracts: space, tab, line feed, vertical tab, form feed, return.
#: ``bytes.split()`` without arguments splits at these six and at nothing else.
SPACES = b" \t\n\r\x0b\x0c"


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The column's texts as UTF-8, null as None."""
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: a worker holds the texts of few rows as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def append_columns(
    df: DataFrame,
    text_col: str,
    compute: Callable[[list[bytes | None]], Sequence],
    fields: list[T.StructField],
    keep: Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """One narrow pass: ``compute`` turns the texts of a batch into one sequence per field.

    ``keep`` names the input columns that are carried along (None: all).  An input column that has
    the name of a new field is replaced.  ``where`` names a boolean field: rows that are not true
    there are dropped in the same pass, so a filter on texts needs no join.
    """
    new = {f.name for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    schema = T.StructType([df.schema[c] for c in kept] + list(fields))
    arrow = [(f.name, to_arrow_type(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = compute(texts_of(batch, text_col))
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(v, type=t) for v, (_, t) in zip(values, arrow, strict=True)]
            out = pa.RecordBatch.from_arrays(columns, names=[*kept, *(n for n, _ in arrow)])
            if where is not None:
                out = out.filter(out.column(where))
            yield out

    source = [*kept, text_col] if text_col not in kept else kept
    return df.select(*source).mapInArrow(run, schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


class Codes(dict):
    """Numbers words as they are first seen; ``fresh`` lists those not yet handled."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key) -> int:
        code = self[key] = len(self)
        self.fresh.append(key)
        return code
