"""One output row per input row, from its text, in Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructType

from coverspark.session import ship

_ROWS = 512


def give_back() -> None:
    """Return what a task has freed to the system, so that a worker that waits for the next task holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # the C library of Linux has it
        trim(0)


def map_texts(df: DataFrame, text_col: str, make: Callable[[], Callable[[list[str | None]], dict[str, list]]], fields: dict[str, pa.DataType]) -> DataFrame:
    """`df` without `text_col` but with `fields`, which make()(texts) gives for a list of texts.

    make runs once per task, so it can set up an encoder. The other columns pass through untouched, nulls
    and large integers included.
    """
    ship(df.sparkSession)
    keep = [c for c in df.columns if c != text_col]
    schema = StructType([df.schema[c] for c in keep])
    for name, kind in fields.items():
        schema = schema.add(name, from_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                made = of(part.column(part.schema.get_field_index(text_col)).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in keep] + [pa.array(made[n], k) for n, k in fields.items()], names=[*keep, *fields])
        del of
        give_back()

    return df.mapInArrow(run, schema)
