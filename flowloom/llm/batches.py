"""Feeding whole texts to Python in Arrow batches, a bounded number of rows at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Rows turned into Python objects at once; texts of a batch stay in Arrow's buffers until then.
ROWS_AT_ONCE = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def to_arrow(name_type: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([pa.field(name, kind) for name, kind in name_type])


def map_rows(
    df: DataFrame,
    columns: list[str],
    make: Callable[[], Callable[..., tuple]],
    fields: list[tuple[str, str, pa.DataType]],
) -> DataFrame:
    """One output row for each input row: ``make()`` runs once a task and gives the row function.

    Only ``columns`` are read, so other columns of ``df`` may have any name. ``fields``
    holds name, SQL type and Arrow type of what the function returns.
    """
    schema = to_arrow([(name, kind) for name, _, kind in fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for part in slices(batches):
            values = [row(*cells) for cells in zip(*(c.to_pylist() for c in part.columns), strict=True)]
            arrays = [pa.array(column, kind) for column, (_, _, kind) in zip(zip(*values, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.select(*columns).mapInArrow(run, ", ".join(f"`{name}` {sql}" for name, sql, _ in fields))


def keep_or_rewrite(
    df: DataFrame, column: str, make: Callable[[], Callable[[str | None], tuple[bool, str | None]]], length: str | None
) -> DataFrame:
    """All columns of ``df`` with the text ``column`` rewritten and rows dropped where the function says so.

    The row function gives (keep, new text). ``length``, where ``df`` has it, is set to the
    number of code points of the new text.
    """
    names = df.columns
    at = names.index(column)
    size_at = names.index(length) if length in names else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for part in slices(batches):
            old = part.column(at).to_pylist()
            made = [row(text) for text in old]
            arrays = list(part.columns)
            new = [text for _, text in made]
            if new != old:
                arrays[at] = pa.array(new, part.schema.field(at).type)
                if size_at is not None:
                    sizes = [None if text is None else len(text) for text in new]
                    arrays[size_at] = pa.array(sizes, part.schema.field(size_at).type)
            out = pa.RecordBatch.from_arrays(arrays, schema=part.schema)
            yield out.filter(pa.array([keep for keep, _ in made], pa.bool_()))

    return df.mapInArrow(run, df.schema)
