"""Row-wise Python operators over Arrow batches, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scriptmill.runtime import ship

SLICE_ROWS, SLICE_BYTES = 256, 2 << 20


def slices(batch: pa.RecordBatch, column: int, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``rows`` rows and about ``size`` bytes in ``column`` (one row at least)."""
    lengths = batch.column(column).nbytes / max(1, batch.num_rows)
    step = max(1, min(rows, int(size / max(1.0, lengths))))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def map_texts(df: DataFrame, make: Callable[[], Callable[[list[str]], dict]], keep: list[str], text: str, schema: StructType, rows: int = SLICE_ROWS) -> DataFrame:
    """Map whole texts to new columns. ``make()`` runs once per task and returns a function from texts (null as empty) to the columns of ``schema`` after ``keep``."""
    ship(df.sparkSession)
    fields = schema.fieldNames()
    arrow = to_arrow_schema(schema)

    def run(batches):
        fn = make()
        for b in batches:
            for part in slices(b, len(keep), rows):
                out = fn([x or "" for x in part.column(len(keep)).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + [pa.array(out[f], arrow.field(f).type) for f in fields[len(keep):]], schema=arrow)

    return df.select(*keep, text).mapInArrow(run, schema)


def schema_of(df: DataFrame, keep: list[str], more: str) -> StructType:
    """The kept columns of ``df`` followed by a DDL list of new ones."""
    return StructType([df.schema[k] for k in keep] + StructType.fromDDL(more).fields)


def filter_rows(df: DataFrame, make: Callable[[], Callable[[list[str]], list]], text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text (null as empty) the function made by ``make`` marks true."""
    ship(df.sparkSession)
    at = df.columns.index(text)

    def run(batches):
        fn = make()
        for b in batches:
            for part in slices(b, at):
                yield part.filter(pa.array([bool(x) for x in fn([x or "" for x in part.column(at).to_pylist()])], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def replace_texts(df: DataFrame, make: Callable[[], Callable[[list[str]], list[str]]], text: str = "text") -> DataFrame:
    """The rows with new texts; null texts stay null, all other columns stay as they are."""
    ship(df.sparkSession)
    at = df.columns.index(text)

    def run(batches):
        fn = make()
        for b in batches:
            for part in slices(b, at):
                old = part.column(at).to_pylist()
                new = fn([x or "" for x in old])
                yield part.set_column(at, part.schema.field(at), pa.array([None if o is None else n for o, n in zip(old, new, strict=True)], part.schema.field(at).type))

    return df.mapInArrow(run, df.schema)
