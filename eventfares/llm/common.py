"""Small helpers the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def batches_of(schema: pa.Schema, rows, chars: int = 8 << 20, most: int = 1000):
    """Batches of `rows`, each a weight in characters and a tuple of values."""
    held, weight = [], 0
    for size, values in rows:
        held.append(values)
        weight += size
        if weight >= chars or len(held) >= most:
            yield batch_of(schema, *zip(*held, strict=True))
            held, weight = [], 0
    if held:
        yield batch_of(schema, *zip(*held, strict=True))


def map_arrow(df: DataFrame, function, schema: pa.Schema) -> DataFrame:
    """`mapInArrow` with an Arrow schema, empty batches skipped."""

    def run(batches):
        yield from function(b for b in batches if b.num_rows)

    return df.mapInArrow(run, ddl(schema))


def ddl(schema: pa.Schema) -> str:
    names = {
        pa.int64(): "bigint",
        pa.int32(): "int",
        pa.string(): "string",
        pa.binary(): "binary",
        pa.float64(): "double",
        pa.bool_(): "boolean",
        pa.list_(pa.int64()): "array<bigint>",
        pa.list_(pa.int32()): "array<int>",
        pa.list_(pa.string()): "array<string>",
    }
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)
