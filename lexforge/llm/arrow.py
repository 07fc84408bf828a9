"""Arrow plumbing for the operators that run Python on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Characters of text that one step of an operator holds at a time, whatever the size of the Arrow batch.
BLOCK_CHARS = 1_500_000


def blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose texts sum to about `most` characters, with the texts as strings (null: empty). A longer text stands alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist() if batch.num_rows else []
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and size + n > most:
                yield batch.slice(start, i - start), [t or "" for t in column.slice(start, i - start).to_pylist()]
                start, size = i, 0
            size += n
        if lengths:
            yield batch.slice(start), [t or "" for t in column.slice(start).to_pylist()]


def map_texts(df: DataFrame, text: str, schema: StructType | str, step: Callable[[pa.RecordBatch, list[str]], dict]) -> DataFrame:
    """Run `step` over blocks of rows; it returns a list of values or an Arrow array for each field of `schema`."""
    types = {f.name: f.type for f in to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, text):
            out = step(batch, texts)
            yield pa.RecordBatch.from_arrays([out[k] if isinstance(out[k], pa.Array) else pa.array(out[k], kind) for k, kind in types.items()], list(types))

    return df.mapInArrow(run, schema)
