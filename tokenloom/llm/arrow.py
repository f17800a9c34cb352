"""Running numpy code over the rows of a DataFrame, in slices of bounded size.

Everything in this subpackage that runs Python on rows goes through ``map_texts``.
A slice holds about ``SLICE_BYTES`` of text, or one longer text: numpy temporaries
are some fifty times that, whatever the size of the Arrow batch that came in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20


class Texts:
    """Texts as one array of UTF-8 bytes and their offsets; null counts as empty."""

    def __init__(self, column: pa.Array):
        texts = column.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        count = len(texts)
        self.offsets = np.zeros(1, np.int64)
        if count:
            self.offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + count + 1]
        first, last = int(self.offsets[0]), int(self.offsets[-1])
        self.data = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
        self.offsets = self.offsets - first

    def __len__(self) -> int:
        return len(self.offsets) - 1


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch after every ``limit`` bytes of text; a longer text is a slice of its own."""
    sizes = batch.column(text).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset :] if len(sizes) else [0]
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets[: batch.num_rows + 1], offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def map_texts(
    df: DataFrame,
    text: str,
    function: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    schema: str | StructType,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns ``keep`` as they are, then what ``function`` makes of each slice of rows.

    ``function`` gets a slice with the columns ``keep`` and ``text`` and returns one
    array per field of ``schema``, each with one value per row.
    """
    made = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    kept = StructType([df.schema[c] for c in keep])
    columns = [*dict.fromkeys([*keep, text])]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                arrays = [part.column(c) for c in keep] + list(function(part))
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *made.names])

    return df.select(*(quoted(c) for c in columns)).mapInArrow(run, StructType([*kept, *made]))


def quoted(column: str):
    """A column by its plain name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def unused(names: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores until no column has that name, letter case aside."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
