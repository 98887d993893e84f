"""Arrow batches within tasks."""

from collections.abc import Iterator

import pyarrow as pa


def small(batches: Iterator[pa.RecordBatch], rows=500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that few texts are unpacked at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)
