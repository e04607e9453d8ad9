"""Forward-only cursors over results."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row


class Cursor:
    """Rows a batch at a time; the driver holds one partition and fetches the next one ahead."""

    def __init__(self, rows: DataFrame, batch: int = 1000):
        self.columns, self.batch = rows.columns, batch
        self._rows: Iterator[Row] = rows.toLocalIterator(prefetchPartitions=True)
        self.closed = False

    def fetch(self) -> list[Row]:
        """The next rows; none at the end."""
        out: list[Row] = []
        if not self.closed:
            for r in self._rows:
                out.append(r)
                if len(out) >= self.batch:
                    break
        return out

    def __iter__(self) -> Iterator[Row]:
        while rows := self.fetch():
            yield from rows

    def close(self) -> None:
        self.closed = True
