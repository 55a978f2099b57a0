"""Work in Python over files: tasks by the number of rows, and Arrow batches bounded in bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Rows of a task whose work on each is heavier than reading it, and bytes that are handed on at once.
TASK_ROWS, BATCH_BYTES, BATCH_ROWS = 2_000, 16 << 20, 2_000


def spread(rows: DataFrame, *keys: str, each: int = TASK_ROWS) -> DataFrame:
    """rows over as many tasks as have about ``each`` of them, by hash of keys: a table of few bytes is else read by few tasks, however long each row takes. Rows are counted first, so they should be of a source and not of work."""
    return rows.repartition(max(1, -(-rows.count() // each)), *keys)


def in_batches(rows: Iterable[tuple], columns: list[str], kinds: dict[str, str] | None = None) -> Iterator[pd.DataFrame]:
    """rows as frames, each of at most BATCH_ROWS rows, and of BATCH_BYTES of bytes and text where a row alone isn't more; rows are made one after the other, as they are asked for."""

    def frame(part: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(part, columns=columns)
        return made.astype(kinds) if kinds else made

    part, held = [], 0
    for row in rows:
        size = sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if part and (held + size > BATCH_BYTES or len(part) == BATCH_ROWS):
            yield frame(part)
            part, held = [], 0
        part.append(row)
        held += size
    if part:
        yield frame(part)
