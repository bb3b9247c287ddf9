"""Act only on events strictly newer than everything seen for the key.

Batch twin of the keyed state: a row is kept when its time is greater
than the maximum time of all rows of the same key that arrived before it
(``positions.max_before``: chunks of the arrival order by sampled ranges, so
neither a hot key nor a burst of arrivals meets in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.operators.positions import DEFAULT_CHUNK_ROWS, ROW_ID, max_before, with_row_id


def newer_only(df: DataFrame, key: str, ts: str, arrival: str, tiebreak: str | None = None,
               chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    order = [F.col(arrival), *([F.col(tiebreak)] if tiebreak else []), F.col(ROW_ID)]
    x = max_before(with_row_id(df), [key], order, F.col(ts), "__best", chunk_rows)
    return x.where(F.col("__best").isNull() | (F.col(ts) > F.col("__best"))).drop("__best", ROW_ID)
