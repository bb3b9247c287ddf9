"""T3 FLAG_COLUMN_FROM_PATTERN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.plans.recipe import step, target_column


def flag_pattern(c: Column, pattern: str) -> Column:
    """True when the pattern matches anywhere in the value; null stays null."""
    return c.cast("string").rlike(pattern)


@step("FLAG_COLUMN_FROM_PATTERN", kind="expr", writes=target_column)
def _flag_step(df, ctx, pattern, sourceColumn, targetColumn, **_):
    return {targetColumn: flag_pattern(F.col(sourceColumn), pattern)}
