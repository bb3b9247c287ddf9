"""T1 FILL_WITH_MOST_FREQUENT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.plans.recipe import same_columns, step


def most_frequent(df: DataFrame, column: str) -> Column:
    """The column's mode as a scalar subquery; ties go to the smallest value.

    ``groupBy(c).count()`` aggregates map-side first, so a value holding a
    third of all rows costs one partial row per task; the top-1 is a
    distributed TakeOrdered.  Nothing is collected to the driver.
    """
    top = (df.where(F.col(column).isNotNull())
           .groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
           .orderBy(F.desc("__n"), F.asc(column))
           .limit(1).select(column))
    return top.scalar()


def fill_most_frequent(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), most_frequent(df, column)))


@step("FILL_WITH_MOST_FREQUENT", kind="expr", writes=same_columns)
def _fill_step(df, ctx, sourceColumn, **_):
    return {sourceColumn: F.coalesce(F.col(sourceColumn), most_frequent(df, sourceColumn))}
