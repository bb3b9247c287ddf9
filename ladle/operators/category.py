"""T6 CATEGORICAL_MAPPING and P7 (delete other rows)."""

from __future__ import annotations

import json
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.joins import attach_checked
from ladle.plans.recipe import RecipeError, step

# Maps up to this many entries are inlined as a map literal in the
# projection; larger ones become a driver-built frame joined with a
# broadcast hint -- its size is the recipe's own size, known here.  Both
# work on the same texts, so the result does not depend on the size.
INLINE_MAP_LIMIT = 1000


def _text(value) -> str | None:
    """A recipe value as the text a cell would show: JSON booleans in lower case, null as null."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value)


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def map_categories(df: DataFrame, source: str, target: str, mapping: dict,
                   other: str | None = None, delete_other_rows: bool = False,
                   map_type: str | None = "TEXT") -> DataFrame:
    """target = mapping[source]; values outside the map, or mapped to null, -> ``other``
    (or their own value when no ``other`` is given); nulls -> ``other``.

    With map type NUMERIC the target is a double: mapped values and ``other`` must be
    numbers (checked before any job), and a value kept as its own that is none becomes null.
    """
    texts, other = {_text(k): _text(v) for k, v in mapping.items()}, _text(other)
    numeric = str(map_type or "TEXT").upper() == "NUMERIC"
    if numeric and (bad := [v for v in [*texts.values(), other] if v is not None and not _is_number(v)]):
        raise RecipeError(f"CATEGORICAL_MAPPING: {bad[0]!r} is no number, but the map type is NUMERIC")

    def typed(c: Column) -> Column:
        return c.try_cast("double") if numeric else c

    key = F.col(source).cast("string")
    rest = F.when(key.isNull(), F.lit(other).cast("string")).otherwise(F.lit(other).cast("string") if other is not None else key)
    if len(texts) <= INLINE_MAP_LIMIT:
        entries = list(chain.from_iterable((F.lit(k), F.lit(v).cast("string")) for k, v in texts.items()))
        table = F.create_map(*entries) if entries else F.lit(None).cast("map<string,string>")
        known = F.coalesce(F.map_contains_key(table, key), F.lit(False)) if entries else F.lit(False)
        joined = df.where(known) if delete_other_rows else df
        mapped = F.element_at(table, key) if entries else F.lit(None).cast("string")
        return joined.withColumn(target, typed(F.coalesce(mapped, rest)))
    table = df.sparkSession.createDataFrame(list(texts.items()), "__key string, __val string")
    joined = df.join(F.broadcast(table), key == F.col("__key"), "inner" if delete_other_rows else "left")
    return joined.withColumn(target, typed(F.coalesce(F.col("__val"), rest))).drop("__key", "__val")


def top_values(df: DataFrame, source: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values (ties -> smaller value first).
    Partial aggregation, then a distributed TakeOrdered of k rows."""
    return (df.where(F.col(source).isNotNull())
            .groupBy(source).agg(F.count(F.lit(1)).alias("__n"))
            .orderBy(F.desc("__n"), F.asc(source)).limit(k).select(source))


def map_top_x(df: DataFrame, source: str, target: str, k: int,
              other: str = "Other", delete_other_rows: bool = False) -> DataFrame:
    """Keep the top-``k`` values, map the rest to ``other``."""
    top = top_values(df, source, k).withColumn("__keep", F.lit(True))
    joined = attach_checked(df, top, [source])  # k values of any length: their bytes are measured
    out = F.when(F.col("__keep"), F.col(source).cast("string")).otherwise(F.lit(other))
    res = joined.withColumn(target, out)
    if delete_other_rows:
        res = res.where(F.col("__keep"))
    return res.drop("__keep")


def _added(params: dict, columns: list[str]) -> list[str]:
    return [*columns, params.get("targetColumn") or f"{params['sourceColumn']}_mapped"]


@step("CATEGORICAL_MAPPING", writes=_added, kinds={"categoryMap": "map", "deleteOtherRows": "flag"})
def _categorical_step(df, ctx, sourceColumn, targetColumn=None, categoryMap=None, other=None,
                      deleteOtherRows=False, mapType="TEXT", mappingOption=None, topX=None, **_):
    target = targetColumn or f"{sourceColumn}_mapped"
    if categoryMap is None and topX is not None:
        return map_top_x(df, sourceColumn, target, int(topX), other or "Other", bool(deleteOtherRows))
    return map_categories(df, sourceColumn, target, dict(categoryMap or {}), other,
                          bool(deleteOtherRows), mapType)
