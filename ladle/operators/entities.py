"""F3 personal-data detection over columns (one aggregate pass)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.patterns import (CHECKSUM_ENTITIES, ENTITY_FIND, ENTITY_PREFILTER, expand_entities,
                                     luhn_valid)


def contains_entity(text: Column, entity: str) -> Column:
    """True when ``text`` contains the entity anywhere (whole text scanned).

    The cheap necessary condition runs first; ``And`` short-circuits, so
    the full pattern only runs where it can match."""
    pre = ENTITY_PREFILTER[entity]
    cheap = F.instr(text, pre) > 0 if entity == "EMAIL" else text.rlike(pre)
    if entity in CHECKSUM_ENTITIES:  # some match must also pass the checksum
        return cheap & F.exists(F.regexp_extract_all(text, F.lit(ENTITY_FIND[entity]), F.lit(0)), luhn_valid)
    return cheap & text.rlike(ENTITY_FIND[entity])


def detect_entities(df: DataFrame, columns: list[str], entities: list[str] | None = None) -> DataFrame:
    """One row per (column, entity): values seen, values containing the entity.

    Whole values are scanned (``rlike`` on the full text).  All counts come
    from a single partial-aggregated pass over the requested columns.
    """
    ents = expand_entities(entities)
    aggs, rows = [], []
    for i, c in enumerate(columns):
        text = F.col(c).cast("string")
        aggs.append(F.count(text).alias(f"__n{i}"))
        for j, e in enumerate(ents):
            aggs.append(F.count_if(contains_entity(text, e)).alias(f"__m{i}_{j}"))
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(e).alias("entity_type"),
                                 F.col(f"__n{i}").alias("n_values"), F.col(f"__m{i}_{j}").alias("n_matches")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
