"""T2 YEAR and T8 MASK_DATE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from ladle.functions.time import parse_with_recipe_pattern
from ladle.plans.recipe import as_list, same_columns, step

_DATE_TYPES = (DateType, TimestampType, TimestampNTZType)


def _is_datetime(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _DATE_TYPES)


def year_of(df: DataFrame, name: str, fmt: str | None) -> Column:
    """Year of a date/timestamp column, or of text parsed with the recipe pattern."""
    if _is_datetime(df, name) or not fmt:
        return F.year(F.col(name) if _is_datetime(df, name) else F.try_to_timestamp(F.col(name)))
    return F.year(parse_with_recipe_pattern(F.col(name), fmt))


def _year_target(params: dict, columns: list[str]) -> list[str]:
    return [*columns, params.get("targetColumn") or f"{params['sourceColumn']}_YEAR"]


@step("YEAR", kind="expr", writes=_year_target)
def _year_step(df, ctx, sourceColumn, targetColumn=None, dateTimeFormat=None, **_):
    return {targetColumn or f"{sourceColumn}_YEAR": year_of(df, sourceColumn, dateTimeFormat)}


# Date, then at most a time of day and zone; anything else after the day is no date.
_PARTS = (r"^\s*(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"
          r"(?:[ T*]\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:Z|[+-]\d{2}(?::?\d{2})?)?)?\s*$")


def mask_date(c: Column, redact: list[str], symbol: str = "#",
              day_first_when_ambiguous: bool = False, is_datetime: bool = False) -> Column:
    """Mask the listed parts of a ``year-month-day`` value -> ``yyyy/MM/dd``.

    Text that is not a valid date gives null (masking must not fail open).
    With ``day_first_when_ambiguous`` a third part <= 12 is read as the
    month, so the middle part is the day -- the compatibility reading;
    the output keeps the input's part order.
    """
    red = {r.upper() for r in redact}
    text = F.date_format(c, "yyyy-MM-dd") if is_datetime else c.cast("string")
    y, p2, p3 = (F.regexp_extract(text, _PARTS, i) for i in (1, 2, 3))
    valid = text.rlike(_PARTS) & F.try_to_date(
        F.concat_ws("-", y, F.lpad(p2, 2, "0"), F.lpad(p3, 2, "0")), "yyyy-MM-dd").isNotNull()
    if day_first_when_ambiguous:
        swap = p3.cast("int") <= 12
        valid = text.rlike(_PARTS) & F.coalesce(
            F.try_to_date(F.concat_ws("-", y, F.lpad(p2, 2, "0"), F.lpad(p3, 2, "0")), "yyyy-MM-dd").isNotNull()
            | F.try_to_date(F.concat_ws("-", y, F.lpad(p3, 2, "0"), F.lpad(p2, 2, "0")), "yyyy-MM-dd").isNotNull(),
            F.lit(False))
        mid_kind = F.when(swap, F.lit("DAY")).otherwise(F.lit("MONTH"))
        last_kind = F.when(swap, F.lit("MONTH")).otherwise(F.lit("DAY"))
    else:
        mid_kind, last_kind = F.lit("MONTH"), F.lit("DAY")

    def part(value: Column, kind: Column | str, width: int) -> Column:
        shown = F.lpad(value, width, "0")
        hidden = F.lit(symbol * width)
        if isinstance(kind, str):
            return hidden if kind in red else shown
        return F.when(kind.isin(*red) if red else F.lit(False), hidden).otherwise(shown)

    out = F.concat_ws("/", part(y, "YEAR", 4), part(p2, mid_kind, 2), part(p3, last_kind, 2))
    return F.when(c.isNotNull() & valid, out)


@step("MASK_DATE", kind="expr", writes=same_columns, kinds={"redact": "list"})
def _mask_date_step(df, ctx, sourceColumns, redact, maskSymbol="#", **_):
    compat = bool(ctx.day_first_when_ambiguous)
    return {c: mask_date(F.col(c), as_list(redact), maskSymbol, compat, _is_datetime(df, c))
            for c in as_list(sourceColumns)}
