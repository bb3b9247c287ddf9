"""T4 / T5 GROUP_BY (A1, A2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.joins import attach_checked
from ladle.plans.recipe import RecipeError, as_list, step


def _agg_expr(fn: str, src: str) -> Column:
    fn = fn.upper()
    c = F.col(src)
    if fn == "COUNT":
        return F.count(c)
    if fn == "SUM":
        return F.sum(c)
    if fn == "MIN":
        return F.min(c)
    if fn == "MAX":
        return F.max(c)
    if fn in ("AVG", "MEAN", "AVERAGE"):
        return F.avg(c)
    if fn == "COUNT_DISTINCT":
        return F.count_distinct(c)
    raise RecipeError(f"GROUP_BY: unsupported function {fn!r}")


def _aggs(options: list[dict]) -> list[tuple[str, Column]]:
    out = []
    for opt in options:
        src = opt["sourceColumnName"]
        tgt = opt.get("targetColumnName") or f"{src}_{opt['functionName'].lower()}"
        e = _agg_expr(opt["functionName"], src)
        if opt.get("targetColumnDataType"):
            e = e.cast(opt["targetColumnDataType"])
        out.append((tgt, e.alias(tgt)))
    return out


def group_new_frame(df: DataFrame, keys: list[str], options: list[dict]) -> DataFrame:
    """The grouped table (hash aggregate with map-side partial aggregation)."""
    return df.groupBy(*keys).agg(*[e for _, e in _aggs(options)])


def group_append(df: DataFrame, keys: list[str], options: list[dict]) -> DataFrame:
    """Each row keeps its columns and gains the aggregate of its group.

    Not ``agg().over(Window.partitionBy(keys))``: a window sends a whole
    group to one task, so one key holding a third of the rows would stall
    the job.  Instead aggregate (partial, skew-proof) and join the per-key
    table back -- broadcast when its checked size is small, so the rows
    themselves are never shuffled.
    """
    aggs = _aggs(options)
    targets = [t for t, _ in aggs]
    table = df.groupBy(*keys).agg(*[e for _, e in aggs])
    base = df.drop(*[t for t in targets if t in df.columns and t not in keys])
    return attach_checked(base, table, keys)


def _reads(params: dict) -> list[str]:
    cols = as_list(params.get("sourceColumns"))
    cols += [o["sourceColumnName"] for o in as_list(params.get("groupByAggFunctionOptions"))]
    return cols


def _leaves(params: dict, columns: list[str]) -> list[str]:
    targets = [o.get("targetColumnName") or f"{o['sourceColumnName']}_{o['functionName'].lower()}"
               for o in as_list(params.get("groupByAggFunctionOptions"))]
    return [*(as_list(params.get("sourceColumns")) if params.get("useNewDataFrame", True) else columns), *targets]


@step("GROUP_BY", reads=_reads, writes=_leaves, kinds={"groupByAggFunctionOptions": "list", "useNewDataFrame": "flag"})
def _group_step(df, ctx, sourceColumns, groupByAggFunctionOptions, useNewDataFrame=True, **_):
    keys, opts = as_list(sourceColumns), as_list(groupByAggFunctionOptions)
    if useNewDataFrame:
        return group_new_frame(df, keys, opts)
    return group_append(df, keys, opts)
