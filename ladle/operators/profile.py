"""F1 column profile and F2 top values per column.

One aggregate pass computes the per-column statistics for all columns
at once (partial aggregation, one row out); it is turned into one row
per column with ``explode`` over that single row.  Exact distinct counts
take one more pass: every row yields one (column, typed value) pair
per column, pairs are de-duplicated with partial aggregation and counted
per column -- one scan and one shuffle of distinct pairs for all columns;
the least and greatest text of text columns come from the same pairs.
``exact_distinct=False`` uses the HyperLogLog++ sketch instead, which
merges in constant memory.  Top values of all columns are one pass over
the same pairs, counted.
``profile_sketches`` keeps per column what profiles of parts need to be merged:
counts, bounds, moments, a HyperLogLog sketch of the values and a KLL sketch of
the numbers.  ``merge_profiles`` makes a profile of all parts of these rows
alone: counts and bounds are exact, distinct counts and quantiles within the
sketches' bounds; no part is read again.
Quantiles use ``percentile_approx`` (a mergeable sketch): an exact
percentile would hold a whole column in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

PROFILE_SCHEMA_COLUMNS = ["column_name", "data_type", "n_rows", "n_null", "n_distinct",
                          "min_value", "max_value", "mean", "stddev"]


def _is_numeric(df: DataFrame, c: str) -> bool:
    t = df.schema[c].dataType
    return isinstance(t, NumericType) and not isinstance(t, BooleanType)


def _orderable(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() not in ("map", "array", "struct", "binary", "variant")


def _is_text(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() == "string"


def _fixed_width(df: DataFrame, c: str) -> bool:
    """min/max buffers of fixed width keep the aggregate a codegen'd HashAggregate."""
    t = df.schema[c].dataType
    if t.typeName() == "decimal":
        return t.precision <= 18
    return t.typeName() in ("byte", "short", "integer", "long", "float", "double", "boolean",
                            "date", "timestamp", "timestamp_ntz")


_SLOTS = ("v_long", "v_double", "v_text")


def _typed_slot(df: DataFrame, c: str) -> tuple[str, Column]:
    """The value in a slot of its own kind, equal exactly when values are equal."""
    t = df.schema[c].dataType
    name = t.typeName()
    x = F.col(c)
    if name in ("byte", "short", "integer", "long", "boolean"):
        return "v_long", x.cast("long")
    if name in ("float", "double"):
        return "v_double", F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))
    if name in ("date", "timestamp", "timestamp_ntz"):
        return "v_long", F.unix_micros(x.cast("timestamp")) if name != "date" else F.unix_date(x).cast("long")
    if name in ("array", "map", "struct", "variant"):
        return "v_text", F.to_json(F.struct(x.alias("v")))
    if name == "binary":
        return "v_text", F.hex(x)
    return "v_text", x.cast("string")


def _pairs(df: DataFrame, cols: list[str], with_text: bool = False) -> DataFrame:
    """(__i, v_long, v_double, v_text) of every non-null cell; ``with_text`` adds ``text``, the cell as
    text where its slot is not the text already."""
    items = []
    for i, c in enumerate(cols):
        slot, val = _typed_slot(df, c)
        fields = [F.lit(i).alias("__i")]
        fields += [(val if s == slot else F.lit(None).cast("string" if s == "v_text" else s[2:])).alias(s)
                   for s in _SLOTS]
        if with_text:
            fields.append((F.col(c).cast("string") if slot != "v_text" else F.lit(None).cast("string")).alias("text"))
        fields.append(val.isNull().alias("is_null"))
        items.append(F.struct(*fields))
    pairs = df.select(F.explode(F.array(*items)).alias("p")).select("p.*")
    return pairs.where(~F.col("is_null")).drop("is_null")


def _column_names(cols: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("__i") + 1)


def exact_distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """column_name, n_distinct (non-null values), min_text, max_text (of text values), for all ``cols`` in one pass."""
    return (_pairs(df, cols).select("__i", *_SLOTS).distinct()
            .groupBy("__i").agg(F.count(F.lit(1)).alias("n_distinct"), F.min("v_text").alias("min_text"),
                                F.max("v_text").alias("max_text"))
            .select(_column_names(cols).alias("column_name"), "n_distinct", "min_text", "max_text"))


def profile(df: DataFrame, columns: list[str] | None = None, exact_distinct: bool = False,
            quantiles: list[float] | None = None, round_to: int | None = None) -> DataFrame:
    cols = columns or df.columns
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    var_aggs: list[Column] = []  # string min/max: variable-width buffers, kept apart
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs.append(F.count(x).alias(f"__nn{i}"))
        if _orderable(df, c) and not (exact_distinct and _is_text(df, c)):
            target = aggs if _fixed_width(df, c) else var_aggs
            target += [F.min(x).cast("string").alias(f"__min{i}"), F.max(x).cast("string").alias(f"__max{i}")]
        if _is_numeric(df, c):
            aggs += [F.avg(x).alias(f"__avg{i}"), F.stddev_samp(x).alias(f"__sd{i}")]
            if quantiles:
                aggs.append(F.percentile_approx(x.cast("double"), quantiles).alias(f"__q{i}"))
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(x).alias(f"__nd{i}"))
    one = df.agg(*aggs)
    if var_aggs:
        # A second one-row aggregate, attached as scalar subqueries (Catalyst
        # merges them into one subquery), so the main aggregate stays a
        # code-generated hash aggregate.
        var_row = df.agg(*var_aggs)
        packed = var_row.select(F.struct(*var_row.columns).alias("v")).scalar()
        one = one.select("*", packed.alias("__var")).select(
            "*", *[F.col("__var").getField(n).alias(n) for n in var_row.columns]).drop("__var")

    def has_bounds(c: str) -> bool:
        return _orderable(df, c) and not (exact_distinct and _is_text(df, c))

    def rnd(e: Column) -> Column:
        return F.round(e, round_to) if round_to is not None else e

    rows = []
    for i, c in enumerate(cols):
        nd = F.lit(None) if exact_distinct else F.col(f"__nd{i}")
        fields = [F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                  F.col("__rows").alias("n_rows"), (F.col("__rows") - F.col(f"__nn{i}")).alias("n_null"),
                  nd.cast("long").alias("n_distinct"),
                  (F.col(f"__min{i}") if has_bounds(c) else F.lit(None).cast("string")).alias("min_value"),
                  (F.col(f"__max{i}") if has_bounds(c) else F.lit(None).cast("string")).alias("max_value"),
                  (rnd(F.col(f"__avg{i}")) if _is_numeric(df, c) else F.lit(None).cast("double")).alias("mean"),
                  (rnd(F.col(f"__sd{i}")) if _is_numeric(df, c) else F.lit(None).cast("double")).alias("stddev")]
        if quantiles:
            fields.append((F.col(f"__q{i}") if _is_numeric(df, c)
                           else F.lit(None).cast("array<double>")).alias("quantiles"))
        rows.append(F.struct(*fields))
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if exact_distinct:
        counts = exact_distinct_counts(df, cols).withColumnRenamed("column_name", "__c")
        texts = [c for c in cols if _is_text(df, c)]
        out = (out.drop("n_distinct").join(counts, F.col("column_name") == F.col("__c"), "left")
               .withColumn("n_distinct", F.coalesce(F.col("n_distinct"), F.lit(0)).cast("long"))
               .withColumn("min_value", F.when(F.col("column_name").isin(texts), F.col("min_text")).otherwise(F.col("min_value")))
               .withColumn("max_value", F.when(F.col("column_name").isin(texts), F.col("max_text")).otherwise(F.col("max_value")))
               .select(*PROFILE_SCHEMA_COLUMNS, *(["quantiles"] if quantiles else [])))
    return out


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-null values of each column (ties: smaller
    value first): column_name, rank, value (as text), frequency.

    One scan for all columns: typed pairs are counted with partial
    aggregation; the rank filter keeps only k rows per column of each task
    before they meet (Spark's group limit).
    """
    cols = [c for c in columns or df.columns if _orderable(df, c)]
    counts = _pairs(df, cols, with_text=True).groupBy("__i", *_SLOTS, "text").agg(F.count(F.lit(1)).alias("frequency"))
    order = [F.desc("frequency"), *[F.asc(s) for s in _SLOTS]]
    rank = F.row_number().over(Window.partitionBy("__i").orderBy(*order))
    return (counts.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
            .select(_column_names(cols).alias("column_name"), "rank", F.coalesce("text", "v_text").alias("value"), "frequency"))


# ---- profiles that merge ------------------------------------------------------------

_BOUND = "struct<v_long: bigint, v_double: double, v_text: string, text: string>"


def _bound(df: DataFrame, c: str) -> Column:
    """A value such that comparing it compares cells of its column, with the cell's text."""
    slot, val = ("v_double", F.col(c).cast("double")) if df.schema[c].dataType.typeName() == "decimal" else _typed_slot(df, c)
    parts = [(val if s == slot else F.lit(None).cast("string" if s == "v_text" else s[2:])).alias(s) for s in _SLOTS]
    return F.struct(*parts, F.col(c).cast("string").alias("text"))


def profile_sketches(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with what a merged profile needs; one pass, one row out of each task."""
    cols = columns or df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x, some = F.col(c), F.col(c).isNotNull()
        aggs += [F.count(x).alias(f"__n{i}"), F.hll_sketch_agg(F.when(some, F.xxhash64(_typed_slot(df, c)[1]))).alias(f"__hll{i}")]
        if _orderable(df, c):
            cell = F.when(some, _bound(df, c))
            aggs += [F.min(cell).alias(f"__min{i}"), F.max(cell).alias(f"__max{i}")]
        if _is_numeric(df, c):
            v = x.cast("double")
            aggs += [F.avg(v).alias(f"__avg{i}"), F.var_pop(v).alias(f"__var{i}"), F.kll_sketch_agg_double(v).alias(f"__kll{i}")]
    one = df.agg(*aggs)

    def part(name: str, kind: str) -> Column:
        return (F.col(name) if name in one.columns else F.lit(None)).cast(kind)

    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                     F.col("__rows").alias("n_rows"), F.col(f"__n{i}").alias("n"), part(f"__min{i}", _BOUND).alias("least"),
                     part(f"__max{i}", _BOUND).alias("most"), part(f"__avg{i}", "double").alias("mean"),
                     (part(f"__var{i}", "double") * F.col(f"__n{i}")).alias("m2"), F.col(f"__hll{i}").alias("hll"),
                     part(f"__kll{i}", "binary").alias("kll")) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merge_profiles(sketches: DataFrame, quantiles: list[float] | None = None) -> DataFrame:
    """The profile of all parts whose ``profile_sketches`` rows are given (columns as ``profile``).

    A column that some parts lack counts the rows of the others.
    """
    moments = F.collect_list(F.when(F.col("n") > 0, F.struct(F.col("n").cast("double").alias("n"), "mean", "m2")))  # one per part
    g = sketches.groupBy("column_name").agg(
        F.max("data_type").alias("data_type"), F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.min("least").alias("least"),
        F.max("most").alias("most"), moments.alias("parts"), F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_double("kll").alias("kll"))

    def add(a: Column, b: Column) -> Column:
        n, d = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + d * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + d * d * a["n"] * b["n"] / n).alias("m2"))

    none = F.lit(None).cast("double")
    some = F.filter("parts", lambda p: p["mean"].isNotNull())
    whole = F.when(F.size(some) > 0, F.aggregate(F.slice(some, 2, F.greatest(F.size(some) - 1, F.lit(0))), F.element_at(some, 1), add))
    m = g.withColumn("m", whole)
    out = m.select(
        "column_name", "data_type", "n_rows", (F.col("n_rows") - F.col("n")).alias("n_null"), F.hll_sketch_estimate("hll").alias("n_distinct"),
        F.col("least.text").alias("min_value"), F.col("most.text").alias("max_value"), F.col("m.mean").alias("mean"),
        F.when(F.col("m.n") > 1, F.sqrt(F.col("m.m2") / (F.col("m.n") - 1))).otherwise(none).alias("stddev"),
        *([F.when(F.col("m.n") > 0, F.kll_sketch_get_quantile_double("kll", F.array(*[F.lit(float(q)) for q in quantiles]))).alias("quantiles")]
          if quantiles else []))
    return out
