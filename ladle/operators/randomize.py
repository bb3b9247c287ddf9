"""T9 REPLACE_WITH_RANDOM_BETWEEN and T10 SHUFFLE_ROWS."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ladle.functions.hashing import hmac_pads, hmac_sha256, secret_scalars
from ladle.operators.joins import attach
from ladle.operators.positions import DEFAULT_CHUNK_ROWS, ROW_ID, positions_within, uniform_from_hex, with_row_id
from ladle.plans.recipe import RecipeError, as_list, same_columns, step


def stream_seed(seed: int, *place) -> int:
    """An own seed for each place (step, column), so their values are independent."""
    text = "|".join(str(x) for x in (seed, *place))
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:6], "big")


def random_between(c: Column, lower: int, upper: int, seed: int, key: Column | None = None) -> Column:
    """Uniform integer in [lower, upper] (both inclusive); null stays null.

    With ``key`` (a text that names the row) the value is drawn from the md5
    of seed and key, the same however the rows are partitioned; otherwise
    from ``rand(seed)``, the same for a retried task of the same split.
    """
    span = int(upper) - int(lower) + 1
    u = F.rand(seed) if key is None else uniform_from_hex(F.md5(F.concat(F.lit(f"random-{seed}|"), key)))
    r = F.floor(u * F.lit(span) + F.lit(int(lower))).cast("int")
    return F.when(c.isNotNull(), r)


def key_text(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in columns])


@step("REPLACE_WITH_RANDOM_BETWEEN", kind="expr", writes=same_columns)
def _random_step(df, ctx, sourceColumns, lowerBound, upperBound, **_):
    keys = ctx.options.get("random_key_columns")
    key = key_text(keys) if keys else None
    return {c: random_between(F.col(c), int(lowerBound), int(upperBound), stream_seed(ctx.seed, ctx.step_index, c), key)
            for c in as_list(sourceColumns)}


def _hashable(df: DataFrame, cols: list[str]) -> list:
    """Columns for xxhash64, which cannot hash maps: maps go in as JSON text."""
    return [F.to_json(F.col(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c) for c in cols]


def shuffle_rows(df: DataFrame, columns: list[str], group_by: list[str] | None = None,
                 seed: int = 42, key_columns: list[str] | None = None, secret: bytes | None = None,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Permute the values of ``columns`` (moving together) among the rows
    of each group (one global group when ``group_by`` is empty).

    The rest of each row is ranked in one pseudo-random order, the moved
    values in an independent one; position i of the first is paired with
    position i of the second: a uniformly random permutation per group.
    Both rankings are skew-proof (see ``positions``), and the final
    equi-join on (group, position) spreads even a huge group evenly.

    The input is materialized once with a row number.  So both sides come
    from the same rows even when the plan before holds random steps, and
    rows with equal content are told apart: equal values do not meet in one
    chunk.  The orders are hashes of the content and the row number.

    With ``key_columns`` the orders are HMAC-SHA-256 of the key under
    ``secret``, which whoever has the secret can reproduce with any SQL
    engine, and nobody else can undo.
    """
    group_by = list(group_by or [])
    columns = list(columns)
    rest = [c for c in df.columns if c not in columns and c not in group_by]
    spark = df.sparkSession
    if key_columns:
        if not secret:
            raise RecipeError("SHUFFLE_ROWS: key columns need a secret")
        s = secret_scalars(spark, **dict(zip(("ipad", "opad"), hmac_pads(secret))))
        h_rest, h_vals = (F.lower(F.hex(hmac_sha256(F.concat(F.lit(f"{side}|"), key_text(key_columns)), s["ipad"], s["opad"])))
                          for side in ("slot", "value"))
    else:
        h_rest = F.xxhash64(F.lit(seed), *_hashable(df, group_by + rest))
        h_vals = F.xxhash64(F.lit(seed + 1), *_hashable(df, group_by + columns))
    base = with_row_id(df.withColumns({"__h_rest": h_rest, "__h_vals": h_vals}))

    def ranked(own: list[str], h: str) -> DataFrame:
        side = base.select(*group_by, *own, F.col(h).alias("__h"), ROW_ID)
        tie = F.xxhash64(F.lit(f"{seed}{h}"), F.col(ROW_ID))
        return positions_within(side, group_by, [F.col("__h"), tie, F.col(ROW_ID)], "__pos", chunk_rows).drop("__h", ROW_ID)

    vals = ranked(columns, "__h_vals").select(*group_by, "__pos", *columns)
    out = attach(ranked(rest, "__h_rest"), vals, group_by + ["__pos"], how="inner")
    return out.select(*df.columns)


@step("SHUFFLE_ROWS", writes=same_columns,
      reads=lambda p: as_list(p.get("sourceColumns")) + as_list(p.get("groupByColumns")))
def _shuffle_step(df, ctx, sourceColumns, groupByColumns=None, **_):
    secret = ctx.options.get("shuffle_secret_id")
    return shuffle_rows(df, as_list(sourceColumns), as_list(groupByColumns), stream_seed(ctx.seed, ctx.step_index),
                        ctx.options.get("shuffle_key_columns"), ctx.secret(secret) if secret else None,
                        ctx.options.get("chunk_rows", DEFAULT_CHUNK_ROWS))
