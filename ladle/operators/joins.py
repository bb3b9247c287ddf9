"""Join helpers shared by the operators.

``attach`` adds per-key columns from a keyed table to a big frame; keys
are compared null-safe, because ``groupBy`` keeps null as a group.

``attach_checked`` is the size-checked broadcast.  Waiting for AQE is not
enough: when the small side is only known to be small at run time, AQE
starts both shuffle stages at once, so the big side is shuffled even if
the join then becomes a broadcast join.  Here the small side (an
aggregate of the big frame) is written once as a reliable checkpoint in
``spark.checkpoint.dir`` and its bytes are measured; at most
``BROADCAST_MAX_BYTES`` -> broadcast hash join, the big side is never
shuffled; more -> a sort-merge join, where AQE splits a hot key's partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What one executor holds of a broadcast table, by measured bytes.
BROADCAST_MAX_BYTES = 64 << 20
_FIXED = ("byte", "short", "integer", "long", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")


def keyed(df: DataFrame, keys: list[str], prefix: str = "__k") -> tuple[DataFrame, list[str]]:
    """Rename ``keys`` to fresh names so a self-derived table can be joined back."""
    alias = [f"{prefix}{i}" for i in range(len(keys))]
    out = df.select(*[F.col(k).alias(a) for k, a in zip(keys, alias)],
                    *[c for c in df.columns if c not in keys])
    return out, alias


def attach(big: DataFrame, table: DataFrame, keys: list[str], how: str = "left",
           broadcast: bool = False) -> DataFrame:
    """``big`` joined with ``table`` on ``keys`` (null-safe); key columns of ``table`` dropped."""
    tbl, alias = keyed(table, keys)
    if broadcast:
        tbl = F.broadcast(tbl)
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(a)) for k, a in zip(keys, alias)]) if keys else F.lit(True)
    return big.join(tbl, cond, how).drop(*alias)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: 16 per fixed-width value, the text length else."""
    def one(name: str) -> Column:
        t = df.schema[name].dataType.typeName()
        if t in _FIXED or t == "decimal":
            return F.lit(16)
        text = F.col(name) if t in ("string", "binary") else F.to_json(F.struct(F.col(name)))
        return F.coalesce(F.octet_length(text), F.lit(0)) + 16
    return reduce(lambda a, b: a + b, [one(c) for c in df.columns])


def checked(table: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Materialize ``table`` (reliable checkpoint) and report whether its bytes are few."""
    from ladle.session import checkpoint_root
    checkpoint_root(table.sparkSession)
    t = table.checkpoint(eager=True)
    size = t.agg(F.sum(row_bytes(t).cast("long"))).first()[0] or 0
    return t, size <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)


def attach_checked(big: DataFrame, table: DataFrame, keys: list[str], how: str = "left",
                   max_bytes: int | None = None) -> DataFrame:
    t, small = checked(table, max_bytes)
    return attach(big, t, keys, how, broadcast=small)
