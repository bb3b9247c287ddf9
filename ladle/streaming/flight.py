"""E6 single flight, batch form: a request starts a run only when no run
of its key is still going; a run lasts ``run_seconds``.

The greedy rule is a chain: the first request of a key starts; after a
start at ``t`` the next start is the first request at or after
``t + run``.  Computed exactly without handing a key to one task:

1. the requests are cut into chunks of contiguous time per key
   (``operators/positions``: sampled ranges, whatever the spread);
2. per chunk, where a chain leaves it depends only on the request it
   enters at.  The run before started no later than the chunk's first request,
   so a chain can only enter within one run of it: the chunk's map from entry
   time to exit time has one row per stretch of requests there that leave
   alike, and none for the rest of the chunk;
3. per key, these few rows are composed from chunk to chunk, which gives
   each chunk's entry time;
4. per chunk, the chain is followed from its entry and its starts marked.

Requests with equal times are told apart by the tie-break and a row
number: exactly one of them can start.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions.time import epoch_micros
from ladle.operators.joins import attach
from ladle.operators.positions import CHUNK, DEFAULT_CHUNK_ROWS, ROW_ID, chunked, materialized, with_row_id

NEVER = -(1 << 62)  # entry time of a key's first chunk


def _exits(t: np.ndarray, run: int) -> np.ndarray:
    """For each request of a sorted chunk, when a chain entering there is free again."""
    nxt = np.searchsorted(t, t + run).tolist()
    out = (t + run).tolist()
    for i in range(len(out) - 1, -1, -1):
        if nxt[i] < len(out):
            out[i] = out[nxt[i]]
    return np.array(out, np.int64)


def _exit_map(run: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.sort(pdf["__t"].to_numpy())
        out = _exits(t, run)
        last = np.append(out[1:] != out[:-1], True)  # the last request of each stretch
        last[np.flatnonzero(last & (t >= t[0] + run))[1:]] = False  # no chain enters behind the first of these
        return pd.DataFrame({"__key": pdf["__key"].iloc[0], CHUNK: pdf[CHUNK].iloc[0], "__upto": t[last], "__exit": out[last]})
    return work


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry time of each of a key's chunks."""
    free, out = NEVER, []
    for chunk, rows in pdf.sort_values([CHUNK, "__upto"]).groupby(CHUNK, sort=True):
        out.append((chunk, free))
        i = int(np.searchsorted(rows["__upto"].to_numpy(), free))
        if i < len(rows):
            free = int(rows["__exit"].iloc[i])
    return pd.DataFrame({"__key": pdf["__key"].iloc[0], CHUNK: [c for c, _ in out], "__entry": [e for _, e in out]})


def _mark(run: int, order: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        t = pdf["__t"].to_numpy()
        started = np.zeros(len(t), bool)
        i = int(np.searchsorted(t, pdf["__entry"].iloc[0]))
        while i < len(t):
            started[i] = True
            i = int(np.searchsorted(t, t[i] + run))
        return pd.DataFrame({ROW_ID: pdf[ROW_ID].to_numpy(), "started": started})
    return work


def single_flight(df: DataFrame, key: str, ts: str, run_seconds: float, tiebreak: str | None = None,
                  chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``df`` plus ``started`` (null when the request has no time)."""
    run = int(round(run_seconds * 1_000_000))
    if run <= 0:
        raise ValueError("a run takes some time")
    base = with_row_id(df)
    ties = [tiebreak] if tiebreak else []
    reqs = (base.where(F.col(ts).isNotNull())
            .select(F.col(key).alias("__key"), epoch_micros(df, ts).alias("__t"),
                    *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(ties)], ROW_ID))
    order = ["__t", *[f"__tie{i}" for i in range(len(ties))], ROW_ID]
    x, several = chunked(reqs, ["__key"], [F.col(c) for c in order], chunk_rows)
    if several:
        kind = df.schema[key].dataType.simpleString()
        maps = x.select("__key", CHUNK, "__t").groupBy("__key", CHUNK).applyInPandas(
            _exit_map(run), f"__key {kind}, {CHUNK} int, __upto long, __exit long")
        entries = materialized(maps.groupBy("__key").applyInPandas(_entries, f"__key {kind}, {CHUNK} int, __entry long"))
        x = attach(x, entries, ["__key", CHUNK])
    else:
        x = x.withColumn("__entry", F.lit(NEVER))
    marked = x.groupBy("__key", CHUNK).applyInPandas(_mark(run, order), f"{ROW_ID} long, started boolean")
    return base.join(marked, ROW_ID, "left").drop(ROW_ID)
