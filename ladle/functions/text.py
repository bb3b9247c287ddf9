"""Small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_location(loc: Column) -> tuple[Column, Column, Column]:
    """Split ``bucket/key`` at the first ``/``.

    Returns (bucket, key, is_valid).  A value without ``/`` yields null
    parts and ``is_valid = false`` instead of failing the job.
    """
    pat = r"^([^/]*)/(.*)$"
    ok = loc.rlike(pat)
    bucket = F.when(ok, F.regexp_extract(loc, pat, 1))
    key = F.when(ok, F.regexp_extract(loc, pat, 2))
    return bucket, key, F.coalesce(ok, F.lit(False))


def message(template: str, *args: Column) -> Column:
    """Fill ``{}`` placeholders in order (C3); null arguments print as 'null'."""
    fmt = template.replace("%", "%%").replace("{}", "%s")
    return F.format_string(fmt, *[F.coalesce(a.cast("string"), F.lit("null")) for a in args])
