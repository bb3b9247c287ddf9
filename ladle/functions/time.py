"""Time helpers (C2, C4) and the recipe date-pattern dialect."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
LEDGER_TTL_DAYS = 7  # fixed value: a run ledger entry expires after 7 days


def expiry_epoch(ts: Column, days: int = LEDGER_TTL_DAYS) -> Column:
    """Epoch seconds of ``ts`` plus ``days``."""
    return F.unix_timestamp(ts.cast("timestamp")) + F.lit(days * SECONDS_PER_DAY)


def iso_text(ts: Column) -> Column:
    """Fixed-width UTC ISO-8601 text with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


_ISO_FORM = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d{1,9})?(Z|[+-]\d\d:\d\d)?$"


def parse_iso(text: Column) -> Column:
    """ISO-8601 text -> timestamp (C4): compare parsed times, not strings.  A text without a zone is UTC."""
    zoned = text.endswith("Z") | F.substring(text, -6, 1).isin("+", "-")
    return F.when(text.rlike(_ISO_FORM), F.when(zoned, text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp"))


def recipe_pattern(fmt: str) -> tuple[str, bool]:
    """Translate the recipe date dialect into a Spark datetime pattern.

    In the recipe dialect ``mm`` in the date half is the month and ``MM``
    in the time half is the minute; ``SS`` is seconds.  ``*`` stands for
    one separator character.  Returns (pattern, has_star); the time half
    becomes an optional section so a bare date still parses.
    """
    cut = re.search(r"[Hh]", fmt)
    date_half, time_half = (fmt[:cut.start()], fmt[cut.start():]) if cut else (fmt, "")
    date_half = date_half.replace("mm", "MM").replace("DD", "dd").replace("YYYY", "yyyy")
    time_half = time_half.replace("MM", "mm").replace("SS", "ss")
    has_star = "*" in date_half or "*" in time_half
    sep = ""
    if date_half and date_half[-1] in "*T -_/":
        sep, date_half = date_half[-1], date_half[:-1]
    date_half = date_half.replace("*", " ")
    sep = " " if sep == "*" else sep
    if time_half:
        pattern = f"{date_half}[{_quote(sep)}{time_half}]"
    else:
        pattern = date_half
    return pattern, has_star


def _quote(sep: str) -> str:
    return f"'{sep}'" if sep and sep.isalpha() else sep


def parse_with_recipe_pattern(c: Column, fmt: str) -> Column:
    pattern, has_star = recipe_pattern(fmt)
    text = c.cast("string")
    if has_star:
        text = F.regexp_replace(text, r"^(\d{4}\D\d{1,2}\D\d{1,2})[T* ]", "$1 ")
    return F.try_to_timestamp(F.trim(text), F.lit(pattern))


_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_micros(df, name: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone.

    ``TIMESTAMP`` (an instant) uses ``unix_micros``; ``TIMESTAMP_NTZ`` (a
    wall-clock value, read as UTC) uses a wall-clock difference, so no
    time-zone rule (or daylight-saving fold) can reorder values.
    """
    t = df.schema[name].dataType.typeName()
    c = F.col(name)
    if t == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)")
    if t == "date":
        return F.unix_date(c).cast("long") * F.lit(86_400_000_000)
    return F.unix_micros(c.cast("timestamp"))


def epoch_seconds(df, name: str) -> Column:
    return F.floor(epoch_micros(df, name) / F.lit(1_000_000)).cast("long")


def iso_micros(text: Column) -> Column:
    """ISO-8601 text -> epoch microseconds (an instant; null when unparseable).

    A long aggregates in a code-generated hash aggregate, text does not."""
    return F.unix_micros(parse_iso(text))


def iso_from_micros(us: Column) -> Column:
    """Epoch microseconds -> fixed-width UTC ISO text, time-zone independent."""
    wall = F.expr(f"timestampadd(MICROSECOND, 0, {_EPOCH_NTZ})")
    return F.date_format(F.timestamp_add("MICROSECOND", us, wall), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
