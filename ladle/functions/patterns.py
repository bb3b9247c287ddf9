"""Personal-data patterns (F3, T14), in Java's regular expressions.

Boundaries are look-arounds: they consume nothing, so entities that stand
next to each other are all found.
"""

from __future__ import annotations

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# The entity types we detect and their patterns, without
# boundaries, in the order in which they are tried at one place.
ENTITY_CORE = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "IP_ADDRESS": rf"(?:{_OCTET}\.){{3}}{_OCTET}",
    "CREDIT_CARD": r"(?:(?:\d{4}[ -]?){3}\d{4}|\d{4}[ -]?\d{6}[ -]?\d{5})",
    "SSN": r"\d{3}-\d{2}-\d{4}",
    "PHONE_NUMBER": r"(?:\+?1[ .-]?)?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}",
}
_BEFORE = {"EMAIL": r"(?<![A-Za-z0-9._%+-])", "IP_ADDRESS": r"(?<!\d)(?<!\d\.)"}
_AFTER = {"EMAIL": r"(?![A-Za-z0-9])", "IP_ADDRESS": r"(?!\d)(?!\.\d)"}

# Anywhere in a text (the whole match is the entity), and as a whole value.
# Digits inside a longer run of letters and digits (a hash, a serial number) are none.
ENTITY_FIND = {e: _BEFORE.get(e, r"(?<![0-9A-Za-z])") + p + _AFTER.get(e, r"(?![0-9A-Za-z])") for e, p in ENTITY_CORE.items()}
ENTITY_FULL = {e: f"^{p}$" for e, p in ENTITY_CORE.items()}

# Necessary conditions checked first: a cheap scan that every match implies,
# so the full pattern only runs on texts that can contain the entity.
ENTITY_PREFILTER = {
    "EMAIL": "@",                 # a literal that every match contains
    "PHONE_NUMBER": r"\d\d\d",    # regex: three digits in a row
    "SSN": r"\d\d\d",
    "CREDIT_CARD": r"\d\d\d",
    "IP_ADDRESS": r"\d\.\d",
}

# Entities whose matches must also pass a checksum (see ``luhn_valid``).
CHECKSUM_ENTITIES = ("CREDIT_CARD",)

# The entity set named in profile configuration expands to all of the above.
ENTITY_SETS = {"USA_ALL": list(ENTITY_CORE)}


def expand_entities(names: list[str] | None) -> list[str]:
    out: list[str] = []
    for n in names or ["USA_ALL"]:
        for e in ENTITY_SETS.get(n.upper(), [n.upper()]):
            if e not in ENTITY_CORE:
                raise ValueError(f"unknown entity type {n!r}")
            if e not in out:
                out.append(e)
    return out


def any_entity(entities: list[str]) -> str:
    """One pattern for all of ``entities``: the leftmost is found, at one place the first in the table's order."""
    return "|".join(ENTITY_FIND[e] for e in ENTITY_CORE if e in entities)


def luhn_valid(value):
    """Luhn checksum of the digits in ``value`` (a Column), with built-in
    higher-order functions: double every second digit from the right,
    subtract 9 above 9, the sum must end in 0."""
    from pyspark.sql import functions as F
    digits = F.reverse(F.regexp_extract_all(value, F.lit(r"(\d)"), 1))
    vals = F.transform(digits, lambda d, i: F.when(i % 2 == 1, F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9)
                                                   .otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    total = F.aggregate(vals, F.lit(0), lambda acc, x: acc + x)
    return (F.size(digits) > 0) & (total % 10 == 0)
