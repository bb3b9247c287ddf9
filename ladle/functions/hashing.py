"""Keyed hashing out of Spark built-ins (no Python in the row path).

HMAC-SHA-256 (RFC 2104): H((K ^ opad) || H((K ^ ipad) || m)).  The two
padded keys are computed once on the driver; each row costs two
``sha2`` calls inside whole-stage codegen.  The padded keys are held in
a one-row DataFrame and referenced as scalar subqueries, so the key
bytes do not appear as literals in the query plan or event log.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BLOCK = 64


def hmac_pads(key: bytes) -> tuple[bytes, bytes]:
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK, b"\x00")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def secret_scalars(spark: SparkSession, **values: bytes) -> dict[str, Column]:
    """Binary constants as scalar subqueries over a one-row local frame."""
    names = list(values)
    row = tuple(bytearray(values[n]) for n in names)
    frame = spark.createDataFrame([row], "struct<" + ",".join(f"{n}:binary" for n in names) + ">")
    return {n: frame.select(n).scalar() for n in names}


def hmac_sha256(msg: Column, ipad: Column, opad: Column) -> Column:
    """Raw 32-byte HMAC of ``msg`` (string is taken as UTF-8; binary as is)."""
    inner = F.unhex(F.sha2(F.concat(ipad, msg.cast("binary")), 256))
    return F.unhex(F.sha2(F.concat(opad, inner), 256))


def b64(c: Column) -> Column:
    """base64 without MIME line breaks (Spark may chunk at 76 characters)."""
    return F.regexp_replace(F.base64(c), r"[\r\n]", "")
