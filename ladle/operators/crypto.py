"""T11 DETERMINISTIC_ENCRYPT, T12 ENCRYPT, T13 CRYPTOGRAPHIC_HASH, T14 entity filter.

All of it is built-in expressions (``aes_encrypt``, ``sha2``, ``base64``)
evaluated inside whole-stage codegen; key bytes reach the plan only as
scalar subqueries over a one-row local frame.

Ciphertext envelope (base64 of): version byte (1 = deterministic,
2 = random), 2-byte big-endian length + key id, 2-byte length + key
fingerprint, then the AES-GCM output (12-byte IV, ciphertext, 16-byte tag).
Deterministic mode derives the IV from an HMAC of the plaintext, so equal
inputs give equal ciphertexts (joinable) and every value still decrypts.
"""

from __future__ import annotations

import hashlib
import hmac as _hmac
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.hashing import b64, hmac_pads, hmac_sha256, secret_scalars
from ladle.functions.patterns import CHECKSUM_ENTITIES, ENTITY_FULL, any_entity, expand_entities, luhn_valid
from ladle.operators.entities import contains_entity
from ladle.plans.recipe import as_list, same_columns, step

DETERMINISTIC, RANDOM = 1, 2


def _derive(master: bytes, label: str) -> bytes:
    return _hmac.new(master, label.encode(), hashlib.sha256).digest()


def _fingerprint(master: bytes) -> bytes:
    return hashlib.sha256(b"ladle-key-fingerprint" + master).hexdigest()[:32].encode()


def _header(version: int, key_id: str, master: bytes) -> bytes:
    kid, fp = key_id.encode(), _fingerprint(master)
    return bytes([version]) + len(kid).to_bytes(2, "big") + kid + len(fp).to_bytes(2, "big") + fp


def encrypt(spark: SparkSession, c: Column, key_id: str, master: bytes, deterministic: bool) -> Column:
    enc_key = _derive(master, "ladle-enc")
    header = _header(DETERMINISTIC if deterministic else RANDOM, key_id, master)
    names = {"k": enc_key, "hdr": header}
    if deterministic:
        ipad, opad = hmac_pads(_derive(master, "ladle-iv"))
        names.update(ipad=ipad, opad=opad)
    s = secret_scalars(spark, **names)
    text = c.cast("string")
    if deterministic:
        iv = F.substring(hmac_sha256(text, s["ipad"], s["opad"]), 1, 12)
        ct = F.aes_encrypt(text.cast("binary"), s["k"], F.lit("GCM"), F.lit("DEFAULT"), iv)
    else:
        # aes_encrypt's own random IV counts as deterministic to Catalyst, so a
        # column read twice downstream could be encrypted twice (two different
        # ciphertexts in one row).  An IV from uuid() -- nondeterministic to
        # the optimizer, seeded per query and partition -- keeps it to one
        # evaluation per row, and a retried task reproduces the same bytes.
        iv = F.substring(F.unhex(F.sha2(F.expr("uuid()"), 256)), 1, 12)
        ct = F.aes_encrypt(text.cast("binary"), s["k"], F.lit("GCM"), F.lit("DEFAULT"), iv)
    return F.when(c.isNotNull(), b64(F.concat(s["hdr"], ct)))


def decrypt(spark: SparkSession, c: Column, master: bytes) -> Column:
    """Inverse of ``encrypt`` for either mode (for key holders and tests)."""
    s = secret_scalars(spark, k=_derive(master, "ladle-enc"))
    b = F.unbase64(c)
    id_len = F.conv(F.hex(F.substring(b, 2, 2)), 16, 10).cast("int")
    ver_len = F.conv(F.hex(F.substr(b, id_len + 4, F.lit(2))), 16, 10).cast("int")
    payload = F.substr(b, id_len + ver_len + 6, F.length(b))
    return F.try_aes_decrypt(payload, s["k"], F.lit("GCM")).cast("string")  # bad value -> null, job goes on


def decrypt_ring(spark: SparkSession, c: Column, ring: dict[str, list[bytes]]) -> Column:
    """Inverse of ``encrypt`` where values were encrypted under several keys.

    ``ring`` has the versions of each key id.  The key is chosen per row by the
    id and fingerprint that the envelope carries, so a column whose key was
    rotated decrypts in one pass.  A value of an unknown key, or one that is no
    envelope or was changed, gives null.
    """
    versions = [(key_id, master) for key_id, masters in ring.items() for master in masters]
    if not versions:
        return F.lit(None).cast("string")
    s = secret_scalars(spark, **{f"k{i}": _derive(master, "ladle-enc") for i, (_, master) in enumerate(versions)})
    b = F.try_to_binary(c, F.lit("base64"))
    id_len = F.conv(F.hex(F.substring(b, 2, 2)), 16, 10).cast("int")
    ver_len = F.conv(F.hex(F.substr(b, id_len + 4, F.lit(2))), 16, 10).cast("int")
    named = F.hex(F.substr(b, F.lit(2), id_len + ver_len + 4))  # key id and fingerprint with their lengths
    key = F.lit(None).cast("binary")
    for i, (key_id, master) in enumerate(versions):
        key = F.when(named == F.lit(_header(RANDOM, key_id, master)[1:].hex().upper()), s[f"k{i}"]).otherwise(key)
    known = F.substring(b, 1, 1).isin(F.lit(bytes([DETERMINISTIC])), F.lit(bytes([RANDOM]))) & key.isNotNull()
    payload = F.substr(b, id_len + ver_len + 6, F.length(b))
    return F.when(known, F.try_aes_decrypt(payload, key, F.lit("GCM")).cast("string"))


def keyed_hash(spark: SparkSession, c: Column, key: bytes) -> Column:
    """base64(HMAC-SHA-256(key, value)): 44 characters, 32 bytes."""
    ipad, opad = hmac_pads(key)
    s = secret_scalars(spark, ipad=ipad, opad=opad)
    return b64(hmac_sha256(c.cast("string"), s["ipad"], s["opad"]))


def keyed_hash_entities(spark: SparkSession, c: Column, key: bytes, entities: list[str]) -> Column:
    """Hash only what is one of ``entities``.

    A cell whose whole trimmed value is such an entity is hashed, others
    pass unchanged.  For occurrences inside free text use
    ``hash_entities_within`` (a frame-level step).
    """
    ents = expand_entities(entities)
    ipad, opad = hmac_pads(key)
    text = c.cast("string")
    s = secret_scalars(spark, ipad=ipad, opad=opad)
    value = F.trim(text)
    is_entity = reduce(lambda a, b: a | b, [
        value.rlike(ENTITY_FULL[e]) & (luhn_valid(value) if e in CHECKSUM_ENTITIES else F.lit(True))
        for e in ents])
    return F.when(is_entity,
                  b64(hmac_sha256(text, s["ipad"], s["opad"]))).otherwise(text)


def hash_entities_within(df: DataFrame, column: str, key: bytes, entities: list[str]) -> DataFrame:
    """Replace every occurrence of ``entities`` inside free text by its keyed hash.

    By place: the text is cut at the matches of one pattern for all
    entities, and the pieces are joined again with each match's hash between
    them.  So a match is never replaced inside a longer one, and neighbours
    are all replaced.  A card-like number without a valid checksum stays.

    A lambda may not hold a subquery, so the HMAC pads are first attached
    as columns (scalar subqueries over a one-row frame, evaluated once)
    and the lambda refers to those columns; key bytes stay out of the plan.
    Texts without a possible match skip the extraction entirely.
    """
    ents = expand_entities(entities)
    ipad, opad = hmac_pads(key)
    s = secret_scalars(df.sparkSession, ipad=ipad, opad=opad)
    text, find = F.col(column).cast("string"), any_entity(ents)
    ip, op = F.col("__ladle_ipad"), F.col("__ladle_opad")

    def hashed(m: Column) -> Column:
        out = b64(hmac_sha256(m, ip, op))
        for e in CHECKSUM_ENTITIES:
            if e in ents:
                out = F.when(m.rlike(ENTITY_FULL[e]) & ~luhn_valid(m), m).otherwise(out)
        return out

    between = F.split(text, find, -1)
    found = F.transform(F.regexp_extract_all(text, F.lit(find), F.lit(0)), hashed)
    joined = F.array_join(F.zip_with(between, found, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), "")
    possible = reduce(lambda a, b: a | b, [contains_entity(text, e) for e in ents])
    return (df.withColumns({"__ladle_ipad": s["ipad"], "__ladle_opad": s["opad"]})
            .withColumn(column, F.when(possible, joined).otherwise(text))
            .drop("__ladle_ipad", "__ladle_opad"))


@step("DETERMINISTIC_ENCRYPT", kind="expr", writes=same_columns)
def _det_encrypt_step(df, ctx, sourceColumns, secretId, **_):
    master = ctx.secret(secretId)
    return {c: encrypt(df.sparkSession, F.col(c), secretId, master, True) for c in as_list(sourceColumns)}


@step("ENCRYPT", kind="expr", writes=same_columns)
def _encrypt_step(df, ctx, sourceColumns, kmsKeyArn=None, secretId=None, **_):
    key_id = kmsKeyArn or secretId
    master = ctx.secret(key_id)
    return {c: encrypt(df.sparkSession, F.col(c), key_id, master, False) for c in as_list(sourceColumns)}


@step("CRYPTOGRAPHIC_HASH", writes=same_columns, kinds={"entityTypeFilter": "list"})
def _hash_step(df, ctx, sourceColumns, secretId, entityTypeFilter=None, **_):
    key = ctx.secret(secretId)
    spark = df.sparkSession
    if entityTypeFilter and ctx.options.get("hash_within_text", False):
        for c in as_list(sourceColumns):
            df = hash_entities_within(df, c, key, as_list(entityTypeFilter))
        return df
    if entityTypeFilter:
        return df.withColumns({c: keyed_hash_entities(spark, F.col(c), key, as_list(entityTypeFilter))
                               for c in as_list(sourceColumns)})
    return df.withColumns({c: keyed_hash(spark, F.col(c), key) for c in as_list(sourceColumns)})
