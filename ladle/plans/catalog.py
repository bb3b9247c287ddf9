"""Registered queries: each reads the driver tables and runs one library
operator over the whole table.  ``ORACLES`` holds the equivalent SQL for
an independent engine (tables registered as views under their names).

Column names and types are aligned on both sides; doubles that depend on
summation order are rounded on both sides.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.hashing import hmac_pads
from ladle.operators.randomize import stream_seed
from ladle.plans.recipe import RecipeContext, apply_recipe

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Fixed demonstration key material for the registered queries.  Real runs
# pass keys fetched from the caller's secret store in RecipeContext.
DEMO_KEY_ID = "demo-transform-secret"
DEMO_KEY = bytes(range(32))
SEED = 42


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def act(op: str, **params) -> dict:
    """One recipe action with every parameter encoded as text, as in recipe files."""
    enc = {k: (v if isinstance(v, str) else json.dumps(v)) for k, v in params.items()}
    return {"Action": {"Operation": op, "Parameters": enc}}


def _ctx(**kw) -> RecipeContext:
    return RecipeContext(secrets={DEMO_KEY_ID: DEMO_KEY}, seed=SEED, **kw)


def _hex(b: bytes) -> str:
    return b.hex().upper()


def _sql_hmac(expr: str, key: bytes = DEMO_KEY) -> str:
    """Lower-case hex."""
    ipad, opad = hmac_pads(key)
    inner = f"unhex(sha256(unhex('{_hex(ipad)}') || encode({expr})))"
    return f"sha256(unhex('{_hex(opad)}') || {inner})"


def _sql_hmac_b64(expr: str, key: bytes = DEMO_KEY) -> str:
    return f"to_base64(unhex({_sql_hmac(expr, key)}))"


# ---------------------------------------------------------------- T1
@query("fill_most_frequent", """
WITH src AS (SELECT c_custkey, NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer),
m AS (SELECT c_mktsegment FROM src WHERE c_mktsegment IS NOT NULL
      GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT c_custkey, COALESCE(src.c_mktsegment, (SELECT c_mktsegment FROM m)) AS c_mktsegment FROM src
""")
def fill_most_frequent(spark, sf):
    src = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    return apply_recipe(src, [act("FILL_WITH_MOST_FREQUENT", sourceColumn="c_mktsegment")], _ctx())


# ---------------------------------------------------------------- T2 (+P2)
@query("year_column", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_YEAR FROM orders
""")
def year_column(spark, sf):
    src = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    out = apply_recipe(src, [act("YEAR", dateTimeFormat="yyyy-mm-dd*HH:MM:SS", functionStepType="YEAR",
                                 sourceColumn="o_orderdate", targetColumn="o_orderdate_YEAR")], _ctx())
    return out.select("o_orderkey", "o_orderdate_YEAR")


# ---------------------------------------------------------------- T3
@query("flag_pattern", """
SELECT event_id, event_type, regexp_matches(event_type, 'err|sign') AS event_type_flagged FROM events
""")
def flag_pattern(spark, sf):
    src = table(spark, sf, "events").select("event_id", "event_type")
    return apply_recipe(src, [act("FLAG_COLUMN_FROM_PATTERN", pattern="err|sign", sourceColumn="event_type",
                                  targetColumn="event_type_flagged")], _ctx())


@query("flag_class_pattern", """
SELECT event_id, event_type, regexp_matches(event_type, '[ep][a-z]+(or|ase)') AS by_class,
       regexp_matches(event_type, '(cli|vi)[a-z]{2}') AS by_group,
       CASE WHEN event_type IN ('error', 'view') THEN event_type ELSE 'True' END AS as_word,
       CASE WHEN event_type = 'click' THEN 'a click' ELSE '[x]' END AS as_mark FROM events
""")
def flag_class_pattern(spark, sf):
    """Patterns and replacement values that begin like JSON or read like a boolean stay text."""
    src = table(spark, sf, "events").select("event_id", "event_type")
    flag = lambda pattern, to: act("FLAG_COLUMN_FROM_PATTERN", pattern=pattern, sourceColumn="event_type", targetColumn=to)
    mapped = lambda to, other, **m: act("CATEGORICAL_MAPPING", categoryMap=m, other=other, sourceColumn="event_type",
                                        targetColumn=to, deleteOtherRows="false")
    return apply_recipe(src, [flag("[ep][a-z]+(or|ase)", "by_class"), flag("(cli|vi)[a-z]{2}", "by_group"),
                              mapped("as_word", "True", error="error", view="view"), mapped("as_mark", "[x]", click="a click")], _ctx())


# ---------------------------------------------------------------- T4 / T5
_GROUP_OPTS = [
    {"sourceColumnName": "c_custkey", "targetColumnName": "n_customers", "functionName": "COUNT"},
    {"sourceColumnName": "c_acctbal", "targetColumnName": "max_acctbal", "functionName": "MAX"},
    {"sourceColumnName": "c_acctbal", "targetColumnName": "min_acctbal", "functionName": "MIN"},
    {"sourceColumnName": "c_nationkey", "targetColumnName": "n_nations", "functionName": "COUNT_DISTINCT"},
]


@query("group_new_frame", """
SELECT c_mktsegment, count(c_custkey) AS n_customers, max(c_acctbal) AS max_acctbal,
       min(c_acctbal) AS min_acctbal, count(DISTINCT c_nationkey) AS n_nations
FROM customer GROUP BY c_mktsegment
""")
def group_new_frame(spark, sf):
    src = table(spark, sf, "customer")
    return apply_recipe(src, [act("GROUP_BY", groupByAggFunctionOptions=_GROUP_OPTS,
                                  sourceColumns=["c_mktsegment"], useNewDataFrame="true")], _ctx())


@query("group_append", """
SELECT c_custkey, c_nationkey, c_mktsegment,
       CAST(count(c_custkey) OVER (PARTITION BY c_nationkey) AS VARCHAR) AS c_count
FROM customer
""")
def group_append(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    opts = [{"sourceColumnName": "c_custkey", "targetColumnName": "c_count",
             "targetColumnDataType": "string", "functionName": "COUNT"}]
    return apply_recipe(src, [act("GROUP_BY", groupByAggFunctionOptions=opts, sourceColumns=["c_nationkey"],
                                  useNewDataFrame="false")], _ctx())


# ---------------------------------------------------------------- T6 / P7 / A6
_TYPE_MAP = {"ECONOMY": "budget", "STANDARD": "regular", "PROMO": "promo"}


@query("categorical_map", """
SELECT p_partkey, p_type,
       CASE p_type WHEN 'ECONOMY' THEN 'budget' WHEN 'STANDARD' THEN 'regular'
                   WHEN 'PROMO' THEN 'promo' ELSE 'Others' END AS p_type_mapped
FROM part
""")
def categorical_map(spark, sf):
    src = table(spark, sf, "part").select("p_partkey", "p_type")
    return apply_recipe(src, [act("CATEGORICAL_MAPPING", categoryMap=_TYPE_MAP, deleteOtherRows="false",
                                  mapType="TEXT", mappingOption="TOP_X_VALUES", other="Others",
                                  sourceColumn="p_type", targetColumn="p_type_mapped")], _ctx())


@query("categorical_delete_other", """
SELECT p_partkey, p_type,
       CASE p_type WHEN 'ECONOMY' THEN 'budget' WHEN 'STANDARD' THEN 'regular'
                   WHEN 'PROMO' THEN 'promo' END AS p_type_mapped
FROM part WHERE p_type IN ('ECONOMY', 'STANDARD', 'PROMO')
""")
def categorical_delete_other(spark, sf):
    src = table(spark, sf, "part").select("p_partkey", "p_type")
    return apply_recipe(src, [act("CATEGORICAL_MAPPING", categoryMap=_TYPE_MAP, deleteOtherRows="true",
                                  mapType="TEXT", other="Others", sourceColumn="p_type",
                                  targetColumn="p_type_mapped")], _ctx())


@query("categorical_topx", """
WITH top AS (SELECT p_brand FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
             ORDER BY count(*) DESC, p_brand LIMIT 5)
SELECT p_partkey, p.p_brand,
       CASE WHEN t.p_brand IS NOT NULL THEN p.p_brand ELSE 'Other' END AS p_brand_mapped
FROM part p LEFT JOIN top t ON p.p_brand = t.p_brand
""")
def categorical_topx(spark, sf):
    src = table(spark, sf, "part").select("p_partkey", "p_brand")
    return apply_recipe(src, [act("CATEGORICAL_MAPPING", topX="5", other="Other", sourceColumn="p_brand",
                                  targetColumn="p_brand_mapped")], _ctx())


# ---------------------------------------------------------------- T7
@query("mask_range", """
SELECT c_custkey, concat(repeat('#', least(5, length(c_name))), substr(c_name, 6)) AS c_name FROM customer
""")
def mask_range(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", "c_name")
    return apply_recipe(src, [act("MASK_RANGE", alphabet=["WHITESPACE", "SYMBOLS"], firstN="5",
                                  maskMode="MASK_FIRST_N", maskSymbol="#", sourceColumns=["c_name"],
                                  stop="5")], _ctx())


# ---------------------------------------------------------------- T8
_MASK_DATE = act("MASK_DATE", locale="en", maskSymbol="#", redact=["YEAR", "DAY"],
                 sourceColumns=["o_orderdate"])


@query("mask_date", """
SELECT o_orderkey, '####/' || strftime(o_orderdate, '%m') || '/##' AS o_orderdate FROM orders
""")
def mask_date(spark, sf):
    src = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return apply_recipe(src, [_MASK_DATE], _ctx())


@query("mask_date_compat", """
SELECT o_orderkey,
       CASE WHEN day(o_orderdate) <= 12 THEN '####/##/' || strftime(o_orderdate, '%d')
            ELSE '####/' || strftime(o_orderdate, '%m') || '/##' END AS o_orderdate
FROM orders
""")
def mask_date_compat(spark, sf):
    src = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    return apply_recipe(src, [_MASK_DATE], _ctx(day_first_when_ambiguous=True))


# ---------------------------------------------------------------- T9
_RANDOM_SEED = stream_seed(SEED, 0, "p_size")


@query("random_between", f"""
SELECT p_partkey, CAST(floor(CAST('0x' || substr(md5('random-{_RANDOM_SEED}|' || CAST(p_partkey AS VARCHAR)), 1, 13) AS BIGINT)
                            / 4503599627370496.0 * 50 + 1) AS INTEGER) AS p_size FROM part
""")
def random_between(spark, sf):
    src = table(spark, sf, "part").select("p_partkey", "p_size")
    return apply_recipe(src, [act("REPLACE_WITH_RANDOM_BETWEEN", lowerBound="1", upperBound="50", sourceColumns=["p_size"])],
                        _ctx(options={"random_key_columns": ["p_partkey"]}))


# ---------------------------------------------------------------- T10 / A8
@query("shuffle_rows", f"""
WITH slots AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY {_sql_hmac("'slot|' || CAST(c_custkey AS VARCHAR)")}) AS pos
  FROM customer),
vals AS (
  SELECT c_nationkey, c_acctbal,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY {_sql_hmac("'value|' || CAST(c_custkey AS VARCHAR)")}) AS pos
  FROM customer)
SELECT s.c_custkey, s.c_nationkey, s.c_mktsegment, v.c_acctbal
FROM slots s JOIN vals v ON s.c_nationkey = v.c_nationkey AND s.pos = v.pos
""")
def shuffle_rows(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    ctx = _ctx(options={"shuffle_key_columns": ["c_custkey"], "shuffle_secret_id": DEMO_KEY_ID})
    return apply_recipe(src, [act("SHUFFLE_ROWS", groupByColumns=["c_nationkey"], sourceColumns=["c_acctbal"])], ctx)


@query("shuffle_rows_default", """
SELECT c_nationkey, 'kept' AS side, c_custkey, NULL::DOUBLE AS c_acctbal FROM customer
UNION ALL SELECT c_nationkey, 'moved', NULL, c_acctbal FROM customer
""")
def shuffle_rows_default(spark, sf):
    """The default order: each group keeps its rows and its multiset of moved values."""
    src = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    out = apply_recipe(src, [act("SHUFFLE_ROWS", groupByColumns=["c_nationkey"], sourceColumns=["c_acctbal"])], _ctx())
    none = F.lit(None)
    sides = F.array(F.struct(F.lit("kept").alias("side"), F.col("c_custkey"), none.cast("double").alias("c_acctbal")),
                    F.struct(F.lit("moved").alias("side"), none.cast("long").alias("c_custkey"), F.col("c_acctbal")))
    return out.select("c_nationkey", F.explode(sides).alias("s")).select("c_nationkey", "s.*")


# ---------------------------------------------------------------- T11
@query("deterministic_encrypt", """
SELECT c_mktsegment, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_ciphertexts FROM customer GROUP BY c_mktsegment
""")
def deterministic_encrypt(spark, sf):
    from ladle.operators.crypto import decrypt
    src = table(spark, sf, "customer").select("c_mktsegment")
    enc = apply_recipe(src, [act("DETERMINISTIC_ENCRYPT", secretId=DEMO_KEY_ID,
                                 sourceColumns=["c_mktsegment"])], _ctx())
    return (enc.groupBy(decrypt(spark, F.col("c_mktsegment"), DEMO_KEY).alias("c_mktsegment"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("c_mktsegment").alias("n_ciphertexts")))


# ---------------------------------------------------------------- T12
@query("encrypt_round_trip", """
SELECT c_custkey, c_name, true AS is_ciphertext, CAST(1 AS BIGINT) AS n_same FROM customer
""")
def encrypt_round_trip(spark, sf):
    from ladle.operators.crypto import decrypt
    src = table(spark, sf, "customer").select("c_custkey", "c_name")
    enc = apply_recipe(src, [act("ENCRYPT", kmsKeyArn=DEMO_KEY_ID, sourceColumns=["c_name"])], _ctx())
    # each value encrypted on its own: no ciphertext twice, none equal to or holding its plain text
    twice = enc.groupBy("c_name").agg(F.count(F.lit(1)).alias("n_same"), F.min("c_custkey").alias("c_custkey"))
    plain = decrypt(spark, F.col("c_name"), DEMO_KEY)
    return twice.select("c_custkey", plain.alias("c_name"), (F.instr(F.col("c_name"), plain) == 0).alias("is_ciphertext"), "n_same")


@query("decrypt_key_ring", """
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 3 THEN c_name END AS c_name, c_custkey % 4 AS version FROM customer
""")
def decrypt_key_ring(spark, sf):
    """A column under two versions of one key, a second key and one that the ring lacks, decrypted in one pass."""
    from ladle.operators.crypto import decrypt_ring, encrypt
    old, new, other, gone = (bytes([i]) * 32 for i in range(4))
    version = F.col("c_custkey") % 4
    name = F.col("c_name")
    enc = (F.when(version == 0, encrypt(spark, name, "rotated", old, True)).when(version == 1, encrypt(spark, name, "rotated", new, False))
           .when(version == 2, encrypt(spark, name, "other", other, False)).otherwise(encrypt(spark, name, "gone", gone, True)))
    src = table(spark, sf, "customer").select("c_custkey", enc.alias("c_name"), version.alias("version"))
    return src.withColumn("c_name", decrypt_ring(spark, name, {"rotated": [old, new], "other": [other]}))


# ---------------------------------------------------------------- T13 / T14
@query("keyed_hash", f"""
SELECT c_custkey, {_sql_hmac_b64('c_name')} AS c_name FROM customer
""")
def keyed_hash(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", "c_name")
    return apply_recipe(src, [act("CRYPTOGRAPHIC_HASH", secretId=DEMO_KEY_ID, sourceColumns=["c_name"])], _ctx())


# A made-up phone column: phone-shaped text on even keys, the name on odd keys.
_PHONE_EXPR = ("CASE WHEN c_custkey % 2 = 0 THEN "
               "lpad(CAST(200 + c_custkey % 800 AS {t}), 3, '0') || (CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE '-' END) "
               "|| lpad(CAST(c_custkey % 1000 AS {t}), 3, '0') || '-' || lpad(CAST(c_custkey % 10000 AS {t}), 4, '0') "
               "ELSE c_name END")
_PHONE_SQL = _PHONE_EXPR.format(t="VARCHAR")


@query("keyed_hash_filtered", f"""
WITH src AS (SELECT c_custkey, {_PHONE_SQL} AS phone FROM customer)
SELECT c_custkey,
       CASE WHEN regexp_full_match(trim(phone), '[0-9][0-9][0-9][ -][0-9][0-9][0-9]-[0-9][0-9][0-9][0-9]')
            THEN {_sql_hmac_b64('phone')} ELSE phone END AS phone
FROM src
""")
def keyed_hash_filtered(spark, sf):
    src = table(spark, sf, "customer").select("c_custkey", F.expr(_PHONE_EXPR.format(t="STRING")).alias("phone"))
    return apply_recipe(src, [act("CRYPTOGRAPHIC_HASH", entityTypeFilter=["PHONE_NUMBER"], secretId=DEMO_KEY_ID,
                                  sourceColumns=["phone"])], _ctx())


# ---------------------------------------------------------------- F1 / F2
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _profile_sql(tbl: str, cols: list[str], numeric: set[str], types: dict[str, str]) -> str:
    parts = []
    for c in cols:
        num = c in numeric
        parts.append(
            f"SELECT '{c}' AS column_name, '{types[c]}' AS data_type, count(*) AS n_rows, "
            f"count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
            + (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev "
               if num else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev ")
            + f"FROM {tbl}")
    return "\nUNION ALL\n".join(parts)


_LI_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
             "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
             "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


@query("profile_columns", _profile_sql("lineitem", _LI_COLS,
                                       {c for c, t in _LI_TYPES.items() if t in ("bigint", "int", "double")},
                                       _LI_TYPES))
def profile_columns(spark, sf):
    from ladle.operators.profile import profile
    return profile(table(spark, sf, "lineitem"), _LI_COLS, exact_distinct=True, round_to=4)


_PART_COLS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query("profile_top_values", "\nUNION ALL\n".join(
    f"""SELECT * FROM (SELECT '{c}' AS column_name,
           CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rank,
           CAST({c} AS VARCHAR) AS value, count(*) AS frequency
       FROM part WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 3)"""
    for c in _PART_COLS))
def profile_top_values(spark, sf):
    from ladle.operators.profile import top_values
    return top_values(table(spark, sf, "part"), _PART_COLS, k=3)


# ---------------------------------------------------------------- F3
_LUHN_SQL = ("list_sum(list_transform(list_reverse(regexp_extract_all(m, '(\\d)', 1)), lambda d, i: "
             "CASE WHEN i % 2 = 0 THEN (CASE WHEN CAST(d AS INTEGER) * 2 > 9 THEN CAST(d AS INTEGER) * 2 - 9 "
             "ELSE CAST(d AS INTEGER) * 2 END) ELSE CAST(d AS INTEGER) END)) % 10 = 0")


# Written apart from the library's patterns: word boundaries in place of look-arounds.
_SQL_ENTITIES = {
    "EMAIL": r"[[:alnum:]._%+-]+@[[:alnum:].-]+[.][[:alpha:]][[:alpha:]]+",
    "PHONE_NUMBER": r"([+]?1[ .-]?)?([(]\d\d\d[)]|\b\d\d\d)[ .-]?\d\d\d[ .-]?\d\d\d\d\b",
    "SSN": r"\b\d\d\d-\d\d-\d\d\d\d\b",
    "CREDIT_CARD": r"\b(\d\d\d\d[ -]?\d\d\d\d[ -]?\d\d\d\d[ -]?\d\d\d\d|\d\d\d\d[ -]?\d\d\d\d\d\d[ -]?\d\d\d\d\d)\b",
    "IP_ADDRESS": r"\b((\d|[1-9]\d|1\d\d|2[0-4]\d|25[0-5])[.]){3}(\d|[1-9]\d|1\d\d|2[0-4]\d|25[0-5])\b",
}


def _entity_sql() -> str:
    def cond(e: str, p: str) -> str:
        if e == "CREDIT_CARD":
            return f"len(list_filter(regexp_extract_all(text, '{p}'), lambda m: {_LUHN_SQL})) > 0"
        return f"regexp_matches(text, '{p}')"
    return "\nUNION ALL\n".join(
        f"SELECT 'text' AS column_name, '{e}' AS entity_type, count(text) AS n_values, "
        f"CAST(count_if({cond(e, p)}) AS BIGINT) AS n_matches FROM documents"
        for e, p in _SQL_ENTITIES.items())


@query("entity_counts", _entity_sql())
def entity_counts(spark, sf):
    from ladle.operators.entities import detect_entities
    return detect_entities(table(spark, sf, "documents"), ["text"], ["USA_ALL"])


# ---------------------------------------------------------------- A7
@query("sample_rows", f"""
SELECT * FROM lineitem
ORDER BY md5('{SEED}|' || CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)) LIMIT 250
""")
def sample_rows(spark, sf):
    from ladle.operators.sample import sample_rows as sample
    return sample(table(spark, sf, "lineitem"), 250, SEED, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- E2 / A4 / C5
_ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


@query("batch_key_and_latest", f"""
SELECT event_id // 30 AS batch_id,
       array_to_string(list_sort(list_distinct(list('landing-' || event_type))), ';') AS watching_key,
       max({_ISO_SQL}) AS latest_event_time, count(*) AS n_records
FROM events GROUP BY event_id // 30
""")
def batch_key_and_latest(spark, sf):
    from ladle.functions.time import iso_text
    from ladle.streaming.envelope import key_and_latest, message_body, unpack_messages
    ev = table(spark, sf, "events")
    body = message_body(iso_text(F.col("ts")), F.concat(F.lit("landing-"), F.col("event_type")),
                        F.concat(F.lit("inbound/"), F.col("user_id").cast("string"), F.lit("/"),
                                 F.col("event_id").cast("string"), F.lit(".csv")))
    # One queue message per event; the queue hands them over 30 at a time.
    msgs = ev.select((F.col("event_id") / 30).cast("long").alias("batch_id"),
                     F.to_json(F.struct(F.array(F.struct(body.alias("body"))).alias("Records"))).alias("message"))
    recs = unpack_messages(msgs, "message", keep=["batch_id"])
    return key_and_latest(recs, ["batch_id"])


# ---------------------------------------------------------------- E4
_DELIVERY = "ts + to_minutes(CAST(json_extract_string(props, '$.k') AS INTEGER))"


@query("newer_only", f"""
WITH d AS (SELECT event_id, event_type, ts, {_DELIVERY} AS delivered_at FROM events),
m AS (SELECT *, max(ts) OVER (PARTITION BY event_type ORDER BY delivered_at, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max FROM d)
SELECT event_id, event_type, ts, delivered_at FROM m WHERE prev_max IS NULL OR ts > prev_max
""")
def newer_only(spark, sf):
    from ladle.streaming.newer import newer_only as keep_newer
    ev = table(spark, sf, "events")
    # Notifications are delivered late by props.k minutes: arrival order != event order.
    delay = F.get_json_object("props", "$.k").cast("int")
    d = ev.select("event_id", "event_type", "ts",
                  (F.col("ts") + F.make_dt_interval(mins=delay)).alias("delivered_at"))
    return keep_newer(d, "event_type", "ts", "delivered_at", tiebreak="event_id")


# ---------------------------------------------------------------- E5
@query("quiet_period", """
WITH e AS (SELECT event_type, ts,
                  CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) > INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS brk FROM events),
s AS (SELECT event_type, ts, sum(brk) OVER (PARTITION BY event_type ORDER BY ts
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM e)
SELECT event_type, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
       max(ts) + INTERVAL 30 MINUTE AS launch_at
FROM s GROUP BY event_type, sid
""")
def quiet_period(spark, sf):
    from ladle.streaming.quiet import quiet_sessions
    return quiet_sessions(table(spark, sf, "events"), "event_type", "ts", 30 * 60)


# ---------------------------------------------------------------- J1 / J2 / E7-E9 / K5
_JOB_SQL = "'job-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d')"
_LEDGER_SQL = f"""
starts AS (SELECT {_JOB_SQL} AS job_id, max(md5('token-' || CAST(event_id AS VARCHAR))) AS task_token, ts AS started_at
           FROM events WHERE event_type = 'view' GROUP BY 1, 3),
comp AS (SELECT event_id AS completion_id, {_JOB_SQL} AS job_id, ts AS completed_at,
                CASE WHEN value >= 1.0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS state
         FROM events WHERE event_type = 'purchase'),
open AS (SELECT c.*, CASE WHEN floor(epoch(c.completed_at)) <= floor(epoch(s.started_at)) + 604800 THEN s.task_token END AS task_token
         FROM comp c ASOF LEFT JOIN starts s ON c.job_id = s.job_id AND c.completed_at >= s.started_at)"""


def _ledger_inputs(spark, sf):
    ev = table(spark, sf, "events")
    job = F.concat(F.lit("job-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
    starts = ev.where(F.col("event_type") == "view").select(
        job.alias("job_id"), F.md5(F.concat(F.lit("token-"), F.col("event_id").cast("string"))).alias("task_token"),
        F.col("ts").alias("started_at"))
    comps = ev.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("completion_id"), job.alias("job_id"), F.col("ts").alias("completed_at"),
        F.when(F.col("value") >= 1.0, F.lit("SUCCEEDED")).otherwise(F.lit("FAILED")).alias("state"))
    return starts, comps


@query("run_outcomes", f"""
WITH {_LEDGER_SQL},
j AS (SELECT *, CASE WHEN task_token IS NOT NULL AND state = 'SUCCEEDED' THEN 'Success' ELSE 'Fail' END AS result,
             CASE WHEN task_token IS NULL THEN 'no open run for the job id'
                  WHEN state <> 'SUCCEEDED' THEN 'run ended in state ' || state END AS cause FROM open)
SELECT completion_id, job_id, completed_at, state, task_token, result, cause, 'transform' AS source,
       'Pipeline result [' || result || ']' AS subject,
       CASE WHEN result = 'Success' THEN 'Job run ' || job_id || ' completed with state ' || state || '.'
            ELSE 'Job fails to launch or finish, error: ' || state || ', cause: ' || cause END AS message
FROM j
""")
def run_outcomes(spark, sf):
    from ladle.streaming.ledger import match_completions, outcome_rows
    starts, comps = _ledger_inputs(spark, sf)
    out = outcome_rows(match_completions(comps, starts))
    return out.select("completion_id", "job_id", "completed_at", "state", "task_token", "result", "cause",
                      "source", "subject", "message")


@query("orphan_completions", f"""
WITH {_LEDGER_SQL}
SELECT completion_id, job_id, completed_at, state FROM open WHERE task_token IS NULL
""")
def orphan_completions(spark, sf):
    from ladle.streaming.ledger import orphan_completions as orphans
    starts, comps = _ledger_inputs(spark, sf)
    return orphans(comps, starts)


# ---------------------------------------------------------------- S1-S8, P2, K1, K2
def _landing(spark) -> str:
    from ladle.session import scratch_dir
    return scratch_dir(spark, "landing")


def _touch_empty(spark, path: str) -> None:
    """Create a zero-byte placeholder object (driver-side metadata call)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(p, True).close()


_ORDERS_TEXT_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders
"""


@query("land_csv_header", _ORDERS_TEXT_SQL)
def land_csv_header(spark, sf):
    """Pushed CSV with header under inbound/, a placeholder object and a file
    outside the prefix; an Incremental read sees exactly the landed rows."""
    from ladle.sources.entities import stringify
    from ladle.sources.files import PLACEHOLDER_OBJECT, PUSH_PREFIX, read_inbound
    root = _landing(spark)
    orders = table(spark, sf, "orders")
    stringify(orders).write.mode("overwrite").option("header", True).csv(f"{root}/{PUSH_PREFIX}drop1")
    _touch_empty(spark, f"{root}/{PUSH_PREFIX}{PLACEHOLDER_OBJECT}")
    table(spark, sf, "region").write.mode("overwrite").option("header", True).csv(f"{root}/elsewhere")
    return read_inbound(spark, f"{root}/{PUSH_PREFIX}", "CsvWithHeaderRow", "Incremental")


@query("land_csv_no_header", _ORDERS_TEXT_SQL)
def land_csv_no_header(spark, sf):
    from ladle.sources.entities import stringify
    from ladle.sources.files import PUSH_PREFIX, read_inbound
    root = _landing(spark)
    orders = table(spark, sf, "orders")
    stringify(orders).write.mode("overwrite").option("header", False).csv(f"{root}/{PUSH_PREFIX}drop1")
    return read_inbound(spark, f"{root}/{PUSH_PREFIX}", "CSV", "Incremental", column_names=orders.columns)


@query("land_json_lines", "SELECT * FROM orders")
def land_json_lines(spark, sf):
    from ladle.sinks.tables import write_json
    from ladle.sources.files import PUSH_PREFIX, read_inbound
    root = _landing(spark)
    orders = table(spark, sf, "orders")
    write_json(orders, f"{root}/{PUSH_PREFIX}drop1")
    return read_inbound(spark, f"{root}/{PUSH_PREFIX}", "JSONMultiLine", "Incremental", schema=orders.schema)


@query("table_append", """
SELECT c_custkey, concat(repeat('#', least(5, length(c_name))), substr(c_name, 6)) AS c_name,
       c_nationkey, c_mktsegment FROM customer
UNION ALL
SELECT c_custkey, concat(repeat('#', least(5, length(c_name))), substr(c_name, 6)) AS c_name,
       c_nationkey, c_mktsegment FROM customer
""")
def table_append(spark, sf):
    """Two runs of a masking recipe append to one Parquet catalog table."""
    import uuid
    from ladle.sinks.tables import TRANSFORM_PREFIX, ensure_database, write_table
    root = _landing(spark)
    db, name = "ladle_out", f"customer_{uuid.uuid4().hex[:12]}"
    ensure_database(spark, db)
    src = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    masked = apply_recipe(src, [act("MASK_RANGE", alphabet=["WHITESPACE", "SYMBOLS"], firstN="5",
                                    maskMode="MASK_FIRST_N", maskSymbol="#", sourceColumns=["c_name"])], _ctx())
    for _ in range(2):
        write_table(masked, f"{db}.{name}", location=f"{root}/{TRANSFORM_PREFIX}{name}")
    return spark.read.table(f"{db}.{name}")


# ---------------------------------------------------------------- flagship (P3-P5 over five steps)
FLAGSHIP_RECIPE = [
    act("FILL_WITH_MOST_FREQUENT", sourceColumn="c_mktsegment"),
    act("GROUP_BY", groupByAggFunctionOptions=[{"sourceColumnName": "c_custkey", "targetColumnName": "nation_size",
                                                "targetColumnDataType": "string", "functionName": "COUNT"}],
        sourceColumns=["c_nationkey"], useNewDataFrame="false"),
    act("CATEGORICAL_MAPPING", categoryMap={"AUTOMOBILE": "industry", "MACHINERY": "industry",
                                            "BUILDING": "industry", "HOUSEHOLD": "consumer"},
        other="other", sourceColumn="c_mktsegment", targetColumn="segment_group"),
    act("MASK_RANGE", alphabet=["WHITESPACE", "SYMBOLS"], firstN="5", maskMode="MASK_FIRST_N",
        maskSymbol="#", sourceColumns=["c_name"], stop="5"),
    act("CRYPTOGRAPHIC_HASH", secretId=DEMO_KEY_ID, sourceColumns=["c_custkey"]),
]

FLAGSHIP_SQL = f"""
SELECT {_sql_hmac_b64('CAST(c_custkey AS VARCHAR)')} AS c_custkey,
       concat(repeat('#', least(5, length(c_name))), substr(c_name, 6)) AS c_name,
       c_nationkey, c_acctbal, c_mktsegment,
       CAST(count(c_custkey) OVER (PARTITION BY c_nationkey) AS VARCHAR) AS nation_size,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'industry' WHEN 'MACHINERY' THEN 'industry'
            WHEN 'BUILDING' THEN 'industry' WHEN 'HOUSEHOLD' THEN 'consumer' ELSE 'other' END AS segment_group
FROM customer
"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = RecipeContext(secrets={DEMO_KEY_ID: DEMO_KEY}, seed=SEED)
    return apply_recipe(table(spark, sf_dir, "customer"), FLAGSHIP_RECIPE, ctx)


query("protect_customers", FLAGSHIP_SQL)(flagship)


# ---------------------------------------------------------------- C1
@query("object_locations", """
WITH loc AS (SELECT event_id,
                    CASE WHEN event_type = 'error' THEN 'landing-' || event_type
                         ELSE 'landing-' || event_type || '/inbound/' || CAST(user_id AS VARCHAR) || '/'
                              || CAST(event_id AS VARCHAR) || '.csv' END AS location FROM events)
SELECT event_id, location,
       CASE WHEN strpos(location, '/') > 0 THEN regexp_extract(location, '^([^/]*)/(.*)$', 1) END AS bucket,
       CASE WHEN strpos(location, '/') > 0 THEN regexp_extract(location, '^([^/]*)/(.*)$', 2) END AS object_key,
       strpos(location, '/') > 0 AS is_valid
FROM loc
""")
def object_locations(spark, sf):
    """Split ``bucket/key`` locations at the first slash; slash-less ones are flagged, not fatal."""
    from ladle.functions.text import split_location
    ev = table(spark, sf, "events")
    loc = F.when(F.col("event_type") == "error", F.concat(F.lit("landing-"), F.col("event_type"))).otherwise(
        F.concat(F.lit("landing-"), F.col("event_type"), F.lit("/inbound/"), F.col("user_id").cast("string"),
                 F.lit("/"), F.col("event_id").cast("string"), F.lit(".csv")))
    src = ev.select("event_id", loc.alias("location"))
    bucket, key, ok = split_location(F.col("location"))
    return src.select("event_id", "location", bucket.alias("bucket"), key.alias("object_key"), ok.alias("is_valid"))


# ---------------------------------------------------------------- P8 / C5 / C6
@query("completion_filter", """
SELECT event_id, 'run-' || CAST(event_id AS VARCHAR) AS job_id,
       CASE WHEN value >= 1.0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS state, 'transform-job' AS job_name
FROM events WHERE event_type IN ('purchase', 'error')
""")
def completion_filter(spark, sf):
    """State-change events of the job service are picked out of a mixed event bus."""
    from ladle.streaming.envelope import completion_events
    ev = table(spark, sf, "events")
    src = F.when(F.col("event_type").isin("purchase", "error"), F.lit("jobs")).otherwise(F.lit("web"))
    detail = F.struct(F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("jobRunId"),
                      F.when(F.col("value") >= 1.0, F.lit("SUCCEEDED")).otherwise(F.lit("FAILED")).alias("state"),
                      F.lit("transform-job").alias("jobName"))
    bus = ev.select("event_id", F.to_json(F.struct(src.alias("source"),
                                                   F.lit("Job State Change").alias("detail-type"),
                                                   detail.alias("detail"))).alias("event"))
    return completion_events(bus, "jobs", "Job State Change").drop("event")


# ---------------------------------------------------------------- T14 inside free text
def _within_sql() -> str:
    either = f"{_SQL_ENTITIES['EMAIL']}|{_SQL_ENTITIES['PHONE_NUMBER']}"
    return f"""
WITH cut AS (SELECT doc_id, text, string_split_regex(text, '{either}') AS between, regexp_extract_all(text, '{either}') AS found
             FROM documents),
rows AS (SELECT doc_id, unnest(range(1, len(between) + 1)) AS i, between, found FROM cut WHERE len(found) > 0),
done AS (SELECT doc_id, string_agg(between[i] || CASE WHEN i <= len(found) THEN {_sql_hmac_b64('found[i]')} ELSE '' END, '' ORDER BY i) AS t
         FROM rows GROUP BY doc_id)
SELECT cut.doc_id, coalesce(done.t, cut.text) AS text FROM cut LEFT JOIN done USING (doc_id)
"""


@query("hash_within_documents", _within_sql())
def hash_within_documents(spark, sf):
    """Every e-mail address and phone number inside whole document texts is
    replaced by its keyed hash; the rest of each text is kept."""
    src = table(spark, sf, "documents").select("doc_id", "text")
    ctx = _ctx(options={"hash_within_text": True})
    return apply_recipe(src, [act("CRYPTOGRAPHIC_HASH", entityTypeFilter=["EMAIL", "PHONE_NUMBER"],
                                  secretId=DEMO_KEY_ID, sourceColumns=["text"])], ctx)


# ---------------------------------------------------------------- E6 (batch)
@query("single_flight", """
WITH RECURSIVE e AS (SELECT event_type, ts,
                  CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts) > INTERVAL 30 MINUTE
                       THEN 1 ELSE 0 END AS brk FROM events),
s AS (SELECT event_type, ts, sum(brk) OVER (PARTITION BY event_type ORDER BY ts
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM e),
launches AS (SELECT event_type, max(ts) + INTERVAL 30 MINUTE AS requested_at FROM s GROUP BY event_type, sid),
chain(event_type, requested_at) AS (
  SELECT event_type, min(requested_at) FROM launches GROUP BY event_type
  UNION ALL
  SELECT c.event_type, (SELECT min(l.requested_at) FROM launches l
                        WHERE l.event_type = c.event_type AND l.requested_at >= c.requested_at + INTERVAL 2 HOUR)
  FROM chain c WHERE c.requested_at IS NOT NULL)
SELECT l.event_type, l.requested_at,
       EXISTS (SELECT 1 FROM chain c WHERE c.event_type = l.event_type AND c.requested_at = l.requested_at) AS started
FROM launches l
""")
def single_flight(spark, sf):
    """Launch requests (one per quiet-period session) start a 2-hour run only
    when the previous run of the same key has finished."""
    from ladle.streaming.flight import single_flight as flight
    from ladle.streaming.quiet import quiet_sessions
    launches = quiet_sessions(table(spark, sf, "events"), "event_type", "ts", 30 * 60) \
        .select("event_type", F.col("launch_at").alias("requested_at"))
    return flight(launches, "event_type", "requested_at", 2 * 3600)


# ---------------------------------------------------------------- S1 / S2: CSV as exported
@query("land_csv_mixed_headers", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ', "the ' || c_mktsegment || '"' || chr(10) || 'second line' AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CASE WHEN c_custkey % 2 = 1 THEN CAST(c_acctbal AS VARCHAR) END AS c_acctbal
FROM customer
""")
def land_csv_mixed_headers(spark, sf):
    """Two exports under one prefix: other column order, one column more, quotes and line breaks in quotes."""
    from ladle.sources.entities import stringify
    from ladle.sources.files import PUSH_PREFIX, read_inbound
    root = f"{_landing(spark)}/{PUSH_PREFIX}"
    name = F.concat("c_name", F.lit(', "the '), "c_mktsegment", F.lit('"\nsecond line'))
    src = stringify(table(spark, sf, "customer").withColumn("c_name", name))
    for odd, columns in ((0, ["c_custkey", "c_name", "c_nationkey"]), (1, ["c_acctbal", "c_nationkey", "c_name", "c_custkey"])):
        (src.where(F.col("c_custkey").cast("long") % 2 == odd).select(*columns)
         .write.option("header", True).option("escape", '"').csv(f"{root}drop{odd}"))
    return read_inbound(spark, root, "CsvWithHeaderRow", "Incremental", multi_line=True).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal")


@query("land_csv_quoted_split", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'first line' || chr(10) || '"' || o_orderstatus || '", ' || CAST(o_custkey AS VARCHAR) || chr(10) || chr(10) || 'last' AS note,
       CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey FROM orders
""")
def land_csv_quoted_split(spark, sf):
    """Large exports with line breaks in quotes, read by one task per split; their headers differ."""
    from ladle.sources.files import PUSH_PREFIX, read_inbound
    root = f"{_landing(spark)}/{PUSH_PREFIX}"
    note = F.concat(F.lit('first line\n"'), "o_orderstatus", F.lit('", '), F.col("o_custkey").cast("string"), F.lit("\n\nlast"))
    src = table(spark, sf, "orders").select("o_orderkey", note.alias("note"), "o_custkey")
    for odd, columns in ((0, ["note", "o_orderkey"]), (1, ["o_custkey", "o_orderkey", "note"])):
        src.where(F.col("o_orderkey") % 2 == odd).select(*columns).write.option("header", True).option("escape", '"').csv(f"{root}drop{odd}")
    return read_inbound(spark, root, "CsvWithHeaderRow", "Incremental", multi_line="split").select("o_orderkey", "note", "o_custkey")


# ---------------------------------------------------------------- S3
@query("land_json_document", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def land_json_document(spark, sf):
    """JSON documents over many lines, one array of at most 1,000 rows per file."""
    from ladle.sources.files import PUSH_PREFIX, read_inbound
    root = f"{_landing(spark)}/{PUSH_PREFIX}"
    src = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    one = F.to_json(F.struct(*src.columns), {"pretty": "true"})
    doc = src.groupBy(F.floor(F.col("c_custkey") / 1000).alias("file")).agg(F.concat(
        F.lit("["), F.concat_ws(",\n", F.collect_list(one)), F.lit("]")).alias("value"))
    doc.select("value").write.option("maxRecordsPerFile", 1).text(root)
    return read_inbound(spark, root, "JSON", "Incremental", schema=src.schema)


# ---------------------------------------------------------------- S5 / A5
@query("land_bulk_newest", "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region")
def land_bulk_newest(spark, sf):
    """Bulk: of all drops of orders and the region file that came last, only the newest file is read."""
    from ladle.sources.entities import stringify
    from ladle.sources.files import PUSH_PREFIX, read_inbound
    root = f"{_landing(spark)}/{PUSH_PREFIX}"
    stringify(table(spark, sf, "orders")).write.option("header", True).csv(f"{root}a-orders")
    region = stringify(table(spark, sf, "region").select("r_regionkey", "r_name"))
    region.coalesce(1).write.option("header", True).csv(f"{root}z-region")  # a few rows by definition
    return read_inbound(spark, root, "CsvWithHeaderRow", "Bulk")


# ---------------------------------------------------------------- S6: only what is new
@query("land_incremental_new", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal, 2::BIGINT AS n_batches FROM customer
""")
def land_incremental_new(spark, sf):
    """Two drops with a run after each and a third run that finds nothing: each run takes only new files, every row stands once."""
    import uuid

    from ladle.sources.entities import stringify
    from ladle.sources.files import PUSH_PREFIX
    from ladle.sources.manifest import IncrementalJob
    root, name = f"{_landing(spark)}/{PUSH_PREFIX}", f"ladle_out.new_{uuid.uuid4().hex[:12]}"
    src = stringify(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"))
    job = IncrementalJob(spark, root, name, f"{name}_files")
    for odd in (0, 1):
        src.where(F.col("c_custkey").cast("long") % 2 == odd).write.option("header", True).csv(f"{root}drop{odd}")
        job.run()
    job.run()
    rows = spark.read.table(name)
    batches = rows.select(F.count_distinct("batch_id").alias("n"))
    return rows.select("c_custkey", "c_name", "c_acctbal", batches.scalar().alias("n_batches"))


# ---------------------------------------------------------------- K6 as a table
@query("keyed_upsert", """
SELECT user_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value,
       arg_max(event_id, (ts, event_id)) AS event_id, 3::BIGINT AS version FROM events GROUP BY user_id
""")
def keyed_upsert(spark, sf):
    """Three overlapping batches into a keyed table, one of them applied twice: the last write of every key."""
    from ladle.sinks.keyed import KeyedTable
    ev = table(spark, sf, "events").select("user_id", "ts", "event_type", "value", "event_id")
    keyed = KeyedTable(spark, f"{_landing(spark)}/keyed", ["user_id"], ["ts", "event_id"], buckets=16)
    for batch in (2, 0, 1, 0):  # not in order of time
        version = keyed.upsert(ev.where((F.col("event_id") % 4).isin(batch, batch + 1)), f"batch-{batch}")
    return keyed.read().withColumn("version", F.lit(version).cast("long"))


# ---------------------------------------------------------------- S9 / P1 / K3
@query("entity_landing", """
SELECT 'ClickEvent' AS entity, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey
FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def entity_landing(spark, sf):
    """One entity of a mixed extract, all fields mapped as text, landed as one JSON file and read back."""
    from ladle.sinks.tables import write_single_json
    from ladle.sources.entities import land_entity
    from ladle.sources.files import flow_prefix, read_inbound
    root = f"{_landing(spark)}/{flow_prefix('customers')}"
    src = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("ClickEvent")).otherwise(F.lit("OpenEvent")).alias("entity"),
        "c_custkey", "c_name", "c_nationkey")
    out = land_entity(src, "ClickEvent", "entity")
    write_single_json(out, root)
    return read_inbound(spark, root, "JSONMultiLine", "Bulk", schema=out.schema, connector="pull")


# ---------------------------------------------------------------- K4 with F1, F2, F3
@query("profile_job", """
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part),
cells AS (SELECT 'p_partkey' AS c, p_partkey AS v FROM p UNION ALL SELECT 'p_name', p_name FROM p UNION ALL SELECT 'p_brand', p_brand FROM p),
top AS (SELECT c, v, n, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) AS r
        FROM (SELECT c, v, count(*) AS n FROM cells WHERE v IS NOT NULL GROUP BY c, v))
SELECT 'profile' AS report, c AS column_name, min(v) AS a, max(v) AS b, count(v) AS n FROM cells GROUP BY c
UNION ALL SELECT 'top', c, v, CAST(r AS VARCHAR), n FROM top WHERE r <= 10
UNION ALL SELECT 'entity', c, e, '', CAST(count_if(regexp_matches(v, q)) AS BIGINT)
          FROM cells, (VALUES ('SSN', '\\b[0-9]{3}-[0-9]{2}-[0-9]{4}\\b')) AS t(e, q) GROUP BY c, e
""")
def profile_job(spark, sf):
    """The profile job's three reports over landed data, read back from where they were written."""
    from ladle.plans.job import run_profile_job
    from ladle.sources.entities import stringify
    root = _landing(spark)
    part = stringify(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"))
    part.write.option("header", True).csv(f"{root}/inbound/drop")
    _, _, out = run_profile_job(spark, f"{root}/inbound/", f"{root}/transform/part", entities=["SSN"], exact_distinct=True)
    prof, top, ents = (spark.read.json(f"{out}{x}") for x in ("*.json", "top_values/", "entities/"))
    return (prof.select(F.lit("profile").alias("report"), "column_name", F.col("min_value").alias("a"), F.col("max_value").alias("b"),
                        (F.col("n_rows") - F.col("n_null")).alias("n"))
            .unionByName(top.select(F.lit("top").alias("report"), "column_name", F.col("value").alias("a"),
                                    F.col("rank").cast("string").alias("b"), F.col("frequency").alias("n")))
            .unionByName(ents.select(F.lit("entity").alias("report"), "column_name", F.col("entity_type").alias("a"),
                                     F.lit("").alias("b"), F.col("n_matches").alias("n"))))


# ---------------------------------------------------------------- F1 / K4: profiles that merge
@query("profile_merged", """
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_quantity, l_shipdate, l_returnflag FROM lineitem)
SELECT 'l_orderkey' AS column_name, count(*) AS n_rows, count(*) - count(l_orderkey) AS n_null, min(l_orderkey) AS min_value,
       max(l_orderkey) AS max_value, NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, true AS distinct_near, NULL AS median_near FROM l
UNION ALL SELECT 'l_quantity', count(*), count(*) - count(l_quantity), CAST(min(l_quantity) AS VARCHAR), CAST(max(l_quantity) AS VARCHAR),
       round(avg(l_quantity), 6), round(stddev_samp(l_quantity), 6), true, true FROM l
UNION ALL SELECT 'l_shipdate', count(*), count(*) - count(l_shipdate), strftime(min(l_shipdate), '%Y-%m-%d'),
       strftime(max(l_shipdate), '%Y-%m-%d'), NULL, NULL, true, NULL FROM l
UNION ALL SELECT 'l_returnflag', count(*), count(*) - count(l_returnflag), min(l_returnflag), max(l_returnflag), NULL, NULL, true, NULL FROM l
""")
def profile_merged(spark, sf):
    """Two drops are profiled apart and their sketches stored; the profile of both comes from the sketches alone.

    ``distinct_near``: the merged distinct count is within 5 % of the exact one; ``median_near``: the merged median
    has 48 to 52 % of the values below it, or equal values in between.
    """
    from ladle.operators.profile import exact_distinct_counts, merge_profiles, profile_sketches
    from ladle.sinks.tables import read_sketches, write_sketches
    src = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("l_orderkey"), "l_quantity",
                                              F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_returnflag")
    root = _landing(spark)
    for odd in (0, 1):
        drop = src.where(F.pmod(F.col("l_orderkey").cast("long"), F.lit(2)) == odd)
        write_sketches(profile_sketches(drop), root, str(odd))
    got = merge_profiles(read_sketches(spark, root), quantiles=[0.5])
    exact = exact_distinct_counts(src, src.columns).select(F.col("column_name").alias("c"), F.col("n_distinct").alias("exact"))
    median = got.where("column_name = 'l_quantity'").select(F.element_at("quantiles", 1)).scalar()
    ranks = src.agg(F.avg((F.col("l_quantity") < median).cast("int")).alias("below"), F.avg((F.col("l_quantity") <= median).cast("int")).alias("upto"))
    near = ranks.select((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).scalar()
    return got.join(exact, F.col("column_name") == F.col("c")).select(
        "column_name", "n_rows", "n_null", "min_value", "max_value", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.05)).alias("distinct_near"),
        F.when(F.col("column_name") == "l_quantity", near).alias("median_near"))


# ---------------------------------------------------------------- P4
@query("empty_recipe", "SELECT * FROM supplier")
def empty_recipe(spark, sf):
    return apply_recipe(table(spark, sf, "supplier"), "", _ctx())


# ---------------------------------------------------------------- C4
@query("iso_compare", """
SELECT event_id, epoch_us(ts) - 7200000000 * (event_id % 2) AS us, (event_id % 2 = 0) AS not_before FROM events
""")
def iso_compare(spark, sf):
    """Times as text in several forms and zones, compared as instants."""
    from ladle.functions.time import iso_micros
    wall = lambda p: F.date_format("ts", p)
    text = (F.when(F.col("event_id") % 4 == 0, F.concat(wall("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
            .when(F.col("event_id") % 4 == 2, wall("yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .otherwise(F.concat(wall("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))))
    own = iso_micros(F.concat(wall("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
    return table(spark, sf, "events").select("event_id", iso_micros(text).alias("us"), (iso_micros(text) >= own).alias("not_before"))


# ---------------------------------------------------------------- E1 / E8 / E10: replays
def _replayed(spark, df: DataFrame) -> str:
    path = f"{_landing(spark)}/stream"
    df.write.parquet(path)
    return path


def _stream_table(spark) -> tuple[str, str]:
    import uuid
    spark.sql("CREATE DATABASE IF NOT EXISTS ladle_out")
    return f"ladle_out.stream_{uuid.uuid4().hex[:12]}", f"{_landing(spark)}/_checkpoint"


@query("arrivals_on_demand", "SELECT event_id, event_type, true AS has_file FROM events")
def arrivals_on_demand(spark, sf):
    """E1 + E10: all rows of arriving files with the file they came from, taken in on demand until none is left."""
    from ladle.streaming.envelope import arrivals
    from ladle.streaming.live import run_available_now
    ev = table(spark, sf, "events").select("event_id", "event_type")
    stream = arrivals(spark, _replayed(spark, ev), "parquet", ev.schema)
    name, checkpoint = _stream_table(spark)
    run_available_now(stream.select("event_id", "event_type", (F.length("file_path") > 0).alias("has_file")), name, checkpoint)
    return spark.read.table(name)


from ladle.plans import streams  # noqa: E402,F401  (registers the replays of streams)
