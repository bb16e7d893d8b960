"""Every registered query with the SQL that must give the same rows.

The tables stand in for CRM objects: ``events`` is a change log (key ``user_id``, stamp ``ts``,
deleted where ``event_type`` is ``error``), ``orders`` an object with a parent reference,
``customer`` and ``part`` field catalogs. All of them read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import changevault as cv
from changevault.functions.coerce import coerce, is_rejected
from changevault.model import CATALOG_SCHEMA, ColumnDef, ObjectSpec, PartitionBy
from changevault.operators.watermark import with_buffer
from changevault.session import fresh_dir, local_frame, moment, now, use_utc
from changevault.sources.raw import columns_of, stage, stamp_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AT = "2024-01-15T00:00:00Z"
DAY_10 = "2024-01-11T00:00:00Z"
EVENTS = ObjectSpec("events", "user_id", "ts", deleted_field="is_deleted")
NEWEST = ("event_id",)
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def query(name: str, sql: str | None = None):
    """Register a query; its session runs in UTC."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: run(use_utc(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("is_deleted", F.col("event_type") == "error")


def utc(name: str) -> Column:
    return F.col(name).cast("timestamp").alias(name)


def ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


# ---- newest version, as-of ------------------------------------------------------------------

_RANKED = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC)"


@query("latest_per_key", f"""
SELECT event_id, ts, user_id, event_type, value, props
FROM (SELECT *, {_RANKED} AS rn FROM events) WHERE rn = 1
""")
def latest_per_key(spark, sf_dir):
    return cv.latest_per_key(table(spark, sf_dir, "events"), "user_id", "ts", NEWEST)


@query("table_as_of", f"""
SELECT event_id, ts, user_id, event_type, value, props, event_type = 'error' AS is_deleted
FROM (SELECT *, {_RANKED} AS rn FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1
""")
def table_as_of(spark, sf_dir):
    return cv.table_as_of(change_log(spark, sf_dir), EVENTS, AT, NEWEST)


@query("record_as_of", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE user_id = 8 AND ts < TIMESTAMP '2024-01-15 00:00:00'
ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 1
""")
def record_as_of(spark, sf_dir):
    return cv.record_as_of(table(spark, sf_dir, "events"), EVENTS, 8, AT, NEWEST)


@query("record_history", """
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE user_id = 8
""")
def record_history(spark, sf_dir):
    return cv.record_history(table(spark, sf_dir, "events"), EVENTS, 8, NEWEST)


@query("restore_preview", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, CAST(user_id AS VARCHAR) AS user_id, value,
  'event_id,event_type,props,ts,user_id,value' AS keys
FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST) AS rn
  FROM (
    SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
    QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1
  )
) WHERE rn = 1
""")
def restore_preview(spark, sf_dir):
    """The preview's JSON, its number read back: engines print doubles differently."""
    versions = cv.latest_per_key(table(spark, sf_dir, "events"), ["user_id", "ts"], "event_id")
    preview = cv.restore_preview(versions, EVENTS, AT)
    cells = F.from_json("record_json", "map<string, string>")
    return preview.select(
        *[cells[c].alias(c) for c in ("event_id", "event_type", "props", "ts", "user_id")],
        cells["value"].cast("double").alias("value"),
        F.concat_ws(",", F.json_object_keys("record_json")).alias("keys"),
    )


# ---- merge ----------------------------------------------------------------------------------

_STATES = f"""
WITH latest AS (
  SELECT *, event_type = 'error' AS is_deleted
  FROM (SELECT *, {_RANKED} AS rn FROM events) WHERE rn = 1
), cur AS (
  SELECT *, event_type = 'error' AS is_deleted
  FROM (SELECT *, {_RANKED} AS rn FROM events WHERE ts < TIMESTAMP '2024-01-11 00:00:00')
  WHERE rn = 1 AND event_type <> 'error'
)
"""


def _states(spark, sf_dir):
    log = change_log(spark, sf_dir)
    current = cv.table_as_of(log, EVENTS, DAY_10, NEWEST).where(~F.col("is_deleted"))
    return current, cv.latest_per_key(log, "user_id", "ts", NEWEST)


@query("merge_current", _STATES + """
SELECT event_id, ts, user_id, event_type, value, props, is_deleted FROM latest WHERE NOT is_deleted
UNION ALL
SELECT event_id, ts, user_id, event_type, value, props, is_deleted FROM cur
WHERE user_id NOT IN (SELECT user_id FROM latest)
""")
def merge_current(spark, sf_dir):
    return cv.merge_current(*_states(spark, sf_dir), "user_id", "is_deleted")


@query("merge_actions", _STATES + """
SELECT l.user_id, CASE
    WHEN c.user_id IS NOT NULL AND l.is_deleted THEN 'delete'
    WHEN c.user_id IS NOT NULL THEN 'update'
    WHEN NOT l.is_deleted THEN 'insert'
    ELSE 'none' END AS action
FROM latest l LEFT JOIN cur c ON c.user_id = l.user_id
""")
def merge_actions(spark, sf_dir):
    return cv.merge_actions(*_states(spark, sf_dir), "user_id", "is_deleted")


# ---- watermarks -----------------------------------------------------------------------------


@query("batch_watermark", """
SELECT event_type, max(ts) AS watermark, count(*) AS n_rows FROM events GROUP BY event_type
""")
def batch_watermark(spark, sf_dir):
    return cv.batch_watermark(table(spark, sf_dir, "events"), "ts", ["event_type"])


@query("watermark_job_start", """
SELECT event_type, max(ts) - INTERVAL 5 MINUTE AS watermark, max(ts) AS last_job_start
FROM events GROUP BY event_type
""")
def watermark_job_start(spark, sf_dir):
    jobs = table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("last_job_start"))
    return jobs.withColumn("watermark", with_buffer(F.col("last_job_start")))


@query("ledger_latest", """
WITH daily AS (
  SELECT event_type AS object, CAST(ts AS DATE) AS day, max(ts) AS watermark, min(ts) AS started
  FROM events GROUP BY ALL
)
SELECT object, max(watermark) AS watermark, arg_max(started, day) AS last_job_start,
  'job-' || CAST(max(day) AS VARCHAR) AS last_job_id
FROM daily GROUP BY object
""")
def ledger_latest(spark, sf_dir):
    day = F.to_date("ts")
    daily = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("object"), day.alias("day")).agg(
        F.max("ts").alias("watermark"), F.min("ts").alias("last_job_start")
    )
    text = F.col("day").cast("string")
    ledger = daily.select(
        "object", "watermark", "last_job_start", F.lit("raw").alias("kind"),
        F.concat(F.lit("job-"), text).alias("last_job_id"), text.alias("commit_id"),
        F.col("day").alias("committed_at"),
    )
    return cv.watermarks(ledger)


@query("incremental_extract", """
SELECT event_id, user_id, event_type, ts, event_type = 'error' AS is_deleted
FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'
""")
def incremental_extract(spark, sf_dir):
    fields = cv.extract_fields(["event_id", "user_id", "event_type"], "ts", "is_deleted")
    return cv.incremental(change_log(spark, sf_dir), EVENTS, AT).select(*fields)


@query("overlap_dedupe", """
SELECT event_id, ts, user_id, event_type, value, props FROM events b
WHERE ts > TIMESTAMP '2024-01-14 23:55:00'
  AND NOT EXISTS (
    SELECT 1 FROM events s WHERE s.user_id = b.user_id AND s.ts = b.ts
      AND s.ts > TIMESTAMP '2024-01-14 23:55:00' AND s.ts <= TIMESTAMP '2024-01-15 00:00:00')
QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1
""")
def overlap_dedupe(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    low = cv.job_start_watermark(AT)
    batch = cv.incremental(events, EVENTS, low)
    seen = events.where(F.col("ts") <= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return cv.drop_seen(batch, seen, EVENTS, since=low, tiebreak=NEWEST)


# ---- partitions, raw table, CSV -------------------------------------------------------------

_ORDER_PARTS = (
    PartitionBy("o_orderdate", "day"), PartitionBy("o_orderdate", "hour"),
    PartitionBy("o_orderdate", "month"), PartitionBy("o_orderdate", "year"),
    PartitionBy("o_orderstatus", "bucketed"), PartitionBy("no_such_field", "day"),
)


@query("partition_transforms", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d-%H') AS hour,
  strftime(o_orderdate, '%Y-%m-01') AS month, strftime(o_orderdate, '%Y-01-01') AS year,
  o_orderstatus AS status, count(*) AS n
FROM orders GROUP BY ALL
""")
def partition_transforms(spark, sf_dir):
    derived, names = cv.with_partitions(table(spark, sf_dir, "orders"), _ORDER_PARTS)
    labels = ("day", "hour", "month", "year", "status")
    return derived.groupBy(*[
        F.col(name).cast("string").alias(label) for name, label in zip(names, labels)
    ]).agg(F.count(F.lit(1)).alias("n"))


ORDERS = ObjectSpec(
    "orders", "o_orderkey", "o_orderdate", partition_by=(PartitionBy("o_orderdate", "year"),)
)
_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
"""
_ORDER_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
)


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", utc("o_orderdate"))


def _orders_back(raw: DataFrame, *extra: Column) -> DataFrame:
    return raw.select(*[ntz(c) if c == "o_orderdate" else F.col(c) for c in _ORDER_COLUMNS], *extra)


def _orders_vault(spark, sf_dir, spec: ObjectSpec = ORDERS) -> str:
    """Orders in three syncs, by status; one is replayed and one attempt is left unpublished."""
    root = fresh_dir(spark, "orders")
    orders = _orders(spark, sf_dir)
    status = F.col("o_orderstatus")
    slices = {"f": status == "F", "o": status == "O", "rest": ~status.isin("F", "O")}
    for sync_id, part in slices.items():
        cv.append_raw(orders.where(part), spec, root, sync_id)
    cv.append_raw(orders.where(slices["o"]), spec, root, "o")
    columns = columns_of(orders)
    stage(stamp_rows(orders, columns, "lost", now()), spec, root, columns)
    return root


@query("raw_round_trip", _ORDERS_SQL)
def raw_round_trip(spark, sf_dir):
    return _orders_back(cv.read_raw(spark, ORDERS, _orders_vault(spark, sf_dir)))


@query("csv_round_trip", r"""
SELECT doc_id, replace(coalesce(text, ''), chr(13) || chr(10), chr(10)) AS text,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source, n_chars
FROM documents
""")
def csv_round_trip(spark, sf_dir):
    path = fresh_dir(spark, "documents")
    cv.write_restore_csv(table(spark, sf_dir, "documents"), path)
    back = cv.read_extract(spark, path, ["doc_id", "text", "lang", "source", "n_chars"])
    return coerce(back, [ColumnDef("doc_id", "long"), ColumnDef("n_chars", "long")])


@query("csv_mixed_headers", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer
""")
def csv_mixed_headers(spark, sf_dir):
    """Pages with different column orders in one extract; cells land by header name."""
    path = fresh_dir(spark, "customer")
    customer = table(spark, sf_dir, "customer").withColumn("c_custkey", F.col("c_custkey").cast("string"))
    building = F.col("c_mktsegment") == "BUILDING"
    names = ["c_name", "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"]
    writer = {"header": True, "escape": '"'}
    customer.where(building).select(*names).write.options(**writer).csv(f"{path}/a")
    customer.where(~building).select(*names[::-1]).write.options(**writer).csv(f"{path}/b")
    back = cv.read_extract(spark, [f"{path}/a", f"{path}/b"], sorted(names), mixed_headers=True)
    return back.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


# ---- coercion -------------------------------------------------------------------------------


def _coerce_query(
    type_name: str, source: str, key: str, text: str, bad: str, sql_value: str,
    sql_empty: str = "NULL", sql_bad: str = "NULL", read: Callable[[Column], Column] = lambda c: c,
):
    """A Spark SQL text expression, with empty and unreadable text mixed in, coerced to one type.

    Every 7th key has empty text and every 11th the bad text; the rest keeps its value. ``read``
    brings the typed value into a form both engines print alike.
    """
    rejected = f"{key} % 7 <> 0 AND {key} % 11 = 0" if sql_bad == "NULL" else "false"

    @query(f"coerce_{type_name}", f"""
    SELECT {key} AS id, {rejected} AS rejected, CASE WHEN {key} % 7 = 0 THEN {sql_empty}
      WHEN {key} % 11 = 0 THEN {sql_bad} ELSE {sql_value} END AS value
    FROM {source}
    """)
    def run(spark, sf_dir):
        id_col = F.col(key)
        mixed = F.when(id_col % 7 == 0, "").when(id_col % 11 == 0, bad).otherwise(F.expr(text))
        frame = table(spark, sf_dir, source).select(id_col.alias("id"), mixed.alias("value"))
        checked = frame.withColumn("rejected", is_rejected("value", type_name))
        typed = coerce(checked, [ColumnDef("value", type_name)], on_error="null")
        return typed.withColumn("value", read(F.col("value")))


def _text(value: Column) -> Column:
    return value.cast("string")


_coerce_query("string", "documents", "doc_id", "text", "anything", "text", "''", "'anything'")
_coerce_query("long", "orders", "o_orderkey", "CAST(o_custkey AS STRING)", "1.0",
              "CAST(o_custkey AS VARCHAR)", read=_text)
_coerce_query("int", "part", "p_partkey", "'+' || p_size", "2147483648",
              "CAST(p_size AS VARCHAR)", read=_text)
_coerce_query("double", "orders", "o_orderkey", "CAST(o_totalprice AS STRING)", "1e999", "o_totalprice")
_coerce_query("float", "customer", "c_custkey", "CAST(c_acctbal AS STRING)", "1.0d",
              "CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE)", read=lambda c: c.cast("double"))
_coerce_query("boolean", "events", "event_id", "IF(event_type = 'click', 't', 'False')",
              "yes", "CAST(event_type = 'click' AS VARCHAR)", read=_text)
_coerce_query("date", "orders", "o_orderkey", "CAST(CAST(o_orderdate AS DATE) AS STRING)", "2023-02-29",
              "strftime(o_orderdate, '%Y-%m-%d')", read=_text)
_coerce_query(
    "timestamp", "events", "event_id",
    """CASE event_type WHEN 'click' THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
    WHEN 'view' THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+01:00'")
    ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END""",
    "2024-01-01",
    "CASE event_type WHEN 'click' THEN date_trunc('millisecond', ts) "
    "WHEN 'view' THEN ts - INTERVAL 1 HOUR ELSE ts END",
    read=lambda c: c.cast("timestamp_ntz"),
)
_coerce_query("binary", "pages", "page_id", "html", "%%%", "sha256(html)",
              sql_bad="sha256('%%%')", read=lambda c: F.sha2(c, 256))


def _messy_orders(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 5 == 0, F.concat(F.col("o_orderstatus"), F.lit("?"))).otherwise(key.cast("string")).alias("o_orderkey"),
        F.when(key % 3 == 0, F.col("o_orderpriority")).when(key % 4 == 0, "")
        .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 2 == 0, F.date_format("o_orderdate", "yyyy")).when(key % 13 == 0, None)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
    )


_MESSY = [
    ColumnDef("o_orderkey", "long", True), ColumnDef("o_totalprice", "double", True),
    ColumnDef("o_orderdate", "date", True),
]


@query("coercion_rejects", """
SELECT "column", value, count(*) AS n FROM (
  SELECT 'o_orderkey' AS "column", o_orderstatus || '?' AS value FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL
  SELECT 'o_totalprice', o_orderpriority FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT 'o_orderdate', strftime(o_orderdate, '%Y') FROM orders WHERE o_orderkey % 2 = 0
) GROUP BY ALL
""")
def coercion_rejects(spark, sf_dir):
    return cv.coercion_rejects(_messy_orders(spark, sf_dir), _MESSY)


ORDERS_BY_MONTH = ObjectSpec("orders", "o_orderkey", "o_orderdate", partition_by=(PartitionBy("o_orderdate", "month"),))
_MESSY_KEY = "CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus || '?' ELSE CAST(o_orderkey AS VARCHAR) END"


def _synced_messy(spark, sf_dir) -> str:
    """Orders with unreadable cells synced from CSV pages; rows with such cells are set aside."""
    root = fresh_dir(spark, "rejects")
    cv.write_restore_csv(_messy_orders(spark, sf_dir), f"{root}/extract")
    catalog = local_frame(
        spark, [("orders", i, c.name, {"long": "int"}.get(c.type, c.type), False) for i, c in enumerate(_MESSY)],
        "object string, position int, name string, type string, nillable boolean")
    cv.sync_object(spark, ORDERS_BY_MONTH, f"{root}/extract", catalog, root, sync_id="s1", on_error="reject")
    return root


@query("rejects_aside", f"""
SELECT {_MESSY_KEY} AS record_key, 'o_orderkey' AS "column", o_orderstatus || '?' AS value FROM orders WHERE o_orderkey % 5 = 0
UNION ALL
SELECT {_MESSY_KEY}, 'o_totalprice', o_orderpriority FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT {_MESSY_KEY}, 'o_orderdate', strftime(o_orderdate, '%Y') FROM orders WHERE o_orderkey % 2 = 0
""")
def rejects_aside(spark, sf_dir):
    """Every cell that kept a row out, with its record."""
    return cv.read_rejects(spark, ORDERS_BY_MONTH, _synced_messy(spark, sf_dir), "s1").select("record_key", "column", "value")


@query("rejects_typed", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate
FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 2 <> 0
""")
def rejects_typed(spark, sf_dir):
    """The rows that got in."""
    return cv.read_raw(spark, ORDERS_BY_MONTH, _synced_messy(spark, sf_dir)).select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("string").alias("o_orderdate"))


@query("required_violations", """
SELECT * FROM (
  SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey % 5 = 0) AS n FROM orders
  UNION ALL
  SELECT 'o_totalprice', count(*) FILTER (o_orderkey % 3 = 0 OR o_orderkey % 4 = 0) FROM orders
  UNION ALL
  SELECT 'o_orderdate', count(*) FILTER (o_orderkey % 2 = 0 OR o_orderkey % 13 = 0) FROM orders
) WHERE n > 0
""")
def required_violations(spark, sf_dir):
    typed = coerce(_messy_orders(spark, sf_dir), _MESSY, on_error="null")
    return cv.required_violations(typed, _MESSY)


# ---- schema ---------------------------------------------------------------------------------

# Source types by p_size modulo 10, as (source type, column type); the last two are compound.
_BY_SIZE = (
    ("id", "string"), ("int", "long"), ("currency", "double"), ("boolean", "boolean"),
    ("date", "date"), ("datetime", "timestamp"), ("base64", "binary"), ("anytype", "string"),
    ("address", None), ("location", None),
)


def _part_catalog(spark, sf_dir) -> DataFrame:
    """``part`` as field catalog: object = brand, twice the key names the field."""
    types = F.array(*[F.lit(t) for t, _ in _BY_SIZE])
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("object"),
        F.concat(F.lit("f"), (F.col("p_partkey") * 2).cast("string")).alias("name"),
        F.get(types, (F.col("p_size") % 10).cast("int")).alias("type"),
        (F.col("p_size") > 25).alias("nillable"),
    )


def _excludes(spark, sf_dir) -> DataFrame:
    """Fields excluded by config: those named after a supplier's key."""
    named = F.concat(F.lit("f"), (F.col("s_suppkey") * 10).cast("string"))
    brands = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("object"), F.concat(F.lit("f"), (F.col("p_partkey") * 2).cast("string")).alias("name")
    )
    return brands.join(table(spark, sf_dir, "supplier").select(named.alias("name")), "name").select("object", "name")


def _stored_columns(spark, sf_dir) -> DataFrame:
    """``customer`` and ``part`` as stored columns: field per customer key, in the brand of that part."""
    brand = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") * 2).alias("k"), "p_brand", (F.col("p_size") % 10).cast("int").alias("m")
    )
    types = F.array(*[F.lit(t or "string") for _, t in _BY_SIZE])
    key = F.col("c_custkey")
    home = F.coalesce("p_brand", F.concat(F.lit("Brand#"), (F.col("c_nationkey") % 5 + 11).cast("string")))
    stored_type = F.when(key % 6 == 0, "string").otherwise(F.coalesce(F.get(types, F.col("m")), F.lit("long")))
    return table(spark, sf_dir, "customer").join(brand, key == F.col("k"), "left").select(
        home.alias("object"),
        F.concat(F.lit("f"), key.cast("string")).alias("name"),
        stored_type.alias("type"),
        F.lit(False).alias("required"),
    )


def _policies(spark, sf_dir) -> DataFrame:
    """Per brand: halt where its highest price is odd, overflow where its smallest part key is."""
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("object")).agg(
        F.when(F.max("p_retailprice").cast("bigint") % 2 == 1, "halt").otherwise("tombstone").alias("removed_field_policy"),
        (F.min("p_partkey") % 2 == 1).alias("overflow"),
    )


_TYPE_CASE = "CASE p_size % 10 " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, (_, t) in enumerate(_BY_SIZE) if t
) + " END"

_CATALOG_SQL = f"""
WITH catalog AS (
  SELECT p_brand AS object, 'f' || CAST(p_partkey * 2 AS VARCHAR) AS name, p_partkey * 2 AS k,
    p_size % 10 >= 8 AS compound, {_TYPE_CASE} AS type, NOT (p_size > 25) AS required
  FROM part
), desired AS (
  SELECT object, name, type, required FROM catalog
  WHERE NOT compound AND name NOT IN (SELECT 'f' || CAST(s_suppkey * 10 AS VARCHAR) FROM supplier)
), stored AS (
  SELECT coalesce(p_brand, 'Brand#' || CAST(c_nationkey % 5 + 11 AS VARCHAR)) AS object,
    'f' || CAST(c_custkey AS VARCHAR) AS name,
    CASE WHEN c_custkey % 6 = 0 THEN 'string' WHEN p_brand IS NULL THEN 'long'
      ELSE coalesce({_TYPE_CASE}, 'string') END AS type, false AS required
  FROM customer LEFT JOIN part ON p_partkey * 2 = c_custkey
), compared AS (
  SELECT object, name, s.type AS old_type, d.type AS new_type,
    CASE WHEN s.type IS NULL THEN 'new' WHEN d.type IS NULL THEN 'removed'
      WHEN s.type <> d.type THEN 'type_change' END AS change
  FROM stored s FULL JOIN desired d USING (object, name)
), drift AS (SELECT * FROM compared WHERE change IS NOT NULL),
policies AS (
  SELECT p_brand AS object,
    CASE WHEN CAST(floor(max(p_retailprice)) AS BIGINT) % 2 = 1 THEN 'halt' ELSE 'tombstone' END AS policy,
    min(p_partkey) % 2 = 1 AS overflow
  FROM part GROUP BY p_brand
)
"""


def _desired(spark, sf_dir) -> DataFrame:
    return cv.columns_from_catalog(_part_catalog(spark, sf_dir), _excludes(spark, sf_dir))


def _drift(spark, sf_dir) -> DataFrame:
    return cv.detect_drift(_stored_columns(spark, sf_dir), _desired(spark, sf_dir))


@query("columns_from_catalog", _CATALOG_SQL + "SELECT object, name, type, required FROM desired")
def columns_from_catalog(spark, sf_dir):
    return _desired(spark, sf_dir)


@query("detect_drift", _CATALOG_SQL + "SELECT object, change, name, old_type, new_type FROM drift")
def detect_drift(spark, sf_dir):
    return _drift(spark, sf_dir)


@query("type_changes", _CATALOG_SQL + """
SELECT object, name, old_type, new_type FROM drift WHERE change = 'type_change'
""")
def type_changes(spark, sf_dir):
    return cv.type_changes(_drift(spark, sf_dir))


@query("drift_intentional", _CATALOG_SQL + """
SELECT object, change, name, old_type, new_type FROM drift d
WHERE NOT (change = 'removed' AND EXISTS (
  SELECT 1 FROM catalog c WHERE c.object = d.object AND c.name = d.name))
""")
def drift_intentional(spark, sf_dir):
    return cv.without_intentional(_drift(spark, sf_dir), _part_catalog(spark, sf_dir))


@query("removed_policy", _CATALOG_SQL + """
SELECT d.object, name, coalesce(policy, 'tombstone') AS action
FROM drift d LEFT JOIN policies p ON p.object = d.object WHERE change = 'removed'
""")
def removed_policy(spark, sf_dir):
    return cv.removed_policy(_drift(spark, sf_dir), _policies(spark, sf_dir))


@query("evolve_schema", _CATALOG_SQL + """
SELECT object, name, type, required FROM stored
UNION ALL
SELECT object, name, new_type, false FROM drift
WHERE change = 'new' AND object NOT IN (SELECT object FROM policies WHERE overflow)
""")
def evolve_schema(spark, sf_dir):
    return cv.evolve(_stored_columns(spark, sf_dir), _drift(spark, sf_dir), _policies(spark, sf_dir))


@query("dry_run_report", _CATALOG_SQL + """
SELECT object, count(old_type) AS current_columns, count(new_type) AS desired_columns,
  count(*) FILTER (change = 'new') AS n_new, count(*) FILTER (change = 'removed') AS n_removed,
  count(*) FILTER (change = 'type_change') AS n_type_change,
  CAST(to_json(coalesce(list(name ORDER BY name) FILTER (change = 'new'), [])) AS VARCHAR) AS new_columns,
  CAST(to_json(coalesce(list(name ORDER BY name) FILTER (change = 'removed'), [])) AS VARCHAR) AS removed_columns,
  CAST(to_json(coalesce(list(name ORDER BY name) FILTER (change = 'type_change'), [])) AS VARCHAR) AS changed_columns,
  count(old_type) > 0 AND count(new_type) > 0 AND count(change) > 0 AS drift_detected,
  CASE WHEN count(old_type) = 0 THEN 'create' WHEN count(new_type) = 0 THEN 'missing'
    WHEN count(change) > 0 THEN 'drift' ELSE 'same' END AS status
FROM compared GROUP BY object
""")
def dry_run_report(spark, sf_dir):
    report = cv.dry_run(_stored_columns(spark, sf_dir), _desired(spark, sf_dir))
    return report.withColumns({c: F.to_json(c) for c in ("new_columns", "removed_columns", "changed_columns")})


# ---- records --------------------------------------------------------------------------------


@query("spill_overflow", """
SELECT event_id, user_id, ts, event_type, props, value, 'event_type,props,value' AS keys FROM events
""")
def spill_overflow(spark, sf_dir):
    """What was spilled, read back from the JSON: engines print doubles differently."""
    spilled = cv.spill_overflow(table(spark, sf_dir, "events"), ["event_id", "user_id", "ts"])
    cells = F.from_json("_overflow", "event_type string, props string, value double")
    return spilled.select(
        "event_id", "user_id", "ts", cells.alias("cells"),
        F.concat_ws(",", F.json_object_keys("_overflow")).alias("keys"),
    ).select("event_id", "user_id", "ts", "cells.*", "keys")


@query("align_schema", """
SELECT o_orderstatus, CAST(NULL AS DOUBLE) AS discount, o_orderkey, CAST(NULL AS VARCHAR) AS note
FROM orders
""")
def align_schema(spark, sf_dir):
    return cv.align(table(spark, sf_dir, "orders"), [
        ColumnDef("o_orderstatus", "string"), ColumnDef("discount", "double"),
        ColumnDef("o_orderkey", "long"), ColumnDef("note", "string"),
    ])


@query("valid_record_ids", """
WITH ids AS (
  SELECT c_name AS record_id FROM customer UNION ALL SELECT c_mktsegment FROM customer
  UNION ALL SELECT o_orderpriority FROM orders UNION ALL SELECT event_type FROM events
)
SELECT record_id, regexp_full_match(record_id, '[a-zA-Z0-9]+') AS is_valid FROM ids
""")
def valid_record_ids(spark, sf_dir):
    columns = (("customer", "c_name"), ("customer", "c_mktsegment"), ("orders", "o_orderpriority"),
               ("events", "event_type"))
    frames = [table(spark, sf_dir, t).select(F.col(c).alias("record_id")) for t, c in columns]
    return cv.valid_record_ids(reduce(DataFrame.unionByName, frames), "record_id")


@query("stringify", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal,
  CASE WHEN c_nationkey % 4 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def stringify(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    text = cv.stringify(customer.select(
        "c_custkey", "c_name", "c_acctbal",
        F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    ))
    return text.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("job_status", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_custkey AS records_processed,
  CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 2 = 0
      THEN '["' || CAST(o_orderkey % 3 AS VARCHAR) || ' record(s) failed","' || o_orderpriority || '"]'
    WHEN o_orderkey % 3 > 0 THEN '["' || CAST(o_orderkey % 3 AS VARCHAR) || ' record(s) failed"]'
    WHEN o_orderkey % 2 = 0 THEN '["' || o_orderpriority || '"]' ELSE '[]' END AS errors
FROM orders
""")
def job_status(spark, sf_dir):
    key = F.col("o_orderkey")
    jobs = table(spark, sf_dir, "orders").select(
        key.cast("string").alias("id"), F.col("o_orderstatus").alias("state"),
        F.col("o_custkey").alias("processed"), (key % 3).alias("failed"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("error_message"),
    )
    return cv.job_status(jobs).withColumn("errors", F.to_json("errors"))


@query("restore_export", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, CAST(user_id AS VARCHAR) AS user_id, value
FROM (SELECT *, {_RANKED} AS rn FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1
""")
def restore_export(spark, sf_dir):
    path = fresh_dir(spark, "restore")
    versions = cv.latest_per_key(table(spark, sf_dir, "events"), ["user_id", "ts"], "event_id")
    cv.restore_export(versions, EVENTS, AT, path)
    back = cv.read_extract(spark, path)
    return back.withColumn("value", F.col("value").cast("double"))


# ---- relations ------------------------------------------------------------------------------


@query("parent_refs", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  c_name AS "o_custkey:customer:c_name"
FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def parent_refs(spark, sf_dir):
    return cv.rewrite_parent_refs(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"),
        "o_custkey", "customer", "c_custkey", "c_name",
    )


@query("restore_levels", """
SELECT 'region ' || r_regionkey AS object, 0 AS level FROM region
UNION ALL SELECT 'nation ' || n_nationkey, 1 FROM nation
UNION ALL SELECT 'customer ' || c_custkey, 2 FROM customer
UNION ALL SELECT 'supplier ' || s_suppkey, 2 FROM supplier
UNION ALL SELECT DISTINCT 'order ' || o_orderkey, 3 FROM orders
""")
def restore_levels(spark, sf_dir):
    """Records as nodes: region, nation, customer and supplier, order, each after its parent."""

    def node(kind: str, key: str) -> Column:
        return F.concat(F.lit(kind + " "), F.col(key).cast("string"))

    links = (
        ("region", "region", "r_regionkey", None, None),
        ("nation", "nation", "n_nationkey", "region", "n_regionkey"),
        ("customer", "customer", "c_custkey", "nation", "c_nationkey"),
        ("supplier", "supplier", "s_suppkey", "nation", "s_nationkey"),
        ("orders", "order", "o_orderkey", "customer", "o_custkey"),
    )
    edges = [
        table(spark, sf_dir, name).select(
            node(kind, key).alias("object"),
            (node(parent, ref) if parent else node(kind, key)).alias("parent"),
        )
        for name, kind, key, parent, ref in links
    ]
    return cv.restore_levels(reduce(DataFrame.unionByName, edges))


@query("canonical_id", """
WITH first AS (
  SELECT user_id, coalesce(min(ts) FILTER (ts >= TIMESTAMP '2024-01-11 00:00:00'), min(ts)) AS first_ts
  FROM events GROUP BY user_id
)
SELECT event_id, ts, user_id, event_type, value, props, event_type = 'error' AS is_deleted,
  sha256('events:' || user_id || ':' || CAST(first_ts AS VARCHAR)) AS canonical_id
FROM events JOIN first USING (user_id)
""")
def canonical_id(spark, sf_dir):
    """Ids are given after a first sync; a second sync brings older versions, which change none."""
    root = fresh_dir(spark, "canonical")
    log = change_log(spark, sf_dir).withColumn("ts", utc("ts"))
    early = F.col("ts") < F.lit("2024-01-11 00:00:00Z").cast("timestamp")
    for sync_id, part in (("late", ~early), ("early", early)):
        cv.append_raw(log.where(part), EVENTS_BY_DAY, root, sync_id)
        cv.register_ids(spark, EVENTS_BY_DAY, root)
    ids = cv.read_ids(spark, EVENTS_BY_DAY, root)
    raw = _events_back(cv.read_raw(spark, EVENTS_BY_DAY, root))
    return cv.assign_canonical_id(raw, EVENTS_BY_DAY, ids)


_RELATED = {
    "region": ("r_regionkey", {}), "nation": ("n_nationkey", {"n_regionkey": "region"}),
    "customer": ("c_custkey", {"c_nationkey": "nation"}), "orders": ("o_orderkey", {"o_custkey": "customer"}),
}


@query("restore_related", """
WITH ids AS (
  SELECT 'region' AS object, r_regionkey AS k, sha256('region:' || r_regionkey || ':2024-01-01 00:00:00') AS id FROM region
  UNION ALL SELECT 'nation', n_nationkey, sha256('nation:' || n_nationkey || ':2024-01-01 00:00:00') FROM nation
  UNION ALL SELECT 'customer', c_custkey, sha256('customer:' || c_custkey || ':2024-01-01 00:00:00') FROM customer
  UNION ALL SELECT 'orders', o_orderkey, sha256('orders:' || o_orderkey || ':2024-01-01 00:00:00') FROM orders
)
SELECT 'region' AS object, 0 AS level, CAST(r_regionkey AS VARCHAR) AS record_key, i.id AS canonical_id,
  CAST(NULL AS VARCHAR) AS parent_id, r_name AS name, CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS kind,
  CAST(NULL AS VARCHAR) AS priority, CAST(NULL AS TIMESTAMP) AS day
FROM region JOIN ids i ON i.object = 'region' AND i.k = r_regionkey
UNION ALL
SELECT 'nation', 1, CAST(n_nationkey AS VARCHAR), i.id, p.id, n_name, NULL, NULL, NULL, NULL
FROM nation JOIN ids i ON i.object = 'nation' AND i.k = n_nationkey LEFT JOIN ids p ON p.object = 'region' AND p.k = n_regionkey
UNION ALL
SELECT 'customer', 2, CAST(c_custkey AS VARCHAR), i.id, p.id, c_name, c_acctbal, c_mktsegment, NULL, NULL
FROM customer JOIN ids i ON i.object = 'customer' AND i.k = c_custkey LEFT JOIN ids p ON p.object = 'nation' AND p.k = c_nationkey
UNION ALL
SELECT 'orders', 3, CAST(o_orderkey AS VARCHAR), i.id, p.id, NULL, o_totalprice, o_orderstatus, o_orderpriority, o_orderdate
FROM orders JOIN ids i ON i.object = 'orders' AND i.k = o_orderkey LEFT JOIN ids p ON p.object = 'customer' AND p.k = o_custkey
""")
def restore_related(spark, sf_dir):
    """Four related objects written in restore order, and all pages read back."""
    root = fresh_dir(spark, "related")
    specs = [ObjectSpec(name, key, "stamp") for name, (key, _) in _RELATED.items()]
    fields = []
    for spec in specs:
        rows = table(spark, sf_dir, spec.name)
        stamped = rows.select(*[utc(c) if t == "timestamp_ntz" else F.col(c) for c, t in rows.dtypes]).withColumn(
            "stamp", F.lit("2024-01-01 00:00:00Z").cast("timestamp"))
        cv.append_raw(stamped, spec, root, "first")
        parents = _RELATED[spec.name][1]
        fields += [(spec.name, c, "reference" if c in parents else "string", None, None, None, True, [parents[c]] if c in parents else None)
                   for c in stamped.columns]
    pages = cv.restore_related(spark, specs, local_frame(spark, fields, CATALOG_SCHEMA), root, AT, f"{root}/out")
    names = {"region": ("r_name", None, None, None, None), "nation": ("n_name", None, None, None, None),
             "customer": ("c_name", "c_acctbal", "c_mktsegment", None, None),
             "orders": (None, "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate")}

    def cell(name: str | None, kind: str = "string") -> Column:
        return F.lit(None).cast(kind) if name is None else F.nullif(F.col(f"`{name}`"), F.lit("")).cast(kind)

    def one(page) -> DataFrame:
        key, parents = _RELATED[page.object]
        name, amount, kind, priority, day = names[page.object]
        ref = next((f"{field}:{parent}:canonical_id" for field, parent in parents.items()), None)
        day = F.lit(None).cast("timestamp_ntz") if day is None else F.rtrim(F.col(day), F.lit("Z")).cast("timestamp_ntz")
        return cv.read_extract(spark, page.path).select(
            F.lit(page.object).alias("object"), F.lit(page.level).alias("level"), F.col(key).alias("record_key"), "canonical_id",
            cell(ref).alias("parent_id"), cell(name).alias("name"), cell(amount, "double").alias("amount"),
            cell(kind).alias("kind"), cell(priority).alias("priority"), day.alias("day"))

    return reduce(DataFrame.unionByName, map(one, pages))


@query("owner_refs", """
SELECT o_orderkey, o_orderpriority,
  CASE WHEN o_orderkey % 2 = 0 THEN sha256('users:U' || o_custkey || ':2024-01-01 00:00:00') END AS "owner:users:canonical_id",
  CASE WHEN o_orderkey % 2 = 1 AND o_custkey % 20 < (SELECT count(*) FROM supplier)
    THEN sha256('teams:T' || (o_custkey % 20) || ':2024-01-01 00:00:00') END AS "owner:teams:canonical_id"
FROM orders
""")
def owner_refs(spark, sf_dir):
    """Tasks whose owner is a user or a team, by one reference field; some teams do not exist."""
    stamp = F.lit("2024-01-01 00:00:00Z").cast("timestamp").alias("stamp")
    users = table(spark, sf_dir, "customer").select(F.concat(F.lit("U"), "c_custkey").alias("id"), stamp)
    teams = table(spark, sf_dir, "supplier").select(F.concat(F.lit("T"), "s_suppkey").alias("id"), stamp)
    owner = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("U"), "o_custkey")).otherwise(
        F.concat(F.lit("T"), (F.col("o_custkey") % 20).cast("string")))
    tasks = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", owner.alias("owner"))
    ids = {n: cv.canonical_ids(df, ObjectSpec(n, "id", "stamp")) for n, df in (("users", users), ("teams", teams))}
    return cv.rewrite_refs_to_any(tasks, "owner", ids)


_KIN = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey"}


def _kin(spark, sf_dir, root: str, **extra: Callable[[DataFrame], DataFrame]) -> list[ObjectSpec]:
    """Objects with the stamp 2024-01-01, each changed by the function of its name, in a vault of their own."""
    specs = [ObjectSpec(name, _KIN[name], "stamp") for name in extra]
    for spec in specs:
        rows = extra[spec.name](table(spark, sf_dir, spec.name))
        cv.append_raw(rows.withColumn("stamp", F.lit("2024-01-01 00:00:00Z").cast("timestamp")), spec, root, "first")
    return specs


def _references(spark, *fields: tuple[str, str, list[str]]) -> DataFrame:
    rows = [(o, n, "reference", None, None, None, True, parents) for o, n, parents in fields]
    return local_frame(spark, rows, CATALOG_SCHEMA)


def _cells(page, *names: str) -> list[Column]:
    """Columns of a page, those it has not as NULL; empty cells are NULL."""
    return [F.nullif(F.col(f"`{n}`"), F.lit("")) if n in page.columns else F.lit(None).cast("string") for n in names]


_KIN_ID = "sha256('{0}:' || {1} || ':2024-01-01 00:00:00')"


@query("restore_staff", f"""
SELECT CAST(c_custkey AS VARCHAR) AS record_key, {_KIN_ID.format("customer", "c_custkey")} AS canonical_id,
  CASE WHEN c_custkey > 0 THEN {_KIN_ID.format("customer", "(c_custkey // 8)")} END AS manager_id,
  CASE WHEN c_custkey = 0 THEN 0 WHEN c_custkey < 8 THEN 1 WHEN c_custkey < 64 THEN 2 WHEN c_custkey < 512 THEN 3
    WHEN c_custkey < 4096 THEN 4 WHEN c_custkey < 32768 THEN 5 WHEN c_custkey < 262144 THEN 6 ELSE 7 END AS wave
FROM customer
""")
def restore_staff(spark, sf_dir):
    """One object whose records refer to each other: managers lie in an earlier page folder than their staff."""
    root = fresh_dir(spark, "staff")
    specs = _kin(spark, sf_dir, root, customer=lambda df: df.select("c_custkey", "c_name", F.expr(
        "CASE WHEN c_custkey > 0 THEN c_custkey div 8 END AS manager")))
    pages = cv.restore_related(
        spark, specs, _references(spark, ("customer", "manager", ["customer"])), root, AT, f"{root}/out")

    def one(page) -> DataFrame:
        rows = cv.read_extract(spark, page.path)
        return rows.select(*[c.alias(n) for c, n in zip(
            _cells(rows, "c_custkey", "canonical_id", "manager:customer:canonical_id"), ("record_key", "canonical_id", "manager_id")
        )], F.lit(page.wave).alias("wave"))

    return reduce(DataFrame.unionByName, map(one, pages))


@query("restore_cycle", f"""
WITH capitals AS (SELECT n_regionkey AS r, min(n_nationkey) AS capital FROM nation GROUP BY n_regionkey)
SELECT 'region' AS object, 0 AS level, CAST(r_regionkey AS VARCHAR) AS record_key, {_KIN_ID.format("region", "r_regionkey")} AS canonical_id,
  r_name AS name, CAST(NULL AS VARCHAR) AS parent_id
FROM region
UNION ALL SELECT 'nation', 0, CAST(n_nationkey AS VARCHAR), {_KIN_ID.format("nation", "n_nationkey")}, n_name, NULL FROM nation
UNION ALL SELECT 'region', 1, NULL, {_KIN_ID.format("region", "r")}, NULL, {_KIN_ID.format("nation", "capital")} FROM capitals
UNION ALL SELECT 'nation', 1, NULL, {_KIN_ID.format("nation", "n_nationkey")}, NULL, {_KIN_ID.format("region", "n_regionkey")} FROM nation
UNION ALL SELECT 'customer', 1, CAST(c_custkey AS VARCHAR), {_KIN_ID.format("customer", "c_custkey")}, c_name,
  {_KIN_ID.format("nation", "c_nationkey")} FROM customer
""")
def restore_cycle(spark, sf_dir):
    """Regions name their capital's nation and nations their region; customers hang behind. All payloads read back: whole
    records without the cyclic references, then these."""
    root = fresh_dir(spark, "cycle")
    capital = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.min("n_nationkey").alias("capital"))
    specs = _kin(spark, sf_dir, root, region=lambda df: df.join(capital, "r_regionkey"), nation=lambda df: df, customer=lambda df: df)
    fields = (("region", "capital", ["nation"]), ("nation", "n_regionkey", ["region"]), ("customer", "c_nationkey", ["nation"]))
    pages = cv.restore_related(spark, specs, _references(spark, *fields), root, AT, f"{root}/out")
    refs = {o: f"{f}:{p}:canonical_id" for o, f, (p,) in fields}
    names = {"region": "r_name", "nation": "n_name", "customer": "c_name"}

    def one(page) -> DataFrame:
        rows = cv.read_extract(spark, page.path)
        cells = _cells(rows, _KIN[page.object], "canonical_id", names[page.object], refs[page.object])
        return rows.select(F.lit(page.object).alias("object"), F.lit(page.level).alias("level"), *[
            c.alias(n) for c, n in zip(cells, ("record_key", "canonical_id", "name", "parent_id"))])

    return reduce(DataFrame.unionByName, map(one, pages))


@query("reference_cycles", """
WITH capitals AS (SELECT n_regionkey AS r, min(n_nationkey) AS capital FROM nation GROUP BY n_regionkey)
SELECT 'region ' || r_regionkey AS object, 'core' AS place, 1 AS level FROM region
UNION ALL SELECT 'nation ' || n_nationkey, CASE WHEN capital IS NULL THEN 'behind' ELSE 'core' END,
  CASE WHEN capital IS NULL THEN 2 ELSE 1 END FROM nation LEFT JOIN capitals ON capital = n_nationkey
UNION ALL SELECT 'customer ' || c_custkey, 'behind', CASE WHEN capital IS NULL THEN 3 ELSE 2 END
  FROM customer LEFT JOIN capitals ON capital = c_nationkey
UNION ALL SELECT 'order ' || o_orderkey, 'behind', CASE WHEN capital IS NULL THEN 4 ELSE 3 END
  FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN capitals ON capital = c_nationkey
UNION ALL SELECT 'part ' || p_partkey, 'free', 0 FROM part
""")
def reference_cycles(spark, sf_dir):
    """Records as nodes: regions and their capital's nations refer to each other, the rest hangs behind them or is free."""

    def node(kind: str, key: str) -> Column:
        return F.concat(F.lit(kind + " "), F.col(key).cast("string"))

    nation = table(spark, sf_dir, "nation")
    capital = nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("capital"))
    edges = [
        capital.select(node("region", "n_regionkey").alias("object"), node("nation", "capital").alias("parent")),
        nation.select(node("nation", "n_nationkey"), node("region", "n_regionkey")),
        table(spark, sf_dir, "customer").select(node("customer", "c_custkey"), node("nation", "c_nationkey")),
        table(spark, sf_dir, "orders").select(node("order", "o_orderkey"), node("customer", "o_custkey")),
        table(spark, sf_dir, "part").select(node("part", "p_partkey"), node("part", "p_partkey")),
    ]
    return cv.restore_plan(reduce(DataFrame.union, edges))


# ---- jobs -----------------------------------------------------------------------------------


EVENTS_BY_DAY = ObjectSpec(
    "events", "user_id", "ts", partition_by=(PartitionBy("ts", "day"),), deleted_field="is_deleted"
)
_EVENT_ROWS = "SELECT event_id, ts, user_id, event_type, value, props, event_type = 'error' AS is_deleted FROM events"


def _events_back(df: DataFrame, *extra: str) -> DataFrame:
    names = (*EVENT_COLUMNS, "is_deleted")
    return df.select(*[ntz(c) if c == "ts" else F.col(c) for c in names], *extra)


#: The third of the month an event lies in, from 0, in both dialects.
_THIRD = "CAST(least(floor((day(ts) - 1) / 10), 2) AS INT)"


def _halved_thirds(spark, sf_dir, root: str) -> DataFrame:
    """The change log in six commits: each third of the month in two, by even and odd event."""
    log = change_log(spark, sf_dir).withColumn("ts", utc("ts"))
    for third in range(3):
        for half in range(2):
            part = log.where(f"{_THIRD} = {third} AND event_id % 2 = {half}")
            cv.append_raw(part, EVENTS_BY_DAY, root, f"third-{third}-{half}")
    return log


def _newest_days(log: DataFrame) -> list:
    return [r[0] for r in log.groupBy(F.expr(_THIRD).alias("third")).agg(F.to_date(F.max("ts"))).orderBy("third").select(
        "to_date(max(ts))").collect()]


@query("compact", f"""
SELECT event_id, ts, user_id, event_type, value, props, event_type = 'error' AS is_deleted,
  CAST(1 AS BIGINT) AS n_commits, count(*) OVER (PARTITION BY {_THIRD}) AS rewritten, CAST(0 AS BIGINT) AS again
FROM events
""")
def compact(spark, sf_dir):
    """Three runs on three data days, and each once more; every row with what its day's runs rewrote, and the
    commits its third lies in afterwards."""
    root = fresh_dir(spark, "compact")
    days = _newest_days(_halved_thirds(spark, sf_dir, root))
    first = [cv.compact(spark, EVENTS_BY_DAY, root, day=day).rows for day in days]
    again = [cv.compact(spark, EVENTS_BY_DAY, root, day=day).rows for day in days]
    runs = local_frame(spark, zip(range(3), first, again), "third int, rewritten bigint, again bigint")
    raw = cv.read_raw(spark, EVENTS_BY_DAY, root).withColumn("third", F.expr(_THIRD))
    stored = raw.groupBy("third").agg(F.countDistinct("_commit").alias("n_commits"))
    return _events_back(raw.join(runs.join(stored, "third"), "third"), "n_commits", "rewritten", "again")


@query("live_commits", f"""
WITH thirds AS (SELECT *, {_THIRD} AS third FROM events)
SELECT event_id, ts, user_id, event_type, value, props, event_type = 'error' AS is_deleted,
  count(*) OVER (PARTITION BY third, CASE WHEN third = 2 THEN event_id % 2 END) AS commit_rows
FROM thirds
""")
def live_commits(spark, sf_dir):
    """The rows that survive when two of three data days are packed, each with the size of the commit that holds it."""
    root = fresh_dir(spark, "live")
    days = _newest_days(_halved_thirds(spark, sf_dir, root))
    for day in days[:2]:
        cv.compact(spark, EVENTS_BY_DAY, root, day=day)
    live = cv.live_commits(cv.read_ledger(spark, root, "events")).select("commit_id", F.col("n_rows").alias("commit_rows"))
    raw = cv.read_raw(spark, EVENTS_BY_DAY, root)
    return _events_back(raw.join(live, F.col("_commit") == F.col("commit_id")), "commit_rows")


CUSTOMER_ORDERS = ObjectSpec(
    "customer_orders", "o_custkey", "o_orderdate", partition_by=(PartitionBy("o_orderdate", "month"),)
)


@query("expire", """
WITH versions AS (
  SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1
)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, false AS in_baseline,
  CAST(0 AS BIGINT) AS replaced_again
FROM versions WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true, 0 FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rn FROM versions
  WHERE o_orderdate < TIMESTAMP '1997-01-01 00:00:00'
) WHERE rn = 1
""")
def expire(spark, sf_dir):
    """Orders as versions of their customer, one per stamp, in two syncs; then a retention run, a compaction of the newest
    data day and a retention run with the same cutoff, which finds nothing to replace."""
    root = fresh_dir(spark, "expire")
    spec = CUSTOMER_ORDERS
    versions = cv.latest_per_key(_orders(spark, sf_dir), ["o_custkey", "o_orderdate"], "o_orderkey")
    old = F.col("o_orderdate") < F.lit("1996-01-01 00:00:00Z").cast("timestamp")
    cv.append_raw(versions.where(old), spec, root, "old")
    cv.append_raw(versions.where(~old), spec, root, "new")
    window = dict(keep_days=60, as_of=moment("1997-01-01T00:00:00Z") + timedelta(days=60))
    baseline = cv.expire(spark, spec, root, **window).commit_id
    cv.compact(spark, spec, root, day=cv.get_watermark(spark, root, spec.name).date())
    again = cv.expire(spark, spec, root, **window)
    raw = cv.read_raw(spark, spec, root)
    return _orders_back(raw, (F.col("_commit") == baseline).alias("in_baseline"),
                        F.lit(len(again.replaced)).cast("long").alias("replaced_again"))


def _event_extracts(spark, sf_dir, root: str) -> dict[str, str]:
    """The change log as CSV extracts: everything up to day 10, and everything after."""
    log = change_log(spark, sf_dir).withColumn("ts", utc("ts"))
    early = F.col("ts") < F.lit("2024-01-11 00:00:00Z").cast("timestamp")
    paths = {"early": f"{root}/extract/early", "late": f"{root}/extract/late"}
    cv.write_restore_csv(log.where(early), paths["early"])
    cv.write_restore_csv(log.where(~early), paths["late"])
    return paths


def _event_catalog(spark, objects=("events",)) -> DataFrame:
    fields = (("event_id", "int"), ("ts", "datetime"), ("user_id", "int"), ("event_type", "picklist"),
              ("value", "double"), ("props", "textarea"), ("is_deleted", "boolean"))
    return local_frame(
        spark, [(o, i, n, t, n == "props") for o in objects for i, (n, t) in enumerate(fields)],
        "object string, position int, name string, type string, nillable boolean",
    )


@query("sync_object", _EVENT_ROWS)
def sync_object(spark, sf_dir):
    root = fresh_dir(spark, "sync")
    catalog = _event_catalog(spark)
    for sync_id, path in _event_extracts(spark, sf_dir, root).items():
        cv.sync_object(spark, EVENTS_BY_DAY, path, catalog, root, sync_id=sync_id)
    return _events_back(cv.read_raw(spark, EVENTS_BY_DAY, root))


@query("sync_all", """
SELECT CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'others' END AS object,
  event_id, ts, user_id, event_type, value, props, event_type = 'error' AS is_deleted FROM events
""")
def sync_all(spark, sf_dir):
    """Two objects synced side by side."""
    root = fresh_dir(spark, "sync-all")
    specs = [ObjectSpec(n, "event_id", "ts", deleted_field="is_deleted") for n in ("clicks", "others")]
    log = change_log(spark, sf_dir).withColumn("ts", utc("ts"))
    click = F.col("event_type") == "click"
    cv.write_restore_csv(log.where(click), f"{root}/extract/clicks")
    cv.write_restore_csv(log.where(~click), f"{root}/extract/others")
    catalog = _event_catalog(spark, [s.name for s in specs])
    cv.sync_all(spark, specs, lambda name: f"{root}/extract/{name}", catalog, root)
    return reduce(DataFrame.unionByName, [
        _events_back(cv.read_raw(spark, s, root)).withColumn("object", F.lit(s.name)) for s in specs
    ])


# Versions with equal stamps are told apart by the sync that brought them, then by row hash.
# The merge queries therefore take one version per user and stamp from the change log.
_ONE_PER_STAMP = """
WITH versions AS (
  SELECT *, event_type = 'error' AS is_deleted FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1
), latest AS (
  SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
)
SELECT event_id, ts, user_id, event_type, value, props, is_deleted FROM latest WHERE NOT is_deleted
"""


def _synced_versions(spark, sf_dir, root: str, merge_between: bool) -> None:
    log = change_log(spark, sf_dir).withColumn("ts", utc("ts"))
    versions = cv.latest_per_key(log, ["user_id", "ts"], "event_id")
    early = F.col("ts") < F.lit("2024-01-11 00:00:00Z").cast("timestamp")
    for sync_id, part in (("late", ~early), ("early", early)):
        cv.append_raw(versions.where(part), EVENTS_BY_DAY, root, sync_id)
        if merge_between:
            cv.merge_all(spark, [EVENTS_BY_DAY], root)


@query("merge_all", _ONE_PER_STAMP)
def merge_all(spark, sf_dir):
    """Merged after each of two syncs, of which the second brings the older rows."""
    root = fresh_dir(spark, "merge")
    _synced_versions(spark, sf_dir, root, merge_between=True)
    return _events_back(cv.read_current(spark, EVENTS_BY_DAY, root))


@query("current_pending", _ONE_PER_STAMP)
def current_pending(spark, sf_dir):
    """Current state read through two syncs that no merge has covered: older versions that arrive late, and all newer ones
    once more after a merge of the first days."""
    root = fresh_dir(spark, "pending")
    log = change_log(spark, sf_dir).withColumn("ts", utc("ts"))
    versions = cv.latest_per_key(log, ["user_id", "ts"], "event_id")
    day = F.to_date("ts")
    cv.append_raw(versions.where(day.between("2024-01-08", "2024-01-20")), EVENTS_BY_DAY, root, "merged")
    cv.merge_all(spark, [EVENTS_BY_DAY], root)
    cv.append_raw(versions.where(day < "2024-01-11"), EVENTS_BY_DAY, root, "late")
    cv.append_raw(versions.where(day > "2024-01-15"), EVENTS_BY_DAY, root, "new")
    return _events_back(cv.read_current(spark, EVENTS_BY_DAY, root, pending=True))


# A wide object: the supplier's four columns in 99 variants each.
_WIDE = [c for i in range(99) for c in (
    (f"s_suppkey + {i}", f"key_{i}", "int"), (f"s_acctbal * {i + 1}", f"amount_{i}", "double"),
    (f"s_name || '-{i}'", f"name_{i}", "string"), (f"s_nationkey % 25 = {i % 25}", f"flag_{i}", "boolean"),
)]
_WIDE_SQL = ", ".join(f"{expression} AS {name}" for expression, name, _ in _WIDE)


@query("wide_object", f"SELECT s_suppkey AS id, {_WIDE_SQL} FROM supplier")
def wide_object(spark, sf_dir):
    """399 fields synced from CSV pages, merged twice, and read as current state."""
    root = fresh_dir(spark, "wide")
    spec = ObjectSpec("wide", "id", "stamp", deleted_field="deleted")
    fields = [("id", "int"), ("stamp", "datetime"), ("deleted", "boolean"), *((n, t) for _, n, t in _WIDE)]
    catalog = local_frame(spark, [("wide", i, n, t, True) for i, (n, t) in enumerate(fields)],
                          "object string, position int, name string, type string, nillable boolean")
    rows = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "CAST('2024-01-01 00:00:00Z' AS TIMESTAMP) AS stamp", "false AS deleted",
        *[f"{expression} AS {name}" for expression, name, _ in _WIDE])
    for half in (0, 1):
        cv.write_restore_csv(rows.where(F.col("id") % 2 == half), f"{root}/extract/{half}")
        cv.sync_object(spark, spec, f"{root}/extract/{half}", catalog, root, sync_id=f"s{half}", filter_watermark=False)
        cv.refresh_current(spark, spec, root)
    return cv.read_current(spark, spec, root).drop("stamp", "deleted", "_overflow")


@query("sync_stream", """
SELECT event_id, ts, user_id, event_type, value,
  CASE WHEN ts >= TIMESTAMP '2024-01-06 00:00:00' THEN props END AS props, event_type = 'error' AS is_deleted
FROM events
""")
def sync_stream(spark, sf_dir):
    """Two landing folders, each with a checkpoint of its own; the first gets pages of two headers in two runs."""
    root = fresh_dir(spark, "sync-stream")
    log = change_log(spark, sf_dir).withColumn("ts", utc("ts"))
    day = F.to_date("ts")
    fields = _event_catalog(spark)
    known = {"catalog": fields.where("name <> 'props'")}

    def run(part: DataFrame, landing: str, page: str) -> None:
        cv.write_restore_csv(part, f"{root}/{landing}/{page}")
        cv.sync_stream(
            spark, EVENTS_BY_DAY, f"{root}/{landing}", lambda: known["catalog"], root, f"{root}/checkpoint-{landing}"
        ).awaitTermination()

    run(log.where(day < "2024-01-06").drop("props"), "one", "a")
    known["catalog"] = fields
    run(log.where(day.between("2024-01-06", "2024-01-15")), "one", "b")
    run(log.where(day > "2024-01-15"), "two", "a")
    return _events_back(cv.read_raw(spark, EVENTS_BY_DAY, root))


@query("current_stream", _ONE_PER_STAMP)
def current_stream(spark, sf_dir):
    root = fresh_dir(spark, "current-stream")
    _synced_versions(spark, sf_dir, root, merge_between=False)
    cv.current_stream(
        spark, EVENTS_BY_DAY, root, f"{root}/checkpoint", max_commits_per_trigger=1
    ).awaitTermination()
    return _events_back(cv.read_current(spark, EVENTS_BY_DAY, root))
