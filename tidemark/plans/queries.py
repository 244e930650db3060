"""Registered queries: every operator on the given tables or on histories derived from them, with the SQL it is held against."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import business_key, entity_file_name, iso_text, lenient_date, markup_field, portable_key, redacted, row_hash, translated
from tidemark.operators import cdc, dimensions, facts, observability, quality, relational
from tidemark.operators.incremental import ChangeTable, Cursor, daily
from tidemark.plans import history as h
from tidemark.plans.history import AS_OF, CHANGES_SQL, DELTAS_SQL, EVENTS_SQL, LOADED_AT, SNAPSHOTS_SQL, key_sql, loaded_at, table
from tidemark.registry import Entity
from tidemark.sources import extractions, sinks
from tidemark.streaming.ingest import EventFiles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


SNAP = "src_file, o_orderkey, o_custkey, status, priority, updated, source_code"
CHANGE = "o_orderkey, o_custkey, status, priority, updated, source_code, row_hash, first_seen, src_file, valid_from, loaded_at, op"
KEY = ["o_orderkey"]
#: English names of the order priorities; one is left out on purpose.
PRIORITIES = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Low"}
#: A holiday seed with one date that has two holidays.
HOLIDAYS = [("1995-01-01", "New Year", "Public", True, True), ("1995-05-01", "Labour Day", "Optional", False, True), ("1995-05-01", "May Day", "Public", False, True), ("1996-12-25", "Christmas Day", "Public", True, True)]
HOLIDAYS_SQL = "holidays(holiday_date, holiday_name, holiday_type, is_global_holiday, fixed) AS (VALUES " + ", ".join(f"(DATE '{d}', '{n}', '{t}', {g}, {f})" for d, n, t, g, f in HOLIDAYS) + ")"


# Bronze ---------------------------------------------------------------------------------------------------------------


def land(spark: SparkSession, sf_dir: str, folder: str, first: int = 1, last: int = h.SNAPSHOTS) -> str:
    """Writes order snapshots as NDJSON extractions, in one job, and returns the glob that finds them."""
    rows = h.order_snapshots(spark, sf_dir).filter(F.col("s").between(first, last)).withColumn("_dlt_load_id", F.col("s"))
    sinks.land_snapshots(rows.drop("s", "source_code"), folder, "orders")
    return f"{folder}/orders/orders_*.json*"


def landed(spark: SparkSession, sf_dir: str) -> str:
    return land(spark, sf_dir, h.scratch(spark))


ORDER_SCHEMA = "o_orderkey long, o_custkey long, status string, priority string, updated timestamp_ntz, _dlt_load_id int"


@query(f"WITH {SNAPSHOTS_SQL} SELECT {SNAP} FROM snap")
def bronze_all_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extractions.read_extractions(spark, landed(spark, sf_dir), "TPC", ORDER_SCHEMA)


@query(f"WITH {SNAPSHOTS_SQL} SELECT {SNAP}, 'N' AS deleted FROM snap WHERE src_file = (SELECT max(src_file) FROM snap)")
def bronze_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extractions.read_latest_extraction(spark, landed(spark, sf_dir), "TPC", ORDER_SCHEMA)


@query(f"WITH {SNAPSHOTS_SQL} SELECT src_file, valid_from, previous_file, next_file, previous_from, next_from, n_rows FROM files JOIN (SELECT src_file, count(*) AS n_rows FROM snap GROUP BY 1) USING (src_file)")
def file_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(spark, sf_dir)
    rows = extractions.read_extractions(spark, path, "TPC", ORDER_SCHEMA).groupBy("src_file").agg(F.count("*").alias("n_rows"))
    files = extractions.list_extractions(spark, path).drop("ordinal", "last_ordinal")
    return rows.join(F.broadcast(files), "src_file").select(*files.columns, "n_rows")  # a row an extraction


@query(f"WITH {SNAPSHOTS_SQL} SELECT DISTINCT src_file, o_custkey, status, priority FROM snap")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.order_snapshots(spark, sf_dir).select("src_file", "o_custkey", "status", "priority").dropDuplicates()


@query(f"WITH {SNAPSHOTS_SQL} SELECT src_file, status, source_code FROM snap")
def select_by_name_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.select_where(h.order_snapshots(spark, sf_dir), lambda c: c.startswith("s") and c != "s")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def select_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").drop("o_totalprice", "o_orderdate")


@query(f"WITH {HOLIDAYS_SQL} SELECT holiday_date, holiday_name, holiday_type, is_global_holiday, fixed, count(o_orderkey) AS n_orders FROM holidays LEFT JOIN orders ON CAST(o_orderdate AS DATE) = holiday_date GROUP BY ALL")
def seed_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = h.scratch(spark)
    spark.createDataFrame(HOLIDAYS, "date string, Name string, Type string, Global boolean, Fixed boolean").write.option("header", True).csv(folder)
    names = {"date": "holiday_date", "Name": "holiday_name", "Type": "holiday_type", "Global": "is_global_holiday", "Fixed": "fixed"}
    seed = extractions.read_seed(spark, folder, "date date, Name string, Type string, Global boolean, Fixed boolean", names)
    orders = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("holiday_date")).agg(F.count("*").alias("n_orders"))
    return seed.join(orders, "holiday_date", "left").select(*names.values(), F.coalesce("n_orders", F.lit(0)).cast("long").alias("n_orders"))


@query("SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extractions.updated_since(table(spark, sf_dir, "events"), "ts", "2024-01-10").select("event_id", "user_id", "event_type")


@query("SELECT event_id, user_id, event_type, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def jdbc_incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a database: written to it, then read back from a date on, in ranges of their id side by side. The database is
    embedded in Spark's own process, so this query is for local mode; the reader isn't."""
    url = h.embedded_database(spark)
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    types = "event_id BIGINT, user_id BIGINT, event_type VARCHAR(64), ts TIMESTAMP"
    events.write.format("jdbc").options(url=url, dbtable="events", createTableColumnTypes=types).mode("overwrite").save()
    return extractions.read_jdbc_incremental(spark, url, "events", "ts", "2024-01-10", "event_id", preferTimestampNTZ="true").toDF("event_id", "user_id", "event_type", "ts")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= DATE '1998-07-01' - INTERVAL 365 DAY")
def lookback_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extractions.lookback_filter(table(spark, sf_dir, "orders"), "o_orderdate", dt.date(1998, 7, 1), 365).select("o_orderkey", "o_custkey")


@query("SELECT event_id, event_type FROM events WHERE ts >= (SELECT date_trunc('day', max(ts)) FROM events WHERE ts < (SELECT min(ts) + INTERVAL 10 DAY FROM events))")
def watermark_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run leaves its cursor behind in a state log; the next one starts at the cursor's day."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    first = events.agg(F.min("ts").alias("first"))
    cursor = Cursor(h.scratch(spark), "ts")
    cursor.advance(cursor.rows(events).join(first, F.col("ts") < F.col("first") + F.expr("INTERVAL 10 DAY")))  # a one-row aggregate
    return cursor.rows(events).select("event_id", "event_type")


@query("SELECT event_id, user_id, event_type, props FROM events")
def api_page_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct("event_id", "user_id", "event_type", "props")
    pages = table(spark, sf_dir, "events").groupBy(F.expr("event_id div 50").alias("page")).agg(F.to_json(F.struct(F.collect_list(record).alias("value"))).alias("body"))
    return extractions.flatten_api_pages(pages, "body", "struct<event_id:bigint,user_id:bigint,event_type:string,props:string>")


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('5-LOW') AND o_custkey IS NOT NULL AND o_orderpriority >= '2' AND o_orderkey <> 7")
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    kept = o.filter(F.col("o_orderstatus").isin("F", "O") & ~F.col("o_orderpriority").isin("5-LOW") & F.col("o_custkey").isNotNull() & (F.col("o_orderpriority") >= "2") & (F.col("o_orderkey") != 7))
    return kept.unionByName(o.limit(0)).drop("o_custkey")


# Silver ---------------------------------------------------------------------------------------------------------------


@query(f"WITH {CHANGES_SQL} SELECT src_file, o_orderkey, row_hash FROM hashed")
def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = h.order_snapshots(spark, sf_dir).drop("s")
    return rows.select("src_file", "o_orderkey", row_hash(rows, KEY, ("src_file", "updated", "source_code")).alias("row_hash"))


QUERIES["row_hash"], ORACLES["row_hash"] = QUERIES.pop("row_hashes"), ORACLES.pop("row_hashes")


@query(f"WITH {CHANGES_SQL} SELECT src_file, o_orderkey, first_seen FROM hashed")
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.order_snapshots(spark, sf_dir).select("src_file", "o_orderkey", cdc.first_seen(KEY, "updated").alias("first_seen"))


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM changes")
def cdc_full_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.order_changes(spark, sf_dir)


@query(f"WITH {DELTAS_SQL} SELECT {CHANGE} FROM delta_changes")
def cdc_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = h.order_deltas(spark, sf_dir).drop("s")
    return cdc.cdc_delta(rows, h.files_of(spark), KEY, loaded_at(), "updated", ("updated", "source_code"))


@query(
    f"""WITH {CHANGES_SQL}, {DELTAS_SQL[len(SNAPSHOTS_SQL) + 1 :]},
    old AS (SELECT * FROM changes WHERE valid_from <= TIMESTAMP '2024-03-01 12:00:00' QUALIFY row_number() OVER (PARTITION BY source_code, o_orderkey ORDER BY valid_from DESC) = 1)
    SELECT {CHANGE} FROM delta_changes
    UNION ALL SELECT {CHANGE} FROM old WHERE op = 'D'
    UNION ALL SELECT o_orderkey, o_custkey, status, priority, updated, source_code, row_hash, first_seen, 'orders_20240401_120000.json', TIMESTAMP '2024-04-01 12:00:00', TIMESTAMP '{LOADED_AT}', 'D'
    FROM old WHERE op <> 'D' AND o_orderkey NOT IN (SELECT o_orderkey FROM snap WHERE s = 4)"""
)
def cdc_delta_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = h.order_deltas(spark, sf_dir).drop("s")
    stored = h.order_changes(spark, sf_dir).filter("valid_from <= timestamp_ntz '2024-03-01 12:00:00'")
    newest = h.order_snapshots(spark, sf_dir).filter(F.col("s") == h.SNAPSHOTS)
    return cdc.cdc_delta_full_refresh(rows, h.files_of(spark), stored, newest, KEY, loaded_at(), "updated", ("updated", "source_code"))


@query(f"WITH {SNAPSHOTS_SQL} SELECT src_file, valid_from, previous_file, previous_from, TIMESTAMP '{LOADED_AT}' AS loaded_at FROM files WHERE next_file IS NULL")
def bookmark_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.bookmark(h.files_of(spark), loaded_at())


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM changes WHERE src_file >= (SELECT previous_file FROM files WHERE next_file IS NULL)")
def bookmark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = bookmark_update(spark, sf_dir).first()
    return cdc.since_bookmark(h.order_changes(spark, sf_dir), mark.previous_file if mark else None)


#: What an earlier run has stored: all changes of the first three extractions.
STORED = "valid_from <= timestamp_ntz '2024-03-01 12:00:00'"


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM changes WHERE src_file >= 'orders_20240301_120000.json' AND valid_from > TIMESTAMP '2024-03-01 12:00:00'")
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = h.order_changes(spark, sf_dir)
    return cdc.idempotent_append(changes, changes.filter(STORED), KEY, "orders_20240301_120000.json")


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM current_rows")
def current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.current_version(h.order_changes(spark, sf_dir), KEY)


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM current_rows WHERE op <> 'D'")
def active_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.active_version(h.order_changes(spark, sf_dir), KEY)


@query(
    f"""WITH {CHANGES_SQL}, old AS (SELECT * FROM hashed WHERE s = 1), new AS (SELECT * FROM hashed WHERE s = 4)
    SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN o.status ELSE n.status END AS status, CASE WHEN n.o_orderkey IS NULL THEN o.row_hash ELSE n.row_hash END AS row_hash,
           CASE WHEN n.o_orderkey IS NULL THEN 'Delete' WHEN o.o_orderkey IS NULL THEN 'Insert' ELSE 'Change' END AS op
    FROM new n FULL OUTER JOIN old o ON n.o_orderkey = o.o_orderkey WHERE n.row_hash IS DISTINCT FROM o.row_hash"""
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = h.order_snapshots(spark, sf_dir)
    hashed = rows.withColumn("row_hash", row_hash(rows.drop("s"), KEY, ("src_file", "updated", "source_code")))
    return cdc.snapshot_diff(hashed.filter("s = 4"), hashed.filter("s = 1"), "o_orderkey", ["status"])


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM changes c WHERE valid_from = (SELECT max(valid_from) FROM changes d WHERE d.o_orderkey = c.o_orderkey)")
def latest_by_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = h.order_changes(spark, sf_dir)
    return relational.latest_by_group_join(changes, KEY, "valid_from").select(changes.columns)


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE}, CASE WHEN src_file > 'orders_20240201' THEN o_custkey % 7 END AS tier FROM changes")
def schema_evolution_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = h.order_changes(spark, sf_dir)
    old, new = changes.filter("src_file <= 'orders_20240201'"), changes.filter("src_file > 'orders_20240201'").withColumn("tier", F.col("o_custkey") % 7)
    return sinks.append_evolving(old, new)


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE}, CASE WHEN src_file > 'orders_20240201' THEN o_custkey % 7 END AS tier FROM changes")
def schema_evolution_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table takes rows with a new column; both generations are read back."""
    path, changes = h.scratch(spark), h.order_changes(spark, sf_dir)
    sinks.append_new_versions(changes.filter("src_file <= 'orders_20240201'"), path, KEY)
    sinks.append_new_versions(changes.withColumn("tier", F.when(F.col("src_file") > "orders_20240201", F.col("o_custkey") % 7)), path, KEY)
    return sinks.read_table(spark, path)


ORDERS = Entity("orders", "TPC", "o_orderkey", False, "updated", ORDER_SCHEMA, ("updated", "source_code"))


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM changes")
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily runs over landed extractions: after the first two, after the third, after the fourth, and a replay. Each reads the newest
    extraction of the last one, the new ones and a row a key, whatever the history's length."""
    folder = h.scratch(spark)
    table = ChangeTable(ORDERS, f"{folder}/silver")
    for first, last in ((1, 2), (3, 3), (4, 4)):
        table.run(spark, land(spark, sf_dir, folder, first, last), loaded_at())
    table.run(spark, f"{folder}/orders/orders_*.json*", loaded_at())
    return table.changes(spark).select(*[c.strip() for c in CHANGE.split(",")])


@query(f"WITH {DELTAS_SQL} SELECT {CHANGE} FROM delta_changes")
def incremental_delta_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for extractions of changed rows only, run one by one, then rebuilt from scratch."""
    folder = h.scratch(spark)
    table = ChangeTable(replace(ORDERS, delta=True), f"{folder}/silver")
    glob = f"{folder}/orders/orders_*.json*"
    rows = h.order_deltas(spark, sf_dir).withColumn("_dlt_load_id", F.col("s"))
    for s in range(1, h.SNAPSHOTS + 1):
        sinks.land_snapshots(rows.filter(F.col("s") == s).drop("s", "source_code"), folder, "orders")
        table.run(spark, glob, loaded_at())
    table.refresh(spark, glob, loaded_at())
    return table.changes(spark).select(*[c.strip() for c in CHANGE.split(",")])


CUSTOMERS = Entity("customers", "TPC", "c_custkey", True, None, "c_custkey long, c_name string, c_mktsegment string", ("source_code",))


@query(
    f"""WITH {CHANGES_SQL}
    SELECT 'orders' AS table_name, src_file, op, count(*) AS n_rows FROM changes GROUP BY src_file, op
    UNION ALL SELECT 'customers', 'customers_20240101_120000.json', 'I', count(*) FROM customer
    UNION ALL SELECT 'customers', 'customers_20240201_120000.json', 'U', count(*) FROM customer WHERE c_custkey % 6 = 0 HAVING count(*) > 0"""
)
def daily_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days of two entities, one of whole and one of changed extractions: changes and exports side by side, with run logs and
    checks; what the exported tables hold in the end."""
    folder = h.scratch(spark)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    moved = customers.filter("c_custkey % 3 = 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 6 == 0, "MOVED").otherwise(F.col("c_mktsegment")))
    globs = {ORDERS: f"{folder}/orders/orders_*.json*", CUSTOMERS: f"{folder}/customers/customers_*.json*"}
    for day, ((first, last), rows) in enumerate((((1, 2), customers), ((3, 3), moved), ((4, 4), None))):
        land(spark, sf_dir, folder, first, last)
        if rows is not None:
            sinks.land_snapshot(rows, folder, "customers", dt.datetime(2024, day + 1, 1, 12))
        _, broken = daily(spark, globs, f"{folder}/silver", f"{folder}/exports", loaded_at())
        if not broken.isEmpty():
            raise ValueError("a change log breaks its rules")
    parts = [sinks.read_table(spark, f"{folder}/exports/{e.name}").select(F.lit(e.name).alias("table_name"), "src_file", "op") for e in globs]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "src_file", "op").agg(F.count("*").alias("n_rows"))


def keyed_orders(spark: SparkSession, sf_dir: str) -> sinks.KeyedTable:
    """The change log stored by key, in two appends of which the second brings a new column."""
    table = sinks.KeyedTable(spark, f"silver_orders_{uuid.uuid4().hex}", KEY, sinks.buckets(spark), h.scratch(spark))
    changes = h.order_changes(spark, sf_dir)
    table.append(changes.filter(STORED))
    table.append(changes.filter(f"not {STORED}").withColumn("tier", F.col("o_custkey") % 7))
    return table


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE}, CASE WHEN valid_from > TIMESTAMP '2024-03-01 12:00:00' THEN o_custkey % 7 END AS tier FROM current_rows")
def keyed_current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current versions of a log that is stored by key: the last step shuffles nothing."""
    return cdc.current_version(keyed_orders(spark, sf_dir).read(), KEY)


@query(f"WITH {CHANGES_SQL} SELECT o_orderkey, valid_from, op, row_number() OVER (ORDER BY o_orderkey, valid_from) AS row_id FROM changes")
def global_row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = h.order_changes(spark, sf_dir).select("o_orderkey", "valid_from", "op")
    return relational.row_ids(changes, ["o_orderkey", "valid_from"], h.scratch(spark))


@query(f"WITH {CHANGES_SQL} SELECT o_orderkey, status, op FROM current_rows")
def layer_as_view_or_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver is published as a view, gold as a table that is made from it."""
    silver = sinks.publish(h.order_changes(spark, sf_dir), "silver_orders")
    gold = sinks.publish(cdc.current_version(silver, KEY).select("o_orderkey", "status", "op"), "gold_orders", h.scratch(spark))
    for name in ("silver_orders", "gold_orders"):  # the plan at hand has no need of the names
        spark.catalog.dropTempView(name)
    return gold


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 <> 0 THEN strftime(ts, '.%f') ELSE '' END AS ts_text, strftime(ts, '%Y-%m-%d') AS day_text FROM events")
def iso_text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.to_date("ts").alias("day"))
    return events.select("event_id", iso_text(events, "ts").alias("ts_text"), iso_text(events, "day").alias("day_text"))


@query(f"WITH {CHANGES_SQL} SELECT {CHANGE} FROM changes")
def export_silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports what a first run has, then everything: only new versions are appended, and a replay appends none."""
    path, changes = h.scratch(spark), h.order_changes(spark, sf_dir)
    sinks.append_new_versions(changes.filter(STORED), path, KEY)
    sinks.append_new_versions(changes, path, KEY)
    return spark.read.parquet(path)


@query(f"WITH {CHANGES_SQL} SELECT o_orderkey, status, op FROM current_rows")
def export_gold_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, gold = h.scratch(spark), current_version(spark, sf_dir)
    sinks.overwrite_table(gold.select("o_orderkey").limit(1), path)
    sinks.overwrite_table(gold.select("o_orderkey", "status", "op"), path)
    return spark.read.parquet(path)


# Gold -----------------------------------------------------------------------------------------------------------------

SCD2_SQL = f"""{CHANGES_SQL},
    versions AS (
        SELECT 'TPC-' || o_orderkey AS order_bk, o_orderkey AS order_id, o_custkey AS customer_id, status, first_seen, source_code, valid_from AS began,
               lead(valid_from) OVER w AS next_from, CAST(row_number() OVER w AS INTEGER) AS version, priority
        FROM changes WINDOW w AS (PARTITION BY source_code, o_orderkey ORDER BY valid_from)
    ),
    dim AS (
        SELECT {key_sql("order_bk || '|' || strftime(began, '%Y-%m-%d %H:%M:%S')")} AS order_key, order_bk, order_id, customer_id, status, first_seen,
               CASE WHEN version = 1 THEN TIMESTAMP '1900-01-01' ELSE began END AS valid_from, version, source_code, coalesce(next_from, TIMESTAMP '9999-12-31') AS valid_to
        FROM versions
    )
"""
DIM = "order_key, order_bk, order_id, customer_id, status, first_seen, valid_from, version, source_code, valid_to"
UNKNOWN_SQL = "SELECT 0, 'Unknown', NULL, NULL, NULL, NULL, TIMESTAMP '1900-01-01', 1, 'SYS', TIMESTAMP '9999-12-31'"


@query(f"WITH {SCD2_SQL} SELECT {DIM} FROM dim")
def scd2_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = {"order_id": F.col("o_orderkey"), "customer_id": F.col("o_custkey"), "status": F.col("status")}
    return dimensions.scd2_dimension(h.order_changes(spark, sf_dir), "o_orderkey", attributes, portable_key, "order")


@query(f"WITH {SCD2_SQL} SELECT {DIM} FROM dim UNION ALL {UNKNOWN_SQL}")
def unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.with_unknown(scd2_dimension(spark, sf_dir), "order")


@query(f"WITH {SCD2_SQL}, every AS (SELECT {DIM} FROM dim UNION ALL {UNKNOWN_SQL}) SELECT order_key, order_bk, order_id, customer_id, status, first_seen, source_code FROM every QUALIFY row_number() OVER (PARTITION BY source_code, order_bk ORDER BY valid_from DESC) = 1")
def gold_current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.current_dimension(unknown_member(spark, sf_dir), "order")


@query(f"WITH {SCD2_SQL} SELECT {DIM}, c_name AS customer_name, c_mktsegment AS segment FROM dim LEFT JOIN customer ON customer_id = c_custkey")
def dimension_with_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "customer")
    columns = {"c_custkey": "_id", "c_name": "customer_name", "c_mktsegment": "segment"}
    return dimensions.with_parent(scd2_dimension(spark, sf_dir), parent, F.col("customer_id") == F.col("_id"), columns).drop("_id")


@query(f"WITH {SCD2_SQL} SELECT {DIM} FROM dim WHERE valid_to = TIMESTAMP '9999-12-31'")
def open_versions_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.open_versions(scd2_dimension(spark, sf_dir))


@query("SELECT o_orderkey, CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITIES.items()) + " ELSE concat(o_orderpriority, ' (not translated yet)') END AS priority_name FROM orders")
def value_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", translated(F.col("o_orderpriority"), PRIORITIES).alias("priority_name"))


@query("SELECT o_orderkey, concat('TPC', '-', o_custkey) AS customer_bk, concat('TPC', '-', nullif(o_orderstatus, 'P')) AS status_bk FROM orders")
def business_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", business_key(F.lit("TPC"), "o_custkey").alias("customer_bk"), business_key(F.lit("TPC"), F.nullif("o_orderstatus", F.lit("P"))).alias("status_bk"))


@query(f"SELECT o_orderkey, {key_sql("'TPC-' || o_orderkey")} AS order_key FROM orders")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", portable_key(business_key(F.lit("TPC"), "o_orderkey")).alias("order_key"))


for _new, _old in (("business_key", "business_keys"), ("surrogate_key", "surrogate_keys")):
    QUERIES[_new], ORACLES[_new] = QUERIES.pop(_old), ORACLES.pop(_old)


@query(
    f"""SELECT {key_sql("'TPC-' || l_orderkey || '-' || l_linenumber")} AS line_key, 'TPC-' || l_orderkey || '-' || l_linenumber AS line_bk, o_orderstatus AS status, c_name AS customer, n_name AS nation, r_name AS region, p_brand AS brand, s_name AS supplier
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey"""
)
def snowflake_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")}
    places = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "left").join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left").select("c_custkey", "c_name", "n_name", "r_name")
    orders = t["orders"].join(places, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_orderstatus", "c_name", "n_name", "r_name")
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    all_ = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(t["part"].select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"), "left").join(t["supplier"].select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    bk = F.concat(F.lit("TPC-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return all_.select(portable_key(bk).alias("line_key"), bk.alias("line_bk"), F.col("o_orderstatus").alias("status"), F.col("c_name").alias("customer"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"), F.col("p_brand").alias("brand"), F.col("s_name").alias("supplier"))


@query(
    f"""WITH {SCD2_SQL}, active AS (SELECT o_orderkey, op FROM current_rows WHERE op <> 'D'), newest AS (SELECT * FROM dim QUALIFY row_number() OVER (PARTITION BY order_bk ORDER BY valid_from DESC) = 1)
    SELECT l.l_orderkey, l.l_linenumber, coalesce(d.order_key, 0) AS order_key, CASE WHEN p.p_partkey IS NULL THEN 0 ELSE {key_sql("'TPC-' || p.p_partkey")} END AS part_key, CASE WHEN s.s_suppkey IS NULL THEN 0 ELSE {key_sql("'TPC-' || s.s_suppkey")} END AS supplier_key,
           CAST(l.l_shipdate AS DATE) AS date_day, 1 AS line_count
    FROM lineitem l JOIN active a ON l.l_orderkey = a.o_orderkey LEFT JOIN newest d ON d.order_bk = 'TPC-' || l.l_orderkey
    LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey"""
)
def fact_resolve_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders that aren't deleted, with the newest keys of their dimensions; orphans get key 0."""
    # every reader of the dimension is served by one materialised change log
    path = h.scratch(spark)
    h.order_changes(spark, sf_dir).write.parquet(path)
    changes = spark.read.parquet(path)
    attributes = {"order_id": F.col("o_orderkey")}
    orders = dimensions.current_dimension(dimensions.scd2_dimension(changes, "o_orderkey", attributes, portable_key, "order"), "order")
    parts = table(spark, sf_dir, "part").select(business_key(F.lit("TPC"), "p_partkey").alias("bk")).withColumn("key", portable_key(F.col("bk")))
    suppliers = table(spark, sf_dir, "supplier").select(business_key(F.lit("TPC"), "s_suppkey").alias("bk")).withColumn("key", portable_key(F.col("bk")))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    live = lines.join(cdc.active_version(changes, KEY).select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    keyed = live.withColumns({f"{n}_bk": business_key(F.lit("TPC"), c) for n, c in (("order", "l_orderkey"), ("part", "l_partkey"), ("supplier", "l_suppkey"))})
    found = facts.resolve_keys(keyed, [(orders, "order_bk", "order_bk", "order_key"), (parts.withColumnRenamed("key", "part_key"), "bk", "part_bk", "part_key"), (suppliers.withColumnRenamed("key", "supplier_key"), "bk", "supplier_bk", "supplier_key")])
    return found.select("l_orderkey", "l_linenumber", "order_key", "part_key", "supplier_key", F.to_date("l_shipdate").alias("date_day"), F.lit(1).alias("line_count"))


def keyed_lines(spark: SparkSession, sf_dir: str) -> sinks.KeyedTable:
    table_ = sinks.KeyedTable(spark, f"silver_lines_{uuid.uuid4().hex}", ["l_orderkey"], sinks.buckets(spark), h.scratch(spark))
    table_.append(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))
    return table_


def fact_lookup(orders: sinks.KeyedTable, lines: sinks.KeyedTable) -> DataFrame:
    versions = dimensions.scd2_dimension(orders.read(), "o_orderkey", {"order_id": F.col("o_orderkey")}, portable_key, "order")
    newest = relational.latest(versions, ["order_id"], ["valid_from"]).select("order_id", "order_key", "version")
    found = lines.read().join(newest, F.col("l_orderkey") == F.col("order_id"), "left")
    return found.select("l_orderkey", "l_linenumber", F.coalesce("order_key", F.lit(0).cast("long")).alias("order_key"), F.coalesce("version", F.lit(0)).alias("n_versions"))


@query(f"WITH {SCD2_SQL} SELECT l_orderkey, l_linenumber, coalesce(order_key, 0) AS order_key, coalesce(version, 0) AS n_versions FROM lineitem LEFT JOIN (SELECT * FROM dim QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY valid_from DESC) = 1) ON order_id = l_orderkey")
def keyed_fact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the newest key of their order: the type-2 windows, the newest version and the lookup keep the one partitioning of
    the stored tables and shuffle nothing."""
    return fact_lookup(keyed_orders(spark, sf_dir), keyed_lines(spark, sf_dir))


def _calendar_sql() -> str:
    """The calendar's columns in SQL, in its own terms."""
    cols = ["CAST(year(d) AS INTEGER) AS date_year", "CAST(isoyear(d) AS INTEGER) AS iso_year", "CAST(quarter(d) AS INTEGER) AS date_quarter", "CAST(month(d) AS INTEGER) AS date_month", "CAST(weekofyear(d) AS INTEGER) AS date_week", "CAST(weekofyear(d) AS INTEGER) AS iso_week_of_year", "CAST(isoyear(d) * 100 + weekofyear(d) AS INTEGER) AS iso_week_year_number"]
    index = {"year": "year({x})", "quarter": "(year({x}) * 4 + quarter({x}))", "month": "(year({x}) * 12 + month({x}))", "week": "((date_trunc('week', {x})::DATE - DATE '1900-01-01') // 7)"}
    for u in ("year", "quarter", "month", "week"):
        begin, off = f"date_trunc('{u}', d)", f"{index[u].format(x='d')} - {index[u].format(x=f'DATE {chr(39)}{AS_OF}{chr(39)}')}"
        number = "isodow(d)" if u == "week" else f"(d - {begin}::DATE) + 1"
        cols += [f"{begin}::DATE AS {u}_start_date", f"({begin} + INTERVAL 1 {u} - INTERVAL 1 DAY)::DATE AS {u}_end_date", f"CAST({number} AS INTEGER) AS {u}_day_number", f"CAST({off} AS INTEGER) AS {u}_offset", f"CAST(({off}) < 0 AS INTEGER) AS {u}_completed"]
    cols += ["monthname(d) AS month_name", "left(monthname(d), 3) AS month_name_short", "left(monthname(d), 1) AS month_initial", "monthname(d) || ' ' || year(d) AS month_and_year", "CAST(year(d) * 100 + month(d) AS INTEGER) AS month_and_year_number"]
    cols += ["CAST(weekofyear((date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::DATE) = 53 AS INTEGER) AS has_53_iso_weeks", f"CAST(d > DATE '{AS_OF}' AS INTEGER) AS is_after_today", f"CAST(d < DATE '{AS_OF}' AS INTEGER) AS is_before_today", "CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend", "CAST(isodow(d) < 6 AS INTEGER) AS is_weekday"]
    return ", ".join(cols)


@query(
    f"""WITH {HOLIDAYS_SQL}, one AS (SELECT * FROM holidays QUALIFY row_number() OVER (PARTITION BY holiday_date ORDER BY holiday_type DESC, holiday_name DESC) = 1),
    days AS (SELECT unnest(generate_series((SELECT min(o_orderdate)::DATE FROM orders), (SELECT max(o_orderdate)::DATE FROM orders), INTERVAL 1 DAY))::DATE AS d),
    n AS (SELECT o_orderdate::DATE AS day, count(*) AS n_orders FROM orders GROUP BY 1)
    SELECT d AS date_day, coalesce(n_orders, 0) AS n_orders, {_calendar_sql()}, coalesce(holiday_name, 'Not a holiday') AS holiday_name, holiday_date IS NOT NULL AS is_holiday, coalesce(is_global_holiday, false) AS is_global_holiday,
           coalesce(holiday_type, 'Not a holiday') AS holiday_type, coalesce(fixed, false) AS fixed
    FROM days LEFT JOIN n ON day = d LEFT JOIN one ON holiday_date = d"""
)
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the days of orders, with the number of orders of each day."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date_day"))
    ends = orders.agg(F.min("date_day").alias("first"), F.max("date_day").alias("last"))
    days = ends.select(F.explode(F.sequence("first", "last")).alias("date_day"))
    busy = days.join(orders.groupBy("date_day").agg(F.count("*").alias("n_orders")), "date_day", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)).cast("long"))
    holidays = spark.createDataFrame(HOLIDAYS, "holiday_date string, holiday_name string, holiday_type string, is_global_holiday boolean, fixed boolean").withColumn("holiday_date", F.to_date("holiday_date"))
    return dimensions.with_holidays(dimensions.calendar(busy, AS_OF), holidays)


@query(
    """WITH clock AS (SELECT unnest(generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2000-01-01 23:59:00', INTERVAL 1 MINUTE)) AS t), seen AS (SELECT strftime(ts, '%H:%M') AS hhmm, count(*) AS n FROM events GROUP BY 1)
    SELECT coalesce(n, 0) AS n_events, CAST(strftime(t, '%H%M') AS INTEGER) AS time_key, strftime(t, '%H:%M') AS time_hhmm, strftime(t, '%H:%M') AS time_hhmi, strftime(t, '%H:%M:%S') AS time_hhmmss, CAST(strftime(t, '%H') AS INTEGER) AS hour,
           CAST(strftime(t, '%M') AS INTEGER) AS minute, ['Night', 'Morning', 'Afternoon', 'Evening'][hour(t) // 6 + 1] AS period_of_day FROM clock LEFT JOIN seen ON hhmm = strftime(t, '%H:%M')"""
)
def time_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 1,440 minutes of a day with the number of events in each."""
    events = table(spark, sf_dir, "events").groupBy((F.hour("ts") * 60 + F.minute("ts")).alias("minute_of_day")).agg(F.count("*").alias("n_events"))
    minutes = spark.range(1440).select(F.col("id").cast("int").alias("minute_of_day")).join(events, "minute_of_day", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)).cast("long"))
    return dimensions.time_of_day(minutes, "minute_of_day").drop("minute_of_day").orderBy("time_key")


@query(
    r"""SELECT page_id, nullif(regexp_extract(html, '<title>(.*?)</title>', 1, 's'), '') AS title, CAST(NULL AS VARCHAR) AS missing, CAST(try_strptime(lpad(CAST(page_id % 40 AS VARCHAR), 2, '0') || '-02-2020', '%d-%m-%Y') AS DATE) AS day FROM pages"""
)
def markup_field_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lpad((F.col("page_id") % 40).cast("string"), 2, "0"), F.lit("-02-2020"))
    return table(spark, sf_dir, "pages").select("page_id", F.nullif(markup_field(F.col("html"), "title"), F.lit("")).alias("title"), markup_field(F.col("html"), "nosuchtag").alias("missing"), lenient_date(text).alias("day"))


#: English names of the regions; one is left out on purpose.
REGIONS = {"AFRICA": "Africa", "AMERICA": "America", "ASIA": "Asia", "EUROPE": "Europe"}


@query(
    rf"""WITH {h.PERSONS_SQL}, stated AS (
        SELECT *, nullif(regexp_extract(biography, '<sex>(.*?)</sex>', 1, 's'), '') AS gender, nullif(regexp_extract(biography, '<party>(.*?)</party>', 1, 's'), '') AS party_name, nullif(regexp_extract(biography, '<partyShortname>(.*?)</partyShortname>', 1, 's'), '') AS party_short_name,
               CAST(try_strptime(regexp_extract(biography, '<born>(.*?)</born>', 1, 's'), '%d-%m-%Y') AS DATE) AS birth_date, CAST(try_strptime(regexp_extract(biography, '<died>(.*?)</died>', 1, 's'), '%d-%m-%Y') AS DATE) AS death_date
        FROM persons
    )
    SELECT {key_sql("'TPC-' || id || '|' || strftime(began, '%Y-%m-%d %H:%M:%S')")} AS person_key, 'TPC-' || id AS person_bk, group_short_name, full_name, biography, gender, CASE gender WHEN 'Mand' THEN 'Male' WHEN 'Kvinde' THEN 'Female' ELSE gender END AS gender_english,
           birth_date, death_date, party_name, party_short_name, first_seen, CASE WHEN version = 1 THEN TIMESTAMP '1900-01-01' ELSE began END AS valid_from, version, 'TPC' AS source_code, coalesce(next_from, TIMESTAMP '9999-12-31') AS valid_to,
           CASE WHEN r_name IS NOT NULL THEN {key_sql("'TPC-' || type_id")} END AS type_key, r_name AS type_name, CASE r_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGIONS.items())} ELSE r_name || ' (not translated yet)' END AS type_english
    FROM stated LEFT JOIN region ON r_regionkey = type_id
    UNION ALL SELECT 0, 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, TIMESTAMP '1900-01-01', 1, 'SYS', TIMESTAMP '9999-12-31', 0, 'Ukendt', 'Unknown'"""
)
def person_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = table(spark, sf_dir, "region").select(business_key(F.lit("TPC"), "r_regionkey").alias("bk"), F.col("r_name").alias("type_name"), translated(F.col("r_name"), REGIONS).alias("type_english")).withColumn("type_key", portable_key(F.col("bk")))
    parent = dimensions.Parent(types, "bk", "type_id", {c: c for c in ("type_key", "type_name", "type_english")}, {"type_key": 0, "type_name": "Ukendt", "type_english": "Unknown"})
    attributes = {c: F.col(c) for c in ("group_short_name", "full_name")}
    return dimensions.person_dimension(h.person_changes(spark, sf_dir), parent, portable_key, attributes=attributes)


@query(
    f"""WITH {SCD2_SQL}
    SELECT {DIM}, CASE WHEN c_name IS NOT NULL THEN {key_sql("'TPC-' || customer_id")} END AS customer_key, c_name AS customer_name, {key_sql("'TPC-' || status")} AS status_key, CASE status WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE status || ' (not translated yet)' END AS status_english
    FROM dim LEFT JOIN customer ON customer_id = c_custkey WHERE valid_to = TIMESTAMP '9999-12-31'
    UNION ALL {UNKNOWN_SQL}, 0, NULL, 0, 'Unknown'"""
)
def open_versions_with_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions that haven't ended with the current versions of two parents, and the Unknown row."""
    customers = table(spark, sf_dir, "customer").select(business_key(F.lit("TPC"), "c_custkey").alias("bk"), F.col("c_name").alias("customer_name")).withColumn("customer_key", portable_key(F.col("bk")))
    changes = h.order_changes(spark, sf_dir)
    states = changes.select("status").distinct().select(business_key(F.lit("TPC"), "status").alias("bk"), translated(F.col("status"), {"F": "Filled", "O": "Open"}).alias("status_english")).withColumn("status_key", portable_key(F.col("bk")))
    parents = [
        dimensions.Parent(customers, "bk", "o_custkey", {"customer_key": "customer_key", "customer_name": "customer_name"}, {"customer_key": 0}),
        dimensions.Parent(states, "bk", "status", {"status_key": "status_key", "status_english": "status_english"}, {"status_key": 0, "status_english": "Unknown"}),
    ]
    attributes = {"order_id": F.col("o_orderkey"), "customer_id": F.col("o_custkey"), "status": F.col("status")}
    return dimensions.child_dimension(changes, "o_orderkey", attributes, parents, portable_key, "order", open_only=True)


# Observability --------------------------------------------------------------------------------------------------------

HHMM = "CAST(hour({0}) * 100 + minute({0}) AS INTEGER)"
FLAT = "run_id, event_ts, step_key, pipeline_name, asset_group, asset_layer, asset_name, asset_full"


@query(f"WITH {EVENTS_SQL} SELECT run_id, job_name, run_status, created_at, started_at, ended_at, duration_seconds FROM pipeline_runs")
def obs_pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observability.pipeline_runs(h.run_table(h.event_log(spark, sf_dir)))


@query(
    f"""WITH {EVENTS_SQL} SELECT {FLAT}, CAST(NULL AS BIGINT) AS records_written, CAST(NULL AS VARCHAR) AS destination_file, CAST(NULL AS VARCHAR) AS destination_path, CAST(NULL AS DOUBLE) AS ingestion_duration_seconds, CAST(NULL AS VARCHAR) AS ingestion_status,
    rows_written, export_table, CAST(NULL AS DOUBLE) AS export_duration_seconds, CAST(NULL AS DOUBLE) AS execution_duration_seconds, CAST(NULL AS VARCHAR) AS unique_id, CAST(NULL AS VARCHAR) AS invocation_id FROM flat"""
)
def obs_event_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observability.event_flatten(h.event_log(spark, sf_dir))


@query(f"WITH {EVENTS_SQL} SELECT DISTINCT {key_sql('job_name')} AS job_key, job_name FROM runs")
def obs_job_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observability.job_dim(obs_pipeline_runs(spark, sf_dir), portable_key)


@query(f"WITH {EVENTS_SQL} SELECT DISTINCT {key_sql('asset_key')} AS asset_sk, asset_key, 'grp' AS asset_group, 'layer' || (k % 3) AS asset_layer, 'asset' || (k % 7) AS asset_name, 'grp/layer' || (k % 3) || '/asset' || (k % 7) AS asset_full FROM log WHERE kind = 'MATERIALIZATION'")
def obs_asset_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observability.asset_dim(h.event_log(spark, sf_dir), portable_key)


RUN_SQL = f"""{EVENTS_SQL}, stats AS (SELECT run_id, CAST(sum(rows_written) AS BIGINT) AS rows_processed, count(*) AS assets_materialized FROM flat GROUP BY 1),
    run_fact AS (
        SELECT {key_sql("r.run_id")} AS run_sk, {key_sql("job_name")} AS job_sk, started_at::DATE AS start_date_sk, {HHMM.format("started_at")} AS start_time_sk, ended_at::DATE AS end_date_sk, {HHMM.format("ended_at")} AS end_time_sk,
               r.run_id, run_status AS status, created_at, started_at, ended_at, duration_seconds, coalesce(rows_processed, 0) AS rows_processed, coalesce(assets_materialized, 0) AS assets_materialized
        FROM pipeline_runs r LEFT JOIN stats s ON r.run_id = s.run_id
    )"""


@query(f"WITH {RUN_SQL} SELECT * FROM run_fact")
def obs_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = h.event_log(spark, sf_dir)
    return observability.run_fact(observability.pipeline_runs(h.run_table(events)), observability.event_flatten(events), portable_key)


MATERIALIZATION_SQL = f"""{EVENTS_SQL},
    plan AS (SELECT run_id, step_key, asset_key, ts AS planned_at FROM log WHERE kind = 'PLANNED'),
    bad AS (SELECT run_id, last('run failed with ' || k ORDER BY ts, id) AS run_error_message FROM log WHERE kind = 'RUN_FAILURE' GROUP BY 1),
    answered AS (
        SELECT e.id, coalesce(max(CASE WHEN p.planned_at <= e.ts THEN p.planned_at END), min(p.planned_at)) AS planned_at
        FROM log e JOIN plan p ON e.run_id = p.run_id AND e.step_key = p.step_key AND e.asset_key = p.asset_key WHERE e.kind = 'MATERIALIZATION' GROUP BY e.id
    ),
    fact AS (
        SELECT {key_sql("e.asset_key")} AS asset_sk, {key_sql("e.run_id")} AS run_sk, {key_sql("e.job_name")} AS job_sk, planned_at::DATE AS start_date_sk, {HHMM.format("planned_at")} AS start_time_sk, e.ts::DATE AS end_date_sk, {HHMM.format("e.ts")} AS end_time_sk,
               e.id AS materialization_id, e.run_id, e.asset_key, e.step_key, CAST(NULL AS VARCHAR) AS partition_key, planned_at AS step_planned_at, e.ts AS materialized_at, round(CAST(epoch_us(e.ts) - epoch_us(planned_at) AS DOUBLE) / 1e6, 1) AS duration_seconds,
               CAST(e.k AS BIGINT) AS rows_processed, r.run_status, b.run_error_message
        FROM log e LEFT JOIN answered p ON e.id = p.id LEFT JOIN runs r ON e.run_id = r.run_id LEFT JOIN bad b ON e.run_id = b.run_id
        WHERE e.kind = 'MATERIALIZATION'
    )"""


@query(f"WITH {MATERIALIZATION_SQL} SELECT * FROM fact")
def obs_materialization(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = h.event_log(spark, sf_dir)
    return observability.materialization_fact(events, observability.pipeline_runs(h.run_table(events)), portable_key)


@query(
    f"""WITH {EVENTS_SQL}, planned AS (SELECT DISTINCT run_id, step_key, asset_key FROM log WHERE kind = 'PLANNED')
    SELECT {key_sql("f.run_id || f.step_key")} AS failure_sk, {key_sql("p.asset_key")} AS asset_sk, {key_sql("f.run_id")} AS run_sk, {key_sql("f.job_name")} AS job_sk, f.ts::DATE AS date_sk, {HHMM.format("f.ts")} AS time_sk, f.run_id, f.step_key, p.asset_key, 'Error' || (f.k % 4) AS error_class, 'code ' || f.k AS error_message, f.ts AS failed_at
    FROM log f LEFT JOIN planned p ON f.run_id = p.run_id AND f.step_key = p.step_key WHERE f.kind = 'STEP_FAILURE'"""
)
def obs_step_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = h.event_log(spark, sf_dir)
    return observability.step_failures(events, observability.pipeline_runs(h.run_table(events)), portable_key)


@query(
    f"""WITH {MATERIALIZATION_SQL}, per_asset AS (SELECT asset_key, max(duration_seconds) AS slowest_seconds, CAST(sum(rows_processed) AS BIGINT) AS n_rows, count(*) AS n_materialized FROM fact GROUP BY 1),
    failures AS (SELECT p.asset_key, count(*) AS n_failures FROM log f JOIN (SELECT DISTINCT run_id, step_key, asset_key FROM log WHERE kind = 'PLANNED') p ON f.run_id = p.run_id AND f.step_key = p.step_key WHERE f.kind = 'STEP_FAILURE' GROUP BY 1)
    SELECT coalesce(a.asset_key, f.asset_key) AS asset_key, slowest_seconds, coalesce(n_rows, 0) AS n_rows, coalesce(n_materialized, 0) AS n_materialized, coalesce(n_failures, 0) AS n_failures FROM per_asset a FULL OUTER JOIN failures f ON a.asset_key = f.asset_key"""
)
def obs_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By asset: the slowest materialisation, rows, materialisations and failures."""
    done = obs_materialization(spark, sf_dir).groupBy("asset_key").agg(F.max("duration_seconds").alias("slowest_seconds"), F.sum("rows_processed").alias("n_rows"), F.count("*").alias("n_materialized"))
    failed = obs_step_failures(spark, sf_dir).filter("asset_key is not null").groupBy("asset_key").agg(F.count("*").alias("n_failures"))
    zero = F.lit(0).cast("long")
    return done.join(failed, "asset_key", "full_outer").select("asset_key", "slowest_seconds", *[F.coalesce(c, zero).alias(c) for c in ("n_rows", "n_materialized", "n_failures")])


@query(
    f"""WITH {MATERIALIZATION_SQL}, slow AS (SELECT run_id, asset_key, max(duration_seconds) AS slowest_seconds, count(*) AS n_materialized FROM fact GROUP BY 1, 2)
    SELECT *, CAST(row_number() OVER (PARTITION BY run_id ORDER BY slowest_seconds DESC NULLS LAST, asset_key) AS INTEGER) AS place FROM slow"""
)
def obs_asset_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observability.asset_durations(obs_materialization(spark, sf_dir))


@query(
    f"""WITH {MATERIALIZATION_SQL}, recent AS (SELECT run_id FROM pipeline_runs ORDER BY created_at DESC NULLS LAST, run_id LIMIT 100)
    SELECT json_extract_string(asset_key, '$[1]') AS asset_layer, CAST(coalesce(sum(rows_processed), 0) AS BIGINT) AS n_rows, count(*) AS n_materialized, count(DISTINCT run_id) AS n_runs FROM fact JOIN recent USING (run_id) GROUP BY 1"""
)
def obs_layer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each layer over the last 100 runs."""
    runs = observability.pipeline_runs(h.run_table(h.event_log(spark, sf_dir)))
    return observability.layer_rows(obs_materialization(spark, sf_dir), runs, 100)


@query(
    f"""WITH {EVENTS_SQL}, planned AS (SELECT DISTINCT run_id, asset_key FROM log WHERE kind = 'PLANNED'), made AS (SELECT DISTINCT run_id, asset_key, 1 AS done FROM log WHERE kind = 'MATERIALIZATION'),
    short AS (SELECT run_id, count(*) AS n_planned, count(*) - count(done) AS n_missing FROM planned LEFT JOIN made USING (run_id, asset_key) GROUP BY 1)
    SELECT run_id, run_status, n_planned, n_missing FROM short LEFT JOIN runs USING (run_id) WHERE n_missing > 0"""
)
def obs_unmet_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = h.event_log(spark, sf_dir)
    return observability.unmet_assets(events, observability.pipeline_runs(h.run_table(events)))


@query(
    f"""WITH {EVENTS_SQL}, ended AS (
        SELECT run_id, step_key, min(ts) AS first, max(ts) FILTER (WHERE kind IN ('MATERIALIZATION', 'STEP_FAILURE')) AS last, CASE WHEN bool_or(kind = 'STEP_FAILURE') THEN 'FAILURE' WHEN bool_or(kind = 'MATERIALIZATION') THEN 'SUCCESS' ELSE 'unknown' END AS status
        FROM log WHERE kind <> 'RUN_FAILURE' GROUP BY 1, 2
    )
    SELECT run_id, count(*) OVER w AS steps_total, count(*) FILTER (WHERE status = 'SUCCESS') OVER w AS steps_succeeded, count(*) FILTER (WHERE status = 'FAILURE') OVER w AS steps_failed, CAST(0 AS BIGINT) AS steps_skipped,
           CAST(row_number() OVER (PARTITION BY run_id ORDER BY step_key) AS INTEGER) AS place, step_key, status, round(CAST(epoch_us(last) - epoch_us(first) AS DOUBLE) / 1e6, 3) AS duration_seconds
    FROM ended WINDOW w AS (PARTITION BY run_id)"""
)
def run_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run's summary, a row a step."""
    runs = observability.run_summary(h.event_log(spark, sf_dir))
    steps = runs.select("run_id", "steps_total", "steps_succeeded", "steps_failed", "steps_skipped", F.posexplode("steps").alias("place", "step"))
    return steps.select("run_id", "steps_total", "steps_succeeded", "steps_failed", "steps_skipped", (F.col("place") + 1).alias("place"), "step.*")


@query(
    f"""WITH {EVENTS_SQL}, planned AS (SELECT DISTINCT run_id, step_key, asset_key FROM log WHERE kind = 'PLANNED')
    SELECT {key_sql("f.run_id || f.step_key")} AS failure_sk, {key_sql("p.asset_key")} AS asset_sk, {key_sql("f.run_id")} AS run_sk, {key_sql("f.job_name")} AS job_sk, f.ts::DATE AS date_sk, {HHMM.format("f.ts")} AS time_sk, f.run_id, f.step_key, p.asset_key, 'Error' || (f.k % 4) AS error_class, 'code ' || f.k AS error_message, f.ts AS failed_at
    FROM log f LEFT JOIN planned p ON f.run_id = p.run_id AND f.step_key = p.step_key WHERE f.kind = 'STEP_FAILURE'"""
)
def obs_step_failures_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step failures of events that come from log files, taken in by two runs; a file that is no log, an index and a broken line are
    among them."""
    folder, log = h.scratch(spark), h.event_log(spark, sf_dir)
    inbox = EventFiles(f"{folder}/in", "id long, run_id string, user_id long, asset_key string, step_key string, partition string, ts timestamp_ntz, kind string, event string", f"{folder}/out")
    parts = log.withColumns({"ts": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "_name": F.concat(F.lit("runs_"), (F.col("user_id") % 16).cast("string"), F.lit(".jsonl"))})
    for late in (False, True):
        sinks.land_snapshots(parts.filter((F.col("user_id") % 2 == 1) == late), folder, "in", "_name")
        spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/in/{'late' if late else 'early'}_broken.jsonl")
        spark.createDataFrame([('{"id": 1, "kind": "STEP_FAILURE"}',)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/in/index.jsonl")
        inbox.ingest(spark)
    events = inbox.events(spark)
    return observability.step_failures(events, observability.pipeline_runs(h.run_table(events)), portable_key)


@query("SELECT event_id, '***' AS api_token, '***' AS db_password, event_type AS kind FROM events")
def redact_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = F.create_map(F.lit("API_Token"), F.col("props"), F.lit("db_password"), F.col("value").cast("string"), F.lit("kind"), F.col("event_type"))
    p = table(spark, sf_dir, "events").select("event_id", redacted(params).alias("p"))
    return p.select("event_id", F.col("p")["API_Token"].alias("api_token"), F.col("p")["db_password"].alias("db_password"), F.col("p")["kind"].alias("kind"))


# Data quality ---------------------------------------------------------------------------------------------------------


@query("SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id FROM events WHERE event_id % 11 = 0")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id"))
    return quality.not_null(e, "user_id")


@query("SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(table(spark, sf_dir, "orders"), ["o_custkey"])


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('signup', 'view', 'click') AND user_id > 10")
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values(table(spark, sf_dir, "events"), "event_type", ["signup", "view", "click"], F.col("user_id") > 10).select("event_id", "event_type")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE length(c_mktsegment) <> 9")
def dq_value_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.value_length(table(spark, sf_dir, "customer"), "c_mktsegment", 9).select("c_custkey", "c_mktsegment")


@query("SELECT count(*) AS n_rows, count(*) BETWEEN 1 AND 1000000000 AS passed FROM orders")
def dq_row_count_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count_between(table(spark, sf_dir, "orders"), 1, 1_000_000_000)


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-')")
def dq_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.matches(table(spark, sf_dir, "orders"), "o_orderpriority", "^[1-3]-").select("o_orderkey", "o_orderpriority")


@query(
    f"""WITH {CHANGES_SQL} SELECT 'changes' AS table_name, o_orderkey || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS key, count(*) AS n_rows FROM changes GROUP BY o_orderkey, valid_from HAVING count(*) > 1
    UNION ALL SELECT 'lines', l_orderkey || '|' || l_linenumber, count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 'suppliers', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem GROUP BY l_suppkey HAVING count(*) > 1"""
)
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return quality.unique_combination({"changes": h.order_changes(spark, sf_dir), "lines": lines, "suppliers": lines}, {"changes": ["o_orderkey", "valid_from"], "lines": ["l_orderkey", "l_linenumber"], "suppliers": ["l_suppkey"]})


@query("SELECT max(CAST(ts AS TIMESTAMP)) AS newest, date_sub('second', max(CAST(ts AS TIMESTAMP)), TIMESTAMP '2024-06-15 00:00:00') AS age_seconds, CASE WHEN date_sub('second', max(CAST(ts AS TIMESTAMP)), TIMESTAMP '2024-06-15 00:00:00') > 7 * 86400 THEN 'error' WHEN date_sub('second', max(CAST(ts AS TIMESTAMP)), TIMESTAMP '2024-06-15 00:00:00') > 2 * 86400 THEN 'warn' ELSE 'pass' END AS status FROM events")
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(table(spark, sf_dir, "events"), "ts", dt.datetime.combine(AS_OF, dt.time()))


@query(
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, event_type, props FROM events)
    SELECT 'user_id not null' AS rule, CAST(to_json([CAST(event_id AS VARCHAR)]) AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS value, CAST(1 AS BIGINT) AS n_rows FROM e WHERE user_id IS NULL
    UNION ALL SELECT 'event_type accepted', CAST(to_json([CAST(event_id AS VARCHAR)]) AS VARCHAR), event_type, 1 FROM e WHERE event_type NOT IN ('signup', 'view', 'click') AND user_id > 10
    UNION ALL SELECT 'event_type length', CAST(to_json([CAST(event_id AS VARCHAR)]) AS VARCHAR), event_type, 1 FROM e WHERE length(event_type) <> 5
    UNION ALL SELECT 'props matches', CAST(to_json([CAST(event_id AS VARCHAR)]) AS VARCHAR), props, 1 FROM e WHERE NOT regexp_matches(props, ': *[0-8][0-9]*}$')
    UNION ALL SELECT 'event_id unique', NULL, CAST(to_json([CAST(event_id AS VARCHAR)]) AS VARCHAR), count(*) FROM e GROUP BY event_id HAVING count(*) > 1
    UNION ALL SELECT 'user_id, event_type unique', NULL, CAST(to_json([CAST(user_id AS VARCHAR), event_type]) AS VARCHAR), count(*) FROM e GROUP BY user_id, event_type HAVING count(*) > 1
    UNION ALL SELECT 'rows between', NULL, NULL, count(*) FROM e HAVING count(*) NOT BETWEEN 1 AND 100
    UNION ALL SELECT 'event_id type', NULL, 'bigint', NULL"""
)
def dq_rules_in_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight rules on a table in one scan, with what breaks each."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id"), "event_type", "props")
    rules = [
        quality.must_not_be_null("user_id"), quality.must_be_among("event_type", ["signup", "view", "click"], F.col("user_id") > 10), quality.must_have_length("event_type", 5), quality.must_match("props", ": *[0-8][0-9]*}$"),
        quality.must_be_unique("event_id"), quality.must_be_unique("user_id", "event_type"), quality.must_have_rows(1, 100), quality.must_have_type(e, "event_id", "int"),
    ]
    return quality.violations(e, ["event_id"], rules)


@query(
    """SELECT 'region' AS table_name, r_regionkey AS key, r_name AS name FROM region UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation UNION ALL SELECT 'customer', c_custkey, c_name FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part"""
)
def exports_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tables exported four at a time, and read back."""
    folder = h.scratch(spark)
    columns = {"region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name"), "customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name"), "part": ("p_partkey", "p_name")}
    tables = {t: table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), F.col(k).cast("long").alias("key"), F.col(n).alias("name")) for t, (k, n) in columns.items()}
    sinks.export_all(spark, {t: (lambda t=t: sinks.overwrite_table(tables[t], f"{folder}/{t}")) for t in tables})
    return reduce(DataFrame.unionByName, [sinks.read_table(spark, f"{folder}/{t}") for t in tables])


@query("SELECT c_custkey, lower(replace(replace(translate(c_name, 'o', 'ø') || ' ÆØÅ æ', 'ø', 'oe'), 'æ', 'ae')) AS file_name FROM customer")
def entity_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.translate("c_name", "o", "ø"), F.lit(" ÆØÅ æ"))
    return table(spark, sf_dir, "customer").select("c_custkey", entity_file_name(name).alias("file_name"))
