"""Derived inputs: order histories, change logs and pipeline event logs that both Spark and SQL compute from the tables.

The *_SQL texts are common table expressions of the same inputs, for the SQL that results are held against.
"""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cdc import cdc_full_snapshot
from tidemark.sources.extractions import timeline

AS_OF = dt.date(2024, 6, 15)
LOADED_AT = "2024-06-15 06:00:00"
SNAPSHOTS = 4


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, below a temporary one if all of Spark runs in this process
    (as in tests). On a cluster no folder of one machine will do, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-tables-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def embedded_database(spark: SparkSession) -> str:
    """JDBC address of a new database that lives in Spark's own process, in a scratch folder if that is a local one."""
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("an embedded database is seen by one process only: use local mode")
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.field", "java.lang.System.err")
    folder = re.sub("^file:/*", "/", scratch(spark))
    return f"jdbc:derby:directory:{folder}/database;create=true" if folder.startswith("/") else f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four complete extractions of orders: some keys are missing from each, some statuses change."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    s = F.col("s")
    return (
        orders.withColumn("s", F.explode(F.sequence(F.lit(1), F.lit(SNAPSHOTS))))
        .filter((F.col("o_orderkey") * 7 + s * 13) % 10 != 0)
        .select(
            F.concat(F.lit("orders_2024"), F.lpad(s.cast("string"), 2, "0"), F.lit("01_120000.json")).alias("src_file"), "s", "o_orderkey", "o_custkey",
            F.when((F.col("o_orderkey") + s) % 4 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("timestamp_ntz").alias("updated"), F.lit("TPC").alias("source_code"),
        )
    )


def snapshot_name(s: int) -> str:
    return f"orders_2024{s:02d}01_120000.json"


def files_of(spark: SparkSession, newest: int = SNAPSHOTS) -> DataFrame:
    """The timeline of the order snapshots: a list of names, as a folder listing gives it, without a look at the rows."""
    return timeline(spark.createDataFrame([(snapshot_name(s),) for s in range(1, newest + 1)], "src_file string"))


def order_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as change-only extractions: the first is complete, the others hold a third of the keys."""
    return order_snapshots(spark, sf_dir).filter((F.col("s") == 1) | ((F.col("o_orderkey") + F.col("s")) % 3 == 0))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_snapshots(spark, sf_dir).drop("s")
    return cdc_full_snapshot(rows, files_of(spark), ["o_orderkey"], loaded_at(), "updated", ("updated", "source_code"))


_HASH = "sha256(coalesce(CAST(o_custkey AS VARCHAR), '<NULL>') || ']##[' || coalesce(status, '<NULL>') || ']##[' || coalesce(priority, '<NULL>') || ']##[')"

SNAPSHOTS_SQL = f"""
    snap AS (
        SELECT 'orders_2024' || lpad(CAST(s AS VARCHAR), 2, '0') || '01_120000.json' AS src_file, CAST(s AS INTEGER) AS s, o_orderkey, o_custkey,
               CASE WHEN (o_orderkey + s) % 4 = 0 THEN 'X' ELSE o_orderstatus END AS status, o_orderpriority AS priority, CAST(o_orderdate AS TIMESTAMP) AS updated, 'TPC' AS source_code
        FROM orders, (SELECT unnest(generate_series(1, {SNAPSHOTS})) AS s) WHERE (o_orderkey * 7 + s * 13) % 10 <> 0
    ),
    files AS (
        SELECT src_file, strptime(regexp_extract(src_file, '(\\d{{8}}_\\d{{6}})\\.', 1), '%Y%m%d_%H%M%S') AS valid_from,
               lag(src_file) OVER w AS previous_file, lead(src_file) OVER w AS next_file,
               lag(strptime(regexp_extract(src_file, '(\\d{{8}}_\\d{{6}})\\.', 1), '%Y%m%d_%H%M%S')) OVER w AS previous_from,
               lead(strptime(regexp_extract(src_file, '(\\d{{8}}_\\d{{6}})\\.', 1), '%Y%m%d_%H%M%S')) OVER w AS next_from
        FROM (SELECT DISTINCT src_file FROM snap) WINDOW w AS (ORDER BY src_file)
    )
"""

#: Changes as set differences of each extraction and the one before it: a second derivation of what cdc_full_snapshot does with windows.
CHANGES_SQL = f"""{SNAPSHOTS_SQL},
    hashed AS (SELECT snap.*, valid_from, {_HASH} AS row_hash, min(updated) OVER (PARTITION BY o_orderkey) AS first_seen FROM snap JOIN files USING (src_file)),
    extraction AS (SELECT DISTINCT s, src_file, valid_from FROM hashed),
    there AS (SELECT s + 1 AS s, o_orderkey FROM hashed),
    differs AS (SELECT s, o_orderkey, row_hash FROM hashed EXCEPT SELECT s + 1, o_orderkey, row_hash FROM hashed),
    appears AS (SELECT s, o_orderkey FROM differs EXCEPT FROM there),
    marked AS (
        SELECT s, o_orderkey, s AS values_of, 'I' AS op FROM appears
        UNION ALL SELECT s, o_orderkey, s, 'U' FROM (SELECT s, o_orderkey FROM differs EXCEPT FROM appears)
        UNION ALL SELECT s, o_orderkey, s - 1, 'D' FROM (SELECT s, o_orderkey FROM there WHERE s <= {SNAPSHOTS} EXCEPT SELECT s, o_orderkey FROM hashed)
    ),
    changes AS (
        SELECT o_orderkey, o_custkey, status, priority, updated, source_code, row_hash, first_seen, e.src_file, e.valid_from, TIMESTAMP '{LOADED_AT}' AS loaded_at, op
        FROM marked m JOIN extraction e ON e.s = m.s JOIN hashed v USING (o_orderkey) WHERE v.s = m.values_of
    ),
    current_rows AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY source_code, o_orderkey ORDER BY valid_from DESC) = 1)
"""

DELTAS_SQL = f"""{SNAPSHOTS_SQL},
    delta AS (
        SELECT n.*, f.valid_from, {_HASH} AS row_hash, min(n.updated) OVER (PARTITION BY o_orderkey) AS first_seen
        FROM snap n JOIN files f USING (src_file) WHERE s = 1 OR (o_orderkey + s) % 3 = 0
    ),
    delta_lag AS (SELECT *, lag(row_hash) OVER (PARTITION BY o_orderkey ORDER BY src_file) AS before FROM delta),
    delta_changes AS (
        SELECT o_orderkey, o_custkey, status, priority, updated, source_code, row_hash, first_seen, src_file, valid_from, TIMESTAMP '{LOADED_AT}' AS loaded_at,
               CASE WHEN before IS NULL THEN 'I' ELSE 'U' END AS op
        FROM delta_lag WHERE before IS NULL OR before <> row_hash
    )
"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline event log: a run a user and day; sign-ups plan, purchases materialise, errors fail."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "purchase", "error"))
    k = F.get_json_object("props", "$.k")
    asset = F.concat(F.lit('["grp","layer'), (k.cast("int") % 3).cast("string"), F.lit('","asset'), (k.cast("int") % 7).cast("string"), F.lit('"]'))
    kind = F.when(F.col("event_type") == "signup", "PLANNED").when(F.col("event_type") == "purchase", "MATERIALIZATION").otherwise(F.when(F.col("event_id") % 2 == 0, "STEP_FAILURE").otherwise("RUN_FAILURE"))
    job = F.concat(F.lit('{"pipeline_name":"job_'), (F.col("user_id") % 10).cast("string"), F.lit('"'))
    done = F.concat(job, F.lit(',"materialization":{"asset_key":{"path":'), asset, F.lit('},"metadata":{"row_count":{"value":"'), F.when(k.cast("int") % 2 == 0, k).otherwise("n/a"), F.lit('"}},"metadata_entries":[{"label":"rows_written","entry_data":{"value":"'), k, F.lit('"}},{"label":"table","entry_data":{"text":"t'), k, F.lit('"}}]}}'))
    failed = F.concat(job, F.lit(',"user_message":"run failed with '), k, F.lit('","error":{"cls_name":"Error'), (k.cast("int") % 4).cast("string"), F.lit('","message":"code '), k, F.lit('"}}'))
    return e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("run_"), F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("run_id"), F.col("user_id"), asset.alias("asset_key"),
        F.concat(F.lit("step_"), (k.cast("int") % 5).cast("string")).alias("step_key"), F.lit(None).cast("string").alias("partition"), F.col("ts").cast("timestamp_ntz").alias("ts"), kind.alias("kind"),
        F.when(F.col("event_type") == "purchase", done).when(F.col("event_type") == "error", failed).otherwise(F.concat(job, F.lit("}"))).alias("event"),
    )


def run_table(events: DataFrame) -> DataFrame:
    """The runs of an event log; a run without a materialisation hasn't ended."""
    epoch = lambda c: F.unix_seconds(c.cast("timestamp"))
    g = events.groupBy("run_id", "user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.max((F.col("kind") == "MATERIALIZATION").cast("int")).alias("done"), F.max((F.col("kind") == "RUN_FAILURE").cast("int")).alias("bad"))
    return g.select("run_id", F.concat(F.lit("job_"), (F.col("user_id") % 10).cast("string")).alias("pipeline_name"), F.when(F.col("bad") == 1, "FAILURE").when(F.col("done") == 1, "SUCCESS").otherwise("STARTED").alias("status"), F.col("first").alias("created_at"), epoch(F.col("first")).alias("start_time"), F.when(F.col("done") == 1, epoch(F.col("last"))).alias("end_time"))


def person_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of persons, up to two versions each: every page is one, with a biography in tags before its markup; a seventh
    has no tags, some dates are none, some types don't exist."""
    i, s, text = F.col("page_id"), F.col("s"), lambda c: c.cast("string")
    two = lambda c: F.lpad(text(c), 2, "0")
    sex = F.when(i % 3 == 0, "Mand").when(i % 3 == 1, "Kvinde").otherwise("Andet")
    died = F.when(i % 4 == 0, F.concat(F.lit("<died>01-"), two(s), F.lit("-2020</died>"))).otherwise("")
    tags = F.concat(F.lit("<member><sex>"), sex, F.lit("</sex><born>"), two(i % 33), F.lit("-"), two(i % 14), F.lit("-"), text(1930 + i % 70), F.lit("</born>"), died, F.lit("<party>Party "), text((i + s) % 5), F.lit("</party><partyShortname>P"), text((i + s) % 5), F.lit("</partyShortname></member>"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html").withColumn("s", F.explode(F.array(F.lit(1), F.lit(2)))).filter((i + s) % 5 != 0)
    return pages.select(
        i.alias("id"), (i % 6).alias("type_id"), F.concat(F.lit("G"), text(i % 9)).alias("group_short_name"), F.col("url").alias("full_name"), F.concat(F.when(i % 7 != 0, tags).otherwise(""), "html").alias("biography"),
        F.lit("2023-01-01").cast("timestamp_ntz").alias("first_seen"), F.concat(F.lit("2024-0"), text(s), F.lit("-01 12:00:00")).cast("timestamp_ntz").alias("valid_from"), F.lit("TPC").alias("source_code"),
    )


PERSONS_SQL = """
    tagged AS (
        SELECT page_id AS id, page_id % 6 AS type_id, 'G' || (page_id % 9) AS group_short_name, url AS full_name, TIMESTAMP '2023-01-01' AS first_seen, CAST('2024-0' || s || '-01 12:00:00' AS TIMESTAMP) AS began,
               CASE WHEN page_id % 7 = 0 THEN '' ELSE '<member><sex>' || ['Mand', 'Kvinde', 'Andet'][page_id % 3 + 1] || '</sex><born>' || lpad(CAST(page_id % 33 AS VARCHAR), 2, '0') || '-' || lpad(CAST(page_id % 14 AS VARCHAR), 2, '0') || '-' || (1930 + page_id % 70) || '</born>'
               || CASE WHEN page_id % 4 = 0 THEN '<died>01-0' || s || '-2020</died>' ELSE '' END || '<party>Party ' || ((page_id + s) % 5) || '</party><partyShortname>P' || ((page_id + s) % 5) || '</partyShortname></member>' END || html AS biography
        FROM pages, (SELECT unnest([1, 2]) AS s) WHERE (page_id + s) % 5 <> 0
    ),
    persons AS (SELECT *, lead(began) OVER w AS next_from, CAST(row_number() OVER w AS INTEGER) AS version FROM tagged WINDOW w AS (PARTITION BY id ORDER BY began))
"""

EVENTS_SQL = """
    base AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type IN ('signup', 'purchase', 'error')),
    log AS (
        SELECT event_id AS id, 'run_' || user_id || '_' || strftime(ts, '%Y%m%d') AS run_id, user_id, '["grp","layer' || (k % 3) || '","asset' || (k % 7) || '"]' AS asset_key, 'step_' || (k % 5) AS step_key,
               CAST(ts AS TIMESTAMP) AS ts, 'job_' || (user_id % 10) AS job_name, k,
               CASE event_type WHEN 'signup' THEN 'PLANNED' WHEN 'purchase' THEN 'MATERIALIZATION' ELSE CASE WHEN event_id % 2 = 0 THEN 'STEP_FAILURE' ELSE 'RUN_FAILURE' END END AS kind
        FROM base
    ),
    runs AS (
        SELECT run_id, 'job_' || (user_id % 10) AS job_name, CASE WHEN bool_or(kind = 'RUN_FAILURE') THEN 'FAILURE' WHEN bool_or(kind = 'MATERIALIZATION') THEN 'SUCCESS' ELSE 'STARTED' END AS run_status,
               min(ts) AS created_at, date_trunc('second', min(ts)) AS started_at, CASE WHEN bool_or(kind = 'MATERIALIZATION') THEN date_trunc('second', max(ts)) END AS ended_at
        FROM log GROUP BY run_id, user_id
    ),
    pipeline_runs AS (SELECT *, round(CAST(epoch(ended_at) - epoch(started_at) AS DOUBLE), 1) AS duration_seconds FROM runs),
    flat AS (
        SELECT DISTINCT run_id, ts AS event_ts, step_key, job_name AS pipeline_name, 'grp' AS asset_group, 'layer' || (k % 3) AS asset_layer, 'asset' || (k % 7) AS asset_name, 'grp/layer' || (k % 3) || '/asset' || (k % 7) AS asset_full,
               max(CAST(k AS BIGINT)) AS rows_written, max('t' || k) AS export_table
        FROM log WHERE kind = 'MATERIALIZATION' GROUP BY ALL
    )
"""


def key_sql(text: str) -> str:
    """functions.scalars.portable_key in SQL."""
    return f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"
