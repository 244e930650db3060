"""Writing tables: extractions, incremental appends, overwrites and run logs. Formats are parameters; Parquet is the default."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import redacted


def file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop's own objects."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


#: Extractions are compressed NDJSON in files of so many rows, as one compressed file is read by one task.
LANDED = {"compression": "gzip", "maxRecordsPerFile": "1000000", "ignoreNullFields": "false"}


def land_snapshot(df: DataFrame, folder: str, entity: str, at: dt.datetime) -> str:
    """Writes one extraction as NDJSON: a folder named after entity and time, whose files executors write side by side."""
    path = f"{folder.rstrip('/')}/{entity}/{entity}_{at:%Y%m%d_%H%M%S}.json"
    df.write.options(**LANDED).json(path)
    return path


def land_snapshots(df: DataFrame, folder: str, entity: str, name: str = "src_file") -> list[str]:
    """Writes many extractions in one job: rows go to the extraction that `name` says. Returns their paths.

    Each is written below a folder of its own first and renamed at the end, so that a reader never sees half of one.
    """
    spark, root = df.sparkSession, f"{folder.rstrip('/')}/{entity}"
    fs, at = file_system(spark, f"{root}/_landing")
    df.write.options(**LANDED).partitionBy(name).json(str(at))
    out = []
    for part in fs.globStatus(file_system(spark, f"{root}/_landing/{name}=*")[1]) or []:
        path = f"{root}/{part.getPath().getName().split('=', 1)[1]}"
        fs.rename(part.getPath(), file_system(spark, path)[1])
        out.append(path)
    fs.delete(at, True)
    return sorted(out)


def new_versions(df: DataFrame, stored: DataFrame, key: list[str], valid_from: str = "valid_from") -> DataFrame:
    """Rows whose (key, valid_from) isn't stored yet; only those columns of the stored table are read.

    Rows meet by key alone, and times are compared there: rows that are dealt out by key already, as changes are, stay where they are.
    """
    names = {c: f"_stored_{i}" for i, c in enumerate([*key, valid_from])}
    there = stored.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = reduce(Column.__and__, [F.col(c) == F.col(names[c]) for c in key])
    at, known = F.col(valid_from), F.col(names[valid_from])
    return df.join(there, same & (at >= known) & (at <= known), "left_anti").select(df.columns)


def new_parts(df: DataFrame, stored: DataFrame, key: list[str], part: str, valid_from: str = "valid_from") -> DataFrame:
    """The same for two tables partitioned by `part`: rows of parts that the stored table lacks need no look, and of the others only
    (key, valid_from) are shuffled; whole rows are only where some of those are new."""
    on = [*key, valid_from]
    both = [r[0] for r in stored.select(part).distinct().collect()]
    fresh = df.filter(~F.col(part).isin(both)) if both else df
    again = df.filter(F.col(part).isin(both))
    if new_versions(again.select(on), stored, key, valid_from).isEmpty():
        return fresh
    return fresh.unionByName(new_versions(again, stored, key, valid_from))


def compressed(fmt: str) -> dict[str, str]:
    """Options of a stored table: row hashes are hex digits, which Zstandard packs and the default codec doesn't."""
    return {"compression": "zstd"} if fmt == "parquet" else {}


def append_rows(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = (), held: bool = False) -> int:
    """Appends rows, with new columns; none leave no file behind. What the first look computes is kept on the executors' disks for
    the write, so nothing is evaluated twice. held: the caller keeps the rows already."""
    rows = df if held else df.persist(StorageLevel.DISK_ONLY)
    try:
        if rows.isEmpty():
            return 0
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).options(**compressed(fmt)).mode("append").option("mergeSchema", "true").partitionBy(*partition_by).save(path)
        return seen.get["n"]
    finally:
        if not held:
            rows.unpersist()


def append_new_versions(df: DataFrame, path: str, key: list[str], valid_from: str = "valid_from", fmt: str = "parquet") -> int:
    """Appends what is new, with new columns; creates the table if there is none; writes nothing if nothing is new.

    Parquet has no transactions: two writers at once may both append a version. Read it back with read_table."""
    spark = df.sparkSession
    if not exists(spark, path):
        return overwrite_table(df, path, fmt)
    return append_rows(new_versions(df, read_table(spark, path, fmt), key, valid_from), path, fmt)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replaces a table; the number of rows is counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).options(**compressed(fmt)).mode("overwrite").option("overwriteSchema", "true").save(path)
    return seen.get["n"]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table with the columns of all its generations; one that a row's generation lacked is null there."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def state_records(spark: SparkSession, path: str) -> list[str]:
    """Paths of the complete records of a state log, the oldest first. A record that a crash cut off lacks its mark of success."""
    fs, at = file_system(spark, f"{path}/*/_SUCCESS")
    return sorted(f.getPath().getParent().toString() for f in fs.globStatus(at) or [])


def write_state(record: DataFrame, path: str, keep: int = 20) -> None:
    """Appends a record (one row, or none for no state) to a state log. Nothing that counts is deleted or replaced before it is
    complete; older records than the last `keep` go afterwards. One writer at a time."""
    spark = record.sparkSession
    done = state_records(spark, path)
    n = int(done[-1].rsplit("/", 1)[-1]) + 1 if done else 0
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/{n:012d}")
    for old in done[: max(0, len(done) + 1 - keep)]:
        fs, at = file_system(spark, old)
        fs.delete(at, True)


def read_state(spark: SparkSession, path: str) -> Row | None:
    """The newest complete record of a state log; None if there is none or it says that there is no state."""
    done = state_records(spark, path)
    return spark.read.parquet(done[-1]).first() if done else None


def drop_state(spark: SparkSession, path: str) -> None:
    """Forgets the state, by a record without a row: a crash before it is complete leaves the state as it was."""
    write_state(spark.range(0), path)


def read_bookmark(spark: SparkSession, path: str) -> str | None:
    """The extraction before the newest one of the last run, from the state log of bookmarks; None before the first run."""
    row = read_state(spark, path)
    return row.previous_file if row else None


def buckets(spark: SparkSession) -> int:
    """Buckets of a stored table by default: as many as a shuffle has parts, so that the two go together."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class KeyedTable:
    """A table stored in buckets by key: windows, aggregations and joins on the key read it without a shuffle.

    An append shuffles its own rows, so that each of its tasks writes one file of one bucket. Tables of the same number of buckets join
    bucket by bucket.
    """

    def __init__(self, spark: SparkSession, name: str, key: list[str], n: int, path: str | None = None):
        self.spark, self.name, self.key, self.n, self.path = spark, name, key, n, path

    def append(self, df: DataFrame) -> None:
        """Adds rows; columns new to the table are null in older rows, columns that df lacks in these."""
        if self.spark.catalog.tableExists(self.name):
            stored = self.spark.table(self.name).schema
            more = [f for f in df.schema if f.name not in stored.names]
            if more:
                self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in more)})")
            df = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in (*stored, *more)])
        out = df.repartition(self.n, *self.key).write.format("parquet").bucketBy(self.n, *self.key).sortBy(*self.key).mode("append")
        (out.option("path", self.path) if self.path else out).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def publish(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Gives a layer its name: as a view, or with a path as a table written there. Returns it as later layers read it."""
    if path is not None:
        overwrite_table(df, path, fmt)
        df = read_table(df.sparkSession, path, fmt)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_evolving(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new rows with the union of their columns; a column that one side lacks is null there."""
    return stored.unionByName(new, allowMissingColumns=True)


def export_all(spark: SparkSession, jobs: dict[str, Callable[[], Any]], at_once: int = 4) -> dict[str, Any]:
    """Runs every export, `at_once` side by side; failures are collected and raised together at the end.

    Each runs in a thread with the caller's settings and in a scheduler pool of its own, so that under FAIR scheduling a long export
    doesn't hold up the others' tasks.
    """

    def run(name: str, job: Callable[[], Any]) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"export-{name}")
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    done, failed = {}, {}
    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name, job) for name, job in jobs.items()}
    for name, future in started.items():
        error = future.exception()
        if error is None:
            done[name] = future.result()
        else:
            failed[name] = error
    if failed:
        raise RuntimeError("exports failed: " + "; ".join(f"{k}: {v}" for k, v in failed.items())) from next(iter(failed.values()))
    return done


def append_run_log(spark: SparkSession, path: str, pipeline: str, params: dict[str, str], job: Callable[[], object]) -> object:
    """Runs a job and appends one NDJSON record of it, also when it fails; a failing log never hides the job's own error."""
    began, error, result = dt.datetime.now(dt.timezone.utc), None, None
    try:
        result = job()
        return result
    except Exception as e:
        error = f"{type(e).__name__}: {e}"
        raise
    finally:
        ended = dt.datetime.now(dt.timezone.utc)
        row = ("ERROR" if error else "INFO", f"{pipeline} {'failed' if error else 'done'}", pipeline, began.isoformat(), ended.isoformat(), round((ended - began).total_seconds(), 3), dict(params), None if result is None else str(result), error)
        try:
            log = spark.createDataFrame([row], "level string, message string, pipeline_type string, started string, ended string, duration_seconds double, params map<string,string>, result string, error string")
            log.withColumn("params", redacted(F.col("params"))).write.mode("append").json(path)
        except Exception:
            if error is None:
                raise
