"""Daily runs of change data capture whose cost doesn't grow with the history.

A run reads the newest extraction of the last run (which may have been landed again since), the new ones, and one row a key that
stands for all extractions before. It writes the keys' state at the extraction before the newest, appends the changes that aren't
stored, and at last writes the bookmark that names that state. A crash before the bookmark leaves the last run's state in force; what was
appended already is found again and not appended twice.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc, quality
from tidemark.registry import LOOKBACK_DAYS, Entity, entities
from tidemark.sources import sinks
from tidemark.sources.extractions import after_watermark, list_paths, lookback_start, read_extractions, read_jdbc_incremental, timeline, watermark

MARK = "src_file string, previous_file string, state_path string"
VIOLATIONS = "table_name string, rule string, key string, value string, n_rows long"
#: Days that an extraction of changed rows looks back where its source has no number of its own.
LOOKBACK = 31


@dataclass(frozen=True)
class Run:
    """What a run did: the extractions that it read, in order, the rows it appended and the newest extraction it knows of."""

    read: list[str] = field(default_factory=list)
    appended: int = 0
    newest: str | None = None


@dataclass(frozen=True)
class ChangeTable:
    """An entity's change log with the state of its runs, below one folder. The log is partitioned by extraction."""

    entity: Entity
    folder: str

    @property
    def log(self) -> str:
        return f"{self.folder}/log"

    @property
    def bookmarks(self) -> str:
        return f"{self.folder}/bookmarks"

    def changes(self, spark: SparkSession) -> DataFrame:
        """The stored log; columns that a row's generation lacked are null there."""
        stored = sinks.read_table(spark, self.log)
        own = cdc.change_columns(stored.columns)
        return stored.select(own)

    def refresh(self, spark: SparkSession, glob: str, loaded_at: Column) -> Run:
        """A run from scratch: the state is forgotten first, then the log is rebuilt from all extractions that are there. A crash in
        between is mended by any later run."""
        sinks.drop_state(spark, self.bookmarks)
        fs, at = sinks.file_system(spark, self.log)
        fs.delete(at, True)
        return self.run(spark, glob, loaded_at)

    def run(self, spark: SparkSession, glob: str, loaded_at: Column) -> Run:
        """Brings the log up to the extractions that the glob finds. An extraction that appears later under a name older than the
        last run's newest isn't looked at; a refresh takes it in."""
        e, key = self.entity, [self.entity.key]
        mark = sinks.read_state(spark, self.bookmarks)
        paths = {p.rstrip("/").rsplit("/", 1)[-1]: p for p in list_paths(spark, glob)}
        # the state stands for the extraction before the last run's newest, and for all before it
        known = mark.previous_file if mark else None
        names = sorted(n for n in paths if known is None or n > known)
        if not names:
            return Run(newest=mark.src_file if mark else None)
        files = timeline(spark.createDataFrame([(n,) for n in names], "src_file string"))
        rows = read_extractions(spark, [paths[n] for n in names], e.source, e.schema, repeats=True)
        before = spark.read.parquet(mark.state_path) if mark and mark.state_path else None
        if before is not None:  # columns that left the source stay in the log
            rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in before.schema if f.name not in (*rows.columns, "first_seen", "present")])
        found = cdc.cdc_run(rows, files, key, loaded_at, e.date_col, e.unhashed, before, e.delta)
        if sinks.exists(spark, self.log):
            # only the partitions of these extractions are looked at; rows of the state have no time and stay
            found = sinks.new_versions(found, sinks.read_table(spark, self.log).filter(F.col("src_file") >= names[0]), key)
        # changes and state come from one pass; the state is written first, as Spark drops what it keeps of a table that is written to
        found = found.persist(StorageLevel.DISK_ONLY)
        try:
            state = mark.state_path if mark else None
            if len(names) > 1:
                state = f"{self.folder}/states/{names[-2]}-{uuid.uuid4().hex}"
                columns = cdc.data_columns(rows, before)
                found.filter("op is null").select(*columns, "first_seen", "present").write.options(**sinks.compressed("parquet")).parquet(state)
                known = names[-2]
            appended = sinks.append_rows(found.filter("op is not null").drop("present"), self.log, partition_by=("src_file",), held=True)
        finally:
            found.unpersist()
        sinks.write_state(spark.createDataFrame([(names[-1], known, state)], MARK), self.bookmarks)
        return Run(names, appended, names[-1])

    def export(self, spark: SparkSession, target: str) -> int:
        """Appends to a table elsewhere what it lacks of this log; returns the number of rows.

        Only the log's partitions from the newest of the last export on are read, here and there: that one may have grown. The mark
        of the last export is written after the rows, so a crash in between repeats none.
        """
        if not sinks.exists(spark, self.log):
            return 0
        marks = f"{self.folder}/exports/{uuid.uuid5(uuid.NAMESPACE_URL, target).hex}"
        mark = sinks.read_state(spark, marks)
        rows = self.changes(spark)
        if mark:
            rows = rows.filter(F.col("src_file") >= mark.src_file)
        newest = rows.agg(F.max("src_file")).first()[0]
        if newest is None:
            return 0
        if sinks.exists(spark, target):
            there = sinks.read_table(spark, target)
            rows = sinks.new_parts(rows, there.filter(F.col("src_file") >= mark.src_file) if mark else there, [self.entity.key], "src_file")
        exported = sinks.append_rows(rows, target, partition_by=("src_file",))
        sinks.write_state(spark.createDataFrame([(newest,)], "src_file string"), marks)
        return exported

    def violations(self, spark: SparkSession) -> DataFrame:
        """What breaks the rules of every change log: table_name, and quality.violations."""
        key = self.entity.key
        if not sinks.exists(spark, self.log):  # nothing has ever changed
            return spark.createDataFrame([], VIOLATIONS)
        rows = self.changes(spark)
        rules = [
            quality.must_not_be_null(key), quality.must_not_be_null("valid_from"), quality.must_be_among("op", ["I", "U", "D"]), quality.must_have_length("row_hash", 64), quality.must_be_unique(key, "valid_from"),
        ]
        return quality.violations(rows, [key, "valid_from"], rules).select(F.lit(self.entity.name).alias("table_name"), "*")


@dataclass(frozen=True)
class Cursor:
    """The greatest value of a column that earlier runs have seen, kept in a state log."""

    path: str
    column: str

    def rows(self, df: DataFrame) -> DataFrame:
        """Rows from the day of the cursor on, that day included; all rows before the first run or after a drop."""
        mark = sinks.read_state(df.sparkSession, self.path)
        return after_watermark(df, self.column, mark.cursor if mark else None)

    def advance(self, rows: DataFrame) -> None:
        """Moves the cursor to the greatest value of rows, once they are stored; never back, and not at all for none."""
        spark = rows.sparkSession
        mark, now = sinks.read_state(spark, self.path), watermark(rows, self.column)
        found = now.first().cursor
        if found is not None and (mark is None or found > mark.cursor):
            sinks.write_state(spark.createDataFrame([(found,)], now.schema), self.path)

    def drop(self, spark: SparkSession) -> None:
        """Forgets the cursor, so that the next run is a full one."""
        sinks.drop_state(spark, self.path)


def extract_jdbc(spark: SparkSession, url: str, entity: Entity, folder: str, at: dt.datetime, date: str | None = None, table: str | None = None, **options: str) -> str:
    """Reads an entity's table from a database and lands it as one extraction; returns its path. An entity of changed rows is read
    from a date on: the one given, else so many days before `at` as its source looks back; others are read whole."""
    since = lookback_start(at.date(), LOOKBACK_DAYS.get(entity.source, LOOKBACK), date).isoformat() if entity.delta and entity.date_col else None
    rows = read_jdbc_incremental(spark, url, table or entity.name, entity.date_col if since else None, since, **options)
    return sinks.land_snapshot(rows, folder, entity.name, at)


def extract_source(spark: SparkSession, url: str, source: str, folder: str, at: dt.datetime, date: str | None = None, at_once: int = 4, **options: str) -> dict[str, str]:
    """Lands an extraction of every registered entity of a source, `at_once` side by side; all are tried, and failures are raised
    together at the end. Returns the path of each."""
    return sinks.export_all(spark, {e.name: (lambda e=e: extract_jdbc(spark, url, e, folder, at, date, **options)) for e in entities(source)}, at_once)


def daily(spark: SparkSession, extractions: Mapping[Entity, str], folder: str, exports: str, loaded_at: Column, at_once: int = 4) -> tuple[dict[str, int], DataFrame]:
    """A day's run over many entities (entity: glob of its extractions), `at_once` side by side: changes, then their export.

    Every step of every entity leaves a record in folder/runs/<entity>; all are tried, and failures are raised together at the end.
    Returns the number of rows that each entity appended, and what breaks the rules of the logs.
    """
    tables = {e.name: ChangeTable(e, f"{folder}/{e.name}") for e in extractions}

    def step(e: Entity) -> int:
        log, table = f"{folder}/runs/{e.name}", tables[e.name]
        params = {"entity": e.name, "extractions": extractions[e]}
        done = sinks.append_run_log(spark, log, "changes", params, lambda: table.run(spark, extractions[e], loaded_at))
        sinks.append_run_log(spark, log, "export", params, lambda: table.export(spark, f"{exports}/{e.name}"))
        return done.appended

    appended = sinks.export_all(spark, {e.name: (lambda e=e: step(e)) for e in extractions}, at_once)
    return appended, reduce(DataFrame.unionByName, [t.violations(spark) for t in tables.values()])
