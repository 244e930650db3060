"""Incremental ingest of extraction files: a streaming checkpoint is the cursor, each run takes what is new and stops."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.scalars import extraction_name
from tidemark.sources import sinks


def new_extractions(spark: SparkSession, path: str, source: str, schema: StructType | str) -> DataFrame:
    """A stream of the rows of extraction files, with src_file and source_code."""
    rows = spark.readStream.schema(schema).json(path)
    return rows.select("*", extraction_name(F.col("_metadata.file_path")).alias("src_file"), F.lit(source).alias("source_code"))


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Hands all rows of files that no earlier run took to `write`, in batches, then stops.

    A batch may be written again after a crash: `write` should be idempotent (sources.sinks.append_new_versions is).
    """
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


@dataclass(frozen=True)
class EventFiles:
    """Log files of many runs below a folder (files or folders of files), taken in as they appear.

    Every run of ingest reads the files that no earlier one took: the streaming checkpoint below `out` is the cursor. Rows go to
    `out/events`, lines that aren't rows to `out/quarantine` with their file and text. Files named like `skip` are left alone;
    a file that can't be read stops nothing and is found by skipped. A batch that is written again after a crash replaces what it had
    written.
    """

    folder: str
    schema: str
    out: str
    skip: str = "index[.].*"

    def ingest(self, spark: SparkSession) -> None:
        fields = StructType.fromDDL(self.schema).fields
        whole = StructType([*fields, StructField("_corrupt_record", StringType())])
        reader = spark.readStream.schema(whole).option("ignoreCorruptFiles", "true").option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", "true")
        rows = reader.json(self.folder).select("*", F.col("_metadata.file_path").alias("src_path"))
        run_available(rows.filter(~self.skipped_name(F.col("src_path"))), f"{self.out}/checkpoint", self.take)

    def take(self, batch: DataFrame, number: int) -> None:
        held = batch.withColumn("batch", F.lit(number)).persist()
        try:
            for name, rows in (("events", held.filter("_corrupt_record is null").drop("_corrupt_record")), ("quarantine", held.filter("_corrupt_record is not null").select("src_path", F.col("_corrupt_record").alias("line"), "batch"))):
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.out}/{name}")
        finally:
            held.unpersist()

    def skipped_name(self, path: Column) -> Column:
        """Whether a file, or a folder that it lies in below this one, is named like `skip`."""
        return path.rlike(f"/{self.folder.rstrip('/').rsplit('/', 1)[-1]}/(?:[^/]*/)*{self.skip}(?:/|$)")

    def events(self, spark: SparkSession) -> DataFrame:
        names = [f.name for f in StructType.fromDDL(self.schema).fields]
        return spark.read.schema(f"{self.schema}, src_path string, batch int").parquet(f"{self.out}/events").select(*names)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("src_path string, line string, batch int").parquet(f"{self.out}/quarantine").select("src_path", "line")

    def skipped(self, spark: SparkSession) -> DataFrame:
        """(src_path, n_bytes) of files that have bytes and gave neither a row nor a quarantined line: not readable, or not yet read."""
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.folder).select(F.col("path").alias("src_path"), F.col("length").alias("n_bytes"))
        listed = listed.filter(~self.skipped_name(F.col("src_path")) & ~F.col("src_path").rlike("/[_.][^/]*$"))
        seen = spark.read.schema(f"{self.schema}, src_path string, batch int").parquet(f"{self.out}/events").select("src_path").unionByName(self.quarantine(spark).select("src_path")).distinct()
        plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
        return listed.filter("n_bytes > 0").withColumn("k", plain("src_path")).join(seen.select(plain("src_path").alias("k")), "k", "left_anti").select("src_path", "n_bytes")
