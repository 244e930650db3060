"""Reading extractions, seeds, pages of an API and tables; windows and cursors that bound an incremental read."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.scalars import extraction_name, extraction_time

#: Columns that only the loader knows.
LOADER_PREFIXES = ("_dlt_",)


def clean_columns(df: DataFrame) -> DataFrame:
    """Drops the loader's own columns."""
    return df.select([c for c in df.columns if c != "filename" and not c.startswith(LOADER_PREFIXES)])


def read_extractions(spark: SparkSession, path: str | list[str], source: str, schema: StructType | None = None, repeats: bool = False) -> DataFrame:
    """All rows of all extractions under a glob, with union of columns by name, without exact repeats within an extraction; with
    `repeats`, with them, and without the shuffle that finds them."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.json(path)
    named = clean_columns(df).select("*", extraction_name(F.col("_metadata.file_path")).alias("src_file"), F.lit(source).alias("source_code"))
    return named if repeats else named.dropDuplicates()


def list_paths(spark: SparkSession, path: str) -> list[str]:
    """Paths that a glob matches, from the file system itself: empty files count, and no row is read."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(f.getPath().toString() for f in found or [])


def read_latest_extraction(spark: SparkSession, path: str, source: str, schema: StructType | None = None) -> DataFrame:
    """Rows of the extraction with the greatest name; only that one is opened."""
    paths = list_paths(spark, path)
    if not paths:
        raise FileNotFoundError(path)
    latest = max(paths, key=lambda p: p.rstrip("/").rsplit("/", 1)[-1])
    return read_extractions(spark, latest, source, schema).withColumn("deleted", F.lit("N"))


def timeline(files: DataFrame) -> DataFrame:
    """(src_file, valid_from, previous_file, next_file, previous_from, next_from, ordinal, last_ordinal) of a list of names.

    The list has a row an extraction, so one task can order it.
    """
    w = Window.orderBy("src_file")
    whole = Window.partitionBy()
    at = files.select("src_file").withColumn("valid_from", extraction_time(F.col("src_file")))
    return at.select(
        "src_file", "valid_from", F.lag("src_file").over(w).alias("previous_file"), F.lead("src_file").over(w).alias("next_file"),
        F.lag("valid_from").over(w).alias("previous_from"), F.lead("valid_from").over(w).alias("next_from"),
        F.row_number().over(w).alias("ordinal"), F.count("*").over(whole).cast("int").alias("last_ordinal"),
    )


def list_extractions(spark: SparkSession, path: str) -> DataFrame:
    """The timeline of all extractions under a glob, empty ones too."""
    names = [p.rstrip("/").rsplit("/", 1)[-1] for p in list_paths(spark, path)]
    return timeline(spark.createDataFrame([(n,) for n in names], "src_file string"))


def read_seed(spark: SparkSession, path: str, schema: StructType | str, names: dict[str, str]) -> DataFrame:
    """A CSV with a header, declared types and new names."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path).withColumnsRenamed(names)


def read_jdbc_incremental(
    spark: SparkSession, url: str, table: str, updated_col: str | None = None, since: str | None = None, range_col: str | None = None, rows_a_task: int = 1_000_000, fetch_size: int = 100_000, **options: str
) -> DataFrame:
    """Rows of a table updated since a date; the database applies the filter.

    range_col: a number, date or time column by whose ranges tasks read side by side. The database is asked once for its bounds and
    the number of rows since the date; there is a range for every rows_a_task of them, and at least one a core if they are many enough for
    a fetch each. Rows outside the bounds (landed in between) and nulls are read by the outer ranges. Further options are passed on.
    """
    source = {"url": url, "fetchsize": str(fetch_size), **options}
    ranges = {}
    if range_col is not None:
        # names as the source spells them, quoted as its dialect does
        names = {c.lower(): c for c in spark.read.format("jdbc").options(**source, dbtable=table).load().columns}
        quoted = lambda c: spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(names[c.lower()])
        at = f" WHERE {quoted(updated_col)} >= {{ts '{dt.datetime.fromisoformat(since)}'}}" if updated_col and since else ""
        ask = f"SELECT MIN({quoted(range_col)}) AS low, MAX({quoted(range_col)}) AS high, COUNT(*) AS n FROM {table}{at}"
        low, high, n = spark.read.format("jdbc").options(**source, query=ask).load().first()
        tasks = max(-(-n // rows_a_task), min(spark.sparkContext.defaultParallelism, -(-n // fetch_size)))
        if tasks > 1 and low is not None and low < high:
            ranges = {"partitionColumn": range_col, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(tasks)}
    df = spark.read.format("jdbc").options(**source, dbtable=table, **ranges).load()
    return df if updated_col is None or since is None else updated_since(df, updated_col, since)


def updated_since(df: DataFrame, updated_col: str, since: str) -> DataFrame:
    """Rows from a date or time on. The bound has the column's own type, so that no cast keeps it from the source."""
    kind = {f.name.lower(): f.dataType for f in df.schema}[updated_col.lower()]
    return df.filter(F.col(updated_col) >= F.lit(since).cast("timestamp_ntz").cast(kind))


def flatten_api_pages(pages: DataFrame, body: str, record: str) -> DataFrame:
    """One row a record of raw pages `{"value": [...]}`; a page without `value` is an error. record: the records' DDL type."""
    parsed = pages.withColumn("page", F.from_json(body, f"struct<value:array<{record}>>"))
    value = F.when(F.col("page.value").isNull(), F.raise_error(F.lit("a page has no value"))).otherwise(F.col("page.value"))
    return parsed.select(F.explode(value).alias("r")).select("r.*")


def lookback_start(as_of: dt.date, days: int, date: str | None = None) -> dt.date:
    """The lower bound of an incremental read: a date given as YYYY-MM-DD, else so many days before as_of."""
    if date is None:
        return as_of - dt.timedelta(days)
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", date):
        raise ValueError(f"{date!r} is not YYYY-MM-DD")
    return dt.date.fromisoformat(date)


def lookback_filter(df: DataFrame, col: str, as_of: dt.date, days: int, date: str | None = None) -> DataFrame:
    return df.filter(F.col(col) >= F.lit(lookback_start(as_of, days, date).isoformat()).cast("date"))


def watermark(df: DataFrame, col: str) -> DataFrame:
    """The cursor after a run: one row with the greatest value."""
    return df.agg(F.max(col).alias("cursor"))


def after_watermark(df: DataFrame, col: str, cursor: dt.datetime | None) -> DataFrame:
    """Rows from the day of the cursor on (inclusive, so runs overlap by part of a day); no cursor: all rows."""
    if cursor is None:
        return df
    return df.filter(F.col(col) >= F.lit(cursor.date().isoformat()).cast("timestamp_ntz"))


def read_event_files(spark: SparkSession, path: str, schema: StructType | str, skip: str = "index.*") -> DataFrame:
    """Events of many per-run files: files named like `skip` are left out, unreadable ones too. A malformed row of a file that
    can be read stays, with its text in one more column, `_corrupt_record`, which is null in all other rows."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    whole = StructType([*fields, StructField("_corrupt_record", StringType())])
    df = spark.read.schema(whole).option("ignoreCorruptFiles", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return df.filter(~F.col("_metadata.file_name").rlike(f"^{skip}$"))
