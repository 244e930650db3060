"""Small relational building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of every key by `order`: a row number with a limit, which Spark applies to each partition's keys before the shuffle
    too, so that at most a row a key and partition is moved.

    A null in `order` comes first. Ties are broken by the values of the remaining columns, so the answer doesn't depend on the
    partitioning; columns that can't be compared (maps) don't break ties.
    """
    rest = [f.name for f in df.schema if f.name not in key and f.name not in order and "map<" not in f.dataType.simpleString()]
    n = _own("n", df)
    w = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in (*order, *rest)])
    return df.withColumn(n, F.row_number().over(w)).filter(F.col(n) == 1).drop(n)


def _own(name: str, df: DataFrame) -> str:
    """A column name that df doesn't have."""
    while name in df.columns:
        name = "_" + name
    return name


def latest_by_group_join(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows at the greatest `order` of their key: an aggregate joined back; ties all stay."""
    return df.join(df.groupBy(*key).agg(F.max(order).alias(order)), [*key, order], "left_semi")


def row_ids(df: DataFrame, order: list[str], path: str, name: str = "row_id") -> DataFrame:
    """Numbers all rows from 1 by `order` (whose values must be unique) without a single task for all of them.

    Rows are dealt out by range and written to path; each range is numbered by itself, and starts after the rows of the ranges
    before it: a sum over one row a range.
    """
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = df.sparkSession.read.parquet(path)
    counts = dealt.groupBy("_range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_own", own).join(F.broadcast(starts), "_range").select(*df.columns, (F.col("_start") + F.col("_own")).alias(name))


def select_where(df: DataFrame, keep) -> DataFrame:
    """The columns whose name satisfies a predicate."""
    return df.select([c for c in df.columns if keep(c)])
