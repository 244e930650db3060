"""Declarative checks. Each returns the rows that break a rule, or one row that says whether a table passes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """Values that occur more than once, with their number; null is a value."""
    return df.groupBy(*cols).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def accepted_values(df: DataFrame, col: str, values: list, where: Column | None = None) -> DataFrame:
    """Rows with another value; null is accepted (see not_null)."""
    rows = df if where is None else df.filter(where)
    return rows.filter(~F.col(col).isin(values))


def value_length(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.filter(F.length(col) != n)


def matches(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(~F.col(col).rlike(pattern))


def row_count_between(df: DataFrame, least: int, most: int) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("passed", F.col("n_rows").between(least, most))


def column_type(df: DataFrame, col: str, kind: str) -> bool:
    return df.schema[col].dataType.simpleString() == kind


def unique_combination(tables: dict[str, DataFrame], cols: dict[str, list[str]]) -> DataFrame:
    """(table_name, key, n_rows) of combinations that repeat, over many tables."""
    found = [unique(df, cols[name]).select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.col(c).cast("string") for c in cols[name]]).alias("key"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, found)


def freshness(df: DataFrame, col: str, as_of: dt.datetime, warn_days: int = 2, error_days: int = 7) -> DataFrame:
    """The newest value, its age in seconds and pass, warn or error; an empty table is an error."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.expr("timestampdiff(SECOND, newest, now)")
    state = F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_days * 86400), "error").when(F.col("age_seconds") > warn_days * 86400, "warn").otherwise("pass")
    return df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("newest")).withColumn("now", now).withColumn("age_seconds", age.cast("long")).withColumn("status", state).drop("now")


@dataclass(frozen=True)
class Rule:
    """A check of a table: of single rows (broken, value), of values that must not repeat (unique), or of the number of rows (rows)."""

    name: str
    broken: Column | None = None
    value: Column | None = None
    unique: tuple[str, ...] = ()
    rows: tuple[int, int] | None = None
    where: Column | None = None


def must_not_be_null(col: str, where: Column | None = None) -> Rule:
    return Rule(f"{col} not null", F.col(col).isNull(), F.lit(None), where=where)


def must_be_among(col: str, values: list, where: Column | None = None) -> Rule:
    return Rule(f"{col} accepted", ~F.col(col).isin(values), F.col(col), where=where)


def must_have_length(col: str, n: int, where: Column | None = None) -> Rule:
    return Rule(f"{col} length", F.length(col) != n, F.col(col), where=where)


def must_match(col: str, pattern: str, where: Column | None = None) -> Rule:
    return Rule(f"{col} matches", ~F.col(col).rlike(pattern), F.col(col), where=where)


def must_be_unique(*cols: str, where: Column | None = None) -> Rule:
    return Rule(f"{', '.join(cols)} unique", unique=cols, where=where)


def must_have_rows(least: int, most: int) -> Rule:
    return Rule("rows between", rows=(least, most))


def must_have_type(df: DataFrame, col: str, kind: str) -> Rule:
    """Decided here, by the schema: a rule that every table breaks or none, without a look at its rows."""
    own = df.schema[col].dataType.simpleString()
    return Rule(f"{col} type", rows=None if own == kind else (1, 0), value=F.lit(own))


def violations(df: DataFrame, key: list[str], rules: list[Rule]) -> DataFrame:
    """What breaks any of the rules, in one scan of the table: rule, key, value, n_rows.

    A row that breaks a rule on single rows gives its key and the value; a combination that repeats gives itself (null is a value) and
    the number of its rows; a number of rows out of bounds gives that number; a column of another type the type. key and
    combinations are JSON lists of texts. A condition that is null isn't broken. Every row is turned into the entries that concern
    it and all entries are counted by one aggregation, which thins them before the shuffle.
    """
    if len({r.name for r in rules}) < len(rules):
        raise ValueError("rules need names of their own")
    text = lambda cols: F.to_json(F.array(*[F.col(c).cast("string") for c in cols]))
    none = F.lit(None).cast("string")

    def entry(rule: Rule) -> Column:
        holds = F.lit(True) if rule.where is None else F.coalesce(rule.where, F.lit(False))
        if rule.broken is not None:
            holds, parts = holds & F.coalesce(rule.broken, F.lit(False)), (text(key), rule.value.cast("string"))
        elif rule.unique:
            parts = (none, text(rule.unique))
        else:
            parts = (none, none)
        return F.when(holds, F.struct(F.lit(rule.name).alias("rule"), parts[0].alias("key"), parts[1].alias("value"), F.lit(1).cast("long").alias("n")))

    counted = [r for r in rules if r.broken is not None or r.unique or (r.rows and r.value is None)]
    entries = df.select(F.explode(F.array_compact(F.array(*[entry(r) for r in counted]))).alias("e")).select("e.*") if counted else None
    spark = df.sparkSession
    # rules on the number of rows have an entry of weight 0, so that they see an empty table too
    fixed = [(r.name, None, None, 0) for r in rules if r.rows and r.value is None] or None
    if fixed:
        entries = entries.unionByName(spark.createDataFrame(fixed, "rule string, key string, value string, n long"))
    found = entries.groupBy("rule", "key", "value").agg(F.sum("n").alias("n_rows")) if entries is not None else spark.createDataFrame([], "rule string, key string, value string, n_rows long")
    by_name = lambda name: F.col("rule") == name
    broken = F.lit(False)
    for r in counted:
        bound = F.lit(True) if r.broken is not None else F.col("n_rows") > 1 if r.unique else ~F.col("n_rows").between(*r.rows)
        broken = broken | (by_name(r.name) & bound)
    out = found.filter(broken)
    for r in rules:
        if r.rows and r.value is not None:
            out = out.unionByName(spark.range(1).select(F.lit(r.name).alias("rule"), none.alias("key"), r.value.cast("string").alias("value"), F.lit(None).cast("long").alias("n_rows")))
    return out
