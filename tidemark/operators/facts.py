"""Facts: measures with the surrogate keys of their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_keys(facts: DataFrame, lookups: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Adds the surrogate key of each dimension; facts without a partner get key 0.

    lookups: (dimension's current version, its business key column, the fact's business key column, its key column). Only the
    two columns of a dimension are joined; Spark broadcasts those that its size threshold allows and shuffles the others.
    """
    out = facts
    for dim, bk, fact_bk, key in lookups:
        slim = dim.select(F.col(bk).alias("_bk"), F.col(key).alias("_key"))
        out = out.join(slim, out[fact_bk] == F.col("_bk"), "left").withColumn(key, F.coalesce("_key", F.lit(0).cast("long"))).drop("_bk", "_key")
    return out
