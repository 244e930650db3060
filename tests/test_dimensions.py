import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.scalars import business_key, surrogate_key
from tidemark.operators import dimensions, facts

LOG = [(1, "Widget-A", "2024-01-01 12:00:00", "I"), (1, "Widget-A-v2", "2024-02-01 12:00:00", "U"), (2, "Widget-B", "2024-01-01 12:00:00", "I"), (3, "Widget-C", "2024-01-01 12:00:00", "I"), (3, "Widget-C", "2024-03-01 12:00:00", "D")]


def dim_of(spark):
    log = spark.createDataFrame([(*r, "DDD") for r in LOG], "id long, name string, at string, op string, source_code string")
    log = log.withColumn("valid_from", F.col("at").cast("timestamp_ntz")).withColumn("first_seen", F.col("valid_from"))
    return dimensions.with_unknown(dimensions.scd2_dimension(log, "id", {"name": F.col("name")}, surrogate_key, "thing"), "thing")


def test_versions_chain_from_1900_and_one_unknown(spark):
    rows = dim_of(spark).collect()
    one = sorted((r for r in rows if r.thing_bk == "DDD-1"), key=lambda r: r.version)
    assert [r.version for r in one] == [1, 2]
    assert one[0].valid_from == dt.datetime(1900, 1, 1) and one[0].valid_to == one[1].valid_from == dt.datetime(2024, 2, 1, 12) and one[1].valid_to == dt.datetime(9999, 12, 31)
    unknown = [r for r in rows if r.thing_key == 0]
    assert len(unknown) == 1 and unknown[0].thing_bk == "Unknown" and unknown[0].name is None
    assert len({r.thing_key for r in rows}) == len(rows) == 6


def test_current_version_and_orphan_facts(spark):
    now = dimensions.current_dimension(dim_of(spark), "thing")
    assert now.count() == 4 and "valid_to" not in now.columns
    votes = spark.createDataFrame([(101, 1), (102, 2), (103, 999), (104, None)], "id long, thing long").withColumn("bk", business_key(F.lit("DDD"), "thing"))
    found = {r.id: r.thing_key for r in facts.resolve_keys(votes, [(now, "thing_bk", "bk", "thing_key")]).collect()}
    newest = {r.thing_bk: r.thing_key for r in now.collect()}
    assert found == {101: newest["DDD-1"], 102: newest["DDD-2"], 103: 0, 104: 0}


def test_calendar_of_a_53_week_year(spark):
    days = dimensions.spine(spark, dt.date(2020, 12, 25), dt.date(2021, 1, 5))
    rows = {r.date_day: r for r in dimensions.calendar(days, dt.date(2021, 1, 1)).collect()}
    d = rows[dt.date(2021, 1, 1)]
    assert (d.iso_year, d.date_week, d.week_day_number, d.year_day_number, d.is_after_today, d.year_offset) == (2020, 53, 5, 1, 0, 0)
    assert rows[dt.date(2020, 12, 31)].has_53_iso_weeks == 1 and d.has_53_iso_weeks == 0
    assert rows[dt.date(2020, 12, 27)].week_offset == -1 and rows[dt.date(2020, 12, 28)].week_offset == 0
    assert rows[dt.date(2020, 12, 31)].year_completed == 1
