import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import registry
from tidemark.functions.scalars import concat_skip_null, entity_file_name, extraction_time, hhmm_key, lenient_date, markup_field, redacted, translated
from tidemark.operators import quality
from tidemark.sources import extractions, sinks


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_registry():
    assert len(registry.entities("DDD")) == 18 and len(registry.entities("RFAM")) == 7 and len(registry.entities(delta=True)) == 8
    assert registry.ENTITIES["RFAM", "genome"].key == "upid"


def test_scalars(spark):
    assert one(spark, concat_skip_null(F.lit("a"), F.lit(None), F.lit(2))) == "a2"
    assert one(spark, markup_field(F.lit("<a>x</a><b>y"), "a")) == "x"
    assert one(spark, markup_field(F.lit("<a>x</a><b>y"), "b")) is None and one(spark, markup_field(F.lit("<a></a>"), "a")) == ""
    assert one(spark, lenient_date(F.lit("31-02-2020"))) is None and one(spark, lenient_date(F.lit("05-03-2020"))) == dt.date(2020, 3, 5)
    assert one(spark, extraction_time(F.lit("a.b_20240131_235959.json"))) == dt.datetime(2024, 1, 31, 23, 59, 59)
    assert one(spark, extraction_time(F.lit("nothing.json"))) is None
    assert one(spark, hhmm_key(F.lit("2024-01-01 09:05:59").cast("timestamp_ntz"))) == 905
    assert one(spark, translated(F.lit(None).cast("string"), {"a": "b"})) == " (not translated yet)"
    assert one(spark, entity_file_name(F.lit("Mødeåæ"))) == "moedeaaae"
    got = one(spark, redacted(F.create_map(F.lit("My_TOKEN"), F.lit("s"), F.lit("CONNECTION_STRING"), F.lit("t"), F.lit("name"), F.lit("n"))))
    assert got == {"My_TOKEN": "***", "CONNECTION_STRING": "***", "name": "n"}


def test_api_page_without_value_is_an_error(spark):
    good = spark.createDataFrame([('{"value": [{"id": 1}, {"id": 2}]}',), ('{"value": []}',)], "body string")
    assert [r.id for r in extractions.flatten_api_pages(good, "body", "struct<id:long>").collect()] == [1, 2]
    with pytest.raises(Exception, match="no value"):
        extractions.flatten_api_pages(spark.createDataFrame([('{"x": 1}',)], "body string"), "body", "struct<id:long>").collect()


def test_lookback_and_watermark(spark):
    assert extractions.lookback_start(dt.date(2024, 3, 1), 31) == dt.date(2024, 1, 30)
    assert extractions.lookback_start(dt.date(2024, 3, 1), 31, "2024-02-02") == dt.date(2024, 2, 2)
    with pytest.raises(ValueError):
        extractions.lookback_start(dt.date(2024, 3, 1), 31, "2024-2-2")
    df = spark.createDataFrame([(1, "2024-01-01 23:00:00"), (2, "2024-01-02 01:00:00")], "id long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert extractions.after_watermark(df, "t", None).count() == 2
    assert [r.id for r in extractions.after_watermark(df, "t", dt.datetime(2024, 1, 2, 9)).collect()] == [2]


def test_seed_with_quoted_comma(spark, tmp_path):
    (tmp_path / "s.csv").write_text('date,Name\n2024-01-01,"New, Year"\n')
    got = extractions.read_seed(spark, str(tmp_path / "s.csv"), "date date, Name string", {"date": "holiday_date", "Name": "holiday_name"}).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 1), "New, Year")]


def test_land_snapshot_and_listing_of_empty_files(spark, tmp_path):
    path = sinks.land_snapshot(spark.createDataFrame([(1, None)], "id long, x string"), str(tmp_path), "e", dt.datetime(2024, 1, 1))
    (tmp_path / "e" / "e_20240201_000000.json").touch()
    files = extractions.list_extractions(spark, f"{tmp_path}/e/e_*.json*").collect()
    assert [f.src_file for f in files] == ["e_20240101_000000.json", "e_20240201_000000.json"] and path.endswith(files[0].src_file)
    assert extractions.read_extractions(spark, f"{tmp_path}/e/e_*.json*", "S", "id long, x string").count() == 1


def test_exports_are_all_tried_and_failures_told_together(spark, tmp_path):
    df = spark.range(3)
    with pytest.raises(RuntimeError, match="bad: boom"):
        sinks.export_all(spark, {"bad": lambda: (_ for _ in ()).throw(ValueError("boom")), "good": lambda: sinks.overwrite_table(df, f"{tmp_path}/good")})
    assert spark.read.parquet(f"{tmp_path}/good").count() == 3
    assert sinks.export_all(spark, {"again": lambda: sinks.overwrite_table(df, f"{tmp_path}/good")}) == {"again": 3}


def test_run_log_is_written_on_failure_and_redacts(spark, tmp_path):
    log = f"{tmp_path}/log"
    assert sinks.append_run_log(spark, log, "p", {"db_password": "x", "n": "1"}, lambda: 7) == 7
    with pytest.raises(KeyError):
        sinks.append_run_log(spark, log, "p", {}, lambda: {}["gone"])
    rows = [json.loads(line) for f in (tmp_path / "log").glob("part-*") for line in f.read_text().splitlines()]
    assert sorted(r["level"] for r in rows) == ["ERROR", "INFO"]
    assert next(r for r in rows if r["level"] == "INFO")["params"] == {"db_password": "***", "n": "1"}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "bb")], "id long, c string")
    assert quality.not_null(df, "c").count() == 1 and quality.unique(df, ["id"]).first().n_rows == 2
    assert quality.accepted_values(df, "c", ["a"]).count() == 1 and quality.value_length(df, "c", 1).count() == 1
    assert quality.column_type(df, "id", "bigint") and not quality.column_type(df, "c", "date")
    empty = df.filter("false").withColumn("t", F.lit(None).cast("timestamp_ntz"))
    assert quality.freshness(empty, "t", dt.datetime(2024, 1, 1)).first().status == "error"
    assert not quality.row_count_between(empty, 1, 2).first().passed
