"""Events paired in one exchange, run summaries, rules in one scan, exports side by side, run logs from files, markup."""

import datetime as dt
import gzip
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import markup_field, with_markup
from tidemark.operators import dimensions, observability, quality
from tidemark.sources import sinks
from tidemark.streaming.ingest import EventFiles

EVENT = "id long, run_id string, asset_key string, step_key string, partition string, ts timestamp_ntz, kind string, event string"


def at(minute, second=0, micro=0):
    return dt.datetime(2024, 1, 1, 0, minute, second, micro)


def same(x):
    return F.xxhash64(x)


def events(spark, rows):
    return spark.createDataFrame([(i, run, asset, step, None, ts, kind, event) for i, (run, step, asset, ts, kind, event) in enumerate(rows)], EVENT)


ROWS = [
    ("r", "s", "a", at(1), "PLANNED", "{}"), ("r", "s", "a", at(3), "PLANNED", "{}"), ("r", "s", "a", at(5), "PLANNED", "{}"),
    ("r", "s", "a", at(4), "MATERIALIZATION", '{"materialization":{"metadata":{"row_count":{"value":"7"}}}}'), ("r", "s", "a", at(0, 30), "MATERIALIZATION", "{}"),
    ("r", "s", "b", at(4), "MATERIALIZATION", "{}"), ("r", None, "a", at(4), "MATERIALIZATION", "{}"), (None, "s", "a", at(4), "MATERIALIZATION", "{}"), (None, "s", "a", at(1), "PLANNED", "{}"),
    ("r", "s", "a", at(6), "RUN_FAILURE", '{"user_message":"first"}'), ("r", "s", "a", at(7), "RUN_FAILURE", '{"user_message":"last"}'), ("r", "s", "c", at(8), "RUN_FAILURE", "{}"), ("q", "s", "a", at(2), "MATERIALIZATION", "{}"),
]


def test_each_materialisation_is_one_row_with_the_plan_before_it(spark):
    got = {(r.run_id, r.step_key, r.asset_key, r.ts): (r.planned_at, r.run_error_message) for r in observability.paired(events(spark, ROWS)).collect()}
    assert got == {
        ("r", "s", "a", at(4)): (at(3), "last"), ("r", "s", "a", at(0, 30)): (at(1), "last"), ("r", "s", "b", at(4)): (None, "last"), ("r", None, "a", at(4)): (None, "last"),
        (None, "s", "a", at(4)): (None, None), ("q", "s", "a", at(2)): (None, None),
    }
    runs = spark.createDataFrame([("r", "FAILURE")], "run_id string, run_status string")
    facts = observability.materialization_fact(events(spark, ROWS), runs, same)
    assert facts.count() == 6 and facts.filter("rows_processed = 7 and run_status = 'FAILURE' and duration_seconds = 60.0").count() == 1


def test_events_are_exchanged_once(spark, tmp_path):
    events(spark, ROWS).write.parquet(f"{tmp_path}/e")
    plan = observability.paired(spark.read.parquet(f"{tmp_path}/e"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_step_failures_of_repeated_plans_and_of_none(spark):
    rows = [("r", "s", "a", at(1), "PLANNED", "{}"), ("r", "s", "a", at(2), "PLANNED", "{}"), ("r", "s", "b", at(2), "PLANNED", "{}"), ("r", "s", None, at(2), "PLANNED", "{}"), ("r", "s", None, at(3), "STEP_FAILURE", '{"error":{"cls_name":"E","message":"m"}}'), ("r", "t", None, at(3), "STEP_FAILURE", "{}"), ("r", None, "z", at(3), "STEP_FAILURE", "{}"), ("r", None, "z", at(3), "PLANNED", "{}")]
    runs = spark.createDataFrame([("r", "job")], "run_id string, job_name string")
    got = sorted((str(r.step_key), str(r.asset_key), str(r.error_class)) for r in observability.step_failures(events(spark, rows), runs, same).collect())
    assert got == [("None", "None", "None"), ("s", "a", "E"), ("s", "b", "E"), ("t", "None", "None")]


def test_run_summary_states_and_durations(spark):
    rows = [("r", "b", None, at(1), "PLANNED", ""), ("r", "b", None, at(1, 2, 345600), "MATERIALIZATION", ""), ("r", "a", None, at(1), "PLANNED", ""), ("r", "a", None, at(2), "MATERIALIZATION", ""), ("r", "a", None, at(1, 30), "STEP_FAILURE", ""), ("r", "c", None, at(1), "STEP_SKIPPED", ""), ("r", "d", None, at(1), "PLANNED", ""), ("r", "e", None, at(1), "RUN_FAILURE", ""), ("r", None, None, at(1), "PLANNED", "")]
    r = observability.run_summary(events(spark, rows)).first()
    assert (r.steps_total, r.steps_succeeded, r.steps_failed, r.steps_skipped) == (4, 1, 1, 1)
    assert [tuple(s) for s in r.steps] == [("a", "FAILURE", 60.0), ("b", "SUCCESS", 2.346), ("c", "SKIPPED", None), ("d", "unknown", None)]


def rules(df):
    return [quality.must_not_be_null("v"), quality.must_be_among("v", ["a", "b"], F.col("id") > 1), quality.must_have_length("v", 1), quality.must_match("v", "^[a-z]+$"), quality.must_be_unique("id"), quality.must_be_unique("id", "v"), quality.must_have_rows(1, 3), quality.must_have_type(df, "id", "int"), quality.must_have_type(df, "v", "string")]


def test_all_rules_in_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "zz"), (2, "c"), (2, None), (3, "A"), (3, "A"), (None, "a")], "id long, v string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    found = quality.violations(df, ["id"], rules(df))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    got = sorted((r.rule, str(r.key), str(r.value), str(r.n_rows)) for r in found.collect())
    assert got == [
        ("id type", "None", "bigint", "None"), ("id unique", "None", '["2"]', "2"), ("id unique", "None", '["3"]', "2"), ("id, v unique", "None", '["3","A"]', "2"), ("rows between", "None", "None", "6"),
        ("v accepted", '["2"]', "c", "1"), ("v accepted", '["3"]', "A", "2"), ("v length", '["1"]', "zz", "1"), ("v matches", '["3"]', "A", "2"), ("v not null", '["2"]', "None", "1"),
    ]


def test_rules_on_an_empty_table_and_none(spark):
    df = spark.createDataFrame([], "id long, v string")
    assert [(r.rule, r.n_rows) for r in quality.violations(df, ["id"], rules(df)).filter("rule <> 'id type'").collect()] == [("rows between", 0)]
    assert quality.violations(df, ["id"], []).collect() == []
    with pytest.raises(ValueError):
        quality.violations(df, ["id"], [quality.must_be_unique("id"), quality.must_be_unique("id")])


def test_exports_overlap_and_tell_every_failure(spark):
    both = threading.Barrier(2, timeout=60)
    pools = []

    def job(n):
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        both.wait()  # passes only when two run at once
        return spark.range(n).count()

    assert sinks.export_all(spark, {"a": lambda: job(3), "b": lambda: job(4)}) == {"a": 3, "b": 4}
    assert sorted(pools) == ["export-a", "export-b"] and spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    done = []

    def bad(text):
        raise ValueError(text)

    with pytest.raises(RuntimeError, match="x: one; z: two"):
        sinks.export_all(spark, {"x": lambda: bad("one"), "y": lambda: done.append(1) or 1, "z": lambda: bad("two")}, at_once=1)
    assert done == [1]


def test_run_logs_from_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.jsonl").write_text('{"id": 1, "kind": "a"}\n{broken\n')
    (folder / "index.jsonl").write_text('{"id": 9, "kind": "index"}\n')
    (folder / "empty.jsonl").write_text("")
    (folder / "bad.jsonl.gz").write_bytes(b"not gzip at all")
    inbox = EventFiles(str(folder), "id long, kind string", f"{tmp_path}/out")
    inbox.ingest(spark)
    assert [tuple(r) for r in inbox.events(spark).collect()] == [(1, "a")]
    assert [r.line for r in inbox.quarantine(spark).collect()] == ["{broken"]
    assert [r.src_path.rsplit("/", 1)[-1] for r in inbox.skipped(spark).collect()] == ["bad.jsonl.gz"]
    (folder / "two.jsonl.gz").write_bytes(gzip.compress(b'{"id": 2, "kind": "b"}\n'))
    inbox.ingest(spark)
    inbox.ingest(spark)  # nothing new
    assert sorted(r.id for r in inbox.events(spark).collect()) == [1, 2]
    inbox.take(spark.createDataFrame([(3, "c", None, "x")], "id long, kind string, _corrupt_record string, src_path string"), 7)
    inbox.take(spark.createDataFrame([(3, "c", None, "x")], "id long, kind string, _corrupt_record string, src_path string"), 7)  # a batch that is written again
    assert sorted(r.id for r in inbox.events(spark).collect()) == [1, 2, 3]


def test_markup_in_one_parse(spark):
    texts = ["<a>1</a><b>2</b>", "<b><a>in</a>ner</b>", "<a>never closed", "<a></a>", "<a>x</a><a>y</a>", "<a>line\nbreak</a>", "", None, "</a><a>late</a>", "<A>other</A>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = with_markup(df, "t", {"a": "x", "b": "y"}).withColumns({"one": markup_field(F.col("t"), "a"), "two": markup_field(F.col("t"), "b")}).orderBy("i").collect()
    assert [r.x for r in got] == ["1", "in", None, "", "x", "line\nbreak", None, None, "late", None]
    assert [(r.x, r.y) for r in got if r.i != 8] == [(r.one, r.two) for r in got if r.i != 8]


def test_person_fields(spark):
    bios = ["<sex>Mand</sex><born>01-02-1950</born><died>31-02-2020</died><party>The Party</party><partyShortname>TP</partyShortname>", "<sex>Andet</sex><born></born>", None]
    changes = spark.createDataFrame([(i, 1, b, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), "S") for i, b in enumerate(bios)], "id long, type_id long, biography string, first_seen timestamp_ntz, valid_from timestamp_ntz, source_code string")
    types = spark.createDataFrame([("S-1", 11, "Medlem")], "bk string, type_key long, type_name string")
    parent = dimensions.Parent(types, "bk", "type_id", {"type_key": "type_key", "type_name": "type_name"}, {"type_key": 0, "type_name": "Ukendt"})
    rows = {r.person_bk: r for r in dimensions.person_dimension(changes, parent, same).collect()}
    a, b, c, u = (rows[k] for k in ("S-0", "S-1", "S-2", "Unknown"))
    assert (a.gender, a.gender_english, a.birth_date, a.death_date, a.party_name, a.party_short_name, a.type_key, a.type_name) == ("Mand", "Male", dt.date(1950, 2, 1), None, "The Party", "TP", 11, "Medlem")
    assert (b.gender_english, b.birth_date, b.party_name) == ("Andet", None, None) and (c.gender, c.gender_english) == (None, None)
    assert (u.person_key, u.type_key, u.type_name, u.gender, u.version) == (0, 0, "Ukendt", None, 1)
