"""Daily runs against the batch log; what they read; stored state that survives crashes; tables stored by key; reads through JDBC."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.incremental import ChangeTable, Cursor, daily, extract_jdbc, extract_source
from tidemark.plans import history as h
from tidemark.plans import queries
from tidemark.registry import Entity, entities
from tidemark.sources import extractions, sinks

SCHEMA = "id long, v string, day timestamp_ntz"
THING = Entity("thing", "S", "id", False, "day", SCHEMA, ("day",))


def now():
    return F.lit("2024-06-15 06:00:00").cast("timestamp_ntz")


def land(folder, name, rows):
    (folder / name).write_text("".join(json.dumps(dict(zip(("id", "v", "day"), r, strict=True))) + "\n" for r in rows))


def shown(df):
    return sorted(tuple(str(r[c]) for c in ("id", "v", "day", "row_hash", "first_seen", "src_file", "valid_from", "op")) for r in df.collect())


def batch(spark, entity, glob):
    rows = extractions.read_extractions(spark, glob, "S", entity.schema)
    find = cdc.cdc_delta if entity.delta else cdc.cdc_full_snapshot
    return find(rows, extractions.list_extractions(spark, glob), ["id"], now(), entity.date_col, entity.unhashed)


def history(rng, delta):
    """Extractions with returning keys, empty ones, nulls, and dates that also go back where a row changes."""
    out, day = {}, 0
    for m in range(1, 7):
        day += 1
        share = 0.4 if delta else rng.choice([0.0, 0.6, 0.9])
        out[f"thing_2024{m:02d}01_120000.json"] = [(k, rng.choice(["a", "b", None]), f"2023-01-{1 + (k + day) % 28:02d}T00:00:00") for k in range(10) if rng.random() < share]
    return out


def first_seen_so_far(files, key, upto):
    return min(d for name, rows in files.items() if name <= upto for k, _, d in rows if k == key)


@pytest.mark.parametrize("delta", [False, True])
def test_daily_runs_give_the_batch_log_and_read_two_extractions(spark, tmp_path, delta):
    rng = random.Random(11 + delta)
    files = history(rng, delta)
    entity = Entity("thing", "S", "id", delta, "day", SCHEMA, ("day",))
    (tmp_path / "in").mkdir()
    glob, table, read = f"{tmp_path}/in/thing_*.json*", ChangeTable(entity, f"file://{tmp_path}/silver"), []
    for name in sorted(files):
        land(tmp_path / "in", name, files[name])
        read.append(table.run(spark, glob, now()).read)
        assert table.run(spark, glob, now()).appended == 0  # a replay
    assert [len(r) for r in read] == [1] + [2] * (len(files) - 1)
    got = table.changes(spark)
    # the dates first seen are those of the run that wrote the row: no later extraction changes a stored row
    keep = ("id", "v", "row_hash", "src_file", "valid_from", "op")
    assert sorted(map(str, got.select(*keep).collect())) == sorted(map(str, batch(spark, entity, glob).select(*keep).collect()))
    for r in got.collect():
        assert r.first_seen == dt.datetime.fromisoformat(first_seen_so_far(files, r.id, r.src_file))
    state = spark.read.parquet(sinks.read_state(spark, table.bookmarks).state_path)
    assert state.count() <= 10


def test_state_rows_are_all_that_a_run_reads_of_the_past(spark, tmp_path):
    (tmp_path / "in").mkdir()
    glob, table = f"{tmp_path}/in/thing_*.json*", ChangeTable(THING, f"file://{tmp_path}/silver")
    bytes_read = []
    for m in range(1, 5):
        land(tmp_path / "in", f"thing_2024{m:02d}01_120000.json", [(k, str(m), "2024-01-01T00:00:00") for k in range(200)])
        table.run(spark, glob, now())
        stored = sinks.read_table(spark, table.log).filter(F.col("src_file") >= f"thing_2024{m:02d}01_120000.json")
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(src_file" in plan
        state = sinks.read_state(spark, table.bookmarks).state_path
        bytes_read.append(spark.read.parquet(state).count() if state else 0)
    assert bytes_read == [0] + [200] * 3


def test_a_crash_anywhere_leaves_a_log_that_the_next_run_completes(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    glob, table = f"{tmp_path}/in/thing_*.json*", ChangeTable(THING, f"file://{tmp_path}/silver")
    files = {f"thing_2024{m:02d}01_120000.json": [(k, f"{(k * m) % 3}", "2024-01-01T00:00:00") for k in range(8) if (k + m) % 4] for m in range(1, 5)}
    for n, name in enumerate(sorted(files)):
        land(tmp_path / "in", name, files[name])
        broken = ("append_rows", "write_state")[n % 2]

        def fail(*a, **k):
            raise OSError("lost")

        with monkeypatch.context() as m:
            m.setattr(sinks, broken, fail)
            with pytest.raises(OSError):
                table.run(spark, glob, now())
        table.run(spark, glob, now())
    assert shown(table.changes(spark)) == shown(batch(spark, THING, glob))
    assert table.refresh(spark, glob, now()).read == sorted(files)
    assert shown(table.changes(spark)) == shown(batch(spark, THING, glob))


def test_the_newest_extraction_may_be_landed_again_and_columns_may_come_and_go(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path, entity = tmp_path / "in", Entity("w", "S", "id", False, None)
    glob, table = f"{path}/w_*.json*", ChangeTable(entity, f"file://{tmp_path}/silver")
    (path / "w_20240101_120000.json").write_text('{"id": 1, "b": "x"}\n')
    table.run(spark, glob, now())
    (path / "w_20240201_120000.json").write_text('{"id": 1, "b": "x"}\n')
    table.run(spark, glob, now())
    (path / "w_20240201_120000.json").write_text('{"id": 1, "b": "x"}\n{"id": 2, "b": "late"}\n')
    assert table.run(spark, glob, now()).appended == 1
    (path / "w_20240301_120000.json").write_text('{"id": 1, "a": "new", "b": "x"}\n{"id": 2, "b": "late"}\n')
    table.run(spark, glob, now())
    (path / "w_20240401_120000.json").write_text('{"id": 1, "a": "new"}\n')
    table.run(spark, glob, now())
    (path / "w_20240501_120000.json").write_text("")
    table.run(spark, glob, now())
    got = sorted((r.src_file[6:8], r.id, r.op, r.a, r.b) for r in table.changes(spark).collect())
    assert got == [("01", 1, "I", None, "x"), ("02", 2, "I", None, "late"), ("03", 1, "U", "new", "x"), ("04", 1, "U", "new", None), ("04", 2, "D", None, "late"), ("05", 1, "D", "new", None)]


def test_state_log_survives_a_crash_between_data_and_record(spark, tmp_path):
    path = f"file://{tmp_path}/marks"
    record = lambda x: spark.createDataFrame([(x,)], "previous_file string")
    assert sinks.read_state(spark, path) is None and sinks.read_bookmark(spark, path) is None
    for i in range(5):
        sinks.write_state(record(str(i)), path, keep=3)
    assert sinks.read_bookmark(spark, path) == "4" and len(sinks.state_records(spark, path)) == 3
    (tmp_path / "marks" / "000000000005").mkdir()  # a record that was begun and never finished
    assert sinks.read_bookmark(spark, path) == "4"
    sinks.write_state(record("6"), path)
    assert sinks.read_bookmark(spark, path) == "6"
    sinks.drop_state(spark, path)
    assert sinks.read_state(spark, path) is None
    sinks.write_state(record("7"), path)
    assert sinks.read_bookmark(spark, path) == "7"


def test_appends_evaluate_their_rows_once_and_leave_no_empty_file(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(1000).repartition(4).mapInPandas(count, "id long")
    path = f"file://{tmp_path}/t"
    assert sinks.append_rows(df, path) == 1000 and seen.value == 1000
    assert sinks.append_rows(df.filter("id < 0"), f"file://{tmp_path}/none") == 0
    assert not (tmp_path / "none").exists()


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "Exchange" in line]


def test_stored_by_key_nothing_is_shuffled(spark, data):
    orders, lines = queries.keyed_orders(spark, data), queries.keyed_lines(spark, data)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(cdc.current_version(orders.read(), ["o_orderkey"])) == []
        assert exchanges(queries.fact_lookup(orders, lines)) == []
        assert exchanges(cdc.current_version(h.order_changes(spark, data), ["o_orderkey"])) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keyed_table_takes_new_and_missing_columns(spark, tmp_path):
    t = sinks.KeyedTable(spark, "keyed_test", ["id"], 3, f"file://{tmp_path}/t")
    t.append(spark.createDataFrame([(1, "a")], "id long, v string"))
    t.append(spark.createDataFrame([(2, 7)], "id long, n int"))
    assert sorted(tuple(r) for r in t.read().select("id", "v", "n").collect()) == [(1, "a", None), (2, None, 7)]
    spark.sql("DROP TABLE keyed_test")


def test_jdbc_read_is_cut_in_ranges_and_filtered_by_the_database(spark, data):
    url = h.embedded_database(spark)
    rows = [(i, f"v{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(500)] + [(None, "null id", dt.datetime(2024, 1, 20)), (600, "old", None)]
    df = spark.createDataFrame(rows, "id long, v string, changed timestamp_ntz")
    df.write.format("jdbc").options(url=url, dbtable="t", createTableColumnTypes="v VARCHAR(20)").save()
    got = extractions.read_jdbc_incremental(spark, url, "t", "changed", "2024-01-11", "id", rows_a_task=50, preferTimestampNTZ="true")
    assert got.rdd.getNumPartitions() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(changed), *GreaterThanOrEqual(changed" in plan
    expected = [r for r in rows if r[2] and r[2] >= dt.datetime(2024, 1, 11)]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected))
    whole = extractions.read_jdbc_incremental(spark, url, "t", rows_a_task=50, range_col="id")
    assert whole.count() == len(rows)
    assert extractions.read_jdbc_incremental(spark, url, "t", "changed", "2030-01-01", "id").count() == 0


def test_exports_read_only_what_may_be_new(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    glob, table, target = f"{tmp_path}/in/thing_*.json*", ChangeTable(THING, f"file://{tmp_path}/silver"), f"file://{tmp_path}/gold/thing"
    counts = []
    for m in range(1, 5):
        land(tmp_path / "in", f"thing_2024{m:02d}01_120000.json", [(k, str(m), "2024-01-01T00:00:00") for k in range(5)])
        table.run(spark, glob, now())
        if m == 3:  # lost between the rows and the mark
            with monkeypatch.context() as patch:
                patch.setattr(sinks, "write_state", lambda *a, **k: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    table.export(spark, target)
        counts.append(table.export(spark, target))
    assert counts == [5, 5, 0, 5] and table.export(spark, target) == 0
    assert shown(sinks.read_table(spark, target)) == shown(table.changes(spark))


def test_a_day_of_several_entities(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "thing_20240101_120000.json", [(1, "a", "2024-01-01T00:00:00"), (2, "b", "2024-01-01T00:00:00")])
    (tmp_path / "in" / "bad_20240101_120000.json").write_text("{}\n")
    good, bad = f"{tmp_path}/in/thing_*.json*", f"{tmp_path}/in/bad_*.json*"
    out, gold = f"file://{tmp_path}/silver", f"file://{tmp_path}/gold"
    appended, broken = daily(spark, {THING: good}, out, gold, now())
    assert appended == {"thing": 2} and broken.collect() == []
    wrong = Entity("bad", "S", "nosuchkey", False, None, "id long")
    with pytest.raises(RuntimeError, match="bad: "):
        daily(spark, {wrong: bad, THING: good}, out, gold, now())
    logs = spark.read.json(f"{tmp_path}/silver/runs/*")
    assert sorted((r.level, r.pipeline_type) for r in logs.collect()) == [("ERROR", "changes"), ("INFO", "changes"), ("INFO", "changes"), ("INFO", "export"), ("INFO", "export")]
    spoiled = ChangeTable(THING, f"{out}/thing")
    spoiled.changes(spark).limit(1).withColumn("op", F.lit("X")).write.mode("append").partitionBy("src_file").parquet(spoiled.log)
    assert sorted(r.rule for r in spoiled.violations(spark).collect()) == ["id, valid_from unique", "op accepted"]


def test_an_entity_without_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    land(tmp_path / "in", "thing_20240101_120000.json", [])
    appended, broken = daily(spark, {THING: f"{tmp_path}/in/thing_*.json*"}, f"file://{tmp_path}/silver", f"file://{tmp_path}/gold", now())
    assert appended == {"thing": 0} and broken.collect() == []
    land(tmp_path / "in", "thing_20240201_120000.json", [(1, "a", "2024-01-01T00:00:00")])
    assert daily(spark, {THING: f"{tmp_path}/in/thing_*.json*"}, f"file://{tmp_path}/silver", f"file://{tmp_path}/gold", now())[0] == {"thing": 1}
    assert sinks.read_table(spark, f"file://{tmp_path}/gold/thing").count() == 1


def test_from_a_database_to_a_change_log(spark, tmp_path):
    url = h.embedded_database(spark)
    entity = Entity("parts", "S", "id", True, "day", SCHEMA, ("day",))
    rows = [(i, f"v{i}", dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.format("jdbc").options(url=url, dbtable="parts", createTableColumnTypes="v VARCHAR(20)").save()
    folder, table = f"file://{tmp_path}/in", ChangeTable(entity, f"file://{tmp_path}/silver")
    extract_jdbc(spark, url, entity, folder, dt.datetime(2024, 2, 1, 12), date="2024-01-01", range_col="id", preferTimestampNTZ="true")
    extract_jdbc(spark, url, entity, folder, dt.datetime(2024, 3, 1, 12), preferTimestampNTZ="true")  # 31 days back
    run = table.run(spark, f"{folder}/parts/parts_*.json*", now())
    assert run.read == ["parts_20240201_120000.json", "parts_20240301_120000.json"] and run.appended == 60
    second = spark.read.schema(SCHEMA).json(f"{folder}/parts/parts_20240301_120000.json")
    assert sorted(r.id for r in second.collect()) == list(range(29, 60))


def test_cursor_is_kept_and_can_be_dropped(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=8 * i)) for i in range(9)], "id long, day timestamp_ntz")
    cursor = Cursor(f"file://{tmp_path}/cursor", "day")
    ids = lambda rows: sorted(r.id for r in rows.collect())
    assert ids(cursor.rows(df)) == list(range(9))
    cursor.advance(df.filter("id <= 4"))
    assert ids(Cursor(cursor.path, "day").rows(df)) == list(range(3, 9))  # from the day on
    cursor.advance(df.filter("id <= 1"))
    cursor.advance(df.limit(0))
    assert ids(cursor.rows(df)) == list(range(3, 9))
    cursor.drop(spark)
    assert ids(cursor.rows(df)) == list(range(9))


def test_every_entity_of_a_source_from_its_database_to_exports(spark, tmp_path):
    url, folder = h.embedded_database(spark), f"file://{tmp_path}/in"
    for n, e in enumerate(entities("RFAM")):
        rows = [(f"k{i}", f"v{i}", dt.datetime(2024, 1, 1)) for i in range(n + 1)]
        spark.createDataFrame(rows, f"{e.key} string, v string, updated timestamp_ntz").write.format("jdbc").options(url=url, dbtable=e.name, createTableColumnTypes=f"{e.key} VARCHAR(20), v VARCHAR(20)").save()
    paths = extract_source(spark, url, "RFAM", folder, dt.datetime(2024, 2, 1, 12), preferTimestampNTZ="true")
    assert sorted(paths) == sorted(e.name for e in entities("RFAM"))
    globs = {e: f"{folder}/{e.name}/{e.name}_*.json*" for e in entities("RFAM")}
    appended, broken = daily(spark, globs, f"file://{tmp_path}/silver", f"file://{tmp_path}/gold", now())
    assert appended == {e.name: n + 1 for n, e in enumerate(entities("RFAM"))} and broken.collect() == []
