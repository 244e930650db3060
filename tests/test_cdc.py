import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import row_hash
from tidemark.operators import cdc
from tidemark.sources import extractions, sinks

def now():
    return F.lit("2024-06-15 06:00:00").cast("timestamp_ntz")

SCHEMA = "id long, name string, value long, opdateringsdato timestamp_ntz"
FILES = {
    "thing_20240101_120000.json": [(1, "Alpha", 10), (2, "Beta", 20)],
    "thing_20240201_120000.json": [(1, "Alpha-v2", 11), (2, "Beta", 20)],
    "thing_20240301_120000.json": [(2, "Beta", 20)],
}


def land(folder, files):
    for name, rows in files.items():
        day = f"{name[6:10]}-{name[10:12]}-01T00:00:00"
        (folder / name).write_text("".join(json.dumps({"id": i, "name": n, "value": v, "opdateringsdato": day, "_dlt_load_id": "x"}) + "\n" for i, n, v in rows))
    return f"{folder}/thing_*.json*"


def changes_of(spark, path, **more):
    rows = extractions.read_extractions(spark, path, "DDD", SCHEMA)
    return cdc.cdc_full_snapshot(rows, extractions.list_extractions(spark, path), ["id"], now(), "opdateringsdato", ("opdateringsdato", "source_code"))


def ops(df):
    return sorted((r.id, r.op, r.src_file[6:14]) for r in df.collect())


def test_three_file_life_cycle(spark, tmp_path):
    log = changes_of(spark, land(tmp_path, FILES))
    assert ops(log) == [(1, "D", "20240301"), (1, "I", "20240101"), (1, "U", "20240201"), (2, "I", "20240101")]
    gone = log.filter("op = 'D'").first()
    assert (gone.name, gone.value, gone.valid_from, gone.first_seen) == ("Alpha-v2", 11, dt.datetime(2024, 3, 1, 12), dt.datetime(2024, 1, 1))
    assert all(len(r.row_hash) == 64 for r in log.collect())
    assert sorted((r.id, r.op) for r in cdc.current_version(log, ["id"]).collect()) == [(1, "D"), (2, "I")]
    assert [r.id for r in cdc.active_version(log, ["id"]).collect()] == [2]


def test_replay_appends_nothing_and_a_new_file_only_its_changes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path, out = land(tmp_path / "in", FILES), str(tmp_path / "silver")
    assert sinks.append_new_versions(changes_of(spark, path), out, ["id"]) == 4
    stored = spark.read.parquet(out)
    mark = cdc.bookmark(extractions.list_extractions(spark, path), now()).first()
    assert (mark.src_file, mark.previous_file) == ("thing_20240301_120000.json", "thing_20240201_120000.json")
    assert cdc.idempotent_append(changes_of(spark, path), stored, ["id"], mark.previous_file).count() == 0
    land(tmp_path / "in", {"thing_20240401_120000.json": [(2, "Beta", 20), (4, "Delta", 1)]})
    assert ops(cdc.idempotent_append(changes_of(spark, path), stored, ["id"], mark.previous_file)) == [(4, "I", "20240401")]
    assert sinks.append_new_versions(changes_of(spark, path), out, ["id"]) == 1
    assert sinks.append_new_versions(changes_of(spark, path), out, ["id"]) == 0


def test_empty_extraction_deletes_every_key_and_returning_keys_are_inserted(spark, tmp_path):
    files = {"thing_20240101_120000.json": [(1, None, 1)], "thing_20240201_120000.json": [], "thing_20240301_120000.json": [(1, None, 1)]}
    assert ops(changes_of(spark, land(tmp_path, files))) == [(1, "D", "20240201"), (1, "I", "20240101"), (1, "I", "20240301")]


def test_new_column_and_loader_columns(spark, tmp_path):
    (tmp_path / "w_20240101_120000.json").write_text('{"id": 1, "_dlt_load_id": "a"}\n{"id": 1, "_dlt_load_id": "a"}\n')
    (tmp_path / "w_20240201_120000.json").write_text('{"id": 1, "colour": "red"}\n')
    rows = extractions.read_extractions(spark, f"{tmp_path}/w_*.json*", "DDD")
    assert sorted(rows.columns) == ["colour", "id", "source_code", "src_file"]
    assert rows.count() == 2
    newest = extractions.read_latest_extraction(spark, f"{tmp_path}/w_*.json*", "DDD")
    assert [(r.id, r.colour, r.deleted) for r in newest.collect()] == [(1, "red", "N")]
    both = sinks.append_evolving(rows.select("id"), rows.select("id", "colour"))
    assert both.columns == ["id", "colour"] and both.count() == 4


def by_hand(history):
    """Changes of complete snapshots, key by key, in plain Python."""
    out, names = [], sorted(history)
    for n, name in enumerate(names):
        now, before = dict(history[name]), dict(history[names[n - 1]]) if n else {}
        out += [(k, "I" if k not in before else "U", name) for k, v in now.items() if before.get(k, object()) != v]
        out += [(k, "D", name) for k in before if k not in now]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_random_histories_batch_and_step_by_step(spark, seed):
    rng = random.Random(seed)
    history = {f"t_2024{m:02d}01_120000.json": [(k, rng.choice("abc")) for k in range(12) if rng.random() < 0.7] for m in range(1, 7)}
    rows = spark.createDataFrame([(k, v, f, "S") for f, part in history.items() for k, v in part], "id long, name string, src_file string, source_code string")
    every = spark.createDataFrame([(f,) for f in history], "src_file string")
    log = cdc.cdc_full_snapshot(rows, extractions.timeline(every), ["id"], now())
    assert sorted((r.id, r.op, r.src_file) for r in log.collect()) == by_hand(history)
    stored = None
    for f in sorted(history):  # one extraction after another, as daily runs do
        files = extractions.timeline(every.filter(F.col("src_file") <= f))
        seen = cdc.cdc_full_snapshot(rows.filter(F.col("src_file") <= f), files, ["id"], now())
        new = seen if stored is None else cdc.idempotent_append(seen, stored, ["id"], cdc.bookmark(files, now()).first().previous_file)
        held = [tuple(r) for r in new.collect()]
        more = spark.createDataFrame(held, log.schema)
        stored = more if stored is None else stored.union(more)
    assert sorted((r.id, r.op, r.src_file) for r in stored.collect()) == by_hand(history)


def test_delta_and_full_refresh(spark):
    files = ["t_20240101_120000.json", "t_20240201_120000.json", "t_20240301_120000.json"]
    data = [(1, "a", files[0]), (2, "b", files[0]), (1, "a", files[1]), (2, "c", files[1]), (3, "d", files[2])]
    rows = spark.createDataFrame([(*r, "S") for r in data], "id long, name string, src_file string, source_code string")
    line = extractions.timeline(spark.createDataFrame([(f,) for f in files], "src_file string"))
    log = cdc.cdc_delta(rows, line, ["id"], now())
    assert sorted((r.id, r.op, r.src_file) for r in log.collect()) == [(1, "I", files[0]), (2, "I", files[0]), (2, "U", files[1]), (3, "I", files[2])]
    old = log.filter("id < 3").withColumn("op", F.when((F.col("id") == 1), "D").otherwise(F.col("op")))
    full = cdc.cdc_delta_full_refresh(rows, line, old, spark.createDataFrame([(3,)], "id long"), ["id"], now())
    assert sorted((r.id, r.op, r.src_file) for r in full.collect() if r.op == "D") == [(1, "D", files[0]), (2, "D", files[2])]


def test_row_hash_tells_null_from_text_and_skips_the_key(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "<NULL>", "x"), (3, "", "x")], "id long, a string, b string")
    got = [r[0] for r in df.select(row_hash(df, ["id"])).collect()]
    assert len(set(got)) == 2  # the stand-in text itself is the one text that equals null
    assert got[0] == got[1] != got[2]


def test_latest_thins_rows_before_the_shuffle_and_breaks_ties_by_value(spark, tmp_path):
    from tidemark.operators.relational import latest

    spark.createDataFrame([(i % 5, i % 7, f"v{i}", {"k": i}) for i in range(200)], "k int, o int, v string, m map<string,int>").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = latest(df, ["k"], ["o"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    rows = [(i % 5, i % 7, f"v{i}") for i in range(200)]
    assert sorted((r.k, r.o, r.v) for r in out.collect()) == sorted(max(r for r in rows if r[0] == k) for k in range(5))


def shuffles(df):
    """Exchanges of the plan before it runs: (number, plan)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_changes_are_shuffled_once_without_their_hash_and_stay_where_they_are(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    path = land(tmp_path, FILES)
    rows = spark.read.schema(SCHEMA).json(path).select("*", F.lit("thing_20240101_120000.json").alias("src_file"), F.lit("DDD").alias("source_code"))
    log = cdc.cdc_full_snapshot(rows, extractions.list_extractions(spark, path), ["id"], now(), "opdateringsdato")
    number, plan = shuffles(log)
    assert number == 1 and "sha2(" in plan and "sha2(" not in plan[plan.index("Exchange hashpartitioning") :]
    log.limit(0).write.parquet(f"{tmp_path}/stored")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # one shuffle of the rows, one of the stored keys
        assert shuffles(sinks.new_versions(log, spark.read.parquet(f"{tmp_path}/stored"), ["id"]))[0] == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_new_versions_meet_by_key_and_time_and_keep_nulls(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 2, 1)), (None, dt.datetime(2024, 1, 1)), (2, None)], "id long, valid_from timestamp_ntz").withColumn("p", F.lit("a"))
    stored = spark.createDataFrame([(1, dt.datetime(2024, 2, 1)), (None, dt.datetime(2024, 1, 1))], "id long, valid_from timestamp_ntz").withColumn("p", F.lit("a"))
    left = {(1, dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 1, 1)), (2, None)}
    assert {(r.id, r.valid_from) for r in sinks.new_versions(df, stored, ["id"]).collect()} == left
    assert {(r.id, r.valid_from) for r in sinks.new_parts(df, stored, ["id"], "p").collect()} == left
    assert sinks.new_parts(df, stored.withColumn("p", F.lit("b")), ["id"], "p").count() == 4
    assert sinks.new_parts(df.filter("valid_from = timestamp_ntz '2024-02-01'"), stored, ["id"], "p").count() == 0


def test_extractions_are_landed_compressed(spark, tmp_path):
    path = sinks.land_snapshot(spark.range(9), str(tmp_path), "e", dt.datetime(2024, 1, 1))
    assert spark.read.json(path).count() == 9 and all(f.endswith(".gz") for f in spark.read.json(path).inputFiles())


@pytest.mark.parametrize("delta", [False, True])
def test_changes_and_state_come_from_one_shuffle_with_repeats_left_out(spark, delta):
    files = ["t_20240101_120000.json", "t_20240201_120000.json", "t_20240301_120000.json"]
    data = [(1, "a", files[0]), (1, "a", files[0]), (2, "b", files[0]), (1, "c", files[1]), (3, "d", files[2]), (3, "d", files[2])]
    rows = spark.createDataFrame([(*r, "S") for r in data], "id long, name string, src_file string, source_code string")
    line = extractions.timeline(spark.createDataFrame([(f,) for f in files], "src_file string"))
    out = cdc.cdc_run(rows, line, ["id"], now(), delta=delta)
    assert shuffles(out)[0] == 1
    find = cdc.cdc_delta if delta else cdc.cdc_full_snapshot
    changes = out.filter("op is not null").drop("present")
    assert sorted(map(str, changes.collect())) == sorted(map(str, find(rows.dropDuplicates(), line, ["id"], now()).collect()))
    assert sorted((r.id, r.name, r.src_file, r.present) for r in out.filter("op is null").collect()) == [(1, "c", files[1], True), (2, "b", files[0], False)]
