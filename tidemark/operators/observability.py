"""The mart over pipeline event logs: runs, jobs, assets, materialisations, failures.

Events: id, run_id, asset_key (JSON text of a path), step_key, partition, ts, kind, event (JSON text). Runs: run_id,
pipeline_name, status, created_at, start_time, end_time (epoch seconds). Paths inside the JSON are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import hhmm_key

PLANNED, DONE, FAILED, RUN_FAILED, SKIPPED = "PLANNED", "MATERIALIZATION", "STEP_FAILURE", "RUN_FAILURE", "STEP_SKIPPED"
#: Labels of metadata entries that become columns.
LABELS = {
    "records_written": "records_written_raw", "destination_file": "destination_file", "destination_path": "destination_path", "duration_seconds": "duration_seconds_raw", "pipeline_status": "ingestion_status",
    "rows_written": "rows_written_raw", "table": "export_table", "Execution Duration": "execution_duration_raw", "unique_id": "unique_id", "invocation_id": "invocation_id",
}


def pipeline_runs(runs: DataFrame) -> DataFrame:
    """Runs with times instead of epochs and the duration to a tenth of a second, null while a run goes on."""
    at = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return runs.select("run_id", F.col("pipeline_name").alias("job_name"), F.col("status").alias("run_status"), "created_at", at("start_time").alias("started_at"), at("end_time").alias("ended_at"), F.round((F.col("end_time") - F.col("start_time")).cast("double"), 1).alias("duration_seconds"))


def path_columns(path: Column) -> dict[str, Column]:
    """First, second and last element of an asset's path and all of it; null where the path is shorter."""
    return {"asset_group": F.try_element_at(path, F.lit(1)), "asset_layer": F.try_element_at(path, F.lit(2)), "asset_name": F.try_element_at(path, F.lit(-1)), "asset_full": F.array_join(path, "/")}


def event_flatten(events: DataFrame, name: str = "$.pipeline_name", path: str = "$.materialization.asset_key.path", entries: str = "$.materialization.metadata_entries") -> DataFrame:
    """One row a materialisation event: its asset path and the labelled metadata entries as columns.

    An entry's value is its text, else its value. Events without entries stay. Numbers that can't be read are null. Events
    that agree in run, time, step, job and path are one.
    """
    entry = "array<struct<label:string,entry_data:struct<text:string,value:string>>>"
    raw = events.filter(F.col("kind") == DONE)
    parsed = raw.select("run_id", F.col("ts").alias("event_ts"), "step_key", F.get_json_object("event", name).alias("pipeline_name"), F.from_json(F.get_json_object("event", path), "array<string>").alias("_path"), F.from_json(F.get_json_object("event", entries), entry).alias("_entries"))
    keyed = parsed.withColumns(path_columns(F.col("_path")))
    one = keyed.withColumn("_e", F.explode_outer("_entries"))
    value = F.coalesce("_e.entry_data.text", "_e.entry_data.value")
    keys = ["run_id", "event_ts", "step_key", "pipeline_name", "asset_group", "asset_layer", "asset_name", "asset_full"]
    wide = one.groupBy(*keys).agg(*[F.max(F.when(F.col("_e.label") == label, value)).alias(c) for label, c in LABELS.items()])
    number = lambda c, t: F.col(c).try_cast(t)
    return wide.select(
        *keys, number("records_written_raw", "bigint").alias("records_written"), "destination_file", "destination_path", number("duration_seconds_raw", "double").alias("ingestion_duration_seconds"), "ingestion_status",
        number("rows_written_raw", "bigint").alias("rows_written"), "export_table", number("duration_seconds_raw", "double").alias("export_duration_seconds"), number("execution_duration_raw", "double").alias("execution_duration_seconds"), "unique_id", "invocation_id",
    )


def job_dim(runs: DataFrame, key) -> DataFrame:
    return runs.filter("job_name is not null").select("job_name").distinct().select(key(F.col("job_name")).alias("job_key"), "job_name")


def asset_dim(events: DataFrame, key) -> DataFrame:
    """One row an asset key ever materialised, with its path taken apart."""
    assets = events.filter((F.col("kind") == DONE) & F.col("asset_key").isNotNull()).select("asset_key").distinct()
    path = F.from_json("asset_key", "array<string>")
    return assets.select(key(F.col("asset_key")).alias("asset_sk"), "asset_key", *[c.alias(n) for n, c in path_columns(path).items()])


def run_fact(runs: DataFrame, flat: DataFrame, key) -> DataFrame:
    """Runs with keys of their job, dates and times, and the rows and assets they materialised."""
    stats = flat.groupBy("run_id").agg(F.sum(F.coalesce("records_written", "rows_written", F.lit(0))).cast("long").alias("rows_processed"), F.count("*").alias("assets_materialized"))
    zero = F.lit(0).cast("long")
    return runs.join(stats, "run_id", "left").select(
        key(F.col("run_id")).alias("run_sk"), key(F.col("job_name")).alias("job_sk"), F.to_date("started_at").alias("start_date_sk"), hhmm_key("started_at").alias("start_time_sk"), F.to_date("ended_at").alias("end_date_sk"), hhmm_key("ended_at").alias("end_time_sk"),
        "run_id", F.col("run_status").alias("status"), "created_at", "started_at", "ended_at", "duration_seconds", F.coalesce("rows_processed", zero).alias("rows_processed"), F.coalesce("assets_materialized", zero).alias("assets_materialized"),
    )


def paired(events: DataFrame, message: str = "$.user_message") -> DataFrame:
    """Materialisations with planned_at and run_error_message, by one exchange of the events by run.

    planned_at: the last plan of the same run, step and asset up to the materialisation, else the first one after it; null
    where a part of that triple is null. run_error_message: of the run's last failure. A second plan or failure repeats no row.
    """
    some = events.filter(F.col("kind").isin(PLANNED, DONE, RUN_FAILED)).select(
        "id", "run_id", "step_key", "asset_key", "ts", "kind", "partition", F.when(F.col("kind") == DONE, F.col("event")).alias("event"), F.when(F.col("kind") == RUN_FAILED, F.get_json_object("event", message)).alias("_message")
    )
    # by run first: what is dealt out by run is also dealt out by run, step and asset
    in_run = Window.partitionBy("run_id").orderBy(F.col("_message").isNull().desc(), "ts", "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = Window.partitionBy("run_id", "step_key", "asset_key").orderBy("ts")
    plan = F.when(F.col("kind") == PLANNED, F.col("ts"))
    planned = F.coalesce(F.max(plan).over(same.rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.min(plan).over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    told = some.withColumn("run_error_message", F.when(F.col("run_id").isNotNull(), F.last("_message").over(in_run)))
    whole = F.col("run_id").isNotNull() & F.col("step_key").isNotNull() & F.col("asset_key").isNotNull()
    return told.withColumn("planned_at", F.when(whole, planned)).filter(F.col("kind") == DONE).drop("_message", "kind")


def materialization_fact(events: DataFrame, runs: DataFrame, key, name: str = "$.pipeline_name", rows: tuple[str, ...] = ("$.materialization.metadata['row_count'].value", "$.materialization.metadata_entries[0].entry_data.value"), message: str = "$.user_message") -> DataFrame:
    """One row a materialisation: the plan it answers (by run, step and asset, so that a step's assets don't multiply), its
    duration, the first row count that can be read, and the run's outcome. The events are exchanged once, by run; see paired."""
    all_ = paired(events, message).join(runs.select("run_id", "run_status"), "run_id", "left")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return all_.select(
        key(F.col("asset_key")).alias("asset_sk"), key(F.col("run_id")).alias("run_sk"), key(F.get_json_object("event", name)).alias("job_sk"), F.to_date("planned_at").alias("start_date_sk"), hhmm_key("planned_at").alias("start_time_sk"),
        F.to_date("ts").alias("end_date_sk"), hhmm_key("ts").alias("end_time_sk"), F.col("id").alias("materialization_id"), "run_id", "asset_key", "step_key", F.col("partition").alias("partition_key"), F.col("planned_at").alias("step_planned_at"), F.col("ts").alias("materialized_at"),
        F.round((micros("ts") - micros("planned_at")) / 1e6, 1).alias("duration_seconds"), F.coalesce(*[F.get_json_object("event", p).try_cast("bigint") for p in rows]).alias("rows_processed"), "run_status", "run_error_message",
    )


def step_failures(events: DataFrame, runs: DataFrame, key, error_class: str = "$.error.cls_name", message: str = "$.error.message") -> DataFrame:
    """One row a failed step and asset that was planned for it (a null asset if none was). Failures and plans are exchanged once, by
    run and step."""
    some = events.filter((F.col("kind") == FAILED) | ((F.col("kind") == PLANNED) & F.col("asset_key").isNotNull()))
    slim = some.select("run_id", "step_key", "kind", F.col("ts").alias("failed_at"), F.when(F.col("kind") == PLANNED, F.col("asset_key")).alias("_plan"), F.when(F.col("kind") == FAILED, F.col("event")).alias("event"))
    assets = F.when(F.col("run_id").isNotNull() & F.col("step_key").isNotNull(), F.collect_set("_plan").over(Window.partitionBy("run_id", "step_key")))
    failed = slim.withColumn("_assets", assets).filter(F.col("kind") == FAILED).select(
        "run_id", "step_key", "failed_at", F.get_json_object("event", error_class).alias("error_class"), F.get_json_object("event", message).alias("error_message"), F.explode_outer(F.when(F.size("_assets") > 0, F.array_sort("_assets"))).alias("asset_key")
    )
    all_ = failed.join(runs.select("run_id", "job_name"), "run_id", "left")
    return all_.select(key(F.concat("run_id", "step_key")).alias("failure_sk"), key(F.col("asset_key")).alias("asset_sk"), key(F.col("run_id")).alias("run_sk"), key(F.col("job_name")).alias("job_sk"), F.to_date("failed_at").alias("date_sk"), hhmm_key("failed_at").alias("time_sk"), "run_id", "step_key", "asset_key", "error_class", "error_message", "failed_at")


def asset_durations(facts: DataFrame) -> DataFrame:
    """The assets of every run by their slowest materialisation, slowest first (a null duration last, ties by name)."""
    slowest = facts.groupBy("run_id", "asset_key").agg(F.max("duration_seconds").alias("slowest_seconds"), F.count("*").alias("n_materialized"))
    by_time = Window.partitionBy("run_id").orderBy(F.desc_nulls_last("slowest_seconds"), "asset_key")
    return slowest.withColumn("place", F.row_number().over(by_time))


def layer_rows(facts: DataFrame, runs: DataFrame, last: int, layer: str = "$[1]") -> DataFrame:
    """Rows and materialisations of each layer over the last runs by their creation. layer: where an asset's key names it."""
    recent = runs.orderBy(F.desc_nulls_last("created_at"), "run_id").limit(last).select("run_id")
    some = facts.join(recent, "run_id").groupBy(F.get_json_object("asset_key", layer).alias("asset_layer"))
    return some.agg(F.coalesce(F.sum("rows_processed"), F.lit(0)).cast("long").alias("n_rows"), F.count("*").alias("n_materialized"), F.countDistinct("run_id").alias("n_runs"))


def unmet_assets(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs that materialised fewer assets than were planned for them: how many were planned and how many are missing."""
    def assets(kind: str) -> DataFrame:
        return events.filter((F.col("kind") == kind) & F.col("asset_key").isNotNull()).select("run_id", "asset_key").distinct()

    state = assets(PLANNED).join(assets(DONE).withColumn("done", F.lit(1)), ["run_id", "asset_key"], "left")
    short = state.groupBy("run_id").agg(F.count("*").alias("n_planned"), F.count("done").alias("n_done")).filter("n_done < n_planned")
    return short.join(runs.select("run_id", "run_status"), "run_id", "left").select("run_id", "run_status", "n_planned", (F.col("n_planned") - F.col("n_done")).alias("n_missing"))


def run_summary(events: DataFrame) -> DataFrame:
    """Steps of every run: how many, how many of them succeeded, failed and were skipped, and one struct a step (step_key, status,
    duration_seconds) in order of name.

    A step is FAILURE if it failed at any time, else SUCCESS if it materialised something, else SKIPPED if it was skipped, else
    unknown, which counts as none of the three. It lasts from its first event to its last success or failure, to a thousandth of a
    second; null while it hasn't ended. Failures of a whole run belong to no step.
    """
    step_events = events.filter(F.col("step_key").isNotNull() & (F.col("kind") != RUN_FAILED))
    had = lambda kind: F.max((F.col("kind") == kind).cast("int")) == 1
    ended = F.max(F.when(F.col("kind").isin(DONE, FAILED), F.col("ts")))
    status = F.when(had(FAILED), "FAILURE").when(had(DONE), "SUCCESS").when(had(SKIPPED), "SKIPPED").otherwise("unknown")
    step = step_events.groupBy("run_id", "step_key").agg(status.alias("status"), F.min("ts").alias("first"), ended.alias("last"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    one = F.struct("step_key", "status", F.round((micros("last") - micros("first")) / 1e6, 3).alias("duration_seconds"))
    count = lambda s: F.sum((F.col("status") == s).cast("long"))
    return step.groupBy("run_id").agg(F.count("*").alias("steps_total"), count("SUCCESS").alias("steps_succeeded"), count("FAILURE").alias("steps_failed"), count("SKIPPED").alias("steps_skipped"), F.sort_array(F.collect_list(one)).alias("steps"))
