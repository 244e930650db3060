"""Change data capture: a history of extractions becomes an append-only log of inserts, updates and deletes.

Bronze rows have the entity's columns, src_file and source_code; `files` is a timeline (sources.extractions.timeline). Keys
must be non-null and unique in an extraction (see operators.quality). A change row adds row_hash, first_seen, src_file,
valid_from, loaded_at and op (I, U or D) and is unique by key and valid_from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import row_hash
from tidemark.operators.relational import latest

OWN = ("src_file", "row_hash", "first_seen", "valid_from", "loaded_at", "op", "deleted")
#: Stands for the name of an extraction in the rows of a state.
BEFORE = ""


def first_seen(key: list[str], date_col: str | None) -> Column:
    """Earliest source date of a key over the whole history, or earliest extraction time if the source has no date."""
    return F.min(seen_at(date_col)).over(Window.partitionBy(*key))


def seen_at(date_col: str | None) -> Column:
    return F.col(date_col or "valid_from").cast("timestamp_ntz")


def placed(bronze: DataFrame, files: DataFrame, key: list[str], date_col: str | None, exclude: tuple[str, ...], before: DataFrame | None, distinct: bool = False) -> DataFrame:
    """Bronze dealt out by key, with its extraction's place in the timeline (which has a row an extraction and is broadcast), its hash and
    the date at which it was seen; with `before`, the state of the keys at the extraction before the first of `files`, at ordinal 0.

    The rows are shuffled first, as narrow as they come: the place and the hash, which doesn't compress, are added after it. The hash is
    taken of both in one, over the columns of either, so that a column that only new rows have counts as null in old ones.
    distinct: exact repeats within an extraction are left out, after the same shuffle.
    """
    rows, held = bronze, F.col("ordinal") == 0
    files = files.select("src_file", "valid_from", "next_file", "next_from", "ordinal", "last_ordinal")
    seen, present = seen_at(date_col), F.lit(True)
    if before is not None:
        state = before.withColumnsRenamed({"first_seen": "_seen", "present": "_present"}).withColumn("src_file", F.lit(BEFORE))
        rows = bronze.unionByName(state, allowMissingColumns=True)
        first = files.filter("ordinal = 1").select(F.lit(BEFORE).alias("src_file"), F.lit(None).cast("timestamp_ntz").alias("valid_from"), F.col("src_file").alias("next_file"), F.col("valid_from").alias("next_from"), F.lit(0).alias("ordinal"), "last_ordinal")
        files = files.unionByName(first)
        seen, present = F.when(held, F.col("_seen")).otherwise(seen), F.when(held, F.col("_present")).otherwise(present)
    rows = rows.repartition(*key).join(F.broadcast(files), "src_file").withColumns({"_seen": seen, "_present": present, "src_file": F.when(~held, F.col("src_file"))})
    data = [c for c in rows.columns if c in bronze.columns or (before is not None and c in before.columns)]
    if distinct:  # sorted by key and ordinal first, as what looks at a key's rows needs them
        copies = Window.partitionBy(*key, "ordinal", *[c for c in data if c not in key and c != "src_file"]).orderBy("ordinal")
        rows = rows.withColumn("_copy", F.row_number().over(copies)).filter("_copy = 1").drop("_copy")
    return rows.withColumn("row_hash", row_hash(rows.select(data), key, (*OWN, *exclude)))


def change_columns(columns: list[str]) -> list[str]:
    """What a change log's rows have, in order, of bronze rows with these columns."""
    return [c for c in columns if c not in OWN] + ["row_hash", "first_seen", "src_file", "valid_from", "loaded_at", "op"]


def over_key(key: list[str]) -> dict[str, Column]:
    """What a row sees of its key's rows, all in one order and so in one window: the earliest date, the row before and the next."""
    w = Window.partitionBy(*key).orderBy("ordinal")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return {
        "first_seen": F.min("_seen").over(whole), "_before": F.lag("ordinal").over(w), "_there": F.lag("_present").over(w), "_hash": F.lag("row_hash").over(w), "_after": F.lead("ordinal").over(w),
    }


def snapshot_changes() -> list[Column]:
    """The change that a row of complete extractions is, and the deletion that follows it, each null if there is none."""
    there = F.coalesce((F.col("_before") == F.col("ordinal") - 1) & F.col("_there"), F.lit(False))
    kind = F.when(F.col("ordinal") == 0, None).when(~there, "I").when(F.col("row_hash") != F.col("_hash"), "U")
    gone = F.col("_present") & (F.col("ordinal") < F.col("last_ordinal")) & (F.col("_after").isNull() | (F.col("_after") > F.col("ordinal") + 1))
    delete = F.when(gone, F.struct(F.lit("D").alias("op"), F.col("next_file").alias("src_file"), F.col("next_from").alias("valid_from")))
    return [own_change(kind), delete]


def delta_changes() -> list[Column]:
    """The change that a row of extractions of changed rows is, null if it is none."""
    return [own_change(F.when(F.col("ordinal") == 0, None).when(F.col("_hash").isNull(), "I").when(F.col("row_hash") != F.col("_hash"), "U"))]


def own_change(kind: Column) -> Column:
    return F.when(kind.isNotNull(), F.struct(kind.alias("op"), F.col("src_file").alias("src_file"), F.col("valid_from").alias("valid_from")))


def exploded(seen: DataFrame, changes: list[Column]) -> DataFrame:
    """A row for each change of a row, without a second pass over the rows."""
    found = seen.withColumn("_change", F.explode(F.array_compact(F.array(*changes)))).drop("src_file", "valid_from")
    return found.select("*", "_change.*")


def cdc_full_snapshot(bronze: DataFrame, files: DataFrame, key: list[str], loaded_at: Column, date_col: str | None = None, exclude: tuple[str, ...] = (), before: DataFrame | None = None) -> DataFrame:
    """Changes of complete extractions, with one shuffle by key and one sort: each row looks at the key's row before and after it.

    A row is an insert if the key isn't in the extraction before, an update if its hash differs there; a key that is not in
    the next extraction is deleted there, with its last values. A key that returns is inserted again. `files` must come from
    the folder listing: an empty extraction deletes every key.

    before: the keys' state (cdc_run) at the extraction before the first of `files`; older extractions aren't needed then.
    """
    seen = placed(bronze, files, key, date_col, exclude, before).withColumns(over_key(key))
    return exploded(seen, snapshot_changes()).withColumn("loaded_at", loaded_at).select(change_columns(data_columns(bronze, before)))


def data_columns(bronze: DataFrame, before: DataFrame | None) -> list[str]:
    """The columns of new rows, then those that only the state has."""
    return bronze.columns + [c for c in (before.columns if before is not None else []) if c not in bronze.columns and c not in ("first_seen", "present")]


def cdc_delta(bronze: DataFrame, files: DataFrame, key: list[str], loaded_at: Column, date_col: str | None = None, exclude: tuple[str, ...] = (), before: DataFrame | None = None) -> DataFrame:
    """Changes of extractions that hold changed rows only: a key's first row is an insert, one whose hash differs from the
    key's last is an update, others are dropped. Deletes can't be seen. A key that was deleted by a refresh and returns with
    unchanged values gives no row. before: as in cdc_full_snapshot."""
    seen = placed(bronze, files, key, date_col, exclude, before).withColumns(over_key(key))
    return exploded(seen, delta_changes()).withColumn("loaded_at", loaded_at).select(change_columns(data_columns(bronze, before)))


def cdc_run(bronze: DataFrame, files: DataFrame, key: list[str], loaded_at: Column, date_col: str | None = None, exclude: tuple[str, ...] = (), before: DataFrame | None = None, delta: bool = False) -> DataFrame:
    """Changes (of cdc_delta or cdc_full_snapshot) and the keys' state at the extraction before the newest, from one shuffle and one sort.

    Bronze may hold exact repeats. Rows of the state have no op and no valid_from: one a key ever seen up to that extraction, with its
    last values, the src_file they are of, first_seen so far, and whether that extraction has the key (present; of no meaning for
    extractions of changed rows only). They are what the next changes need of all extractions so far. With one extraction there is no
    state but what `before` has.
    """
    cols = data_columns(bronze, before)
    so_far = F.min("_seen").over(Window.partitionBy(*key).orderBy("ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = placed(bronze, files, key, date_col, exclude, before, True).withColumns({**over_key(key), "_so_far": so_far})
    last = (F.col("ordinal") < F.col("last_ordinal")) & (F.col("_after").isNull() | (F.col("_after") == F.col("last_ordinal")))
    none = F.lit(None)
    state = F.when(last, F.struct(none.cast("string").alias("op"), F.col("src_file").alias("src_file"), none.cast("timestamp_ntz").alias("valid_from")))
    rows = exploded(seen, [*(delta_changes() if delta else snapshot_changes()), state])
    change = F.col("op").isNotNull()
    return rows.withColumns({
        "row_hash": F.when(change, F.col("row_hash")), "first_seen": F.when(change, F.col("first_seen")).otherwise(F.col("_so_far")), "loaded_at": loaded_at,
        "present": F.when(~change, F.col("ordinal") == F.col("last_ordinal") - 1),
    }).select(*change_columns(cols), "present")


def cdc_delta_full_refresh(bronze: DataFrame, files: DataFrame, stored: DataFrame, latest_rows: DataFrame, key: list[str], loaded_at: Column, date_col: str | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """A rebuild from delta extractions: their changes, the deletes already known, and a delete for every stored key that the
    latest extraction (complete, on a refresh) lacks, stamped with that extraction.

    stored: the change log before the rebuild; write the result elsewhere or stage it before stored is replaced.
    """
    current = latest(stored, ["source_code", *key], ["valid_from"])
    last = files.orderBy(F.desc("src_file")).limit(1).select(F.col("src_file").alias("_file"), F.col("valid_from").alias("_from"))
    gone = current.filter("op <> 'D'").join(latest_rows.select(key).distinct(), key, "left_anti")
    # one row, from a list with a row an extraction
    gone = gone.join(F.broadcast(last)).withColumns({"src_file": F.col("_file"), "valid_from": F.col("_from"), "loaded_at": loaded_at, "op": F.lit("D")})
    changes = cdc_delta(bronze, files, key, loaded_at, date_col, exclude)
    cols = changes.columns
    return changes.unionByName(current.filter("op = 'D'").select(cols)).unionByName(gone.select(cols))


def bookmark(files: DataFrame, loaded_at: Column) -> DataFrame:
    """State after a run: one row with the newest extraction and the one before it; none if there is no extraction."""
    return files.orderBy(F.desc("src_file")).limit(1).select("src_file", "valid_from", "previous_file", "previous_from", loaded_at.alias("loaded_at"))


def since_bookmark(changes: DataFrame, previous_file: str | None) -> DataFrame:
    """Changes from the bookmark's previous extraction on, that one included; all of them without a bookmark."""
    return changes if previous_file is None else changes.filter(F.col("src_file") >= previous_file)


def idempotent_append(changes: DataFrame, stored: DataFrame, key: list[str], previous_file: str | None) -> DataFrame:
    """What an incremental run appends: changes since the bookmark whose (key, valid_from) isn't stored. A replay gives none,
    so appending first and moving the bookmark after survives a crash in between."""
    on = [*key, "valid_from"]
    return since_bookmark(changes, previous_file).join(stored.select(on), on, "left_anti").select(changes.columns)


def current_version(stored: DataFrame, key: list[str]) -> DataFrame:
    """The latest row of every key, deleted ones included."""
    return latest(stored, ["source_code", *key], ["valid_from"])


def active_version(stored: DataFrame, key: list[str]) -> DataFrame:
    """The latest row of every key that isn't deleted; deletes are dropped after the latest is picked."""
    return current_version(stored, key).filter("op <> 'D'")


def snapshot_diff(staging: DataFrame, current: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Insert, Change or Delete for every key on which staging and the current, undeleted rows differ, by one full outer join.

    Both sides have row_hash. A deleted key keeps its current values. No row number is added: numbering all rows in order
    takes a single task; use monotonically_increasing_id where an id is needed.
    """
    s, c = staging.select(key, *columns, "row_hash").alias("s"), current.select(key, *columns, "row_hash").alias("c")
    both = s.join(c, F.col(f"s.{key}") == F.col(f"c.{key}"), "full_outer")
    gone, new = F.col(f"s.{key}").isNull(), F.col(f"c.{key}").isNull()
    op = F.when(gone, "Delete").when(new, "Insert").when(F.col("s.row_hash") != F.col("c.row_hash"), "Change").otherwise("No Change")
    values = [F.when(gone, F.col(f"c.{x}")).otherwise(F.col(f"s.{x}")).alias(x) for x in (key, *columns, "row_hash")]
    return both.select(*values, op.alias("op")).filter("op <> 'No Change'")
