"""Type-2 dimensions, their current views, and the calendar and time-of-day dimensions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import business_key, lenient_date, with_markup
from tidemark.operators.relational import latest

#: Bounds of validity, and key, name and source of the row that facts without a partner point to.
START, END = "1900-01-01 00:00:00", "9999-12-31 00:00:00"
UNKNOWN_KEY, UNKNOWN, UNKNOWN_SOURCE = 0, "Unknown", "SYS"


def stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def scd2_dimension(changes: DataFrame, key: str, attributes: dict[str, Column], surrogate, name: str) -> DataFrame:
    """Versions of every key of a change log: {name}_key, {name}_bk, the attributes, first_seen, valid_from, valid_to, version,
    source_code.

    A version ends where the next begins; the first one starts in 1900. Deletes are versions like others. Both windows share
    one partitioning, by source and key. surrogate: a function of one text column (functions.scalars), taken of the business
    key and the version's own start.
    """
    w = Window.partitionBy("source_code", key).orderBy("valid_from")
    version = F.row_number().over(w)
    bk = business_key("source_code", key)
    id_text = F.concat(bk, F.lit("|"), F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss"))
    return changes.select(
        surrogate(id_text).alias(f"{name}_key"), bk.alias(f"{name}_bk"), *[c.alias(n) for n, c in attributes.items()], "first_seen",
        F.when(version == 1, stamp(START)).otherwise(F.col("valid_from")).alias("valid_from"),
        F.lead("valid_from", 1, None).over(w).alias("_next"), version.cast("int").alias("version"), "source_code",
    ).select("*", F.coalesce("_next", stamp(END)).alias("valid_to")).drop("_next")


def with_unknown(dim: DataFrame, name: str, row: dict | None = None) -> DataFrame:
    """Adds the Unknown row: key 0, validity from 1900 to 9999, version 1, other columns null unless given."""
    values = {f"{name}_key": UNKNOWN_KEY, f"{name}_bk": UNKNOWN, "valid_from": stamp(START), "valid_to": stamp(END), "version": 1, "source_code": UNKNOWN_SOURCE} | (row or {})
    one = dim.sparkSession.range(1).select(*[(v if isinstance(v := values.get(f.name), Column) else F.lit(v)).cast(f.dataType).alias(f.name) for f in dim.schema])
    return dim.unionByName(one)


def current_dimension(dim: DataFrame, name: str) -> DataFrame:
    """The last version of every business key, without the columns of history."""
    return latest(dim, ["source_code", f"{name}_bk"], ["valid_from"]).drop("valid_from", "valid_to", "version")


def with_parent(child: DataFrame, parent: DataFrame, on: Column, columns: dict[str, str]) -> DataFrame:
    """The child with columns of its parent's current version; children without a parent stay, with nulls."""
    chosen = parent.select(*[F.col(k).alias(v) for k, v in columns.items()])
    return child.join(chosen, on, "left")


@dataclass(frozen=True)
class Parent:
    """The current version of a dimension that another one points to: its business key, the child's column with that key's id, the
    columns that the child takes over (name there: name here) and what they are in the child's Unknown row."""

    rows: DataFrame
    bk: str
    child: str
    columns: dict[str, str]
    unknown: dict[str, object] = field(default_factory=dict)


def child_dimension(changes: DataFrame, key: str, attributes: dict[str, Column], parents: list[Parent], surrogate, name: str, open_only: bool = False) -> DataFrame:
    """A type-2 dimension with keys and labels of any number of parents, and an Unknown row.

    open_only: versions that haven't ended, picked before the parents are joined; they keep their version number and start. Of a
    parent only its key and the columns taken over are moved; Spark broadcasts those that its size threshold allows.
    """
    links = {f"_link_{i}": business_key("source_code", p.child) for i, p in enumerate(parents)}
    dim = scd2_dimension(changes, key, attributes | links, surrogate, name)
    dim = open_versions(dim) if open_only else dim
    unknown: dict[str, object] = {}
    for i, p in enumerate(parents):
        dim = with_parent(dim, p.rows, F.col(f"_link_{i}") == F.col(f"_bk_{i}"), {p.bk: f"_bk_{i}", **p.columns}).drop(f"_link_{i}", f"_bk_{i}")
        unknown |= p.unknown
    return with_unknown(dim, name, unknown)


#: Tags of a person's biography and the columns they become, and English names of the sexes it states.
PERSON_TAGS = {"sex": "gender", "born": "birth_text", "died": "death_text", "party": "party_name", "partyShortname": "party_short_name"}
GENDERS = {"Mand": "Male", "Kvinde": "Female"}


def person_dimension(changes: DataFrame, types: Parent, surrogate, key: str = "id", biography: str = "biography", attributes: dict[str, Column] | None = None) -> DataFrame:
    """Persons with what their biography states in tags: gender (as stated, and in English where it is known, else as stated), birth_date
    and death_date (null where the text is no date), party_name and party_short_name; with their type and an Unknown row."""
    parsed = with_markup(changes, biography, PERSON_TAGS)
    english = F.col("gender")
    for stated, name in GENDERS.items():
        english = F.when(F.col("gender") == stated, name).otherwise(english)
    stated = {"biography": F.col(biography), "gender": F.col("gender"), "gender_english": english, "birth_date": lenient_date(F.col("birth_text")), "death_date": lenient_date(F.col("death_text")), "party_name": F.col("party_name"), "party_short_name": F.col("party_short_name")}
    return child_dimension(parsed, key, (attributes or {}) | stated, [types], surrogate, "person")


def open_versions(dim: DataFrame) -> DataFrame:
    """The versions that haven't ended."""
    return dim.filter(F.col("valid_to") == stamp(END))


def calendar(days: DataFrame, as_of: dt.date) -> DataFrame:
    """Columns of a calendar for every date_day of `days`: year, quarter, month and week with their bounds, day numbers,
    offsets to as_of and completed flags.

    Offsets count boundaries; a period is completed if its offset is negative. Weeks are ISO weeks. month_and_year_number is
    year * 100 + month.
    """
    d, now = F.col("date_day"), F.lit(as_of.isoformat()).cast("date")

    def week(x: Column) -> Column:  # number of the ISO week since a Monday
        return F.floor(F.datediff(x, F.lit("1900-01-01").cast("date")) / 7).cast("int")

    def index(unit: str, x: Column) -> Column:
        return {"year": F.year(x), "quarter": F.year(x) * 4 + F.quarter(x), "month": F.year(x) * 12 + F.month(x), "week": week(x)}[unit]

    out = days.select("*")
    iso_year = F.extract(F.lit("YEAROFWEEK"), d).cast("int")
    cols: dict[str, Column] = {"date_year": F.year(d), "iso_year": iso_year}
    step = {"year": 12, "quarter": 3, "month": 1}
    for unit in ("year", "quarter", "month", "week"):
        begin = F.trunc(d, unit)
        cols[f"{unit}_start_date"] = begin
        cols[f"{unit}_end_date"] = F.date_add(begin, 6) if unit == "week" else F.date_sub(F.add_months(begin, step[unit]), 1)
        cols[f"{unit}_day_number"] = (F.weekday(d) + 1 if unit == "week" else F.datediff(d, begin) + 1).cast("int")
        cols[f"{unit}_offset"] = (index(unit, d) - index(unit, now)).cast("int")
        cols[f"{unit}_completed"] = (index(unit, d) < index(unit, now)).cast("int")
    name = F.date_format(d, "MMMM")
    cols |= {
        "date_quarter": F.quarter(d), "date_month": F.month(d), "month_name": name, "month_name_short": F.left(name, F.lit(3)), "month_initial": F.left(name, F.lit(1)),
        "month_and_year": F.concat(name, F.lit(" "), F.year(d).cast("string")), "month_and_year_number": F.year(d) * 100 + F.month(d),
        "date_week": F.weekofyear(d), "iso_week_of_year": F.weekofyear(d), "iso_week_year_number": iso_year * 100 + F.weekofyear(d),
        "has_53_iso_weeks": (F.weekofyear(F.date_sub(F.add_months(F.trunc(d, "year"), 12), 1)) == 53).cast("int"),
        "is_after_today": (d > now).cast("int"), "is_before_today": (d < now).cast("int"),
        "is_weekend": (F.weekday(d) >= 5).cast("int"), "is_weekday": (F.weekday(d) < 5).cast("int"),
    }
    return out.withColumns(cols)


def with_holidays(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Adds the holiday of every date_day. Of several on a date the one whose type sorts last is taken.

    holidays: holiday_date, holiday_name, holiday_type, is_global_holiday, fixed; a calendar's worth, so it is broadcast.
    """
    one = latest(holidays.select("holiday_date", "holiday_type", "holiday_name", "is_global_holiday", "fixed"), ["holiday_date"], ["holiday_type", "holiday_name"])
    met = days.join(F.broadcast(one), days["date_day"] == one["holiday_date"], "left")
    none = "Not a holiday"
    return met.select(
        *days.columns, F.coalesce("holiday_name", F.lit(none)).alias("holiday_name"), F.col("holiday_date").isNotNull().alias("is_holiday"),
        F.coalesce("is_global_holiday", F.lit(False)).alias("is_global_holiday"), F.coalesce("holiday_type", F.lit(none)).alias("holiday_type"), F.coalesce("fixed", F.lit(False)).alias("fixed"),
    )


def spine(spark, first: dt.date, last: dt.date) -> DataFrame:
    """One row a day, both ends included."""
    return spark.range((last - first).days + 1).select(F.date_add(F.lit(first.isoformat()).cast("date"), F.col("id").cast("int")).alias("date_day"))


def time_of_day(minutes: DataFrame, minute: str) -> DataFrame:
    """Columns of the time dimension for a minute of the day."""
    m = F.col(minute)
    hhmm = F.concat(F.lpad(F.expr(f"{minute} div 60").cast("string"), 2, "0"), F.lit(":"), F.lpad((m % 60).cast("string"), 2, "0"))
    period = F.when(m.between(0, 359), "Night").when(m.between(360, 719), "Morning").when(m.between(720, 1079), "Afternoon").otherwise("Evening")
    hour = F.expr(f"{minute} div 60").cast("int")
    return minutes.withColumns({"time_key": (hour * 100 + m % 60).cast("int"), "time_hhmm": hhmm, "time_hhmi": hhmm, "time_hhmmss": F.concat(hhmm, F.lit(":00")), "hour": hour, "minute": (m % 60).cast("int"), "period_of_day": period})
