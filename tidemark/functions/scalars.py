"""Column helpers whose null, type and overflow rules differ between SQL dialects; each states the rule it keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

#: Fixed values of the row hash: what stands for a null and what closes every column's text.
NULL_TEXT, CLOSE = "<NULL>", "]##["
#: Parts of a parameter's name that make it sensitive.
SENSITIVE = ("connection_string", "secret", "password", "token")


def concat_skip_null(*cols: Column | str) -> Column:
    """Concatenation that skips nulls; empty if all are null."""
    return F.concat_ws("", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def business_key(source: Column | str, key: Column | str) -> Column:
    """source-key, skipping nulls."""
    return concat_skip_null(source, F.lit("-"), key)


def row_hash(df: DataFrame, key: list[str], exclude: tuple[str, ...] = ()) -> Column:
    """SHA-256 over the text of every column but the key and the excluded ones, in column order.

    A null differs from every text. Doubles hash as Spark writes them; format them first where another engine must agree.
    """
    cols = [c for c in df.columns if c not in key and c not in exclude]
    return F.sha2(F.concat(*[F.concat(F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)), F.lit(CLOSE)) for c in cols]), 256)


def iso_text(df: DataFrame, name: str) -> Column:
    """A date or timestamp column in ISO 8601; a fraction of six digits only where it isn't zero. Null stays null."""
    if isinstance(df.schema[name].dataType, DateType):
        return F.date_format(name, "yyyy-MM-dd")
    fraction = F.date_format(name, ".SSSSSS")
    return F.concat(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == ".000000", "").otherwise(fraction))


def surrogate_key(*cols: Column | str) -> Column:
    """Deterministic 64-bit key of the parts; the fast one, whose values are Spark's own."""
    return F.xxhash64(*cols)


def portable_key(text: Column) -> Column:
    """Deterministic 60-bit key of a text that other engines can compute: the first 15 hex digits of its SHA-256."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def hhmm_key(ts: Column | str) -> Column:
    """hour * 100 + minute as an int; null for null."""
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def extraction_name(path: Column) -> Column:
    """The part of a path that names an extraction, `<entity>_<yyyymmdd>_<hhmmss>.json...`; it may be a file or a folder."""
    return F.regexp_extract(path, r"([^/]*_\d{8}_\d{6}\.[^/]*)", 1)


def extraction_time(name: Column) -> Column:
    """The time in an extraction's name, without a zone; null if there is none."""
    stamp = F.regexp_extract(name, r"(\d{8}_\d{6})\.[^.]*$", 1)
    return F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def translated(value: Column, names: dict[str, str], missing: str = " (not translated yet)") -> Column:
    """Maps values by a small dictionary; others get their text with a note, null stays as the note alone."""
    out = None
    for k, v in names.items():
        out = F.when(value == k, v) if out is None else out.when(value == k, v)
    other = concat_skip_null(value, F.lit(missing))
    return other if out is None else out.otherwise(other)


def markup_field(text: Column, tag: str) -> Column:
    """Content of the first <tag>...</tag>; null if the tag is missing."""
    found = F.regexp_extract(text, rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.when(F.instr(text, f"<{tag}>") > 0, F.when(F.instr(text, f"</{tag}>") > 0, found))


def with_markup(df: DataFrame, text: str, fields: dict[str, str]) -> DataFrame:
    """Adds the contents of several tags (tag: name of its column), from one structured parse of the text.

    The parse finds every opening tag of interest together with what stands before its first closing tag, nested or not; of a
    tag that occurs more than once the first counts. A tag that is missing or never closed gives null, an empty one an empty text.
    """
    pattern = rf"(?s)<({'|'.join(fields)})>(?=(.*?)</\1>)"
    tokens = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(pattern), F.lit(i)).alias(n) for i, n in ((1, "tag"), (2, "content"))])
    parsed = df.withColumn("_tokens", tokens)
    first = lambda tag: F.try_element_at(F.filter("_tokens", lambda t: t["tag"] == tag), F.lit(1))["content"]
    return parsed.withColumns({name: first(tag) for tag, name in fields.items()}).drop("_tokens")


def lenient_date(text: Column, form: str = "dd-MM-yyyy") -> Column:
    """A date, or null where the text is none."""
    return F.try_to_timestamp(text, F.lit(form)).cast("date")


def redacted(params: Column) -> Column:
    """A map of parameters with the values of sensitive names replaced by ***."""
    return F.transform_values(params, lambda k, v: F.when(F.lower(k).rlike("|".join(SENSITIVE)), F.lit("***")).otherwise(v))


def entity_file_name(name: Column) -> Column:
    """Lower-case ASCII file name of an entity: the small letters o-slash, ae and a-ring are spelled out before lowering."""
    return F.lower(F.replace(F.replace(F.replace(name, F.lit("ø"), F.lit("oe")), F.lit("æ"), F.lit("ae")), F.lit("å"), F.lit("aa")))
