"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

A text is cut where its own content says so: after the first sentence mark past a least length, or, where none comes in time,
after the first window of four characters past it whose codes meet a mask. An edit moves the cuts near it only, in texts
without marks (digits, encoded data) too. Distinct chunks are grouped by their characters, which verifies the 64-bit identifiers: one that stands for
two different chunks is found there and widened. Documents are then compared by their ordered lists of identifiers alone;
the texts themselves are moved once, as distinct chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CLASS, staged

#: A chunk has this many characters at least (but for a text's last) and at most, unless neither a mark nor a window comes in time.
LEAST, MOST = 256, 1024
CUT = r"[.!?:;|。।]"
#: Windows that are looked for where no mark comes: four characters whose codes end with two zero bits (one place in some 300, whatever
#: ASCII alphabet the text has), then, for other scripts, three to five of which the first is the last as well.
WINDOWS = "[" + "".join(rf"\x{c:02x}" for c in range(48, 127, 4)) + "]{4}", r"(.)(?:.|..|...)\1"
#: Copies of one text from which they are dealt out to several tasks, PART to each; at most so many texts are dealt out.
HOT_COPIES, PART, MOST_HOT = 1000, 256, 100_000


def chunks(text: F.Column) -> F.Column:
    """The chunks of a text, in order; none of an empty text."""
    pattern = rf"(?s).{{{LEAST},{MOST - 1}}}?{CUT}|.{{{LEAST},{MOST - 5}}}?{WINDOWS[0]}|.{{{LEAST},{MOST - 5}}}?{WINDOWS[1]}|.{{1,{MOST}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifier(chunk: F.Column) -> F.Column:
    """64 bits for a chunk."""
    return F.xxhash64(chunk)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups rows whose texts are identical after all of space and \\t..\\r is deleted.

    Of a group the row with the most code points in its original text stays, then the one with the smallest id (a null id
    comes last). A null text counts as empty; empty texts are equal to each other. Rows that repeat an id with a text of one
    length are one document here: they share `kept`. An empty table gives no rows. Other columns are ignored, whatever their
    names. Long texts are chunked whole; a group of any size is counted in parts before it is
    shuffled, and its copies are told of it in parts too.

    Returns id_col, keep_id, group_size long, kept boolean, text_sha256 string (of the normalised text).
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("points"),
        F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), SPACE_CLASS + "+", "").alias("text"),
    )
    # identifiers: distinct chunks by their characters; an identifier with two of them is no identifier
    distinct = base.select(F.explode(chunks(F.col("text"))).alias("chunk")).select(identifier(F.col("chunk")).alias("h"), "chunk").groupBy("h", "chunk").agg(F.lit(1).alias("one"))
    unsafe = staged(distinct.groupBy("h").count().filter("count > 1").select("h"), "unsafe")
    recipes = base.select(
        "id", "points", F.sha2("text", 256).alias("text_sha256"), F.transform(chunks(F.col("text")), identifier).alias("recipe"), *([F.transform(chunks(F.col("text")), lambda c: F.sha2(c, 256)).alias("wide")] if unsafe.limit(1).count() else [])
    )
    if "wide" in recipes.columns:  # two chunks share an identifier somewhere: those recipes take digests for it as well
        hit = recipes.withColumn("row", F.monotonically_increasing_id())
        hit = staged(hit, "recipes")
        wide = hit.select("row", F.explode("recipe").alias("h")).join(unsafe, "h", "left_semi").select("row").distinct()
        recipes = hit.join(wide.withColumn("unsafe", F.lit(True)), "row", "left").withColumn("wide", F.when(F.col("unsafe"), F.col("wide")).otherwise(F.array().cast("array<string>"))).drop("row", "unsafe")
    else:
        recipes = recipes.withColumn("wide", F.array().cast("array<string>"))
    recipes = staged(recipes, "recipes")
    first = F.min(F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("none"), F.col("id").alias("id")))
    groups = staged(recipes.groupBy("recipe", "wide").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    # a large group's row is repeated for each part of its copies; at most MOST_HOT groups can have more copies than the bound, whatever
    # the input, so that their table is safe to broadcast
    bound, h = max(HOT_COPIES, recipes.count() // MOST_HOT), F.xxhash64("recipe", "wide")
    hot = groups.filter(F.col("group_size") > bound).groupBy(h.alias("h")).agg(F.max(F.ceil(F.col("group_size") / PART)).alias("parts"))
    hot = F.broadcast(staged(hot, "hot"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = recipes.withColumn("h", h).join(hot, "h", "left").withColumn("part", F.pmod(F.xxhash64("id", "points"), parts)).drop("h", "parts")
    repeated = groups.withColumn("h", h).join(hot, "h", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("h", "parts")
    joined = dealt.join(repeated, ["recipe", "wide", "part"])
    kept = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("points") == -F.col("first.points"))
    return joined.select(F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
