"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every document gets a rate exp(multiplier of its source): of all rates that give the sources their target numbers of words,
those nearest to 1 in relative entropy, each word weighing alike. The multipliers solve the convex dual by Newton steps; a
step's gradient and curvature are sums over (source, size) counts. Rates become copies by systematic selection: documents of
a source in order of size, every 1/f-th of them. The starting phase and a nudge of f, no larger than the largest document's
share of its source, are those that come nearest to the target.

Documents of one source and size are numbered in the order of a digest. Its first digits deal them to as many parts as the
table needs, so the numbers don't depend on how many parts there are, and no task numbers a whole source.
"""

from __future__ import annotations

from math import inf

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_path, staged
from tidemark.operators.relational import row_ids

#: Weights of the sources in order, repeating; share of all words to take; most copies of a document.
WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), 1.5, 2
#: Starting phases and nudges of the fraction (each way, within the share of the largest document) that are tried.
PHASES, NUDGES = 16, 8
#: Documents of a part, about, should one source and size hold them all; a Newton step that ends the search.
PART_ROWS, STILL = 4096, 1e-10


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long"), F.lit(0).cast("long"))


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """Adds target to (source, source_size): shares by weight, held at `most` times a source's size, the excess reshared by
    weight until none is above. Sources ("" is the null one) are in code point order, null last, and take the weights in turn.

    They are numbered by ranges. A round of resharing is one aggregation over them, and holds at least one source more.
    """
    ranked = row_ids(sources, [F.col("source") == "", F.col("source")], scratch_path(sources.sparkSession, "sources"), "turn")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("turn") - 1, F.lit(len(weights))).cast("int") + 1)
    listed = staged(ranked.select("source", "source_size", weight.alias("weight"), (most * F.col("source_size").cast("double")).alias("cap")), "sources")
    held, level, before = F.lit(False), 0.0, -1
    while True:
        now = listed.agg(F.sum("source_size").alias("whole"), F.sum(F.when(held, F.col("cap"))).alias("capped"), F.sum(F.when(~held, F.col("weight"))).alias("free"), F.count_if(held).alias("n")).first()
        if now.n == before or not now.free:
            break
        level, before = (share * now.whole - (now.capped or 0.0)) / now.free, now.n
        held = F.col("weight") * F.lit(level) >= F.col("cap")
    return listed.select("source", "source_size", F.when(held, F.col("cap")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def balanced_rates(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, rate): the dual's solution by Newton steps over (source, size, n) counts.

    A step is one job: it sums size * n * exp(multiplier) over the counts (gradient and curvature at once: every word weighs alike),
    writes the next multipliers and observes the largest move. From below a step overshoots and is held; from above steps
    come down by one at most until they converge quadratically, so their number is that of a target's share in logarithms and
    a few more. A source without words or target has rate 0.
    """
    now, far = staged(targets.withColumn("multiplier", F.lit(0.0)), "multipliers"), inf
    while far >= STILL:
        mass = classes.join(now.select("source", "multiplier"), "source").groupBy("source").agg(F.sum(F.col("size") * F.col("n") * F.exp("multiplier")).alias("mass"))
        live = (F.col("mass") > 0) & (F.col("target") > 0)
        step = F.coalesce(F.when(live, F.least(F.lit(2.0), (F.col("target") - F.col("mass")) / F.col("mass"))), F.lit(0.0))
        moved = now.join(mass, "source", "left").withColumn("step", step)
        seen = Observation()
        moved = moved.observe(seen, F.max(F.abs("step")).alias("far"))
        now = staged(moved.select("source", "source_size", "target", (F.col("multiplier") + F.col("step")).alias("multiplier")), "multipliers")
        far = seen.get["far"]
    rate = F.when((F.col("target") > 0) & (F.col("source_size") > 0), F.round(F.exp("multiplier"), 9)).otherwise(0.0)
    return now.select("source", "source_size", "target", rate.alias("rate"))


def nudged(f: Column, nudge: Column, reach: Column) -> Column:
    """f moved by so many steps of reach, from 0 to 1; a whole rate has nothing to select and stays."""
    return F.when(f == 0, 0.0).otherwise(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), f + nudge * reach)), 9))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """Copies of every row so that each source comes near its target number of words.

    A null text has size 0; a null source is a source of its own, the last one. Rows of size 0 are taken 0 times. Repeated
    rows are rows of their own; which of several equal rows has a copy more can't be told apart. Null ids are rows like others. An
    empty table gives none. `keep` names further columns to carry along; all others are ignored, whatever their names.

    Returns id_col, size, source_size long, target double, copies int, taken long (size * copies), and the kept columns.
    """
    # sources by a name that is never null, so that windows and joins below share one partitioning; "" is the null source
    named = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    text = F.col(text_col).cast("string")
    place = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), text))
    base = docs.select(F.col(id_col).alias("id"), named.alias("source"), word_count(text).alias("size"), place.alias("place"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    base = base if keep else staged(base, "sizes")
    rows, digits = docs.count(), 1
    if not rows:
        none = base.withColumns({"source_size": F.lit(0).cast("long"), "target": F.lit(0.0), "copies": F.lit(0), "taken": F.lit(0).cast("long")})
        return none.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", "taken", *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)])
    while 16**digits * PART_ROWS < rows:
        digits += 1
    base = base.withColumn("part", F.left("place", F.lit(digits)))
    parts = staged(base.groupBy("source", "size", "part").agg(F.count("*").alias("n")), "parts")
    classes = staged(parts.groupBy("source", "size").agg(F.sum("n").alias("n")), "counts")
    sources = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rates = balanced_rates(classes, source_targets(sources))

    # how many rows of a source come before each of its sizes (of which a source of w words has at most the root of 2 w), and the start and nudge that bring it nearest to its target
    by_size = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = classes.withColumn("before", F.coalesce(F.sum("n").over(by_size), F.lit(0)).cast("long"))
    ranked = ranked.join(rates, "source").withColumn("f", F.round(F.col("rate") - F.floor("rate"), 9))
    ranked = ranked.withColumn("reach", F.max("size").over(Window.partitionBy("source")) / F.greatest(F.col("source_size"), F.lit(1)) / NUDGES)
    choices = [F.struct(F.lit(abs(j)).alias("far"), F.lit((i + 0.5) / PHASES).alias("phase"), F.lit(j).alias("nudge")) for j in range(-NUDGES, NUDGES + 1) for i in range(PHASES)]
    tried = ranked.filter("size > 0").withColumn("choice", F.explode(F.array(*choices))).withColumn("g", nudged(F.col("f"), F.col("choice.nudge"), F.col("reach")))
    more = F.floor((F.col("before") + F.col("n")) * F.col("g") + F.col("choice.phase")) - F.floor(F.col("before") * F.col("g") + F.col("choice.phase"))
    sums = tried.groupBy("source", "choice").agg(F.abs(F.sum(F.col("size") * (F.col("n") * F.floor("rate") + more)) - F.first("target")).alias("off"))
    best = sums.groupBy("source").agg(F.min(F.struct("off", "choice"))["choice"].alias("choice"))
    ranked = ranked.join(best, "source", "left").withColumn("f", nudged(F.col("f"), F.col("choice.nudge"), F.col("reach"))).drop("n")
    by_part = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = parts.withColumn("in_class", F.coalesce(F.sum("n").over(by_part), F.lit(0)))
    plan = start.join(ranked, ["source", "size"]).select("source", "size", "part", (F.col("before") + F.col("in_class")).alias("from"), "f", "rate", F.coalesce("choice.phase", F.lit(0.5)).alias("phase"), "source_size", "target")

    numbered = base.withColumn("k", F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("place")))
    full = numbered.join(staged(plan, "plan"), ["source", "size", "part"])
    at = F.col("from") + F.col("k")
    copies = F.floor("rate") + F.floor(at * F.col("f") + F.col("phase")) - F.floor((at - 1) * F.col("f") + F.col("phase"))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.least(F.lit(MOST_COPIES), copies)).cast("int")
    return full.select(F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)])
