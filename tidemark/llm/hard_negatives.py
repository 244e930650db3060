"""Hard-negative mining: for each positive of an anchor, the best scored rows of other labels within a band below its score.

Anchors and rows are dealt into blocks, and every anchor block meets every row block in one cell of a grid: a product of two
integer matrices, whatever the labels, so that no label's size matters. A first pass keeps each anchor's best rows of its own
label. Their bands overlap, but what is best below a band's upper limit can be put together: the upper limits, in descending
order, cut the scores into disjoint slots. In the second pass every cell keeps the first k rows of each slot, window limits merge
cells slot by slot, and merging the slots from the lowest to the highest gives for every limit the first k rows at or below
it. A band's answer is the part of that list that reaches its lower limit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Positives of an anchor, negatives of a positive, bounds of the band in percent of the positive's score, and what a component is multiplied with before it is cut to a whole number.
POSITIVES, NEGATIVES, LOWEST, HIGHEST, SCALE = 5, 3, 50, 95, 256
#: Components of an anchor block and of a row block, rows below which a block isn't cut to keep more cores busy, and scores that are held at a time.
ANCHOR_VALUES, ROW_VALUES, LEAST_BLOCK, SCORES = 1 << 20, 1 << 22, 2048, 1 << 22
#: Doubles below this add and multiply without rounding; scores further from 0 than MOST_SCORE count as that.
EXACT, MOST_SCORE = 2.0**53, 1 << 62
NONE = -np.inf


def whole(v: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix of whole numbers as doubles) of a list column, for each number of components that occurs."""
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    at = v.offsets.to_numpy().astype(np.int64)
    flat = np.floor(v.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    sizes = np.diff(at)
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        yield places, flat[at[places][:, None] + np.arange(size)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole rows as doubles; where doubles could round, by Python's integers and held at MOST_SCORE."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return a @ b.T
    ints = [[int(x) for x in row] for row in b.tolist()]
    held = np.empty((len(a), len(b)), object)
    for i, row in enumerate(a.tolist()):
        left = [int(x) for x in row]
        for j, right in enumerate(ints):
            held[i, j] = max(-MOST_SCORE, min(MOST_SCORE, sum(x * y for x, y in zip(left, right, strict=True))))
    return held


def first_places(scores: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the greatest score of each row that is left, then of the next, k times; the first of equal ones. Scores
    taken are overwritten."""
    every = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        best = scores.argmax(axis=1)
        found = scores[every, best] > NONE
        if not found.any():
            return
        yield every[found], best[found]
        scores[every, best] = NONE


def exactly(scores: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in scores], np.int64) if scores.dtype == object else scores.astype(np.int64)


def cells(left: pa.Table, right: pa.Table, pick: Callable) -> pa.Table:
    """What `pick` finds for the anchors (left) and the rows (right) of one cell, over pairs with as many components."""
    right = right.sort_by("id")  # ties go to the smaller id, which is the first
    scale = left.column("scale")[0].as_py() if left.num_rows else 1
    column = lambda t, c: t.column(c).to_numpy()
    out = []
    if left.num_rows and right.num_rows:
        ids, labels, blocks = column(right, "id"), column(right, "label"), {m.shape[1]: (p, m) for p, m in whole(right.column("v"), scale)}
        own, own_labels, places = column(left, "id"), column(left, "label"), column(left, "place")
        for at, anchors in whole(left.column("v"), scale):
            there, rows = blocks.get(anchors.shape[1], (np.zeros(0, np.int64), None))
            if rows is None:
                continue
            out += pick(left, at, anchors, own[at], own_labels[at], places[at], rows, ids[there], labels[there])
    names = ("place", "slot", "score", "id")
    joined = [np.concatenate([np.asarray(o[i], np.int64) for o in out]) if out else np.zeros(0, np.int64) for i in range(4)]
    return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(names, joined, strict=True)})


def pick_positives(k: int) -> Callable:
    """For every anchor its k best rows of the same label but another id, label by label."""

    def pick(left, at, anchors, own, own_labels, places, rows, ids, labels):
        out = []
        for label in np.unique(own_labels):
            mine, theirs = np.flatnonzero(own_labels == label), np.flatnonzero(labels == label)
            step = max(1, SCORES // max(1, len(theirs)))
            for i in range(0, len(mine), step):
                some = mine[i : i + step]
                scores = products(anchors[some], rows[theirs])
                low, high = np.searchsorted(ids[theirs], own[some], "left"), np.searchsorted(ids[theirs], own[some], "right")
                for n in np.flatnonzero(high > low):
                    scores[n, low[n] : high[n]] = NONE
                kept = scores.copy()
                out += [(places[some[n]], np.zeros(len(n), np.int64), exactly(kept[n, j]), ids[theirs[j]]) for n, j in first_places(scores, k)]
        return out

    return pick


def pick_slots(k: int) -> Callable:
    """For every anchor and slot the k best rows of other labels. Slot s has scores at most limits[s - 1] and above limits[s]; the
    last one reaches down to the anchor's least score of interest."""

    def pick(left, at, anchors, own, own_labels, places, rows, ids, labels):
        limits = left.column("limits").take(pa.array(at)).to_pylist()
        most = max(map(len, limits))
        upper = np.array([u + [None] * (most - len(u)) for u in limits], np.float64)  # a missing one is NaN: nothing is at most that
        floor = left.column("least").to_numpy()[at].astype(np.float64)
        if upper.size and np.nanmax(np.abs(upper)) >= EXACT:  # the scores are Python's integers, so are their limits
            upper = np.array([u + [-MOST_SCORE - 1] * (most - len(u)) for u in limits], object)
            floor = left.column("least").to_numpy()[at].astype(object)
        out = []
        step = max(1, SCORES // max(1, len(rows)))
        for i in range(0, len(at), step):
            part = slice(i, i + step)
            scores = products(anchors[part], rows)
            scores[own_labels[part][:, None] == labels[None, :]] = NONE
            for s in range(most):
                inside = (scores <= upper[part, s, None]) & (scores >= floor[part, None])
                if s + 1 < most:
                    inside &= ~(scores <= upper[part, s + 1, None])
                if not inside.any():
                    continue
                slot = np.where(inside, scores, NONE)
                for n, j in first_places(slot, k):
                    out.append((places[part][n], np.full(len(n), s + 1), exactly(scores[n, j]), ids[j]))
        return out

    return pick


def best(found: DataFrame, key: list[str], k: int) -> DataFrame:
    """The first k of every key by score; each partition keeps its own first k before they are shuffled."""
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)


def usable(v: Column, scale: int) -> Column:
    """Not null, and every component neither null nor other than finite, also when multiplied."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & fine, F.lit(False))


def mine_hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | Column = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST, scale: int = SCALE
) -> DataFrame:
    """The first `negatives` rows of other labels for each of the first `positives` rows of an anchor's own label.

    anchor: which rows are anchors. A score is the inner product of two rows whose components are multiplied by scale and cut to
    whole numbers; higher ones come first, ties by smaller id. A negative's score is lowest to highest percent of the positive's.

    Rows with a null id or label, a null vector, or a component that is null or not finite (also when multiplied) take no part.
    Rows are scored where they have as many components; empty vectors score 0 with each other. A row that repeats an id is a row
    of its own, but none is a positive of an anchor with its id. Scores beyond 2 ** 62 count as that. An anchor without
    positives, or a positive without negatives in its band (all of negative score), gives no row; so does an empty table. Other
    columns are ignored, whatever their names.

    Returns anchor_id, positive_id, rank int, negative_id, positive_score, negative_score.
    """
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    base = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    base = base.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.transform("v", lambda x: x.cast("double")), scale))
    anchors = staged(base.filter("anchor").select("id", "label", "v", F.monotonically_increasing_id().alias("place")), "anchors")
    n_rows, width = base.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    n_anchors, width, cores = anchors.count(), max(1, width), vectors.sparkSession.sparkContext.defaultParallelism
    across = max(1, -(-n_anchors * width // ANCHOR_VALUES))
    down = max(1, -(-n_rows * width // ROW_VALUES), min(cores, -(-n_rows // LEAST_BLOCK)))
    tasks = min(across * down, 8 * max(cores, 64))

    def block(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = base.select("id", "label", "v", block("id", down).alias("r")).withColumn("a", every(across)).repartition(tasks, "a", "r").groupBy("a", "r")

    def met(some: DataFrame, pick: Callable) -> DataFrame:
        left = some.withColumns({"a": block("place", across), "scale": F.lit(scale)}).withColumn("r", every(down)).repartition(tasks, "a", "r").groupBy("a", "r")
        return left.cogroup(rows).applyInArrow(lambda x, y: cells(x, y, pick), "place long, slot long, score long, id long")

    found = best(met(anchors, pick_positives(positives)), ["place"], positives).filter("score >= 0")
    # whole numbers: floor(highest * s / 100) and ceil(lowest * s / 100) without leaving the range of a long
    part = lambda x, more: F.expr(f"(score div 100) * {x} + ((score % 100) * {x} + {more}) div 100")
    band = F.struct("n", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), part(highest, 0).alias("upper"), part(lowest, 99).alias("lower"))
    bands = staged(found.groupBy("place").agg(F.sort_array(F.collect_list(band)).alias("bands")), "bands")
    limited = anchors.join(bands, "place").select("id", "label", "v", "place", F.expr("transform(bands, b -> b.upper)").alias("limits"), F.array_min(F.expr("transform(bands, b -> b.lower)")).alias("least"))
    slots = best(met(limited, pick_slots(negatives)), ["place", "slot"], negatives)
    listed = slots.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("found"))
    # from the lowest slot to the highest: the first rows of a slot, then of what is below it
    merged = F.expr(
        f"""aggregate(sequence(size(bands), 1, -1), cast(array() as array<array<struct<slot:bigint,down:bigint,id:bigint>>>),
        (below, s) -> concat(array(slice(concat(filter(found, f -> f.slot = s), coalesce(get(below, 0), cast(array() as array<struct<slot:bigint,down:bigint,id:bigint>>))), 1, {negatives})), below))"""
    )
    answered = bands.join(listed, "place").withColumn("suffixes", merged).select("place", F.posexplode("bands").alias("i", "b"), "suffixes")
    kept = answered.select("place", "b", F.expr("filter(get(suffixes, i), f -> -f.down >= b.lower)").alias("kept")).select("place", "b", F.posexplode("kept").alias("i", "f"))
    return kept.join(anchors.select("place", F.col("id").alias("anchor_id")), "place").select(
        "anchor_id", "b.positive_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("f.id").alias("negative_id"), "b.positive_score", (-F.col("f.down")).alias("negative_score")
    )
