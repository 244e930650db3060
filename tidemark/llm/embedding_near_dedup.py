"""Embedding near-dedup by dual traversal of cover trees.

Vectors of one label are cut into shells by their distance from the label's pivot (the root of its tree); by the triangle
inequality linked vectors lie in one shell or in two that adjoin. Large shells are dealt out in tiles. For every pair of
tiles that can hold links a task grows a cover tree of either tile, with nested levels of halving radii, and walks the pair
of trees: a pair of nodes is dropped when its centres are further apart than the linking distance and both covering radii
allow; leaves are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, staged

SIMILARITY = 0.98
#: Vectors of a tile. A task holds two tiles.
TILE = 2048
#: Radii are those of unit vectors' chords: 2 covers the sphere. Rounding moves a short chord by some 1e-8.
ROOT_RADIUS, SLACK = 2.0, 1e-6


class Node:
    __slots__ = ("center", "children", "members", "radius")

    def __init__(self, center: int, members: np.ndarray, radius: float):
        self.center, self.members, self.radius, self.children = center, members, radius, []


def chords(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def cover_tree(x: np.ndarray, least: float) -> Node:
    """Nested levels over unit vectors: a node's children lie within half its level's radius of their own centres, the first
    of which is the node's; nodes whose level is below `least` are leaves."""
    start = chords(x, x[:1])[:, 0]
    root = Node(0, np.arange(len(x)), float(start.max()))
    stack = [(root, ROOT_RADIUS, start)]
    while stack:
        node, level, dist = stack.pop()
        if len(node.members) == 1 or node.radius <= least:
            continue
        half = level / 2
        while half > least and node.radius <= half:  # a level with one node only is skipped
            half /= 2
        rest, center, d = node.members, node.center, dist
        while len(rest):
            near = d <= half
            child = Node(center, rest[near], float(d[near].max()))
            node.children.append(child)
            stack.append((child, half, d[near]))
            rest = rest[~near]
            if len(rest):
                center = int(rest[0])
                d = chords(x[rest], x[center : center + 1])[:, 0]
    return root


def dual_pairs(x: np.ndarray, y: np.ndarray | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of all pairs of rows of x and y (y None: pairs i < j of x) with inner product >= similarity."""
    t = float(np.sqrt(max(0.0, 2.0 - 2.0 * similarity))) + SLACK
    own = y is None
    other = x if own else y
    a = cover_tree(x, t / 2)
    b = a if own else cover_tree(other, t / 2)
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    stack = [(a, b)]
    while stack:
        p, q = stack.pop()
        if not p.children and not q.children:
            i, j = np.nonzero(x[p.members] @ other[q.members].T >= similarity)
            i, j = p.members[i], q.members[j]
            keep = i < j if own and p is q else slice(None)
            out_i.append(np.minimum(i, j)[keep] if own else i)
            out_j.append(np.maximum(i, j)[keep] if own else j)
            continue
        ps, qs = p.children or [p], q.children or [q]
        if p is not q and p.children and q.children:  # the wider node is opened first
            ps, qs = (ps, [q]) if p.radius >= q.radius else ([p], qs)
        d = chords(x[[n.center for n in ps]], other[[n.center for n in qs]])
        near = d <= t + np.array([n.radius for n in ps])[:, None] + np.array([n.radius for n in qs])[None, :]
        for k, m in zip(*np.nonzero(near), strict=True):
            if not (own and p is q and k > m):
                stack.append((ps[k], qs[m]))
    return np.concatenate(out_i), np.concatenate(out_j)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place reachable over pairs (i, j), by repeated minimum and shortcut."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def usable(v: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", similarity: float = SIMILARITY) -> DataFrame:
    """Links and groups of vectors of one label whose cosine is `similarity` (above 0) or more, in double precision.

    Vectors are compared when their labels are equal and not null and they have as many components. Vectors that are null,
    empty, zero or have null or non-finite components link with nothing, nor do rows with a null id. id_col is read as a
    long. Equal vectors are one class and aren't compared with each other: each counts as a link of the others, a repeated
    row too. Ties can't occur. An empty table gives none; other columns are ignored, whatever their names.

    Returns id_col, n_links long (other vectors linked directly), component_id (smallest id reachable), kept boolean.
    """
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))
    rows = staged(base.select("id", F.when(good, F.col("label")).alias("label"), F.when(good, F.col("v")).alias("v")).withColumn("h", F.xxhash64("label", "v")), "vectors")
    valid = rows.filter("v is not null")
    classes = valid.groupBy("label", "v", "h").agg(F.min("id").alias("c"), F.count("*").alias("copies"))
    # the smallest class of a label and size is its pivot
    pivots = classes.groupBy("label", F.size("v").alias("size")).agg(F.min(F.struct("c", "v"))["v"].alias("pivot"))
    t = (2.0 - 2.0 * similarity) ** 0.5 + SLACK
    far = classes.withColumn("size", F.size("v")).join(pivots, ["label", "size"])

    def dot(a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    cosine = F.try_divide(F.try_divide(dot("v", "pivot"), F.sqrt(dot("v", "v"))), F.sqrt(dot("pivot", "pivot")))
    # overflowing or vanishing squares give no cosine: such vectors share the first shell with all others of their label
    shell = F.floor(F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * cosine)) / t).cast("int")
    shelled = staged(far.select("label", "size", "c", "v", "copies", F.when(cosine.isNotNull() & ~F.isnan(cosine), shell).otherwise(-1).alias("shell")), "shells")
    counts = shelled.groupBy("label", "size", "shell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    tiled = shelled.join(counts, ["label", "size", "shell"]).withColumn("part", F.pmod(F.xxhash64("c"), "parts").cast("int"))
    tiles = counts.select("label", "size", "shell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    one, two = (tiles.select("label", "size", F.col("shell").alias(f"s{k}"), F.col("part").alias(f"p{k}")) for k in (1, 2))
    near = (F.col("s2") == F.col("s1") + 1) | (F.col("s1") == -1) & (F.col("s2") > -1) | (F.col("s1") == F.col("s2")) & (F.col("p1") <= F.col("p2"))
    # pairs of tiles, not of rows: a tile of a spread-out label meets its own and the adjoining shells
    couples = one.join(two, ["label", "size"]).filter(near)
    pair = F.struct("label", "size", "s1", "p1", "s2", "p2")
    ends = couples.select(pair.alias("pair"), "label", "size", F.explode(F.when((F.col("s1") == F.col("s2")) & (F.col("p1") == F.col("p2")), F.array(F.struct(F.col("s1").alias("shell"), F.col("p1").alias("part"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("s1").alias("shell"), F.col("p1").alias("part"), F.lit(0).alias("side")), F.struct(F.col("s2").alias("shell"), F.col("p2").alias("part"), F.lit(1).alias("side"))))).alias("e"))
    ends = ends.select("pair", "label", "size", "e.*")
    met = tiled.join(ends, ["label", "size", "shell", "part"]).select("pair", "side", "c", "copies", "v")

    def walk(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids, copies = table.column("c").to_numpy(), table.column("copies").to_numpy()
        order = np.lexsort((ids, side))
        side, ids, copies = side[order], ids[order], copies[order]
        column = table.column("v").combine_chunks()
        v = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)[order]
        v = v / np.abs(v).max(1, keepdims=True)  # no square overflows
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        first = int((side == 0).sum())
        i, j = dual_pairs(v, None, similarity) if first == len(v) else dual_pairs(v[:first], v[first:], similarity) if first else (np.zeros(0, np.int64),) * 2
        j = j if first == len(v) else j + first
        links = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(j, weights=copies[i], minlength=len(ids))
        # places are in order of ids on either side only: roots are named by the smallest id
        root = local_roots(len(ids), i, j)
        name = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(name, root, ids)
        some = np.flatnonzero(links)
        return pa.table({"c": ids[some], "links": links[some].astype(np.int64), "root": name[root[some]]})

    found = staged(met.groupBy("pair").applyInArrow(walk, "c long, links long, root long"), "links")
    groups = components(found.filter("c <> root").select(F.col("c").alias("a"), F.col("root").alias("b")))
    direct = found.groupBy("c").agg(F.sum("links").alias("links"))
    about = staged(classes.join(direct, "c", "left").join(groups.withColumnRenamed("id", "c"), "c", "left").select("h", "label", "v", "c", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "c").alias("component")), "classes")
    linked = valid.join(about, ["h", "label", "v"]).select("id", "n_links", "component")
    alone = rows.filter("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
