"""N-gram Jaccard join on size-banded tiles with hashed bitmap signatures.

1. Every text becomes a sorted array of 64-bit shingle hashes, at points that are drawn anew for every run, so that no text can be
   made to clash. A run in which two words of a text clash, or the words refute a link, is begun again at other points. Texts with the same words in the same order (a 128-bit digest of
   the words) are one class, under the smallest id.
2. Two sets that link share a shingle among the first quarter of either, in any one order of all shingles, with enough of both
   sets after it. The order puts shingles of crowded hash cells last (as a rarity order does), then goes by hash. A key is one
   such shingle that more than one class has.
3. Every class is compared with one leader, the mate that it meets under most keys: a group of near copies is joined by one
   comparison a member. Classes whose leaders, or theirs, are the same are a cluster, whether they link with them or not.
4. Classes of different groups that share a key which few classes have are paired one by one, and a pair stays if it shares as many
   keys as sets of its sizes must to link. A larger input has more keys that unlike texts share by chance; such a pair falls
   here, before anything of its texts or clusters moves. Where a key has many classes, their clusters are paired instead.
5. Groups with such pairs, and clusters, are compared by tiles: each is cut by size bands into blocks of a
   thousand classes, blocks of fitting sizes meet, and of a pair of blocks only the classes are compared that no link joins
   so far. Signatures bound the overlap from above: bits in which two signatures differ are no more than the shingles that one
   set has and the other lacks. Only for classes that some signature leaves a partner are the sorted arrays moved and
   intersected.
6. Links that join groups are confirmed on the words themselves. A tile returns links that join its groups, not all its pairs:
   rows grow with blocks and members, not with pairs.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHasher, components, rolled, slices, staged, text_buffer, word_bounds

SHINGLE, PERCENT = 5, 75
#: Hash cells whose shingles are counted to find the crowded ones; the table has a byte a cell, whatever the input.
CELL_BITS, CELL_BLOCKS = 22, 64
#: Rows up to which a table of ids is broadcast (32 bytes each at most); beyond it the texts are shuffled to meet them.
BROADCAST_ROWS = 1_000_000
#: Members that one task compares with a leader before its group is dealt out to more; classes and shingles of a block.
GROUP_MEMBERS, BLOCK, BLOCK_SHINGLES = 512, 1024, 1 << 20
#: Leaders of leaders that are followed to name a cluster; few, so that chains of unlike texts stay short.
LEADERS_UP = 3
#: Classes of a key up to which they are paired one by one; keys that a pair is asked to share at most (it decides about speed only).
FEW, AGREE = 128, 8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def hashed_words(texts: pa.Array, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): text i has the words first[i]..first[i + 1] - 1, A-Z in lower case."""
    buf, offsets = text_buffer(texts)
    buf = _LOWER[buf]
    starts, ends, first = word_bounds(buf, offsets)
    return hasher(buf, starts, ends), first


def shingles(h: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    runs = rolled(h, k, 0xD6E8FEB86659FD93)
    out = []
    for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = j - i
        if n >= k:
            out.append(np.unique(runs[i : j - k + 1]))
        elif n:  # the whole sequence as one; seeded by its length, so that it can't equal a part of another
            out.append(rolled(h[i:j], n, 0xD6E8FEB86659FD93 + 2 * n))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: pa.Array, hasher: WordHasher) -> list[np.ndarray]:
    return shingles(*hashed_words(texts, hasher))


def lowered_words(texts: pa.Array) -> list[list[bytes]]:
    """The words of every text, A-Z in lower case."""
    buf, offsets = text_buffer(texts)
    raw = _LOWER[buf].tobytes()
    return [raw[i:j].split() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def shingles_of(words: list[bytes], k: int = SHINGLE) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def words_link(a: set[tuple[bytes, ...]], b: set[tuple[bytes, ...]], percent: int = PERCENT) -> bool:
    """100 * |a & b| >= percent * |a | b|, on the words."""
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def signature(s: np.ndarray, bits: int) -> np.ndarray:
    """Bitmap of the hashes modulo bits (a power of two)."""
    out = np.zeros(bits, bool)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64)


def signature_bits(n: int) -> int:
    return 1 << max(6, (2 * n - 1).bit_length())


def folded(sign: np.ndarray, words: int) -> np.ndarray:
    """A signature cut to fewer words (a power of two): what signature() gives for so many bits."""
    return np.bitwise_or.reduce(sign.reshape(-1, words), axis=0) if len(sign) > words else sign


def least_overlap(na: np.ndarray | int, nb: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least overlap of sets of so many shingles that links them."""
    return -(-percent * (na + nb) // (100 + percent))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * |a & b| >= percent * |a | b| of two sorted arrays, after the bound by their signatures."""
    na, nb = len(a), len(b)
    if not na or not nb or 100 * min(na, nb) < percent * max(na, nb):
        return False
    bits = signature_bits(min(na, nb))
    differ = int(np.bitwise_count(signature(a, bits) ^ signature(b, bits)).sum())
    if na + nb - differ < 2 * least_overlap(na, nb, percent):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), nb - 1)] == a).sum())
    return 100 * both >= percent * (na + nb - both)


def crowded_levels(docs: DataFrame, hasher: WordHasher) -> np.ndarray:
    """A level for every hash cell of shingles: eight times the binary logarithm of its count.

    Every task sums dense counts and sends them in blocks; blocks are added by key. It only orders shingles, so it decides
    about speed, never about results.
    """
    size = (1 << CELL_BITS) // CELL_BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << CELL_BITS, np.int32)
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text"), hasher)
                if sets:
                    np.add.at(held, (np.concatenate(sets) >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
        blocks = [held[i * size : (i + 1) * size] for i in range(CELL_BLOCKS)]
        some = [i for i, b in enumerate(blocks) if b.any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([np.ascontiguousarray(blocks[i].astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for i in some], pa.binary())], names=["block", "counts"])

    def planes(data: bytes) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                held[b] = held.get(b, 0) + planes(data)
        for b, n in held.items():
            level = np.minimum(255, np.round(8 * np.log2(1.0 + n))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["block", "levels"])

    summed = docs.select("text").mapInArrow(count, "block int, counts binary").repartition(CELL_BLOCKS, "block").mapInArrow(add, "block int, levels binary")
    levels = np.zeros(1 << CELL_BITS, np.uint8)
    for row in summed.collect():  # a byte a cell
        levels[row.block * size : (row.block + 1) * size] = np.frombuffer(row.levels, np.uint8)
    return levels


def bounded(table: DataFrame) -> DataFrame:
    """A staged table of ids, marked for broadcast if it has no more than BROADCAST_ROWS rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def may_link(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures leave room for the overlap that a link needs. signs: c, n, sign."""
    one, two = (signs.select(F.col("c").alias(i), F.col("n").alias(f"n{i}"), F.col("sign").alias(f"s{i}")) for i in ("a", "b"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            room = na + nb - 2 * least_overlap(na, nb, percent)
            keep = []
            for x, y, most in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), room.tolist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                keep.append(int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()) <= most)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    met = pairs.join(one, "a").join(two, "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return met.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(test, "a long, b long")


def compare(docs: DataFrame, pairs: DataFrame, percent: int, hasher: WordHasher) -> DataFrame:
    """The pairs (a, b) whose texts link, on the words. Texts of a's members meet a's text; a group of any size is dealt out
    in parts."""
    pairs = staged(pairs, "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_MEMBERS).alias("parts"))
    members = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").alias("part"), F.col("b").alias("id"), F.lit(False).alias("lead"))
    leads = parts.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("a").alias("id"), F.lit(True).alias("lead"))
    met = docs.select("id", "text").join(bounded(staged(members.union(leads), "roles")), "id")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, leaders = None, []
        for whole in batches:
            for batch in slices(whole, "text"):
                out, texts = [], batch.column("text")
                rows = zip(batch.column("a").to_pylist(), batch.column("part").to_pylist(), batch.column("id").to_pylist(), batch.column("lead").to_pylist(), shingle_sets(texts, hasher), lowered_words(texts), strict=True)
                for a, part, b, lead, s, words in rows:
                    if now != (a, part):
                        now, leaders = (a, part), []
                    if lead:
                        leaders.append((s, shingles_of(words)))
                    elif some := [x for t, x in leaders if linked(t, s, percent)]:
                        mine = shingles_of(words)
                        if any(words_link(x, mine, percent) for x in some):
                            out.append((a, b))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = met.select("a", "part", "id", "lead", "text").repartition(tasks, "a", "part").sortWithinPartitions("a", "part", F.desc("lead"))
    return staged(grouped.mapInArrow(test, "a long, b long"), "links")


def grouped_rows(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j == i:
                continue
            if held and held[0].column(key)[0].as_py() != keys[i]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def met_pairs(table: pa.Table, percent: int) -> np.ndarray:
    """True where a class of one block may link with one of the other by their sizes, groups and signatures."""
    one, two = (np.flatnonzero(table.column(s).to_numpy(zero_copy_only=False)) for s in ("one", "two"))
    n, comp, c = (table.column(x).to_numpy() for x in ("n", "comp", "c"))
    signs = [np.frombuffer(x, np.uint64) for x in table.column("sign").to_pylist()]
    na, nb = n[one][:, None], n[two][None, :]
    fits = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (comp[one][:, None] != comp[two][None, :])
    room = na + nb - 2 * least_overlap(na, nb, percent)
    width = np.array([len(s) for s in signs])
    for w in np.unique(width):  # signatures are compared in the shorter width
        for v in np.unique(width):
            i, j = np.flatnonzero(width[one] == w), np.flatnonzero(width[two] == v)
            if not len(i) or not len(j) or not fits[np.ix_(i, j)].any():
                continue
            words = int(min(w, v))
            x, y = (np.stack([folded(signs[k], words) for k in side]) for side in (one[i], two[j]))
            differ = np.zeros((len(i), len(j)), np.int64)
            for k in range(words):
                differ += np.bitwise_count(x[:, k, None] ^ y[None, :, k])
            fits[np.ix_(i, j)] &= differ <= room[np.ix_(i, j)]
    return fits


def joining_links(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links of a pair of blocks that join different groups, one for each two groups that come together."""
    fits = met_pairs(table, percent)
    one, two = (np.flatnonzero(table.column(s).to_numpy(zero_copy_only=False)) for s in ("one", "two"))
    ids, comp = (table.column(x).to_numpy() for x in ("c", "comp"))
    column = table.column("set").combine_chunks()
    n = column.value_lengths().to_numpy()
    flat, starts = column.flatten().to_numpy(), np.concatenate(([0], np.cumsum(n)))
    shingles, place = np.unique(flat, return_inverse=True)
    parent = {x: x for x in np.unique(comp).tolist()}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # shingles of side two in one run, so that one pass counts what a class shares with each
    runs = np.concatenate([place[starts[k] : starts[k + 1]] for k in two]) if len(two) else place[:0]
    begin = np.concatenate(([0], np.cumsum(n[two])[:-1])).astype(np.int64)
    has, out = np.zeros(len(shingles), bool), []
    for i, k in enumerate(one):
        js = np.flatnonzero(fits[i])
        if not len(js) or all(find(int(comp[two[j]])) == find(int(comp[k])) for j in js):
            continue
        own = place[starts[k] : starts[k + 1]]
        has[own] = True
        both = np.add.reduceat(has[runs].astype(np.int64), begin)
        has[own] = False
        for j in js[100 * both[js] >= percent * (n[k] + n[two[js]] - both[js])]:
            x, y = find(int(comp[k])), find(int(comp[two[j]]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((int(ids[k]), int(ids[two[j]])))
    return out


def several() -> Column:
    """Whether two sets of classes with groups c0..c1 have more than one group."""
    return (F.col("c01") != F.col("c11")) | (F.col("c02") != F.col("c12")) | (F.col("c01") != F.col("c02"))


def fitting(percent: int) -> Column:
    """Whether some sizes in lo..hi of two sets of classes can link."""
    return (100 * F.col("hi1") >= percent * F.col("lo2")) & (100 * F.col("hi2") >= percent * F.col("lo1"))


def close_pairs(few: DataFrame, many: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of different groups that share a key of few classes and may link by their keys and signatures.

    few, many: key, c, n, rest (shingles from the key on), comp (group so far). If two sets overlap in m shingles or more, the first i
    shingles that both have (any i up to m) have m - i more in common after them: the two share i keys with more than m - i shingles
    from them on, for any i for which these are all among the keys of both. A key of many classes is taken as shared if both have one.
    """
    x, y = (few.select("key", *[F.col(k).alias(f"{k}{i}") for k in ("c", "n", "rest", "comp")]) for i in (1, 2))
    sizes = (100 * F.col("n1") >= percent * F.col("n2")) & (100 * F.col("n2") >= percent * F.col("n1"))
    least = F.expr(f"({percent} * (n1 + n2) + {99 + percent}) div {100 + percent}")
    agree = F.least(F.lit(AGREE), least - F.expr(f"({percent} * greatest(n1, n2) + 99) div 100") + 1)
    met = x.join(y, "key").filter((F.col("c1") < F.col("c2")) & (F.col("comp1") != F.col("comp2")) & sizes & (F.least("rest1", "rest2") > least - agree))
    pairs = met.select(F.col("c1").alias("a"), F.col("c2").alias("b"), agree.cast("int").alias("agree")).groupBy("a", "b").agg(F.count("*").alias("times"), F.max("agree").alias("agree"))
    held = staged(many.groupBy("c").agg(F.count("*").alias("held")), "held")
    for i in ("a", "b"):
        pairs = pairs.join(held.select(F.col("c").alias(i), F.col("held").alias(f"held_{i}")), i, "left")
    enough = F.col("times") + F.least(F.coalesce("held_a", F.lit(0)), F.coalesce("held_b", F.lit(0))) >= F.col("agree")
    return staged(may_link(staged(pairs.filter(enough).select("a", "b"), "agreeing"), signs, percent), "near")


def met_groups(near: DataFrame, groups: DataFrame, signs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(couples, members) for tiles of the pairs near (a, b): groups that have one, and their classes that are in one.
    groups: c, comp of the classes that have been joined."""
    of = staged(near.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(groups, "c", "left").select("c", F.coalesce("comp", "c").alias("comp")), "of")
    one, two = (of.select(F.col("c").alias(i), F.col("comp").alias(f"comp_{i}")) for i in ("a", "b"))
    couples = near.join(one, "a").join(two, "b").select(*[F.struct(F.lit(1).alias("kind"), f("comp_a", "comp_b").alias("id")).alias(x) for x, f in (("cluster1", F.least), ("cluster2", F.greatest))])
    return couples.distinct(), signs.select("c", "n").join(of, "c").select("c", "n", "comp", F.struct(F.lit(1).alias("kind"), F.col("comp").alias("id")).alias("cluster"))


def met_clusters(many: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(couples, members) for tiles of clusters that share a key of many classes. many: key, c, n, rest, comp, cluster."""
    many = many.withColumn("cluster", F.struct(F.lit(2).alias("kind"), F.col("cluster").alias("id")))
    by_key = many.groupBy("key", "cluster").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("rest").alias("rest"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    by_key = staged(by_key, "by_key")
    a, b = (by_key.select("key", *[F.col(x).alias(f"{x}{k}") for x in ("cluster", "lo", "hi", "rest", "c0", "c1")]) for k in (1, 2))
    enough = (100 + percent) * F.least("rest1", "rest2") >= percent * (F.col("lo1") + F.col("lo2"))
    across = a.join(b, "key").filter((F.col("cluster1") < F.col("cluster2")) & several() & fitting(percent) & enough).select("cluster1", "cluster2")
    within = by_key.filter("c0 <> c1").select(F.col("cluster").alias("cluster1"), F.col("cluster").alias("cluster2"))
    return across.union(within).distinct(), many.select("c", "n", "comp", "cluster").distinct()


def tiles(couples: DataFrame, members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of classes and the pairs of blocks that can hold links.

    couples: cluster1, cluster2; members: c, n, comp (group so far), cluster. Returns members (c, n, comp, block) and
    pairs (pair, block1, block2).
    """
    couples = staged(couples, "couples")
    some = couples.select(F.explode(F.array("cluster1", "cluster2")).alias("cluster")).distinct()
    members = staged(members.join(some, "cluster", "left_semi"), "members")
    # a cluster of one block's size is a block; a larger one is cut by size band, and groups of a block's size stand apart
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent + 0.01))).cast("int")
    needed = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES))
    of_cluster = members.groupBy("cluster").agg(needed.alias("in_cluster"))
    of_group = members.groupBy("cluster", "comp").agg(needed.alias("in_group"))
    large = F.col("in_cluster") > 1
    cut = members.join(of_cluster, "cluster").join(of_group, ["cluster", "comp"]).select(
        "c", "n", "comp", "cluster", F.when(large, band).otherwise(-1).alias("band"), F.when(large & (F.col("in_group") > 1), F.col("comp")).otherwise(F.lit(-1)).alias("own"), (large & (F.col("in_group") > 1)).alias("apart")
    )
    cut = staged(cut, "cut")
    parts = cut.groupBy("cluster", "band", "own", "apart").agg(needed.alias("parts"))
    dealt = cut.join(parts, ["cluster", "band", "own", "apart"]).select("c", "n", "comp", "cluster", "band", "own", "apart", F.pmod(F.xxhash64("c"), "parts").alias("part"))
    name = ("cluster", "band", "own", "apart", "part")
    blocks = dealt.groupBy(*name).agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    blocks = staged(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    placed = staged(dealt.join(blocks.select(*name, "block"), list(name)).select("c", "n", "comp", "block"), "placed")
    x, y = (blocks.select(*[F.col(i).alias(f"{i}{k}") for i in ("cluster", "block", "lo", "hi", "c0", "c1")]) for k in (1, 2))
    meet = couples.join(x, "cluster1").join(y, "cluster2").filter(several() & fitting(percent) & ((F.col("cluster1") != F.col("cluster2")) | (F.col("block1") <= F.col("block2"))))
    return placed, staged(meet.select(F.monotonically_increasing_id().alias("pair"), "block1", "block2"), "meet")


def tile_links(base: DataFrame, signs: DataFrame, open_rows: DataFrame, groups: DataFrame, percent: int, hasher: WordHasher) -> DataFrame:
    """Links (a, b) between classes of different groups that share a key, enough of them to join all that link.

    open_rows: key, c, n, rest, comp, cluster, few (whether few classes have the key), of keys that several groups have.
    """
    few, many = open_rows.filter("few"), open_rows.filter("not few")
    by_pairs, by_keys = met_groups(close_pairs(few, many, signs, percent), groups, signs), met_clusters(many, percent)
    placed, meet = tiles(by_pairs[0].union(by_keys[0]), by_pairs[1].union(by_keys[1]), percent)
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sided = meet.select("pair", F.explode(F.when(F.col("block1") == F.col("block2"), F.array(F.struct(F.col("block1").alias("block"), F.lit(True).alias("one"), F.lit(True).alias("two")))).otherwise(F.array(F.struct(F.col("block1").alias("block"), F.lit(True).alias("one"), F.lit(False).alias("two")), F.struct(F.col("block2").alias("block"), F.lit(False).alias("one"), F.lit(True).alias("two"))))).alias("s")).select("pair", "s.*")
    sides = sided.join(placed.join(signs.select("c", "sign"), "c"), "block").select("pair", "one", "two", "c", "n", "comp", "sign").repartition(tasks, "pair").sortWithinPartitions("pair", "c")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The classes of each pair of blocks to which some signature leaves a partner."""
        for table in grouped_rows(batches, "pair"):
            fits = met_pairs(table, percent)
            one, two = (np.flatnonzero(table.column(s).to_numpy(zero_copy_only=False)) for s in ("one", "two"))
            keep = np.zeros(len(table), bool)
            keep[one[fits.any(1)]] = True
            keep[two[fits.any(0)]] = True
            yield from table.filter(pa.array(keep)).combine_chunks().to_batches()

    shape = "pair long, one boolean, two boolean, c long, n long, comp long, sign binary"
    close = staged(sides.mapInArrow(candidates, shape), "close")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text"), hasher)
                ends = np.cumsum([0, *map(len, sets)])
                lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["c", "set"])

    wanted = bounded(staged(close.select(F.col("c").alias("id")).distinct(), "wanted"))
    sets = staged(base.join(wanted, "id", "left_semi").mapInArrow(shingled, "c long, set array<long>"), "sets").dropDuplicates(["c"])
    full = close.join(sets, "c").select("pair", "one", "two", "c", "n", "comp", "sign", "set").repartition(tasks, "pair").sortWithinPartitions("pair", "c")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_rows(batches, "pair"):
            found = joining_links(table, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    return full.mapInArrow(links, "a long, b long").distinct()


def ngram_jaccard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The group of every row under links of texts whose shingle sets have a Jaccard similarity of percent / 100 or more.

    Words are runs of anything but space and \\t..\\r, A-Z in lower case; a set has all distinct 5-word shingles, or the whole
    sequence of fewer words. A text without words (or null) has an empty set and links with nothing. id_col is read as a
    long and should be unique: rows with a null id have a null component and link with nothing, equal rows share their
    class, unlike texts of one id are one member of a group with the links of one of them. Ties can't occur: a component is the
    smallest id reachable. An empty table gives none; other columns are ignored.

    Returns doc_id, n_shingles long, class_id (smallest id with the same words) and component_id.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    while (found := joined_at(base, percent, WordHasher(drawn_points()))) is None:
        pass
    names = {"id": id_col, "n": "n_shingles", "class": "class_id", "component": "component_id"}
    return found.select(*[F.col(c).alias(name) for c, name in names.items()])


def drawn_points() -> int:
    return secrets.randbits(64)


def joined_at(base: DataFrame, percent: int, hasher: WordHasher) -> DataFrame | None:
    """(id, n, class, component) of every row of base (id, text); None if hashes at these points clash."""
    levels = base.sparkSession.sparkContext.broadcast(crowded_levels(base, hasher))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                h, bounds = hashed_words(batch.column("text"), hasher)
                words, sets, first = lowered_words(batch.column("text")), shingles(h, bounds), []
                digest = [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words]
                clash = [len(set(w)) != len(np.unique(h[i:j])) for w, i, j in zip(words, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                signs = [signature(s, signature_bits(len(s))).tobytes() for s in sets]
                for s in sets:
                    n = len(s)
                    k = n - -(-percent * n // 100) + 1 if n else 0
                    level = levels.value[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    # sets are sorted, so a stable sort by level orders by (level, hash)
                    first.append(s[np.argsort(level, kind="stable")[:k]].view(np.int64))
                sizes = np.fromiter(map(len, first), np.int64, len(first))
                flat = np.concatenate(first) if first else np.zeros(0, np.int64)
                lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes)))), pa.array(flat)).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(signs, pa.binary()), lists, pa.array(clash, pa.bool_())], names=["id", "n", "digest", "sign", "first", "clash"])

    summary = staged(base.mapInArrow(summarise, "id long, n long, digest binary, sign binary, first array<long>, clash boolean"), "summary")
    if not summary.filter("clash").isEmpty():
        return None
    known = summary.filter("id is not null and n > 0")
    classes = staged(known.groupBy("digest").agg(F.min("id").alias("class")), "classes")
    kept = known.join(classes.withColumnRenamed("class", "id"), ["id", "digest"], "left_semi")
    kept = staged(kept.select(F.col("id").alias("c"), "n", "sign", "first"), "kept")
    signs = kept.select("c", "n", "sign")

    # keys of more than one class, and their smallest classes in size bands of one remainder by three
    band = F.pmod(F.floor(F.log("n") / F.log(F.lit(100.0 / percent + 0.01))), F.lit(3))
    rows = kept.select("c", "n", F.posexplode("first").alias("place", "key"))
    held = [F.min(F.when(band == k, F.col("c"))).alias(f"in{k}") for k in range(3)]
    keys = staged(rows.groupBy("key").agg(F.count("*").alias("sharers"), *held).filter("sharers > 1").drop("sharers"), "keys")
    own = F.when(band == 0, F.col("in0")).when(band == 1, F.col("in1")).otherwise(F.col("in2"))
    lead = F.when(own != F.col("c"), own).otherwise(F.least("in0", "in1", "in2"))
    shared = staged(rows.join(keys, "key").select("key", "c", "n", (F.col("n") - F.col("place")).alias("rest"), lead.alias("lead")), "shared")

    # one leader a class: the mate that it meets most often
    met = shared.filter("lead <> c").groupBy("c", "lead").agg(F.count("*").alias("times"))
    stars = staged(met.groupBy("c").agg(F.max(F.struct("times", (-F.col("lead")).alias("a")))["a"].alias("a")).select((-F.col("a")).alias("a"), F.col("c").alias("b")), "stars")
    links = compare(base, may_link(stars, signs, percent), percent, hasher)
    joined = staged(components(links), "joined")
    cluster = stars.select(F.col("b").alias("c"), F.least("a", "b").alias("cluster"))
    for _ in range(LEADERS_UP):
        cluster = cluster.join(stars.select(F.col("b").alias("cluster"), F.col("a").alias("next")), "cluster", "left").select("c", F.least("cluster", "next").alias("cluster"))
    about = cluster.join(joined.select(F.col("id").alias("c"), "component"), "c", "full")
    placed = shared.drop("lead").join(about, "c", "left").select("key", "c", "n", "rest", F.coalesce("component", "c").alias("comp"), F.coalesce("cluster", "c").alias("cluster"))
    placed = staged(placed, "placed")
    of_key = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("sharers")).filter("c0 <> c1")
    open_rows = staged(placed.join(of_key.select("key", (F.col("sharers") <= FEW).alias("few")), "key"), "open")
    groups = joined.select(F.col("id").alias("c"), F.col("component").alias("comp"))
    # a link between groups stands for others of the two, so it must be one on the words too
    asked = staged(tile_links(base, signs, open_rows, groups, percent, hasher), "asked")
    more = compare(base, asked, percent, hasher)
    if more.count() < asked.count():
        return None
    found = staged(components(links.union(more)), "found")

    out = summary.join(classes, "digest", "left").withColumn("class", F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("id")))
    out = out.join(found.withColumnRenamed("id", "class"), "class", "left")
    known = F.col("id").isNotNull()
    return out.select("id", "n", F.when(known, F.col("class")).alias("class"), F.when(known, F.coalesce("component", "class")).alias("component"))
