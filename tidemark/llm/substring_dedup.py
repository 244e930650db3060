"""Substring dedup with a count-min prefilter.

Documents are dealt into buckets of a few MB; all passes read that one exchange.

1. Each bucket makes a sketch: the cell of every window of 13 words, counted once a document. Sketches are sparse and cut
   into blocks of cells; merging a block's sketches over all buckets gives counts that never fall short of the true ones.
2. Each bucket gets back which of its cells have a merged count of two or more. Only windows in such cells are digested
   (BLAKE2b, 128 bits of the words themselves) and grouped exactly, one row for each digest and bucket, so that a
   passage in a third of all documents still gives one row a bucket at most.
3. Each bucket learns which of its digests begin in a smaller document elsewhere and removes the covered words.

A window that repeats raises its cell's count to two, whatever else falls in the cell: none is lost. The width of the
sketch follows the number of windows (sixteen cells a window), so false candidates stay near one in sixteen at any size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WordHasher, rolled, text_buffer, word_bounds

WINDOW = 13
#: Text of a bucket, windows of a block and cells of a block.
BUCKET_BYTES, BLOCK_WINDOWS, BLOCK_CELLS = 4 << 20, 1 << 22, 1 << 26
#: Copies of one text from which they are dealt out to several buckets; at most so many texts are dealt out.
HOT_COPIES, MOST_HOT = 1000, 100_000
#: Copies of such a text that go to a bucket.
COPIES_A_BUCKET = 256

_HASH = WordHasher(3)
_LAST = np.iinfo(np.int64).max  # a null id: after all others


class Bucket:
    """The documents of one bucket; exact copies of a text are looked at once, under their smallest id."""

    def __init__(self, table: pa.Table, window: int):
        ids = table.column("doc_id").combine_chunks()
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        self.window = window
        texts = table.column("text").to_pylist()
        order = np.argsort(self.ids, kind="stable")
        held: dict[str, int] = {}
        self.copy_of = np.empty(len(texts), np.int64)  # place among the distinct texts
        first = []
        for i in order:
            t = texts[i] or ""
            if t not in held:
                held[t] = len(first)
                first.append(i)
            self.copy_of[i] = held[t]
        self.first = np.array(first, np.int64)
        self.buf, offsets = text_buffer(pa.array(list(held), pa.large_string()))
        self.starts, self.ends, self.words = word_bounds(self.buf, offsets)
        h = _HASH(self.buf, self.starts, self.ends)
        k = rolled(h, window, 0x9E3779B97F4A7C15 | 1)
        doc = np.repeat(np.arange(len(first)), np.diff(self.words))
        whole = doc[: len(k)] == doc[window - 1 :] if len(k) else np.zeros(0, bool)
        self.at = np.flatnonzero(whole)  # word at which each window begins
        self.doc, self.key = doc[self.at], k[self.at]

    def cells(self, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, cell in it) of every window."""
        block = ((self.key >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        return block.astype(np.int64), (self.key & np.uint64(BLOCK_CELLS - 1)).astype(np.int64)

    def digests(self, some: np.ndarray) -> np.ndarray:
        """128-bit digests (n x 2) of the windows at places `some` of self.at, taken of their words joined by a space."""
        out = bytearray()
        raw, last, joined, place = self.buf.tobytes(), -1, b"", np.zeros(0, np.int64)
        base = 0
        for w, d in zip(self.at[some].tolist(), self.doc[some].tolist(), strict=True):
            if d != last:
                base, end = int(self.words[d]), int(self.words[d + 1])
                s, e = self.starts[base:end].tolist(), self.ends[base:end].tolist()
                joined = b" ".join([raw[a:b] for a, b in zip(s, e, strict=True)])
                place = np.concatenate(([0], np.cumsum(self.ends[base:end] - self.starts[base:end] + 1))).tolist()
                last = d
            out += hashlib.blake2b(joined[place[w - base] : place[w - base + self.window] - 1], digest_size=16).digest()
        return np.frombuffer(bytes(out), np.int64).reshape(-1, 2)

    def candidates(self, notes: list[tuple[int, bytes]], blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, number of its digest, distinct digests) of the windows whose merged count is two or more."""
        block, cell = self.cells(blocks)
        told = np.sort(np.concatenate([b * BLOCK_CELLS + unpack(x) for b, x in notes])) if notes else np.zeros(0, np.int64)
        key = block * BLOCK_CELLS + cell
        some = np.flatnonzero(told[np.minimum(np.searchsorted(told, key), len(told) - 1)] == key) if len(told) else np.zeros(0, np.int64)
        digest = self.digests(some)
        pairs = np.ascontiguousarray(digest).view([("a", np.int64), ("b", np.int64)]).ravel()
        distinct, number = np.unique(pairs, return_inverse=True)
        return some, number, distinct

    def least(self, some: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
        """Smallest id in this bucket that has each digest."""
        out = np.full(n, _LAST, np.int64)
        np.minimum.at(out, number, self.ids[self.first][self.doc[some]])
        return out


def pack(sorted_cells: np.ndarray) -> bytes:
    """Gaps of sorted cells as four byte planes; the upper ones are nearly all zero and compress away."""
    return np.diff(sorted_cells, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


def bucketed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """(doc_id, text, bucket) dealt out by bucket, the number of buckets and of blocks. Copies of a text share buckets."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    total = base.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    buckets = max(1, -(-(total["size"] or 0) // BUCKET_BYTES))
    # at most MOST_HOT texts can have more copies than this, whatever the input: the table is safe to broadcast
    bound = max(HOT_COPIES, total.n // MOST_HOT)
    hot = base.groupBy(h.alias("h")).count().filter(F.col("count") > bound).select("h", F.ceil(F.col("count") / COPIES_A_BUCKET).alias("parts"))
    keyed = base.withColumn("h", h).join(F.broadcast(hot), "h", "left")
    spread = F.when(F.col("parts").isNull(), F.col("h")).otherwise(F.xxhash64("h", F.pmod(F.xxhash64("doc_id"), "parts")))
    dealt = keyed.select("doc_id", "text", F.pmod(spread, F.lit(buckets)).cast("int").alias("bucket"))
    tasks = max(1, min(buckets, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 4)))
    return dealt.repartition(tasks, "bucket"), buckets, max(1, -(-(total["size"] or 0) // (6 * BLOCK_WINDOWS)))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Removes every word covered by a window of words that also starts in a document with a smaller id.

    Words are runs of anything but space and \\t..\\r. All windows are judged on the input. id_col is read as a long; rows
    with a null id come after all others and don't remove each other, nor do rows with one id. A null text has no words;
    empty and short texts (fewer words than the window) lose nothing. Repeated rows each give a row; an empty table gives
    none. Other columns are ignored, whatever their names. A text of any length is one unit of work.

    Returns doc_id, n_words, n_removed long, kept_sha256 string and, if asked for, kept_text (kept words joined by a space).
    """
    dealt, _, blocks = bucketed(docs, id_col, text_col)

    def sketch(table: pa.Table) -> pa.Table:
        bucket = Bucket(table, window)
        block, cell = bucket.cells(blocks)
        # a cell counts once a document
        key = block * BLOCK_CELLS + cell
        order = np.argsort(key, kind="stable")  # documents stay in order within a cell
        key, doc = key[order], bucket.doc[order]
        key = key[(np.diff(key, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0)]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        cells, docs_in = key[at], np.diff(np.append(at, len(key)))
        cut = np.searchsorted(cells, np.arange(blocks + 1) * BLOCK_CELLS)
        rows = [(b, pack(cells[i:k] - b * BLOCK_CELLS), np.packbits(docs_in[i:k] > 1).tobytes()) for b, (i, k) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if k > i]
        number = table.column("bucket")[0].as_py()
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int32()), "bucket": pa.array([number] * len(rows), pa.int32()), "cells": pa.array([r[1] for r in rows], pa.binary()), "many": pa.array([r[2] for r in rows], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        each = [unpack(x) for x in table.column("cells").to_pylist()]
        many = [c[np.unpackbits(np.frombuffer(m, np.uint8), count=len(c)).astype(bool)] for c, m in zip(each, table.column("many").to_pylist(), strict=True)]
        merged = np.sort(np.concatenate([*each, *many]))
        again = np.unique(merged[1:][merged[1:] == merged[:-1]])
        kept = [c[again[np.minimum(np.searchsorted(again, c), len(again) - 1)] == c] if len(again) else c[:0] for c in each]
        rows = [(b, pack(c)) for b, c in zip(table.column("bucket").to_pylist(), kept, strict=True) if len(c)]
        n = len(rows)
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([block] * n, pa.int32()), "cells": pa.array([r[1] for r in rows], pa.binary()), "a": pa.nulls(n, pa.int64()), "b": pa.nulls(n, pa.int64())})

    def noted(notes: pa.Table) -> list[tuple[int, bytes]]:
        return [(b, x) for b, x in zip(notes.column("block").to_pylist(), notes.column("cells").to_pylist(), strict=True) if x is not None]

    def digest(key: tuple, table: pa.Table, notes: pa.Table) -> pa.Table:
        bucket = Bucket(table, window)
        some, number, distinct = bucket.candidates(noted(notes), blocks)
        least = bucket.least(some, number, len(distinct))
        return pa.table({"a": distinct["a"], "b": distinct["b"], "bucket": pa.array(np.full(len(distinct), key[0].as_py(), np.int32)), "least": least})

    def remove(key: tuple, table: pa.Table, notes: pa.Table) -> pa.Table:
        bucket = Bucket(table, window)
        some, number, distinct = bucket.candidates(noted(notes), blocks)
        least = bucket.least(some, number, len(distinct))
        a, b = notes.column("a").combine_chunks().drop_null(), notes.column("b").combine_chunks().drop_null()
        told = np.zeros(len(a), distinct.dtype)
        told["a"], told["b"] = a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False)
        elsewhere = np.isin(distinct, told)
        ids = bucket.ids[bucket.first]
        gone = bucket.at[some[(ids[bucket.doc[some]] > least[number]) | elsewhere[number]]]
        covered = np.zeros(len(bucket.starts) + 1, np.int64)
        np.add.at(covered, gone, 1)
        np.add.at(covered, gone + window, -1)
        covered = np.cumsum(covered)[:-1] > 0
        raw = bucket.buf.tobytes()
        kept = []
        for d in range(len(bucket.first)):
            i, k = int(bucket.words[d]), int(bucket.words[d + 1])
            free = np.flatnonzero(~covered[i:k]) + i
            text = b" ".join([raw[s:e] for s, e in zip(bucket.starts[free].tolist(), bucket.ends[free].tolist(), strict=True)])
            kept.append((k - i, k - i - len(free), text))
        out: dict[str, list] = {"n": [], "gone": [], "text": []}
        for i, c in enumerate(bucket.copy_of):
            n, less, text = kept[c]
            if bucket.ids[i] > ids[c] and n >= window:  # a copy of a text in a smaller document
                less, text = n, b""
            out["n"].append(n)
            out["gone"].append(less)
            out["text"].append(text)
        cols = {"doc_id": table.column("doc_id"), "n_words": pa.array(out["n"], pa.int64()), "n_removed": pa.array(out["gone"], pa.int64()), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in out["text"]], pa.string())}
        return pa.table(cols | ({"kept_text": pa.array([t.decode("utf-8", "surrogatepass") for t in out["text"]], pa.string())} if with_text else {}))

    note = "bucket int, block int, cells binary, a long, b long"
    sketches = dealt.groupBy("bucket").applyInArrow(sketch, "block int, bucket int, cells binary, many binary")
    repeated = sketches.groupBy("block").applyInArrow(merge, note)
    keys = dealt.groupBy("bucket").cogroup(repeated.groupBy("bucket")).applyInArrow(digest, "a long, b long, bucket int, least long")
    # a digest has one row a bucket, so a window function's group can't exceed the number of buckets
    elsewhere = keys.withColumn("first", F.min("least").over(Window.partitionBy("a", "b"))).filter("least > first")
    notes = repeated.union(elsewhere.select("bucket", F.lit(None).cast("int"), F.lit(None).cast("binary"), "a", "b"))
    kept = ", kept_text string" if with_text else ""
    return dealt.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(remove, f"doc_id long, n_words long, n_removed long, kept_sha256 string{kept}")


