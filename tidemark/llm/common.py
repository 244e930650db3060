"""What several operators share: word hashing on whole Arrow columns, staged tables and connected components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that separates words, as a Java character class and as single characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"

#: Bytes of text that are worked on at a time, so that the work arrays stay small whatever the Arrow batch holds.
SLICE_BYTES = 1 << 18

#: Edges that one task contracts by itself.
EDGES_A_TASK = 1 << 18

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: spark.checkpoint.dir. Where that is unset, a new one if all of Spark runs in this
    process (as in tests); on a cluster that is an error, as no folder of one machine will do."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """While it holds, the session has this setting."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends there and a lost executor costs no recomputation.
    Nothing reads the job's shuffle files after that, so they go when the table is written."""
    path = scratch_path(df.sparkSession, name)
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *wanted: str) -> str:
    """A column name that clashes with none of df's."""
    name = "_".join(wanted)
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Two primes below 2 ** 31.
PRIMES = (2147483647, 2147483629)
#: Bytes up to which sums of (byte + 1) * power can't pass 2 ** 63; longer words are reduced byte by byte.
SAFE_SUM = 1 << 22


class WordHasher:
    """Hashes of all words of a text buffer from prefix sums; no loop over words.

    A word is a polynomial in its bytes, taken at one point of each of two prime fields. Two different words of n bytes agree
    at points drawn at random with a chance of at most (n / 2 ** 31) ** 2, whatever their structure; at points that are known
    (a fixed seed) such words can be made.
    """

    def __init__(self, seed: int):
        drawn = mix(np.arange(1, 3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)).tolist()
        self._points = [2 + x % (p - 2) for x, p in zip(drawn, PRIMES, strict=True)]
        self._powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in PRIMES]

    def _grow(self, n: int) -> None:
        """Powers of the points and of their inverses up to n of them."""
        for k, (p, x) in enumerate(zip(PRIMES, self._points, strict=True)):
            both = []
            for have, base in zip(self._powers[k], (x, pow(x, -1, p)), strict=True):
                while len(have) < n:
                    have = np.concatenate([have, have * np.uint64(pow(base, len(have), p)) % np.uint64(p)])
                both.append(have)
            self._powers[k] = (both[0], both[1])

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            k = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
            a, b = int(starts[i]), int(ends[k - 1])
            self._grow(b - a + 1)
            s, e = starts[i:k] - a, ends[i:k] - a
            digits = buf[a:b].astype(np.uint64) + np.uint64(1)
            sums = np.zeros(b - a + 1, np.uint64)
            values = []
            for p, (powers, inverses) in zip(PRIMES, self._powers, strict=True):
                terms = digits * powers[: b - a]
                np.cumsum(terms if b - a <= SAFE_SUM else terms % np.uint64(p), out=sums[1:])
                values.append((sums[e] - sums[s]) % np.uint64(p) * inverses[s] % np.uint64(p))
            out[i:k] = mix((values[0] << np.uint64(31) | values[1]) + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            i = k
        return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, n + 1 offsets) of a string column; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[at[0] : at[-1]], at - at[0]


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte bounds of all words; text i has the words first[i]..first[i + 1] - 1."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[buf]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(buf))]
    start[inner] = word[inner]
    end[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `most` bytes of text; one row at least."""
    _, offsets = text_buffer(batch.column(text))
    i = 0
    while i < batch.num_rows:
        k = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield batch.slice(i, k - i)
        i = k


def give_back() -> None:
    """Hands what the C library holds of freed memory back to the system, where it can (glibc): a Python worker waits a minute for its
    next task, beside an executor that may be busy with something else."""
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def rolled(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of every run of k consecutive entries of h (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for j in range(k):
            out = out * np.uint64(base) + h[j : j + n]
    return mix(out)


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars (u, v) that join what a task's edges (u, v) join; v is the smallest id reachable over them."""
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        us.append(batch.column("u").to_numpy())
        vs.append(batch.column("v").to_numpy())
    ids, place = np.unique(np.concatenate([*us, *vs]), return_inverse=True)
    i, j = place[: len(place) // 2], place[len(place) // 2 :]
    root = np.arange(len(ids))
    while True:
        new = root.copy()
        np.minimum.at(new, root[i], root[j])
        np.minimum.at(new, root[j], root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = root != np.arange(len(ids))
    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[root[some]])], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over undirected edges (a, b), for every id that has an edge to another.

    Every task first contracts EDGES_A_TASK of the edges to stars. While there is more than one such task, large-star and
    small-star contractions alternate until nothing changes: every step is an aggregation with map-side combine and a join
    of staged tables, so no component is ever gathered in a task.
    """
    pairs = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    tasks = max(1, -(-pairs.count() // EDGES_A_TASK))
    pairs = staged(pairs.repartition(tasks).mapInArrow(forest, "u long, v long"), "edges")
    sums = None
    while tasks > 1:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = staged(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct(), "edges")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u > v").distinct()
        pairs = staged(small, "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sums:
            break
        sums = now
    stars = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())
