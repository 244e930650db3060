"""Byte-level BPE encoding and decoding.

Every piece of the split pattern has a segment tree over its byte positions. A leaf holds the rank of the pair that begins
there (none: infinity), an inner node the leftmost minimum below it; a merge reads the root and sets three leaves, each a
walk of log n nodes. Short pieces of a batch are merged side by side in numpy, one tree a row; long ones one at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, slices

INF = 1 << 62
#: Pieces up to this many bytes share a numpy forest; a longer one has a tree of its own.
FOREST_BYTES = 128
#: Entries of a forest, and pieces that a task remembers before it forgets those that came in one batch only.
FOREST_CELLS, MEMORY = 1 << 17, 250_000
#: Bytes of text whose pieces are encoded together.
BATCH_BYTES = 1 << 20


class ByteBPE:
    """Encoder and decoder for one rank file (lines of base64 token and rank)."""

    def __init__(self, lines: list[tuple[bytes, int]], pattern: str):
        self.ranks = dict(lines)
        self.tokens = {r: t for t, r in lines}
        self.split = regex.compile(pattern).findall
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in lines:
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[int(k)] for k in self.keys], np.int64)

    @classmethod
    def load(cls, data: bytes, pattern: str) -> ByteBPE:
        return cls([(base64.b64decode(a), int(b)) for a, b in map(bytes.split, data.splitlines()) if a], pattern)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; INF where it is no token."""
        if not len(self.keys):
            return np.full(len(a), INF, np.int64)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], INF)

    def merge_one(self, piece: bytes) -> list[int]:
        """The ids of one piece from its own tree."""
        n, m = len(piece), 1 << max(1, (len(piece) - 1).bit_length())
        tok = [int(self.byte[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.pairs.get
        tree = [INF] * (2 * m)
        for i in range(n - 1):
            if (r := get(tok[i] << 32 | tok[i + 1])) is not None:
                tree[m + i] = r * m + i
        for k in range(m - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, value: int) -> None:
            k = m + i
            tree[k] = value
            while k > 1:
                k >>= 1
                low = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == low:
                    break
                tree[k] = low

        while tree[1] < INF:
            rank, i = divmod(tree[1], m)
            j = after[i]
            tok[i], tok[j], k = rank, -1, after[j]
            after[i] = k
            put(j, INF)
            if k < n:
                before[k] = i
                r = get(rank << 32 | tok[k])
                put(i, INF if r is None else r * m + i)
            else:
                put(i, INF)
            if (p := before[i]) >= 0:
                r = get(tok[p] << 32 | rank)
                put(p, INF if r is None else r * m + p)
        return [t for t in tok if t >= 0]

    def merge_forest(self, pieces: list[bytes], m: int) -> list[list[int]]:
        """The ids of pieces of up to m bytes (m a power of two, 2 at least): one row of the forest each."""
        n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(m, b"\0") for p in pieces), np.uint8).reshape(n, m)
        place = np.arange(m)
        tok = np.where(place < size[:, None], self.byte[raw], -1)
        after = np.broadcast_to(place + 1, (n, m)).copy()
        before = np.broadcast_to(place - 1, (n, m)).copy()
        tree = np.full((n, 2 * m), INF, np.int64)
        pair = self._rank(np.maximum(tok[:, :-1], 0).ravel(), np.maximum(tok[:, 1:], 0).ravel()).reshape(n, m - 1)
        pair = np.where(place[1:] < size[:, None], pair, INF)
        tree[:, m : 2 * m - 1] = np.where(pair < INF, pair * m + place[:-1], INF)
        k = m
        while k > 1:
            k >>= 1
            tree[:, k : 2 * k] = np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2])
        rows = np.flatnonzero(tree[:, 1] < INF)
        while len(rows):
            rank, i = np.divmod(tree[rows, 1], m)
            j = after[rows, i]
            k = after[rows, j]
            tok[rows, i], tok[rows, j], after[rows, i] = rank, -1, k
            last = k >= size[rows]
            on = np.where(last, 0, k)
            before[rows[~last], k[~last]] = i[~last]
            p = before[rows, i]
            first = p < 0
            back = np.where(first, i, p)
            right = np.where(last, INF, self._rank(rank, np.maximum(tok[rows, on], 0)))
            left = self._rank(np.maximum(tok[rows, back], 0), rank)
            tree[rows, m + j] = INF
            tree[rows, m + i] = np.where(right < INF, right * m + i, INF)
            some = ~first
            tree[rows[some], m + p[some]] = np.where(left < INF, left * m + p, INF)[some]
            nodes = [m + j, m + i, m + back]
            for _ in range(m.bit_length() - 1):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
            rows = rows[tree[rows, 1] < INF]
        return [[t for t in row if t >= 0] for row in tok.tolist()]

    def encode_pieces(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of distinct pieces; a piece that is a token as it stands is that token."""
        out: dict[str, list[int]] = {}
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            if (whole := self.ranks.get(raw)) is not None:
                out[piece] = [whole]
            elif len(raw) > FOREST_BYTES:
                out[piece] = self.merge_one(raw)
            else:
                by_size.setdefault(1 << max(1, (len(raw) - 1).bit_length()), []).append((piece, raw))
        for m, some in by_size.items():
            step = max(1, FOREST_CELLS // (2 * m))
            for i in range(0, len(some), step):
                part = some[i : i + step]
                out.update(zip((p for p, _ in part), self.merge_forest([r for _, r in part], m), strict=True))
        return out

    def encode(self, text: str) -> list[int]:
        pieces = self.split(text)
        known = self.encode_pieces(list(set(pieces)))
        return [i for p in pieces for i in known[p]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


#: Encoders of this worker, by digest of the rank file and pattern.
_LOADED: dict[tuple[str, str], ByteBPE] = {}


def encoder(key: str, data: bytes, pattern: str) -> ByteBPE:
    """The worker's encoder. (Tasks call it by name, so they share _LOADED; a table named in the task's own function is sent with it, empty.)"""
    if (key, pattern) not in _LOADED:
        _LOADED[key, pattern] = ByteBPE.load(data, pattern)
    return _LOADED[key, pattern]


def byte_bpe(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """Encodes and decodes the text of every row.

    docs: any table with id_col (any type) and text_col; other columns are ignored, whatever their names. A null text counts
    as empty: no ids, empty bytes. Repeated rows each give a row; an empty table gives none. Text of any length is encoded
    whole. rank_file is read once on the driver and sent to the tasks (a vocabulary: its size doesn't depend on the data).

    Returns id_col, n_tokens long, ids array<int> (if ids), ids_sha256 and decoded_sha256.
    """
    with open(rank_file, "rb") as f:
        ranks = f.read()
    data, key = docs.sparkSession.sparkContext.broadcast(ranks), hashlib.sha256(ranks).hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, memory, again = encoder(key, data.value, pattern), {}, set()
        for whole in batches:
            for batch in slices(whole, "text", BATCH_BYTES):
                split = [bpe.split(t or "") for t in batch.column("text").to_pylist()]
                new = {p for pieces in split for p in pieces}
                again |= new & memory.keys()
                if len(memory) + len(new) > MEMORY:
                    memory, again = {p: memory[p] for p in again if len(again) + len(new) <= MEMORY}, set()
                for piece, found in bpe.encode_pieces([p for p in new if p not in memory]).items():
                    memory[piece] = (" ".join(map(str, found)), bpe.decode(found), len(found))
                cols: dict[str, list] = {"n": [], "ids": [], "text": [], "sha": []}
                for pieces in split:
                    got = [memory[p] for p in pieces]
                    line = " ".join([g[0] for g in got])
                    cols["n"].append(sum([g[2] for g in got]))
                    cols["text"].append(hashlib.sha256(line.encode()).hexdigest())
                    cols["sha"].append(hashlib.sha256(b"".join([g[1] for g in got])).hexdigest())
                    if ids:
                        cols["ids"].append(np.array(line.split(), np.int32) if line else np.zeros(0, np.int32))
                out = [batch.column("id"), pa.array(cols["n"], pa.int64())]
                out += [pa.array(cols["ids"], pa.list_(pa.int32()))] * ids
                yield pa.RecordBatch.from_arrays([*out, pa.array(cols["text"]), pa.array(cols["sha"])], names=["id", "n_tokens", *["ids"] * ids, "ids_sha256", "decoded_sha256"])
        whole = batch = split = new = cols = out = memory = again = None
        give_back()

    schema = f"id {kind}, n_tokens long, " + "ids array<int>, " * ids + "ids_sha256 string, decoded_sha256 string"
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
