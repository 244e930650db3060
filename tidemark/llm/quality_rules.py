"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on a bounded sample of labelled rows; every path from a root is a conjunctive rule. A lasso
logistic regression keeps the rules that matter, and these are compiled into one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHasher, slices, text_buffer, word_bounds

#: Labelled rows that are fitted at most, those with the smallest hash of their id; scoring has no bound.
SAMPLE = 20_000
STATS = ("log_words", "mean_word", "long_words", "upper", "digits", "symbols", "bangs", "pipes", "stops", "commas", "distinct", "top_word", "repeats", "lines", "short_lines", "non_ascii")
_KIND = np.zeros(256, np.uint8)
for _k, _bytes in enumerate((range(65, 91), range(48, 58), b"#$%&*@^~<>{}[]\\=_+", b"!", b"|", b".?", b",;:"), 1):
    _KIND[list(_bytes)] = _k
_HASH = WordHasher(11)


def text_stats(column: pa.Array) -> dict[str, np.ndarray]:
    """Statistics of every text of an Arrow column, in one pass over its bytes; an empty or null text gives zeros."""
    buf, offsets = text_buffer(column)
    rows = len(offsets) - 1
    starts, ends, first = word_bounds(buf, offsets)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    size = ends - starts
    word_row = np.repeat(np.arange(rows), np.diff(first))

    def per_row(values: np.ndarray, row: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=values, minlength=rows)[:rows] if len(row) else np.zeros(rows)

    chars = np.maximum(per_row(size.astype(float), word_row), 1)
    kind = _KIND[buf]
    at = np.flatnonzero(kind)
    by_kind = np.bincount((np.searchsorted(offsets, at, "right") - 1) * 8 + kind[at], minlength=rows * 8)[: rows * 8].reshape(rows, 8) if len(at) else np.zeros((rows, 8))
    high = np.flatnonzero(buf >= 0xC0)
    h = _HASH(buf, starts, ends)
    order = np.lexsort((h, word_row))
    sh, sr = h[order], word_row[order]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (sr[1:] != sr[:-1])
    group = np.flatnonzero(new)
    many = np.diff(np.append(group, len(sh)))
    top = np.zeros(rows)
    np.maximum.at(top, sr[group], many)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1])
    newline = np.flatnonzero(buf == 10)
    line_row = np.searchsorted(offsets, newline, "right") - 1
    lines = per_row(np.ones(len(newline)), line_row) + 1
    return {
        "log_words": np.log1p(words), "mean_word": chars * (words > 0) / some, "long_words": per_row((size > 20).astype(float), word_row) / some,
        "upper": by_kind[:, 1] / chars, "digits": by_kind[:, 2] / chars, "symbols": by_kind[:, 3] / chars, "bangs": by_kind[:, 4] / some, "pipes": by_kind[:, 5] / some,
        "stops": by_kind[:, 6] / some, "commas": by_kind[:, 7] / some, "distinct": per_row(np.ones(len(group)), sr[group]) / some, "top_word": top / some,
        "repeats": per_row(again, word_row) / some, "lines": np.log1p(lines), "short_lines": lines / some, "non_ascii": per_row(np.ones(len(high)), np.searchsorted(offsets, high, "right") - 1) / chars,
    }


def with_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col (as `id`) and the statistics of every row's whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                stats = text_stats(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(stats[c], pa.float64()) for c in STATS)], names=["id", *STATS])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} double" for c in STATS))


Rule = tuple[tuple[str, bool, float], ...]  # (statistic, above, bound): all must hold; above means > bound, else <= bound


@dataclass
class RuleEnsemble:
    bias: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self, prior: float = 0.0) -> Column:
        """The score as a Spark column over the statistics."""
        total = F.lit(self.bias + prior)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for stat, above, bound in rule:
                holds = holds & ((F.col(stat) > F.lit(bound)) if above else (F.col(stat) <= F.lit(bound)))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The same score in numpy, for rows of STATS."""
        total = np.full(len(x), self.bias)
        for rule, weight in self.rules:
            total += weight * holds(rule, x)
        return 1 / (1 + np.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for stat, above, bound in rule:
        v = x[:, STATS.index(stat)]
        out &= v > bound if above else v <= bound
    return out


def grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, w: np.ndarray, rows: np.ndarray, depth: int, path: Rule, rate: float, out: list[Rule], add: np.ndarray) -> None:
    """One regression tree on gradients g with curvatures w: appends the rule of every node below the root, adds the leaves' steps to add."""
    best, at = 1e-6, None
    if depth:
        gt, wt = g[rows].sum(), w[rows].sum() + 1.0
        for j in range(x.shape[1]):
            if not len(cuts[j]):
                continue
            n = len(cuts[j]) + 1
            b = bins[rows, j]
            gl = np.cumsum(np.bincount(b, weights=g[rows], minlength=n))[:-1]
            wl = np.cumsum(np.bincount(b, weights=w[rows], minlength=n))[:-1] + 1.0
            nl = np.cumsum(np.bincount(b, minlength=n))[:-1]
            gain = gl**2 / wl + (gt - gl) ** 2 / (wt - wl + 2.0) - gt**2 / wt
            gain[(nl < 5) | (len(rows) - nl < 5)] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = gain[k], (j, k)
    if path:
        out.append(path)
    if at is None:
        add[rows] += rate * g[rows].sum() / (w[rows].sum() + 1.0)
        return
    j, k = at
    low = bins[rows, j] <= k
    for above, part in ((False, rows[low]), (True, rows[~low])):
        grow(x, bins, cuts, g, w, part, depth - 1, (*path, (STATS[j], above, float(cuts[j][k]))), rate, out, add)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, rounds: int = 600) -> RuleEnsemble:
    """Trees, their rules, and lasso logistic weights by accelerated proximal steps. Deterministic."""
    if not len(x) or y.min() == y.max():
        return RuleEnsemble(bias=0.0 if not len(x) else (3.0 if y[0] else -3.0))
    cuts = []
    for j in range(x.shape[1]):
        u = np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1], method="lower"))
        cuts.append(u[u < x[:, j].max()])
    bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    share = y.mean()
    f = np.full(len(x), np.log(share / (1 - share)))
    found: list[Rule] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        add = np.zeros(len(x))
        grow(x, bins, cuts, y - p, p * (1 - p), np.arange(len(x)), depth, (), 0.3, found, add)
        f += add
    rules, seen = [], set()
    z = []
    for rule in found:
        v = holds(rule, x)
        mark = v.tobytes()
        if v.any() and not v.all() and mark not in seen and (~v).tobytes() not in seen:
            seen.add(mark)
            rules.append(rule)
            z.append(v)
    z = np.stack(z, 1).astype(float) if z else np.zeros((len(x), 0))
    mean, scale = z.mean(0), np.maximum(z.std(0), 0.05)
    zs = (z - mean) / scale
    step = 4 / (np.linalg.norm(zs, 2) ** 2 / len(x) + 1)
    w = v = np.zeros(zs.shape[1])
    b, t = float(np.log(share / (1 - share))), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(zs @ v + b)))
        new = v - step * (zs.T @ (p - y)) / len(x)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        b -= step * float((p - y).mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    weight = w / scale
    kept = [(r, float(c)) for r, c in zip(rules, weight, strict=True) if abs(c) > 1e-4]
    return RuleEnsemble(bias=float(b - (mean * weight).sum()), rules=kept)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> RuleEnsemble:
    """Fits on labelled rows of docs: the `sample` rows (default 20,000) with the smallest hash of their id.

    Rows whose label is null or other than 0 and 1, or whose id is null, are left out; with no row of one class the score
    is a constant. Repeated labels of an id each count once a row of the join.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1) and id is not null")
    few = marks.orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    few = F.broadcast(few)  # `sample` rows at most
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(few.select("id").distinct(), "id", "left_semi")
    rows = with_stats(texts, "id", "text").join(few, "id").select("id", "y", *STATS).collect()
    rows.sort(key=lambda r: (str(r.id), r.y))
    x = np.array([[r[c] for c in STATS] for r in rows], float).reshape(len(rows), len(STATS))
    return fit(x, np.array([r.y for r in rows], float))


def score_quality(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score (0 to 1) of every row.

    Only the text is read; a null text counts as empty, and an empty one is scored by its zeros. Repeated rows each give a
    row; an empty table gives none; other columns are ignored, whatever their names.
    """
    return with_stats(docs, id_col, text_col).select(F.col("id").alias(id_col), model.column().alias("score"))
