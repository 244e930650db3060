"""Multilingual mixture inference of a document's languages.

A language is a distribution over hashed letter trigrams, counted over all learning rows. A document is a mixture of
languages: expectation-maximisation estimates its proportions, and a penalised likelihood (half a log of the number of its
trigrams for each further language) selects the set of languages, grown from the best single one: each step takes the
language that adds most, of all that are learned, until none adds more than its penalty. What a language adds is measured where
the estimation has converged, or is proven to be too little before.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, give_back, mix, slices

#: Hash cells of the trigrams. A language model is one row of so many counts, so the model's size is cells x languages.
CELLS = 1 << 14
#: More languages than this are refused: the model that is sent to the tasks stays below 64 MB.
MOST_LANGUAGES = 512
UND = "und"
#: A likelihood counts as the greatest when it is this near, in penalties; and text that is worked on at a time, in bytes x languages.
CLOSE, WORK = 0.01, 1 << 21
#: Documents whose keys are sorted together (keys fit 31 bits).
MOST_SORTED = (1 << 31) // CELLS - 1
_LETTER: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """True for the code points of Unicode's letter categories."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def trigram_cells(text: str) -> np.ndarray:
    """Hash cells of the trigrams around every letter of the lower-cased text; anything but a letter counts as a space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    c = np.zeros(len(points) + 2, np.uint64)
    c[1:-1] = np.where(letter, points, 0)
    key = (c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:])[letter]
    return (mix(key * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(CELLS - 1)).astype(np.int64)


def id_hash(column: str) -> F.Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def language_counts(docs: DataFrame) -> DataFrame:
    """(lang, cell, n): trigrams of all rows of docs (text, lang), summed in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                cells = trigram_cells(text)
                if len(cells):
                    held.setdefault(lang, np.zeros(CELLS, np.int64))
                    held[lang] += np.bincount(cells, minlength=CELLS)
                if len(held) > MOST_LANGUAGES:
                    raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "cell", "n"])

    return docs.select("text", "lang").filter("text is not null and lang is not null").mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


class MixtureModel:
    """Trigram distributions of the learned languages, in order of their names."""

    def __init__(self, langs: list[str], logs: np.ndarray):
        self.langs, self.log_p, self.p = langs, logs, np.exp(logs)  # cells x languages

    @classmethod
    def fit(cls, docs: DataFrame) -> MixtureModel:
        """Counts cover every row; what reaches the driver is one sparse row of at most CELLS counts a language."""
        rows = language_counts(docs).groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("cells")).orderBy("lang").collect()
        if len(rows) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
        counts = np.zeros((CELLS, len(rows)))
        for k, row in enumerate(rows):
            for c, n in row.cells:
                counts[c, k] = n
        share = (counts + 0.5) / (counts.sum(0) + 0.5 * CELLS)
        return cls([r.lang for r in rows], np.log(share))

    @staticmethod
    def climb(p: np.ndarray, n: np.ndarray, size: np.ndarray, pi: np.ndarray, enough: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions (documents x columns of p) from a start pi, and log-likelihoods, for all documents side by side.

        Each document's expectation-maximisation, with squared extrapolation over two steps, goes on until its likelihood is
        proven to be within `enough` of the greatest there is, or the greatest proven not to be above `floor`. The
        likelihood is concave, so it can't rise by more than the steepest slope from here to a single language.
        """
        out, value = pi.copy(), np.full(len(pi), -np.inf)
        live = np.arange(len(pi))
        first, doc = np.cumsum(size) - size, np.repeat(np.arange(len(pi)), size)
        total = np.add.reduceat(n, first)

        def look(pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            mass = np.maximum(np.einsum("ij,ij->i", p, pi[doc]), 1e-300)
            return np.add.reduceat(n * np.log(mass), first), np.add.reduceat(p * (n / mass)[:, None], first, axis=0)

        while len(live):
            like, slope = look(pi)
            gap = slope.max(1) - total
            better = like > value[live]
            value[live[better]], out[live[better]] = like[better], pi[better]
            # 1e-12: what adding up so many logarithms may round
            done = (gap <= np.maximum(enough[live], 1e-12 * np.abs(like))) | (like + gap <= floor[live])
            if done.any():
                left, rows = ~done, ~done[doc]
                live, pi, slope, total, p, n, size = live[left], pi[left], slope[left], total[left], p[rows], n[rows], size[left]
                first, doc = np.cumsum(size) - size, np.repeat(np.arange(len(live)), size)
                if not len(live):
                    break
            one = pi * slope / total[:, None]
            base, slope = look(one)
            two = one * slope / total[:, None]
            step, bend = one - pi, two - one - (one - pi)
            length = np.sqrt((step**2).sum(1) / np.maximum((bend**2).sum(1), 1e-300))[:, None]
            far = np.maximum(pi + 2 * np.maximum(length, 1) * step + np.maximum(length, 1) ** 2 * bend, 1e-9)
            far /= far.sum(1, keepdims=True)
            pi = np.where((look(far)[0] >= base)[:, None], far, two)
        return out, value

    def infer(self, texts: list[str | None]) -> tuple[list[str], list[float], list[dict[str, float]]]:
        """(language with the largest share, that share, shares of the selected set) of each text."""
        return self.infer_fit(texts)[:3]

    def infer_fit(self, texts: list[str | None]) -> tuple[list[str], list[float], list[dict[str, float]], list[float]]:
        """What infer gives, and the fit of each text: by how much the mean log-likelihood of its trigrams under the selected
        set is above that under no language, where all cells are equally likely; 0 where there is nothing to fit."""
        cells = [trigram_cells(t) if t else np.zeros(0, np.int64) for t in texts]
        names, scores, sets, fits = [UND] * len(texts), [0.0] * len(texts), [{} for _ in texts], [0.0] * len(texts)
        some = [i for i, c in enumerate(cells) if len(c)]
        if not some or not self.langs:
            return names, scores, sets, fits
        # one sort of (document, cell) keys counts the cells of all documents; runs of documents keep the keys in 31 bits
        keys = [np.concatenate([cells[i].astype(np.int32) + CELLS * j for j, i in enumerate(some[k : k + MOST_SORTED])]) for k in range(0, len(some), MOST_SORTED)]
        doc, cell, n = (np.concatenate(x) for x in zip(*(_counted(x, k * MOST_SORTED) for k, x in enumerate(keys)), strict=True))
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        size = np.diff(np.append(first, len(doc)))
        p = self.p[cell]
        single = np.add.reduceat(n[:, None] * self.log_p[cell], first)
        k, total = len(self.langs), np.add.reduceat(n, first)
        penalty = 0.5 * np.log(np.maximum(total, 2))
        like, held = single.max(1), single.argmax(1)[:, None]
        pi = np.zeros((len(some), k))
        pi[np.arange(len(some)), held[:, 0]] = 1
        # documents whose set still grows, with as many languages each (held), and their rows
        live, q, m = np.arange(len(some)), p, n
        while len(live) and held.shape[1] < k:
            start, at = np.cumsum(size[live]) - size[live], np.repeat(np.arange(len(live)), size[live])
            now, mine = np.take_along_axis(pi[live], held, 1), np.take_along_axis(q, held[at], 1)
            # the likelihood is concave: with one language more it cannot rise by more than the steepest slope towards the set
            slope = np.add.reduceat(q * (m / np.maximum((mine * now[at]).sum(1), 1e-300))[:, None], start) - total[live, None]
            most = np.maximum(slope, np.take_along_axis(slope, held, 1).max(1, keepdims=True))
            np.put_along_axis(most, held, -np.inf, 1)
            added, gain = np.full(len(live), -1), np.zeros(len(live))
            grown = np.zeros((len(live), held.shape[1] + 1))
            for lang in range(k):
                sub = np.flatnonzero(most[:, lang] > penalty[live])
                if not len(sub):
                    continue
                keep = (most[:, lang] > penalty[live])[at]
                sizes = size[live[sub]]
                begin = np.hstack([now[sub] * (1 - 1 / grown.shape[1]), np.full((len(sub), 1), 1 / grown.shape[1])])
                dues = penalty[live[sub]]
                new, value = self.climb(np.hstack([mine[keep], q[keep, lang : lang + 1]]), m[keep], sizes, begin, CLOSE * dues, like[live[sub]] + dues + gain[sub])
                more = value - dues - like[live[sub]]
                up = more > gain[sub]
                added[sub[up]], gain[sub[up]], grown[sub[up]] = lang, more[up], new[up]
            won = np.flatnonzero(added >= 0)
            keep = (added >= 0)[at]
            live, held, q, m = live[won], np.hstack([held[won], added[won, None]]), q[keep], m[keep]
            like[live] += gain[won] + penalty[live]
            pi[live[:, None], held] = grown[won]
        best, fit = pi.argmax(1), like / total + np.log(CELLS)
        for i, b, share, f in zip(some, best, pi, fit, strict=True):
            names[i], scores[i] = self.langs[b], float(min(1.0, max(0.0, share[b])))
            fits[i] = float(f)
            sets[i] = {self.langs[x]: float(share[x]) for x in np.flatnonzero(share)}
        return names, scores, sets, fits


def _counted(keys: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, cell, count) of sorted (document, cell) keys."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.diff(keys, prepend=-1))
    return first + keys[at] // CELLS, keys[at] % CELLS, np.diff(np.append(at, len(keys))).astype(float)


def language_id(docs: DataFrame, model: MixtureModel, text_col: str = "text", out: str = "lang_pred", score: str = "score", shares: str | None = None, fit: str | None = None) -> DataFrame:
    """docs with the predicted language of every row, its share of the document and, if asked for, all selected shares
    and the fit (see infer_fit).

    Only text_col is read. A null text or one without a letter gets `und` and 0. Ties go to the language whose name is
    first. Repeated rows each get the same answer; an empty table stays empty; with nothing learned all rows are `und`.
    Columns of docs that are named like an output are replaced; all others are kept. Texts of any length are read whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c.lower() not in {x.lower() for x in (out, score, shares, fit) if x}]
    text = docs[text_col].cast("string")
    struct = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)]) if keep else F.struct(F.lit(0).alias("c0"))
    kind = docs.select(struct.alias("rest")).schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", max(1, min(SLICE_BYTES, WORK // max(1, len(sent.value.langs))))):
                names, scores, sets, fits = sent.value.infer_fit(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rest"), pa.array(names), pa.array(scores, pa.float64()), pa.array([list(s.items()) for s in sets], pa.map_(pa.string(), pa.float64())), pa.array(fits, pa.float64())],
                    names=["rest", "lang", "score", "shares", "fit"],
                )
        whole = batch = None
        give_back()

    done = docs.select(struct.alias("rest"), text.alias("text")).mapInArrow(run, f"rest {kind}, lang string, score double, shares map<string,double>, fit double")
    cols = [F.col(f"rest.c{i}").alias(c) for i, c in enumerate(keep)] + [F.col("lang").alias(out), F.col("score").alias(score)]
    return done.select(*cols, *([F.col("shares").alias(shares)] if shares else []), *([F.col("fit").alias(fit)] if fit else []))


def crc_mod(value: object, m: int) -> int:
    """What id_hash(...) % m gives, for tests and callers outside Spark."""
    return zlib.crc32(str(value).encode()) % m
