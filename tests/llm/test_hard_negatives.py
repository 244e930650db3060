"""Hard negatives against plain Python on odd rows, ties, wide bands, long scores and many blocks."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives
from tidemark.llm.hard_negatives import mine_hard_negatives
from tidemark.llm.queries import op11_hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor, positives=5, negatives=3, lowest=50, highest=95, scale=256):
    fine = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine.append((i, label, [math.floor(x * scale) for x in v]))
    out = Counter()
    for a, label, v in fine:
        if not anchor(a):
            continue
        scored = [(-max(-(2**62), min(2**62, sum(x * y for x, y in zip(v, w)))), i, other) for i, other, w in fine if len(w) == len(v)]
        own = sorted((s, i) for s, i, other in scored if other == label and i != a)[:positives]
        for p, pid in own:
            band = sorted((s, i) for s, i, other in scored if other != label and lowest * -p <= 100 * -s <= highest * -p)[:negatives]
            out.update((a, pid, n + 1, i, -p, -s) for n, (s, i) in enumerate(band))
    return out


def rows_of(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in df.collect())


def made(seed, n=120, d=3, hot=True):
    rng = random.Random(seed)
    rows = [(i, [round(rng.choice([0.1, 0.5, 1.0, -0.5, rng.random()]), 2) for _ in range(d)], 0 if hot and rng.random() < 0.4 else rng.randrange(4)) for i in range(n)]
    rows += [(1000 + i, list(rows[i % 7][1]), rows[i % 7][2]) for i in range(30)]  # copies: ties
    rows += [(None, [1.0] * d, 1), (2001, None, 1), (2002, [1.0] * d, None), (2003, [1.0, None, 2.0], 1), (2004, [float("nan")] + [1.0] * (d - 1), 1), (2005, [float("inf")] * d, 0), (2010, [], 0), (2020, [], 1), (2030, [], 0), (2040, [0.5], 2), (2050, [0.0] * d, 3), (2060, [1e308] * d, 1)]
    rows += rows[:5]  # repeated rows
    rng.shuffle(rows)
    return rows


def clashing(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "2 as slot", "'x' as id", "3 as score", "4 as a", "5 as r", "6 as v").repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_odd_rows(spark, seed):
    rows = [r for r in made(seed) if r[0] != 2060]
    got = rows_of(mine_hard_negatives(clashing(spark, rows), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0) and got


def test_many_blocks_and_small_pieces_give_the_same(spark, monkeypatch):
    rows = [r for r in made(7) if r[0] != 2060]
    for name, value in (("ANCHOR_VALUES", 20), ("ROW_VALUES", 100), ("LEAST_BLOCK", 10)):
        monkeypatch.setattr(hard_negatives, name, value)
    got = rows_of(mine_hard_negatives(clashing(spark, rows), F.col("vec_id") % 10 == 0, positives=3, negatives=2, lowest=10, highest=99))
    assert got == brute(rows, lambda i: i % 10 == 0, 3, 2, 10, 99) and got


def test_overlapping_bands_share_slots(spark):
    rows = [(0, [1.0, 0.0], 0)] + [(i, [1.0 - i / 50, 0.0], 0) for i in range(1, 6)] + [(100 + i, [i / 100, 0.3], 1) for i in range(101)]
    got = rows_of(mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0))
    assert got == brute(rows, lambda i: i == 0) and len(got) == 15


def test_scores_beyond_doubles_and_longs(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(2**27, 2**28) / 256, rng.randrange(2**28) / 256, 2.0**19 if i % 4 else 3.0], i % 2) for i in range(24)]
    got = rows_of(mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0))
    assert got == brute(rows, lambda i: i % 5 == 0) and got
    assert rows_of(mine_hard_negatives(spark.createDataFrame([(0, [1e308], 0), (1, [1e308], 0), (2, [1.0], 1)], SCHEMA), F.col("vec_id") == 0)) == Counter()


def test_empty_tables_and_no_anchor(spark):
    df = clashing(spark, made(0))
    assert mine_hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert mine_hard_negatives(df, F.lit(False)).collect() == []
    assert mine_hard_negatives(df.filter("label = 0"), F.col("vec_id") % 10 == 0).collect() == []


def test_query_moves_labels(spark, tmp_path):
    rows = [(i, v, label) for i, v, label in made(4, n=260) if i != 2060]
    clashing(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, (label + 1) % 10 if i is not None and label is not None and i % 7 == 0 else label) for i, v, label in rows]
    assert rows_of(op11_hard_negatives(spark, str(tmp_path))) == brute(moved, lambda i: i % 50 == 0)
