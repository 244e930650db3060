"""Every stage on what the one before it kept, against brute force."""

import re

import corpus_pipeline
import public_tokenizers
import tiktoken
from test_deduplication import brute_jaccard, brute_lines
from test_text_models import check_mix

from tidemark.llm import ngram_jaccard
from tidemark.llm.common import setting, staged

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    held = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, data), name)
        held.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == DOCUMENTS
    first, lined, unlike, mixed, coded = ([tuple(r) for r in df.collect()] for df in held)
    given = {r.doc_id: tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    assert all(given[r[0]] == r for r in first) and len(first) >= 0.99 * len(given)
    want = brute_lines(first)
    assert {r[0]: (r[1], r[4]) for r in lined} == {i: (t, len(t)) for i, (t, _) in want.items()}
    groups, _ = brute_jaccard(lined)
    assert sorted(unlike) == sorted(r for r in lined if groups[r[0]][1] == r[0])
    copies = {r[0]: 0 for r in unlike}
    for r in mixed:
        copies[r[0]] += 1
    assert set(mixed) <= set(unlike) and max(copies.values()) == 2

    class Row:
        def __init__(self, r, source_size, target):
            self.doc_id, self.size, self.taken, self.source_size, self.target = r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1])), 0, source_size, target
            self.taken = self.size * copies[r[0]]

    from collections import Counter

    from test_text_models import targets_by_hand

    sizes = Counter()
    for r in unlike:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    target = targets_by_hand(sizes)
    check_mix(unlike, [Row(r, sizes[r[3]], target[r[3]]) for r in unlike])
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(), special_tokens={})
    assert sorted((r[0], r[2]) for r in coded) == sorted((r[0], enc.encode_ordinary(r[1])) for r in mixed)
    assert corpus_pipeline.ORACLE_SQL is None


def _ranks():
    import base64

    data = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def test_stages_take_odd_and_empty_tables(spark, docs, empty):
    for table in (docs, empty):
        for name, stage in corpus_pipeline.STAGES:
            table = staged(stage(spark, table, ""), name)
    assert table.count() == 0


def test_texts_stay_where_they_are_when_copies_go(spark, docs, monkeypatch):
    """Ids that go are counted and broadcast, whatever Spark estimates; beyond the bound the texts are shuffled to meet them, with one result."""
    kept = {}
    for rows in (1_000_000, 0):
        monkeypatch.setattr(ngram_jaccard, "BROADCAST_ROWS", rows)
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            out = corpus_pipeline.dedup_ngrams(spark, docs.select(DOCUMENTS), "")
            assert ("Exchange hashpartitioning" in out._jdf.queryExecution().executedPlan().toString()) == (rows == 0)
            kept[rows] = sorted(map(tuple, out.collect()), key=repr)
    assert kept[0] == kept[1_000_000] and 0 < len(kept[0]) < docs.count()
