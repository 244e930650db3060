"""Language ID, quality rules, source mixing, byte BPE and secret scans."""

import base64
import hashlib
import json
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe as bb
from tidemark.llm import language_id as li
from tidemark.llm import quality_rules as qr
from tidemark.llm import queries
from tidemark.llm import secret_scan as ss
from tidemark.llm import source_mixing as sm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def tokenizer():
    data = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return bb.ByteBPE.load(data, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_table(docs, rows, null_ids, empty, tokenizer):
    args = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    want = {}
    for i, t, *_ in rows:
        ids = tokenizer[1].encode_ordinary(t or "")
        want[i] = (len(ids), ids, sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))
    assert {r[0]: tuple(r)[1:] for r in bb.byte_bpe(docs, *args).collect()} == want
    assert bb.byte_bpe(null_ids, *args, ids=False).count() == 5 and bb.byte_bpe(empty, *args).count() == 0


def test_byte_bpe_keeps_its_encoder_and_no_pieces(spark, docs):
    """A worker that waits for the next job has one encoder, and no dictionary but the encoder's own."""
    bb.byte_bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count()

    def held(batches):
        import pyarrow as pa

        kept = [x for v in bb._LOADED.values() for x in (v if isinstance(v, tuple) else (v,))]
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(kept)]), pa.array([sum(len(x) for x in kept if isinstance(x, dict))])], names=["loaded", "pieces"])

    found = spark.range(0, 64, 1, 16).mapInArrow(held, "loaded long, pieces long").collect()
    assert any(r.loaded for r in found) and not any(r.pieces for r in found)


def test_byte_bpe_pieces(tokenizer):
    own, other = tokenizer
    rng = np.random.RandomState(0)
    for text in ["a" * 700, "ab" * 400, "<|endoftext|> don't 123456 ٣٤ 漢字🙂́", " 　\x85 \n\n x", "".join(chr(c) for c in rng.randint(32, 1200, 3000)), "".join(rng.choice(list("abé"), 500))]:
        ids = own.encode(text)
        assert ids == other.encode_ordinary(text) and own.decode(ids).decode() == text
    for piece in (b"abcabcabc", b"hello world again and again"):
        m = 1 << (len(piece) - 1).bit_length()
        assert own.merge_one(piece) == own.merge_forest([piece], m)[0]


def test_language_id_on_given_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = queries.op6_language_id(spark, data).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == docs.count() and all(r.held_out == (li.crc_mod(r.doc_id, 4) == 2) for r in found)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95 and all(0 <= r.score <= 1 for r in found)


def test_language_id_odd_texts(docs, null_ids, empty):
    model = li.MixtureModel.fit(docs)
    done = li.language_id(docs, model, shares="shares")
    assert set(docs.columns) <= set(done.columns) and model.langs == ["en", "fr"]
    for r in done.collect():
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == li.UND) == none and (r.score == 0) == none and abs(sum(r.shares.values()) - (not none)) < 1e-6
    assert li.language_id(null_ids, model).count() == 5 and li.language_id(empty, model).count() == 0
    nothing = li.MixtureModel.fit(empty)
    assert nothing.langs == [] and {r.lang_pred for r in li.language_id(docs, nothing).collect()} == {li.UND}


def test_mixture_of_two_languages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = li.MixtureModel.fit(docs)
    text = {r.lang: r.text for r in docs.filter("n_chars > 3000").collect()}
    _, score, shares = model.infer([text["de"][:3000] + " " + text["fr"][:1000]])
    assert set(shares[0]) == {"de", "fr"} and 0.6 < score[0] < 0.9


def test_quality_on_given_documents(spark, data):
    found = queries.op4_quality_rules(spark, data).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    assert all(r.held_out == (li.crc_mod(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    known = [r for r in found if r.doc_id in labels and r.held_out]
    assert len(known) > 5 and sum(r.predicted == labels[r.doc_id] for r in known) / len(known) > 0.9


def test_weights_meet_the_conditions_of_the_lasso():
    rng = np.random.RandomState(3)
    x = rng.rand(400, len(qr.STATS))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.5) | (rng.rand(400) < 0.1)).astype(float)
    model = qr.fit(x, y, trees=4, depth=2, penalty=0.01, rounds=6000)
    # the slope of the mean log-loss is nought for the bias and the penalty against the sign of every standardised weight
    off = model.predict(x) - y
    assert abs(off.mean()) < 1e-4 and len(model.rules) > 2
    for rule, weight in model.rules:
        v = np.array([all((row[qr.STATS.index(s)] > b) == above for s, above, b in rule) for row in x], float)
        slope = (off * (v - v.mean())).mean() / max(v.std(), 0.05)
        assert abs(slope + 0.01 * np.sign(weight)) < 1e-3
    hits = {r for r, w in model.rules if {(s, a) for s, a, _ in r} == {(qr.STATS[0], True), (qr.STATS[1], False)}}
    assert hits, "the conjunction that the labels were made by"


def test_compiled_rules_score_as_the_model(spark, docs, null_ids, empty):
    stats = qr.with_stats(docs)
    x = np.array([[r[c] for c in qr.STATS] for r in stats.orderBy("id").collect()])
    y = (x[:, 0] > np.median(x[:, 0])).astype(float)
    model = qr.fit(x, y)
    assert model.rules and ((model.predict(x) > 0.5) == y).mean() > 0.9
    got = [r.s for r in stats.orderBy("id").select(model.column().alias("s")).collect()]
    assert np.allclose(got, model.predict(x))
    assert qr.score_quality(null_ids, model).count() == 5 and qr.score_quality(empty, model).count() == 0
    none = qr.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in qr.score_quality(docs, none).collect()} == {0.5}


def test_statistics_by_hand():
    import pyarrow as pa

    s = qr.text_stats(pa.array(["Ab ab!! ab", None, "12 | #$", "é\né"]))
    assert np.allclose(s["log_words"], np.log1p([3, 0, 3, 2])) and np.allclose(s["distinct"], [1, 0, 1, 0.5])
    assert np.allclose(s["upper"], [1 / 8, 0, 0, 0]) and np.allclose(s["bangs"], [2 / 3, 0, 0, 0]) and np.allclose(s["pipes"], [0, 0, 1 / 3, 0])
    assert np.allclose(s["repeats"], [0, 0, 0, 0.5]) and np.allclose(s["top_word"], [1 / 3, 0, 1 / 3, 1])


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level >= 2 * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in free}
        out |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return out


def check_mix(rows, got):
    sizes, source, largest = Counter(), {}, Counter()
    for i, t, _, s, _ in rows:
        sizes[s] += len(WORD.findall(t or ""))
        largest[s] = max(largest[s], len(WORD.findall(t or "")))
        source[i] = s
    want, taken = targets_by_hand(sizes), Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(1, 0.5 * largest[s]), s
    return taken, want


def test_mixing(spark, docs, rows, null_ids, empty, monkeypatch):
    got = sm.mix_sources(docs).collect()
    check_mix(rows, got)
    assert {r.doc_id: r.size for r in got} == {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    assert sorted(sm.mix_sources(docs.repartition(5)).collect()) == sorted(got)
    monkeypatch.setattr(sm, "PART_ROWS", 1)  # parts of two digits: the same numbers
    assert sorted(sm.mix_sources(docs).collect()) == sorted(got)
    many = spark.range(3000).selectExpr("id as doc_id", "'a b c' as text", "concat('s', id % 700) as source")
    check_mix([(r.doc_id, r.text, None, r.source, 0) for r in many.collect()], sm.mix_sources(many).collect())
    assert sm.mix_sources(null_ids).count() == 5 and sm.mix_sources(empty).count() == 0


def test_mixing_comes_near_on_given_documents(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    taken, want = check_mix(rows, queries.op8_source_mixing(spark, data).collect())
    assert all(abs(taken[s] - want[s]) <= 0.03 * want[s] for s in want)


def der(tag, data):
    n = len(data)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + data


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes(range(1, 60))) for _ in range(8)))
HEADER = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
SECRETS = [
    (1, 'PassWord = "abcdef"; token:short x'), (2, "AKIA" + "A" * 16 + " AKIASHORT"), (3, "0" * 24 + " " + "f" * 23), (4, "password=token:value123"), (5, "key " + base64.b64encode(RSA).decode() + " end"),
    (6, "h " + RSA.hex()), (7, f"j {HEADER}.e30.sig"), (8, "M" + "A" * 60 + " eyJub3QiOiJqc29u.e30.x"), (9, None), (10, ""), (11, "Key toſecret=abcdefg api_KEY: 'k_k=/+.-x'"), (12, "a\U0001f600 secret = aaaaaaa"),
]


def base_by_hand(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:(?a:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_scan(spark, data, docs, null_ids, empty):
    got = {r.doc_id: r for r in ss.scan_digest(ss.secret_scan(spark.createDataFrame(SECRETS, "doc_id long, text string"))).collect()}
    for i, text in SECRETS:
        base = base_by_hand(text)
        assert got[i].base_sha256 == sha(ss.joined(base).encode()), i
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
    extra = {i: [s.split(":")[0] for s in r.spans.split(",") if s.split(":")[0] in ss.KINDS[3:]] for i, r in got.items()}
    assert {i: x for i, x in extra.items() if x} == {5: ["key_der"], 6: ["key_hex"], 7: ["signed_token"]}
    assert ss.secret_scan(docs).count() == docs.count() and ss.secret_scan(null_ids).count() == 5 and ss.secret_scan(empty).count() == 0
    given = spark.read.parquet(f"{data}/documents.parquet").collect()
    found = {r.doc_id: r.base_sha256 for r in queries.op10_secret_scan(spark, data).collect()}
    assert found == {r.doc_id: sha(ss.joined(base_by_hand(r.text)).encode()) for r in given}


def test_key_structure():
    assert ss.is_key(RSA) and not ss.is_key(RSA[:-1]) and not ss.is_key(b"") and not ss.is_key(der(0x30, b"\x02\x01\x00"))
    wrapped = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x03")) + der(4, b"k" * 40))
    assert ss.is_key(wrapped) and not ss.is_key(wrapped.replace(b"\x06\x02", b"\x05\x02"))
    assert not ss.is_signed_token("eyJub3QiOiJqc29u") and ss.is_signed_token(HEADER)


def test_id_hash(spark):
    got = spark.range(50).select(li.id_hash("id").alias("h")).collect()
    assert [r.h % 4 for r in got] == [li.crc_mod(i, 4) for i in range(50)]
    assert spark.sql("select cast(null as long) as id").select(F.isnull(li.id_hash("id"))).first()[0]
