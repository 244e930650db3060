"""Personal data: base spans against Python's re, discovery by context against a plain loop."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from tidemark.llm.personal_data import CONFIDENT, KNOWN, SUPPORT, personal_data
from tidemark.llm.queries import op12_personal_data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def counts(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_of(text):
    found = [(m.start(), list(BASE).index(k), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "", re.ASCII) if counts(k, m.group())]
    return sorted(found)


def listed(spans):
    return ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in spans)


def check(rows, texts):
    for r in rows.collect():
        base = base_of(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4)), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest(), (texts[r.doc_id], base)
        assert set(filter(None, listed(base).split(","))) <= set(r.spans.split(","))


def stored(spark, folder, texts):
    rows = [(i, t) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "'x' as base", "2 as id", "3 as seen", "4 as found_email").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_base_spans_of_random_texts(spark, tmp_path):
    rng = random.Random(2)
    parts = ["a", "b.c", "@", ".", "-", "+", " ", "  ", "1", "23", "255", "256", "4111111111111111", "4111-1111 1111 1111", "+1 (743) 555-3824", "x@y.z", "10.0.0.1", "1.2.3.4.5.6.7.8", "_", "é", "😀", "(", ")", "\n", "%", "x.19@m-5.ex.com"]
    texts = {i: "".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for i in range(1500)}
    texts |= {5000: None, 5001: "", 5002: " \n", 5003: "a@b.c_d@e.f@g.h", 5004: "+++1 2(((", 5005: "1" * 20 + "-" + "4111111111111111", 5006: "000255.1.1.1 1.2.3.00004", 5007: "😀a@b.c😀+12 34567 8901😀", 5008: "a@b.c." + "d." * 6000 + "e", 5009: "1-" * 9000 + "1"}
    check(op12_personal_data(spark, stored(spark, tmp_path, texts)), texts)


def test_long_hostile_texts_take_linear_time(spark, tmp_path):
    texts = {1: "a" * 1_000_000, 2: "1" * 1_000_000, 3: "+1" + "(" * 1_000_000, 4: "a@b" * 200_000, 5: "1.1.1." * 200_000, 6: "a@b.c " * 100_000, 7: "12," * 200_000}
    began = time.perf_counter()
    rows = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in op12_personal_data(spark, stored(spark, tmp_path, texts)).collect()}
    assert time.perf_counter() - began < 90
    assert rows == {i: (100_000, 0, 0, 0) if i == 6 else (0, 150_000, 0, 0) if i == 5 else (0, 0, 0, 0) for i in texts}


def by_hand(texts):
    """Rounds over (words, value, seed, like) of made texts whose instances are single words or numbers after words."""
    like = {"phone": r"[+(]?(?:[ ()./-]{0,2}[0-9]){7,15}\)?", "card": r"(?:[ .-]?[0-9]){12,19}", "email": r"[^@\s]+@[^@\s]+", "ip": r"(?=(?:[^.:]*[.:]){3})[0-9A-Fa-fx.:*]{7,45}"}
    edges = {}
    for text in texts:
        words = text.lower().split()
        for i, w in enumerate(words):
            if not re.search("[0-9@]", w):
                continue
            before = ["<id>" if re.search("[0-9@]", x) else x for x in words[max(0, i - 2) : i]]
            for p in {" ".join(before[-1:]), " ".join(before) if len(before) > 1 else ""} - {""}:
                edges.setdefault(p, set()).add(w)
    seed = {w: next((k for k, p in BASE.items() if re.fullmatch(p, w) and counts(k, w)), None) for ws in edges.values() for w in ws}
    known = {(w, k) for w, k in seed.items() if k}
    while True:
        sure = {(p, k): sum((w, k) in known for w in ws) / (len(ws) + 1) for p, ws in edges.items() for k in BASE if sum((w, k) in known for w in ws) >= SUPPORT}
        sure = {x: c for x, c in sure.items() if c >= CONFIDENT}
        more = set()
        for w in seed:
            for k in BASE:
                miss = 1.0
                for (p, kind), c in sure.items():
                    if kind == k and w in edges[p]:
                        miss *= 1 - c
                if seed[w] is None and re.fullmatch(like[k], w) and 1 - miss >= KNOWN:
                    more.add((w, k))
        if more <= known:
            return {(w, k) for w, k in known if not seed[w]}
        known |= more


def made():
    rng = random.Random(4)
    phone = lambda: f"+1{rng.randrange(10**9, 10**10)}"
    texts = [f"please call me at {phone()} soon" for _ in range(20)]
    texts += ["please call me at 555-123-4567 soon", "call me at 555.987.6543 today", "my cell is 555-123-4567 now", "invoice number 555-000-1111 is due"]
    texts += [f"my cell is {phone()} ok" for _ in range(9)] + ["my cell is 020-7946-0958 ok"]
    texts += [f"write to bob{i}@mail.example.com please" for i in range(8)] + ["write to carol@localhost please"]
    texts += [f"in the year {y} it was" for y in range(1900, 1960)] + ["order number 7654321 arrived", "in the year 10000000 it was"]
    return texts


def test_context_finds_what_no_pattern_does(spark):
    texts = made()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = set()
    for r in personal_data(df).collect():
        for s in r.spans:
            if s not in r.base:
                got.add((texts[r.doc_id][s.start : s.stop].lower(), list(BASE)[s.kind]))
    assert got == by_hand(texts)
    assert {("555-123-4567", "phone"), ("555.987.6543", "phone"), ("020-7946-0958", "phone"), ("carol@localhost", "email")} <= got
    assert not {v for v, _ in got} & {"7654321", "10000000", "555-000-1111", "1950"}


def test_spans_found_by_context_overlap_no_base_span(spark):
    texts = made() + ["please call me at 555-123-4567,a@b.c soon", "x 555-123-4567 and +1 555-123-4567 soon"]
    for r in personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        base = {tuple(s) for s in r.base}
        assert base == set(base_of(texts[r.doc_id]))
        for a, k, b in ({tuple(s) for s in r.spans} - base):
            assert not any(a < d and c < b for c, _, d in base), (texts[r.doc_id], a, b)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a@b.c"), (None, "a@b.c"), (7, None), (7, "1.2.3.4"), (7, "1.2.3.4")], "doc_id long, text string")
    got = sorted((str(r.doc_id), len(r.base)) for r in personal_data(df).collect())
    assert got == [("7", 0), ("7", 1), ("7", 1), ("None", 1), ("None", 1)]
    assert personal_data(df.limit(0)).collect() == []


def test_query_on_given_table(spark, data):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    check(op12_personal_data(spark, data), docs)


def test_no_python_on_the_way(spark, data):
    plan = personal_data(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
