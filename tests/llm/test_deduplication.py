"""Exact, substring and line dedup and the n-gram join against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from conftest_llm import roots
from oracle import check
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm import line_dedup as ld
from tidemark.llm import ngram_jaccard as nj
from tidemark.llm import queries
from tidemark.llm import substring_dedup as sd
from tidemark.llm.exact_dedup import chunks, exact_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_exact_dedup_deals_out_large_groups(docs, monkeypatch):
    want = sorted(map(tuple, exact_dedup(docs).collect()), key=repr)
    monkeypatch.setattr("tidemark.llm.exact_dedup.HOT_COPIES", 1)
    monkeypatch.setattr("tidemark.llm.exact_dedup.PART", 2)
    assert sorted(map(tuple, exact_dedup(docs).collect()), key=repr) == want and max(r[2] for r in want) > 1


def test_exact_dedup(spark, data, docs, rows, null_ids, empty):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    want = {i: (min(g)[1], len(g), min(g)[1] == i, sha(k)) for k, g in groups.items() for _, i in g}
    assert {r[0]: tuple(r)[1:] for r in exact_dedup(docs).collect()} == want
    got = exact_dedup(null_ids).collect()
    assert len(got) == 5 and sorted(r.group_size for r in got) == [1, 2, 2, 2, 2]
    assert exact_dedup(empty).count() == 0
    check(spark, data, queries.op5_exact_dedup, queries.oracle_sql()["op5_exact_dedup"])


def test_chunks_that_share_an_identifier_are_told_apart(docs, null_ids, empty, monkeypatch):
    want = {tuple(r) for r in exact_dedup(docs).collect()}
    monkeypatch.setattr("tidemark.llm.exact_dedup.identifier", lambda c: F.pmod(F.length(c), F.lit(5)).cast("long"))
    assert {tuple(r) for r in exact_dedup(docs).collect()} == want
    assert sorted(r.group_size for r in exact_dedup(null_ids).collect()) == [1, 2, 2, 2, 2] and exact_dedup(empty).count() == 0


def test_an_edit_moves_the_cuts_near_it_only(spark):
    rng = random.Random(5)
    for letters in ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
        text = "".join(rng.choice(letters) for _ in range(40_000))
        cut = spark.createDataFrame([(text,), ("#" + text,), (text[:20_000] + "#" + text[20_000:],)], "t string").select(chunks(F.col("t")).alias("c"))
        whole, front, middle = (r.c for r in cut.collect())
        assert "".join(whole) == text and all(256 < len(c) <= 1024 for c in whole[:-1])
        assert len(set(whole) - set(front)) < 0.2 * len(whole) and len(set(whole) - set(middle)) < 0.2 * len(whole)


def brute_substring(rows, n=13):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    for i, w in sorted(split):
        for j in range(len(w) - n + 1):
            first.setdefault(tuple(w[j : j + n]), i)
    out = {}
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j : j + n])] < i:
                gone[j : j + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), sha(" ".join(kept)))
    return out


def test_substring_dedup(docs, rows, null_ids, empty, monkeypatch):
    want = brute_substring(rows)
    assert {r[0]: tuple(r)[1:] for r in sd.substring_dedup(docs).collect()} == want
    assert sum(w[1] for w in want.values()) > 200
    monkeypatch.setattr(sd, "BUCKET_BYTES", 20_000)  # many buckets, several blocks, hot texts
    monkeypatch.setattr(sd, "BLOCK_WINDOWS", 5_000)
    monkeypatch.setattr(sd, "HOT_COPIES", 1)
    monkeypatch.setattr(sd, "COPIES_A_BUCKET", 1)
    assert {r[0]: tuple(r)[1:] for r in sd.substring_dedup(docs).collect()} == want
    got = sd.substring_dedup(null_ids, with_text=True).collect()
    assert len(got) == 5 and all(r.n_removed == 0 for r in got)
    assert sd.substring_dedup(empty).count() == 0


def test_substring_sketch_never_loses_a_window():
    import numpy as np

    cells = np.unique(np.random.RandomState(0).randint(0, sd.BLOCK_CELLS, 5000))
    assert (sd.unpack(sd.pack(cells)) == cells).all() and len(sd.unpack(sd.pack(cells[:0]))) == 0


def brute_lines(rows):
    """Every line with a token against all earlier ones."""
    seen, out = {}, {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        if t is None:
            out[i] = (None, 0)
            continue
        kept = []
        for line in t.split("\n"):
            s = frozenset(WORD.findall(line))
            if not s or not (s in seen or any(100 * len(s & o) >= 75 * len(s | o) for o in seen)):
                kept.append(line)
            if s:
                seen[s] = True
        out[i] = ("\n".join(kept), len(t.split("\n")) - len(kept))
    return out


def test_line_dedup(docs, rows, null_ids, empty, monkeypatch):
    done = ld.line_dedup(docs)
    assert done.columns == [*docs.columns, "n_lines", "_n_removed"]  # docs has an n_removed of its own
    want = brute_lines(rows)
    assert {r.doc_id: (r.text, r["_n_removed"]) for r in done.collect()} == want
    assert {r.doc_id: r.n_lines for r in done.collect()} == {i: 0 if t is None else t.count("\n") + 1 for i, t, *_ in rows}
    assert sum(w[1] for w in want.values()) > 10
    got = ld.line_dedup(null_ids).collect()
    assert [r["_n_removed"] for r in got] == [0] * 5  # rows of one id and text are one document
    assert ld.line_dedup(empty).count() == 0
    monkeypatch.setattr(ld, "BROADCAST_ROWS", -1)  # every table is shuffled
    assert {r.doc_id: (r.text, r["_n_removed"]) for r in ld.line_dedup(docs).collect()} == want


def near_lines(n, seed):
    """Lines that are copies of a few, with words changed, added, left out, repeated or in another order; short and long ones."""
    rng = random.Random(seed)
    bases = [[f"t{rng.randrange(80)}" for _ in range(k)] for k in (1, 2, 3, 4, 5, 7, 12, 20, 50, 90)]
    out = []
    for k in range(n):
        words = [w for w in rng.choice(bases) if rng.random() > 0.06 * (k % 4)]
        words = [f"t{rng.randrange(80)}" if rng.random() < 0.05 * (k % 3) else w for w in words]
        words += [rng.choice(words)] * (k % 2) if words else []
        if k % 5 == 0:
            rng.shuffle(words)
        out.append(rng.choice(["", " "]) + rng.choice([" ", "  ", "\t", "\x0b"]).join(words) + rng.choice(["", "\r"]))
    return out


def test_line_dedup_near_the_threshold(spark):
    lines = near_lines(400, 3)
    rows = [(k // 4 if k < 200 else 1000 - k, "\n".join(lines[k : k + 4])) for k in range(0, 400, 4)]
    got = {r.doc_id: (r.text, r.n_removed) for r in ld.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute_lines(rows) and 50 < sum(n for _, n in got.values()) < 395


def test_line_dedup_short_lines(spark):
    texts = ["All rights reserved.\n\nRead more", "Read more\n\n版权所有不得转载", "版权所有不得转载\nreserved. All rights now", "a b c d", "a b c", "a b x", "more", "x\u00a0y", "x y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in ld.line_dedup(df).collect()}
    assert got == brute_lines(enumerate(texts)) and [got[i][1] for i in range(9)] == [0, 1, 2, 0, 1, 0, 0, 0, 0]


def test_line_dedup_tells_texts_of_one_id_apart(spark):
    df = spark.createDataFrame([(1, "a b c\nd e f"), (1, "q r s\na b c"), (1, "a b c\nd e f")], "doc_id long, text string")
    got = sorted((r.text, r.n_removed) for r in ld.line_dedup(df).collect())
    assert got in ([("a b c\nd e f", 0), ("a b c\nd e f", 0), ("q r s", 1)], [("d e f", 1), ("d e f", 1), ("q r s\na b c", 0)])


def test_line_dedup_with_signatures_of_either_width(spark, monkeypatch):
    lines = near_lines(240, 11)
    rows = [(k, "\n".join(lines[k : k + 3])) for k in range(0, 240, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (0, 6, 1000):
        monkeypatch.setattr(ld, "ONE_WORD", width)
        assert {r.doc_id: (r.text, r.n_removed) for r in ld.line_dedup(df).collect()} == brute_lines(rows)


def test_line_dedup_makes_nothing_twice(spark, monkeypatch):
    seen = {}

    def spy(df, name):
        seen[name] = df.columns, df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return common.staged(df, name)

    monkeypatch.setattr(ld, "staged", spy)
    df = spark.createDataFrame([(1, "a b c d\ne\tf"), (2, "a b c d\n\ne f"), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in ld.line_dedup(df).collect()} == {1: 0, 2: 2, 3: 0}
    for name in ("classes", "gone"):  # a filter or join on what is made of a text would make it again
        assert not any(x in line for line in seen[name][1] for x in ("Contains(", "sha2(") if "Filter" in line)
        assert sum("sha2(" in line for line in seen[name][1]) == 1
    assert seen["lines"][0] == ["doc", "at", "text"]  # texts are moved, not their words
    join = [line for line in seen["pairs"][1] if "Join Inner" in line]
    assert len(join) == 1 and "shuffle_hash" in join[0]  # the prefixes aren't sorted
    assert sum("RepartitionByExpression" in line for line in seen["pairs"][1]) == 2 and not any("isnotnull(band" in line for line in seen["pairs"][1])


def test_line_dedup_query(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    want = {i: (n, None if t is None else sha(t)) for i, (t, n) in brute_lines(rows).items()}
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in queries.op2_line_dedup(spark, data).collect()} == want


def brute_jaccard(rows):
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = roots(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}, links


def test_ngram_jaccard(docs, rows, null_ids, empty):
    want, links = brute_jaccard(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_jaccard(docs).collect()} == want
    assert len(links) > 10
    got = nj.ngram_jaccard(null_ids).collect()
    assert [r.component_id for r in got if r.doc_id is None] == [None] * 3 and [r.component_id for r in got if r.doc_id == 5] == [5, 5]
    assert nj.ngram_jaccard(empty).count() == 0


def test_ngram_jaccard_chain_and_shuffled_texts(spark, monkeypatch):
    """A chain of texts, each near the next only, is one group; beyond the broadcast bound texts are shuffled."""
    monkeypatch.setattr(nj, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(nj, "GROUP_MEMBERS", 2)
    w = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(w[10 * k : 10 * k + 100])) for k in range(12)] + [(50 + k, " ".join([*w[:99], f"tail{k}"])) for k in range(9)]
    got = {r.doc_id: r.component_id for r in nj.ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: brute_jaccard(rows)[0][i][1] for i, _ in rows} and set(got.values()) == {0}


def spread_copies(n, seed):
    """Copies of one text with up to a third of the words changed: many pairs lie near the threshold; lengths differ as well."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for k in range(n):
        words = [rng.choice("xyz") + str(rng.randrange(10**6)) if rng.random() < 0.02 * (k % 9) / 2 else x for x in base]
        rows.append((k, " ".join(words[: len(words) - rng.choice([0, 0, 10, 40])])))
    return rows


def test_ngram_jaccard_cuts_groups_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 8)
    monkeypatch.setattr(common, "EDGES_A_TASK", 10)
    rows = spread_copies(160, 0) + [(1000 + k, t) for k, t in spread_copies(20, 1)] + [(2000 + k, " ".join(f"u{k}x{j}" for j in range(30))) for k in range(5)]
    want, links = brute_jaccard(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want and len(links) > 500 and len({c for _, c in want.values()}) > 20


def thue_morse(n):
    word = [0]
    while len(word) < n:
        word += [1 - x for x in word]
    return "".join("ab"[x] for x in word), "".join("ba"[x] for x in word)


def test_structured_words_differ(spark):
    """Words that any polynomial modulo a power of two confuses are told apart."""
    one, other = thue_morse(1024)
    hashed = common.WordHasher(7)
    buf, offsets = common.text_buffer(pa.array([one, other, one + "\n" + other, "x" * (3 << 20) + " y"]))
    starts, ends, _ = common.word_bounds(buf, offsets)
    h = hashed(buf, starts, ends).tolist()
    assert len(set(h)) == 4 and h[0] == h[2] and h[1] == h[3]
    rows = [(1, f"{one} w x y z"), (2, f"{other} w x y z"), (3, f"q {one} w x y z"), (4, f"q {other} w x y z"), (5, f"q  {one.upper()} w x\ty z")]
    got = {r.doc_id: r.component_id for r in nj.ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3}


#: Two words that have one hash at the points of seed 7.
CLASH = "mmmmmmmmmmmmmmmmmmmmmmmm", "pklmlolpnplkpjkmnnmomlkn"


def clash_rows():
    one, other = CLASH
    both = f"p q r s {one} t u v w p q r s {other} t u v w"
    return [(1, f"{both} y0 y1"), (2, f"{both} z0 z1"), (3, f"{one} a b c d e"), (4, f"{other} a b c d e")]


def test_words_made_to_clash_are_told_apart(spark):
    df = spark.createDataFrame(clash_rows(), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_jaccard(df).collect()} == {1: (16, 1), 2: (16, 1), 3: (2, 3), 4: (2, 4)}


def test_points_at_which_words_clash_are_drawn_again(spark, monkeypatch):
    drawn = iter([7, 7, 12345])
    monkeypatch.setattr(nj, "drawn_points", lambda: next(drawn))
    df = spark.createDataFrame(clash_rows(), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_jaccard(df).collect()} == {1: (16, 1), 2: (16, 1), 3: (2, 3), 4: (2, 4)}
    assert next(drawn, None) is None


def test_a_link_that_the_words_refute_draws_new_points(spark, monkeypatch):
    """Texts 3 and 4 have one hash at seed 7 and no clash of their own."""
    one, other = CLASH
    shared = " ".join(f"w{i}" for i in range(4))
    rows = [(1, f"{shared} {one} q"), (2, f"{shared} {other} q")]
    seen = []
    monkeypatch.setattr(nj, "drawn_points", lambda: seen.append(1) or (7 if len(seen) == 1 else 99))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (2, 1), 2: (2, 2)} == {i: x for i, x in brute_jaccard(rows)[0].items()}


def test_components_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(common, "EDGES_A_TASK", 3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 120)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 120)} | {200: 200, 300: 200}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def chance_rows():
    """60 unlike texts, each two of which share a passage of seven words, among copies with changes."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        words = [f"u{i}x{j}" for j in range(20)]
        for k in range(60):
            if k != i:
                words += [f"p{min(i, k)}q{max(i, k)}y{j}" for j in range(7)] if (i + k) % 5 == 0 else [f"u{i}z{k}{rng.random()}"]
        rows.append((10 * i, " ".join(words)))
        rows += [(10 * i + 1 + c, " ".join([*words[: len(words) - 5 * c], f"v{i}w{c}"])) for c in range(i % 3)]
    return rows


@pytest.mark.parametrize("few", [128, 0])
def test_ngram_jaccard_moves_nothing_of_texts_that_meet_by_chance(spark, monkeypatch, few):
    """Texts that share less than a link needs don't meet in tiles, where whole signatures move; by keys that count as common they do.
    All cells are equally crowded, as in a large table."""
    moved, write = {}, nj.staged

    def spy(df, name):
        out = write(df, name)
        moved[name] = moved.get(name, 0) + (out.count() if name in ("couples", "members", "meet") else 0)
        return out

    monkeypatch.setattr(nj, "staged", spy)
    monkeypatch.setattr(nj, "FEW", few, raising=False)
    monkeypatch.setattr(nj, "crowded_levels", lambda docs, hasher: nj.np.zeros(1 << nj.CELL_BITS, nj.np.uint8))
    rows = chance_rows()
    want, links = brute_jaccard(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(links) == 80 and len({c for _, c in want.values()}) == 60
    assert (moved["couples"] + moved["members"] + moved["meet"] == 0) == (few > 0)


def random_sets(seed):
    """Texts from a small pool of passages, so that sets overlap in any degree, with repeats that share passages of few or many texts."""
    rng = random.Random(seed)
    passages = [[f"s{p}t{j}" for j in range(rng.randint(1, 25))] for p in range(25)]
    rows = []
    for k in range(150):
        if rows and rng.random() < 0.6:
            words = rows[rng.randrange(len(rows))][1].split(" ")
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 4)] = rng.choice(passages)[: rng.randint(0, 6)]
        else:
            words = [w for p in rng.sample(passages, rng.randint(1, 8)) for w in p]
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize(("few", "agree", "up"), [(128, 8, 3), (128, 1, 0), (3, 8, 0), (6, 100, 0), (0, 8, 3)])
def test_ngram_jaccard_whatever_keys_count_as_common(spark, monkeypatch, few, agree, up):
    for name, value in (("FEW", few), ("AGREE", agree), ("LEADERS_UP", up), ("BLOCK", 8)):
        monkeypatch.setattr(nj, name, value, raising=False)
    rows = random_sets(few + agree)
    want, links = brute_jaccard(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(links) > 50
