"""Conversation repair against exhaustive search, and its stream against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair
from tidemark.llm.conversation_repair import Conversation, Steps, damaged, repair_reports, repaired_turns
from tidemark.llm.queries import op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def faults(rows):
    """blank, duplicate, truncated or None of every (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        end = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
        out.append("blank" if BLANK.match(text) else "duplicate" if (role, text) in seen else "truncated" if end.group(1) not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired text) by a recursion over suffixes: no ranks, no pruning, no backpointers."""
    marks, memo = faults(rows), {}
    grammar = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow

    def best(i, last, inserted):
        if (i, last, inserted) not in memo:
            found = []
            if i == len(rows) and last in ("", "a"):
                found.append((0, "", ()))
            if inserted < 2:
                for role in ("user", "assistant"):
                    if role[0] in grammar[last]:
                        c, a, t = best(i, role[0], inserted + 1)
                        found.append((c + 2, "I" + a, (role + ":", *t)))
            if i < len(rows):
                role, text = rows[i]
                c, a, t = best(i + 1, last, 0)
                found.append((c + 3, "D" + a, t))
                if marks[i] not in ("blank", "duplicate"):
                    for edit, new in (("K", role), ("R", "user"), ("R", "assistant")):
                        if new[:1] and new[:1] in grammar[last] and new[:1] in "sua":
                            c, a, t = best(i + 1, new[0], 0)
                            found.append((c + 2 * (edit == "R") + (marks[i] == "truncated"), edit + a, (f"{new}:{text}", *t)))
            memo[i, last, inserted] = min(found) if found else (10**9, "", ())
        return memo[i, last, inserted]

    cost, audit, lines = best(0, "", 0)
    return cost, audit, "\n".join(lines)


def expected(rows):
    """What a conversation's (turn, role, text) rows should give."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns, pairs = [t for t, _, _ in rows if t is not None], [(r, t) for _, r, t in rows]
    marks = faults(pairs)
    cost, audit, text = cheapest(pairs)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def hurt(rows):
    """Damage in plain Python: every conversation with its rows that are left."""
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        left = out.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        left += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def report(rows):
    got = {}
    for r in rows.collect():
        assert r.conv_id not in got
        got[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
    return got


def by_machine(pairs):
    c, seen = Conversation(Steps()), set()
    for role, text in pairs:
        c.add(None, role, text, (role, text) in seen)
        seen.add((role, text))
    return c.report()


def test_all_short_conversations_match_exhaustive_search():
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("Said.", "cut", "")]
    for n in range(4):
        for picked in itertools.product(kinds, repeat=n):
            pairs = [(r, t and f"{i} {t}") for i, (r, t) in enumerate(picked)]
            cost, audit, text = cheapest(pairs)
            got = by_machine(pairs)
            assert got[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), pairs
            kept = "".join(line[0] for line in text.split("\n")) if text else ""
            assert re.fullmatch("(s?(ua)+)?", kept)


def test_random_conversations_and_few_states():
    rng = random.Random(3)
    machine = Steps()
    for _ in range(600):
        pairs = [(rng.choice(["system", "user", "assistant", "tool", "", "Ürole"]), rng.choice(["a.", "b!", "c", "", " \n", "d?  ", "é"])) for _ in range(rng.randint(0, 14))]
        c, seen = Conversation(machine), set()
        for role, text in pairs:
            c.add(None, role, text, (role, text) in seen)
            seen.add((role, text))
        cost, audit, text = cheapest(pairs)
        assert c.report()[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest())
    for _ in range(200):  # long rows of any kinds lead to no new states for ever
        c = Conversation(machine)
        for _ in range(300):
            c.add(None, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", ""]), rng.random() < 0.2)
    assert len(machine.moves) < 2000


@pytest.mark.parametrize("held", [7, 1 << 16])
def test_backpointers_spill(monkeypatch, held):
    monkeypatch.setattr(conversation_repair, "HELD", held)
    rng = random.Random(5)
    for n in (0, 1, 6, 7, 8, 14, 150):
        pairs = [(rng.choice(["system", "user", "assistant", "tool"]), f"{i} {rng.choice(['a.', 'b', ''])}") for i in range(n)]
        cost, audit, text = cheapest(pairs)
        assert by_machine(pairs)[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest())


def made(seed=0):
    rng = random.Random(seed)
    rows = []
    for conv in (*range(40), None, -5, 2**60 + 1):
        for turn in range(rng.randint(1, 9)):
            turn = rng.choice([turn, turn, turn, turn + 3, None, 0])
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "assistant", "user", "tool", None, "", "Assistant"]), rng.choice(["Yes.", "No!", "Why?\n", "cut off", "", None, " \t", "é à.", f"own {rng.random()}."])))
    rows += rng.sample(rows, 10)  # repeated rows
    rows.append((99, 1, "user", "long. " * 30_000))
    return rows


def clashing(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "'x' as gone", "true as again", "'y' as audit", "0 as kind").repartition(3)


def test_query_on_odd_rows(spark, tmp_path):
    rows = made()
    clashing(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = report(op13_conversation_repair(spark, str(tmp_path)))
    assert got == {conv: expected(left) for conv, left in hurt(rows).items()}


def test_query_on_given_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert report(op13_conversation_repair(spark, data)) == {conv: expected(left) for conv, left in hurt(rows).items()}


def test_state_is_carried_across_batches_and_repaired_rows_have_the_digest(spark):
    rows = [(c, i, ["user", "assistant", "tool"][(i * i + c) % 3], f"{i % 31} said{'.' if i % 4 else ''}") for c in (1, 2) for i in range(100)] + [(3, 1, "user", "Alone.")]
    df = clashing(spark, rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        reports = repair_reports(df)
        got = report(reports)
        turns = repaired_turns(df, reports).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {c: expected([r[1:] for r in rows if r[0] == c]) for c in (1, 2, 3)}
    for c in (1, 2, 3):
        own = sorted((r for r in turns if r.conv_id == c), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, len(own) + 1))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == got[c][7]
        assert "".join(r.edit for r in own) == got[c][6].replace("D", "")


def test_conversations_without_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, 1, "user", "Hi.")], SCHEMA)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert report(repair_reports(rows, gone=F.lit(True))) == {1: nothing}
    assert repair_reports(rows.limit(0)).collect() == []
    assert damaged(rows.limit(0)).collect() == []
    assert report(repair_reports(spark.createDataFrame([(None, None, None, None)], SCHEMA))) == {None: (0, 1, 0, 0, 0, 3, "D", hashlib.sha256(b"").hexdigest())}
