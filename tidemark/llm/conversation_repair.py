"""Conversation repair: the cheapest edits that make the roles of a conversation alternate.

Conversations are dealt to tasks by their id and sorted by turn; a task streams through its Arrow batches and carries one small
state from row to row, also across batches. The state is a dynamic program over what the kept roles end in (nothing, a system
message, a user's, an assistant's): for each such end the cost of the cheapest edits so far, the order of their audits by
ASCII, and a running digest of the repaired text. Costs are kept relative to the cheapest and ends that can't win any more are
dropped, so few different states exist; each step between two of them is worked out once and numbered. A row's backpointer is that
number, two bytes; a long conversation spills them to the task's scratch file, and the audit is read from them backwards.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES

#: Costs of the edits and of a truncated message that stays; ends of a message that isn't truncated.
REROLE, DELETE, INSERT, TRUNCATED, CLOSERS = 2, 3, 2, 1, ".!?"
#: What the kept roles end in, the state after one more role, and the role that must be inserted or set there.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = ("user", "user", "assistant", "user")
#: Pairs of initials that may follow each other.
LEGAL = frozenset(("su", "ua", "au"))
#: What it costs at most to go on from the first end as from the second: a second end that costs more than that is dropped.
STAND_IN = {(ASSISTANT, NOTHING): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT, (USER, ASSISTANT): INSERT, (USER, SYSTEM): INSERT, (SYSTEM, USER): INSERT, (NOTHING, USER): INSERT}
#: Backpointers that are held in memory before they go to the scratch file.
HELD = 1 << 16
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Steps:
    """The dynamic program's steps. An end is (state, cost above the cheapest); ends are in the order of their audits."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}
        self.moves: list[list[tuple[int, str]]] = []

    def step(self, ends: tuple, kind: str) -> tuple:
        """(ends after a row, cost added, number of the step, how each end's digest goes on). kind: the initial of the row's
        role, "." behind it for a truncated row; "" for a row that must go."""
        found = self.known.get((ends, kind))
        return found if found is not None else self._learn(ends, kind)

    def _learn(self, ends: tuple, kind: str) -> tuple:
        best: dict[int, tuple] = {}
        stays = TRUNCATED if kind.endswith(".") and len(kind) > 1 else 0
        for rank, (state, cost) in enumerate(ends):
            for edits in ("", "I", "II"):
                choices = [(state, cost + DELETE, "D")]
                if kind:
                    wanted = WANTED[state]
                    choices.append((AFTER[state, wanted[0]], cost + REROLE + stays, "R"))
                    if (state, kind[0]) in AFTER:
                        choices.append((AFTER[state, kind[0]], cost + stays, "K"))
                for new, total, edit in choices:
                    if new not in best or (total, rank, edits + edit) < best[new]:
                        best[new] = (total, rank, edits + edit)
                state, cost = AFTER[state, WANTED[state][0]], cost + INSERT
        kept = {s: b for s, b in best.items() if not any((o, s) in STAND_IN and best[o][0] + STAND_IN[o, s] < b[0] for o in best)}
        low = min(b[0] for b in kept.values())
        order = sorted(kept, key=lambda s: kept[s][1:])
        moves = [(kept[s][1], kept[s][2]) for s in order]
        uses = [rank for rank, _ in moves]
        plans = [(rank, uses.count(rank) > 1, *self.lines(ends[rank][0], edits)) for rank, edits in moves]
        out = tuple((s, kept[s][0] - low) for s in order), low, len(self.moves), plans
        self.moves.append(moves)
        self.known[ends, kind] = out
        return out

    @staticmethod
    def lines(state: int, edits: str) -> tuple[bytes, str | None]:
        """What edits append to the repaired text before the row's own text: inserted lines and the row's start; and the role that
        the row gets: None for its own, "" if it goes."""
        out, own = b"", ""
        for e in edits:
            if e in "IR":
                role = WANTED[state]
                out += (b"" if state == NOTHING else b"\n") + role.encode() + b":"
                state = AFTER[state, role[0]]
                own = role if e == "R" else ""
            elif e == "K":
                out, own = out + (b"" if state == NOTHING else b"\n"), None
        return out, own


class Conversation:
    """One conversation while its rows stream by."""

    def __init__(self, steps: Steps):
        self.steps, self.ends, self.digests = steps, ((NOTHING, 0),), [hashlib.sha256()]
        self.cost = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None
        self.back, self.spill = array("H"), None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        said = text.rstrip(SPACES)
        kind = initial if initial in ("s", "u", "a") else "?"
        if not said:
            self.blank += 1
            kind = ""
        elif again:
            self.duplicate += 1
            kind = ""
        elif said[-1] not in CLOSERS:
            self.truncated += 1
            kind += "."
        self.ends, cost, number, plans = self.steps.step(self.ends, kind)
        self.cost += cost
        self.back.append(number)
        if len(self.back) >= HELD:
            self.spill = self.spill or tempfile.TemporaryFile()
            self.back.tofile(self.spill)
            self.back = array("H")
        old, line, digests = self.digests, None, []
        for rank, shared, before, own in plans:
            digest = old[rank].copy() if shared else old[rank]
            if before or own is None:
                digest.update(before)
            if own != "":
                line = line or text.encode("utf-8", "surrogatepass")
                digest.update(role.encode("utf-8", "surrogatepass") + b":" + line if own is None else line)
            digests.append(digest)
        self.digests = digests

    def report(self) -> tuple:
        closing = {NOTHING: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        cost, rank, edits = min((c + INSERT * len(closing[s]), rank, closing[s]) for rank, (s, c) in enumerate(self.ends))
        self.digests[rank].update(self.steps.lines(self.ends[rank][0], edits)[0])
        audit = self.audit(rank) + edits
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + cost, audit, self.digests[rank].hexdigest()

    def audit(self, rank: int) -> str:
        """The edits on the way to an end, read from the backpointers, the last block first."""
        parts, block = [], self.back
        place = self.spill.tell() if self.spill else 0
        while True:
            for number in reversed(block):
                rank, edits = self.steps.moves[number][rank]
                parts.append(edits)
            if not place:
                break
            place -= HELD * self.back.itemsize
            self.spill.seek(place)
            block = array("H")
            block.fromfile(self.spill, HELD)
        if self.spill:
            self.spill.close()
        parts.reverse()
        return "".join(parts)


def stream_reports(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reports of a partition's conversations, whose rows come one after another in order of turn."""
    steps, key, now = Steps(), None, None
    names = [c.split()[0] for c in REPORT.split(", ")]

    def table(done: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(done, columns=names)
        return out.astype({"conv_id": "Int64"})

    for batch in batches:
        done = []
        columns = [batch[c].tolist() for c in ("conv", "no_conv", "turn", "no_turn", "role", "text", "gone", "again")]
        for conv, no_conv, turn, no_turn, role, text, gone, again in zip(*columns, strict=True):
            if (conv, no_conv) != key:
                if now is not None:
                    done.append((None if key[1] else key[0], *now.report()))
                key, now = (conv, no_conv), Conversation(steps)
            if not gone:
                now.add(None if no_turn else turn, role, text, again)
        if done:
            yield table(done)
    if now is not None:
        yield table([(None if key[1] else key[0], *now.report())])


def by_turn(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, gone: Column | None) -> DataFrame:
    """Rows as the stream takes them, each conversation in one partition, before they are sorted by turn. again: an earlier row has
    the same role and text; found in the same partitioning, by a local sort, so that no task holds a conversation's texts."""
    zero, blank = F.lit(0).cast("long"), F.lit(" ")
    gone = F.lit(False) if gone is None else gone
    conv, turn = F.col(conv_col).cast("long"), F.col(turn_col).cast("long")
    base = rows.select(
        F.coalesce(conv, zero).alias("conv"), conv.isNull().alias("no_conv"), F.coalesce(turn, zero).alias("turn"), turn.isNull().alias("no_turn"),
        F.when(~gone, F.coalesce(F.col(role_col).cast("string"), blank)).alias("role"), F.when(~gone, F.coalesce(F.col(text_col).cast("string"), blank)).alias("text"), gone.alias("gone"),
    )
    same = Window.partitionBy("conv", "no_conv", "role", "text").orderBy(F.desc("no_turn"), "turn")
    return base.repartition("conv", "no_conv").withColumn("again", F.row_number().over(same) > 1)


def repair_reports(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: Column | None = None) -> DataFrame:
    """One row a conversation: its faults, and the cheapest edits that give role initials `(s?(ua)+)?`.

    Rows are taken by turn, null turns first, rows of one turn by role and text. A null role or text counts as one space. A row's
    first fault counts: blank (white space only), duplicate (role and text seen earlier), truncated (ends in none of `.!?`).
    Keep costs nothing, rerole to user or assistant 2, delete 3, insert an empty message of either 2; blank and duplicate rows
    must go, a truncated one that stays adds 1. Of equally cheap edits those with the ASCII-least audit are taken.

    gone: rows that are no longer there; a conversation of such rows alone is reported with zeros. Null ids are one conversation.
    Repeated rows are rows. Texts may be of any length, and conversations: a task's memory grows with neither rows nor texts, but
    for the audit, a byte an edit, which is part of the result. An empty table gives none; other columns are ignored.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit, repaired_sha256 (of the repaired
    `role:text` joined by newlines; repaired_turns gives the rows themselves).
    """
    ready = by_turn(rows, conv_col, turn_col, role_col, text_col, gone)
    return ready.sortWithinPartitions("conv", "no_conv", F.desc("no_turn"), "turn", "role", "text", "again").mapInPandas(stream_reports, REPORT)


def stream_turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired rows: a conversation's audit comes before its rows and tells what becomes of each."""
    audit, at, state, place, key = "", 0, NOTHING, 0, None
    for batch in batches:
        out = []

        def put(conv, role, text, edit):
            nonlocal place, state
            place, state = place + 1, AFTER[state, role[0]]
            out.append((conv, place, role, text, edit))

        columns = [batch[c].tolist() for c in ("conv", "no_conv", "role", "text", "audit")]
        for conv, no_conv, role, text, plan in zip(*columns, strict=True):
            conv = None if no_conv else conv
            if plan is not None:
                key, audit, at, state, place = conv, plan, 0, NOTHING, 0
            else:
                edit = audit[at]
                at += 1
                if edit != "D":
                    put(key, role if edit == "K" else WANTED[state], text, edit)
            while at < len(audit) and audit[at] == "I":
                put(key, WANTED[state], "", "I")
                at += 1
        yield pd.DataFrame(out, columns=["conv_id", "position", "role", "text", "edit"]).astype({"conv_id": "Int64"})


def repaired_turns(rows: DataFrame, reports: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone: Column | None = None) -> DataFrame:
    """The repaired conversations: (conv_id, position from 1, role, text, edit: K, R or I) of every row that is kept or inserted.

    reports: repair_reports of the same rows. A second stream, in which a conversation's audit comes first.
    """
    base = by_turn(rows, conv_col, turn_col, role_col, text_col, gone).filter("not gone").select("conv", "no_conv", "no_turn", "turn", "role", "text", "again", F.lit(None).cast("string").alias("audit"), F.lit(1).alias("kind"))
    zero = F.lit(0).cast("long")
    plans = reports.select(F.coalesce("conv_id", zero).alias("conv"), F.col("conv_id").isNull().alias("no_conv"), F.lit(True).alias("no_turn"), zero.alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(False).alias("again"), "audit", F.lit(0).alias("kind"))
    both = base.unionByName(plans).repartition("conv", "no_conv").sortWithinPartitions("conv", "no_conv", "kind", F.desc("no_turn"), "turn", "role", "text", "again")
    return both.mapInPandas(stream_turns, "conv_id long, position long, role string, text string, edit string")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with known faults, by crc32 of `conv:turn` modulo 20: 0 marks a row as gone, 1 empties its text, 2 takes
    `.!?` out of it, 3 repeats it at the same turn, 4 makes it the user's. Nulls count as one space.

    Returns conv_id, turn, role, text, gone.
    """
    blank = F.lit(" ")
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    fault = F.crc32(F.concat(text_of(conv_col), F.lit(":"), text_of(turn_col))) % 20
    base = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text"), fault.alias("fault"))
    hurt = base.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fault") == 0).alias("gone"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return hurt.drop("copy")
