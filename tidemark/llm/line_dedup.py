"""Line dedup by an exact set-similarity join, in DataFrame operations only.

Tokens of a line are ordered by rarity; two lines with Jaccard 0.75 or more share a token among the first few of either
(prefix filter), are of similar size (length filter), leave enough tokens after the shared one (positional filter) and
differ in few bits of a signature. What is left is verified on the tokens themselves. Of every pair of matching lines, the
later one goes.

Lines with one text (a 128-bit digest of it) are one class, under the earliest of them. One match is enough to remove a line, so
every class is first held against the earliest classes that have two tokens drawn from its prefix: that settles groups of near copies
with a few comparisons a member. Only pairs whose later class is still open are then looked for by whole prefixes.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, setting, staged

#: Similarity in hundredths.
PERCENT = 75
#: Token counts are kept for so many hash cells (a power of two): the rarity order is a table of fixed size.
CELL_BITS = 18
#: Sets of no more tokens than this have signatures of 64 bits, larger ones of 128.
ONE_WORD = 60
#: Tokens of a prefix with the lowest hashes, and with the highest, any two of which find an earlier class to be held against at first.
DRAWN = 4
#: Rows of fixed width (16 to 40 bytes), and lines listed in them (4 bytes each), up to which a table is broadcast; beyond that
#: the same join is shuffled.
BROADCAST_ROWS, BROADCAST_LINES = 1_000_000, 4_000_000
#: The white space but \n and space that separates words.
OTHER_SPACES = ("\t", "\x0b", "\x0c", "\r")


def spaced(text: Column) -> Column:
    """The text with a space for every white space but \\n. Few texts hold any other; those alone are rewritten."""
    odd = text.contains(OTHER_SPACES[0])
    for c in OTHER_SPACES[1:]:
        odd = odd | text.contains(c)
    return F.when(odd, F.translate(text, "".join(OTHER_SPACES), " " * len(OTHER_SPACES))).otherwise(text)


def token_set(line: Column) -> Column:
    """Distinct words of a line that spaced() made."""
    return F.array_except(F.split(line, " ", -1), F.array(F.lit("")))


def token_hashes(line: Column) -> Column:
    """A 32-bit hash for every distinct word of a line that spaced() made: words of one hash count twice, so sizes are those of the
    words, and no filter loses a pair that shares more hashes than words. Hashes only choose what is compared on the words."""
    return F.transform(token_set(line), lambda w: F.hash(w))


def rarity_levels(texts: DataFrame) -> Column:
    """An array literal with a level for every hash cell of tokens: twice the binary logarithm of their count over all texts.

    Tokens are counted by cell in every task before they are shuffled; the table has 2 ** CELL_BITS entries whatever the
    input. Any order of tokens gives right results; this one puts frequent tokens last.
    """
    words = texts.select(F.explode(F.split(F.replace(spaced(F.col("text")), F.lit("\n"), F.lit(" ")), " ", -1)).alias("w"))
    counts = words.groupBy(F.hash("w").bitwiseAND(F.lit((1 << CELL_BITS) - 1)).alias("cell")).count()
    every = texts.sparkSession.range(1 << CELL_BITS).select(F.col("id").cast("int").alias("cell")).join(counts, "cell", "left")
    level = F.least(F.lit(63), F.floor(2 * F.log2(F.coalesce("count", F.lit(0)) + 1))).cast("string")
    listed = F.transform(F.sort_array(F.collect_list(F.struct("cell", level.alias("level")))), lambda x: x["level"])
    return F.split(F.lit(every.agg(F.array_join(listed, ",").alias("levels")).first().levels), ",").cast("array<bigint>")


def bounded(table: DataFrame, lines: str | None = None) -> DataFrame:
    """A staged table, marked for broadcast if its rows and the lines that it lists are few enough."""
    size = table.agg(F.count("*").alias("rows"), F.sum(F.size(lines) if lines else F.lit(0)).alias("lines")).first()
    return F.broadcast(table) if size.rows <= BROADCAST_ROWS and (size.lines or 0) <= BROADCAST_LINES else table


def line_classes(lines: DataFrame, levels: Column, percent: int) -> DataFrame:
    """digest, doc, at (the earliest line), copies, n (distinct tokens), first (hashes of the prefix), all_bits and high_bits."""
    some = lines.filter(F.trim("text") != "").select("doc", "at", line_digest(F.col("text")).alias("digest"), token_hashes(F.col("text")).alias("hashes"))
    cell = F.lit((1 << CELL_BITS) - 1)
    # a token's place in the order: the level of its cell, then its hash; numbers that can't be null are sorted as such
    places = F.transform("hashes", lambda h: F.shiftleft(F.coalesce(F.get(levels, h.bitwiseAND(cell)), F.lit(0).cast("bigint")), 32) + h)
    # bits of the parity of tokens (a shift takes the low six bits of its width): two of these differ in no more bits than there are
    # tokens in one set only; of small sets one word of them says enough
    every, high = (F.expr(f"aggregate(hashes, 0L, (a, h) -> a ^ shiftleft({one}, h))") for one in ("1L", "shiftrightunsigned(h, 31) + 0L"))
    n = F.size("hashes")
    placed = some.select("doc", "at", "digest", n.alias("n"), F.sort_array(places).alias("places"), every.alias("all_bits"), F.when(n > ONE_WORD, high).otherwise(0).alias("high_bits"))
    prefix = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    first = F.transform(F.slice("places", 1, prefix), lambda x: F.hash(x))
    lines = placed.select("digest", F.struct("doc", "at", "n", first.alias("first"), "all_bits", "high_bits").alias("c"))
    return lines.groupBy("digest").agg(F.min("c").alias("c"), F.count("*").alias("copies")).select("digest", "c.*", "copies")


def line_digest(line: Column) -> Column:
    """128 bits of the SHA-256 of a line, never null (a join would look for nulls, and make every digest twice)."""
    return F.coalesce(F.unhex(F.left(F.sha2(line, 256), F.lit(32))), F.lit(b""))


def differing() -> Column:
    """Tokens that are in one of two sets only, at least: the bits in which their signatures differ."""
    every = F.col("all_bits1").bitwiseXOR(F.col("all_bits2"))
    high = F.when(F.least("n1", "n2") > ONE_WORD, F.col("high_bits1").bitwiseXOR(F.col("high_bits2"))).otherwise(0)
    return F.bit_count(every.bitwiseXOR(high)) + F.bit_count(high)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once a row wherever use names it."""
    return F.get(F.transform(F.array(value), use), 0)


def matching(texts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(doc, at): the later lines (doc2, at2) of staged pairs of lines whose token sets match. texts has one row a (doc, mark), as given;
    those without a line in any pair are passed over."""
    ends = pairs.select(F.explode(F.array(*[F.struct(F.col(f"doc{k}").alias("doc"), F.col(f"at{k}").alias("at")) for k in (1, 2)])).alias("e")).select("e.*").distinct()
    wanted = ends.groupBy("doc", F.shiftright("at", 32).cast("int").alias("mark")).agg(F.collect_set(F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).alias("lines"))
    listed = texts.join(bounded(staged(wanted, "wanted"), "lines"), ["doc", "mark"]).withColumn("text", spaced(F.col("text")))
    split = listed.select("doc", "mark", F.explode(let(F.split("text", "\n", -1), lambda every: F.transform("lines", lambda i: F.struct(i.alias("line"), F.get(every, i).alias("text"))))).alias("x"))
    listed = staged(split.select("doc", line_place(F.col("mark"), F.col("x.line")).alias("at"), "x.text"), "lines")
    one, two = (listed.select(F.col("doc").alias(f"doc{k}"), F.col("at").alias(f"at{k}"), F.col("text").alias(f"text{k}")) for k in (1, 2))
    # texts are smaller than their words, so they are what is moved
    sets = F.struct(token_set(F.col("text1")).alias("a"), token_set(F.col("text2")).alias("b"))
    shared = let(sets, lambda x: F.struct(F.size(F.array_intersect(x["a"], x["b"])).alias("both"), (F.size(x["a"]) + F.size(x["b"])).alias("all")))
    both = pairs.join(one, ["doc1", "at1"]).join(two, ["doc2", "at2"]).filter(let(shared, lambda x: 100 * x["both"] >= percent * (x["all"] - x["both"])))
    return both.select(F.col("doc2").alias("doc"), F.col("at2").alias("at")).distinct()


def line_place(mark: Column, line: Column) -> Column:
    """One number for a line's place among the lines of all rows with one id."""
    return F.shiftleft(mark.cast("long"), 32).bitwiseOR(line.cast("long"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Removes every line whose token set matches that of an earlier line.

    Lines end with \\n; tokens are runs of anything but space and \\t..\\r, unchanged; lines match when 100 * shared tokens >=
    percent * all their tokens. Earlier means a smaller id (read as a long; null comes last), then a smaller line number; rows
    that repeat an id with another text come in the order of a hash of their texts. All lines are judged on the input. Lines
    without a token stay. A null text stays null and has no lines; an empty text has one empty line. Rows that repeat an id and
    its text are one document: they lose the same lines. An empty table gives none. Long texts and lines are read whole.

    Returns docs with text_col replaced, and two more columns, n_lines and n_removed long (named so, or with underscores in
    front where docs has such names).
    """
    doc_col, mark_col, gone_col, removed, lines_col = (fresh(docs, c) for c in ("doc", "mark", "gone", "n_removed", "n_lines"))
    text = F.col(text_col).cast("string")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    # texts need telling apart by more than their id only if an id repeats
    repeats = not docs.groupBy(doc.alias("doc")).count().filter("count > 1").isEmpty()
    mark = F.hash(text) if repeats else F.lit(0)
    # nulls go before anything is made of a text: a filter on what is made of it would make it twice
    texts = docs.filter(text.isNotNull()).select(doc.alias("doc"), mark.alias("mark"), text.alias("text"))
    lines = texts.select("doc", "mark", F.posexplode(F.split(spaced(F.col("text")), "\n", -1)).alias("line", "text")).select("doc", line_place(F.col("mark"), F.col("line")).alias("at"), "text")
    classes = staged(line_classes(lines, rarity_levels(texts), percent), "classes")

    once = texts.dropDuplicates(["doc", "mark"]) if repeats else texts

    # each class against the earliest classes that have two tokens drawn from its prefix
    who = ("doc", "at", "n", "all_bits", "high_bits")
    drawn = classes.select("doc", "at", F.sort_array("first").alias("drawn"), F.size("first").alias("m"))
    ends = [(F.lit(i), F.lit(j)) for i, j in combinations(range(DRAWN), 2)]
    ends += [(F.col("m") - 1 - j, F.col("m") - 1 - i) for i, j in ends]
    two_of = [F.when(F.greatest(i, j) < F.col("m"), F.hash(F.get("drawn", i), F.get("drawn", j))) for i, j in ends]
    rare = drawn.select("doc", "at", F.explode(F.array_distinct(F.array(*two_of))).alias("key")).filter("key is not null")
    # of several lines of the earliest document any one leads; these aggregates are kept in a hash table, a least pair would be sorted
    lead = rare.groupBy("key").agg(F.min("doc").alias("doc1"), F.min_by("at", "doc").alias("at1"), F.count("*").alias("sharers")).filter("sharers > 1")
    lead = bounded(staged(lead.select("key", "doc1", "at1"), "leads"))
    led = rare.select("key", F.col("doc").alias("doc2"), F.col("at").alias("at2")).join(lead, "key").filter("doc1 < doc2 or doc1 = doc2 and at1 < at2")
    led = staged(led.select("doc1", "at1", "doc2", "at2").distinct(), "led")
    for k in (1, 2):
        led = led.join(classes.select(*[F.col(c).alias(f"{c}{k}") for c in who]), [f"doc{k}", f"at{k}"])
    n1, n2 = F.col("n1"), F.col("n2")
    alike = (100 * n1 >= percent * n2) & (100 * n2 >= percent * n1) & ((100 + percent) * differing() <= (100 - percent) * (n1 + n2))
    led = staged(led.filter(alike).select("doc1", "at1", "doc2", "at2"), "led")
    settled = staged(matching(once, led, percent), "settled")

    # every pair of a class and one that is not longer, with a shared token in the prefix of either; the two sides read one exchange
    state = classes.join(bounded(settled).withColumn("settled", F.lit(0)), ["doc", "at"], "left").select(*who, "first", F.coalesce("settled", F.lit(1)).alias("open"))
    places = state.select("doc", "at", "n", "open", "all_bits", "high_bits", F.posexplode("first").alias("place", "token"))
    size = F.shiftleft(F.shiftleft(F.col("n").cast("long"), 1).bitwiseOR(F.col("open").cast("long")), 32).bitwiseOR(F.col("place").cast("long"))
    dealt = places.select("token", "doc", "at", size.alias("size"), "all_bits", "high_bits").repartition("token")
    n, rest = (e.cast("long") for e in (F.shiftright("size", 33), F.shiftright("size", 33) - F.col("size").bitwiseAND(F.lit((1 << 32) - 1))))
    one, two = (dealt.select("token", *[F.col(c).alias(f"{c}{k}") for c in ("doc", "at", "all_bits", "high_bits")], n.alias(f"n{k}"), rest.alias(f"rest{k}"), F.shiftright("size", 32).bitwiseAND(F.lit(1)).alias(f"open{k}")) for k in (1, 2))

    def band(size: Column) -> Column:
        return F.floor(F.log(size) / math.log(100 / percent + 0.01)).cast("int")

    # the shorter side is looked up in the size band of its own, the longer one in those of all sizes that it can match from its place
    # on; null meets nothing (a filter would be moved below the exchange, and either side get one of its own: none is to be inferred)
    n1, n2 = F.col("n1"), F.col("n2")
    one = one.withColumn("band", F.when((100 + percent) * F.col("rest1") >= 2 * percent * n1, band(n1)))
    least, most = F.ceil(percent * n2 / 100), F.least(n2, F.floor((100 + percent) * F.col("rest2") / percent) - n2)
    two = two.withColumn("band", F.explode_outer(F.when(most >= least, F.sequence(band(least), band(most)))))
    before = (F.col("doc1") < F.col("doc2")) | (F.col("doc1") == F.col("doc2")) & (F.col("at1") < F.col("at2"))
    alike = (100 * n1 >= percent * n2) & ((100 + percent) * F.least("rest1", "rest2") >= percent * (n1 + n2)) & ((100 + percent) * differing() <= (100 - percent) * (n1 + n2))
    later_open = F.when(before, F.col("open2")).otherwise(F.col("open1")) == 1
    found = one.hint("shuffle_hash").join(two, ["token", "band"]).filter(((n1 < n2) | (n1 == n2) & before) & alike & later_open)
    ends = [F.when(before, F.col(f"{c}{k}")).otherwise(F.col(f"{c}{3 - k}")).alias(f"{c}{k}") for k in (1, 2) for c in ("doc", "at")]
    # two sides that are dealt by one of the join's keys aren't dealt anew by both
    with setting(docs.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"), setting(docs.sparkSession, "spark.sql.constraintPropagation.enabled", "false"):
        pairs = staged(found.select(*ends).distinct(), "pairs")
    late = settled.union(matching(once, pairs, percent))

    # of a class whose earliest line goes all lines go, of another one all but that
    late = staged(late, "late").withColumn("late", F.lit(True))
    told = classes.select("digest", "doc", "at", "copies").join(late, ["doc", "at"], "left").filter("late or copies > 1")
    told = bounded(staged(told.select("digest", F.when(F.col("late").isNull(), F.col("doc")).alias("kept_doc"), F.when(F.col("late").isNull(), F.col("at")).alias("kept_at")), "told"))
    members = lines.filter(F.trim("text") != "").select("doc", "at", line_digest(F.col("text")).alias("digest")).join(told, "digest")
    gone = members.filter(~(F.col("doc").eqNullSafe(F.col("kept_doc")) & F.col("at").eqNullSafe(F.col("kept_at"))))
    gone = gone.groupBy(F.col("doc").alias(doc_col), F.shiftright("at", 32).cast("int").alias(mark_col)).agg(F.sort_array(F.collect_set(F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))).alias(gone_col))
    out = docs.withColumns({doc_col: doc, mark_col: mark}).join(bounded(staged(gone, "gone"), gone_col), [doc_col, mark_col], "left")
    kept = F.when(F.col(gone_col).isNull(), text).otherwise(let(F.split(text, "\n", -1), lambda every: kept_lines(every, F.col(gone_col))))
    count = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    cols = [kept.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return out.select(*cols, F.coalesce(count.cast("long"), F.lit(0).cast("long")).alias(lines_col), F.coalesce(F.size(gone_col).cast("long"), F.lit(0).cast("long")).alias(removed))


def kept_lines(lines: Column, gone: Column) -> Column:
    """The lines whose numbers are not in gone, joined."""
    return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n")
