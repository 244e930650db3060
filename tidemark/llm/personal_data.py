"""Personal data: e-mail addresses, IP addresses, card and phone numbers by pattern, then further ones by what stands before them.

What the patterns find are seeds. Every word with a digit or `@`, with the digit words behind it, is an instance; the last word or
two words before it are its lexical patterns. Patterns and instances form a graph. In each round a pattern's confidence for a kind
is the share of its distinct instances that are known to be of that kind; confident patterns then vouch for their other
instances, which are known from the next round on if they look like the kind and the patterns together are sure enough. Known
instances are only ever added, so the rounds end by themselves. All in DataFrame operations, on distinct pairs of pattern and
instance; texts are read once and never moved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, staged

#: The kinds in the order in which their spans are listed.
KINDS = ("email", "ip", "card", "phone")
#: What each kind looks like. A possessive quantifier finds what a greedy one does where nothing can be given back, and
#: an attempt begins only where a run of its first class does, or where the last match ended: the time is linear in the text.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: An instance, its part without marks around it, and what an instance must look like to be of a kind that no pattern above finds.
INSTANCE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+(?:\x20[(+]?[0-9][^\x20\x09-\x0D]*+)*+"
CORE = r"(?s)[\p{L}\p{N}+(](?:.*[\p{L}\p{N})])?"
LIKE = {"email": r"^[^@\s]{1,64}@[^@\s]{1,189}$", "ip": r"^(?=(?:[^.:]*[.:]){3})[0-9A-Fa-fx.:*]{7,45}$", "card": r"^(?:[\x20.-]?[0-9]){12,19}$", "phone": r"^[+(]?(?:[\x20()./-]{0,2}[0-9]){7,15}\)?$"}
#: Characters of context in which the words before an instance are looked for, and length from which an instance goes by its digest.
CONTEXT, LONG = 64, 254
#: Distinct known instances that a pattern needs, its least confidence, and what the confidences of an instance's patterns must come to together.
SUPPORT, CONFIDENT, KNOWN = 5, 0.6, 0.75
#: Rows of a few short texts that are broadcast after they are counted; more are shuffled.
BROADCAST_ROWS = 100_000

SPAN = "array<struct<start:int,kind:int,stop:int>>"


def running_sum(lengths: str) -> str:
    """SQL of the running sums of an array: each round adds what stands 2 ** k places before, log n rounds of n steps."""
    return f"aggregate(sequence(0, int(ceil(log2(greatest(size({lengths}), 1))))), {lengths}, (acc, k) -> transform(acc, (x, i) -> x + coalesce(get(acc, i - shiftleft(1, k)), 0)))"


def located(df: DataFrame, text: str, pattern: str, hint: Column, out: str) -> DataFrame:
    """Adds the matches of a pattern as (match, before, stop): the text since the last match, and the end in code points; null for
    a text without any. hint: what a text with matches satisfies."""
    raw = fresh(df, "raw", out)
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.when(hint, F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda m, p: F.struct(m.alias("match"), p.alias("before"))))
    ends = F.expr(running_sum(f"transform({raw}, m -> length(m.before) + length(m.match))"))
    whole = F.zip_with(raw, ends, lambda m, stop: F.struct(m["match"].alias("match"), m["before"].alias("before"), stop.alias("stop")))
    return df.withColumn(raw, both).withColumn(out, F.when(F.size(raw) > 0, whole)).drop(raw)


def fine(kind: str, match: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"),
        "card": F.length(digits).between(14, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(10, 15),
    }[kind]


def span_of(i: int, kind: str) -> Callable[[Column], Column]:
    """A match to its span, null if the match doesn't count."""
    return lambda m: F.when(fine(kind, m["match"]), F.struct((m["stop"] - F.length(m["match"])).alias("start"), F.lit(i).alias("kind"), m["stop"].alias("stop")))


def base_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the spans that the patterns find, leftmost and not overlapping for each kind, as (start, kind, stop) in order."""
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    hint = {"email": F.contains(F.col(text), F.lit("@")), "ip": F.col(text).rlike(r"[0-9]\.[0-9]"), "card": F.col(text).rlike(r"[0-9][\x20-]?[0-9]"), "phone": F.contains(F.col(text), F.lit("+"))}
    names = {k: fresh(df, "found", k) for k in KINDS}
    own, none = df, F.array().cast(SPAN)
    for k in KINDS:
        own = located(own, text, patterns[k], hint[k], names[k])
    parts = [F.coalesce(F.filter(F.transform(names[k], span_of(i, k)), lambda s: s.isNotNull()), none) for i, k in enumerate(KINDS)]
    return own.withColumn(out, F.array_sort(F.concat(*parts)).cast(SPAN)).drop(*names.values())


def instances(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds every instance of a text: start, stop, value (lower case), seed (the kind whose pattern is all of it), like (kinds that
    it looks like; none if a pattern finds part of it) and patterns."""
    name = fresh(df, "all", "instances")
    own = located(df, text, INSTANCE, F.col(text).rlike("[0-9@]"), name)

    def one(m: Column, at: Column) -> Column:
        match, before = m["match"], m["before"]
        core = F.regexp_extract(match, CORE, 0)
        start = m["stop"] - F.length(match) + F.instr(match, core) - 1
        seed = F.coalesce(*[F.when(core.rlike(f"^(?:{p})$") & fine(k, core), F.lit(i)) for i, (k, p) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))])
        part = core.rlike(f"{EMAIL}|{IP}") | (F.contains(core, F.lit("+")) & core.rlike(PHONE) & F.length(F.regexp_replace(core, "[^0-9]", "")).between(10, 15))
        like = F.filter(F.array(*[F.when(core.rlike(LIKE[k]), F.lit(i)) for i, k in enumerate(KINDS)]), lambda x: x.isNotNull())
        # the words before it, and what stands for an instance where one comes first
        words = F.regexp_extract_all(F.lower(F.right(before, F.lit(CONTEXT))), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
        words = F.concat(F.when(at > 0, F.array(F.lit("<id>"))).otherwise(F.array().cast("array<string>")), words)
        last, prior = F.try_element_at(words, F.lit(-1)), F.try_element_at(words, F.lit(-2))
        value = F.lower(core)
        return F.struct(
            start.alias("start"), (start + F.length(core)).alias("stop"), F.when(F.length(value) > LONG, F.sha2(value, 256)).otherwise(value).alias("value"), seed.alias("seed"),
            F.when(seed.isNull() & ~part & (F.length(value) <= LONG), like).otherwise(F.array().cast("array<int>")).alias("like"),
            F.array_compact(F.array(last, F.concat_ws(" ", F.when(last.isNotNull(), prior), F.when(prior.isNotNull(), last)))).alias("patterns"),
        )

    found = F.filter(F.transform(F.col(name), one), lambda x: x["stop"] > x["start"])
    return own.withColumn(out, F.coalesce(found, F.array().cast("array<struct<start:int,stop:int,value:string,seed:int,like:array<int>,patterns:array<string>>>"))).drop(name)


def bounded(df: DataFrame) -> DataFrame:
    """A staged table, to be broadcast if it has few rows of bounded width."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def discovered(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, patterns) after the last round: (value, kind, score) of instances that no pattern of a kind finds, and (pattern, kind,
    confidence). seen: value, seed, like and patterns of every instance."""
    pairs = seen.select("value", "seed", "like", F.explode("patterns").alias("pattern")).filter("pattern <> ''")
    # seed and like follow from the value
    edges = staged(pairs.groupBy("pattern", "value").agg(F.first("seed").alias("seed"), F.first("like").alias("like")), "edges")
    sizes = staged(edges.groupBy("pattern").agg(F.count("*").alias("n")), "sizes")
    seeds = edges.filter("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    known, before = staged(seeds, "known"), -1
    while True:
        n = known.count()
        counted = edges.join(bounded(known), "value").groupBy("pattern", "kind").agg(F.count("*").alias("n_known")).filter(F.col("n_known") >= SUPPORT)
        sure = counted.join(sizes, "pattern").withColumn("confidence", F.col("n_known") / (F.col("n") + 1.0)).filter(F.col("confidence") >= CONFIDENT)
        patterns = staged(sure.select("pattern", "kind", "confidence"), "patterns")
        if n == before:
            return known.join(seeds, ["value", "kind"], "left_anti"), patterns
        before = n
        vouched = edges.filter("seed is null and size(like) > 0").join(bounded(patterns), "pattern").filter(F.array_contains("like", F.col("kind")))
        score = 1.0 - F.exp(F.sum(F.log(1.0 - F.col("confidence"))))
        found = vouched.groupBy("value", "kind").agg(score.alias("score")).filter(F.col("score") >= KNOWN)
        more = seeds.unionByName(found).unionByName(known).groupBy("value", "kind").agg(F.max("score").alias("score"))
        known = staged(more, "known")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every text as spans (start, kind, stop): base, what the patterns of KINDS find, and spans, with what is
    found by context too.

    Positions are in code points, stop exclusive, in order of start, then kind as KINDS lists them. A null text counts as
    empty. Repeated rows and null ids are rows like others; copies of a text count once as evidence. Texts may be of any length;
    time is linear in them but for a logarithm of the number of matches. An instance goes by one kind, the one of the greatest
    score, then the first. A span found by context overlaps no base span. An empty table gives none; other columns are ignored.

    Returns id_col, base, spans.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # rows are numbered where they are written, so that the numbers stay when a task is repeated
    rows = base_spans(docs.select(F.col(id_col).alias("id"), text.alias("text")), "text", "base")
    rows = staged(instances(rows, "text", "seen").select(F.monotonically_increasing_id().alias("row"), "id", "base", "seen"), "rows")
    seen = rows.filter("size(seen) > 0").select("row", F.explode("seen").alias("s")).select("row", "s.*")
    known, _ = discovered(seen)
    kinds = known.groupBy("value").agg(F.min(F.struct(-F.col("score"), F.col("kind").alias("kind")))["kind"].alias("kind"))
    met = seen.filter("size(like) > 0").join(bounded(staged(kinds, "kinds")), "value").select("row", "start", "kind", "stop", F.lit(True).alias("new"))
    met = staged(met, "met")
    # the base spans of the rows concerned, to see what overlaps
    base = rows.join(met.select("row").distinct(), "row", "left_semi").select("row", F.explode("base").alias("b")).select("row", "b.start", "b.kind", "b.stop", F.lit(False).alias("new"))
    by_start = Window.partitionBy("row").orderBy("start", "stop")
    before = F.max(F.when(~F.col("new"), F.col("stop"))).over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(~F.col("new"), F.col("start"))).over(by_start.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    free = met.unionByName(base).withColumns({"before": before, "after": after}).filter("new and coalesce(before <= start, true) and coalesce(after >= stop, true)")
    more = free.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("more"))
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return rows.select("row", "id", "base").join(more, "row", "left").select(F.col("id").alias(id_col), "base", spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
