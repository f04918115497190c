"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are the matches of four expressions.  The words around a seed make lexical patterns: the two words before
it, and the word on either side of it.  Candidates are what is left beside the seeds of words with the sign of an
address, and of runs of other words with digits.  Patterns
and the values that they hold form a graph, scored in turns: a pattern's confidence in a kind is the mean of
its values' scores, with PRIOR values of score 0 added; a candidate value's score is the probability that one of its patterns
is right (noisy or).  A candidate in a pattern of SURE confidence that is itself scored SURE becomes a span of the
kind, and counts as known in the next turn.  As a candidate counts against its own patterns, it takes a dozen
values of one kind around it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import written

KINDS = ["email", "ip", "card", "phone"]

# The expressions of the kinds.  Possessive repeats and the starts at a run's edge (or at the
# end of the last match) only spare retries that can't succeed; the matches are the plain expressions'.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a word of an address has: an at sign, one written out, or a dot before a letter.
SIGN = r"@|[(\[]at[)\]]|[\p{L}0-9]\.\p{L}"
CANDIDATE = (rf"(?<!\S)(?:(?=\S*?(?:{SIGN}))\S++"
             rf"|[^\s0-9]*+[0-9]\S*+(?:\x20(?!\S*?(?:{SIGN}))[^\s0-9]*+[0-9]\S*+)*+)")

ROUNDS = 3
SURE = 0.9
#: Score-0 values that a pattern starts with, and values of a kind that it must hold.
PRIOR = 0.3
SUPPORT = 3
#: Items of an array that are gathered one by one.
BLOCK = 256


_NONE = "cast(array() as array<struct<start:int,kind:int,end:int,value:string>>)"


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "card":
        # from the right, every second digit doubled, nine taken off above nine
        total = F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("i"), F.lit(0).alias("s")), lambda a, d: F.struct(
            (a["i"] + 1).alias("i"),
            (a["s"] + F.when(d == "", 0).when(a["i"] % 2 == 0, d.cast("int")).otherwise(
                (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int"))).cast("int").alias("s")), lambda a: a["s"])
        return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(False)
    return F.lit(True)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array in blocks of BLOCK items: what is gathered item by item is gathered within blocks, and then block by block,
    since every addition copies the array or text so far."""
    def block(at: Column) -> Column:  # slice() would copy the whole array first
        return F.transform(F.sequence(at, F.least(at + BLOCK, F.size(items)) - 1), lambda i: F.get(items, i))

    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.size(items) - 1, F.lit(BLOCK)), block)).otherwise(F.array())


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Matches of a pattern as structs start, kind, end, value, from the gaps between them (code points)."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    start = F.struct(F.lit(0).alias("at"), F.expr(_NONE).alias("out"))

    def step(a: Column, z: Column) -> Column:
        begin = a["at"] + F.length(z["gap"])
        end = begin + F.coalesce(F.length(z["match"]), F.lit(0))
        own = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), z["match"].alias("value"))
        return F.struct(end.alias("at"), F.when(z["match"].isNull(), a["out"]).otherwise(F.array_append(a["out"], own)).alias("out"))

    def placed(blocks: Column) -> Column:
        before = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")), lambda a, b: F.struct(
            (a["at"] + b["at"]).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(blocks, before, lambda b, at: F.transform(b["out"], lambda s: F.struct(
            (s["start"] + at).alias("start"), s["kind"].alias("kind"), (s["end"] + at).alias("end"), s["value"].alias("value")))))

    return _let(zipped, lambda z: _let(F.transform(_blocks(z), lambda block: F.aggregate(block, start, step)), placed))


_MAY = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}


def base_spans(text: Column) -> Column:
    """Base spans of a text, by start and then kind."""
    def of_kind(i: int, k: str) -> Column:
        return F.when(text.rlike(_MAY[k]), F.filter(_found(text, PATTERNS[k], i), lambda s: _valid(k, s["value"]))).otherwise(
            F.expr(_NONE))

    return F.sort_array(F.concat(*[of_kind(i, k) for i, k in enumerate(KINDS)]))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _last_end(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0), lambda a, s: F.greatest(a, s["end"]))


def _rewritten(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with put(end of the spans before, span) in place of what each span (by start) adds to those before it."""
    none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<low:int,high:int>>)").alias("out"))

    def regions(a: Column, block: Column) -> Column:  # from the last end before the block to the last one in it
        return _let(F.greatest(a["at"], _last_end(block)), lambda high: F.struct(
            high.alias("at"), F.array_append(a["out"], F.struct(a["at"].alias("low"), high.alias("high"))).alias("out")))

    def of_block(block: Column, region: Column) -> Column:
        def in_region(own: Column) -> Column:
            def step(a: Column, s: Column) -> Column:
                gap = F.substring(own, a["at"] - region["low"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
                return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], gap, put(a["at"], s)).alias("out"))

            return F.aggregate(block, F.struct(region["low"].alias("at"), F.lit("").alias("out")), step, lambda a: a["out"])

        return _let(F.substring(text, region["low"] + 1, region["high"] - region["low"]), in_region)

    def whole(blocks: Column) -> Column:
        return _let(F.aggregate(blocks, none, regions), lambda found: F.concat(
            F.array_join(F.zip_with(blocks, found["out"], of_block), ""), F.substring(text, found["at"] + 1, F.length(text))))

    return F.when(F.size(spans) > 0, _let(_blocks(spans), whole)).otherwise(text)


def _without(text: Column, spans: Column) -> Column:
    """The text with line feeds in place of the spans' characters."""
    return _rewritten(text, spans, lambda at, s: F.repeat(F.lit("\n"), F.greatest(s["end"] - F.greatest(at, s["start"]), F.lit(0))))


def _words_around(text: Column, start: Column, end: Column) -> tuple[Column, Column]:
    before = F.split(F.trim(F.regexp_replace(F.substring(text, F.greatest(start - 79, F.lit(1)), F.least(start, F.lit(80))), r"\s+", " ")), " ")
    after = F.split(F.trim(F.regexp_replace(F.substring(text, end + 1, F.lit(80)), r"\s+", " ")), " ")
    plain = lambda w: F.regexp_replace(F.lower(F.coalesce(w, F.lit(""))), r"[0-9]+", "0")
    last = plain(F.element_at(before, -1))
    two = F.when(F.size(before) > 1, F.concat_ws(" ", plain(F.get(before, F.size(before) - 2)), last))
    return two, F.concat(last, F.lit(" _ "), plain(F.get(after, F.lit(0))))


def _in_context(rows: DataFrame, spans: Column, kind: Column) -> DataFrame:
    """One row for each span, with the patterns around it; kind is its seed kind, from the span column s."""
    at = ["doc_id", "text_hash"]
    blocks = rows.select(*at, "text", F.explode(_let(spans, _blocks)).alias("block"))
    # a block's stretch of text with 80 characters on either side
    low = F.greatest(F.get("block", F.lit(0))["start"] - 80, F.lit(0))
    near = blocks.select(*at, low.alias("low"), F.substring("text", low + 1, _last_end(F.col("block")) + 80 - low).alias("near"), "block")
    two, both = _words_around(F.col("near"), F.col("s.start") - F.col("low"), F.col("s.end") - F.col("low"))
    return near.select(*at, "low", "near", F.explode("block").alias("s")).select(
        *at, "s.start", "s.end", "s.value", kind.alias("seed_kind"), F.array_compact(F.array(two, both)).alias("patterns"))


def _discovered(rows: DataFrame) -> DataFrame:
    """Spans doc_id, text_hash, start, kind, end that confident patterns add; rows: doc_id, text_hash, text, base."""
    seeds = _in_context(rows.where("size(base) > 0"), F.col("base"), F.col("s.kind"))
    wild = _in_context(rows, _found(_without(F.col("text"), F.col("base")), CANDIDATE, -1), F.lit(None).cast("int"))
    seen = written(seeds.unionAll(wild), "occurrences")
    # the graph: one row per pattern and value, however often they meet
    graph = written(seen.select(F.explode("patterns").alias("pattern"), "value", "seed_kind").groupBy("pattern", "value")
                    .agg(F.max("seed_kind").alias("seed_kind")), "graph")
    known = written(graph.where("seed_kind is not null").select(
        "value", F.col("seed_kind").alias("kind"), F.lit(1.0).alias("score"), F.lit(True).alias("seed")).distinct(), "known")
    held = graph.groupBy("pattern").agg(F.count("*").alias("values"))
    sure = None
    for _ in range(ROUNDS):
        scores = known.groupBy("value", "kind").agg(F.max("score").alias("score"))  # a found value may be a seed elsewhere
        sums = graph.join(scores, "value").groupBy("pattern", "kind").agg(
            F.sum("score").alias("total"), F.count("*").alias("support"))
        sure = written(sums.join(held, "pattern").withColumn("confidence", F.col("total") / (F.col("values") + PRIOR))
                       .where((F.col("support") >= SUPPORT) & (F.col("confidence") >= SURE))
                       .select("pattern", "kind", "confidence"), "patterns")
        found = (graph.where("seed_kind is null").join(sure, "pattern")
                 .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence") + 1e-9)))).alias("score"))
                 .where(F.col("score") >= SURE).withColumn("seed", F.lit(False)))
        known = written(known.where("seed").unionAll(found), "known")
    return written(seen.where("seed_kind is null").select("doc_id", "text_hash", "start", "end", "value", F.explode("patterns").alias("pattern"))
                   .join(sure, "pattern").join(known.where("not seed"), ["value", "kind"])
                   .select("doc_id", "text_hash", F.struct("start", "kind", "end", "value").alias("span")).distinct(), "added")


def personal_data(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every row: doc_id, text_hash, base (base spans) and spans (base and added ones).

    A span is a struct start, kind (index in KINDS), end, value; positions are code points, end exclusive.
    Both arrays are sorted by start and kind.  A null text counts as empty.  Rows with the same id and text
    get the same spans.  Columns other than id and text are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").withColumn("base", base_spans(F.col("text")))
    marked = written(rows.select("doc_id", "text_hash", "base", F.when(F.col("text").rlike(f"[0-9]|{SIGN}"), F.col("text")).alias("text")), "marked")
    added = (_discovered(marked.where("text is not null").dropDuplicates(["doc_id", "text_hash"]))
             .groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("more"))
             .select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "more"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    return marked.drop("text").join(added, same, "left").select(
        "doc_id", "text_hash", "base",
        F.sort_array(F.concat("base", F.coalesce("more", F.expr(_NONE)))).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans share one replacement."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    return _rewritten(text, spans, lambda at, s: F.when(s["start"] < at, "").otherwise(F.get(names, s["kind"])))


def op6_personal_data(spark, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [F.size(F.array_remove(F.transform("spans", lambda s: s["kind"] == i), F.lit(False))).cast("long").alias(f"n_{k}")  # noqa: B023
              for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
