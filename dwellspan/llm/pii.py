"""Personal data: exact base patterns, and identifiers found by bootstrapped contexts.

Base matches of four kinds are the seeds. Words with a digit or an @, runs of neighbouring digit groups
and addresses with a spelt at are instances; the one and two words before an instance are its patterns.
Instances and patterns form a weighted graph that Spark scores in turns: a pattern's score for a kind is the share of its occurrences whose instance scores
for that kind, smoothed; an instance's score is that of its best pattern, 1 for seeds. Instances that are
no seeds become spans of a kind where a pattern of high score precedes them.

All steps are DataFrame expressions. Positions are counted in code points: a text is split at
the matches, and lengths of pieces and matches add up. Quantifiers are possessive and matches
start at the end of the last one or behind a character that no match holds, which finds the same
matches in linear time. Sums of lengths run over short parts of a text's matches and then over the parts, and
overlaps with base spans are found by one sorted pass, so texts of very many matches cost little more than long ones.

A null text is empty. Each row is judged by itself, repeated ids too, and all rows weigh in the
graph; columns other than doc_id and text are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

KINDS = ("email", "ip", "card", "phone")
#: For each kind a cheap test and the pattern, in linear form.
BASE = {
    "email": (r"instr(text, '@') > 0", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"text rlike '[0-9]\\.[0-9]'", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"text rlike '[0-9](?:[\\x20-]?[0-9]){15}'", r"[0-9]++(?:[\x20-][0-9]++)*+"),
    "phone": (r"instr(text, '+') > 0", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_LUHN = f"aggregate(transform(sequence(1, length({_DIGITS})), i -> cast(substr({_DIGITS}, -i, 1) as int) * (2 - i % 2) - if(i % 2 = 0 and cast(substr({_DIGITS}, -i, 1) as int) > 4, 9, 0)), 0, (a, d) -> a + d) % 10 = 0"
#: What a match of each kind must be.
KEEP = {
    "email": "true",
    "ip": rf"x.m rlike '^{_OCTET}([.]{_OCTET}){{3}}$'",
    "card": f"length({_DIGITS}) between 16 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 8 and 15",
}
_NAME, _OPEN, _CLOSE = r"[A-Za-z0-9._%+-]++", r"\x20?+[(\[{]\x20?+", r"\x20?+[)\]}]\x20?+"
_DOT = rf"(?:\.|{_OPEN}(?i:dot){_CLOSE}|\x20++(?i:dot)\x20++)[A-Za-z0-9-]++"
#: Addresses written with words for @: any dots after a bracketed at, a spelt dot after a bare one.
_SPELT = rf"{_NAME}(?:{_OPEN}(?i:at){_CLOSE}[A-Za-z0-9-]++(?:{_DOT})*+|\x20++(?i:at)\x20++[A-Za-z0-9-]++(?:\x20++(?i:dot)\x20++[A-Za-z0-9-]++)++)[^\x20\x09-\x0D]*+"
_GROUP = r"[+(\[]*+[0-9][0-9()\[\]./-]*+(?=[,;:!?}>\x22\x27]*+(?![^\x20\x09-\x0D]))"
#: Instances: spelt addresses, runs of neighbouring digit groups, and words with a digit or @; at least MIN_CHARS long without the marks around them.
INSTANCE = rf"(?:\G|(?<![^\x20\x09-\x0D]))(?:{_SPELT}|[(\[{{<\x22\x27]*+{_GROUP}(?:(?<![.])[\x20\x09]++(?:-[\x20\x09]++)?+{_GROUP})*+[^\x20\x09-\x0D]*+|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)"
MIN_CHARS = 6
#: Characters before an instance that are kept if they hold its context words, else all up to the instance before; longer words stand as digests.
CONTEXT_CHARS = 64
ROUNDS, SMOOTHING, ACCEPT, MIN_SUPPORT = 3, 2.0, 0.8, 5
_SPANS = "array<struct<start:int,end:int,m:string,left:string>>"


def _escaped(regex: str) -> str:
    return regex.replace("\\", "\\\\")


_WORDS = r"[\\x20\\x09-\\x0D]+"


def _found(matches: str, pieces: str) -> str:
    """SQL for spans of matches, with the end of the piece before each.

    Appending to an array copies it, so arrays are appended to in parts of about the cube root of the number of matches.
    """
    near = f"if(size(split(right(p, {CONTEXT_CHARS}), '{_WORDS}', 4)) > 3 or length(p) <= {CONTEXT_CHARS}, right(p, {CONTEXT_CHARS}), p)"
    all_ = f"zip_with({matches}, slice({pieces}, 1, size({matches})), (m, p) -> struct(m, length(p) as gap, {near} as near))"
    part = f"cast(greatest(16, ceil(cbrt(size({matches})))) as int)"
    parts = f"transform(sequence(0, (size({matches}) - 1) div {part}), k -> slice(x, cast(k * {part} + 1 as int), {part}))"
    starts = f"aggregate({{}}, struct(0 as pos, cast(array() as array<int>) as out), (a, y) -> struct(a.pos + aggregate(y, 0, (n, z) -> n + z.gap + length(z.m)) as pos, array_append(a.out, a.pos) as out), a -> a.out)"
    spans = (
        f"flatten(zip_with(ps, {starts.format('ps')}, (y, s) -> aggregate(y, struct(s as pos, cast(array() as {_SPANS}) as out), "
        "(a, z) -> struct(a.pos + z.gap + length(z.m) as pos, array_append(a.out, named_struct('start', a.pos + z.gap, 'end', a.pos + z.gap + length(z.m), 'm', z.m, 'left', z.near)) as out), a -> a.out)))"
    )
    # transform over one element names an expression, so that it is computed once
    return f"if(size({matches}) > 0, transform(transform(array({all_}), x -> {parts}), ps -> {spans})[0], cast(array() as {_SPANS}))"


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id and, for each kind and for instances, an array of spans (start, end, m, left)."""
    out = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = {**BASE, "instance": (r"text rlike '[0-9@]|(?i)[(\\[{\\x20]at[)\\]}\\x20]'", INSTANCE)}
    names = [*kinds]
    keep = KEEP | {"instance": "true"}
    out = out.select("doc_id", "text", *(F.expr(f"if({test}, regexp_extract_all(text, '{_escaped(regex)}', 0), cast(array() as array<string>))").alias(f"{k}_m") for k, (test, regex) in kinds.items()))
    out = out.select("doc_id", *(f"{k}_m" for k in names), *(F.expr(f"if(size({k}_m) > 0, split(text, '{_escaped(regex)}'), null)").alias(f"{k}_p") for k, (_, regex) in kinds.items()))
    out = out.select("doc_id", *(F.expr(_found(f"{k}_m", f"{k}_p")).alias(k) for k in names))
    return out.select("doc_id", *(F.expr(f"filter({k}, x -> {keep[k]})").alias(k) for k in names))


def instances(found: DataFrame) -> DataFrame:
    """Occurrences of instances: row, start, end, instance, seed (its kind or null), pattern; one row for each pattern."""
    holds = " or ".join(f"size({k}) > 0" for k in KINDS)
    texts = found.filter(F.size("instance") > 0)
    alone = texts.filter(f"not ({holds})").select("row", F.explode("instance").alias("o"), F.lit(None).cast("string").alias("seed"))
    # spans of a kind don't overlap, so of those that start before an instance's end only the last may reach into it
    beside = texts.filter(holds)
    events = beside.select("row", F.explode("instance").alias("o"), *(F.lit(None).cast("int").alias(f"{k}_end") for k in KINDS)).select("row", F.col("o.end").alias("at"), F.lit(0).alias("side"), "o", *(f"{k}_end" for k in KINDS))
    for kind in KINDS:
        ends = (F.col("s.end").alias(f"{k}_end") if k == kind else F.lit(None).cast("int").alias(f"{k}_end") for k in KINDS)
        spans = beside.select("row", F.explode(kind).alias("s")).select("row", F.col("s.start").alias("at"), F.lit(1).alias("side"), F.lit(None).cast(events.schema["o"].dataType).alias("o"), *ends)
        events = events.union(spans)
    before = Window.partitionBy("row").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    reach = events.select("row", "o", "side", *(F.max(f"{k}_end").over(before).alias(f"{k}_end") for k in KINDS)).filter("side = 0")
    seed = F.coalesce(*(F.when(F.col(f"{k}_end") > F.col("o.start"), k) for k in KINDS))
    rows = alone.union(reach.select("row", "o", seed.alias("seed")))
    rows = rows.withColumn("head", F.expr(r"length(regexp_extract(o.m, '^(?:[{<\"\']|[(\\[](?![0-9+]++[)\\]][^()\\[\\]]*[0-9]))*', 0))")).withColumn("tail", F.expr(r"length(regexp_extract(o.m, '[.,;:!?)\\]}>\"\']*$', 0))"))
    rows = rows.select(
        "row", "seed", F.expr("o.start + head").alias("start"), F.expr("o.end - tail").alias("end"),
        F.expr("lower(substr(o.m, head + 1, length(o.m) - head - tail))").alias("instance"),
        F.expr(f"filter(split(lower(o.left), '{_WORDS}'), w -> w != '')").alias("near"),
    )
    rows = rows.withColumn("near", F.expr(f"transform(slice(near, greatest(1, size(near) - 1), 2), w -> if(length(w) > {CONTEXT_CHARS}, sha2(w, 256), w))"))
    rows = rows.filter(f"size(near) > 0 and (seed is not null or end - start >= {MIN_CHARS})")
    patterns = F.expr("array_compact(array(concat('1 ', element_at(near, -1)), if(size(near) > 1, concat('2 ', element_at(near, -2), ' ', element_at(near, -1)), null)))")
    return rows.select("row", "seed", "start", "end", "instance", F.explode(patterns).alias("pattern"))


def pattern_scores(occurrences: DataFrame) -> DataFrame:
    """pattern, kind, score of the patterns to accept, after ROUNDS turns over the graph."""
    edges = written(occurrences.groupBy("instance", "pattern", "seed").agg(F.count("*").alias("n")), "pii-edges")
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = edges.filter("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scored = seeds
    for _ in range(ROUNDS):
        weight = edges.join(scored, "instance").groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("weight"), F.count_distinct("instance").alias("support"))
        patterns = written(weight.join(totals, "pattern").select("pattern", "kind", "support", (F.col("weight") / (F.col("total") + SMOOTHING)).alias("score")), "pii-patterns")
        good = patterns.filter((F.col("support") >= MIN_SUPPORT) & (F.col("score") >= ACCEPT / 2))
        fresh = edges.filter("seed is null").join(good, "pattern").groupBy("instance", "kind").agg(F.max("score").alias("score"))
        scored = seeds.union(fresh).groupBy("instance", "kind").agg(F.max("score").alias("score"))
    return patterns.filter((F.col("support") >= MIN_SUPPORT) & (F.col("score") >= ACCEPT))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of base spans, and all spans as text."""
    found = written(base_spans(docs).withColumn("row", F.monotonically_increasing_id()), "pii-spans")
    occurrences = instances(found)
    good = pattern_scores(occurrences)
    hits = occurrences.filter("seed is null").join(good, "pattern").groupBy("row", "start", "end").agg(F.max(F.struct("score", "kind"))["kind"].alias("kind"))
    hits = hits.groupBy(F.col("row").alias("hit_row")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    joined = found.join(hits, found.row == hits.hit_row, "left")
    text = lambda k, spans: f"transform(array_sort({spans}), s -> concat('{k}:', s.start, ':', s.end))"
    plain = lambda k: f"transform({k}, s -> named_struct('start', s.start, 'end', s.end))"
    extra = lambda k: f"transform(filter(coalesce(more, array()), s -> s.kind = '{k}'), s -> named_struct('start', s.start, 'end', s.end))"
    base = "concat_ws(',', " + ", ".join(text(k, plain(k)) for k in KINDS) + ")"
    every = "concat_ws(',', " + ", ".join(text(k, f"concat({plain(k)}, {extra(k)})") for k in KINDS) + ")"
    return joined.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(F.expr(base), 256).alias("base_sha256"), F.expr(every).alias("spans"))


def op4_pii_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
