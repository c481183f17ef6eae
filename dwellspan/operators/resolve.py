"""Noisy text to a closed list of names, and recurring strings that no name fits.

The similarity of strings is the Ratcliff-Obershelp ratio, which Spark has not; each distinct string meets
the names through an inverted index (``alike``), and only pairs whose bounds allow a result are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_name
from .alike import Held, alike, closest, ratio
from .lineage import cut

# Scores from which names match, and their margin.
MIN_MATCH, MARGIN = 0.62, 0.03
CONTAINED, CONTAINED_CHARS, CONTAINED_SHARE = 0.86, 6, 0.60
MERGE, LOOSE_CONTAINED = 0.75, 0.88
#: Distinct strings of the first turn of leaders; each later one takes as many as all before.
FIRST_TURN = 4096


def name_index(names: DataFrame, name: str = "name", aliases: str = "aliases") -> DataFrame:
    """name, norm: one row for each spelling of each name."""
    spelled = names.select(F.col(name).alias("name"), F.explode(F.concat(F.array(name), F.coalesce(F.col(aliases), F.array().cast("array<string>")))).alias("spelling"))
    return spelled.select("name", norm_name(F.col("spelling")).alias("norm")).filter("norm != ''").distinct()


def best_names(tokens: DataFrame, index: DataFrame, min_match: float = MIN_MATCH) -> DataFrame:
    """a (a normalised token of 3 letters at least), name and score: the name that fits, none if another one fits about as well, and the best score of all names."""
    pairs = alike(tokens.filter(F.length("a") >= 3), index.select(F.col("norm").alias("b")), margin=MARGIN, held=Held(CONTAINED, CONTAINED_CHARS, CONTAINED_SHARE))
    fits = pairs.join(index.withColumnRenamed("norm", "b"), "b").groupBy("a", "name").agg(F.max("fit").alias("fit"))
    best = fits.groupBy("a").agg(F.max("fit").alias("score"))
    near = fits.join(best, "a").filter(F.col("score") - F.col("fit") < MARGIN).groupBy("a", "score").agg(F.max_by("name", "fit").alias("name"), F.count("*").alias("rivals"))
    return near.select("a", F.when((F.col("score") >= min_match) & (F.col("rivals") == 1), F.col("name")).alias("name"), "score")


def resolve(tokens: DataFrame, index: DataFrame, token: str = "token", min_match: float = MIN_MATCH) -> DataFrame:
    """tokens with name and match (the score): exact spellings by a join, the others once a distinct string."""
    normed = tokens.withColumn("norm_", norm_name(F.col(token)))
    unique = index.groupBy("norm").agg(F.min("name").alias("exact_"), F.count_distinct("name").alias("n_")).filter("n_ = 1").drop("n_")
    hit = normed.join(unique, normed.norm_ == unique.norm, "left").drop("norm")
    fuzzy = best_names(hit.filter("exact_ is null").select(F.col("norm_").alias("a")).distinct(), index, min_match)
    out = hit.join(fuzzy.select(F.col("a").alias("r_"), F.col("name").alias("fuzzy_"), F.col("score").alias("score_")), F.col("norm_") == F.col("r_"), "left")
    return out.select(*[F.col(f"`{c}`") for c in tokens.columns], F.coalesce("exact_", "fuzzy_").alias("name"), F.when(F.col("exact_").isNotNull(), 1.0).otherwise(F.coalesce("score_", F.lit(0.0))).alias("match"))


def many_matches(text: str, names: Sequence[tuple[str, str]]) -> list[tuple[str, float]]:
    """(name, score) of all names that a spaced, normalised text may hold, the best first; short names must fit better."""
    words, out = text.split(), []
    for norm, name in names:
        if not norm:
            continue
        n = len(norm.split())
        parts = [text, *words, *(" ".join(words[i : i + n]) for i in range(len(words) - n + 1) if n > 1)]
        fit = 1.0 if norm in text else max(ratio(norm, p) for p in parts)
        if fit >= (0.85 if len(norm.replace(" ", "")) <= 4 else 0.65):
            out.append((name, fit))
    return sorted(out, key=lambda x: -x[1])


def search_rank(query: str, names: Sequence[str]) -> list[str]:
    """Names for a typed query: those that begin with it, hold it, or are alike, in this order."""
    q = query.strip().upper()
    if not q:
        return list(names)

    def rank(n: str) -> float:
        share = len(q) / max(len(n), 1)
        return 3 + share if n.startswith(q) else 2 + share if q in n else ratio(q, n)

    ranked = [(-rank(n), n) for n in names]
    return [n for r, n in sorted(ranked) if -r >= 0.45]


def _turns(strings: DataFrame) -> DataFrame:
    """strings (with conf and norm) with their turn: each takes about as many of the order as all turns before, the first FIRST_TURN."""
    n = strings.count()
    shares = []
    upto = FIRST_TURN
    while upto < n:
        shares.append(upto / n)
        upto *= 2
    if not shares:
        return strings.withColumn("turn", F.lit(0))
    # cuts between turns needn't be exact, only in order
    sample = strings.select("conf", "norm").orderBy(F.xxhash64("norm", "conf")).limit(20_000).orderBy(F.desc("conf"), "norm").collect()
    cuts = [sample[int(s * len(sample))] for s in shares]
    later = [F.when((F.col("conf") < c.conf) | ((F.col("conf") == c.conf) & (F.col("norm") >= c.norm)), 1).otherwise(0) for c in cuts]
    return strings.withColumn("turn", sum(later, F.lit(0)))


def _heads(edges: DataFrame, strings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The leaders among strings: those none of whose earlier neighbours leads. edges: keys, norm, earlier.

    A string leads when all its earlier neighbours are known to follow, and follows when one of them leads; the others wait for the next round.
    """
    on = [*keys, "norm"]
    rest, edges = cut(strings.select(*on)), cut(edges)
    heads = rest.limit(0)
    while True:
        new = cut(rest.join(edges.select(*on).distinct(), on, "left_anti"))
        heads = heads.unionByName(new)
        if edges.isEmpty():
            return heads
        earlier = [F.col(k).alias(k) for k in keys] + [F.col("norm").alias("earlier")]
        following = edges.join(new.select(*earlier), [*keys, "earlier"], "left_semi").select(*on).distinct()
        gone = following.unionByName(new)
        rest = cut(rest.join(gone, on, "left_anti"))
        edges = cut(edges.join(gone, on, "left_anti").join(following.select(*earlier), [*keys, "earlier"], "left_anti"))


def leaders(strings: DataFrame, keys: Sequence[str], merge: float = MERGE) -> DataFrame:
    """keys, norm and lead of strings (keys, norm, conf; one row each): taken by falling confidence, a string joins the nearest earlier leader that is alike or leads itself.

    Equal to taking them one by one, but a key need not be one task: strings come in turns that grow, those of a turn first meet
    the leaders so far, so that a family of like strings meets its leader and not itself, and only what follows none of these is compared with its like.
    """
    keys, held = list(keys), Held(LOOSE_CONTAINED)
    on = [*keys, "norm"]
    earlier = (F.col("l_conf") > F.col("conf")) | ((F.col("l_conf") == F.col("conf")) & (F.col("l_norm") < F.col("norm")))

    def edges(own: DataFrame, others: DataFrame) -> DataFrame:
        """keys, norm, conf, l_norm, l_conf, fit of like pairs whose second lies earlier."""
        left, right = own.select(*keys, F.col("norm").alias("a")), others.select(*keys, F.col("norm").alias("b"))
        pairs = alike(left, right, keys, merge, held=held).select(*keys, F.col("a").alias("norm"), F.col("b").alias("l_norm"), "fit")
        return pairs.join(own.select(*on, "conf"), on).join(others.select(*keys, F.col("norm").alias("l_norm"), F.col("conf").alias("l_conf")), [*keys, "l_norm"]).filter(earlier)

    held_strings = cut(_turns(strings.select(*on, "conf")))
    heads = held_strings.limit(0).drop("turn")
    for turn in range((held_strings.agg(F.max("turn")).first()[0] or 0) + 1):
        own = held_strings.filter(F.col("turn") == turn).drop("turn")
        if turn:
            own = own.join(edges(own, heads).select(*on).distinct(), on, "left_anti")
            own = cut(own)
        found = _heads(edges(own, own).select(*on, F.col("l_norm").alias("earlier")), own, keys)
        heads = cut(heads.unionByName(found.join(own, on)))
    strings = held_strings.drop("turn")
    best = edges(strings.join(heads, on, "left_anti"), heads).groupBy(*on).agg(F.min_by("l_norm", F.struct(-F.col("fit"), -F.col("l_conf"), "l_norm")).alias("lead"))
    return heads.select(*on, F.col("norm").alias("lead")).unionByName(best)


def unknown_clusters(hits: DataFrame, keys: Sequence[str], index: DataFrame, min_seconds: float = 1.0, min_frames: int = 4, min_chars: int = 4, min_conf: float = 0.60, max_similar: float = 0.45) -> DataFrame:
    """Candidate names among unmatched strings: keys, name, norm, seconds, frames, mean_conf, sim_to_listed, promoted, rejected_for.

    hits: keys, norm, text, conf, frame, seconds (what a frame stands for). Strings of a key are
    clustered once each; counts and sums stay in Spark. Hits are never broadcast: repeated strings make small files, by which Spark
    would take millions of them for a small table. So spellings are counted before they meet their leader, and frames meet it by a merge.
    """
    distinct = hits.groupBy(*keys, "norm").agg(F.max("conf").alias("conf"))
    led = cut(leaders(distinct, keys))
    own = hits.select(*keys, "norm", "frame", "seconds").hint("merge").join(led, [*keys, "norm"])
    frames = own.select(*keys, "lead", "frame", "seconds").distinct().groupBy(*keys, "lead").agg(F.sum("seconds").alias("seconds"), F.count("*").alias("frames"))
    counted = hits.groupBy(*keys, "norm", "text").agg(F.count("*").alias("n"), F.max("conf").alias("c"), F.sum("conf").alias("sum"), F.count("conf").alias("known"))
    sums = [F.sum(x).alias(x) for x in ("n", "sum", "known")]
    spelled = counted.hint("merge").join(led, [*keys, "norm"]).groupBy(*keys, "lead", "text").agg(F.max("c").alias("c"), *sums)
    name = spelled.groupBy(*keys, "lead").agg(F.max_by("text", F.struct("n", "c", "text")).alias("name"), F.try_divide(F.sum("sum"), F.sum("known")).alias("mean_conf"))

    out = cut(frames.hint("merge").join(name, [*keys, "lead"]).withColumn("a", norm_name(F.col("name"))))
    near = closest(out.select("a"), index.select(F.col("norm").alias("b")), Held(LOOSE_CONTAINED))
    out = out.join(near, "a").drop("a").withColumnRenamed("fit", "sim_to_listed")
    digits = F.regexp_count("lead", F.lit("[0-9]")) / F.greatest(F.length("lead"), F.lit(1))
    reasons = F.array_compact(F.array(
        F.when((F.col("seconds") < min_seconds) | (F.col("frames") < min_frames), "too brief"), F.when(F.length("lead") < min_chars, "too short"),
        F.when(F.col("mean_conf") < min_conf, "low confidence"), F.when(F.col("sim_to_listed") >= max_similar, "like a listed name"), F.when(digits >= 0.6, "mostly digits"),
    ))
    return out.withColumn("rejected_for", reasons).withColumn("promoted", F.size("rejected_for") == 0).withColumnRenamed("lead", "norm")
