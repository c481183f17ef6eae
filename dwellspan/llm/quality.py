"""Quality rules: a table of thresholds compiled into column expressions, without user functions.

Words are runs of [^\\x20\\x09-\\x0D]; lines are split at \\n. A null text has no words and is rejected by
the base rules. Each row is judged by itself, so repeated rows get equal verdicts; ``judge`` keeps
all columns and replaces those it computes; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table

WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
SYMBOLS = "[#*$%&|<>]"
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = tuple(
    "the of and to in is that for with on as by at was be this it are from or an "
    "der die und das von zu mit den ist ein nicht auf im eine auch sich des dem "
    "le la les de et un une dans que pour pas par sur est en au du "
    "el y los del las por con su se lo como".split()
)


@dataclass(frozen=True)
class Rule:
    """A ratio (SQL over the measures) that must lie between low and high."""

    name: str
    ratio: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean_word_chars", "word_chars / greatest(n_words, 1)", 2.0, 14.0),
    Rule("symbols_a_word", "n_symbols / greatest(n_words, 1)", high=0.25),
    Rule("stop_word_share", "(n_stop_words + 1) / (n_words + 10)", low=0.03),  # smoothed, as few words say little
    Rule("lettered_word_share", "n_lettered_words / greatest(n_words, 1)", low=0.7),
    Rule("duplicate_line_share", "n_dup_lines / greatest(n_lines, 1)", high=0.5),
    Rule("ellipsis_line_share", "n_ellipsis_lines / greatest(n_lines, 1)", high=0.5),
    Rule("bullet_line_share", "n_bullet_lines / greatest(n_lines, 1)", high=0.9),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lettered_words", "n_lines", "n_dup_lines", "n_ellipsis_lines", "n_bullet_lines", "n_repeat_words")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean expression over the measures: all ratios within their bounds."""
    tests = [f"({r.ratio}) {op} {bound}" for r in rules for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None]
    return F.expr(" and ".join(f"({t})" for t in tests) or "true")


def measured(docs: DataFrame, stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """docs with MEASURES added. Every step is a projection; windows that repeat are found by 64-bit hashes within a text."""
    clash = [c for c in docs.columns if c.lower().startswith("qr_")]
    if clash:  # the steps' own names; they get theirs back at the end
        free = f"held_{max(map(len, docs.columns)) * 'x'}_"
        out = measured(docs.withColumnsRenamed({c: f"{free}{k}" for k, c in enumerate(clash)}), stop_words)
        return out.withColumnsRenamed({f"{free}{k}": c for k, c in enumerate(clash)})
    names = [c for c in docs.columns if c not in MEASURES]
    own = [F.col(f"`{c}`") for c in names]
    stop = ", ".join(f"'{w}'" for w in stop_words)
    ngram = ", ".join(f"get(qr_h, i + {k})" for k in range(WINDOW))
    steps = [
        {
            "qr_words": r"coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), array())",
            "qr_lines": r"filter(split(coalesce(text, ''), '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')",
            "n_symbols": f"cast(coalesce(regexp_count(text, '{SYMBOLS}'), 0) as bigint)",
            "word_chars": r"cast(coalesce(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '')), 0) as bigint)",
        },
        {
            "n_words": "cast(size(qr_words) as bigint)",
            "n_lines": "cast(size(qr_lines) as bigint)",
            "n_dup_lines": "cast(size(qr_lines) - size(array_distinct(qr_lines)) as bigint)",
            "n_ellipsis_lines": r"cast(size(filter(qr_lines, x -> x rlike '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$')) as bigint)",
            "n_bullet_lines": r"cast(size(filter(qr_lines, x -> x rlike '^[\\x20\\x09-\\x0D]*[-*•]')) as bigint)",
            "n_stop_words": f"cast(size(filter(qr_words, w -> lower(rtrim('.,!?;:', w)) in ({stop}))) as bigint)",
            "n_lettered_words": r"cast(size(filter(qr_words, w -> w rlike '\\p{L}')) as bigint)",
            "qr_h": "transform(qr_words, w -> xxhash64(w))",
        },
        {"qr_w": f"if(n_words >= {WINDOW}, transform(sequence(0, size(qr_h) - {WINDOW}), i -> xxhash64({ngram})), array())"},
        {"qr_sorted": "if(size(array_distinct(qr_w)) < size(qr_w), sort_array(transform(qr_w, (x, i) -> struct(x as k, i as i))), null)"},
        {"qr_at": "sort_array(transform(filter(qr_sorted, (p, j) -> coalesce(get(qr_sorted, j - 1).k = p.k, false) or coalesce(get(qr_sorted, j + 1).k = p.k, false)), p -> p.i))"},
        {"n_repeat_words": f"cast(coalesce(aggregate(transform(qr_at, (p, j) -> least({WINDOW}, coalesce(get(qr_at, j + 1) - p, {WINDOW}))), 0, (s, x) -> s + x), 0) as bigint)"},
    ]
    made: list[str] = []
    for step in steps:
        docs = docs.select(*own, *made, *(F.expr(e).alias(c) for c, e in step.items()))
        made += step
    # Behind a generator the measures are computed once: filters on them would else be pushed below, with all steps nested into one expression.
    return docs.select(*own, F.array(F.struct(*MEASURES)).alias("qr_m")).select(*own, F.inline_outer("qr_m"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with MEASURES, base_failed and kept added."""
    out = measured(docs.drop("base_failed", "kept"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP2_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
grams AS (SELECT r, unnest(range(len(words) - {WINDOW} + 1)) AS pos, unnest(list_transform(range(len(words) - {WINDOW} + 1), lambda i: array_to_string(words[i + 1:i + {WINDOW}], ' '))) AS gram FROM w WHERE len(words) >= {WINDOW}),
again AS (SELECT r, pos FROM grams QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
covered AS (SELECT r, count(DISTINCT pos + k) AS n FROM again, range({WINDOW}) t(k) GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
             len(list_filter(words, lambda x: lower(rtrim(x, '.,!?;:')) IN ({_STOP}))) AS n_stop_words,
             len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_lettered_words,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines
      FROM w LEFT JOIN covered c ON w.r = c.r),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"({r.ratio}) {op} {bound}" for r in RULES for op, bound in ((">=", r.low), ("<=", r.high)) if bound is not None)} AS kept
FROM b
"""
