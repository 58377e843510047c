"""Quality rules: a threshold table compiled into one Spark projection.

Each rule bounds one ratio of a text.  The table, not code, holds the rules; it
becomes a single expression of built-in functions, with no user function.

Defined cases: a null text counts as empty; an empty text has no words and
fails the base rule; every row is judged by itself, so repeated rows and ties
agree and an empty table stays empty; extra columns travel inside ``row``, where
their names meet none of the operator's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"

#: Frequent function words of four languages.
STOP_WORDS = (
    "the of and to in a is that for it on with as was by be at from this are or an have not "
    "der die das und den von zu mit ist auf für nicht ein eine des im dem sich auch es wird sie "
    "le la les de et en un une que qui dans pour sur pas au du par est plus avec ne se ce "
    "el los las y del con su para como más pero sus al lo una por"
).split()


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures with the range that a good text stays in."""

    name: str
    over: str
    under: str
    least: float = 0.0
    most: float = float("inf")


#: Thresholds of the default verdict.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", most=0.1),
    Rule("exclamations_per_word", "n_exclamations", "n_words", most=0.3),
    Rule("stop_word_share", "n_stop_words", "n_words", least=0.06),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", most=0.4),
    Rule("bullet_line_share", "n_bullet_lines", "n_lines", most=0.9),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", most=0.3),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times: Catalyst can't inline it."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, first ones included."""

    def covered(at: Column) -> Column:
        gap = F.transform(at, lambda x, i: F.when(i < F.size(at) - 1, F.least(F.lit(3), at[i + 1] - x)).otherwise(3))
        return F.aggregate(gap, F.lit(0), lambda a, x: a + x)

    def marked(s: Column) -> Column:
        same = lambda x, i: (s[i]["g"] == x["g"])
        own = F.transform(
            s, lambda x, i: F.when(((i > 0) & same(x, F.greatest(i - 1, F.lit(0)))) | ((i < F.size(s) - 1) & same(x, F.least(i + 1, F.size(s) - 1))), x["i"])
        )
        return _let(F.sort_array(F.filter(own, lambda x: x.isNotNull())), covered)

    def grams(h: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.struct(F.xxhash64(h[i], h[i + 1], h[i + 2]).alias("g"), i.alias("i"))
        )
        return _let(F.sort_array(each), marked)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(F.transform(words, lambda w: F.xxhash64(w)), grams))


def _count(array: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(array, test)).cast("long")


def measures(text: Column) -> Column:
    """A struct of every measure that a rule may name."""

    def of(words: Column, lines: Column, body: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.length(F.regexp_replace(body, r"[^!]+", "")).cast("long").alias("n_exclamations"),
            _count(words, lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _count(lines, lambda x: x.rlike(r"^\s*[-*•]")).alias("n_bullet_lines"),
            _count(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$")).alias("n_ellipsis_lines"),
            _repeated(words).cast("long").alias("n_repeat_words"),
        )

    body = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(body, SPACE + "+", -1), lambda w: w != "")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(F.struct(words.alias("w"), lines.alias("l"), body.alias("b")), lambda s: of(s["w"], s["l"], s["b"]))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that the measures break, as an array."""
    broken = []
    for r in rules:
        ratio = m[r.over] / F.greatest(m[r.under], F.lit(1))
        broken.append(F.when((ratio < r.least) | (ratio > r.most), F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def quality_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row``, the input row as a struct, and a struct ``quality``: measures, broken, base_failed, kept."""
    built = measures(F.col(f"`{text}`"))

    def judged(m: Column) -> Column:
        base = (m["n_words"] < 50) | (F.lit(100) * m["n_repeat_words"] > F.lit(50) * m["n_words"])
        broken = verdict(m, rules)
        return F.struct(m.alias("measures"), broken.alias("broken"), base.alias("base_failed"), (~base & (F.size(broken) == 0)).alias("kept"))

    return df.select(F.struct("*").alias("row"), _let(built, judged).alias("quality"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures, the base rule and the verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    q = quality_rules(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return q.select("row.doc_id", *(F.col(f"quality.measures.{n}").alias(n) for n in names), F.col("quality.base_failed").alias("base_failed"), F.col("quality.kept").alias("kept"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules keep, with their columns."""
    return quality_rules(docs).filter("quality.kept").select("row.*")


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same as DuckDB SQL."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    tests = " AND ".join(
        t
        for r in rules
        for t in (
            ([f"{r.over} / greatest({r.under}, 1) >= {r.least}"] if r.least > 0 else [])
            + ([f"{r.over} / greatest({r.under}, 1) <= {r.most}"] if r.most != float("inf") else [])
        )
    )
    return rf"""
WITH b AS (SELECT doc_id, coalesce(text, '') AS body,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, i, hash(words[i], words[i + 1], words[i + 2]) AS g, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM b)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g, s) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM r) GROUP BY 1),
m AS (SELECT b.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(body, '[^!]+', '', 'g')) AS BIGINT) AS n_exclamations,
    CAST(len(list_filter(words, lambda w: lower(w) IN ({stops}))) AS BIGINT) AS n_stop_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS BIGINT) AS n_ellipsis_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM b LEFT JOIN c ON b.doc_id = c.doc_id),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {tests} AS kept FROM v"""
