"""Operator 1: quality rules as one projection compiled from a threshold table.

``RULES`` is a table of (name, measure, lowest, highest). ``apply_rules``
turns it into a single Spark projection over the text: measures of length,
symbols, stop words and lines, one verdict per rule, one verdict per
document. Only built-in functions are used and nothing is shuffled, so the
operator streams over any number of documents; a document of any length is
one row of one task.

Defined results: a null or empty text has no words and fails the length
rule. Nulls in other columns do not matter. Repeated rows get the same
verdict each. An empty table gives an empty table. Columns of the input are
carried in a struct, so any name may occur among them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import let, lower_ascii, table, text_of, words

SYMBOLS = "#*$%&|<>"

#: Function words of the four languages of the corpus (fixed values).
STOP_WORDS = {
    "en": "the of and to in a is that for it was on with as be by are this from have not",
    "de": "der die das und in den von zu mit sich des auf ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un une du dans que est pour qui par sur au avec pas",
    "es": "de la que el en y los se del las un por con no una su para es al como",
}


class Rule(NamedTuple):
    """A document passes if ``low <= measure <= high`` (None: no bound)."""

    name: str
    measure: str
    low: float | None
    high: float | None


#: The threshold table. ``base`` rules decide ``base_failed``.
BASE_RULES = (
    Rule("min_words", "n_words", 50, None),
    Rule("repeated_words", "repeat_percent", None, 50),
)
RULES = (
    Rule("mean_word_length", "mean_word_chars", 2, 14),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_share", 0.04, None),
    Rule("capitals", "capital_word_share", None, 0.3),
    Rule("exclamations", "exclamations_per_word", None, 0.15),
    Rule("repeated_lines", "dup_line_share", None, 0.3),
    Rule("alphabetic_words", "alpha_word_share", 0.7, None),
    Rule("word_runs", "word_run_share", None, 0.15),
)


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    The windows' 64-bit hashes are sorted with their positions; equal
    neighbours mark repeated windows, whose positions are sorted again to
    count the words they cover.
    """
    n = F.size(w)

    def window(i: Column) -> Column:
        return F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                        i.alias("p"))

    def repeated(s: Column) -> Column:
        h = lambda i: F.get(s, i).getField("h")
        hit = F.transform(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda i: F.when((h(i) == h(i - 1)) | (h(i) == h(i + 1)),
                                           F.get(s, i).getField("p")))
        return F.sort_array(F.filter(hit, lambda p: p.isNotNull()))

    def covered(q: Column) -> Column:
        return F.when(F.size(q) == 0, F.lit(0)).when(F.size(q) == 1, F.lit(3)).otherwise(
            F.aggregate(F.sequence(F.lit(0), F.size(q) - 2), F.lit(3),
                        lambda acc, i: acc + F.least(F.lit(3), F.get(q, i + 1) - F.get(q, i))))

    windows = F.transform(F.sequence(F.lit(0), n - 3), window)
    return F.when(n < 4, F.lit(0)).otherwise(
        let(F.sort_array(windows), lambda s: let(repeated(s), covered)))


def _run_words(w: Column) -> Column:
    """Words equal to the word before them."""
    return F.when(F.size(w) < 2, F.lit(0)).otherwise(
        F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))))


def _of_words(w: Column) -> Column:
    stops = sorted({s for v in STOP_WORDS.values() for s in v.split()})
    return F.struct(
        F.size(w).alias("n_words"),
        _repeat_words(w).alias("n_repeat_words"),
        _run_words(w).alias("n_run_words"),
        F.size(F.filter(w, lambda x: lower_ascii(F.rtrim(x, F.lit(".,;:!?"))).isin(stops)))
        .alias("n_stop_words"),
        F.size(F.filter(w, lambda x: F.rlike(x, F.lit(r"^[^a-z]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"))))
        .alias("n_capital_words"),
        F.size(F.filter(w, lambda x: F.rlike(x, F.lit(r"\p{L}")))).alias("n_alpha_words"),
    )


def measures(text: Column) -> Column:
    """All measures of a text as one struct column."""
    t = text_of(text)
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    return let(t, lambda v: F.struct(
        let(words(v), _of_words).alias("w"),
        F.length(F.translate(v, " \t\n\x0b\x0c\r", "")).alias("word_chars"),
        (F.length(v) - F.length(F.translate(v, SYMBOLS, ""))).alias("n_symbols"),
        (F.length(v) - F.length(F.translate(v, "!", ""))).alias("n_exclamations"),
        let(lines, lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup"))).alias("l"),
    ))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def apply_rules(docs: DataFrame, text_col: str = "text", base_rules=BASE_RULES,
                rules=RULES) -> DataFrame:
    """Every row of ``docs`` with its measures and verdicts.

    Columns: ``row`` (the input row as a struct), the measures, one boolean
    ``ok_<rule>`` per rule, ``base_failed`` and ``kept``.
    """
    m = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                    measures(F.col(f"`{text_col}`")).alias("m"))
    n = F.col("m.w.n_words")
    m = m.select(
        "row",
        n.cast("bigint").alias("n_words"),
        F.col("m.word_chars").cast("bigint").alias("word_chars"),
        F.col("m.n_symbols").cast("bigint").alias("n_symbols"),
        F.col("m.l.n_dup").cast("bigint").alias("n_dup_lines"),
        F.col("m.w.n_repeat_words").cast("bigint").alias("n_repeat_words"),
        _ratio(100.0 * F.col("m.w.n_repeat_words"), n).alias("repeat_percent"),
        _ratio(F.col("m.word_chars"), n).alias("mean_word_chars"),
        _ratio(F.col("m.n_symbols"), n).alias("symbols_per_word"),
        _ratio(F.col("m.n_exclamations"), n).alias("exclamations_per_word"),
        _ratio(F.col("m.w.n_stop_words"), n).alias("stop_word_share"),
        _ratio(F.col("m.w.n_capital_words"), n).alias("capital_word_share"),
        _ratio(F.col("m.w.n_alpha_words"), n).alias("alpha_word_share"),
        _ratio(F.col("m.w.n_run_words"), n).alias("word_run_share"),
        _ratio(F.col("m.l.n_dup"), F.col("m.l.n")).alias("dup_line_share"),
    )

    def passes(r: Rule) -> Column:
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (F.col(r.measure) >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (F.col(r.measure) <= F.lit(r.high))
        return ok

    def all_of(rs) -> Column:
        ok = F.lit(True)
        for r in rs:
            ok = ok & passes(r)
        return ok

    return m.select("*", *[passes(r).alias(f"ok_{r.name}") for r in (*base_rules, *rules)],
                    (~all_of(base_rules)).alias("base_failed"),
                    all_of((*base_rules, *rules)).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass all rules, with their own columns."""
    return apply_rules(docs, text_col).where("kept").select("row.*")


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    stops = ", ".join(f"'{s}'" for s in sorted({s for v in STOP_WORDS.values() for s in v.split()}))

    def cond(r: Rule) -> str:
        out = []
        if r.low is not None:
            out.append(f"{r.measure} >= {r.low}")
        if r.high is not None:
            out.append(f"{r.measure} <= {r.high}")
        return " AND ".join(out)

    base = " AND ".join(cond(r) for r in BASE_RULES)
    every = " AND ".join(cond(r) for r in (*BASE_RULES, *RULES))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d),
u AS (
  SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
tri AS (
  SELECT rid, i, x,
         lead(x, 1) OVER p AS y, lead(x, 2) OVER p AS z, lag(x, 1) OVER p AS before
  FROM u WINDOW p AS (PARTITION BY rid ORDER BY i)),
cnt AS (
  SELECT rid, i, x, before,
         CASE WHEN z IS NOT NULL THEN count(*) OVER (PARTITION BY rid, x, y, z) > 1
              ELSE false END AS rep
  FROM tri),
cov AS (
  SELECT rid, x, before,
         rep OR coalesce(lag(rep, 1) OVER p, false) OR coalesce(lag(rep, 2) OVER p, false) AS c
  FROM cnt WINDOW p AS (PARTITION BY rid ORDER BY i)),
agg AS (
  SELECT rid, count(*) FILTER (c) AS n_repeat_words,
         count(*) FILTER (x = before) AS n_run_words,
         count(*) FILTER (translate(rtrim(x, '.,;:!?'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz') IN ({stops})) AS n_stop_words,
         count(*) FILTER (regexp_matches(x, '^[^a-z]*\\p{{Lu}}[^\\p{{Ll}}]*\\p{{Lu}}[^\\p{{Ll}}]*$')) AS n_capital_words,
         count(*) FILTER (regexp_matches(x, '\\p{{L}}')) AS n_alpha_words
  FROM cov GROUP BY rid),
m AS (
  SELECT doc_id, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
         length(t) - length(replace(t, '!', '')) AS n_exclamations,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_run_words, 0) AS n_run_words,
         coalesce(n_stop_words, 0) AS n_stop_words, coalesce(n_capital_words, 0) AS n_capital_words,
         coalesce(n_alpha_words, 0) AS n_alpha_words
  FROM w LEFT JOIN agg USING (rid)),
r AS (
  SELECT *, coalesce(100.0::DOUBLE * n_repeat_words / nullif(n_words, 0), 0) AS repeat_percent,
         coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0) AS mean_word_chars,
         coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0) AS symbols_per_word,
         coalesce(n_exclamations::DOUBLE / nullif(n_words, 0), 0) AS exclamations_per_word,
         coalesce(n_stop_words::DOUBLE / nullif(n_words, 0), 0) AS stop_word_share,
         coalesce(n_capital_words::DOUBLE / nullif(n_words, 0), 0) AS capital_word_share,
         coalesce(n_alpha_words::DOUBLE / nullif(n_words, 0), 0) AS alpha_word_share,
         coalesce(n_run_words::DOUBLE / nullif(n_words, 0), 0) AS word_run_share,
         coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0) AS dup_line_share
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, NOT ({base}) AS base_failed, ({every}) AS kept
FROM r
"""


SQL = _sql()
