"""Operator 11: URL filter by a list of host and path rules.

A rule is a host and the beginning of a path (``example.net`` and ``/en/``)
with a verdict. It fits a URL on its host or any subdomain whose path
starts with the rule's path. Of all rules that fit, the one with the
longest text (host and path together) decides; of equally long ones the one
with the longer host, and ``block`` before ``allow`` where both are listed
for one host and path. A URL without a fitting rule gets ``default``.

Method: every URL is expanded into expressions, a suffix of its host (whole
labels) joined to a prefix of its path, which are joined with the rules by
the first 32 bits of a digest. A hit counts once the full digests (SHA-256)
are equal. Only expressions of a rule's shape (number of host labels and
length of the path) can hit, so a URL has at most as many expressions as
the list has shapes, however long it is; a list's shapes are bounded by the
lengths of hosts and paths, not by the number of its rules.

The rules are broadcast if their bytes are within ``max_broadcast_bytes``.
Beyond that the join is shuffled: hash prefixes that hold more than a
thousandth of all expressions (fewer than 1000, so their rules are few) are
joined by broadcast, the others by hash prefix. Hits are collapsed to one
candidate per URL in the map tasks, and rows are told apart by a row
number, so repeated URLs and ids stay spread. The page itself is not read.

Defined results: host and path of a null URL or one without ``://`` are
empty. The host is taken as it stands (with port or user name). Rules with
a null host, path or verdict fit nothing. Repeated rules are one rule. An
empty list gives ``default`` everywhere, an empty table no rows. Columns
other than the id and the URL are not read by :func:`judge`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import heavy_keys, lower_ascii, table, text_of
from corate.operators.pairs import DEFAULT_BROADCAST_BYTES, table_bytes
from corate.session import materialize

ALLOW, BLOCK = "allow", "block"

#: The rules of the registered query.
RULES = [
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
]
RULE_SCHEMA = "host string, path string, verdict string"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(_after_scheme(text_of(url)), r"\A([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(text_of(url)), r"\A[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def compile_rules(rules: DataFrame) -> DataFrame:
    """``rule, verdict, weight, labels, chars, prefix, digest`` of distinct
    rules; the largest ``weight`` wins. Hosts are lower-cased as URLs' are."""
    r = (rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").dropna()
         .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))  # block sorts after allow
    rule = F.concat("host", "path")
    digest = _digest(F.concat("host", F.lit(" "), "path"))
    return r.select(rule.alias("rule"), "verdict",
                    F.struct(F.length(rule).alias("length"), F.length("host").alias("host")).alias("weight"),
                    _labels(F.col("host")).alias("labels"), F.length("path").alias("chars"),
                    digest.alias("digest")).withColumn("prefix", _prefix(F.col("digest")))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The array of expression digests of a URL, for ``shapes`` of (host
    labels, path characters); shapes larger than the URL give none."""
    if not shapes:
        return F.array().cast("array<string>")
    sizes = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in shapes])  # a constant
    fits = F.filter(sizes, lambda s: (_labels(host) >= s["labels"]) & (F.length(path) >= s["chars"]))
    suffix = lambda s: F.call_function("substring_index", host, F.lit("."), -s["labels"])
    return F.transform(fits, lambda s: _digest(F.concat(suffix(s), F.lit(" "), F.substr(path, F.lit(1), s["chars"]))))


def _hits(urls: DataFrame, rules: DataFrame, max_broadcast_bytes: int) -> DataFrame:
    """``row, best`` for the rows of ``urls(row, host, path)`` with a fitting
    rule; ``best`` is a struct of weight, rule and verdict."""
    shapes = sorted((r.labels, r.chars) for r in rules.select("labels", "chars").distinct().collect())
    keyed = (urls.select("row", F.explode(expressions(F.col("host"), F.col("path"), shapes)).alias("digest"))
             .withColumn("prefix", _prefix(F.col("digest"))))
    listed = rules.select("prefix", F.col("digest").alias("full"),
                          F.struct("weight", "rule", "verdict").alias("best"))
    same = F.col("digest") == F.col("full")
    if table_bytes(rules.select("rule", "verdict", "digest", "prefix")) <= max_broadcast_bytes:
        met = keyed.join(F.broadcast(listed), "prefix").where(same)
    else:
        keyed = materialize(keyed, "url-expressions")
        hot = F.broadcast(heavy_keys(keyed, ["prefix"], keyed.count()))
        met = (keyed.join(F.broadcast(listed.join(hot, "prefix")), "prefix").where(same)
               .unionByName(keyed.join(hot, "prefix", "left_anti").join(listed, "prefix").where(same)))
    return met.groupBy("row").agg(F.max("best").alias("best"))


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, id_col: str = "page_id", url_col: str = "url",
          max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row of ``pages``;
    ``rules`` has the columns ``host, path, verdict`` (allow or block)."""
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    # written with its row numbers: they are the same for every later reader
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "url-rows")
    rules = materialize(compile_rules(rules), "url-rules")
    hits = _hits(rows, rules, max_broadcast_bytes)
    return rows.join(hits, "row", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def keep_allowed(pages: DataFrame, rules: DataFrame, default: str = ALLOW, url_col: str = "url",
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns.

    Verdicts are joined back by URL (a hash table of the blocked ones, which
    are distinct), so a page's columns are read once and not sorted.
    """
    urls = pages.select(F.col(f"`{url_col}`").alias("url")).distinct()
    verdicts = judge(urls, rules, default, "url", "url", max_broadcast_bytes)
    blocked = materialize(verdicts.where(F.col("verdict") == BLOCK).select(F.col("url").alias("__blocked")), "url-blocked")
    return pages.join(blocked, F.col(f"`{url_col}`").eqNullSafe(F.col("__blocked")), "left_anti")


def query(spark, sf_dir) -> DataFrame:
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    return judge(table(spark, sf_dir, "pages"), rules)


SQL = """
WITH rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
         ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
cut AS (
  SELECT row_number() OVER () AS row, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT row, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
best AS (
  SELECT u.row, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM urls u JOIN rules r
    ON ('.' || u.host) LIKE ('%.' || r.host) AND starts_with(u.path, r.path)
  GROUP BY u.row)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN best USING (row)
"""
