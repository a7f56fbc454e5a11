"""Operator 13: Merkle manifest of a table, with a proof for every row.

Each row is a leaf (a digest of its length-prefixed fields). Per group the
leaves, in key order, are rolled up ``FAN`` at a time to a subroot; the
subroots, in group order, are rolled up the same way to the root.

Method (nested-struct rollup): a leaf's rank in its group is written in
digits to base ``FAN``. The last ``LEVELS`` digits are grouped away one by
one: each step collects the nodes that differ in the lowest digit, in
order, as child structs of one node with their digest. A block ends with
``FAN ** LEVELS`` leaves in one nested struct, whatever the size of the
group; the blocks' digests are the leaves of the next tier, until every
group is one node. One shuffle per tier (by group and block) serves all of
its steps. Proofs come down the same tiers: nested transforms walk a
block's structs, put each node's siblings in front of the path of its
block, and one explode emits the leaves. A tier's blocks meet the paths
emitted above them in a union grouped by block, so there is no join on
nodes and no task holds more than a block.

Ranks need no window over a group: rows are range-partitioned by (group,
key, leaf, row number), sorted and written, and a table with one row per
partition and group gives the offsets. That table is shuffled too (or
broadcast by Spark if its files are small), and a partition's rows of a
group are one join key, so a group with a third of all rows stays spread.

Defined results: a null field is hashed as ``-``; a null or empty text too
(empty: ``0:``). A null key comes before all others, a null group is a
group of its own before all others. Rows with equal key are ordered by
leaf digest, equal rows are leaves of their own. An empty table has no
leaves and gives no rows. Other columns are neither read nor hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.llm.common import table
from corate.session import materialize

FAN = 3
#: Digits grouped away within a block: at most 3**6 = 729 leaves in a struct.
LEVELS = 6

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = "string"
_STEP = f"struct<left:{_HEX},right:{_HEX}>"
_POSITION = (1 << 33) - 1


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def encoded(col: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    value = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return sha(F.concat(*[encoded(c) for c in fields]))


def _ranked(leaves: DataFrame) -> DataFrame:
    """``leaves(tree, key, digest, payload)`` with ``idx``, the rank in its
    tree from 0 (nulls first), and ``n``, the tree's leaves."""
    cols = ["tree", "key", "digest", "payload"]
    order = ["tree", "key", "digest", "row_no"]
    # the row number splits large groups of equal rows over partitions
    rows = materialize(
        leaves.select(*cols).withColumn("row_no", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .select(*cols, F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(_POSITION).alias("at")),
        "merkle-order")
    runs = rows.groupBy("tree", "part").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("len"))
    whole = Window.partitionBy("tree")  # a row per partition at most
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(runs.select(
        F.col("tree").alias("t"), F.col("part").alias("p"), F.sum("len").over(whole).alias("n"),
        (F.coalesce(F.sum("len").over(before), F.lit(0)) - F.col("start")).alias("shift")), "merkle-runs")
    return (rows.join(runs, (F.col("part") == F.col("p")) & F.col("tree").eqNullSafe(F.col("t")))
            .select(*cols, (F.col("at") + F.col("shift")).alias("idx"), "n"))


def _children() -> Column:
    """The group's nodes as structs in the order of their last digit."""
    return F.sort_array(F.collect_list("node"))


def _blocks(nodes: DataFrame, tier: int) -> DataFrame:
    """Rolls up ``LEVELS`` digits of ``nodes(tree, n, idx, digest, payload)``:
    ``(tree, n, idx, digest, kids)``, one row per block.

    A level hashes only in trees that still have several nodes below it.
    """
    rest, tree = F.col("idx"), F.col("tree")
    digits = [f"d{i}" for i in range(LEVELS)]
    for d in digits:
        nodes = nodes.withColumn(d, F.pmod(rest, F.lit(FAN)).cast("tinyint"))
        rest = F.floor(rest / FAN)
    block = rest.cast("bigint")
    nodes = nodes.select(tree, "n", block.alias("idx"), *digits,
                         F.struct(F.col("d0").alias("digit"), "digest", "payload").alias("node"))
    nodes = nodes.repartition("tree", "idx")
    for level in range(LEVELS):
        left = digits[level + 1:]
        nodes = nodes.groupBy("tree", "idx", *left).agg(F.max("n").alias("n"), _children().alias("kids"))
        # whole numbers: a tree of n leaves has several nodes here if n > FAN**(levels below)
        grows = F.col("n") > F.lit(FAN ** min(tier * LEVELS + level, 39))
        digest = F.when(grows, sha(F.array_join("kids.digest", ""))).otherwise(F.col("kids")[0]["digest"])
        if left:
            nodes = nodes.select("tree", "idx", "n", *left,
                                 F.struct(F.col(left[0]).alias("digit"), digest.alias("digest"),
                                          "kids").alias("node"))
        else:
            nodes = nodes.select("tree", "idx", "n", digest.alias("digest"), "kids")
    return nodes


def _step(kids: Column, i: Column) -> Column:
    """The siblings of child ``i``, those to its left and to its right."""
    at = lambda j: F.coalesce(F.get(kids, j)["digest"], F.lit(""))
    left = F.concat(*[at(i - j) for j in range(FAN - 1, 0, -1)])
    return F.struct(left.alias("left"), F.concat(*[at(i + j) for j in range(1, FAN)]).alias("right"))


def _paths(kids: Column, path: Column, level: int, tier: int) -> Column:
    """``array<struct<payload, path>>`` of a block's leaves below ``kids``.
    A path is the array of steps from the leaf up."""
    grows = F.col("n") > F.lit(FAN ** min(tier * LEVELS + level, 39))

    def child(c: Column, i: Column) -> Column:
        own = F.when(grows, F.array(_step(kids, i))).otherwise(F.array().cast(f"array<{_STEP}>"))
        up = F.concat(own, path)  # ``path`` once: an expression that grows with the level, not doubles
        if level == 0:
            return F.struct(c["payload"].alias("payload"), up.alias("path"))
        return _paths(c["kids"], up, level - 1, tier)

    out = F.transform(kids, child)
    return F.flatten(out) if level else out


def _emit(blocks: DataFrame, tier: int) -> DataFrame:
    """Explodes blocks with their ``path`` and ``root`` to their leaves."""
    return blocks.select("root", F.explode(_paths(F.col("kids"), F.col("path"), LEVELS - 1, tier)).alias("x")) \
        .select("root", "x.payload", "x.path")


def _meet(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with the ``root`` and ``path`` that ``above`` has for them."""
    kids = blocks.schema["kids"].dataType
    up = above.select("payload.tree", "payload.idx", F.lit(None).cast("bigint").alias("n"),
                      F.lit(None).cast(kids).alias("kids"), "root", "path")
    own = blocks.select("tree", "idx", "n", "kids", F.lit(None).cast(_HEX).alias("root"),
                        F.lit(None).cast(f"array<{_STEP}>").alias("path"))
    one = lambda c: F.first(c, ignorenulls=True).alias(c)
    return own.unionByName(up).groupBy("tree", "idx").agg(one("n"), one("kids"), one("root"), one("path"))


def _tiers(leaves: DataFrame, label: str) -> list[DataFrame]:
    """The blocks of each tier, the last with one block per tree.

    ``leaves`` has the columns of :func:`_ranked`; the payload of a node of
    a higher tier is the block it stands for.
    """
    nodes, out = materialize(leaves, f"merkle-{label}-leaves"), []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while not out or largest > FAN ** (LEVELS * len(out)):
        blocks = materialize(_blocks(nodes, len(out)), f"merkle-{label}-blocks")
        out.append(blocks)
        nodes = blocks.select("tree", "n", "idx", "digest", F.struct("tree", "idx").alias("payload"))
    return out


def proofs(leaves: DataFrame) -> DataFrame:
    """``leaves(tree, key, digest, payload)`` to one row per leaf: ``payload,
    subroot, root, path`` with ``path`` an array of ``(left, right)`` sibling
    digests (as joined hex text) from the leaf up to the root."""
    trees = _tiers(_ranked(leaves), "group")
    top = trees[-1].select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("key"), "digest",
                           F.struct("tree", F.lit(0).cast("bigint").alias("idx"),
                                    F.col("digest").alias("subroot")).alias("payload"))
    groups = _tiers(_ranked(top), "top")
    nothing = F.array().cast(f"array<{_STEP}>")
    down = _emit(groups[-1].withColumn("root", F.col("digest")).withColumn("path", nothing), len(groups) - 1)
    for tier in range(len(groups) - 2, -1, -1):
        down = _emit(_meet(groups[tier], down), tier)
    # from here on the subroot travels in front of the root
    down = down.select(F.concat("payload.subroot", "root").alias("root"), "payload", "path")
    for tier in range(len(trees) - 1, -1, -1):
        down = _emit(_meet(trees[tier], down), tier)
    return down.select("payload", F.substring("root", 1, 64).alias("subroot"),
                       F.substring("root", 65, 64).alias("root"), "path")


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda acc, s: sha(F.concat(s["left"], acc, s["right"])))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple = FIELDS,
             presented: Column | None = None) -> DataFrame:
    """``key, group, leaf, subroot, root, path`` per row, and ``shown``: the
    digest of ``presented`` (a digest column of ``docs``, e.g. of a copy to
    be verified), or the leaf where that is null."""
    leaf = leaf_digest(*[F.col(f"`{c}`") for c in fields])
    shown = F.lit(None).cast("string") if presented is None else presented
    leaves = docs.select(F.col(f"`{group}`").cast("string").alias("tree"), F.col(f"`{key}`").alias("key"),
                         leaf.alias("digest"), shown.alias("shown")) \
        .select("tree", "key", "digest", F.struct("key", "tree", F.col("digest").alias("leaf"), "shown").alias("payload"))
    return proofs(leaves).select(
        F.col("payload.key").alias(key), F.col("payload.tree").alias(group), F.col("payload.leaf").alias("leaf"),
        "subroot", "root", "path", F.coalesce("payload.shown", "payload.leaf").alias("shown"))


def query(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    other = F.when(tampered & (F.instr("text", "\n") > 0),
                   leaf_digest(*[text if c == "text" else F.col(c) for c in FIELDS]))
    fold = folded(F.col("shown"), F.col("path"))
    return (manifest(docs, presented=other)
            .select("doc_id", "leaf", "subroot", "root", sha(proof_text(F.col("path"))).alias("proof_sha256"),
                    fold.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         CASE WHEN list_reduce(list_prepend(4294967295::BIGINT,
                     [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]),
                   lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0],
                     lambda x, y: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))
              % 2 = 1  -- the register is inverted at the end
              THEN replace(text, chr(10), '') ELSE text END AS shown,
         text, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                      coalesce(strlen(source) || ':' || source, '-'),
                      coalesce(strlen(lang) || ':' || lang, '-'),
                      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head
  FROM documents),
leaves AS (
  SELECT doc_id, source, coalesce('s' || source, '') AS tree,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS shown
  FROM d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n
  FROM leaves),
nodes AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS digest FROM ranked
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 3, n),
subroots AS (SELECT tree, digest FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY lvl, idx // 3, n),
ordered AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS top_idx FROM subroots),
steps AS (
  SELECT a.tree, a.lvl, a.idx,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY ALL),
top_steps AS (
  SELECT a.lvl, a.idx,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY ALL),
low AS (
  SELECT k.tree, k.idx, list({'l': s.l, 'r': s.r, 'd': ''} ORDER BY s.lvl) AS path
  FROM ranked k JOIN steps s ON s.tree = k.tree AND s.idx = k.idx // (3 ** s.lvl)::BIGINT
  GROUP BY ALL),
high AS (
  SELECT o.tree, list({'l': s.l, 'r': s.r, 'd': ''} ORDER BY s.lvl) AS path
  FROM ordered o JOIN top_steps s ON s.idx = o.top_idx // (3 ** s.lvl)::BIGINT
  GROUP BY ALL),
paths AS (
  SELECT k.doc_id, k.leaf, k.shown, o.digest AS subroot, t.digest AS root,
         list_concat(coalesce(low.path, []), coalesce(high.path, [])) AS path
  FROM ranked k JOIN ordered o ON k.tree = o.tree JOIN tops t ON t.n = 1
  LEFT JOIN low ON low.tree = k.tree AND low.idx = k.idx LEFT JOIN high ON high.tree = k.tree),
folded AS (
  SELECT doc_id, leaf, subroot, root,
         sha256(list_aggregate([s.l || s.r for s in list_prepend({'l': '', 'r': '', 'd': ''}, path)], 'string_agg', '')) AS proof_sha256,
         list_reduce(list_prepend({'l': '', 'r': '', 'd': shown}, path),
           lambda a, s: {'l': '', 'r': '', 'd': sha256(s.l || a.d || s.r)}).d AS folded_root
  FROM paths)
SELECT *, folded_root = root AS verified FROM folded
"""
