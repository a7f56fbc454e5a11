"""Skew-safe pair generation: the equi-join behind every co-occurrence.

Item-item similarity pairs the items of each user (self-join on user);
user-user measures pair the raters of each item (join on item). A key with
n rows on each side yields n^2 pairs; if one key holds a third of all rows,
a plain shuffle join hands all of that to one task.

A key with more than ``block_rows`` rows on a side is therefore cut into
``ceil(n / block_rows)`` blocks by a hash of a row id, and each left block
meets each right block under a join key of its own, so no join key yields
more than about ``block_rows^2`` pairs. A self-join only joins block i with
blocks j >= i. Every hot key is cut; there is no cap and no row is dropped.

Pairs that are summed per pair of items go through :func:`listed_pairs`: the
rows of a key travel as one list to each of its items, and the pairs are
formed and summed where the item is, so no pair is shuffled by itself.

The table of hot keys and both sides are written first (in the shared
checkpoint folder), so the row sides are joined with it as plain scans:
Spark broadcasts the table if its files are small, and otherwise shuffles
and may split hot keys there too. The number of join partitions follows
from the pairs counted, not from the session's default.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corate.session import materialize, scratch_path, shuffles_dropped

DEFAULT_BLOCK_ROWS = 10_000
PAIRS_PER_TASK = 20_000_000


def _counts(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def _partitions(df: DataFrame, pairs: float | None) -> int:
    """Join partitions for so many pairs, at least the session's number."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil((pairs or 0) / PAIRS_PER_TASK))


def _block(split: str, n: str) -> F.Column:
    return F.pmod(F.xxhash64(F.col(split)), F.col(n))


def _to(lo, hi) -> F.Column:
    return F.explode(F.sequence(lo, hi))


def blocked_join(left: DataFrame, right: DataFrame, key: str, left_split: str,
                 right_split: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Inner join of ``left`` and ``right`` on ``key`` that stays balanced
    when a key is hot on one or both sides.

    ``left_split``/``right_split`` are row-identifying columns (e.g. the
    item of a rating) that decide a row's block. Columns other than ``key``
    must not clash between the sides. The result has one ``key`` column and
    all other columns of both sides.
    """
    left, right = materialize(left, "join-left"), materialize(right, "join-right")
    counts = materialize(_counts(left, key, "__cl").join(_counts(right, key, "__cr"), key), "join-counts")
    pairs = counts.agg(F.sum(F.col("__cl").cast("double") * F.col("__cr"))).first()[0]
    blocks = lambda c: F.ceil(F.col(c) / block_rows).cast("bigint")
    hot = materialize(counts.where(f"__cl > {block_rows} OR __cr > {block_rows}")
                      .select(key, blocks("__cl").alias("__nl"), blocks("__cr").alias("__nr")), "hot-keys")
    one = F.lit(1).cast("bigint")

    def side(df: DataFrame, own: str, other: str, split: str, own_block: str, other_block: str) -> DataFrame:
        return (df.join(hot, key, "left")
                .withColumn(own, F.coalesce(own, one)).withColumn(other, F.coalesce(other, one))
                .withColumn(own_block, _block(split, own))
                .withColumn(other_block, _to(one - 1, F.col(other) - 1)).drop("__nl", "__nr"))

    n = _partitions(left, pairs)
    keys = [key, "__bl", "__br"]
    return (side(left, "__nl", "__nr", left_split, "__bl", "__br").repartition(n, *keys)
            .join(side(right, "__nr", "__nl", right_split, "__br", "__bl").repartition(n, *keys), keys)
            .drop("__bl", "__br"))


def self_pairs(rows: DataFrame, key: str, split: str, values: list[str], a: str = "a_", b: str = "b_",
               block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Each unordered pair of ``rows`` (a written table) with the same
    ``key``, once: ``key`` and, for the row with the smaller and the larger
    ``split``, that column and ``values`` with the prefixes ``a`` and ``b``.
    Rows of a key with equal ``split`` are not paired."""
    counts = materialize(_counts(rows, key, "__n"), "join-counts")
    pairs = counts.agg(F.sum(F.col("__n").cast("double") * F.col("__n") / 2)).first()[0]
    hot = materialize(counts.where(F.col("__n") > block_rows)
                      .select(key, F.ceil(F.col("__n") / block_rows).cast("bigint").alias("__nb")), "hot-keys")
    cols = [split, *values]
    own = (rows.select(key, *cols).join(hot, key, "left")
           .withColumn("__nb", F.coalesce("__nb", F.lit(1).cast("bigint")))
           .withColumn("__b", _block(split, "__nb")))
    left = own.withColumn("__i", F.col("__b")).withColumn("__j", _to(F.col("__b"), F.col("__nb") - 1))
    right = own.withColumn("__j", F.col("__b")).withColumn("__i", _to(F.lit(0).cast("bigint"), F.col("__b")))
    n = _partitions(rows, pairs)
    keys = [key, "__i", "__j"]
    name = lambda df, p: df.select(*keys, *[F.col(c).alias(f"__{p}{c}") for c in cols]).repartition(n, *keys)
    x, y = F.col(f"__x{split}"), F.col(f"__y{split}")
    # within one block each pair meets twice: keep it in order; across two
    # blocks it meets once, in any order, and is put in order
    met = (name(left, "x").join(name(right, "y"), keys)
           .where((x < y) | ((x > y) & (F.col("__i") < F.col("__j")))))
    pick = lambda c, first, second: F.when(x < y, F.col(f"__{first}{c}")).otherwise(F.col(f"__{second}{c}"))
    return met.select(key, *[pick(c, "x", "y").alias(f"{a}{c}") for c in cols],
                      *[pick(c, "y", "x").alias(f"{b}{c}") for c in cols])


#: Rows of a key in one list, partners of an item in one part, and pairs a task forms from lists.
LIST_ROWS = 1_000
LISTED_PER_TASK = 4_000_000
#: Written results are made in shares of the items: so many partners a row in one share, if it has so many pairs.
SHARE_PARTNERS = 6
SHARE_PAIRS = 200_000_000
#: Column of :func:`listed_pairs`: which part of an item's partners it is.
PART = "part"

_WHOLE = {"tinyint": 7, "smallint": 15, "int": 31}
_EXACT = {"double": 53, "bigint": 62, "int": 31}
_CODE_BITS = 62
_INT = 1 << 31


def _ranges(rows: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """``lo, hi, whole, nulls`` of each column of numbers."""
    kinds = dict(rows.dtypes)
    numbers = [c for c in columns if kinds[c] in _EXACT]
    if not numbers:
        return {}
    aggs = []
    for i, c in enumerate(numbers):
        whole = F.bool_and(F.rint(c) == F.col(c)) if kinds[c] == "double" else F.lit(True)
        aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), whole.alias(f"whole{i}"), F.count_if(F.col(c).isNull()).alias(f"nulls{i}")]
    r = rows.agg(*aggs).first()
    return {c: (r[f"lo{i}"], r[f"hi{i}"], r[f"whole{i}"], r[f"nulls{i}"]) for i, c in enumerate(numbers)}


def narrow_types(rows: DataFrame, columns: list[str], ranges: dict | None = None) -> dict[str, str]:
    """Per column the narrowest type that holds all its values unchanged:
    whole numbers take 1, 2 or 4 bytes where they fit, others stay."""
    kinds = dict(rows.dtypes)
    out = {c: kinds[c] for c in columns}
    for c, (lo, hi, whole, _) in (_ranges(rows, columns) if ranges is None else ranges).items():
        if whole and lo is not None:
            out[c] = next((t for t, bits in _WHOLE.items() if -(2**bits) <= lo and hi < 2**bits), kinds[c])
    return out


@dataclass(frozen=True)
class _Field:
    """Where a column lies in a code: ``bits`` above ``shift``; 0 is null, if
    there are nulls."""

    column: str
    kind: str
    lo: int
    nulls: bool
    bits: int
    shift: int


class _Code:
    """Columns of whole numbers of known ranges in one number of as few bytes
    as hold it: an int, an int with one or two bytes above it, or a long. The
    first column is the highest, so codes are in its order."""

    def __init__(self, name: str, fields: list[tuple[str, str, int, bool, int]]):
        self.name, self.bits, self.fields = name, sum(f[4] for f in fields), []
        shift = self.bits
        for f in fields:
            shift -= f[4]
            self.fields.append(_Field(*f, shift))
        self.high = None if self.bits <= 32 or self.bits > 47 else "tinyint" if self.bits <= 39 else "smallint"
        self.columns = [f"{name}h", name] if self.high else [name]

    def pack(self) -> list[F.Column]:
        code = F.lit(0).cast("bigint")
        for f in self.fields:
            v = F.col(f.column).cast("bigint") - F.lit(f.lo)
            code = code + F.shiftleft(F.coalesce(v + 1, F.lit(0)) if f.nulls else v, f.shift)
        if self.bits > 47:
            return [code.alias(self.name)]
        low = (code.bitwiseAND(F.lit(2 * _INT - 1)) - F.lit(_INT)).cast("int").alias(self.name)
        return [F.shiftright(code, 32).cast(self.high).alias(f"{self.name}h"), low] if self.high else [low]

    def unpack(self, column: str, at) -> F.Column:
        """A column of the code whose parts ``at`` gives by their names."""
        f = next(f for f in self.fields if f.column == column)
        code = at(self.name).cast("bigint")
        if self.bits <= 47:
            code = code + F.lit(_INT)
        if self.high:
            code = code + F.shiftleft(at(f"{self.name}h").cast("bigint"), 32)
        v = F.shiftright(code, f.shift) if f is self.fields[0] else F.shiftright(code, f.shift).bitwiseAND(F.lit((1 << f.bits) - 1))
        if f.nulls:
            return F.when(v > 0, v + F.lit(f.lo - 1)).cast(f.kind)
        return (v + F.lit(f.lo)).cast(f.kind)


class _Packed:
    """How the columns of a list's rows are stored: as codes, and those that
    are no whole numbers as they are."""

    def __init__(self, rows: DataFrame, columns: list[str]):
        kinds, known = dict(rows.dtypes), _ranges(rows, columns)
        small = narrow_types(rows, columns, known)
        self.kinds, self.codes, self.plain, fields = kinds, [], [], []
        for c in columns:
            lo, hi, whole, nulls = known.get(c, (None, None, False, 0))
            if not whole or lo is None or max(abs(lo), abs(hi)) >= 2 ** _EXACT[kinds[c]]:
                self.plain.append(c)
                continue
            bits = max(1, (int(hi) - int(lo) + bool(nulls)).bit_length())
            if fields and sum(f[4] for f in fields) + bits > _CODE_BITS:
                self.codes.append(_Code(f"c{len(self.codes)}", fields))
                fields = []
            if bits > _CODE_BITS:
                self.plain.append(c)
            else:
                fields.append((c, kinds[c], int(lo), bool(nulls), bits))
        if fields:
            self.codes.append(_Code(f"c{len(self.codes)}", fields))
        self.of = {f.column: code for code in self.codes for f in code.fields}
        self.small = {c: small[c] for c in self.plain}
        first = columns[0]
        # sorted by the first column
        mine = [(code.columns, first in self.of and code is self.of[first]) for code in self.codes]
        mine += [([f"p_{c}"], c == first) for c in self.plain]
        self.columns = [c for names, _ in sorted(mine, key=lambda x: not x[1]) for c in names]

    def pack(self) -> list[F.Column]:
        made = [c for code in self.codes for c in code.pack()]
        return made + [F.col(c).cast(self.small[c]).alias(f"p_{c}") for c in self.plain]

    def unpack(self, column: str, at) -> F.Column:
        if column in self.of:
            return self.of[column].unpack(column, at)
        return at(f"p_{column}").cast(self.kinds[column])


def _parts(rows: DataFrame, counts: DataFrame, key: str, split: str, longest: int, most: int) -> DataFrame | None:
    """``split, __parts`` of the items with more than ``most`` partners, over
    all their rows; None if there are none."""
    raters = rows.groupBy(split).agg(F.count(F.lit(1)).alias("__c")).agg(F.max("__c")).first()[0] or 0
    if raters * longest <= most:
        return None
    met = rows.select(key, split).join(counts, key).groupBy(split).agg(F.sum("__n").alias("__w"))
    hot = materialize(met.where(F.col("__w") > most).select(split, F.ceil(F.col("__w") / most).cast("int").alias("__parts")), "hot-items")
    return None if hot.isEmpty() else hot


def listed_pairs(rows: DataFrame, key: str, split: str, values: list[str], both: bool = False, a: str = "a_", b: str = "b_",
                 block_rows: int = LIST_ROWS, most: int = LISTED_PER_TASK) -> DataFrame:
    """The pairs of :func:`self_pairs`, laid out by the item ``a``: a
    ``groupBy`` on it (and more) needs no further shuffle. With ``both`` each
    pair comes in both turns, so all partners of an item are together.

    The rows of a key are packed into lists, a row in one number of as few
    bytes as hold it, and each of its items receives the list (of the items
    after it, without ``both``): a pair costs a few bytes of a shuffle instead
    of a row. A key with more than ``block_rows`` rows has several lists, each
    of which meets each other. An item with more than ``most`` partners has
    them dealt to parts by the partner's hash; only then the result has a
    column :data:`PART`, a function of the pair, to be grouped by as well.
    """
    return PairLists(rows, key, split, values, both, a, b, block_rows, most).pairs()


class PairLists:
    """The lists behind :func:`listed_pairs`. They can be paired for one share
    of the items ``a`` after another (:meth:`in_shares`), so that the shuffled
    lists of one share are on disk at a time, or where they are made
    (``by_item=False``): then nothing is shuffled but the rows themselves."""

    def __init__(self, rows: DataFrame, key: str, split: str, values: list[str], both: bool = False, a: str = "a_", b: str = "b_",
                 block_rows: int = LIST_ROWS, most: int | None = None, by_item: bool = True, shares: bool = False):
        most = most or LISTED_PER_TASK
        self.key, self.split, self.cols, self.both, self.a, self.b, self.by_item, self.most = key, split, [split, *values], both, a, b, by_item, most
        rows = rows.where(F.col(key).isNotNull() & F.col(split).isNotNull())
        self.packed = _Packed(rows, self.cols)
        counts = materialize(_counts(rows, key, "__n"), "join-counts")
        met = counts.agg(F.sum(F.col("__n").cast("double") * F.col("__n")).alias("pairs"), F.max("__n").alias("longest"),
                         F.sum("__n").alias("rows")).first()
        self.total, longest = (met.pairs or 0) / (1 if both else 2), met.longest or 0
        #: how many shares of the items are paired one after another
        self.shares = max(1, min(math.ceil(self.total / SHARE_PAIRS), math.ceil(self.total / max(met.rows or 0, 1) / SHARE_PARTNERS))) if shares else 1
        self.least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.n = n = max(self.least, math.ceil(self.total / most))
        hot = _parts(rows, counts, key, split, longest, most) if by_item else None
        own = rows.select(key, *self.cols)
        self.parted = hot is not None
        if self.parted:
            own = own.join(hot, split, "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))
        self.cut = longest > block_rows
        if self.cut:
            blocks = materialize(counts.where(F.col("__n") > block_rows)
                                 .select(key, F.ceil(F.col("__n") / block_rows).cast("bigint").alias("__nb")), "hot-keys")
            own = own.join(blocks, key, "left").withColumn("__nb", F.coalesce("__nb", F.lit(1).cast("bigint"))).withColumn("__b", _block(split, "__nb"))
        block = ["__nb", "__b"] if self.cut else []
        self.listed = [*self.packed.columns, *(["__parts"] if self.parted else [])]
        own = own.select(key, *block, *self.packed.pack(), *(["__parts"] if self.parted else []))
        lists = (own.repartition(n, key, *block).groupBy(key, *block).agg(F.sort_array(F.collect_list(F.struct(*self.listed))).alias("__e"))
                 .select(key, *block, *[F.col(f"__e.{c}").alias(f"__y{c}") for c in self.listed]))
        if self.cut or self.shares > 1:
            lists = materialize(lists, "lists")
        self.lists = lists.repartition(n, key, *block) if self.cut else lists

    def _share(self, lists: DataFrame, share: int) -> DataFrame:
        """The rows whose item belongs to a share."""
        if self.shares == 1:
            return lists
        return lists.where(F.pmod(F.xxhash64(f"{self.a}{self.split}", F.lit("share")), F.lit(self.shares)) == share)

    def pairs(self, share: int = 0) -> DataFrame:
        """The pairs of one share of the items, lazily."""
        key, split, a, packed = self.key, self.split, self.a, self.packed
        size, first = F.size(f"__y{packed.columns[0]}"), F.lit(1) if self.both else F.col("__p") + 2
        x = lambda c: F.col(f"__x{c}")[F.col("__p")]
        mine = [packed.unpack(c, x).alias(f"{a}{c}") for c in self.cols] + ([x("__parts").alias("__parts")] if self.parted else [])
        rest = lambda c: F.col(f"__y{c}") if self.both else F.slice(F.col(f"__y{c}"), first, size)
        ends = [f"__y{c}" for c in packed.columns]
        # each row of a list with the list (or what follows): one turn of each pair, or both
        same = (self.lists.select("*", *[F.col(f"__y{c}").alias(f"__x{c}") for c in self.listed], _to(F.lit(0), size - 1).alias("__p"))
                .where(size >= F.col("__p") + 2 if not self.both else size > 1)
                .select(key, *mine, *[rest(c).alias(f"__y{c}") for c in packed.columns]))
        same = self._share(same, share)
        if self.cut:  # each row of a list with the key's other lists; turns are told apart below
            many = self.lists.where("__nb > 1")
            left = many.select(key, *[F.col(f"__y{c}").alias(f"__x{c}") for c in self.listed], F.col("__b").alias("__i"),
                               _to(F.lit(0).cast("bigint"), F.col("__nb") - 1).alias("__b")).where("__i <> __b").repartition(self.n, key, "__b")
            across = (left.join(many.select(key, "__b", *ends), [key, "__b"])
                      .select("*", _to(F.lit(0), F.size(f"__x{packed.columns[0]}") - 1).alias("__p"))
                      .select(key, *mine, *ends))
            same = same.unionByName(self._share(across, share))
        keys = [f"{a}{split}"]
        if self.parted:
            same = self._dealt(same)
            keys.append(PART)
        if self.by_item:
            n = max(self.least, math.ceil(self.total / self.shares / self.most))
            same = same.repartition(n, *keys)
            if not self.both:  # rows of an item follow each other: files of sums by pair are smaller
                same = same.sortWithinPartitions(*keys)
        last = ends[-1]
        y = lambda c: F.col("__v") if f"__y{c}" == last else F.col(f"__y{c}")[F.col("__q")]
        out = same.select("*", F.posexplode(last).alias("__q", "__v")).select(
            key, *[f"{a}{c}" for c in self.cols], *keys[1:], *[packed.unpack(c, y).alias(f"{self.b}{c}") for c in self.cols])
        one, other = F.col(f"{a}{split}"), F.col(f"{self.b}{split}")
        return out.where(one != other if self.both else one < other)

    def in_shares(self, result: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
        """``result`` of all pairs, written share by share. It takes pairs and
        gives rows of the items ``a``, of each by its own pairs alone."""
        path = scratch_path(self.lists.sparkSession, label)
        for share in range(self.shares):
            with shuffles_dropped(self.lists.sparkSession):
                result(self.pairs(share)).write.mode("append").parquet(path)
        return self.lists.sparkSession.read.parquet(path)

    def _dealt(self, lists: DataFrame) -> DataFrame:
        """The lists of items with several parts, cut into them by the partner."""
        ends = [f"__y{c}" for c in self.packed.columns]
        lists = lists.withColumn(PART, _to(F.lit(0), F.col("__parts") - 1))
        partner = lambda i: self.packed.unpack(self.split, lambda c: F.col(f"__y{c}")[i])
        at = F.filter(F.sequence(F.lit(0), F.size(ends[0]) - 1),
                      lambda i: F.pmod(F.xxhash64(partner(i)), F.col("__parts")) == F.col(PART))
        lists = lists.withColumn("__at", F.when(F.col("__parts") > 1, at)).where("__at IS NULL OR size(__at) > 0")
        cut = lambda c: F.when(F.col("__at").isNull(), F.col(c)).otherwise(F.transform("__at", lambda i: F.col(c)[i]))
        return lists.select(*[x for x in lists.columns if x not in ("__at", "__parts", *ends)], *[cut(c).alias(c) for c in ends])


DEFAULT_BROADCAST_BYTES = 64 << 20


def table_bytes(df: DataFrame) -> int:
    """Bytes of a table's values: 8 per number, the length of each string."""
    text = [c for c, kind in df.dtypes if kind == "string"]
    size = F.lit(8 * (len(df.columns) - len(text)))
    for c in text:
        size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 8
    return df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]


def fanout_join(small: DataFrame, big: DataFrame, key: str, small_split: str,
                big_split: str, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Join a side that is usually small (query users' ratings, neighbour
    lists of a batch, a history) with a large side.

    The small side is written once (it is typically the end of a longer
    plan) and its bytes are measured: up to ``max_broadcast_bytes`` it is
    broadcast, so the large side streams through without a shuffle and a
    hot key costs nothing extra. Beyond that bound the join is a
    :func:`blocked_join`.
    """
    small = materialize(small, "join-side")
    if table_bytes(small) <= max_broadcast_bytes:
        return big.join(F.broadcast(small), key)
    return blocked_join(small, big, key, small_split, big_split, block_rows=block_rows)


def free_ranks(taken: DataFrame, owners: DataFrame, owner: str, k: int, total: int,
               rank: str = "_r", block: int | None = None) -> DataFrame:
    """The ``k`` smallest ranks of 0..total-1 that ``taken(owner, rank)``
    does not hold, for each of ``owners``: ``(owner, rank)``.

    Ranks are cut into blocks (``block`` ranks each, by default the root of
    ``total``, at least ``k``). Counts of the taken ranks per owner and block,
    added up in order, tell which blocks hold one of the first ``k`` free
    ranks: at most ``k`` blocks, since a block without any taken rank (found
    in the gaps between counted ones) has room for all of them. Only the taken
    ranks of those blocks are sorted, block by block, so no window holds more
    than the blocks of an owner or the ranks of a block.
    """
    block = block or max(k, math.isqrt(max(total - 1, 0)) + 1)
    taken = taken.select(owner, F.col(rank).cast("bigint").alias("__t")).withColumn("__b", F.floor(F.col("__t") / block))
    needed = _blocks_with_room(taken, owners, owner, k, total, block)
    first = F.col("__b") * block
    last = F.least(first + block, F.lit(total).cast("bigint"))
    rows = (taken.join(needed, [owner, "__b"], "left_semi").select(owner, "__b", "__t")
            .unionByName(needed.select(owner, "__b", last.alias("__t"))))
    w = Window.partitionBy(owner, "__b").orderBy("__t")
    begin = F.coalesce(F.lag("__t").over(w) + 1, first)
    # free ranks of the block before the gap: ranks before it less those taken
    gaps = (rows.withColumn("__lo", begin).withColumn("__before", begin - first - F.row_number().over(w) + 1)
            .join(needed, [owner, "__b"])
            .withColumn("__n", F.least(F.col("__t") - F.col("__lo"), F.col("__want") - F.col("__before")))
            .where("__n > 0"))
    return gaps.select(owner, F.explode(F.sequence("__lo", F.col("__lo") + F.col("__n") - 1)).alias(rank))


def _blocks_with_room(taken: DataFrame, owners: DataFrame, owner: str, k: int, total: int, block: int) -> DataFrame:
    """``(owner, __b, __want)``: the blocks with the first ``k`` free ranks
    and how many of them may come from each. Written, it is read twice."""
    blocks = -(-total // block)
    size = lambda b: F.least(F.lit(block), F.lit(total) - b * block)
    counts = taken.groupBy(owner, "__b").agg(F.count(F.lit(1)).alias("__c")).withColumn("__free", size(F.col("__b")) - F.col("__c"))
    end = owners.select(owner).distinct().select(owner, F.lit(blocks).cast("bigint").alias("__b"), F.lit(0).cast("bigint").alias("__free"))
    w = Window.partitionBy(owner).orderBy("__b")
    earlier = F.coalesce(F.sum("__free").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = (counts.select(owner, "__b", "__free").unionByName(end)
            .withColumn("__previous", F.coalesce(F.lag("__b").over(w), F.lit(-1).cast("bigint")))
            .withColumn("__earlier", earlier)
            # blocks without a taken rank before this one, and before the previous one
            .withColumn("__empty", F.col("__b") - (F.row_number().over(w) - 1))
            .withColumn("__gap", F.col("__b") - F.col("__previous") - 1))
    own = rows.where("__free > 0").select(
        owner, "__b", (F.lit(k) - F.col("__earlier") - F.col("__empty") * block).alias("__want"))
    empty = rows.where("__gap > 0 AND __empty = __gap").select(
        owner, (F.col("__previous") + 1).alias("__b"), (F.lit(k) - F.col("__earlier")).alias("__want"))
    return materialize(own.unionByName(empty).where("__want > 0"), "blocks-with-room")
