"""Operator 2: chat formatting of records with different layouts.

A layout is a declarative mapping from nested fields to canonical turns
(role, text). The nested field paths of a record are hashed to a
fingerprint that selects the mapping:

* typed tables: the schema's field paths (``turn_rows`` and any layout whose
  fields are columns);
* JSON records: all nested field paths of each record, parsed from its
  variant's schema.

Extra fields do not matter: if no layout has exactly the fingerprint, the
first layout (in order of the table) whose paths all occur is taken. A
record that fits no layout gives no turns, and its layout is null. A turn's
text may be a list of parts: their texts are joined, parts without text
(images) give none.

Canonical turns are formatted as ``<|im_start|>role\\ntext<|im_end|>\\n``.
Inside texts every backslash is doubled and one is put after the first
character of each control string of the common chat templates, so no text
can open or close a turn, and dropping each escaping backslash restores it.
Roles are URL-encoded. The loss mask is an array of (start, end) code-point
spans of the assistants' texts in the formatted string.

A conversation becomes one row, so its turns are gathered together; the
other steps are projections without a shuffle.

Defined results: a null text is empty, a null role is an empty role, turns
are ordered by (turn, role, text) with null turns first, repeated rows stay
repeated turns, rows without conversation id form one conversation, an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corate.llm.common import let, table

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common chat templates that texts must not contain
#: (fixed values).
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Turns per run of the offsets' sums: a conversation of n turns costs about
#: n * RUN additions.
RUN = 256
TURNS = "array<struct<role:string,text:string>>"


class Layout(NamedTuple):
    """``steps``: (role, path) turns in order, where an optional path may be
    missing; or a list of turns at ``turns`` with ``role``/``text`` fields,
    ``part`` being the text field of a text's parts if it is a list."""

    name: str
    steps: tuple[tuple[str, str, bool], ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    join: str = ""  # a second path appended to the first step's text
    part: str = ""

    def paths(self) -> list[str]:
        if self.turns:
            text = f"{self.turns}[].{self.text}"
            return [f"{self.turns}[].{self.role}", f"{text}[].{self.part}" if self.part else text]
        return [p for _, p, optional in self.steps if not optional] + [self.join] * bool(self.join)


#: Layouts of JSON records and of typed tables, the more specific first.
LAYOUTS = (
    Layout("messages", turns="messages", role="role", text="content"),
    Layout("message_parts", turns="messages", role="role", text="content", part="text"),
    Layout("sharegpt", turns="conversations", role="from", text="value"),
    Layout("turns", turns="turns", role="role", text="text"),
    Layout("instruction_input", join="input",
           steps=(("system", "system", True), ("user", "instruction", False), ("assistant", "output", False))),
    Layout("instruction", steps=(("system", "system", True), ("user", "instruction", False),
                                 ("assistant", "output", False))),
    Layout("prompt_completion", steps=(("system", "system", True), ("user", "prompt", False),
                                       ("assistant", "completion", False))),
    Layout("prompt_response", steps=(("system", "system", True), ("user", "prompt", False),
                                     ("assistant", "response", False))),
    Layout("question_answer", steps=(("user", "question", False), ("assistant", "answer", False))),
)
#: One row per turn: conversation id, order, role, text.
TURN_ROWS = ("conv_id", "turn", "role", "text")
#: Names of roles in the layouts, mapped to canonical ones (fixed values).
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` marks list elements."""
    out = []
    for f in schema.fields:
        path, kind = prefix + f.name, f.dataType
        while isinstance(kind, T.ArrayType):
            path, kind = path + "[]", kind.elementType
        out += schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


def select_layout(paths, layouts=LAYOUTS) -> Layout | str | None:
    """The layout for a set of field paths: by fingerprint, else the first
    one whose paths all occur."""
    by_hash = {fingerprint(x.paths()): x for x in reversed(layouts)}
    by_hash[fingerprint(TURN_ROWS)] = "turn_rows"
    if found := by_hash.get(fingerprint(paths)):
        return found
    have = set(paths)
    if have >= set(TURN_ROWS):
        return "turn_rows"
    return next((x for x in layouts if have >= set(x.paths())), None)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                    F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def turns_from_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """``(conv_id, turns)`` from a table with one row per turn."""
    return (df.groupBy(F.col(f"`{conv}`").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col(f"`{turn}`").alias("n"),
                F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")))).alias("t"))
            .select("conv_id", F.transform("t", lambda x: _turn(x["role"], x["text"])).alias("turns")))


def _json_turns(v: Column, layout: Layout) -> Column:
    get = lambda path, kind: F.try_variant_get(v, "$." + path, kind)
    if layout.turns:
        role = lambda r: F.coalesce(*[F.when(r == a, F.lit(b)) for a, b in ROLES.items()], r)
        of = lambda t, field, kind="string": F.try_variant_get(t, "$." + field, kind)

        def text(t: Column) -> Column:
            parts = F.transform(of(t, layout.text, "array<variant>"), lambda p: F.coalesce(
                F.try_variant_get(p, "$." + (layout.part or "text"), "string"),
                F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")), F.lit("")))
            # a list has a text of its own too (its JSON), so parts come first
            return F.coalesce(F.array_join(parts, ""), of(t, layout.text))

        return F.transform(get(layout.turns, "array<variant>"), lambda t: _turn(role(of(t, layout.role)), text(t)))
    turns = []
    for name, path, optional in layout.steps:
        text = get(path, "string")
        if layout.join and name == "user":
            more = get(layout.join, "string")
            text = F.when(F.coalesce(more, F.lit("")) == "", text) \
                .otherwise(F.concat(F.coalesce(text, F.lit("")), F.lit("\n\n"), more))
        turn = _turn(F.lit(name), text)
        turns.append(F.when(text.isNotNull(), turn) if optional else turn)
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


_SCHEMA_TOKEN = re.compile(r"(?:`((?:[^`]|``)*)`|([A-Za-z_][A-Za-z0-9_]*)): |(OBJECT<|ARRAY<)|(>)|, |[^<>,`]+")


def paths_of_schema(text: str | None) -> list[str]:
    """All nested field paths (sorted) of a variant's schema as Spark prints
    it: ``OBJECT<a: STRING, b: ARRAY<OBJECT<c: BIGINT>>>`` has ``a`` and
    ``b[].c``."""
    found, around, path = set(), [], ""
    for m in _SCHEMA_TOKEN.finditer(text or ""):
        name = m[2] if m[1] is None else m[1].replace("``", "`")
        if name is not None:
            path = f"{around[-1]}.{name}" if around[-1] else name
        elif m[3]:
            around.append(path)
            path += "[]" if m[3] == "ARRAY<" else ""
        elif m[4]:
            around.pop()
        elif m[0] != ", " and path:  # a type without fields
            found.add(path)
    return sorted(found)


def variant_paths():
    """A pandas UDF: field paths of schemas, each different one parsed once."""
    @F.pandas_udf("array<string>")
    def paths(schemas: pd.Series) -> pd.Series:
        return schemas.map({s: paths_of_schema(s) for s in schemas.unique()})

    return paths


def turns_from_json(df: DataFrame, json_col: str = "record", layouts=LAYOUTS) -> DataFrame:
    """The columns of ``df`` in a struct ``row``, the record's ``fingerprint``,
    the name of its ``layout`` (null: none fits) and its ``turns``.

    The field paths of each record come from its variant schema; their hash
    is looked up in the table of layouts, and the layout's declarative
    mapping reads the turns.
    """
    v = F.try_parse_json(F.col(f"`{json_col}`"))
    out = (df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), v.alias("v"))
           .withColumn("paths", variant_paths()(F.schema_of_variant("v")))
           .withColumn("fingerprint", F.substring(F.sha2(F.array_join("paths", "\n"), 256), 1, 16)))
    fits = [(F.col("fingerprint") == fingerprint(x.paths()), x) for x in layouts]
    fits += [(F.size(F.array_except(F.array(*[F.lit(p) for p in x.paths()]), F.col("paths"))) == 0, x)
             for x in layouts]
    name = F.coalesce(*[F.when(cond, F.lit(x.name)) for cond, x in fits])
    out = out.withColumn("layout", name)
    turns = F.coalesce(*[F.when(F.col("layout") == x.name, _json_turns(F.col("v"), x)) for x in layouts],
                       F.array().cast(TURNS))
    return out.select("row", "fingerprint", "layout", turns.cast(TURNS).alias("turns"))


def canonical_turns(df: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of a typed table, by its schema's fingerprint."""
    layout = select_layout(schema_paths(df.schema))
    if layout == "turn_rows":
        return turns_from_rows(df)
    if layout is None:
        raise ValueError(f"no layout fits the fields {schema_paths(df.schema)}")
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    key = F.col("conv_id") if "conv_id" in df.columns else F.lit(None).cast("bigint")
    got = turns_from_json(df.select(key.alias("conv_id"), row.alias("record")), "record", (layout,))
    return got.select(F.col("row.conv_id").alias("conv_id"), "turns")


def escape(text: Column) -> Column:
    """Backslashes doubled, one put after the first character of each
    control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(convs: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` of ``(conv_id, turns)``."""
    piece = lambda t: F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n"),
                               escape(t["text"]), F.lit(END))
    parts = F.transform("turns", lambda t: F.struct(
        piece(t).alias("s"), (t["role"] == "assistant").alias("loss"),
        (F.lit(len(START) + 1) + F.length(F.url_encode(t["role"]))).alias("head")))

    def spans(p: Column) -> Column:
        # ends of the pieces: the sum of whole runs before, and within the run
        size = F.transform(p, lambda x: F.length(x["s"]))
        total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
        runs = F.sequence(F.lit(0), F.greatest(F.floor((F.size(p) - 1) / RUN), F.lit(0)).cast("int"))
        both = lambda n: let(F.transform(runs, lambda b: total(F.slice(n, b * RUN + 1, RUN))), lambda sums: F.struct(
            n.alias("n"), F.transform(sums, lambda x, b: total(F.slice(sums, 1, b))).alias("before")))

        def ends(r: Column) -> Column:
            return F.transform(p, lambda x, i: F.struct(
                x["loss"].alias("loss"), x["head"].alias("head"), F.length(x["s"]).alias("len"),
                (r["before"][F.floor(i / RUN).cast("int")]
                 + total(F.slice(r["n"], i - i % RUN + 1, i % RUN + 1))).alias("end")))

        at = let(let(size, both), ends)
        return F.transform(F.filter(at, lambda x: x["loss"]), lambda x: F.struct(
            (x["end"] - x["len"] + x["head"]).alias("start"), (x["end"] - F.lit(len(END))).alias("end")))

    return convs.select("conv_id", let(parts, lambda p: F.struct(
        F.array_join(F.transform(p, lambda x: x["s"]), "").alias("f"), spans(p).alias("l"))).alias("r")) \
        .select("conv_id", F.col("r.f").alias("formatted"), F.col("r.l").alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) parsed from a formatted conversation."""
    pieces = F.filter(F.split(formatted, re.escape(END)), lambda s: s != "")

    def turn(s: Column) -> Column:
        body = F.substring(s, len(START) + 1, 2**31 - 1)
        cut = F.locate("\n", body)
        return F.struct(F.url_decode(F.substr(body, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substr(body, cut + 1)).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    # four bytes a code point, so that a span is found by its offset; the mark
    # in front keeps a decoder from taking a text's own for one
    def pieces(wide: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: unescape(F.decode(F.concat(
            F.unhex(F.lit("0000FEFF")), F.substr(wide, 4 * x["start"] + 1, 4 * (x["end"] - x["start"]))), "UTF-32"))), "")

    return let(F.encode(formatted, "UTF-32"), pieces)


def query(spark, sf_dir) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select(*TURN_ROWS)
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    chats = format_chats(canonical_turns(rows.unionByName(more)))
    back = chats.select(
        "conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"),
        read_back(F.col("formatted")).alias("t"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said_by = F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("t").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said_by, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")


def _sql() -> str:
    esc = r"replace(text, '\', '\\')"
    for c in CONTROL:
        esc = f"replace({esc}, '{c}', '{c[0]}\\{c[1:]}')"
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(START)} + length(url_encode(role)) + 1 + length({esc}) + {len(END)}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


SQL = _sql()
