"""Chat formatting with layouts chosen by schema fingerprint.

A fingerprint is the hash of the nested field paths of a table (or of one JSON
record); it selects a declarative mapping that turns the layout into canonical
turns, an array of (role, text).  The template marks turns, and control strings
inside texts are escaped so that formatting can be undone exactly.

Everything is DataFrame functions.  A conversation is one output row, so it must fit
in one as its text does.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
#: Roles by the names that some layouts use for them.
ROLE_NAMES = {"human": "user", "gpt": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``fields``: (role, path) for layouts with one field per turn, in turn order;
    ``items``: (list path, role field, text field) for layouts with a list;
    ``rows``: (order, role, text) columns for layouts with a row per turn.
    Fields in ``optional`` give no turn where they are null or empty; ``renamed``
    layouts write roles as in ``ROLE_NAMES``, others as they are.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    items: tuple[str, str, str] | None = None
    rows: tuple[str, str, str] | None = None
    optional: frozenset[str] = field(default_factory=frozenset)
    renamed: bool = False

    @property
    def paths(self) -> list[str]:
        if self.rows:
            return sorted(self.rows)
        if self.items:
            where, role, text = self.items
            return sorted([f"{where}[].{role}", f"{where}[].{text}"])
        return sorted(path for _, path in self.fields)


LAYOUTS = (
    Layout("turn rows", rows=("turn", "role", "text")),
    Layout("messages", items=("messages", "role", "content")),
    Layout("from-value list", items=("conversations", "from", "value"), renamed=True),
    Layout("prompt and response", fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("prompt and completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question and answer", fields=(("user", "question"), ("assistant", "answer"))),
    Layout(
        "system, prompt and response",
        fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
        optional=frozenset({"system"}),
    ),
    Layout(
        "instruction, input and output",
        fields=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=frozenset({"input"}),
    ),
    Layout("nested prompt", fields=(("user", "data.prompt"), ("assistant", "data.response"))),
)


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves; a list adds ``[]``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, at + "[]")
    return [at]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}
_KNOWN = {path for layout in LAYOUTS for path in layout.paths}


def layout_of(schema: T.StructType) -> Layout:
    """The mapping for a table; columns that no mapping names do not count.

    Where the known paths are those of no layout, because a column is named like a
    field of another one, the first layout of the most paths that are all there holds.
    """
    paths = [p for p in field_paths(schema) if p in _KNOWN]
    if exact := BY_FINGERPRINT.get(fingerprint(paths)):
        return exact
    present = [layout for layout in LAYOUTS if set(layout.paths) <= set(paths)]
    if not present:
        raise ValueError(f"no layout has only fields of {sorted(paths)}")
    return max(present, key=lambda layout: len(layout.paths))


def _role(role: Column, renamed: bool) -> Column:
    role = F.coalesce(role.cast("string"), F.lit(""))
    for name, meant in ROLE_NAMES.items() if renamed else ():
        role = F.when(role == name, F.lit(meant)).otherwise(role)
    return role


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _field_turns(layout: Layout, get) -> Column:
    turns = []
    for role, path in layout.fields:
        one = _turn(F.lit(role), get(path))
        empty = F.coalesce(F.length(get(path)), F.lit(0)) == 0
        turns.append(F.when(~empty, one) if path in layout.optional else one)
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def _item_turns(layout: Layout, items: Column) -> Column:
    _, role, text = layout.items
    return F.transform(F.coalesce(items, F.array()), lambda i: _turn(_role(i[role], layout.renamed), i[text]))


def canonical_turns(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(``conv_id``, ``turns``) from a table in any known layout.

    A null role or text is empty, a null list has no turns, and rows of a layout with
    one row per turn are put in order of turn, nulls first, ties by role and text.
    A null id is a conversation of its own.  Other columns are ignored, also those
    named like a field of another layout.
    """
    layout = layout_of(df.drop(conv_id).schema)
    key = F.col(conv_id).cast("long").alias("conv_id")
    if layout.rows:
        order, role, text = layout.rows
        turn = F.struct(
            F.col(order).cast("long").alias("turn"), _role(F.col(role), layout.renamed).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
        )
        rows = df.select(key, turn.alias("turn")).groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
        return rows.select("conv_id", F.transform("turns", lambda t: _turn(t["role"], t["text"])).alias("turns"))
    if layout.items:
        return df.select(key, _item_turns(layout, F.col(layout.items[0])).alias("turns"))
    return df.select(key, _field_turns(layout, lambda p: F.col(p).cast("string")).alias("turns"))


def _shape(paths: list[str]) -> str:
    """The shape that records with these leaves have: keys in order, leaves as ``_``."""
    tree: dict = {}
    for path in paths:
        at = tree
        parts = path.split(".")
        for part in parts[:-1]:
            at = at.setdefault(part, {})
        at[parts[-1]] = None

    def written(node: dict | None) -> str:
        if node is None:
            return "_"
        inner = []
        for name in sorted(node):
            own = written(node[name])
            inner.append(f"{name[:-2]}: ARRAY<{own}>" if name.endswith("[]") else f"{name}: {own}")
        return "OBJECT<" + ", ".join(inner) + ">"

    return written(tree)


def record_fingerprint(record: Column) -> Column:
    """Fingerprint of one parsed JSON record: its nested keys without the leaves' types."""
    shape = F.schema_of_variant(record)
    return F.sha2(F.regexp_replace(shape, r"(?<=[ <])[A-Z]+(\([0-9,]+\))?(?=[,>])", "_"), 256)


def canonical_records(df: DataFrame, conv_id: str, record: str) -> DataFrame:
    """(``conv_id``, ``layout``, ``turns``) from JSON texts, each in a layout of its own.

    A text that is null, no JSON, or in no known layout keeps its row, with nulls.
    """
    parsed = df.select(F.col(conv_id).cast("long").alias("conv_id"), F.try_parse_json(F.col(record)).alias("r"))
    marked = parsed.withColumn("print", record_fingerprint(F.col("r")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for one in LAYOUTS:
        if one.rows:
            continue
        hit = F.col("print") == hashlib.sha256(_shape(one.paths).encode()).hexdigest()
        if one.items:
            where, role, text = one.items
            items = F.try_variant_get("r", f"$.{where}", f"array<struct<`{role}`:string,`{text}`:string>>")
            made = _item_turns(one, items)
        else:
            made = _field_turns(one, lambda p: F.try_variant_get("r", f"$.{p}", "string"))
        layout = F.when(hit, F.lit(one.name)).otherwise(layout)
        turns = F.when(hit, made).otherwise(turns)
    return marked.select("conv_id", layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    """Put one more backslash into every ``<|``, ``<\\|`` and so on, so none reads as control."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n|>"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n|>"), F.lit("\n")))


def format_chat(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(``conv_id``, ``formatted``, ``loss``).

    ``loss`` has one entry per turn: where the text to learn starts, in code points
    from the turn's mark, and its length (0 for turns that are not learned).
    """
    head = lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))
    piece = lambda t: F.concat(head(t), escape(t["text"]), F.lit(END + "\n"))

    def learned(t: Column) -> Column:
        length = F.when(t["role"].isin(*loss_roles), F.length(escape(t["text"]))).otherwise(0)
        return F.struct(F.length(head(t)).alias("start"), length.alias("length"))

    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", piece), "").alias("formatted"),
        F.transform("turns", learned).alias("loss"),
    )


def read_chat(formatted: DataFrame) -> DataFrame:
    """Undo :func:`format_chat`: adds ``turns`` and ``learned``, the texts under the mask."""
    marked = F.split("formatted", F.lit(r"(?=<\|im_start\|>)"))
    pieces = F.filter(marked, lambda p: p != "")

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(START) + 1), F.length(piece) - (len(START) + len(END) + 1))
        role = F.substring_index(inner, "\n", 1)
        text = F.substring(inner, F.length(role) + 2, F.length(inner))
        return _turn(_unescape_role(role), unescape(text))

    masked = F.zip_with(
        pieces, "loss", lambda p, m: F.when(m["length"] > 0, unescape(F.substring(p, m["start"] + 1, m["length"])))
    )
    return formatted.select(
        "*", F.transform(pieces, turn).alias("turns"), F.filter(masked, lambda t: t.isNotNull()).alias("learned")
    )


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Digests of what :func:`read_chat` reads back."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return read_chat(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, i, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
), e AS (
  SELECT *, length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) AS n,
         length(replace(regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g'), chr(10), '<|n|>')) AS m
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n + m + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
