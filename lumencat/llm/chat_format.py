"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns.

A record's layout is the set of its nested field paths that are not null. Its
fingerprint is the XXH64 (seed 42) of the sorted paths, computed by Spark's
xxhash64; each registered mapping knows the fingerprints of the layouts it
serves (its required paths with any of its optional ones), so heterogeneous
records of one table each find their mapping by one integer comparison.

The template writes a turn as ``<s>[INST]role[/INST]text</s>``. A control
string inside a role or a text gets a backslash after its first character, and
one that already has backslashes there gets one more: ``</s>`` becomes
``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``. Reading back takes one away, so
formatting is reversible and only look-alikes of control strings change.

The loss mask is a list of (start, length) spans in code points over the
formatted string: each assistant text once.

All of it is DataFrame functions. Rows of a conversation are ordered by (turn,
role, text). Defined results: null text or role: empty; null turn: first; null
conv_id: one conversation of its own; repeated rows: repeated turns; records of
an unknown layout: no turns, fingerprint kept; empty table: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed by the template.
OPEN, HEAD_END, CLOSE = "<s>[INST]", "[/INST]", "</s>"
#: What a text may not contain unescaped: first character, backslashes, the rest.
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
TURNS = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


@dataclass(frozen=True)
class Mapping:
    """Turns of one layout: constant-role fields in order, or a list of messages.

    fields: (path, role) of each turn. messages: path of an array of structs
    and the names of its role and text. row: the record is one turn itself,
    (role path, text path). columns: serves only tables that have them.
    """

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    fields: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None
    row: tuple[str, str] | None = None
    columns: tuple[str, ...] = ()

    def layouts(self) -> list[tuple[str, ...]]:
        """Every path set that this mapping serves."""
        return [(*self.required, *extra) for n in range(len(self.optional) + 1) for extra in combinations(self.optional, n)]


#: Layouts in common use; register more by passing mappings of your own.
MAPPINGS = (
    Mapping("turn_row", ("turn",), ("conv_id", "role", "text"), row=("role", "text")),
    Mapping("turn_row_without_turn", ("conv_id",), ("role", "text"), row=("role", "text")),
    Mapping("turn_row_bare", ("role",), ("text",), row=("role", "text")),
    Mapping("turn_row_text", ("text",), row=("role", "text")),
    Mapping("turn_row_empty", (), row=("role", "text"), columns=("conv_id", "turn", "role", "text")),
    Mapping("prompt_response", ("prompt", "response"), ("system",), fields=(("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    Mapping("prompt_completion", ("prompt", "completion"), fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("instruction", ("instruction", "output"), ("input",), fields=(("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    Mapping("question_answer", ("question", "answer"), fields=(("question", "user"), ("answer", "assistant"))),
    Mapping("messages", ("messages[].role", "messages[].content"), messages=("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), messages=("conversations", "from", "value")),
)
#: Other names of roles in message lists.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}


def layout_hash(paths: tuple[str, ...]) -> int:
    """The fingerprint of a path set, as Spark's xxhash64 gives it."""
    value = xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def field_paths(schema: T.StructType, prefix: str = "") -> dict[str, str]:
    """Leaf paths of a schema, and the column whose null hides each; [] marks list items."""
    out = {}
    for f in schema.fields:
        kind, path = f.dataType, prefix + f.name
        if isinstance(kind, T.StructType):
            out |= field_paths(kind, path + ".")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out |= {p.replace(path + ".", path + "[].", 1): path for p in field_paths(kind.elementType, path + ".")}
        else:
            out[path] = path
    return out


def schema_fingerprint(df: DataFrame, known: set[str] | None = None) -> Column:
    """Fingerprint of a record: hash of its sorted paths that are not null (of the known ones)."""
    paths = {p: c for p, c in field_paths(df.schema).items() if known is None or p in known}
    parts = [F.when(F.col(c).isNotNull(), F.lit(p)) for p, c in sorted(paths.items())]
    return F.xxhash64(F.concat_ws("\n", *parts) if parts else F.lit(""))


def canonical_turns(df: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """df with schema_fp, mapping and turns (array of role, text), by each record's layout.

    Columns outside all registered paths are carried and do not matter.
    """
    have = set(field_paths(df.schema))
    known = {p for m in mappings for p in (*m.required, *m.optional)}
    serving = [(m, [layout_hash(x) for x in m.layouts() if {*x, *m.columns} <= have]) for m in mappings]
    turns, names = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    fp = F.col("schema_fp")
    for m, hashes in reversed(serving):
        if hashes:
            turns = F.when(fp.isin(hashes), _mapped(m, have).cast(TURNS)).otherwise(turns)
            names = F.when(fp.isin(hashes), F.lit(m.name)).otherwise(names)
    out = df.withColumn("schema_fp", schema_fingerprint(df, known))
    return out.withColumn("mapping", names).withColumn("turns", F.coalesce(turns, F.array().cast(TURNS)))


def _mapped(m: Mapping, have: set[str]) -> Column:
    def text(path: str) -> Column:
        return F.coalesce(F.col(path).cast("string"), F.lit("")) if path in have else F.lit("")

    if m.row:
        return F.array(F.struct(text(m.row[0]).alias("role"), text(m.row[1]).alias("text")))
    if m.messages:
        path, role, body = m.messages
        names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
        blank = F.lit("")
        return F.transform(
            path,
            lambda x: F.struct(F.coalesce(names[x[role]], x[role], blank).alias("role"), F.coalesce(x[body].cast("string"), blank).alias("text")),
        )
    made = [F.when(F.col(p).isNotNull(), F.struct(F.lit(r).alias("role"), F.col(p).cast("string").alias("text"))) for p, r in m.fields if p in have]
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def format_turns(turns: DataFrame, conv_id: str = "conv_id", order: tuple[str, ...] = ("turn",)) -> DataFrame:
    """conv_id, formatted, loss_spans, n_turns from records with canonical turns.

    The offset of a turn is a running sum over its conversation (a sorted
    window, which spills), so a very long conversation is linear work.
    """
    one = turns.select(conv_id, *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.posexplode("turns").alias("at", "turn_"))
    one = one.select(conv_id, *[f"o{i}" for i in range(len(order))], "at", F.col("turn_.role").alias("role"), F.col("turn_.text").alias("text"))
    keys = [*[F.col(f"o{i}") for i in range(len(order))], "role", "text", "at"]
    one = one.withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(HEAD_END))).withColumn("body", escape(F.col("text")))
    one = one.withColumn("width", (F.char_length("head") + F.char_length("body") + len(CLOSE)).cast("bigint"))
    running = Window.partitionBy(conv_id).orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = one.withColumn("until", F.sum("width").over(running)).withColumn("no", F.count("*").over(running))
    start = F.col("until") - F.char_length("body") - len(CLOSE)
    span = F.when(F.col("role") == "assistant", F.struct(start.alias("start"), F.char_length("body").cast("bigint").alias("length")))
    parts = F.sort_array(F.collect_list(F.struct("no", F.concat("head", "body", F.lit(CLOSE)).alias("part"), span.alias("span"))))
    grouped = one.groupBy(conv_id).agg(parts.alias("parts"))
    return grouped.select(
        conv_id,
        F.array_join(F.transform("parts", lambda x: x["part"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss_spans"),
        F.size("parts").cast("bigint").alias("n_turns"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted string."""
    pieces = F.filter(F.split(formatted, r"\Q" + CLOSE + r"\E", -1), lambda x: x != "")

    def turn(piece: Column) -> Column:
        at = F.instr(piece, HEAD_END)
        role = F.substring(piece, F.lit(len(OPEN) + 1), at - 1 - len(OPEN))
        text = F.substring(piece, at + len(HEAD_END), F.char_length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
