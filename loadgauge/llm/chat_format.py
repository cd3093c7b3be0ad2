"""Chat formatting by schema fingerprints.

The nested field paths of a table, or of each JSON record, are hashed; the hash selects a declarative mapping from that layout
(messages, instruction, prompt, one row per turn, ...) to canonical turns. Turns become one text with a reversible escape
and a loss mask over what the assistant says. DataFrame expressions only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import or_empty

# The template, what it escapes, and the escapes. A backslash goes first on the way in and last on the way out; in an
# escaped text every backslash begins an escape, so none can be mistaken for another.
OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
LEARNED = "assistant"
# Fixed value: speaker names of other layouts.
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """How a layout gives turns: from a list ``each`` with fields, or from fixed ``turns`` (role, fields joined by a blank line)."""

    name: str
    each: str | None = None
    role: str | None = None
    text: str | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def paths(self) -> list[str]:
        if self.turns:
            return sorted(f for _, fields in self.turns for f in fields)
        stem = f"{self.each}[]." if self.each else ""
        return sorted(stem + f for f in (self.role, self.text))

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


MAPPINGS = (
    Mapping("turn_rows", role="role", text="text"),
    Mapping("messages", "messages", "role", "content"),
    Mapping("speakers", "conversations", "from", "value"),
    Mapping("instruction", turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction_input", turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("prompt", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt_response", turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("system_prompt", turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question", turns=(("user", ("question",)), ("assistant", ("answer",)))),
)
BY_FINGERPRINT = {m.fingerprint: m for m in MAPPINGS}
#: Paths that take part in a fingerprint; other fields of a record don't change its layout.
KNOWN = sorted({p for m in MAPPINGS for p in m.paths})
LISTS = sorted({m.each for m in MAPPINGS if m.each})


def schema_paths(schema: T.StructType) -> list[str]:
    """The known nested field paths of a table; fields of lists are written ``list[].field``."""
    found = []
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            found += [f"{f.name}[].{g}" for g in f.dataType.elementType.names]
        else:
            found.append(f.name)
    return [p for p in KNOWN if p in found]


def _turn(role: Column, text: Column) -> Column:
    named = or_empty(role.cast("string"))
    for old, new in SPEAKERS.items():
        named = F.when(role == old, F.lit(new)).otherwise(named)
    return F.struct(named.alias("role"), or_empty(text.cast("string")).alias("text"))


def _turns(m: Mapping, field, each) -> Column:
    """The mapping over a record: ``field`` gives a field's column, ``each`` the elements of a list and how to get their fields."""
    if m.each:
        elements, get = each(m.each)
        return F.transform(elements, lambda x: _turn(get(x, m.role), get(x, m.text)))
    if m.role:
        return F.array(_turn(field(m.role), field(m.text)))
    joined = [(role, F.concat_ws("\n\n", *[F.when(F.length(field(f)) > 0, field(f)) for f in fields])) for role, fields in m.turns]
    return F.array(*[_turn(F.lit(role), text) for role, text in joined])


def canonical_turns(docs: DataFrame) -> DataFrame:
    """A table's rows as (row, layout, turns); the fingerprint of its schema selects the mapping for all rows.

    A table of no known layout is an error that names the paths found. Null roles and texts are empty, a null list has no turns.
    """
    mapping = BY_FINGERPRINT.get(fingerprint(paths := schema_paths(docs.schema)))
    if mapping is None:
        raise ValueError(f"no mapping for a layout with the fields {paths}; the table has {docs.columns}")
    turns = _turns(mapping, lambda f: F.col(f"`{f}`"), lambda f: (F.coalesce(F.col(f"`{f}`"), F.array().cast(docs.schema[f].dataType)), lambda x, g: x[g]))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.lit(mapping.name).alias("layout"), turns.alias("turns"))


def _under(name: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(f"{name}[]."), k))


def canonical_records(docs: DataFrame, record: str) -> DataFrame:
    """Rows whose column ``record`` holds JSON of any layout as (row, layout, turns): each record's own fingerprint selects its mapping.

    Records that are no JSON object, or of no known layout, have a null layout and no turns; they stay in the result.
    """
    listed = "array<map<string,string>>"
    data = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.from_json(F.col(f"`{record}`"), "map<string,string>").alias("fields"))
    data = data.select("row", "fields", *[F.from_json(F.col("fields")[name], listed).alias(f"list_{name}") for name in LISTS])
    top = F.filter(F.coalesce(F.map_keys("fields"), F.array().cast("array<string>")), lambda k: k.isin([p for p in KNOWN if "[]" not in p]))
    parts = [top]
    for name in LISTS:
        keys = F.array_distinct(F.flatten(F.transform(F.coalesce(f"list_{name}", F.array().cast(listed)), lambda m: F.coalesce(F.map_keys(m), F.array().cast("array<string>")))))
        parts.append(F.filter(_under(name, keys), lambda p: p.isin(KNOWN)))
    found = data.withColumn("print", F.sha2(F.array_join(F.sort_array(F.concat(*parts)), "\n").cast("binary"), 256))
    none = F.array().cast("array<struct<role:string,text:string>>")
    layout, turns = F.lit(None).cast("string"), none
    for m in MAPPINGS:
        made = _turns(m, lambda f: F.col("fields")[f], lambda f: (F.filter(F.col(f"list_{f}"), lambda x: x.isNotNull()), lambda x, g: x[g]))
        layout = F.when(F.col("print") == m.fingerprint, F.lit(m.name)).otherwise(layout)
        turns = F.when(F.col("print") == m.fingerprint, made).otherwise(turns)
    return found.select("row", layout.alias("layout"), turns.alias("turns"))


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_turns(turns: DataFrame, conversation: str = "conversation", place: str = "place", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation from one row per turn: (conversation, n_turns, formatted, loss).

    ``loss`` lists (start, end) in code points of ``formatted`` for what the assistant says, escaped as it stands there. Turns go by place,
    null places first; equal places by role, then text, so repeated rows all stay. Null roles and texts are empty; rows
    with a null conversation are one conversation. A conversation's text is one value, so its rows come together in one task.
    """
    said = turns.select(F.col(f"`{conversation}`").alias("conversation"), F.col(f"`{place}`").alias("place"), or_empty(F.col(f"`{role}`")).alias("role"), or_empty(F.col(f"`{text}`")).alias("text"))
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), ROLE_ESCAPES), F.lit(SEP))
    cut = said.select("*", head.alias("head"), escaped(F.col("text")).alias("body"))
    cut = cut.withColumn("size", F.char_length("head") + F.char_length("body") + len(CLOSE))
    order = Window.partitionBy("conversation").orderBy("place", "role", "text")
    placed = cut.withColumn("number", F.row_number().over(order)).withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    start = F.col("before") + F.char_length("head")
    piece = F.struct("number", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), (F.col("role") == LEARNED).alias("learned"), start.alias("start"), (start + F.char_length("body")).alias("end"))
    whole = placed.groupBy("conversation").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return whole.select(
        "conversation",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        F.transform(F.filter("pieces", lambda p: p["learned"]), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias("loss"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text was made of."""
    parts = F.split(formatted, CLOSE, -1)
    at = lambda x: F.instr(x, SEP)
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda x: F.struct(
            unescaped(F.substring(x, F.lit(len(OPEN) + 1), at(x) - len(OPEN) - 1), ROLE_ESCAPES).alias("role"),
            unescaped(F.substring(x, at(x) + len(SEP), F.char_length(x))).alias("text"),
        ),
    )


def learned_text(formatted: Column, loss: Column) -> Column:
    """What lies under the loss mask, unescaped, one text after the other."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
