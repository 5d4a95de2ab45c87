"""Conversations of several layouts in one chat template.

A record's layout is known by its fingerprint, a hash of the nested field paths that have values.
Each known fingerprint selects a mapping, which says in column expressions where the turns are. The
turns are written as ``<|im_start|>role, newline, text, <|im_end|>, newline``. In texts ``<|`` is
written ``<\\|`` and a backslash twice; roles are URL-encoded. So no text can end its turn or open
another, and both come back as they were. The loss mask is the list of spans (code points, end
exclusive) of the assistant's texts. Everything is DataFrame functions.

Defined results: a NULL text or role is empty. A record whose layout has no mapping has no turns and
``layout`` NULL; nothing is guessed. A conversation is one row of the output, so its turns meet in one
task, as they must to make one text; order and span sums are windows that spill. Key values have to
differ, or their conversations are one. Fields that no mapping names are part of the fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from histload.names import quoted

# The template's control strings.
BEGIN, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
TURNS = "array<struct<role: string, text: string>>"


def field_paths(name: str, kind: DataType, value: Column) -> list[tuple[str, Column]]:
    """(path, whether the row has a value there) of every leaf below a column."""
    if isinstance(kind, StructType):
        inside = [field_paths(f.name, f.dataType, value.getField(f.name)) for f in kind]
        return [(f"{name}.{path}", has) for paths in inside for path, has in paths]
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        return [_element_path(name, field.name, value) for field in kind.elementType]
    return [(name, value.isNotNull())]


def _element_path(name: str, field: str, value: Column) -> tuple[str, Column]:
    """The path of a field of a list's elements, there if any element has it; not looked into."""
    return f"{name}[].{field}", F.exists(value, lambda one: one.getField(field).isNotNull())


def fingerprint_of(paths: Sequence[str]) -> str:
    return hashlib.sha256(",".join(sorted(paths)).encode()).hexdigest()


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """The hash of the sorted nested field paths that have values in a row."""
    found = [
        pair
        for name in columns
        for pair in field_paths(name, df.schema[name].dataType, F.col(quoted(name)))
    ]
    present = [F.when(F.coalesce(has, F.lit(False)), F.lit(path)) for path, has in sorted(found, key=lambda pair: pair[0])]
    return F.sha2(F.concat_ws(",", *present), 256)


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns: ``turns`` makes an array of (role, text) of its columns."""

    layout: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]

    @property
    def columns(self) -> set[str]:
        return {path.split("[]")[0].split(".")[0] for path in self.paths}


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def _listed(column: str, role: str, text: str, names: dict[str, str] | None = None):
    def turn(one):
        who = one.getField(role)
        for old, new in (names or {}).items():
            who = F.when(one.getField(role) == old, new).otherwise(who)
        return F.struct(who.alias("role"), one.getField(text).alias("text"))

    return lambda: F.transform(column, turn)


def _asked() -> Column:
    return F.concat_ws("\n\n", "instruction", "input")


MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), _listed("messages", "role", "content")),
    Mapping(
        "dialogue",
        ("conversations[].from", "conversations[].value"),
        _listed("conversations", "from", "value", {"human": "user", "gpt": ASSISTANT}),
    ),
    Mapping(
        "prompt",
        ("prompt", "response"),
        lambda: F.array(_turn("user", F.col("prompt")), _turn(ASSISTANT, F.col("response"))),
    ),
    Mapping(
        "system_prompt",
        ("system", "prompt", "response"),
        lambda: F.array(
            _turn("system", F.col("system")),
            _turn("user", F.col("prompt")),
            _turn(ASSISTANT, F.col("response")),
        ),
    ),
    Mapping(
        "instruction",
        ("instruction", "output"),
        lambda: F.array(_turn("user", F.col("instruction")), _turn(ASSISTANT, F.col("output"))),
    ),
    Mapping(
        "instruction_input",
        ("instruction", "input", "output"),
        lambda: F.array(_turn("user", _asked()), _turn(ASSISTANT, F.col("output"))),
    ),
)


def canonical_turns(
    records: DataFrame, key: str = "conv_id", mappings: Sequence[Mapping] = MAPPINGS
) -> DataFrame:
    """(``key``, layout, turns): the turns of each record, by the mapping its fingerprint selects."""
    columns = [name for name in records.columns if name != key]
    usable = [m for m in mappings if m.columns <= set(columns)]
    marked = records.withColumn("__layout", fingerprint(records, columns))
    layout, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for mapping in usable:
        same = F.col("__layout") == fingerprint_of(mapping.paths)
        layout = F.when(same, mapping.layout).otherwise(layout)
        turns = F.when(same, mapping.turns().cast(TURNS)).otherwise(turns)
    return marked.select(quoted(key), layout.alias("layout"), turns.alias("turns"))


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def formatted(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(``key``, formatted, loss) of (``key``, turns): the text in the template and its loss spans."""
    each = turns.select(quoted(key), F.posexplode_outer("turns").alias("n", "one"))
    role, text = (F.coalesce(F.col(f"one.{name}"), F.lit("")) for name in ("role", "text"))
    each = each.select(
        quoted(key),
        "n",
        (role == ASSISTANT).alias("learned"),
        F.concat(F.lit(BEGIN), F.url_encode(role), F.lit("\n")).alias("head"),
        escaped(text).alias("body"),
    )
    piece = F.concat("head", "body", F.lit(END + "\n"))
    along = Window.partitionBy(quoted(key)).orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length(piece)).over(along), F.lit(0)) + F.length("head")
    each = each.withColumn("start", before)
    span = F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end"))
    parts = F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("n", piece.alias("piece")))))
    return each.groupBy(quoted(key)).agg(
        F.array_join(F.transform(parts, lambda part: part["piece"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("learned"), span))).alias("loss"),
    )


def parsed(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """(``key``, turns, loss_text, formatted_chars) read back from ``formatted``."""

    def turn(piece):
        head = F.substring_index(piece, "\n", 1)
        role = F.url_decode(F.substr(head, F.lit(len(BEGIN) + 1)))
        text = F.substr(piece, F.length(head) + 2)
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    pieces = F.split("formatted", r"<\|im_end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def learned(span):
        return unescaped(F.substr("formatted", span["start"] + 1, span["end"] - span["start"]))

    return rows.select(
        quoted(key),
        F.transform(pieces, turn).alias("turns"),
        F.array_join(F.transform("loss", learned), "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
