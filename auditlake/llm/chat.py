"""Chat formatting: records of unlike layouts to canonical turns, then to one template.

A record is a VARIANT. Its nested field paths, without the types of the leaves, are
hashed; the hash picks a declarative mapping that says where the turns are. Rows of one
turn each are typed, so the field paths of their items are those of the schema: they are
hashed once, pick a mapping in the same way, and no VARIANT, which has a size limit, is made
of them. Columns that no row layout names play no part there. Everything is built-in
functions. A record whose paths no layout has gives NULL turns, and NULL for whatever
follows from them.

In the template every turn is ``<|turn|>role<|text|>text<|end|>``. Control strings in a
role or text, those of other common templates too, get a backslash after their first
character, and a backslash of the text is doubled, so what was said can be read back to
the letter and can never end a turn. The loss mask is a list of (start, length) in UTF-8
bytes of the formatted text, one for each assistant turn; it covers the escaped text
between the marks and nothing of the marks.

NULL role or text counts as empty. Turns are ordered by turn, then role, then text, so
repeated turn numbers have one order and repeated rows are repeated turns. A
conversation without turns gives an empty text. A conversation is one output text, so its
own rows do meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of this template and of common others; each starts with < or [ and
# ends with > or ], so no two can overlap.
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
LEARNED_ROLE = "assistant"
# Running sums are made in two steps, as a fold copies the list it makes at every item.
RUN = 256
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    ``paths`` are the field paths that make it, ``[]`` for the items of a list. Either
    ``items`` names a list with a role and a text field each, whose roles are renamed by
    ``roles``, or ``fields`` names one field per turn with its role; several fields of one
    role in a row make one turn, set apart by an empty line.
    """

    name: str
    paths: tuple[str, ...]
    items: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()


LAYOUTS = (
    Layout("messages", ("messages", "messages[].role", "messages[].content"), ("messages", "role", "content")),
    Layout(
        "dialogue",
        ("conversations", "conversations[].from", "conversations[].value"),
        ("conversations", "from", "value"),
        (("human", "user"), ("gpt", "assistant")),
    ),
    Layout("pair", ("prompt", "response"), fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("completion", ("prompt", "completion"), fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout(
        "instruction",
        ("instruction", "output"),
        fields=(("user", ("instruction",)), ("assistant", ("output",))),
    ),
    Layout(
        "instruction_input",
        ("instruction", "input", "output"),
        fields=(("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Layout(
        "system_pair",
        ("system", "prompt", "response"),
        fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    ),
    Layout("empty_messages", ("messages",), ("messages", "role", "content")),
)


# Tables with one row a turn; a record is the list of its rows.
ROW_LAYOUTS = (
    Layout("turn_rows", ("[].role", "[].text"), ("", "role", "text")),
    Layout("message_rows", ("[].role", "[].content"), ("", "role", "content")),
    Layout("dialogue_rows", ("[].from", "[].value"), ("", "from", "value"), (("human", "user"), ("gpt", "assistant"))),
)


def shape_of_paths(paths: Sequence[str]) -> str:
    """Nested field paths as the text that :func:`shape` gives for a record with them."""
    tree: dict = {}
    for path in paths:
        at = tree
        for part in filter(None, path.replace("[]", ".[]").split(".")):
            at = at.setdefault(part, {})

    def text(node: dict) -> str:
        if not node:
            return "_"
        if "[]" in node:
            return f"ARRAY<{text(node['[]'])}>"
        return "OBJECT<" + ", ".join(f"{k}: {text(node[k])}" for k in sorted(node)) + ">"

    return text(tree)


def shape(body: Column) -> Column:
    """Nested field paths of a VARIANT, keys sorted and the types of leaves left out."""
    leaf = r"\b(?:VOID|BOOLEAN|BIGINT|DECIMAL\(\d+,\d+\)|FLOAT|DOUBLE|STRING|BINARY|DATE|TIMESTAMP(?:_NTZ)?|UUID|VARIANT)\b"
    types_gone = F.regexp_replace(F.schema_of_variant(body), f"(?<=[<:] ?){leaf}(?=[,>]|$)", "_")
    # an empty list, or one without fields, is a leaf
    return F.regexp_replace(types_gone, "ARRAY<_>", "_")


def fingerprint(shape_text: Column) -> Column:
    return F.xxhash64(shape_text)


def shape_of_type(kind: T.DataType) -> str:
    """The same text for a declared type."""
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{shape_of_type(kind.elementType)}>"
    if isinstance(kind, T.StructType) and kind.fields:
        return "OBJECT<" + ", ".join(f"{f.name}: {shape_of_type(f.dataType)}" for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    return "_"


def mark_of(shape_text: str) -> int:
    """The number that :func:`fingerprint` gives, for text on the driver."""
    number = xxhash.xxh64_intdigest(shape_text.encode(), seed=42)
    return number - (1 << 64) if number >> 63 else number


def picked(kind: T.DataType, layouts: Sequence[Layout]) -> Layout | None:
    """The layout whose fingerprint is that of a declared type."""
    return {mark_of(shape_of_paths(x.paths)): x for x in layouts}.get(mark_of(shape_of_type(kind)))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _said_by(layout: Layout, role: Column) -> Column:
    """A role under its canonical name."""
    if not layout.roles:
        return role
    names = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair])
    return F.coalesce(F.try_element_at(names, role), role)


def _turns(layout: Layout, body: Column) -> Column:
    get = lambda path, kind: F.try_variant_get(body, f"$.{path}", kind)
    if layout.items:
        items, role, text = layout.items
        listed = get(items, f"array<struct<`{role}`: string, `{text}`: string>>")
        listed = F.coalesce(listed, F.array().cast(f"array<struct<`{role}`: string, `{text}`: string>>"))
        return F.transform(listed, lambda item: _turn(_said_by(layout, item[role]), item[text]))
    turns = []
    for role, fields in layout.fields:
        parts = [F.nullif(get(f, "string"), F.lit("")) for f in fields]
        text = F.concat_ws("\n\n", *parts) if len(parts) > 1 else get(fields[0], "string")
        turns.append(_turn(F.lit(role), text))
    return F.array(*turns)


def canonical_turns(body: Column, layouts: Sequence[Layout] = LAYOUTS) -> tuple[Column, Column]:
    """The turns of a record, and the name of the layout that its fingerprint picked."""
    mark = fingerprint(shape(body))
    turns, name = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for layout in reversed(layouts):
        hit = mark == fingerprint(F.lit(shape_of_paths(layout.paths)))
        turns = F.when(hit, _turns(layout, body)).otherwise(turns)
        name = F.when(hit, layout.name).otherwise(name)
    return turns, name


def turns_of_rows(rows: DataFrame, key: str = "conv_id", order: str = "turn", layouts: Sequence[Layout] = ROW_LAYOUTS) -> DataFrame:
    """``key, _turns, layout`` of a table with one row a turn.

    Each text is shuffled once; the lists are begun before the shuffle.
    """
    named = {path.rsplit(".", 1)[1] for layout in layouts for path in layout.paths}
    fields = [f for f in rows.schema.fields if f.name in named and f.name not in (key, order)]
    layout = picked(T.ArrayType(T.StructType(fields)), layouts)
    if layout is None:
        return rows.groupBy(key).agg(F.lit(None).cast(TURNS).alias("_turns"), F.lit(None).cast("string").alias("layout"))
    _, role, text = layout.items
    turn = _turn(_said_by(layout, F.col(f"`{role}`").cast("string")), F.col(f"`{text}`").cast("string"))
    listed = rows.select(key, F.struct(F.col(f"`{order}`").alias("at"), turn.alias("turn")).alias("item"))
    listed = listed.groupBy(key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    return listed.select(key, F.transform("items", lambda m: m["turn"]).alias("_turns"), F.lit(layout.name).alias("layout"))


def format_rows(rows: DataFrame, key: str = "conv_id", order: str = "turn", layouts: Sequence[Layout] = ROW_LAYOUTS) -> DataFrame:
    """As :func:`format_chats`, of a table with one row a turn."""
    return _formatted(turns_of_rows(rows, key, order, layouts))


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def unescaped(text: Column) -> Column:
    """A lone backslash goes, a double one becomes one."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(records: DataFrame, body: str = "body", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Add ``layout``, ``formatted`` and ``loss_mask`` in place of the record."""
    turns, name = canonical_turns(F.col(body), layouts)
    return _formatted(records.withColumns({"_turns": turns, "layout": name}).drop(body))


def _summed(sizes: str) -> Column:
    """For every ``RUN`` numbers their total and what comes before each of them."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / RUN)), lambda i: F.slice(sizes, (i * RUN + 1).cast("int"), F.lit(RUN)))
    return F.transform(runs, lambda run: _before_each(run, lambda x: x))


def _before_each(items: Column | str, number: Callable[[Column], Column]) -> Column:
    return F.aggregate(
        items,
        F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before")),
        lambda acc, x: F.struct((acc["total"] + number(x)).alias("total"), F.array_append(acc["before"], acc["total"]).alias("before")),
    )


def _running(summed: str) -> Column:
    """The sum of all numbers before each one."""
    offsets = _before_each(F.col(summed), lambda run: run["total"])["before"]
    return F.flatten(F.zip_with(F.col(summed), offsets, lambda run, start: F.transform(run["before"], lambda x: x + start)))


def _formatted(records: DataFrame) -> DataFrame:
    """``records`` with ``formatted`` and ``loss_mask`` in place of ``_turns``."""
    pieces = F.transform(
        "_turns",
        lambda t: F.struct(
            F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT)).alias("head"),
            escaped(t["text"]).alias("text"),
            (t["role"] == LEARNED_ROLE).alias("learned"),
        ),
    )
    whole = F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "")
    sizes = F.transform("_pieces", lambda p: F.octet_length(p["head"]) + F.octet_length(p["text"]) + len(END))
    spans = F.transform(
        F.arrays_zip("_pieces", "_starts"),
        lambda z: F.when(
            z["_pieces"]["learned"],
            F.struct(
                (z["_starts"] + F.octet_length(z["_pieces"]["head"])).alias("start"),
                F.octet_length(z["_pieces"]["text"]).alias("length"),
            ),
        ),
    )
    return (
        records.withColumn("_pieces", pieces)
        .withColumns({"formatted": whole, "_sizes": sizes})
        .withColumn("_summed", _summed("_sizes"))
        .withColumn("_starts", _running("_summed"))
        .withColumn("loss_mask", F.array_compact(spans))
        .drop("_turns", "_pieces", "_sizes", "_summed", "_starts")
    )


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as they were said."""
    quoted = lambda mark: mark.replace("|", r"\|")
    pieces = F.split(formatted, quoted(END))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def one(piece: Column) -> Column:
        parts = F.split(piece, quoted(TEXT))
        role = F.substring(F.get(parts, 0), len(TURN) + 1, 2**31 - 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.get(parts, 1)).alias("text"))

    return F.transform(pieces, one)


def masked_texts(formatted: Column, loss_mask: Column) -> Column:
    """The texts under a loss mask, as they were said. Give columns of a frame: both are
    read once for each span."""
    return F.transform(
        loss_mask,
        lambda s: unescaped(F.decode(F.substr(formatted.cast("binary"), s["start"] + 1, s["length"]), "UTF-8")),
    )


def digest(formatted: DataFrame, key: str) -> DataFrame:
    """What a reader gets back from formatted texts and masks, as counts and digests."""
    told = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select(
        key,
        "formatted",
        parsed_turns(F.col("formatted")).alias("_turns"),
        F.array_join(masked_texts(F.col("formatted"), F.col("loss_mask")), "").alias("_learned"),
    )
    return read.select(
        key,
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_learned"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
