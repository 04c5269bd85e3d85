"""Chat formatting: layouts are told by the fingerprint of their fields, and mapped to turns by declaration.

The fingerprint of a record is a hash of its sorted nested field paths with their kinds, `messages[].role:string` and so
on; null fields and empty lists have no kind and no path below. `LAYOUTS` declares for each layout the fields that must
be there and those that may be, and how turns are read from them; every allowed set of fields has its fingerprint in
one table, so a record finds its mapping by one look-up. Records of unknown layout, and those that are no JSON object,
are kept aside with their fingerprint.

The template writes a turn as `<|im_start|>role`, a line end, the text and `<|im_end|>`, a line end. Within roles and
texts every backslash is doubled and every control string of any common template gets a backslash after its first
character, so no text can close a turn, open one or forge a mark, and `unescaped` gives back what was there. The loss
mask spans exactly the assistants' escaped texts.

A conversation's turns may lie anywhere and may be many: rows are sorted by conversation and turn and streamed, and the
formatted text stays in pieces, one a turn. Nothing gathers a conversation.

Defined results: null and empty texts are turns with empty text; a null role is the empty one. Turns of one conversation
with equal or null numbers follow by role and text, nulls first; repeated rows are turns each. Rows with a null
conversation id are one conversation of that id. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, NumericType, StringType, StructType

#: Control strings of common chat templates.
CONTROLS = [
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>",
    "<|eot_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>",
]
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"

CONTROL_PATTERN = "|".join(re.escape(x) for x in sorted(CONTROLS, key=len, reverse=True))
_CONTROL = re.compile(CONTROL_PATTERN)


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as the template writes it, and begin and length of its text under the loss mask."""
    head = OPEN + escaped(role).replace("\n", "\\\n") + "\n"
    body = escaped(text)
    return head + body + CLOSE, len(head), len(body) if role == TRAINED else 0


_TURN = re.compile(re.escape(OPEN) + r"((?:[^\n\\]|\\.)*)\n(.*?)" + re.escape(CLOSE), re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        match = _TURN.match(formatted, at)
        if match is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescaped(match[1]), unescaped(match[2])))
        at = match.end()
    return turns


# Layouts


@dataclass(frozen=True)
class Layout:
    """Fields that a layout must have and may have, and how its turns are read.

    turns: (role, field) pairs, read in order and left out where the field is absent, or one (role field, text field)
    pair within the list field `each`. roles: other names of roles.
    """

    name: str
    must: tuple[str, ...]
    may: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str | None = None
    keys: tuple[str, str] = ("", "")
    roles: tuple[tuple[str, str], ...] = ()


_SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("prompter", "user"))
_NOTES = ("id:string", "id:number", "source:string")
LAYOUTS = [
    Layout("prompt and response", ("prompt:string", "response:string"), ("system:string", *_NOTES), (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt and completion", ("prompt:string", "completion:string"), ("system:string", *_NOTES), (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("question and answer", ("question:string", "answer:string"), ("context:string", *_NOTES), (("user", ("context", "question")), ("assistant", ("answer",)))),
    Layout("instruction", ("instruction:string", "output:string"), ("input:string", "system:string", *_NOTES), (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("messages", ("messages[].role:string", "messages[].content:string"), _NOTES, each="messages", keys=("role", "content"), roles=_SHARED),
    Layout("conversations", ("conversations[].from:string", "conversations[].value:string"), _NOTES, each="conversations", keys=("from", "value"), roles=_SHARED),
    Layout("turn row", ("conv_id:number", "role:string", "text:string", "turn:number"), (), (), None, ("role", "text")),
]


def paths_of(value, path: str = "") -> set[str]:
    """The nested field paths of a JSON value, with their kinds."""
    if isinstance(value, dict):
        return set().union(*(paths_of(v, f"{path}.{k}" if path else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(paths_of(v, path + "[]") for v in value))
    kind = "boolean" if isinstance(value, bool) else "string" if isinstance(value, str) else "number" if isinstance(value, (int, float)) else None
    return {f"{path}:{kind}"} if kind else set()


def paths_of_type(kind: DataType, path: str = "") -> set[str]:
    """The nested field paths of a column type."""
    if isinstance(kind, StructType):
        return set().union(*(paths_of_type(f.dataType, f"{path}.{f.name}" if path else f.name) for f in kind.fields))
    if isinstance(kind, ArrayType):
        return paths_of_type(kind.elementType, path + "[]")
    if isinstance(kind, MapType):
        return paths_of_type(kind.valueType, path + ".*")
    name = "string" if isinstance(kind, StringType) else "boolean" if isinstance(kind, BooleanType) else "number" if isinstance(kind, NumericType) else kind.simpleString()
    return {f"{path}:{name}"}


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def known_layouts(layouts: list[Layout] = LAYOUTS) -> dict[str, Layout]:
    """The layout of each fingerprint: every set of fields that a layout allows."""
    known = {}
    for layout in layouts:
        for n in range(len(layout.may) + 1):
            for more in itertools.combinations(layout.may, n):
                known[fingerprint({*layout.must, *more})] = layout
    return known


def turns_of(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """Roles and texts of a record."""
    names = dict(layout.roles)
    if layout.each is not None:
        role, text = layout.keys
        return [(names.get(x.get(role) or "", x.get(role) or ""), x.get(text) or "") for x in record[layout.each] or () if x is not None]
    if layout.keys[0]:
        return [(record.get(layout.keys[0]) or "", record.get(layout.keys[1]) or "")]
    out = []
    for role, fields in layout.turns:
        found = [record[f] for f in fields if record.get(f)]
        if found or any(f"{f}:string" in layout.must for f in fields):
            out.append((role, "\n\n".join(found)))
    return out


def canonical_turns(records: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, turn, role, text, fingerprint, layout of JSON records (conv_id, record).

    A record of unknown layout gives one row with null layout, turn, role and text.
    """
    known = known_layouts(layouts)
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fingerprint", pa.string()), ("layout", pa.string())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    value = json.loads(record) if record else None
                except (ValueError, RecursionError):
                    value = None
                mark = fingerprint(paths_of(value)) if isinstance(value, dict) else None
                layout = known.get(mark)
                turns = turns_of(value, layout) if layout else []
                rows += [(conv, i, role, text, mark, layout.name) for i, (role, text) in enumerate(turns)] if layout else [(conv, None, None, None, mark, None)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return records.select(F.col("conv_id").cast("long"), F.col("record").cast("string")).mapInArrow(of, "conv_id long, turn long, role string, text string, fingerprint string, layout string")


def turn_rows(table: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, turn, role, text of a table whose rows are turns, by the fingerprint of its columns.

    Columns that no layout of turn rows knows are ignored; raises if none fits.
    """
    paths = paths_of_type(table.schema)
    known = known_layouts(layouts)
    for layout in layouts:
        if not layout.each and not layout.turns and paths >= set(layout.must):
            found = known[fingerprint(paths & {*layout.must, *layout.may})]
            role, text = found.keys
            return table.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    raise ValueError(f"no layout for the fields {sorted(paths)}")


# Formatting

_PIECE_DDL = "conv_id long, place long, piece string, loss_begin long, loss_length long"
_PIECE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("piece", pa.string()), ("loss_begin", pa.int64()), ("loss_length", pa.int64())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation, place, begin = object(), 0, 0
    for batch in batches:
        rows = []
        for conv, _, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if conv != conversation:
                conversation, place, begin = conv, 0, 0
            piece, at, length = formatted_turn(role or "", text or "")
            rows.append((conv, place, piece, begin + at, length))
            place, begin = place + 1, begin + len(piece)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECE)], schema=_PIECE)


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, place, piece, loss_begin, loss_length: each conversation's formatted text in pieces, and its loss mask.

    A conversation is its pieces in order of place; loss_begin counts characters from its start.
    """
    rows = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(_pieces, _PIECE_DDL)


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_READ_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation, state = object(), None

    def done() -> list[tuple]:
        return [(conversation, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])] if state else []

    for batch in batches:
        rows = []
        for conv, _, piece, begin, length in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if state is None or conv != conversation:
                rows += done()
                conversation, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(piece):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            masked = unescaped(piece[begin - state[4] : begin - state[4] + length])
            state[2] += len(masked)
            state[3].update(masked.encode("utf-8", "surrogatepass"))
            state[4] += len(piece)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)
    if state:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done()), _READ)], schema=_READ)


def read_back(pieces: DataFrame) -> DataFrame:
    """Turns and loss mask of every conversation as read from its formatted pieces, as counts and digests."""
    rows = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(_digests, _READ_DDL)
