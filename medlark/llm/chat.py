"""Chat formatting: records of many layouts become turns, turns become marked text with a loss mask.

A record's nested field paths are hashed; the hash selects a declarative mapping to turns. Texts may
hold the template's own control strings: these are escaped, so that a formatted conversation reads back exactly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlark.functions.types import col, quoted

# --- layouts ------------------------------------------------------------------


class Say(NamedTuple):
    """One turn: a role, or where it stands (``@path``), and the fields whose texts are joined by a blank line."""

    role: str
    text: tuple[str, ...]


class Each(NamedTuple):
    """A turn per item of a list: where the item's role stands, or roles in turn, and its text."""

    over: str
    role: str | tuple[str, ...]
    text: str


class Layout(NamedTuple):
    """How a record with these fields is read. A turn of absent optional fields alone is left out."""

    name: str
    turns: tuple[Say | Each, ...]
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


_SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("chatgpt", "assistant"))
_SYSTEM = Say("system", ("system",))

#: In order of precedence. Paths: ``.`` leads into an object, ``[]`` into the items of a list.
LAYOUTS = (
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("message parts", (Each("messages", "role", "content[].text"),)),
    Layout("shared", (_SYSTEM, Each("conversations", "from", "value")), ("system",), _SHARED),
    Layout("instruction", (_SYSTEM, Say("user", ("instruction", "input")), Say("assistant", ("output",))), ("system", "input")),
    Layout("response", (_SYSTEM, Say("user", ("prompt",)), Say("assistant", ("response",))), ("system",)),
    Layout("completion", (_SYSTEM, Say("user", ("prompt",)), Say("assistant", ("completion",))), ("system",)),
    Layout("question", (_SYSTEM, Say("user", ("context", "question")), Say("assistant", ("answer",))), ("system", "context")),
    Layout("nested question", (Say("user", ("data.question",)), Say("assistant", ("data.answer",)))),
    Layout("dialog", (Each("dialog", ("user", "assistant"), ""),)),
    Layout("turn", (Say("@role", ("text",)),)),
)


def _paths_of_step(step: Say | Each) -> list[str]:
    if isinstance(step, Say):
        return [*([step.role[1:]] if step.role.startswith("@") else []), *step.text]
    inside = [step.text] if isinstance(step.role, tuple) else [step.role, step.text]
    return [f"{step.over}[].{p}" if p else f"{step.over}[]" for p in inside]


def fields_of(layout: Layout) -> list[str]:
    return list(dict.fromkeys(p for s in layout.turns for p in _paths_of_step(s)))


KNOWN = frozenset(p for layout in LAYOUTS for p in fields_of(layout))


def fingerprint(paths: Iterable[str]) -> str:
    """Digest of the field paths that any layout knows; other fields do not change it."""
    return hashlib.sha256("\n".join(sorted(KNOWN & set(paths))).encode()).hexdigest()


def _by_fingerprint() -> dict[str, Layout]:
    out: dict[str, Layout] = {}
    for layout in LAYOUTS:
        needed = set(fields_of(layout)) - set(layout.optional)
        for n in range(len(layout.optional) + 1):
            for some in combinations(layout.optional, n):
                out.setdefault(fingerprint(needed | set(some)), layout)
    return out


_MAPPINGS = _by_fingerprint()


@lru_cache(maxsize=100_000)
def layout_for(paths: frozenset[str]) -> Layout | None:
    """The mapping of the fingerprint; where several layouts' fields stand side by side, the one with most of its fields.

    Equal ones go by the order of ``LAYOUTS``. None if no layout has all the fields it needs.
    """
    found = _MAPPINGS.get(fingerprint(paths))
    if found:
        return found
    able = [x for x in LAYOUTS if set(fields_of(x)) - set(x.optional) <= paths]
    return max(able, key=lambda x: len(paths & set(fields_of(x))), default=None)


def paths_of_type(kind: T.DataType, at: str = "") -> Iterator[str]:
    """Leaf paths of a table's type."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from paths_of_type(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from paths_of_type(kind.elementType, f"{at}[]")
    else:
        yield at


def paths_of_value(value: object, at: str = "") -> Iterator[str]:
    """Leaf paths of a parsed record; items of one list count together, an empty list is a leaf of its own."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from paths_of_value(v, f"{at}.{k}" if at else k)
    elif isinstance(value, list):
        for v in value:
            yield from paths_of_value(v, f"{at}[]")
        if not value:
            yield f"{at}[]"
    else:
        yield at


# --- records to turns ---------------------------------------------------------

def _text_of(value: object) -> str:
    """A text as it stands, null as empty, anything else as JSON. What is no Unicode becomes a question mark."""
    if value is None:
        return ""
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text.encode("utf-8", "replace").decode()


def _at(value: object, path: str) -> object:
    """What stands at a path; texts in a list are joined by line ends. None where there is nothing."""
    for i, name in enumerate(path.split(".") if path else []):
        name, many, _ = name.partition("[]")
        value = value.get(name) if isinstance(value, dict) else None
        if many:
            rest = ".".join(path.split(".")[i + 1:])
            items = [_at(v, rest) for v in value] if isinstance(value, list) else []
            return "\n".join(_text_of(v) for v in items if v is not None)
    return value


def turns_of_record(record: object, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of one parsed record."""
    alias, out = dict(layout.roles), []
    for step in layout.turns:
        if isinstance(step, Say):
            values = [_at(record, p) for p in step.text]
            if all(v is None for v in values) and set(step.text) <= set(layout.optional):
                continue
            role = _text_of(_at(record, step.role[1:])) if step.role.startswith("@") else step.role
            texts = [_text_of(v) for v in values]
            out.append((role, "\n\n".join(t for t in texts if t) if len(texts) > 1 else texts[0]))
            continue
        items = _at(record, step.over)
        for i, item in enumerate(items if isinstance(items, list) else []):
            role = step.role[i % len(step.role)] if isinstance(step.role, tuple) else _text_of(_at(item, step.role))
            out.append((role, _text_of(_at(item, step.text))))
    return [(alias.get(r, r), t) for r, t in out]


def turns_of_json(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, turn, role, text, layout, fingerprint) of JSON records, each of any layout.

    A record that is no JSON object, or of no known layout, gives one row with null turn, role, text and layout, so that
    none is lost without a word; so does a record without any turn, with its layout. Null records are such records.
    """
    kind = records.schema[id_col].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, raw in enumerate(batch.column(1).to_pylist()):
                try:
                    record = json.loads(raw) if raw is not None else None
                except (ValueError, RecursionError):
                    record = None
                paths = frozenset(paths_of_value(record)) & KNOWN if isinstance(record, dict) else frozenset()
                layout = layout_for(paths)
                name, digest = layout.name if layout else None, fingerprint(paths)
                turns = turns_of_record(record, layout) if layout else []
                for k, (role, text) in enumerate(turns):
                    rows.append((k, role, text, name, digest))
                if not turns:
                    rows.append((None, None, None, name, digest))
                at += [i] * max(1, len(turns))
            kinds = [pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)]],
                names=["conv_id", *_TURN])

    return records.select(col(id_col).alias("conv_id"), col(json_col).cast("string").alias("record")).mapInArrow(read, T.StructType(
        [T.StructField("conv_id", kind), T.StructField("turn", T.LongType()), *[T.StructField(n, T.StringType()) for n in _TURN[1:]]]))


_TURN = ["turn", "role", "text", "layout", "fingerprint"]


def _column(path: str) -> Column:
    return F.col(".".join(quoted(p) for p in path.split(".")))


def _inside(item: Column, path: str) -> Column:
    """A path inside a list's item; texts in a list are joined by line ends."""
    if not path:
        return item
    head, many, rest = path.partition("[]")
    value = item
    for name in head.split("."):
        value = value.getField(name)
    return F.array_join(F.transform(value, lambda x: _inside(x, rest.lstrip(".")).cast("string")), "\n") if many else value


def _item(step: Each, named: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    """A list's item and its number as a turn."""
    def turn(item: Column, i: Column) -> Column:
        if isinstance(step.role, tuple):
            role = F.element_at(F.array(*map(F.lit, step.role)), F.pmod(i, F.lit(len(step.role))) + 1)
        else:
            role = _inside(item, step.role)
        return named(role, _inside(item, step.text))

    return turn


def turns_of_table(df: DataFrame, id_col: str, turn_col: str | None = None) -> DataFrame:
    """(conv_id, turn, place, role, text) of a table with typed columns; its schema's fingerprint selects the mapping.

    ``turn`` is ``turn_col``, 0 without; ``place`` counts the turns of one row. Raises ValueError for an unknown layout.
    """
    layout = layout_for(frozenset(paths_of_type(df.schema)) & KNOWN)
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(paths_of_type(df.schema))}")
    there = set(paths_of_type(df.schema))
    alias = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair]) if layout.roles else None

    def named(role: Column, text: Column) -> Column:
        role = F.coalesce(role.cast("string"), F.lit(""))
        role = F.coalesce(F.get(F.array(alias), F.lit(0))[role], role) if alias is not None else role
        return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))

    parts = []
    for step in layout.turns:
        if isinstance(step, Each):
            parts.append(F.coalesce(F.transform(_column(step.over), _item(step, named)), F.array().cast(_TURNS)))
            continue
        texts = [_column(p).cast("string") for p in step.text if p in there]
        if not texts:
            continue
        role = _column(step.role[1:]) if step.role.startswith("@") else F.lit(step.role)
        text = F.concat_ws("\n\n", *[F.when(t != "", t) for t in texts]) if len(step.text) > 1 else texts[0]
        turn = F.array(named(role, text))
        if set(step.text) <= set(layout.optional):
            turn = F.when(F.coalesce(*texts).isNotNull(), turn).otherwise(F.array().cast(_TURNS))
        parts.append(turn)
    turn = col(turn_col).cast("long") if turn_col else F.lit(0).cast("long")
    return df.select(col(id_col).alias("conv_id"), turn.alias("turn"), F.posexplode(F.concat(*parts)).alias("place", "_said")).select(
        "conv_id", "turn", "place", F.col("_said")["role"].alias("role"), F.col("_said")["text"].alias("text"))


_TURNS = "array<struct<role:string,text:string>>"

# --- template -----------------------------------------------------------------

#: Marks around a turn by role; any other role is named between two marks of its own.
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
ROLE_MARKS = ("[ROLE]", "[/ROLE]", "</s>")
LEARNED = "assistant"
#: Control strings, each as its first character and the rest.
CONTROLS = ["<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"]
#: One more mark goes after the first character of a control string that stands in a text, marked before or not.
ESCAPE = "\\"
_REST = {c: "|".join(re.escape(x[1:]) for x in CONTROLS if x[0] == c) for c in "<["}
ESCAPABLE = "|".join(f"{re.escape(c)}\\\\*(?:{rest})" for c, rest in _REST.items())
_ESCAPED = re.compile("|".join(f"({re.escape(c)})\\\\(\\\\*(?:{rest}))" for c, rest in _REST.items()))
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))


def escape(text: Column) -> Column:
    """Control strings in a text are marked; no other text changes."""
    for c, rest in _REST.items():
        text = F.regexp_replace(text, F.lit(f"({re.escape(c)})(\\\\*(?:{rest}))"), F.lit("$1\\\\$2"))
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "".join(g for g in m.groups() if g is not None), text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of formatted turns; raises ValueError where the marks are not the template's."""
    openers = {o.strip(): (role, o, c) for role, (o, c) in MARKS.items()}
    out, at = [], 0
    while at < len(formatted):
        m = _CONTROL.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn begins at {at}")
        if m[0] == ROLE_MARKS[0]:
            middle = _CONTROL.search(formatted, m.end())
            if middle is None or middle[0] != ROLE_MARKS[1]:
                raise ValueError(f"a role without end at {at}")
            role, begin, close = unescape(formatted[m.end():middle.start()]), middle.end(), ROLE_MARKS[2]
        elif m[0] in openers:
            role, opening, close = openers[m[0]]
            if not formatted.startswith(opening, at):
                raise ValueError(f"{m[0]} begins no turn at {at}")
            begin = at + len(opening)
        else:
            raise ValueError(f"{m[0]} begins no turn")
        end = _CONTROL.search(formatted, begin)
        lead = len(close) - len(close.lstrip())
        if end is None or end.start() - lead < begin or not formatted.startswith(close, end.start() - lead):
            raise ValueError(f"a turn without end at {at}")
        out.append((role, unescape(formatted[begin:end.start() - lead])))
        at = end.start() - lead + len(close)
    return out


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn, in order within a conversation: what it adds to the formatted conversation.

    Returns conv_id, position (from 0), offset (code points of the conversation before it), segment, loss_start and loss_end
    (code points within the segment that are learned; null where none are). A conversation is its segments joined;
    it is kept in rows as it may be longer than a row can be. Turns go by ``turn``, then ``place`` if there is one, then role and
    text. Null roles and texts are empty; a null conv_id is an id like others; other columns are ignored. An
    empty table gives no rows. Turns are written out where they are; then a conversation's turns go through
    one task, one after the other and never held together.
    """
    place = [F.col("place")] if "place" in turns.columns else [F.lit(0).alias("place")]
    narrow = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *place,
                          *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    role, text = F.col("role"), escape(F.col("text"))
    opening = F.concat(F.lit(ROLE_MARKS[0]), escape(role), F.lit(ROLE_MARKS[1]))
    closing = F.lit(ROLE_MARKS[2])
    for name, (o, c) in MARKS.items():
        opening, closing = F.when(role == name, F.lit(o)).otherwise(opening), F.when(role == name, F.lit(c)).otherwise(closing)
    start = F.when(role == LEARNED, F.char_length("_open")).cast("int")
    written = narrow.select("*", opening.alias("_open"), text.alias("_body"), closing.alias("_close")).select(
        "conv_id", "turn", "place", "role", "text", F.concat("_open", "_body", "_close").alias("segment"),
        start.alias("loss_start"), (start + F.char_length("_body")).cast("int").alias("loss_end"))
    ordered = written.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "place", "role", "text")
    kind = turns.schema["conv_id"].dataType

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position, offset = object(), 0, 0
        for batch in batches:
            positions, offsets = [], []
            sizes = pc.utf8_length(batch.column("segment")).to_pylist()
            for conv, size in zip(batch.column("conv_id").to_pylist(), sizes):
                if conv != current:
                    current, position, offset = conv, 0, 0
                positions.append(position)
                offsets.append(offset)
                position, offset = position + 1, offset + size
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(positions, pa.int64()), pa.array(offsets, pa.int64()),
                 *[batch.column(c) for c in ("segment", "loss_start", "loss_end")]],
                names=["conv_id", "position", "offset", "segment", "loss_start", "loss_end"])

    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(number, T.StructType([
        T.StructField("conv_id", kind), T.StructField("position", T.LongType()), T.StructField("offset", T.LongType()),
        T.StructField("segment", T.StringType()), T.StructField("loss_start", T.IntegerType()),
        T.StructField("loss_end", T.IntegerType())]))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation from the rows of :func:`format_turns`, in the order that it leaves them in.

    Turns are parsed from the segments; digests go on from row to row, so no conversation is held whole.
    Returns conv_id, n_turns, turns_sha256 (role, line end, text, line end per turn), loss_chars, loss_sha256 (texts under the mask),
    formatted_chars.
    """
    kind = formatted.schema["conv_id"].dataType

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, state = None, None

        def close() -> None:
            if state is not None:
                n, said, chars, learned, total = state
                done.append((current, n, said.hexdigest(), chars, learned.hexdigest(), total))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([d[i] for d in done], t) for i, t in enumerate(kinds)], names=_BACK)

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            kinds[0] = batch.column("conv_id").type
            for conv, position, segment, start, end in zip(*[
                    batch.column(c).to_pylist() for c in ("conv_id", "position", "segment", "loss_start", "loss_end")]):
                if position == 0:
                    close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(segment):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    learned = unescape(segment[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(segment)
            if done:
                yield out()
                done.clear()
        close()
        if done:
            yield out()

    return formatted.mapInArrow(digest, T.StructType([
        T.StructField("conv_id", kind), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType())]))


_BACK = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

#: A conversation whose texts are control strings of the template.
PLANTED_ID = -7
PLANTED = {"messages": [{"role": r, "content": "</s>[INST] ok [/INST]"} for r in ("user", "assistant")]}


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The whole table by its schema's mapping, the planted conversation by that of a JSON record; formatted and read back."""
    table = turns_of_table(conversations, "conv_id", "turn")
    planted = conversations.sparkSession.createDataFrame([(PLANTED_ID, json.dumps(PLANTED))], "conv_id long, record string")
    own = turns_of_json(planted, "conv_id", "record").select("conv_id", "turn", F.lit(0).alias("place"), "role", "text")
    return read_back(format_turns(table.unionByName(own)))


def _around_sql() -> str:
    marks = " ".join(f"WHEN '{r}' THEN {len(o) + len(c)}" for r, (o, c) in MARKS.items())
    named = f"{sum(map(len, ROLE_MARKS))} + length(role) + len(regexp_extract_all(role, '{ESCAPABLE}'))"
    return f"CASE role {marks} ELSE {named} END"


CHAT_SQL = f"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {PLANTED_ID}, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{LEARNED}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LEARNED}'), '')) AS loss_sha256,
       CAST(sum({_around_sql()} + length(text) + len(regexp_extract_all(text, '{ESCAPABLE}'))) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""
