"""Chat formatting with schema fingerprints.

A record in one of several layouts (prompt pairs, instructions, message lists, single messages) arrives as JSON. Its
nested field paths are hashed; the hash picks a declarative mapping that says where the turns are. Turns are
written with role marks and an end mark; control strings inside texts are escaped with backslashes, so the turns,
and the assistant texts under the loss mask, can be read back from the formatted text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK, END = "### ", "</turn>"
_TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
_NAMES = {v: k for k, v in _TITLES.items()}


@dataclass(frozen=True)
class Mapping:
    """Where a layout has its turns: ``items`` is the path of a list of messages, or empty for the record itself.

    Each of ``turns`` is (role, path of the text, path of more text); a role that begins with "@" is a path
    whose value, after ``roles``, is the role.
    """

    paths: tuple[str, ...]
    turns: tuple[tuple[str, ...], ...]
    items: str = ""
    roles: tuple[tuple[str, str], ...] = ()


_SHARE = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
#: The layouts that are known; fields that are absent or null leave their path out of the fingerprint.
MAPPINGS = (
    Mapping(("role", "text"), (("@role", "text"),)),
    Mapping(("role",), (("@role", "text"),)),
    Mapping(("text",), (("@role", "text"),)),
    Mapping((), (("@role", "text"),)),
    Mapping(("content", "role"), (("@role", "content"),)),
    Mapping(("messages[].content", "messages[].role"), (("@role", "content"),), "messages"),
    Mapping(("conversations[].from", "conversations[].value"), (("@from", "value"),), "conversations", _SHARE),
    Mapping(("turns[].role", "turns[].text"), (("@role", "text"),), "turns"),
    Mapping(("completion", "prompt"), (("user", "prompt"), ("assistant", "completion"))),
    Mapping(("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Mapping(("prompt", "response", "system"), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping(("answer", "question"), (("user", "question"), ("assistant", "answer"))),
    Mapping(("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Mapping(("input", "instruction", "output"), (("user", "instruction", "input"), ("assistant", "output"))),
    Mapping(("input", "instruction", "output", "system"), (("system", "system"), ("user", "instruction", "input"), ("assistant", "output"))),
)


def field_paths(value: object, at: str = "") -> set[str]:
    """Paths of all values that aren't null; "[]" stands for the places of a list. Empty lists and objects have no path."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value))
    return set() if value is None else {at}


def fingerprint(paths: set[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


_BY_PRINT = {fingerprint(m.paths): m for m in MAPPINGS}


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False, sort_keys=True)


def canonical(record: object, mappings: dict[str, Mapping] = _BY_PRINT) -> list[tuple[str, str]] | None:
    """(role, text) turns of a record, or None if its layout is unknown."""
    if not isinstance(record, dict):
        return None
    mapping = mappings.get(fingerprint(field_paths(record)))
    if mapping is None:
        return None
    out = []
    for item in record[mapping.items] if mapping.items else [record]:
        for role, first, *more in mapping.turns:
            name = _text(item.get(role[1:])) if role.startswith("@") else role
            texts = [_text(item.get(p)) for p in (first, *more)]
            out.append((dict(mapping.roles).get(name, name), "\n\n".join(t for t in texts[:1] + [t for t in texts[1:] if t])))
    return out


def escape(text: str) -> str:
    """Put a backslash before backslashes and before control strings."""
    return text.replace("\\", "\\\\").replace(MARK, "\\" + MARK).replace(END, "\\" + END)


def unescape(text: str) -> str:
    pieces = text.split("\\\\")
    return "\\".join(p.replace("\\" + MARK, MARK).replace("\\" + END, END) for p in pieces)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its escaped text begins and ends.

    Other roles than system, user and assistant are written as "=" and the escaped name.
    """
    name = _TITLES.get(role) or "=" + escape(role).replace(":", "\\:")
    head = f"{MARK}{name}: "
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def _plain_at(s: str, wanted: str, at: int) -> int:
    """First place of a string that no backslash escapes; backslashes come in pairs where they are text."""
    while True:
        found = s.find(wanted, at)
        if found < 0:
            raise ValueError(f"no {wanted!r}")
        k = found
        while k > 0 and s[k - 1] == "\\":
            k -= 1
        if (found - k) % 2 == 0:
            return found
        at = found + 1


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(MARK, at):
            raise ValueError("a turn begins with a role mark")
        begin = at + len(MARK)
        stop = _plain_at(formatted, ": ", begin)
        name = formatted[begin:stop]
        role = unescape(name[1:].replace("\\:", ":")) if name.startswith("=") else _NAMES[name]
        end = _plain_at(formatted, END, stop + 2)
        yield role, unescape(formatted[stop + 2 : end])
        at = end + len(END) + 1


_TURNS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
                    ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("layout", pa.string())])
_TURNS_DDL = "conv_id long, place long, role string, formatted string, loss_start long, loss_end long, layout string"


def format_records(records: DataFrame) -> DataFrame:
    """Formatted turns of JSON records (conv_id, place, record): one row per turn.

    Returns conv_id, place, role, formatted, loss_start and loss_end (the assistant text in ``formatted``, in code points; null in
    other turns) and layout (the fingerprint). A record of an unknown layout, or that isn't JSON, gives one row with null
    role and formatted text, so nothing is lost. Null texts count as empty, null roles as the empty role. Turns of one record share its place and are
    in order of the record.
    """

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows: list[tuple] = []
            for conv, place, text in zip(*(part[c].to_pylist() for c in ("conv_id", "place", "record"))):
                try:
                    value = json.loads(text) if text is not None else None
                except ValueError:
                    value = None
                turns = canonical(value)
                layout = fingerprint(field_paths(value)) if isinstance(value, dict) else None
                if turns is None:
                    rows.append((conv, place, None, None, None, None, layout))
                for role, body in turns or ():
                    formatted, a, b = format_turn(role, body)
                    mask = (a, b) if role == "assistant" else (None, None)
                    rows.append((conv, place, role, formatted, *mask, layout))
            columns = list(zip(*rows)) or [()] * len(_TURNS)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TURNS)], schema=_TURNS)

    keyed = records.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("place").cast("long").alias("place"), F.col("record").cast("string").alias("record"))
    return keyed.mapInArrow(apply, _TURNS_DDL)


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(turns: DataFrame) -> DataFrame:
    """Digests per conversation, from its formatted turns alone.

    ``turns`` has conv_id, place, formatted, loss_start, loss_end. Rows of a conversation come to one task in order
    and are digested as they pass: none is held, however long the conversation is. A null conv_id is a conversation.
    """

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        state: list | None = None

        def close() -> None:
            if state:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        for part in parts:
            for conv, text, a, b in zip(*(part[c].to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
                if state is None or state[0] != conv:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if text is None:
                    continue
                state[5] += len(text)
                for role, body in read_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                if a is not None:
                    loss = unescape(text[a:b])
                    state[3] += len(loss)
                    state[4].update(loss.encode("utf-8", "surrogatepass"))
            if len(done) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _READ)], schema=_READ)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _READ)], schema=_READ)

    rows = turns.select("conv_id", "place", "formatted", "loss_start", "loss_end")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place", "formatted").mapInArrow(
        apply, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def message_records(messages: DataFrame) -> DataFrame:
    """JSON records (conv_id, place, record) from rows conv_id, turn, role, text; fields that are null are left out."""
    return messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("place"),
        F.to_json(F.struct(F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))).alias("record"),
    )
