"""Chat formatting: records of many layouts to canonical turns, and turns to one template that can be read back.

A record's layout is known by its nested field paths; their fingerprint selects a declarative mapping whose required
paths are all there: where the turns are, and which fields hold role and text. Formatting is per turn, so a conversation of any length is
formatted by as many tasks as hold its turns; reading back goes through each conversation in order, one turn at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted

# The template's own marks, and others' that a model may know; none appears in a formatted text unless the template
# puts it there.
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
CONTROLS = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = "assistant"
# The first character of each control string, also of one that begins within another.
_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """How a layout gives turns. ``at``: the path of a list of turns, with the fields of role and text; or ``role`` and
    ``text`` of a record that is one turn. ``parts``: ``(role, path)`` of single texts, before the list if there is one.
    ``roles`` renames roles. ``optional`` paths may be missing or null and give no turn then."""

    at: str = ""
    role: str = ""
    text: str = ""
    parts: Sequence[tuple[str, str]] = ()
    roles: dict[str, str] = field(default_factory=dict)
    optional: frozenset[str] = frozenset()

    def paths(self) -> frozenset[str]:
        of_turn = {f"{self.at}[].{f}" if self.at else f for f in (self.role, self.text) if f}
        return frozenset(path for _, path in self.parts) | of_turn


_SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
_SYSTEM, _MAY_HAVE = (("system", "system"),), frozenset(["system"])
MAPPINGS: dict[str, Mapping] = {
    "turn": Mapping(role="role", text="text"),
    "messages": Mapping("messages", "role", "content", _SYSTEM, _SHARED, _MAY_HAVE),
    "conversations": Mapping("conversations", "from", "value", _SYSTEM, _SHARED, _MAY_HAVE),
    "instruction": Mapping(parts=(*_SYSTEM, ("user", "instruction"), ("assistant", "output")), optional=_MAY_HAVE),
    "instruction_input": Mapping(
        parts=(*_SYSTEM, ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=_MAY_HAVE
    ),
    "prompt_completion": Mapping(parts=(*_SYSTEM, ("user", "prompt"), ("assistant", "completion")), optional=_MAY_HAVE),
    "prompt_response": Mapping(parts=(("user", "prompt"), ("assistant", "response"))),
    "system_prompt_response": Mapping(parts=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    "question_answer": Mapping(parts=(*_SYSTEM, ("user", "question"), ("assistant", "answer")), optional=_MAY_HAVE),
    "dialog": Mapping("dialog.turns", "speaker", "utterance", _SYSTEM, _SHARED, _MAY_HAVE),
}


def field_paths(value: object, path: str = "") -> set[str]:
    """Paths of a record's leaves: fields joined by dots, a list's items by ``[]``; an empty list is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(field_paths(v, f"{path}.{k}" if path else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{path}[]"} if not value else set(), *(field_paths(v, f"{path}[]") for v in value))
    return {path}


def fingerprint(paths: Sequence[str] | frozenset[str] | set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Registry:
    """Mappings in the order in which they are tried: lists of turns, then single texts, then records that are one turn;
    of each kind, those with more required paths first. What a fingerprint selects is kept for the next record."""

    KEPT = 4096

    def __init__(self, mappings: dict[str, Mapping]) -> None:
        def rank(named: tuple[str, Mapping]) -> tuple[int, int]:
            m = named[1]
            return 0 if m.at else 1 if m.parts else 2, -len(m.paths() - m.optional)

        self.ordered = [(name, m, m.paths() - m.optional) for name, m in sorted(mappings.items(), key=rank)]
        self.by_print: dict[str, tuple[str | None, Mapping | None]] = {}

    def mapping(self, record: object) -> tuple[str | None, Mapping | None]:
        """The first mapping whose required paths are all in the record; other fields do not matter. A list without
        turns counts if no mapping has all of its paths."""
        paths = field_paths(record)
        found = self.by_print.get(key := fingerprint(paths))
        if found is None:
            if len(self.by_print) >= self.KEPT:
                self.by_print.clear()
            found = self.by_print[key] = self._select(paths)
        return found

    def _select(self, paths: set[str]) -> tuple[str | None, Mapping | None]:
        # A field may hold a list or an object: its own path is the beginning of its leaves' paths then.
        there = paths | {path[:k] for path in paths for k, c in enumerate(path) if c in ".["}
        for name, m, required in self.ordered:
            if required <= there:
                return name, m
        return next(((name, m) for name, m, _ in self.ordered if m.at and f"{m.at}[]" in paths), (None, None))


def _at(record: object, path: str) -> object:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value: object) -> str:
    """A text as it is, a list of texts or of text blocks as one text, anything else as JSON."""
    if isinstance(value, list) and value:
        blocks = [v.get("text") if isinstance(v, dict) and v.get("type", "text") == "text" else v for v in value]
        if all(isinstance(v, str) for v in blocks):
            return "".join(blocks)
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns(record: object, mapping: Mapping) -> list[tuple[str, str]]:
    """A record's canonical turns: role and text; a null is empty."""
    parts = [(role, path, _at(record, path)) for role, path in mapping.parts]
    raw = [(role, _text(value)) for role, path, value in parts if value is not None or path not in mapping.optional]
    if mapping.role:
        listed = (_at(record, mapping.at) or []) if mapping.at else [record]
        raw += [(_text(_at(t, mapping.role)), _text(_at(t, mapping.text))) for t in listed]
    return [(mapping.roles.get(role, role), text) for role, text in raw]


def escape(text: str) -> str:
    """Text in which no control string is left: a backslash is doubled, and one goes behind a control string's first
    character."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text is: start and length in code points."""
    head = START + escape(role).replace("\n", "\\\x1f") + MIDDLE  # a role is one line
    body = escape(text)
    return head + body + END, len(head), len(body)


def read_turn(turn: str) -> tuple[str, str]:
    role, _, rest = turn[len(START) :].partition(MIDDLE)
    role = _ESCAPED.sub(lambda m: "\n" if m[1] == "\x1f" else m[1], role)
    return role, unescape(rest[: len(rest) - len(END)])


def canonical_turns(records: DataFrame, id_col: str, order_col: str, json_col: str) -> DataFrame:
    """``conv_id, seq, part, layout, role, text, reason``: the turns of JSON records of any registered layout. ``seq`` is the
    record's place in its conversation and ``part`` the turn's in the record. A record of no known layout, and null or
    broken JSON, gives one row with null layout, role and text and with the reason, so nothing is lost unseen.
    """
    narrow = records.select(
        F.col(quoted(id_col)).alias("conv_id"), F.col(quoted(order_col)).alias("seq"), F.col(quoted(json_col)).alias("record")
    )
    types = {c: narrow.schema[c].dataType.simpleString() for c in ("conv_id", "seq")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registry = Registry(MAPPINGS)
        for batch in batches:
            rows, out = [], []
            for row, record in enumerate(batch.column(2).to_pylist()):
                value, reason = None, "null record" if record is None else None
                try:
                    value = json.loads(record) if record is not None else None
                except ValueError:
                    reason = "broken JSON"
                name, mapping = registry.mapping(value)
                found = [(None, None)] if mapping is None else turns(value, mapping)
                if mapping is None:
                    reason = reason or "no known layout"
                for part, (role, text) in enumerate(found):
                    rows.append(row)
                    out.append((part, name, role, text, reason))
            kinds = [pa.int32(), *[pa.string()] * 4]
            columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            ids = batch.select([0, 1]).take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays([*ids.columns, *columns], ["conv_id", "seq", "part", "layout", "role", "text", "reason"])

    schema = f"conv_id {types['conv_id']}, seq {types['seq']}, part int, layout string, role string, text string, reason string"
    return narrow.mapInArrow(run, schema)


def format_turns(found: DataFrame) -> DataFrame:
    """``conv_id, seq, part, formatted, loss_start, loss_chars, reason``: each canonical turn in the template, and the span
    under the loss mask, which is a learned role's text; ``loss_start`` is null for other turns. A conversation is
    its turns' texts one after the other by ``seq`` and ``part``. A row without a layout keeps its reason and has a null
    text.
    """
    known = found.select("conv_id", "seq", "part", "layout", "role", "text", "reason")
    types = {c: known.schema[c].dataType.simpleString() for c in ("conv_id", "seq")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for layout, role, text in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5))):
                if layout is None:
                    out.append((None, None, 0))
                    continue
                formatted, start, length = formatted_turn(role or "", text or "")
                out.append((formatted, start if role == LEARNED else None, length if role == LEARNED else 0))
            kinds = [pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            names = ["conv_id", "seq", "part", "formatted", "loss_start", "loss_chars", "reason"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns, batch.column(6)], names)

    schema = f"conv_id {types['conv_id']}, seq {types['seq']}, part int, formatted string, loss_start long, loss_chars long, reason string"
    return known.mapInArrow(run, schema)


_DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, read from the formatted turns: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``. Conversations are dealt by id and sorted by turn; a task holds one turn and running digests, so
    a conversation of any length takes no memory. Turns equal in place are ordered by their text. A record of no known layout
    is no turn, but its conversation has a row.
    """
    ordered = (
        formatted.select("conv_id", "seq", "part", "formatted", "loss_start", "loss_chars")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "part", "formatted")
        .select("conv_id", "formatted", "loss_start", "loss_chars")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, kind = None, None, None

        def result(conversations: list) -> pa.RecordBatch:
            rows = [(c, n, t.hexdigest(), lc, ls.hexdigest(), chars) for c, (n, t, lc, ls, chars) in conversations]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", *[f.split()[0] for f in _DIGEST.split(", ")]]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            for conv_id, turn, start, length in zip(*(column.to_pylist() for column in batch.columns)):
                if state is None or conv_id != now:
                    if state is not None:
                        done.append((now, state))
                    now, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if turn is None:  # a record of no known layout
                    continue
                role, text = read_turn(turn)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[4] += len(turn)
                if start is not None:
                    learned = unescape(turn[start : start + length])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
            if done:
                yield result(done)
        if state is not None:
            yield result([(now, state)])

    return ordered.mapInArrow(run, f"conv_id {ordered.schema['conv_id'].dataType.simpleString()}, {_DIGEST}")
