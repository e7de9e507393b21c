r"""Conversations as training text in budgeted windows.

A turn is written `### role: text</turn>` and a line end. In texts, `###`, `</turn>` and the backslash get a backslash
before them; in roles `:` as well. So the template's own strings stand for themselves only outside texts, and
`read_window` gives the turns back exactly.

Prefix sums of turn sizes choose the windows: each takes as many whole turns as fit the budget. A later window starts with
the system turn and the last turns before it that fit a smaller budget; what is repeated is not a target again.
Rows come to a task sorted by conversation and are formatted as they stream by, so a conversation of any length needs
the memory of one window.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY = 512, 128
TARGET, SYSTEM = "assistant", "system"
_ESCAPED = re.compile(r"\\|###|</turn>")
_ESCAPED_ROLE = re.compile(r"\\|###|</turn>|:")
_PLAIN = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"\1", text)


def turn_size(role: str, text: str) -> int:
    """Tokens a turn is reckoned at: a quarter of its bytes, and four for its marks."""
    return (len(text.encode()) + len(role.encode()) + 3) // 4 + 4


class Windows:
    """One conversation, turn by turn; `add` and `end` give the windows that are done."""

    def __init__(self, budget: int, history: int) -> None:
        self.budget, self.history = budget, history
        self.turns: list[tuple[str, str]] = []  # of this window, and before them its history
        self.prefix = [0]  # sums of the sizes of self.turns
        self.repeated, self.system, self.number, self.started = 0, None, 0, False

    def add(self, role: str, text: str) -> list[dict]:
        size, done = turn_size(role, text), []
        if len(self.turns) > self.repeated and self.prefix[-1] + self._system_size() + size > self.budget:
            done = [self._window()]
            self._restart(size)
        if not self.started and role == SYSTEM and size <= self.budget // 2:
            self.system = (role, text, size)
        self.started = True
        self.turns.append((role, text))
        self.prefix.append(self.prefix[-1] + size)
        return done

    def end(self) -> list[dict]:
        return [self._window()] if self.turns else []

    def _system_size(self) -> int:
        return self.system[2] if self.system and self.number else 0

    def _restart(self, size: int) -> None:
        """Keeps the longest run of last turns that fits the history and leaves room for the next turn."""
        self.number += 1
        room = min(self.history, self.budget - size - self._system_size())
        keep = len(self.turns)
        least = 1 if self.number == 1 and self.system else 0  # the first window's system turn is repeated anyway
        while keep > least and self.prefix[-1] - self.prefix[keep - 1] <= room:
            keep -= 1
        base = self.prefix[keep]
        self.turns, self.prefix = self.turns[keep:], [p - base for p in self.prefix[keep:]]
        self.repeated = len(self.turns)

    def _window(self) -> dict:
        parts, starts, ends, at = [], [], [], 0
        turns, repeated = self.turns, self.repeated
        if self.system and self.number:
            turns, repeated = [self.system[:2], *turns], repeated + 1
        for i, (role, text) in enumerate(turns):
            head, body = f"### {_ESCAPED_ROLE.sub(r'\\\g<0>', role)}: ", escape(text)
            if role == TARGET and i >= repeated:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            parts.append(f"{head}{body}</turn>\n")
            at += len(parts[-1])
        size = self.prefix[-1] + self._system_size()
        return {"window": self.number, "text": "".join(parts), "n_repeated": repeated, "n_turns": len(turns), "size": size, "loss_starts": starts, "loss_ends": ends}


def read_window(text: str, repeated: int, starts: list[int], ends: list[int]) -> tuple[list[tuple[str, str]], list[str]]:
    """The window's own turns and its targets, read from the formatted text."""
    turns = [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]
    return turns[repeated:], [unescape(text[a:b]) for a, b in zip(starts, ends)]


_FIELDS = {
    "window": pa.int64(), "text": pa.string(), "n_repeated": pa.int64(), "n_turns": pa.int64(), "size": pa.int64(),
    "loss_starts": pa.list_(pa.int64()), "loss_ends": pa.list_(pa.int64()),
}
_SCHEMA = "window long, text string, n_repeated long, n_turns long, size long, loss_starts array<long>, loss_ends array<long>"
_NOTHING = object()


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """`conversations(conv_id, turn, role, text, ...)` -> the windows: conv_id, window (from 0), text, n_repeated (turns at the
    start that earlier windows hold), n_turns, size, and the character spans loss_starts, loss_ends of the targets.

    Turns are ordered by turn (null first), role and text, so ties have one order. Null texts and roles count as empty; rows of a null conv_id
    are one conversation. Repeated rows are turns of their own. A turn above the budget is a window by itself, whole,
    with no history but the system turn. A system turn is repeated if it comes first and takes up half the budget at most. Extra columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    id_type = conversations.schema["conv_id"].dataType.simpleString()

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, kind = _NOTHING, None, pa.null()
        for batch in batches:
            ids, out, kind = [], [], batch.column("conv_id").type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != now or state is None:
                    done = state.end() if state else []
                    ids += [now] * len(done)
                    out += done
                    now, state = conv, Windows(budget, history)
                done = state.add(role, text)
                ids += [conv] * len(done)
                out += done
            yield _batch(ids, out, kind)
        if state:
            done = state.end()
            yield _batch([now] * len(done), done, kind)

    return rows.mapInArrow(formatted, f"conv_id {id_type}, {_SCHEMA}")


def _batch(ids: list, rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array([r[name] for r in rows], of) for name, of in _FIELDS.items()]
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns], ["conv_id", *_FIELDS])


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def add(self, text: str, repeated: int, starts: list[int], ends: list[int]) -> None:
        turns, targets = read_window(text, repeated, starts, ends)
        for role, own in turns:
            self.turns.update(f"{role}\n{own}\n".encode())
        for target in targets:
            self.loss.update(target.encode())
        self.n_turns += len(turns)
        self.loss_chars += sum(map(len, targets))
        self.formatted += len(text)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted


def digests(formatted: DataFrame) -> DataFrame:
    """Windows as `windows` gives them -> per conversation, read back from the formatted text: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. The windows of a conversation come together and in order, as they were made."""
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in done], t) for i, t in enumerate([kind, *types])]
        return pa.RecordBatch.from_arrays(columns, names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, kind = _NOTHING, None, pa.null()
        for batch in batches:
            done, kind = [], batch.column("conv_id").type
            for conv, *window in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "n_repeated", "loss_starts", "loss_ends"))):
                if conv != now or state is None:
                    done += [(now, *state.row())] if state else []
                    now, state = conv, _Digest()
                state.add(*window)
            yield rows(done, kind)
        if state:
            yield rows([(now, *state.row())], kind)

    return formatted.mapInArrow(read, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
