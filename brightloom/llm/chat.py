r"""Conversations as training text that provably reads back as it was.

Grammar of the text, one turn after the other::

    turn := '<turn role="' NAME '" esc="' LEVEL '">' BODY '</turn>' NEWLINE

At level 0 the body is the text as it is. The turn is parsed again; if that fails, or the
recovered role and text differ from the source, the next level is tried, until they are
identical. Level 1 writes ``<`` as ``\l`` and a backslash as two; NAME is always written that
way, with ``"`` as ``\q``. The parser is deterministic: a body ends at the first end mark, at
level 0 it must not hold ``<turn`` or ``</turn``, at level 1 no ``<`` at all. So no text can
bring a mark of its own into the formatted text, forged turns included.

``render`` gives one row per turn, so a conversation of any length is spread over tasks, and
marks the turns under the loss (those of the assistant). ``read_back`` streams the rendered
turns in order through the parser and folds each conversation into digests; its memory does
not depend on the conversation's length.

Nulls and odd input: a null text or role counts as empty; null conv_id is a conversation,
null turns come first; rows of equal turn follow their rendered text. Repeated rows are
turns of their own. An empty table gives no conversation. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
#: Turns under the loss mask.
LEARNED = "assistant"

#: What the grammar writes; no body at level 0 may hold one.
MARKS = ("<turn", "</turn")

_HEAD = re.compile(r'<turn role="([^"<]*+)" esc="([01])">')
_ESCAPES = {"\\": "\\\\", "<": "\\l", '"': "\\q"}
_PLAIN = {v[1]: k for k, v in _ESCAPES.items()}


def _escape(text: str, marks: str) -> str:
    return re.sub(f"[{marks}\\\\]", lambda m: _ESCAPES[m[0]], text)


def _unescape(text: str) -> str:
    """Raises ValueError on what no escape writes."""
    try:
        return re.sub(r"\\(.?)", lambda m: _PLAIN[m[1]], text, flags=re.S)
    except KeyError:
        raise ValueError("an unknown escape") from None


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int, tuple[int, int]]:
    """Role, text, where the next turn begins, and the body's span. Raises ValueError on what
    the grammar does not derive."""
    head = _HEAD.match(text, at)
    if not head:
        raise ValueError(f"no turn at {at}")
    stop = text.find(END, head.end())
    if stop < 0:
        raise ValueError(f"turn at {at} does not end")
    body = text[head.end() : stop]
    if any(mark in body for mark in (MARKS if head[2] == "0" else ("<",))):
        raise ValueError(f"a mark inside the turn at {at}")
    return _unescape(head[1]), body if head[2] == "0" else _unescape(body), stop + len(END), (head.end(), stop)


def render_turn(role: str, text: str) -> tuple[str, int]:
    """The turn's text and the level of escapes it needed."""
    for level, body in enumerate((text, _escape(text, "<"))):
        out = f'<turn role="{_escape(role, '<"')}" esc="{level}">{body}{END}'
        try:
            if parse_turn(out)[:3] == (role, text, len(out)):
                return out, level
        except ValueError:
            pass
    raise ValueError("the grammar does not round-trip")  # cannot happen: level 1 holds no <


def parse(text: str) -> list[tuple[str, str]]:
    """All turns of a conversation's text."""
    turns, at = [], 0
    while at < len(text):
        role, body, at, _ = parse_turn(text, at)
        turns.append((role, body))
    return turns


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, formatted, escapes (the level), and the body's span if it is learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, levels, starts, stops = [], [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                out, level = render_turn(role or "", text or "")
                span = parse_turn(out)[3] if role == LEARNED else (None, None)
                texts.append(out)
                levels.append(level)
                starts.append(span[0])
                stops.append(span[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array(texts, pa.string()), pa.array(levels, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(stops, pa.int64()),
                ],
                names=["conv_id", "turn", "formatted", "escapes", "loss_start", "loss_stop"],
            )

    slim = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return slim.mapInArrow(run, "conv_id long, turn long, formatted string, escapes int, loss_start long, loss_stop long")


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.n, self.loss, self.length = conv_id, 0, 0, 0
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, start: int | None, stop: int | None) -> None:
        role, body, at, _ = parse_turn(text)
        if at != len(text):
            raise ValueError("more than one turn")
        self.n += 1
        self.length += len(text)
        self.turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            masked = text[start:stop]
            learned = _unescape(masked) if text[start - 4] == '"' and text[start - 3] == "1" else masked
            self.loss += len(learned)
            self.learned.update(learned.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.learned.hexdigest(), self.length


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, all from the rendered text."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows(done: list[_Digest]) -> pa.RecordBatch:
        columns = list(zip(*(d.row() for d in done)))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for batch in batches:  # conversations follow one another; only the current one is open
            done = []
            for conv, text, start, stop in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_stop"))):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now)
                    now = _Digest(conv)
                now.add(text, start, stop)
            if done:
                yield rows(done)
        if now is not None:
            yield rows([now])

    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
