r"""Chat formatting in budgeted windows.

A conversation's turns are packed into windows by the running sum of their tokens: a window closes before
the turn that would take it past the budget, so windows are turn-aligned and no turn is cut. Each window
opens with the system turn, if the conversation begins with one, then repeats the last turns of the window
before, up to ``history`` tokens and as far as they leave room for the first new turn, then adds its new
turns. System turn, history and new turns together hold the budget (tokens of the texts); only a turn that
does not fit beside the system turn passes it, as the one new turn of a window without history. Only new
assistant turns are under the loss mask: what is repeated was a target before and is masked now, so each
assistant turn is a target exactly once.

Template: `<turn role>`, line feed, text, `</turn>`, line feed. A text's own `<turn` and `</turn` get a
backslash after the `<` (and those that have some get one more), which :func:`unescape` undoes. Roles are
percent-encoded.

Turns arrive sorted by (conversation, turn) within a partition and are formatted as a stream: a task holds
one window, the system turn and the history, however long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import col

_CONTROL = re.compile(r"<(\\*/?turn)")
_ESCAPED = re.compile(r"<\\(\\*/?turn)")
_TURN = re.compile(r"<turn ([^>]*)>\n(.*?)</turn>\n", re.S)
_PIECE = re.compile(r"\w+|[^\w\s]")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of the text in it)."""
    head = f"<turn {quote(role, safe='')}>\n"
    body = escape(text)
    return head + body + "</turn>\n", len(head), len(head) + len(body)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    return [(unquote(m.group(1)), unescape(m.group(2))) for m in _TURN.finditer(formatted)]


def token_counter(tokenizer_path: str | None):
    """Counts tokens with a tokenizer file if a path is given, else words and punctuation marks."""
    if not tokenizer_path:
        return lambda text: sum(1 for _ in _PIECE.finditer(text))
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    return lambda text: len(tok.encode(text, add_special_tokens=False).ids)


_WINDOWS = ("conv_id {id}, window long, formatted string, loss array<struct<start:long,end:long>>, repeated long, "
            "n_tokens long")


class _Writer:
    """Windows of one conversation, turn by turn."""

    def __init__(self, conv, budget: int, history: int, count):
        self.conv, self.count = conv, count
        self.history, self.budget = history, budget
        self.system, self.tail, self.new = None, [], []
        self.window = self.used = self.seen = 0

    def add(self, role: str, text: str):
        """Takes a turn; returns the window that it closes, if any."""
        n = self.count(text)
        out = None
        if self.new and self.used + n > self.budget:
            out = self.close()
        if not self.new:
            self.used = sum(t[2] for t in self.lead())
            while self.tail and self.used + n > self.budget:
                self.used -= self.tail.pop(0)[2]
        self.new.append((role, text, n))
        self.used += n
        if self.seen == 0 and role == "system":
            self.system = self.new[0]
        self.seen += 1
        return out

    def lead(self) -> list:
        """Turns that the window repeats before its new ones."""
        return ([] if self.window == 0 or self.system is None else [self.system]) + self.tail

    def close(self):
        first = self.window == 0
        lead = self.lead()
        parts, loss, at = [], [], 0
        for k, (role, text, _) in enumerate(lead + self.new):
            s, a, b = format_turn(role, text)
            if k >= len(lead) and role == "assistant":
                loss.append({"start": at + a, "end": at + b})
            parts.append(s)
            at += len(s)
        row = {"conv_id": self.conv, "window": self.window, "formatted": "".join(parts), "loss": loss, "repeated": len(lead),
               "n_tokens": sum(t[2] for t in lead + self.new)}
        # History for the next window: the last turns that fit, the system turn aside.
        past = self.tail + [t for k, t in enumerate(self.new) if not (first and k == 0 and self.system is not None)]
        keep, used = [], 0
        for t in reversed(past):
            if used + t[2] > self.history:
                break
            keep.append(t)
            used += t[2]
        self.tail, self.new = keep[::-1], []
        self.window += 1
        return row


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", budget: int = 512, history: int = 128, tokenizer_path: str | None = None) -> DataFrame:
    """(conv_id, window, formatted, loss, repeated, n_tokens): ``loss`` holds the spans of the target texts
    in ``formatted`` (code points, end exclusive), ``repeated`` how many of its leading turns are repeats.

    Null text or role counts as empty; null conversation ids form one conversation; turns with equal
    numbers (repeated rows too) are taken in the order of role and text, nulls first, and each is a turn;
    null turn numbers come first. An empty table gives no windows.
    """
    id_type = turns.schema[conv_col].dataType
    schema = _WINDOWS.format(id=id_type.simpleString())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    src = turns.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), col(role_col).alias("role"),
                       col(text_col).alias("text"))
    # All turns of a conversation stream through one task in order: a running digest of the whole
    # conversation cannot be split. Memory does not grow with the conversation.
    src = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")

    def run(batches):
        count = token_counter(tokenizer_path)
        writer, ids = None, None
        rows: list = []
        size = 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r["conv_id"] for r in rows], ids), pa.array([r["window"] for r in rows], pa.int64()),
                 pa.array([r["formatted"] for r in rows], pa.string()), pa.array([r["loss"] for r in rows], kind),
                 pa.array([r["repeated"] for r in rows], pa.int64()), pa.array([r["n_tokens"] for r in rows], pa.int64())],
                names=["conv_id", "window", "formatted", "loss", "repeated", "n_tokens"])

        for batch in batches:
            ids = batch.schema.field(0).type
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if writer is None or writer.conv != conv:
                    if writer:
                        rows.append(writer.close())
                    writer = _Writer(conv, budget, history, count)
                row = writer.add(role or "", text or "")
                if row:
                    rows.append(row)
                    size += len(row["formatted"])
                if size > 1 << 22:
                    yield batch_of(rows)
                    rows, size = [], 0
        if writer:
            rows.append(writer.close())
        if rows:
            yield batch_of(rows)

    return src.mapInArrow(run, schema)


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) parsed from windows."""
    schema = (f"conv_id {windows.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, "
              "loss_chars long, loss_sha256 string, formatted_chars long")
    src = (windows.select("conv_id", "window", "formatted", "loss", "repeated").repartition("conv_id")
           .sortWithinPartitions("conv_id", "window").drop("window"))

    def run(batches):
        state, ids, rows = None, None, []

        def finish():
            rows.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def batch_of():
            kinds = [ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                              names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            ids = batch.schema.field(0).type
            for conv, text, loss, repeated in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or state[0] != conv:
                    if state:
                        finish()
                    if len(rows) >= 4096:
                        yield batch_of()
                        rows.clear()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse_turns(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    body = unescape(text[span["start"]:span["end"]])
                    state[3] += len(body)
                    state[4].update(body.encode())
                state[5] += len(text)
        if state:
            finish()
        if rows:
            yield batch_of()

    return src.mapInArrow(run, schema)
