"""Chat formatting by event-sourced reconstruction.

Logs are events (conversation, sequence number, message, kind, role, text). Events are folded per message, so that no
task ever holds a conversation; messages are then sorted by conversation and place, and rendered as they stream by.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The marks of the template, the escape character, and the kinds of events.
TURN_OPEN, TURN_CLOSE, ESCAPE = "<|turn:", "<|end|>", "\\"
KINDS = ("message", "delta", "edit", "regenerate", "delete")
#: Control strings of common templates; one in a text is escaped, so that it can't be read as a mark.
CONTROL = ("<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")
_CONTROL = re.compile(rf"{re.escape(ESCAPE)}|(?=(?:{'|'.join(re.escape(c) for c in CONTROL)})).", re.S)
_ROLE = re.compile(r"[\\|<\[]")
_UNESCAPE = re.compile(re.escape(ESCAPE) + "(.)", re.S)
_TURN = re.compile(re.escape(TURN_OPEN) + r"((?:[^\\|]|\\.)*)\|>\n(.*?)" + re.escape(TURN_CLOSE) + "\n", re.S)


def escape(text: str) -> str:
    """Every control string gets an escape character after its first character, every escape character is doubled."""
    return _CONTROL.sub(lambda m: m[0] + ESCAPE, text)


def unescape(text: str) -> str:
    """Inverse of ``escape``."""
    return _UNESCAPE.sub(lambda m: m[1], text)


def render_turn(role: str, text: str) -> str:
    role = _ROLE.sub(lambda m: ESCAPE + m[0], role)
    return f"{TURN_OPEN}{role}|>\n{escape(text)}{TURN_CLOSE}\n"


def parse_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """role, text and the span of the (escaped) text of each turn of a rendered conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2]), *m.span(2)))
        at = m.end()
    return out


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, place, role, text, one for each message that isn't deleted.

    ``events``: conv_id, seq, message_id, kind, role, text. A message starts with its text; ``delta`` appends, ``edit``
    replaces, ``regenerate`` clears (its text, if any, starts the new one), ``delete`` removes it unless a later event
    writes it again. ``place`` is the message's first seq, role the first that isn't null. Events of the same seq are
    taken in the order of kind, text and role. Null text: empty. Null kind: message. Null role: empty. Null conv_id and null
    message_id are values like others. Other columns are ignored; no events, no messages. A task holds the text of one message.
    """
    def fold(batches):
        held: dict | None = None  # the message at hand: its text so far, not its events

        def closed(rows):
            if held is not None and held["kind"] != "delete":
                rows.append((*held["key"], held["place"], held["role"] or "", "".join(held["text"])))

        for b in batches:
            rows: list[tuple] = []
            for conv, message, seq, kind, text, role in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
                if held is None or held["key"] != (conv, message):
                    closed(rows)
                    held = {"key": (conv, message), "place": seq, "role": None, "text": [], "kind": ""}
                if kind != "delta":
                    held["text"] = []
                if kind != "delete" and text:
                    held["text"].append(text)
                held["kind"] = kind
                held["role"] = role if held["role"] is None else held["role"]
            yield batch(rows, b.schema)
        rows = []
        closed(rows)
        if rows:
            yield batch(rows, b.schema)

    def batch(rows, schema):
        cols = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (schema.field("conv_id").type, schema.field("message_id").type, schema.field("seq").type, pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=["conv_id", "message_id", "place", "role", "text"])

    kinds = dict(events.dtypes)
    rows = events.select("conv_id", "message_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"), "role")
    rows = rows.repartition("conv_id", "message_id").sortWithinPartitions("conv_id", "message_id", "seq", "kind", "text", "role")
    out = rows.mapInArrow(fold, f"conv_id {kinds['conv_id']}, message_id {kinds['message_id']}, place {kinds['seq']}, role string, text string")
    return out.select("conv_id", "message_id", "place", "role", "text")


def render(messages: DataFrame) -> DataFrame:
    """Rendered turns: conv_id, place, message_id, role and ``formatted``; a conversation is its turns by place and message_id, joined."""

    def turns(batches):
        for b in batches:
            roles, texts = b.column("role").to_pylist(), b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("place"), b.column("message_id"), pa.array([render_turn(r or "", t or "") for r, t in zip(roles, texts, strict=True)], pa.string())], names=["conv_id", "place", "message_id", "formatted"])

    kinds = dict(messages.dtypes)
    return messages.select("conv_id", "place", "message_id", "role", "text").mapInArrow(turns, f"conv_id {kinds['conv_id']}, place {kinds['place']}, message_id {kinds['message_id']}, formatted string")


class _Digest:
    def __init__(self):
        self.turns, self.loss, self.n, self.loss_n, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, formatted: str) -> None:
        self.chars += len(formatted)
        for role, text, _, _ in parse_turns(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_n += len(text)
                self.loss.update(text.encode())


def digests(rendered: DataFrame) -> DataFrame:
    """What is read back from the rendered conversations, whose ids are whole numbers, a row each: counts and digests of turns and of the loss mask.

    The turns of a conversation stream by in order; a task holds one batch of them and the running digests, however long
    the conversation is. The digest of one conversation is sequential by its nature.
    """

    def read(batches):
        conv, d, done = None, None, []

        def out():
            rows = [(c, x.n, x.turns.hexdigest(), x.loss_n, x.loss.hexdigest(), x.chars) for c, x in done]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for b in batches:
            for c, f in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist(), strict=True):
                if d is None or c != conv:
                    if d is not None:
                        done.append((conv, d))
                    conv, d = c, _Digest()
                d.add(f)
            if done:
                yield out()
        if d is not None:
            done.append((conv, d))
            yield out()

    ordered = rendered.select(F.col("conv_id").cast("long"), "place", "message_id", "formatted").repartition("conv_id").sortWithinPartitions("conv_id", "place", "message_id")
    return ordered.select("conv_id", "formatted").mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def turn_events(conversations: DataFrame) -> DataFrame:
    """The rows of a turn table as events, each a message of its own. Repeated turns stay apart, in the order of role and text.

    Null conv_id is a conversation of its own; null turn comes first, null role and text are empty.
    """
    from pyspark.sql import Window

    rows = conversations.select("conv_id", F.col("turn").alias("seq"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    k = F.row_number().over(Window.partitionBy("conv_id", "seq").orderBy("role", "text"))
    return rows.withColumn("_k", k).select("conv_id", "seq", F.struct("seq", "_k").alias("message_id"), F.lit("message").alias("kind"), "role", "text")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Rendered turns of a table of turns (conv_id, turn, role, text). Other columns are ignored; no rows, no turns."""
    return render(fold_events(turn_events(conversations)))
