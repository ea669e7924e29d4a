"""Chat formatting: a finite-state machine over roles and a declarative
template that yields text segments with a loss flag each.

The template names the marks; control strings inside texts and roles are
escaped with a backslash, which the reader undoes exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# role -> shown label and whether its text counts in the loss; any other role
# is shown after ``unknown`` as it is written. ``next`` lists what may follow.
TEMPLATE = {
    "open": "### ", "after_role": ": ", "close": " </turn>\n", "unknown": "?",
    "escape": "\\", "controls": ["###", "</turn>", ": "],
    "roles": {"system": {"label": "System", "loss": False},
              "user": {"label": "User", "loss": False},
              "assistant": {"label": "Assistant", "loss": True}},
    "next": {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
    "accept": ["assistant"],
}

SEGMENTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn_no", T.LongType()),
    T.StructField("seg_no", T.IntegerType()), T.StructField("segment", T.StringType()),
    T.StructField("loss", T.BooleanType()), T.StructField("order_ok", T.BooleanType())])

READ_BACK = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    T.StructField("valid", T.BooleanType())])


class Codec:
    """Escaping, role labels and turn parsing of one template."""

    def __init__(self, template: dict) -> None:
        self.t = template
        esc = template["escape"]
        marks = "|".join(re.escape(c) for c in [esc, *template["controls"]])
        self._esc = re.compile(f"({marks})")
        self._unesc = re.compile(re.escape(esc) + f"({marks})")
        self._e = esc
        self.label = {r: x["label"] for r, x in template["roles"].items()}
        self.role = {v: k for k, v in self.label.items()}

    def escape(self, s: str) -> str:
        return self._esc.sub(lambda m: self._e + m[0], s)

    def unescape(self, s: str) -> str:
        return self._unesc.sub(lambda m: m[1], s)

    def head(self, role: str | None) -> str:
        name = self.label.get(role) or self.t["unknown"] + self.escape(role or "")
        return self.t["open"] + name + self.t["after_role"]

    def trains(self, role: str | None) -> bool:
        return bool(self.t["roles"].get(role, {}).get("loss"))

    def follows(self, state: str | None, role: str | None) -> bool:
        return state is not None and role in self.t["next"].get(state, ())

    def parse_turn(self, s: str) -> tuple[str, str]:
        """(role, text) of one formatted turn; the first unescaped role mark
        ends the role."""
        t = self.t
        if not (s.startswith(t["open"]) and s.endswith(t["close"])):
            raise ValueError("not a formatted turn")
        body = s[len(t["open"]):len(s) - len(t["close"])]
        i = 0
        while not body.startswith(t["after_role"], i):
            if i >= len(body):
                raise ValueError("no role mark")
            m = self._unesc.match(body, i)
            i = m.end() if m else i + 1
        name, text = body[:i], body[i + len(t["after_role"]):]
        role = self.role[name] if name in self.role else self.unescape(name[len(t["unknown"]):])
        return role, self.unescape(text)


def format_conversations(turns: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Segments (conv_id, turn_no, seg_no, segment, loss, order_ok) in order.

    ``turns(conv_id, turn, role, text)``; a conversation's rows go by turn,
    equal turns by role and text, null first. Null text is empty text, a null
    role an empty role, rows with a null conv_id form one conversation.
    ``order_ok`` is whether the machine allows this turn after the ones
    before it (false from the first violation on); turns out of order are
    formatted all the same. Other columns are ignored.

    One shuffle by conversation; rows stream through a sorted partition, so a
    conversation of any length needs the memory of one Arrow batch.
    """
    codec = Codec(template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, no, seen = None, "", 0, False
        for b in batches:
            rows = []
            for c, role, text in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(),
                                     b.column("text").to_pylist()):
                if not seen or c != conv:
                    conv, state, no, seen = c, "", 0, True
                state = role if codec.follows(state, role) else None
                ok = state is not None
                rows.append((c, no, 0, codec.head(role), False, ok))
                rows.append((c, no, 1, codec.escape(text or ""), codec.trains(role), ok))
                rows.append((c, no, 2, template["close"], False, ok))
                no += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), _SEG_TYPES)], names=SEGMENTS.names)

    d = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"),
                     F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
                     F.col("text").cast("string").alias("text"))
    d = d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return d.mapInArrow(run, SEGMENTS)


_SEG_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
_READ_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]


def read_back(segments: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Digests per conversation, parsed from the formatted segments, which
    must stand in the order :func:`format_conversations` gives them."""
    codec = Codec(template)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur = None
        for b in batches:
            done = []
            for c, no, seg, s, loss, ok in zip(*[b.column(x).to_pylist() for x in SEGMENTS.names]):
                if cur is None or c != cur["id"]:
                    if cur is not None:
                        done.append(finish(cur))
                    cur = {"id": c, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(),
                           "loss_chars": 0, "chars": 0, "turn": [], "ok": True, "last": ""}
                cur["turn"].append(s)
                cur["chars"] += len(s)
                cur["ok"] &= ok
                if loss:
                    own = codec.unescape(s)
                    cur["loss"].update(own.encode())
                    cur["loss_chars"] += len(own)
                if seg == 2:
                    role, text = codec.parse_turn("".join(cur["turn"]))
                    cur["turns"].update(f"{role}\n{text}\n".encode())
                    cur["turn"], cur["last"] = [], role
                    cur["n"] += 1
            if done:
                yield table(done)
        if cur is not None:
            yield table([finish(cur)])

    def finish(c: dict) -> tuple:
        return (c["id"], c["n"], c["turns"].hexdigest(), c["loss_chars"], c["loss"].hexdigest(),
                c["chars"], c["ok"] and c["last"] in template["accept"])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), _READ_TYPES)], names=READ_BACK.names)

    return segments.mapInArrow(run, READ_BACK)
