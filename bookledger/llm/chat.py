"""Chat formatting: conversations are rendered by a compiled template and can be read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookledger.llm.template import compile_template

#: Turns end at a control string of their own; roles other than these three are written out.
TEMPLATE = (
    "{% for turn in turns %}"
    "{% if turn.role == 'system' %}<<SYS>>{{ turn.text|escape }}<</SYS>>"
    "{% elif turn.role == 'user' %}<s>[INST] {{ turn.text|escape }} [/INST]"
    "{% elif turn.role == 'assistant' %}{% generation %}{{ turn.text|escape }}{% endgeneration %}</s>"
    "{% else %}<|{{ turn.role|escape }}|>{{ turn.text|escape }}<|end|>"
    "{% endif %}{% endfor %}"
)

#: All control strings begin with one of these characters, so a text without them holds none.
ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b", "|": "\\p"}
BACK = {v[1]: k for k, v in ESCAPES.items()}


def escape(text: Any) -> str:
    return re.sub(r"[\\<\[|]", lambda m: ESCAPES[m[0]], text or "")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: BACK[m[1]], text)


#: Start of a turn, its end, and its role (None: written between start and ``|>``).
MARKS = (("<<SYS>>", "<</SYS>>", "system"), ("<s>[INST] ", " [/INST]", "user"), ("<|", "<|end|>", None))
ANSWER_END = "</s>"


class TurnReader:
    """Reads ``TEMPLATE``'s output piece by piece and yields the complete turns so far."""

    def __init__(self) -> None:
        self.rest = ""

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        self.rest += text
        at = 0
        while at < len(self.rest):
            start, end, role = next((m for m in MARKS if self.rest.startswith(m[0], at)), ("", ANSWER_END, "assistant"))
            close = self.rest.find(end, at + len(start))
            if close < 0:
                break
            body = self.rest[at + len(start) : close]
            if role is None:
                role, _, body = body.partition("|>")
                role = unescape(role)
            yield role, unescape(body)
            at = close + len(end)
        self.rest = self.rest[at:]


Rows = Iterator[tuple]


def _rows(batches: Iterable[pa.RecordBatch]) -> Rows:
    for batch in batches:
        for i in range(0, batch.num_rows, 1000):
            part = batch.slice(i, 1000)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _written(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size from a stream of rows."""
    waiting, weight = [], 0
    for row in rows:
        waiting.append(row)
        weight += 50 + size(row)
        if weight > 1_000_000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in waiting], schema=schema)
            waiting, weight = [], 0
    if waiting:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in waiting], schema=schema)


PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("loss", pa.bool_())])


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``conv_id, part, text, loss``: the rendered conversations in pieces.

    A conversation's output is its texts in the order of ``part``; ``loss`` marks the pieces under the
    template's generation marker. The template sees ``turns``, each with ``role``, ``text`` and ``turn``, by
    turn; ties go by role, then text, and repeated rows are turns of their own. Null texts and
    roles count as empty; null turns come first; null conversation ids are one conversation. An
    empty table gives no rows; other columns are ignored.

    Turns are shuffled and sorted, then rendered as a stream: the longest conversation is never
    held as a whole, neither as rows nor as text.
    """
    compile_template(template, {"escape": escape})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, {"escape": escape})

        def pieces() -> Rows:
            for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
                stream = ({"turn": turn, "role": role or "", "text": text or ""} for _, turn, role, text in rows)
                for part, (text, loss) in enumerate(render({"turns": stream})):
                    yield conv_id, part, text, loss

        yield from _written(pieces(), PIECES, lambda r: len(r[2]))

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, "conv_id long, part long, text string, loss boolean")


READ = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ]
)


def read_back(pieces: DataFrame, ordered: bool = False) -> DataFrame:
    """What ``TEMPLATE``'s output holds, by conversation: turns, and the text under the loss mask.

    ordered: the pieces come straight from ``format_conversations``, which leaves each conversation
    in one partition and in order; stored pieces are shuffled and sorted first. Conversations
    without any output don't appear.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Rows:
            for conv_id, rows in groupby(_rows(batches), key=lambda r: r[0]):
                turns, answers = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
                reader = TurnReader()
                for _, _, text, loss in rows:
                    chars += len(text)
                    if loss:
                        plain = unescape(text)
                        loss_chars += len(plain)
                        answers.update(plain.encode())
                    for role, content in reader.feed(text):
                        n_turns += 1
                        turns.update(f"{role}\n{content}\n".encode())
                if reader.rest:
                    raise ValueError(f"conversation {conv_id} ends within a turn")
                yield conv_id, n_turns, turns.hexdigest(), loss_chars, answers.hexdigest(), chars

        yield from _written(read(), READ, lambda r: 150)

    if not ordered:
        pieces = pieces.select("conv_id", "part", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return pieces.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
