"""Chat formatting by prefix-target expansion: each assistant turn becomes an example of its own,
with all turns before it as context and only that reply trainable.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a
backslash becomes ``\\\\`` and ``<|`` becomes ``<\\|`` (a newline in a role ``\\n``), so a marker in the output is always one of the
template's; ``unescape`` undoes it. ``loss`` holds the [start, end) character spans to train on.

A conversation's rows are ordered by turn (nulls first, then role and text); null roles and texts are
empty; rows without a conversation id form one conversation of their own; a conversation without an
assistant turn gives one example with no trainable text, so that its turns aren't lost. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The template's markers.
START, END = "<|im_start|>", "<|im_end|>"
EXAMPLES = "conv_id long, example long, n_context long, formatted string, loss array<struct<start:long,end:long>>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
BATCH_CHARS = 1 << 22


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(s: str) -> str:
    return escape(s).replace("\n", "\\n")


def unescape(s: str) -> str:
    return re.sub(r"\\([\\|n])", lambda m: "\n" if m[1] == "n" else m[1], s)


def examples(turns: list[tuple[str, str]]) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
    """(turns of context, formatted text, loss spans) for each assistant turn, in order."""
    done, said, any_reply = "", 0, False
    for role, text in turns:
        head = f"{START}{escape_role(role)}\n"
        body = escape(text)
        whole = f"{done}{head}{body}{END}\n"
        if role == "assistant":
            any_reply = True
            at = len(done) + len(head)
            yield said, whole, [(at, at + len(body))]
        done, said = whole, said + 1
    if not any_reply:
        yield said, done, []
    elif turns[-1][0] != "assistant":
        yield said, done, []


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that a formatted text holds."""
    out = []
    for part in formatted.split(START)[1:]:
        head, _, rest = part.partition("\n")
        out.append((unescape(head), unescape(rest[: rest.rindex(END)])))
    return out


def format_chat(conversations: DataFrame) -> DataFrame:
    """conv_id, example (number within the conversation), n_context, formatted, loss.

    Turns after the last reply appear in a last example without trainable text.
    """

    def run(batches):
        key, turns, out, chars = (), [], [], 0

        def flush():
            for i, (n, text, loss) in enumerate(examples(turns)):
                yield key[0], i, n, text, [{"start": a, "end": b} for a, b in loss]

        def pack(rows):
            names = ("conv_id", "example", "n_context", "formatted", "loss")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if key != (conv,):
                    for row in flush() if key else ():
                        out.append(row)
                        chars += len(row[3])
                        if chars > BATCH_CHARS:
                            yield pack(out)
                            out, chars = [], 0
                    key, turns = (conv,), []
                turns.append((role, text))
        for row in flush() if key else ():
            out.append(row)
            chars += len(row[3])
            if chars > BATCH_CHARS:
                yield pack(out)
                out, chars = [], 0
        if out:
            yield pack(out)

    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return rows.mapInArrow(run, EXAMPLES)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation from its examples, which lie together and in order."""

    def run(batches):
        key, state, rows = (), None, []

        def close():
            turns = "".join(f"{r}\n{t}\n" for r, t in parse(state["last"]))
            loss = "".join(state["loss"])
            return key[0], len(parse(state["last"])), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), state["chars"]

        def pack(rows):
            return pa.RecordBatch.from_pydict(dict(zip(("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"), (pa.array(c, pa.string() if i in (2, 4) else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))), strict=True)))

        for batch in batches:
            for conv, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True):
                if key != (conv,):
                    if key:
                        rows.append(close())
                    key, state = (conv,), {"last": "", "loss": [], "chars": 0}
                state["last"] = text
                state["loss"] += [unescape(text[x["start"] : x["end"]]) for x in loss]
                state["chars"] += len(text)
            if len(rows) > 5000:
                yield pack(rows)
                rows = []
        if key:
            rows.append(close())
        if rows:
            yield pack(rows)

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, DIGESTS)
