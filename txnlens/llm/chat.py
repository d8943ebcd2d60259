"""Operator 8: chat formatting by prefix-target expansion.

Every assistant turn becomes its own example: all preceding turns are the
context and only that reply is trainable. A turn is rendered as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

where in roles and texts ``\\`` is written ``\\\\`` and ``<|`` is written ``<\\|``
(a new line in a role: ``\\n``), so no control string can occur inside a text
and the original can be read back. Turns after the last assistant turn are
kept in one more row without a trainable part, so nothing is lost.

Rows are taken in the order of turn, role, text (nulls first); repeated rows
are turns of their own; a null role or text is empty; a null conv_id is a
conversation of its own. An empty table gives no rows. Only conv_id, turn,
role and text are read.

Conversations are distributed by id and streamed in turn order: a task holds
the rendered prefix of one conversation, never its examples together. The
text of the examples of one conversation grows with the square of its turns,
which is what this expansion means.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
FLUSH_CHARS = 4 << 20
EXAMPLE = "conv_id long, example long, text string, loss_start long, loss_end long, trainable boolean, last boolean"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_examples long")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
_ESC = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESC.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int, int]:
    """The segment of one turn, and where its text starts and ends in it."""
    head = START + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted example."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (conv_id, turn, role, text) sorted by conversation and turn ->
    EXAMPLE rows, contiguous and in order for each conversation. ``last``
    marks the row of a conversation that holds all its turns."""
    out, held = [], 0
    conv, prefix, example, spare, pending = None, [], 0, False, None

    def finish():
        """The held example, now known to be the last, or the tail row."""
        nonlocal example
        if spare:
            text = "".join(prefix)
            if pending:
                yield (*pending, False)
            yield (conv, example, text, len(text), len(text), False, True)
        elif pending:
            yield (*pending, True)

    def flush():
        nonlocal out, held
        frame = pd.DataFrame(out, columns=["conv_id", "example", "text", "loss_start", "loss_end", "trainable", "last"])
        frame["conv_id"] = frame["conv_id"].astype("Int64")
        out, held = [], 0
        return frame

    started = False
    for b in batches:
        ids = [None if pd.isna(x) else int(x) for x in b["conv_id"]]
        for c, role, text in zip(ids, b["role"], b["text"]):
            if not started or c != conv:
                for row in finish():
                    out.append(row)
                    held += len(row[2])
                conv, prefix, example, spare, pending, started = c, [], 0, False, None, True
            seg, lo, hi = render(role, text)
            if role == "assistant":
                if pending:
                    out.append((*pending, False))
                    held += len(pending[2])
                    if held > FLUSH_CHARS:
                        yield flush()
                before = "".join(prefix)
                prefix = [before + seg]
                pending, spare = (conv, example, prefix[0], len(before) + lo, len(before) + hi, True), False
                example += 1
            else:
                prefix.append(seg)
                spare = True
    for row in finish():
        out.append(row)
    if out:
        yield flush()


def read_back(examples: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """EXAMPLE rows -> one DIGEST row per conversation, from their text."""
    conv, started, loss, n_loss, chars, n_ex = None, False, hashlib.sha256(), 0, 0, 0
    for b in examples:
        rows = []
        for r in b.itertuples(index=False):
            c = None if pd.isna(r.conv_id) else int(r.conv_id)
            if not started or c != conv:
                conv, started, loss, n_loss, chars, n_ex = c, True, hashlib.sha256(), 0, 0, 0
            reply = unescape(r.text[r.loss_start:r.loss_end])
            loss.update(reply.encode())
            n_loss, chars, n_ex = n_loss + len(reply), chars + len(r.text), n_ex + bool(r.trainable)
            if r.last:
                turns = read_turns(r.text)
                sha = hashlib.sha256()
                for role, text in turns:
                    sha.update(f"{role}\n{text}\n".encode())
                rows.append((conv, len(turns), sha.hexdigest(), n_loss, loss.hexdigest(), chars, n_ex))
        frame = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples"])
        frame["conv_id"] = frame["conv_id"].astype("Int64")
        yield frame


def _in_order(conversations: DataFrame) -> DataFrame:
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                             F.coalesce("text", F.lit("")).alias("text"))
    return (c.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text"))


def chat_examples(conversations: DataFrame) -> DataFrame:
    """The formatted examples with the span of the trainable reply."""
    return _in_order(conversations).mapInPandas(expand, EXAMPLE)


def chat_digest(conversations: DataFrame) -> DataFrame:
    """Per conversation, what reading its formatted examples gives back. The
    examples are read where they are made, so their text is not moved."""
    return _in_order(conversations).mapInPandas(lambda it: read_back(expand(it)), DIGEST)
