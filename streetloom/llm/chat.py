"""Chat formatting with loss masks aligned to token offsets.

A conversation is rendered whole as ``<s>role[INST]text[/INST]</s>`` per turn.  Strings in a
role or text that look like one of the control strings get a backslash behind their first
character; those that already have backslashes there get one more, so the change can be
undone exactly and the control strings occur only as marks.  The rendered text is encoded
once, with offsets, by a tokenizer that knows the control strings as tokens of their own; no
token therefore reaches over the edge of a text.  The spans of the assistant's texts and those
of the tokens are sorted, and a binary search finds the tokens of each turn: the loss mask.

A conversation is the unit of work: its turns are gathered in one row and must fit in memory.

Defined results: a null role or text counts as empty; turns are ordered by number (null
first), then role, then text; repeated rows are repeated turns; an assistant without text
has no tokens under the mask; rows without conv_id form one conversation; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = [BEGIN, OPEN, CLOSE, END, "<|endoftext|>"]
LEARNED_ROLE = "assistant"
_FIRSTS = sorted({c[0] for c in CONTROLS})
_TAILS = {f: "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == f) for f in _FIRSTS}
_LIKE = re.compile("|".join(rf"{re.escape(f)}\\*(?={_TAILS[f]})" for f in _FIRSTS))
_ESCAPED = re.compile("|".join(rf"{re.escape(f)}\\+(?={_TAILS[f]})" for f in _FIRSTS))
_TURN = re.compile(
    "".join(
        [re.escape(BEGIN), "(.*?)", re.escape(OPEN), "(.*?)", re.escape(CLOSE), re.escape(END)]
    ),
    re.DOTALL,
)


def escape(text: str) -> str:
    """The text without control strings; `unescape` gives it back."""
    return _LIKE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][:-1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered conversation and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = BEGIN + escape(role) + OPEN, escape(text)
        parts += [head, body, CLOSE + END]
        at += len(head)
        if role == LEARNED_ROLE:
            spans.append((at, at + len(body)))
        at += len(body) + len(parts[-1])
    return "".join(parts), spans


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (sorted offsets: start, end) lie in one of the sorted spans."""
    mask = np.zeros(len(offsets), bool)
    if len(offsets):
        first = np.searchsorted(offsets[:, 1], [s for s, _ in spans], "right")
        last = np.searchsorted(offsets[:, 0], [e for _, e in spans], "left")
        for (start, end), a, b in zip(spans, first, last, strict=True):
            if start < end:
                mask[a:b] = True
    return mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def read_loss(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts under the mask, one for each run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False]))
    return [
        unescape(formatted[offsets[a, 0] : offsets[b - 1, 1]])
        for a, b in zip(edges[::2], edges[1::2], strict=True)
    ]


def _tokenizer(description: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(description)
    tokenizer.add_special_tokens(CONTROLS)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


SCHEMA = "formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"


def formatted(spark: SparkSession, conversations: DataFrame, tokenizer: str) -> DataFrame:
    """One row per conversation: conv_id, the rendered text, token ids, offsets and loss mask."""
    with open(tokenizer, encoding="utf-8") as file:
        description = spark.sparkContext.broadcast(file.read())

    def run(batches):
        model = _tokenizer(description.value)
        for batch in batches:
            columns: list = [[], [], [], [], []]
            for turns in batch.column(1):
                pairs = [(t["role"] or "", t["text"] or "") for t in turns.as_py()]
                text, spans = render(pairs)
                found = model.encode(text, add_special_tokens=False)
                offsets = np.array(found.offsets, np.int32).reshape(-1, 2)
                values = (
                    text, found.ids, offsets[:, 0], offsets[:, 1], loss_mask(offsets, spans),
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            ints = pa.list_(pa.int32())
            kinds = [pa.string(), ints, ints, ints, pa.list_(pa.bool_())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays],
                names=["conv_id", "formatted", "ids", "starts", "ends", "loss"],
            )

    turn = F.struct("turn", "role", "text")
    gathered = conversations.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    key = conversations.schema["conv_id"].dataType.simpleString()
    return gathered.mapInArrow(run, f"conv_id {key}, {SCHEMA}")


def digests(rows: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""

    def run(batches):
        for batch in batches:
            out: list = [[], [], [], [], []]
            for row in batch.select(["formatted", "starts", "ends", "loss"]).to_pylist():
                text = row["formatted"]
                turns = read_turns(text)
                offsets = np.stack(
                    [np.array(row["starts"], np.int64), np.array(row["ends"], np.int64)], axis=1
                )
                learned = "".join(read_loss(text, offsets, np.array(row["loss"], bool)))
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                values = (
                    len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest(), len(text),
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *map(pa.array, out, kinds)],
                names=[
                    "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                    "formatted_chars",
                ],
            )

    key = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )
