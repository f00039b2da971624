"""Harmonic packing of tokenised documents into sequences of one capacity.

A piece belongs to the class of the reciprocal of its length: class k holds pieces of a k-th
of the capacity, and a bin of class k takes exactly k of them.  Documents may be cut, so their
ends are cut at the lengths of the classes (capacity, half of it, a quarter …, one token)
instead of leaving pieces between two classes; every full bin is then full to the last token.
Each task fills bins of its own partition while it reads, without a shuffle; open bins hold
less than one capacity of tokens per class.  What a task has left at its end, fewer than k
pieces of each class, is put together by descending length into full sequences and at most one
sequence of each power of two, which needs no padding.

The ids are those of the tokenizers library.  They are made by tiktoken from the same
vocabulary, which is several times faster; texts that its pattern engine refuses (very long
runs of white space) go to the tokenizers library itself.

A sequence is named by its partition and place in it: a task that runs again on the same rows
names and fills its sequences the same way.  One document must fit in memory.

Defined results: a null or empty text is one token, the closing id; repeated rows are documents
of their own; a null doc_id stays null; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.bpe import PATTERN, byte_letters

CAPACITY = 1024
#: The id behind the last one of a document, also the padding.
END = 0
#: Rows of pieces that a task hands out at once.
ROWS = 20_000


class Encoder:
    """Ids of texts, as the tokenizers library gives them without special tokens added."""

    def __init__(self, description: str):
        import tiktoken

        read = json.loads(description)
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in read["model"]["vocab"].items()}
        added = {t["content"]: t["id"] for t in read["added_tokens"]}
        ranks = {t: i for t, i in ranks.items() if i not in added.values()}
        self.fast = tiktoken.Encoding(
            "pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added
        )
        self.description, self.slow = description, None

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            pass
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.description)
            self.slow.no_truncation()
            self.slow.no_padding()
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(length: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document: whole sequences, then one piece of a class each."""
    whole, rest = divmod(length, capacity)
    pieces = [capacity] * whole
    while rest:
        pieces.append(1 << (rest.bit_length() - 1))
        rest -= pieces[-1]
    return pieces


def bins(pieces, capacity: int = CAPACITY):
    """Lists of pieces that make a sequence, from (length, …) tuples of class lengths."""
    classes: dict[int, list] = {}
    for piece in pieces:
        open_bin = classes.setdefault(piece[0], [])
        open_bin.append(piece)
        if len(open_bin) == capacity // piece[0]:
            yield open_bin
            classes[piece[0]] = []
    left = [p for length in sorted(classes, reverse=True) for p in classes[length]]
    total = sum(p[0] for p in left)
    # every length divides the longer ones, so the pieces end exactly where a sequence does
    for target in cuts(total, capacity):
        count = size = 0
        while size < target:
            size += left[count][0]
            count += 1
        yield left[:count]
        left = left[count:]


def _pieces(encoder: Encoder, batches, capacity: int, with_ids: bool):
    """(length, doc_id, start, crc32, document's tokens, ids) of all pieces of a partition."""
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            key = key.as_py()
            ids = np.append(encoder.encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
            start = 0
            for length in cuts(len(ids), capacity):
                part = ids[start : start + length]
                own = part.astype(np.int32) if with_ids else None  # a copy: frees the rest
                yield length, key, start, zlib.crc32(part), len(ids), own
                start += length


def _runner(spark: SparkSession, tokenizer: str, capacity: int, with_ids: bool):
    """A function of a partition's batches that gives (sequence_id, bin) pairs."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity must be a power of two, not {capacity}")
    with open(tokenizer, encoding="utf-8") as file:
        description = spark.sparkContext.broadcast(file.read())

    def run(batches):
        first = TaskContext.get().partitionId() << 33
        pieces = _pieces(Encoder(description.value), batches, capacity, with_ids)
        yield from enumerate(bins(pieces, capacity), first)

    return run


def packed(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    ``tokenizer`` is the path of a description in the format of the tokenizers library.
    """
    run = _runner(spark, tokenizer, capacity, with_ids)
    key = docs.schema["doc_id"].dataType
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    longs = ", ".join(f"{n} long" for n in names[1:])
    schema = f"doc_id {key.simpleString()}, {longs}" + (", ids array<int>" if with_ids else "")

    def table(rows, kind):
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(columns[0], kind)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
        if with_ids:
            arrays.append(pa.array(columns[7], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names=names + ["ids"] * with_ids)

    def rows_of(batches):
        kind, rows = pa.null(), []

        def typed(found):
            nonlocal kind
            for batch in found:
                kind = batch.schema.field(0).type
                yield batch

        for sequence, members in run(typed(batches)):
            offset = 0
            for length, doc, start, crc, tokens, ids in members:
                rows.append((doc, start, length, crc, tokens, sequence, offset, ids))
                offset += length
            if len(rows) >= ROWS:
                yield table(rows, kind)
                rows = []
        if rows:
            yield table(rows, kind)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(rows_of, schema)


def sequences(
    spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY
) -> DataFrame:
    """One row per sequence: sequence_id, length, ids (padded as a model reads them), starts.

    ``starts`` are the places where a new piece begins; a length that is a power of two is
    not padded.
    """
    run = _runner(spark, tokenizer, capacity, True)

    def rows_of(batches):
        rows: list = []

        def table():
            columns = zip(*rows, strict=True)
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(
                arrays, names=["sequence_id", "length", "ids", "starts"]
            )

        for sequence, members in run(batches):
            ids = np.concatenate([m[5] for m in members])
            starts = np.cumsum([0] + [m[0] for m in members[:-1]])
            length = len(ids)
            if length & (length - 1):
                ids = np.pad(ids, (0, capacity - length), constant_values=END)
            rows.append((sequence, length, ids, starts.astype(np.int32)))
            if len(rows) * capacity >= 1 << 20:
                yield table()
                rows.clear()
        if rows:
            yield table()

    schema = "sequence_id long, length int, ids array<int>, starts array<int>"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(rows_of, schema)
