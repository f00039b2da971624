"""Fill-in-the-middle over texts kept as seekable compressed frames.

A text is stored as independent zstandard frames of bounded size, each with the number of units
(tokens of white space and a word) and code points that end before it.  A cut behind a number of
units is found by binary search over these counts and decompresses one frame; the sections
between two cuts reuse the stored frames, only the cut ones are compressed anew.  The output is
again a row of frames.  Its digest, and the text restored from it, are made frame by frame, so
beside the compressed text a task holds one frame, whatever the length of a document.

A unit ends where a word does, or where the text ends in white space.  Both are bytes below 128,
so units are counted and cut on UTF-8; frames end between code points.

Defined results: a null text counts as empty, an empty text is plain; a text that holds one of
the marks is plain; a null doc_id draws its numbers from the seed and an empty id; repeated rows
are transformed each, alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.common import staged

SEED = 42
#: Of 100 documents, those that are transformed; of these, those with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Order of the marks in the two forms.
FORMS = {"psm": [PREFIX, SUFFIX, MIDDLE], "spm": [SUFFIX, PREFIX, MIDDLE]}
#: Bytes of text in a frame.
FRAME = 1 << 16
#: Bytes of frames that a task hands out at once.
AT_ONCE = 8 << 20
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _ends(body: np.ndarray) -> np.ndarray:
    """Where words end inside ``body`` (the end of it is not looked at)."""
    space = _SPACE[body]
    return np.flatnonzero(~space[:-1] & space[1:]) + 1


def _points(body: np.ndarray) -> int:
    """Code points that begin in ``body``."""
    return int(np.count_nonzero((body & 0xC0) != 0x80))


def frames(body: bytes, size: int = FRAME):
    """(units before, code points before, frame) of a text, then the total counts."""
    whole, compress = np.frombuffer(body, np.uint8), zstandard.ZstdCompressor().compress
    out, units, points, start = [], 0, 0, 0
    while start < len(body):
        stop = min(start + size, len(body))
        while stop < len(body) and whole[stop] & 0xC0 == 0x80:
            stop += 1
        out.append((units, points, compress(body[start:stop])))
        # a word that ends with the frame counts here: the byte behind is looked at, too
        units += len(_ends(whole[start : stop + 1])) + (stop == len(body))
        points += _points(whole[start:stop])
        start = stop
    return out, units, points


class Store:
    """The frames of one text."""

    def __init__(self, units, points, bodies):
        self.units, self.points, self.bodies = units, points, bodies
        self.expand = zstandard.ZstdDecompressor().decompress
        self.compress = zstandard.ZstdCompressor().compress

    def cut(self, units: int) -> tuple[int, int, int]:
        """Frame, byte in it and code point behind the first ``units`` units."""
        if units == 0:
            return 0, 0, 0
        frame = int(np.searchsorted(self.units, units, "left")) - 1
        body = np.frombuffer(self.expand(self.bodies[frame]), np.uint8)
        ends, place = _ends(body), units - self.units[frame] - 1
        stop = int(ends[place]) if place < len(ends) else len(body)
        return frame, stop, int(self.points[frame]) + _points(body[:stop])

    def section(self, first, last):
        """Frames of the text between two cuts; ``last`` None: up to the end."""
        (frame, at), (final, stop) = first[:2], last[:2] if last else (len(self.bodies), 0)
        while frame < final or (frame == final and at < stop):
            if at or frame == final:
                part = self.expand(self.bodies[frame])[at : stop if frame == final else None]
                if part:
                    yield self.compress(part)
            else:
                yield self.bodies[frame]
            frame, at = frame + 1, 0


def draws(doc_id, seed: int = SEED) -> list[int]:
    """The four numbers that decide on a document."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def restored(bodies: list[bytes], form: str):
    """The original text, in pieces of bounded size, from the frames of an output.

    The marks are looked up in the text of the output; it does not matter how it was cut.
    """
    expand = zstandard.ZstdDecompressor().decompress
    if form == "plain":
        yield from map(expand, bodies)
        return
    marks, starts, found, tail, size = iter(FORMS[form]), [0], [], b"", 0
    mark = next(marks)
    for body in bodies:
        part = expand(body)
        window, begin, at = tail + part, size - len(tail), 0
        while mark is not None and (hit := window.find(mark, at)) >= 0:
            found.append(begin + hit)
            at, mark = hit + len(mark), next(marks, None)
        size += len(part)
        starts.append(size)
        tail = window[max(at, len(window) - 2) :]  # a mark may go on in the next frame
    spans = {}
    for mark, begin, end in zip(FORMS[form], found, [*found[1:], size], strict=True):
        spans[mark] = (begin + len(mark), end)
    for mark in (PREFIX, MIDDLE, SUFFIX):
        at, end = spans[mark]
        frame = bisect_right(starts, at) - 1
        while at < end:
            yield expand(bodies[frame])[at - starts[frame] : end - starts[frame]]
            frame += 1
            at = starts[frame]


def frame_store(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """The table of frames: doc_id, n (units), marked, frames; one row per document."""
    frame = pa.struct(
        [("units", pa.int64()), ("points", pa.int64()), ("body", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            rows: list = [[], [], []]
            first = held = 0
            for row, text in enumerate(batch.column(1), 1):
                body = text.as_py() or b""
                cut, units, _ = frames(body, size)
                marks = any(m in body for m in (PREFIX, SUFFIX, MIDDLE))
                for column, value in zip(rows, (units, marks, cut), strict=True):
                    column.append(value)
                held += sum(len(c[2]) for c in cut)
                if held >= AT_ONCE or row == batch.num_rows:
                    kinds = [pa.int64(), pa.bool_(), pa.list_(frame)]
                    lists = [[dict(zip(("units", "points", "body"), f, strict=True)) for f in c] for c in rows[2]]
                    arrays = [pa.array(c, k) for c, k in zip([*rows[:2], lists], kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[first:row], *arrays], names=["doc_id", "n", "marked", "frames"]
                    )
                    rows, first, held = [[], [], []], row, 0

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {key}, n long, marked boolean, "
        "frames array<struct<units: long, points: long, body: binary>>"
    )
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def transformed(
    store: DataFrame,
    seed: int = SEED,
    share: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (frames, in order) of a `frame_store`."""

    def one(doc_id, n, marked, parts):
        h = draws(doc_id, seed)
        own = Store(
            np.array([p["units"] for p in parts]), [p["points"] for p in parts],
            [p["body"] for p in parts],
        )
        if n == 0 or marked or h[2] % 100 >= share:
            return "plain", None, None, own.bodies
        ends = sorted(x % (n + 1) for x in h[:2])
        first, last = own.cut(ends[0]), own.cut(ends[1])
        parts = {
            PREFIX: own.section((0, 0), first), MIDDLE: own.section(first, last),
            SUFFIX: own.section(last, None),
        }
        form = "spm" if h[3] % 100 < suffix_first else "psm"
        bodies = [b for m in FORMS[form] for b in (own.compress(m), *parts[m])]
        return form, first[2], last[2] - first[2], bodies

    def run(batches):
        for batch in batches:
            rows: list = []
            first = held = 0
            columns = [batch.column(c) for c in ("doc_id", "n", "marked", "frames")]
            for row, values in enumerate(zip(*columns, strict=True), 1):
                rows.append(one(*(v.as_py() for v in values)))
                held += sum(map(len, rows[-1][3]))
                if held >= AT_ONCE or row == batch.num_rows:
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
                    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [columns[0][first:row], columns[1][first:row], *arrays],
                        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                    )
                    rows, first, held = [], row, 0

    key = store.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, n long, form string, prefix_chars long, middle_chars long, output array<binary>"
    return store.mapInArrow(run, schema)


def output_texts(rows: DataFrame) -> DataFrame:
    """The texts of the outputs of `transformed`: doc_id, form, text."""

    def run(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [b"".join(map(expand, bodies.as_py())) for bodies in batch.column(2)]
            text = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), text], names=["doc_id", "form", "text"]
            )

    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "form", "output").mapInArrow(
        run, f"doc_id {key}, form string, text string"
    )


def digests(rows: DataFrame) -> DataFrame:
    """The rows of `transformed` with digests of the output and of the text restored from it."""
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def digest(parts) -> str:
        sha = hashlib.sha256()
        for part in parts:
            sha.update(part)
        return sha.hexdigest()

    def run(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            made, again = [], []
            for form, bodies in zip(batch.column("form"), batch.column("output"), strict=True):
                bodies = bodies.as_py()
                made.append(digest(map(expand, bodies)))
                again.append(digest(restored(bodies, form.as_py())))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(made, pa.string()), pa.array(again, pa.string())],
                names=[*kept, "output_sha256", "restored_sha256"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.mapInArrow(run, f"{schema}, output_sha256 string, restored_sha256 string")


def fill_in_middle(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: its form, the lengths of prefix and middle, and both digests."""
    return digests(transformed(staged(spark, frame_store(docs), "frames")))
