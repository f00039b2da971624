"""Byte-level BPE encoding and decoding with segment trees over adjacent pair ranks.

A text is cut at the strings of added tokens, then into pieces by the tokenizer's pattern.
The leaves of a piece's segment tree hold, for each symbol, the rank of the merge with its
right neighbour and its place; the root is then the leftmost merge of lowest rank.  A merge
changes three leaves, so each costs the logarithm of the length, until no pair can merge.
Trees of short pieces have the same shape and are worked on together as rows of one numpy
array; a long piece has a tree of its own.  Pieces repeat, so a task remembers a bounded
number of them.

Defined results: a null text counts as empty, an empty text has no ids (the digest is that
of the empty string); repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How the vocabulary's tokenizer cuts a text into pieces (fixed by the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces of more bytes have a tree of their own.
SHORT = 64
#: A task remembers at most so many pieces.
REMEMBERED = 300_000
#: Characters of text that are worked on at once.
AT_ONCE = 2_000_000
NONE = np.int64(2**62)


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in vocabularies of this kind."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(moved)}


class Bpe:
    """A vocabulary with its merges; encodes pieces, decodes ids."""

    def __init__(self, description: str):
        read = json.loads(description)
        letters, vocab = byte_letters(), read["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in read["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
        merges = [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.ranks = dict(zip(keys.tolist(), range(len(merges)), strict=True))
        self.names = [str(i) for i in range(size)]
        self.pieces = regex.compile(PATTERN).findall
        ends = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, ends)) + ")") if ends else None
        self.memory: dict = {}

    def split(self, text: str) -> list[str]:
        """Pieces of a text; added tokens are pieces of their own."""
        if self.cut is None or not self.cut.search(text):
            return self.pieces(text)
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out += [part] if k % 2 else self.pieces(part)
        return out

    def _rank(self, left, right):
        """Ranks of pairs of symbols; `NONE` where there is no such merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NONE)

    def encode_short(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Encode pieces of at most ``width`` (a power of two) bytes together."""
        n = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        places = np.arange(width)
        inside = places < size[:, None]
        symbol = np.where(inside, self.first[raw].reshape(n, width), -1)
        after = np.where(places + 1 < size[:, None], places + 1, -1) + np.zeros((n, 1), np.int64)
        before = np.broadcast_to(places - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE)
        rank = self._rank(symbol[:, :-1].clip(0), symbol[:, 1:].clip(0))
        rank[~inside[:, 1:]] = NONE
        tree[:, width : 2 * width - 1] = np.where(rank < NONE, rank * width + places[:-1], NONE)
        level = width
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(
                tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2]
            )
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            at, merged = root % width, self.made[root // width]
            right = after[rows, at]
            beyond, ahead = after[rows, right], before[rows, at]
            symbol[rows, at], symbol[rows, right] = merged, -1
            after[rows, at] = beyond
            has = beyond >= 0
            before[rows[has], beyond[has]] = at[has]
            leaf = np.full(len(rows), NONE)
            r = self._rank(merged[has], symbol[rows[has], beyond[has]])
            leaf[has] = np.where(r < NONE, r * width + at[has], NONE)
            tree[rows, width + right] = NONE
            tree[rows, width + at] = leaf
            led = ahead >= 0
            r = self._rank(symbol[rows[led], ahead[led]], merged[led])
            tree[rows[led], width + ahead[led]] = np.where(r < NONE, r * width + ahead[led], NONE)
            for row, spot in ((rows, at), (rows, right), (rows[led], ahead[led])):
                node = (width + spot) >> 1
                while node.size and node[0] > 0:
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                    node = node >> 1
            rows = rows[tree[rows, 1] < NONE]
        flat = symbol[symbol >= 0].tolist()
        ends = np.cumsum((symbol >= 0).sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_long(self, piece: bytes) -> list[int]:
        """Encode one piece of any length with a segment tree of its own."""
        n = len(piece)
        width = 1 << max(n - 1, 1).bit_length()
        symbol = self.first[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        none, ranks, made = int(NONE), self.ranks, self.made

        def leaf(i, j):
            r = ranks.get(symbol[i] << 32 | symbol[j]) if i >= 0 and j >= 0 else None
            return none if r is None else r * width + i

        tree = [none] * (2 * width)
        tree[width : width + n] = [leaf(i, after[i]) for i in range(n)]
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            right = after[at]
            symbol[at], symbol[right] = int(made[rank]), -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for i, value in (
                (at, leaf(at, after[at])), (right, none), (before[at], leaf(before[at], at)),
            ):
                if i < 0:
                    continue
                k = width + i
                tree[k] = value
                while k > 1:
                    k //= 2
                    low = min(tree[2 * k], tree[2 * k + 1])
                    if tree[k] == low:
                        break
                    tree[k] = low
        return [s for s in symbol if s >= 0]

    def learn(self, pieces) -> None:
        """Encode pieces that are not remembered: ids as text, their number, decoded bytes."""
        new = [p for p in pieces if p not in self.memory]
        raw = {p: p.encode("utf-8", "surrogatepass") for p in new if p not in self.added}
        done = {p: [self.added[p]] for p in new if p in self.added}
        by_width: dict[int, list[str]] = {}
        for p, b in raw.items():
            width = max(4, 1 << (len(b) - 1).bit_length())
            by_width.setdefault(width if width <= SHORT else 0, []).append(p)
        for width, members in by_width.items():
            if not width:
                done |= {p: self.encode_long(raw[p]) for p in members}
                continue
            for at in range(0, len(members), 65_536):
                part = members[at : at + 65_536]
                done |= dict(
                    zip(part, self.encode_short([raw[p] for p in part], width), strict=True)
                )
        names, own = self.names, self.bytes
        for p, ids in done.items():
            self.memory[p] = (
                ",".join([names[i] for i in ids]), len(ids), b"".join([own[i] for i in ids]),
            )

    def encode(self, text: str) -> list[int]:
        """The ids of one text."""
        pieces = self.split(text)
        self.learn(set(pieces))
        return [int(i) for p in pieces for i in self.memory[p][0].split(",")]

    def decode(self, ids) -> str:
        """The text of ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


def encoded(
    spark: SparkSession, docs: DataFrame, tokenizer: str, with_ids: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids).

    ``tokenizer`` is the path of a description in the format of the tokenizers library; it is
    read on the driver and sent to the tasks, its size is that of a vocabulary.
    """
    with open(tokenizer, encoding="utf-8") as file:
        description = spark.sparkContext.broadcast(file.read())

    def texts(batch):
        part, size = [], 0
        for row, text in enumerate(batch.column(1)):
            part.append((row, text.as_py() or ""))
            size += len(part[-1][1])
            if size >= AT_ONCE:
                yield part
                part, size = [], 0
        yield part

    def run(batches):
        model = Bpe(description.value)
        for batch in batches:
            for part in texts(batch):
                split = [model.split(t) for _, t in part]
                if len(model.memory) > REMEMBERED:
                    model.memory.clear()
                model.learn(set().union(*split))
                memory, columns = model.memory, ([], [], [], [])
                for pieces in split:
                    found = [memory[p] for p in pieces]
                    ids = ",".join([f[0] for f in found])
                    text = b"".join([f[2] for f in found]).decode("utf-8", "replace")
                    columns[0].append(sum([f[1] for f in found]))
                    columns[1].append(hashlib.sha256(ids.encode()).hexdigest())
                    columns[2].append(hashlib.sha256(text.encode()).hexdigest())
                    if with_ids:
                        columns[3].append(np.array(ids.split(",") if ids else [], np.int32))
                keys = batch.column(0).take(pa.array([row for row, _ in part], pa.int64()))
                out = [keys, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string())]
                out.append(pa.array(columns[2], pa.string()))
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out.append(pa.array(columns[3], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select("doc_id", F.col("text").cast("string"))
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
