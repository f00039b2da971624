"""Fill-in-middle, Merkle manifest and packing against brute force, on small and awkward inputs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from streetloom.llm import fill_middle, merkle, queries
from streetloom.llm.fill_middle import digests, draws, fill_in_middle, frame_store, frames, restored, transformed
from streetloom.llm.merkle import derive, document_leaves, merkle_manifest, merkle_tree, missing, proofs
from streetloom.llm.packing import bins, cuts, packed, sequences
from tests.conftest import SF_DIR
from tests.llm.test_llm import awkward, empty

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_middle(doc_id, text):
    """n, form, prefix, middle and output of a text, straight from the definition."""
    text = text or ""
    units = UNIT.findall(text)
    h = draws(doc_id)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", p, m, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", p, m, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_awkward(spark):
    rows, docs = awkward(spark)
    rng = random.Random(8)
    more = [(i, "".join(rng.choice([" ", "\n", "é", "語", "ab", "<", "M>", "\x1c", "😀"]) for _ in range(i % 90)),
             "en", "z", 0, 0, 0) for i in range(1000, 1200)]
    more += [(i, t, "en", "z", 0, 0, 0) for i in range(2000, 2040)
             for t in ("x" * 300_000, " " * 200_000, "<S> a b", " a ", "a\n" * 70_000)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema)).withColumn("frames", F.lit(1))
    want = []
    for row in [*rows, *more]:
        n, form, p, m, out = brute_middle(row[0], row[1])
        chars = (None, None) if p is None else (len(p), len(m))
        want.append((row[0], n, form, *chars, sha(out), sha(row[1] or "")))
    for size in (7, fill_middle.FRAME):
        some = docs.where("doc_id < 2000 or doc_id is null") if size == 7 else docs
        got = [tuple(r) for r in digests(transformed(frame_store(some, size))).collect()]
        kept = [w for w in want if size != 7 or w[0] is None or w[0] < 2000]
        assert sorted(got, key=repr) == sorted(kept, key=repr), size
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    assert fill_in_middle(spark, empty(spark)).count() == 0


def test_fill_in_middle_texts_and_parameters(spark):
    docs = spark.createDataFrame([(i, f"a{i} b c\nd e ") for i in range(60)], "doc_id long, text string")
    rows = transformed(frame_store(docs), share=100, suffix_first=0)
    texts = {r["doc_id"]: (r["form"], r["text"]) for r in fill_middle.output_texts(rows).collect()}
    for i in range(60):
        form, text = texts[i]
        assert form == "psm"
        p, s, m = re.fullmatch("<P>(.*)<S>(.*)<M>(.*)", text, re.S).groups()
        assert p + m + s == f"a{i} b c\nd e "


def test_frames_are_independent_and_restored_by_marks_alone():
    text = ("Größe 語 ab\n" * 40).encode()
    cut, units, points = frames(text, 10)
    assert units == 121 and points == len(text.decode())  # the last unit is white space
    expand = fill_middle.zstandard.ZstdDecompressor().decompress
    assert b"".join(expand(f) for _, _, f in cut) == text
    assert all(expand(f).decode() for _, _, f in cut)
    # an output cut at any places, through its marks too, restores the same text
    output = b"<S>" + text[30:] + b"<P>" + text[:9] + b"<M>" + text[9:30]
    for size in (1, 2, 3, 50):
        parts = [fill_middle.zstandard.ZstdCompressor().compress(output[i : i + size])
                 for i in range(0, len(output), size)]
        assert b"".join(restored(parts, "spm")) == text


def fold_up(digests):
    """The levels of a tree, from its leaves to its root."""
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brothers(tree, index):
    """For each level, what stands left and right of the way from a leaf."""
    out = []
    for level in tree[:-1]:
        at = index // 8 * 8
        out.append(("".join(level[at:index]), "".join(level[index + 1 : at + 8])))
        index //= 8
    return out


def brute_manifest(rows):
    """One row per (doc_id, text, lang, source, n_chars, …) row."""

    def leaf(row, text):
        values = (row[0], row[3], row[2], row[4], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda g: g[:3])
        trees.append(fold_up([g[2] for g in groups[name]]))
    top = fold_up([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for rank, (name, tree) in enumerate(zip(names, trees, strict=True)):
        for index, (_, _, digest, row) in enumerate(groups[name]):
            path = brothers(tree, index) + brothers(top, rank)
            now = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1]:
                now = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]))
            for left, right in path:
                now = sha(left + now + right)
            proof = sha("".join(a + b for a, b in path))
            out.append((row[0], digest, tree[-1][0], root, proof, now, now == root))
    return out


def many_rows():
    rng = random.Random(3)
    rows = [(i, f"Text {i}", rng.choice(["de", "en", "en", "en", "fr", None, ""]), "s", i, 0, 0) for i in range(700)]
    rows += [(i, None, f"lang {i}", None, None, 0, 0) for i in range(800, 820)]
    rows += [(5, "Same", "en", "s", 4, 0, 0)] * 40 + [(None, "No Key", "en", "s", 4, 0, 0)] * 3
    return rows


@pytest.mark.parametrize("proved", [1, 4])
def test_merkle_manifest_brute_force(spark, monkeypatch, proved):
    monkeypatch.setattr(merkle, "PROVED", proved)
    monkeypatch.setattr(merkle, "UPPER", 2)  # several copies of the nodes from there on
    rows, docs = awkward(spark)
    rows = rows + many_rows()
    docs = spark.createDataFrame(rows, docs.schema).repartition(5)
    docs = docs.withColumns({"index": F.lit("x"), "digest": F.lit(1), "tree": F.lit(2)})
    got = [tuple(r) for r in merkle_manifest(spark, docs).collect()]
    want = brute_manifest(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {g[-1] for g in got} == {True, False}


def test_merkle_manifest_small_tables(spark):
    assert merkle_manifest(spark, empty(spark)).count() == 0
    assert len(merkle_manifest(spark, empty(spark)).columns) == 7
    rows = [(7, "One", "en", "s", 3, 0, 0)]
    got = [tuple(r) for r in merkle_manifest(spark, spark.createDataFrame(rows, empty(spark).schema)).collect()]
    assert got == brute_manifest(rows)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")


def test_proofs_of_a_few_leaves_fetch_the_missing_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "PROVED", 2)
    rows = [(i, f"Text {i}", "en" if i % 3 else "de", "s", i, 0, 0) for i in range(900)]
    tree = merkle_tree(spark, document_leaves(spark.createDataFrame(rows, empty(spark).schema)), ["doc_id", "digest"])
    wanted = tree.leaves.where("doc_id % 97 = 0")
    found = proofs(spark, tree, wanted).withColumn("ends", merkle.folded(F.col("digest"), F.col("proof")))
    found = {r["doc_id"]: r for r in found.collect()}
    assert sorted(found) == list(range(0, 900, 97))
    assert {r["ends"] for r in found.values()} == {tree.root}
    whole = {r[0]: r for r in brute_manifest(rows)}
    for key, row in found.items():
        assert sha("".join(p["left"] + p["right"] for p in row["proof"])) == whole[key][4]


def test_missing_nodes_are_the_smallest_set():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 9, 64, 65, 700):
        levels = fold_up([sha(f"leaf {i}") for i in range(size)])
        for _ in range(5):
            known = np.unique(rng.integers(0, size, rng.integers(1, size + 1)))
            level, index = missing(known, size)
            places = list(zip(level.tolist(), index.tolist(), strict=True))
            # none can be derived from the leaves, none from others fetched
            assert len(set(places)) == len(places)
            assert all(not ((known >> (3 * a)) == b).any() for a, b in places)
            fetched = {(a, b): levels[a][b] for a, b in places}
            root, sides = derive({int(i): levels[0][i] for i in known}, fetched, size)
            assert root == levels[-1][0]
            for i in known.tolist():
                path = [here[i >> (3 * a)] for a, here in enumerate(sides)]
                assert path == brothers(levels, i)


def library_ids(texts):
    tokenizer = Tokenizer.from_file(queries.byte_bpe())
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packing(rows, ids_of, capacity):
    """Pieces hold each id of their document once, sequences are gapless and hardly padded."""
    sequences_, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences_[r["sequence_id"]].append(r)
        documents[r["doc_id"]].append(r)
    padding = 0
    for members in sequences_.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0
    assert documents.keys() == ids_of.keys()
    for key, pieces in documents.items():
        want = sorted(ids_of[key], key=len)
        left = sorted(pieces, key=lambda r: (r["doc_tokens"], r["start"]))
        assert sum(r["length"] for r in left) == sum(map(len, want)), key
        for r in left:
            bodies = [i for i in want if len(i) == r["doc_tokens"]]
            assert crc(bodies[0][r["start"] : r["start"] + r["length"]]) == r["ids_crc32"]


@pytest.mark.parametrize("capacity", [1, 64, 1024])
def test_packing_brute_force(spark, capacity):
    rows, docs = awkward(spark)
    extra = [(20, " " * 60_000, "en", "a", 0, 0, 0), (21, "z" * 50_000, "en", "a", 0, 0, 0), (22, "\n\n x  'll" * 99, "en", "a", 0, 0, 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("start", F.lit("x"))
    rows = rows + extra
    if capacity == 1:
        rows = [r for r in rows if len(r[1] or "") < 1000]
        docs = docs.where("length(coalesce(text, '')) < 1000")
    ids = defaultdict(list)
    for row, one in zip(rows, library_ids([r[1] for r in rows]), strict=True):
        ids[row[0]].append(one)
    got = packed(spark, docs, queries.byte_bpe(), capacity).collect()
    check_packing(got, ids, capacity)
    assert packed(spark, empty(spark), queries.byte_bpe()).count() == 0
    with pytest.raises(ValueError):
        packed(spark, docs, queries.byte_bpe(), 1000)


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    ids = {r["doc_id"]: [one] for r, one in zip(docs, library_ids([r["text"] for r in docs]), strict=True)}
    check_packing(queries.op13_packing(spark, SF_DIR).collect(), ids, 1024)


def test_sequences_hold_the_pieces(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * (i % 50)) for i in range(300)], "doc_id long, text string")
    docs = docs.repartition(3, "doc_id")
    pieces = packed(spark, docs, queries.byte_bpe(), 128, with_ids=True).collect()
    whole = {r["sequence_id"]: r for r in sequences(spark, docs, queries.byte_bpe(), 128).collect()}
    assert {p["sequence_id"] for p in pieces} == whole.keys()
    for p in pieces:
        row = whole[p["sequence_id"]]
        assert row["ids"][p["offset"] : p["offset"] + p["length"]] == p["ids"]
        assert p["offset"] in row["starts"]
        assert len(row["ids"]) in (128, row["length"])
    assert sum(len(r["ids"]) for r in whole.values()) == sum(p["length"] for p in pieces)


def test_bins_have_a_fixed_count():
    rng = random.Random(2)
    lengths = [x for _ in range(500) for x in cuts(rng.randint(1, 3000), 256)]
    made = list(bins([(x,) for x in lengths], 256))
    assert sorted(x for b in made for (x,) in b) == sorted(lengths)
    sizes = [sum(x for (x,) in b) for b in made]
    short = [s for s in sizes if s != 256]
    assert len(set(short)) == len(short) and all(s & (s - 1) == 0 for s in short)
    one_class = [b for b in made if len(set(b)) == 1 and sum(x for (x,) in b) == 256]
    assert all(len(b) == 256 // b[0][0] for b in one_class) and len(one_class) > 0.95 * len(made)
