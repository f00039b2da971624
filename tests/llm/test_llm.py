"""The training-data operators against brute force, on small and on awkward inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import _sorted
from streetloom.llm import neighbours, queries
from streetloom.llm.bpe import Bpe, encoded
from streetloom.llm.chat import digests, escape, formatted, read_turns, render, unescape
from streetloom.llm.html_text import extracted
from streetloom.llm.language_model import language_scores
from streetloom.llm.line_dedup import line_dedup
from streetloom.llm.mixing import fitted, mixture
from streetloom.llm.neighbours import nearest
from streetloom.llm.quality import good_documents, quality
from streetloom.llm.secrets import RULES, Rule, findings, scan, secrets
from streetloom.llm.simhash import near_duplicates, representative_documents
from tests.conftest import SF_DIR

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __rid int, size int"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def awkward(spark):
    """Nulls in every column, empty and long texts, copies, ties, clashing column names."""
    rng = random.Random(4)
    long = " ".join(rng.choice(["alpha", "Beta", "γ", "delta!", "x"]) for _ in range(30_000))
    para = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, para + "\nown line\n" + para, "en", "a"), (2, "first\n" + para, "en", "a"),
        (3, para, None, "a"), (3, para, None, "a"), (None, para + " tail", "en", None),
        (4, None, None, None), (5, "", "en", "b"), (6, " \n\t\n ", "en", "b"), (7, long, "en", "b"),
        (8, "password = abcdefgh12 token: a secret:'AKIAABCDEFGHIJKL' " + "0a" * 20, "en", "c"),
        (9, "one two", "de", "c"), (10, "one two", "de", "c"),
        (11, "<|endoftext|> é x y 'll'S  \n\n 123", "de", "d"),
    ]
    rows = [(*r, len(r[1] or ""), k, 9) for k, r in enumerate(rows)]
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_native_queries_equal_sql(spark, con):
    for name in queries.ORACLES:
        df = queries.QUERIES[name](spark, SF_DIR)
        got = _sorted(df.columns, [tuple(r) for r in df.collect()])
        result = con.execute(queries.ORACLES[name])
        want = _sorted([d[0] for d in result.description], result.fetchall())
        assert got == want, name


def test_quality_awkward(spark):
    rows, docs = awkward(spark)
    got = quality(spark, docs).collect()
    assert len(got) == len(rows)
    assert {r["n_words"] for r in got if r["doc_id"] == 4} == {0}
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 10)
    kept = good_documents(spark, docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in got)
    assert quality(spark, empty(spark)).count() == 0


def test_quality_repeats_act_below_the_base_rule(spark):
    def text(k, times):
        # ``times`` copies of one window among words that occur once
        return " ".join(["aa bb cc dd ee"] * times + [f"w{k}x{i}" for i in range(100 - 5 * times)])

    rows = [(k, text(k, 0), "s", "en") for k in range(300)]
    rows += [(1000, text(1000, 3), "s", "en"), (1001, text(1001, 2), "s", "en")]
    # in a group that repeats throughout, the same text is no outlier
    rows += [(2000 + k, text(2000 + k, k % 4), "t", "en") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: r for r in quality(spark, docs).collect()}
    assert got[1000]["n_repeat_words"] == 15 and not got[1000]["base_failed"]
    assert not got[1000]["kept"] and got[1001]["kept"]
    assert all(r["kept"] for k, r in got.items() if k != 1000)


def brute_lines(rows, least=50):
    """Deleted (row, line) pairs by comparing all runs of lines with enough words."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, gone = set(), set()
    runs = []
    for place, i in enumerate(order):
        lines = [(p, x) for p, x in enumerate((rows[i][1] or "").split("\n")) if words(x)]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                body = tuple(x for _, x in lines[a : b + 1])
                if sum(len(words(x)) for x in body) >= least:
                    runs.append((place, a, i, [p for p, _ in lines[a : b + 1]], body))
    for _, _, i, places, body in sorted(runs, key=lambda r: r[:2]):
        if body in seen:
            gone.update((i, p) for p in places)
        seen.add(body)
    return gone


def test_line_dedup_brute_force(spark):
    rng = random.Random(1)
    pool = [" ".join(f"{k}w{j}" for j in range(rng.choice([3, 20, 30, 60]))) for k in range(12)]
    rows = [
        (k, "\n".join(rng.choice([*pool, "", f"own {k} {j}"]) for j in range(rng.randint(1, 12))))
        for k in range(60)
    ] + [(None, "\n".join(pool[:6])), (100, None), (101, "")]
    gone = brute_lines(rows)
    want = []
    for i, (key, text) in enumerate(rows):
        lines = (text or "").split("\n")
        left = "\n".join(x for p, x in enumerate(lines) if (i, p) not in gone)
        want.append((key, sum(1 for j, _ in gone if j == i), None if text is None else left))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, line_dedup(spark, docs).collect()), key=repr) == sorted(want, key=repr)
    assert line_dedup(spark, empty(spark)).count() == 0


def brute_components(rows):
    prints = []
    for row in rows:
        w = words(row[1])
        shingles = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    ids = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    return [(rows[i][0], f"{prints[i]:016x}", ids[root[i]]) for i in range(len(rows))]


def test_simhash_brute_force(spark):
    rows, docs = awkward(spark)
    rows = [r for r in rows if r[0] != 7]
    rng = random.Random(2)
    base = [f"t{i}" for i in range(400)]
    for k in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 12)):
            w[rng.randrange(400)] = f"z{rng.randrange(50)}"
        rows.append((100 + k, " ".join(w), "en", "a", 0, k, 0))
    docs = spark.createDataFrame(rows, DOCS)
    want = brute_components(rows)
    got = near_duplicates(spark, docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    left = representative_documents(spark, docs)
    assert left.columns == docs.columns
    assert left.count() == len({w[2] if w[2] is not None else w[1] for w in want})
    assert near_duplicates(spark, empty(spark)).count() == 0


def test_near_dedup_stage_brute_force(spark):
    rng = random.Random(8)
    base = [f"t{i}" for i in range(300)]
    rows = [(k, t, "en", "a", 0, k, 0) for k, t in enumerate(["a b", "A  b", "a b c", "x y z v"])]
    for k in range(10, 130):
        w = list(base) if k % 3 else [f"{k} {i}" for i in range(200)]
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(200)] = f"z{rng.randrange(50)}"
        rows.append((k, " ".join(w), "en", "a", 0, k, 0))
    docs = spark.createDataFrame(rng.sample(rows * 2, 2 * len(rows)), DOCS).repartition(3)
    want = {component for _, _, component in brute_components(rows)}
    got = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)
    assert len(want) < 100


@pytest.mark.parametrize("seed", range(6))
def test_fitted_is_exact_where_small_lengths_allow(seed):
    rng = random.Random(seed)
    lengths = rng.sample(range(1, 400), 60)
    counts = [rng.randint(1, 9) for _ in lengths]
    total = sum(x * n for x, n in zip(lengths, counts, strict=True))
    for budget in (0, 1, total // 7, total // 2, total - 1, total, total + 9):
        take = fitted(lengths, counts, budget)
        assert all(0 <= t <= n for t, n in zip(take, counts, strict=True))
        reached = {0}
        for x, n in zip(lengths, counts, strict=True):
            reached |= {r + x * k for r in reached for k in range(1, n + 1) if r + x * k <= 400}
        assert budget - 400 < (take * lengths).sum() <= budget or budget > total
        if budget <= 1:
            assert (take * lengths).sum() == max(r for r in reached if r <= budget)


def test_mixture(spark):
    rows, docs = awkward(spark)
    first, again = (sorted(map(tuple, mixture(spark, docs).collect()), key=repr) for _ in range(2))
    assert first == again and len(first) == len(rows)
    assert all(r[4] <= 3 * r[1] and (r[1] == 0 or r[4] % r[1] == 0) for r in first)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    targets = {(r[2], r[3]) for r in first}
    assert abs(sum(t for _, t in targets) - sum(sizes.values())) < 1e-6
    assert mixture(spark, empty(spark)).count() == 0


def test_bpe_equals_library(spark):
    rows, docs = awkward(spark)
    library = Tokenizer.from_file(queries.byte_bpe())
    with open(queries.byte_bpe(), encoding="utf-8") as file:
        own = Bpe(file.read())
    rng = random.Random(3)
    marks = "aeéñ 中   \u0085\x1c\x1f\x0b\n\t'sdlrv0٣Ⅷ!?<|>=-😀́"
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 90))) for _ in range(800)]
    texts += ["=" * 500, "a" * 333, " " * 200 + "x", "x<|endoftext|>y<|endoftext|>"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    got = {r["doc_id"]: r for r in encoded(spark, docs, queries.byte_bpe(), with_ids=True).collect()}
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        if key not in (3, None):
            assert got[key]["ids"] == ids
            assert got[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert encoded(spark, empty(spark), queries.byte_bpe()).count() == 0


def test_secret_ledger(spark):
    rows, docs = awkward(spark)
    first = scan(docs)
    assert scan(docs, first).count() == 0
    newer = [*RULES[:2], Rule("hex", 2, r"[0-9a-f]{40,}", 0, 40)]
    more = scan(docs, first, newer)
    assert {tuple(r["scanned"]) for r in more.collect()} == {("hex@2",)}
    spans = {
        r["doc_id"]: [s["rule"] for s in r["spans"]]
        for r in findings(docs, first.unionByName(more), newer).collect()
    }
    assert spans[8] == ["assign@1", "assign@1", "access@1", "hex@2"]
    got = {r["doc_id"]: r for r in secrets(spark, docs).collect()}
    assert (got[8]["n_assign"], got[8]["n_access"], got[8]["n_hex"]) == (2, 1, 1)
    assert got[4]["spans"] == "" and secrets(spark, empty(spark)).count() == 0


def test_chat_round_trip(spark):
    rng = random.Random(5)
    marks = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "<\\s>", "<|endoftext|>", "é😀", " ", "\n", "a"]
    text = lambda: "".join(rng.choice(marks) for _ in range(rng.randint(0, 9)))
    for _ in range(500):
        turns = [(rng.choice(["user", "assistant", text()]), text()) for _ in range(4)]
        assert read_turns(render(turns)[0]) == turns
        assert all(unescape(escape(t)) == t for _, t in turns)
    rows = [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice([text(), text(), None]), 1)
        for c in range(40) for t in range(rng.randint(1, 6))
    ] + [(None, None, "assistant", "x", 1)]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids int")
    got = {r["conv_id"]: r for r in digests(formatted(spark, talks, queries.byte_bpe())).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        learned = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        assert got[conv]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert got[conv]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
    assert digests(formatted(spark, talks.limit(0), queries.byte_bpe())).count() == 0


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    x = (centres[rng.integers(0, 20, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[50:90] = x[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(5000, None, 1), (5050, [0.0] * 16, 1), (5100, [float("nan")] * 16, 1), (None, [1.0] * 16, 1), (5150, [1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rid int")
    got = nearest(spark, table, table.where("vec_id % 50 = 0")).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    hits = 0
    assert set(found) == set(range(0, 3000, 50))
    for q, ids in found.items():
        assert len(ids) == 5 and q not in ids
        like = unit @ unit[q]
        like[q] = -2
        hits += len(set(ids) & set(np.argsort(-like, kind="stable")[:5].tolist()))
    assert hits / (5 * len(found)) >= 0.9
    assert found[0] == [50, 51, 52, 53, 54]
    assert nearest(spark, table.limit(0), table.limit(0)).count() == 0
    few = nearest(spark, table.limit(4), table.where("vec_id = 0")).collect()
    assert [r["rank"] for r in few] == [1, 2, 3]


@pytest.mark.parametrize("clustered", [False, True])
def test_neighbours_recall_with_many_lists(spark, monkeypatch, clustered):
    monkeypatch.setattr(neighbours, "LIST_LENGTH", 12)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 24))
    if clustered:
        x = 3 * rng.normal(size=(40, 24))[rng.integers(0, 40, 6000)] + x
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest(spark, table, table.where("vec_id % 50 = 0")).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, 6000, 50):
        like = unit @ unit[q]
        like[q] = -2
        ids = {r["vec_id"] for r in got if r["query_id"] == q}
        hits += len(ids & set(np.argsort(-like)[:5].tolist()))
    assert hits / 600 >= 0.9
    assert nearest(spark, table, table.limit(0)).count() == 0


def test_neighbours_of_a_repeated_row(spark):
    x = np.abs(np.random.default_rng(6).normal(size=(600, 16)))
    x[7] *= -1  # far from all others, so that no list of its centroids holds them
    rows = [(i, x[i].tolist()) for i in range(600)] + [(7, x[7].tolist())] * 400
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(spark, table, table.where("vec_id = 7").limit(3)).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = [i for i in np.argsort(-(unit @ unit[7])).tolist() if i != 7][:5]
    assert len(got) == 15
    assert all(r["vec_id"] == want[r["rank"] - 1] for r in got)


def test_language_model_beats_unigrams(spark):
    rng = random.Random(6)
    chain = {k: rng.sample(range(30), 3) for k in range(30)}
    rows = []
    for k in range(400):
        w, at = [], rng.randrange(30)
        for _ in range(rng.randint(1, 120)):
            w.append(f"W{at}")
            at = rng.choice(chain[at])
        rows.append((k, " ".join(w), "en", "a", 0, 0, 0))
    rows += [(None, None, None, None, None, 0, 0), (1000, "", "en", "a", 0, 0, 0)]
    got = language_scores(spark, spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2}
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["n_tokens"] == len(words(dict((x[0], x[1]) for x in rows)[r["doc_id"]])) + 1 for r in got)
    assert language_scores(spark, empty(spark)).count() == 0


def test_html_extraction(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><a>menu</a></nav>"
        "<div class='ad'>buy</div><article><h1>Head  &amp; x</h1><p>one <b>two</b>\n three<p>four"
        "<aside>side</aside><div class='comments'><p>me</p></div></article><footer>f</footer>"
    )
    bare = "<body><div class=top>Site</div><div class=in><p>Own {0}</p><div class=x>Same</div></div></body>"
    rows = [(1, "http://a.example/1", page, 0), (2, None, None, 0), (3, "x", "", 0), (4, "http://a.example", "<p>broken <i", 0)]
    rows += [(5, "http://a.example", "<article>a<![odd b]><p>c<!-->d<![if x]>e</p></article><!-- f", 0)]
    rows += [(10 + k, f"http://b.example/{k}", bare.format(k * 7), 0) for k in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, wrapper int")
    got = {r["page_id"]: r["text"] for r in extracted(spark, pages).collect()}
    assert got[1] == "Head & x\none two three\nfour"
    assert got[2] == got[3] == ""
    assert got[5] == "a\ncde"
    assert [got[10 + k] for k in range(9)] == [f"Own {k * 7}" for k in range(9)]
    assert extracted(spark, pages.limit(0)).count() == 0


def texts_of(spark, html, pages=8):
    rows = [(k, f"http://c.example/{k}", html.replace("{0}", f"n{k}")) for k in range(pages)]
    got = extracted(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"].split("\n") for r in got.collect()}


def test_html_keeps_all_that_varies(spark):
    page = (
        "<body><div class=top>Site</div><h1>Title {0}</h1><div class=in><h2>Sub {0}</h2><p>" + "long {0} " * 40
        + "</p><ul><li>item {0}</li></ul><table><tr><td>cell {0}</td></tr></table><pre>code {0}</pre></div>"
        "<div class=end>Imprint</div>"
    )
    for k, lines in texts_of(spark, page).items():
        assert lines[:2] == [f"Title n{k}", f"Sub n{k}"]
        assert lines[3:] == [f"item n{k}", f"cell n{k}", f"code n{k}"]
        assert lines[2] == f"long n{k} " * 39 + f"long n{k}"


def test_html_wrapper_decides_on_marked_pages(spark):
    teasers = "<article class=card>see {0}</article>" * 2
    page = "<body><div class=top>Site</div><div class=in><p>" + "own {0} " * 30 + f"</p></div>{teasers}"
    for k, lines in texts_of(spark, page).items():
        assert lines == [f"own n{k} " * 29 + f"own n{k}", f"see n{k}", f"see n{k}"]
    page = "<body><div class=x>out {0}</div><article><p>own text {0}</p><div class=y>Read on our site</div></article>"
    for k, lines in texts_of(spark, page).items():
        assert lines == [f"own text n{k}"]
    assert texts_of(spark, page.replace("{0}", "same"))[3] == ["own text same", "Read on our site"]


def test_html_names_do_not_drop_layout(spark):
    inner = "<article><p>own {0}</p><div class=share-prices>prices {0}</div><div class='ad'>buy {0}</div></article>"
    for outer in ("<div class='layout has-sidebar'>", "<div class='page menu'>", "<form>", "<div id=comments-open>"):
        for pages in (2, 8):
            for k, lines in texts_of(spark, f"<body>{outer}{inner}", pages).items():
                assert lines == [f"own n{k}", f"prices n{k}"], outer
    page = "<body><h1>{0}</h1><form><div class=sidebar><p>" + "own {0} " * 30 + "</p><div class=ad>buy {0}</div></div></form>"
    for k, lines in texts_of(spark, page).items():
        assert lines == [f"n{k}", f"own n{k} " * 29 + f"own n{k}"]


def test_html_names_drop_what_is_no_content(spark):
    from streetloom.llm.html_text import content, parse

    own = "<p>own {0}</p>"
    dropped = [
        "<div class='comments-list'>x {0}</div>", "<section class='reader-comments'><p>x {0}</p></section>",
        "<ul class='related-posts'><li>x {0}</ul>", "<div class='cookie-banner'>x {0}</div>",
        "<div class='side-bar'>x {0}</div>", "<div id=user-comments>x {0}</div>", "<div class='ad-slot'>x {0}</div>",
        "<div class='mainNav'>x {0}</div>", "<div class='comment-body'>x {0}</div>",
    ]
    outside = [
        "<header><h1>My Site</h1><p>slogan {0}</p></header>", "<div class='site-header'>x {0}</div>",
        "<div class='site-footer'>x {0}</div>", "<div class='header'>x {0}</div>",
    ]
    kept = ["<div class='related-work'><p>r {0}</p></div>", "<p class='no-sidebar'>s {0}</p>", "<div class=comments-open>c {0}</div>"]
    pages = [f"<body>{d}<article>{own}</article>{d}" for d in dropped + outside]
    pages += [f"<body><article>{own}{d}</article>" for d in dropped]
    pages += [f"<body>{d}<div class=in>{own}</div>" for d in dropped + outside]
    for page in pages:
        assert content(parse(page), None) == "own {0}", page
    both = "<body>" + "".join(dropped + outside) + "<div class=in>" + own + "".join(kept + dropped) + "</div>"
    for count in (2, 8):
        for k, lines in texts_of(spark, both, count).items():
            assert lines == [f"own n{k}", f"r n{k}", f"s n{k}", f"c n{k}"]


def test_html_main_before_its_articles(spark):
    page = "<body><main><p>lead {0}</p><article><header><h1>head {0}</h1></header><p>card {0}</p></article></main><p>x {0}</p>"
    for count in (2, 8):
        for k, lines in texts_of(spark, page, count).items():
            assert lines == [f"lead n{k}", f"head n{k}", f"card n{k}"]


def test_html_layout_without_marks_on_small_hosts(spark):
    page = "<body><h1>{0}</h1><form><div class=sidebar><p>" + "own {0} " * 30 + "</p><div class=ad>buy {0}</div></div></form>"
    comments = "<body><p>own {0}</p><div class=comments>" + "mine {0} " * 30 + "</div>"
    for k, lines in texts_of(spark, page, 2).items():
        assert lines == [f"n{k}", f"own n{k} " * 29 + f"own n{k}"]
    for count in (2, 8):
        for k, lines in texts_of(spark, comments, count).items():
            assert lines == [f"own n{k}"]


def test_html_deep_and_long_pages(spark):
    deep = "<body>" + "<div>" * 120 + "<p>own {0}</p><p class=x>same</p>" + "</div>" * 120
    deeper = "<body>" + "<div>" * 3000 + "<p>own {0}</p>"
    long = "<body><article>" + "<p>own {0} &amp; more</p>" * 20000
    for k, lines in texts_of(spark, deep).items():
        assert lines == [f"own n{k}"]
    for k, lines in texts_of(spark, deeper).items():
        assert lines == [f"own n{k}"]
    for k, lines in texts_of(spark, long, 2).items():
        assert lines == [f"own n{k} & more"] * 20000


def test_pipeline(spark):
    rows, docs = awkward(spark)
    whole = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    now = whole
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF_DIR)
        assert now.columns == whole.columns
        now = spark.createDataFrame(now.collect(), now.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR)
    assert last.count() == now.count() > 0
    for some in (docs, empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, some, SF_DIR).count()
