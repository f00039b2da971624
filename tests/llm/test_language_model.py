"""The language model against plain steps and plain counts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from streetloom.llm.language_model import HIDDEN, LOGIT, Gru, language_scores

SCHEMA = "doc_id long, text string, score string"


@pytest.fixture
def model():
    rng = np.random.default_rng(1)
    gru = Gru([9, 7, 5, 5, 3, 8, 0, 2], [0, 2, 4, 5, 8])
    gru.w = {k: (v + rng.normal(0, 0.7, v.shape)).astype(np.float32) for k, v in gru.w.items()}
    return gru


def softmax(logits):
    logits = np.clip(logits, -LOGIT, LOGIT)
    return np.exp(logits) / np.exp(logits).sum()


def plain_steps(gru, text):
    """log10 probability of a text, one step after the other, and of all rows at each step."""
    h, state, last, total, sums = HIDDEN, np.zeros(HIDDEN), gru.start, 0.0, []
    w = {k: v.astype(float) for k, v in gru.w.items()}
    for row in text:
        x, g = w["x"][last], state @ w["u"]
        f = 1 / (1 + np.exp(-(x[:h] + g[:h])))
        state = state + f * (np.tanh(x[h:] + f * g[h:]) - state)
        out = np.r_[state, 1.0]
        of_class = softmax(out @ w["c"])
        p = np.concatenate(
            [of_class[c] * softmax(w["w"][a:b] @ out) for c, (a, b) in enumerate(zip(gru.edges[:-1], gru.edges[1:]))]
        )
        total, last = total + math.log10(p[row]), row
        sums.append(p.sum())
    return total, sums


def test_scores_equal_plain_steps(model):
    rng = random.Random(2)
    texts = [np.array(rng.choices(range(8), k=n), np.uint32) for n in (1, 2, 40, 7, 300, 1, 33, 64, 5, 12)]
    for got, text in zip(model.score(texts), texts):
        want, sums = plain_steps(model, text)
        assert got == pytest.approx(want, rel=1e-4)
        assert np.allclose(sums, 1)


def test_training_lowers_the_loss_by_the_true_gradient(model):
    text = np.array([0, 3, 1, 5, 7, 2, 4, 0, 1, 3] * 30, np.uint32)
    before = model.score([text])[0]
    model.train([text] * 20)
    assert model.score([text])[0] > before + 50


def rows_of(rng):
    rare = [f"rare{i}" for i in range(600)]
    rows = []
    for k in range(300):
        words = [rng.choice(["the", "of", "A", "to"]) for _ in range(rng.randint(0, 60))]
        rows.append((k, " ".join(words + rng.sample(rare, 4)), None))
    rows += [(None, None, None), (5, "the of", "x"), (5, "the of", "x"), (400, " \t\r\n", None), (401, "the " * 60_000, None)]
    return rows


def test_base_columns_and_repeated_runs(spark):
    rows = rows_of(random.Random(4))
    tokens = [(t or "").lower().split() + ["\n"] for _, t, _ in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _, _ in rows]
    counts = Counter(w for words, out in zip(tokens, held) if not out for w in words)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), out, len(words), sum(counts[w] > 0 for w in words), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 4))
        for (i, _, _), words, out in zip(rows, tokens, held)
    )
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(2)

    found = language_scores(spark, docs).collect()
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in found)
    assert got == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    again = language_scores(spark, docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    same = [r["score"] for r in found if r["doc_id"] == 5 and r["n_tokens"] == 3]
    assert len(same) == 2 and same[0] == pytest.approx(same[1])
