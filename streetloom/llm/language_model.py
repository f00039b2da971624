"""Log-likelihood of documents under a gated recurrent language model, trained here.

Tokens are words and one end of each document.  Documents are read in blocks of some million
tokens; a block carries its own list of words, so the counts of all training tokens are
gathered and given back once per block and word, not once per token.

The output softmax is factored into classes: P(token) = P(class | state) P(row | class, state)
P(word | row).  The most frequent words have rows of their own; their number grows with the cube
root of the vocabulary, and they fill classes of equal size.  All other words fall into one class
per power of two of their count; within it a hash deals them to rows, whose number again grows
with the cube root of the words of the class, and words of one row share its probability by their
counts.  Rows have weights of their own, as input and as output.  All words without a count are
one word of count one in the first row of the rarest class, so all probabilities add up to one
over the training vocabulary and that word.

Training is one pass over all training documents by truncated backpropagation through a
gated recurrent unit in numpy.  The pass is cut into rounds; in each, every block is trained on
from the same start, and the weights are averaged by the tokens they saw.  The sums are those of
whole numbers, so their order does not matter, and blocks are named by partition and place:
the same table, read in the same partitions, gives the same scores again.  The state of the unit
is carried from window to window of a text, in training and in scoring, where documents run side
by side.

The model, with its rows, is sent to all tasks; word counts never are.

Defined results: a null text counts as empty and has the one token end; a null doc_id counts as
the empty text for the choice of training documents; repeated rows are trained and scored
each; without training documents all scores follow from the smoothed classes; an empty table
gives an empty result.
"""

from __future__ import annotations

import copy

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.common import release, staged

END = b"\n"  # no word holds white space
#: Tokens of a block, a little less or one document more.
BLOCK = 3_000_000
#: Words with a row of their own, and rows of a class of rarer words, for a cube root of one.
HEAD, TAIL = 16, 2
HIDDEN = 16
#: Tokens of a stream (streams are trained side by side) and steps of backpropagation.
STREAM, STEPS = 1_000, 16
ROUNDS = 2
RATE = 0.25
#: What squared gradients are added to, against long first steps.
CALM = 1e-9
#: Bound of a logit.
LOGIT = 60
#: Steps of a scoring window, and tokens if few texts are left.
WINDOW, LEAST = 32, 4_096
#: Weights are summed as whole numbers of this part, and by these many tokens.
PART, SHARE = 2.0**-20, 1_024

_DOCS = "doc_ids array<{key}>, held array<boolean>, sizes array<int>"


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.astype(np.uint32).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), np.uint32)


def _blocks(docs: DataFrame, key: str) -> DataFrame:
    """Rows of two kinds: documents with block-local token numbers, and the block's words."""

    def rows(block, ids, held, sizes, tokens, local):
        numbers = np.concatenate(tokens)
        trained = np.repeat(~np.array(held), sizes)
        counts = np.bincount(numbers[trained], minlength=len(local))
        names = ["block", "doc_ids", "held", "sizes", "tokens", "words", "counts"]
        kinds = [
            pa.int64(), pa.list_(ids.type), pa.list_(pa.bool_()), pa.list_(pa.int32()),
            pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()),
        ]
        values = [
            [block, ids.to_pylist(), held, sizes, _packed(numbers), None, None],
            [block, None, None, None, None, list(local), counts.tolist()],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*values, strict=True), kinds, strict=True)],
            names=names,
        )

    def run(batches):
        ids, held, sizes, tokens, local, total = [], [], [], [], {}, 0
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch.column(2)[row].as_py() or b""
                words = text.lower().split()  # bytes: lowers A-Z, splits at ASCII white space
                words.append(END)
                number = local.setdefault
                found = np.fromiter((number(w, len(local)) for w in words), np.uint32, len(words))
                ids.append(batch.column(0).slice(row, 1))
                held.append(batch.column(1)[row].as_py())
                sizes.append(len(found))
                tokens.append(found)
                total += len(found)
                if total >= BLOCK:
                    yield rows(block, pa.concat_arrays(ids), held, sizes, tokens, local)
                    block += 1
                    ids, held, sizes, tokens, local, total = [], [], [], [], {}, 0
        if ids:
            yield rows(block, pa.concat_arrays(ids), held, sizes, tokens, local)

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows_in = docs.select(
        "doc_id", (F.crc32(name) % 7 == 2).alias("held"), F.col("text").cast("binary")
    )
    return rows_in.mapInArrow(
        run,
        f"block long, {_DOCS.format(key=key)}, tokens binary, words array<binary>, "
        "counts array<long>",
    )


class Gru:
    """The model: weights, one training step, and scores of whole texts."""

    def __init__(self, counts, edges, seed: int = 7):
        """``counts`` of the rows; rows ``edges[k]`` to ``edges[k + 1]`` are class k."""
        counts, h = np.asarray(counts, float), HIDDEN
        rng = np.random.default_rng(seed)
        self.edges, self.start = np.asarray(edges), len(counts)
        self.classes = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        self.w = {
            "x": rng.normal(0, 0.1, (self.start + 1, 2 * h)),
            "u": rng.normal(0, h**-0.5 / 2, (h, 2 * h)),
            "c": np.zeros((h + 1, len(edges) - 1)),
            "w": np.zeros((self.start, h + 1)),
        }
        # the last weight is the bias: a share of the tokens, of the class
        sums = np.add.reduceat(counts, self.edges[:-1])
        self.w["c"][-1] = np.log((sums + 0.5) / (sums + 0.5).sum())
        self.w["w"][:, -1] = np.log((counts + 0.5) / (sums + 0.5)[self.classes])
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.w.values()])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for k, v in self.w.items():
            self.w[k] = vector[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def run(self, inputs, fresh, state, keep: bool):
        """States after each step and a one (T, B, H + 1), the last state, and with ``keep``
        what backpropagation needs.

        The unit has one gate: f = sigmoid(x_f + h U_f), n = tanh(x_n + f * h U_n),
        h' = h + f * (n - h).
        """
        h, u, x = HIDDEN, self.w["u"], self.w["x"][inputs]
        states = np.ones((*inputs.shape, h + 1), np.float32)
        saved = []
        for t in range(len(inputs)):
            if fresh is not None:
                state = state * fresh[t][:, None]
            g = state @ u
            f = g[:, :h] + x[t, :, :h]
            np.exp(np.negative(f, out=f), out=f)
            f += 1
            np.reciprocal(f, out=f)
            gn = g[:, h:]
            n = f * gn
            n += x[t, :, h:]
            np.tanh(n, out=n)
            if keep:
                saved.append((state, f, n, gn))
            state = state + f * (n - state)
            states[t, :, :h] = state
        return states, state, saved

    def outputs(self, states, targets, weight=None, update=None):
        """Log-probabilities (natural) of target rows; logits are held within ``LOGIT``.

        With ``weight``, ``update(name, part, gradient)`` gets the gradients of the output
        weights, and those of the states are returned.
        """

        def softmax(s, words, spot, weight):
            logits = s @ words
            np.clip(logits, -LOGIT, LOGIT, out=logits)
            own = np.arange(len(spot))
            found = logits[own, spot] if weight is None else None
            p = np.exp(logits, out=logits)
            total = p @ np.ones(p.shape[1], np.float32)
            if weight is None:
                return found - np.log(total), None
            p *= (weight / total)[:, None]
            p[own, spot] -= weight
            return None, p

        cls = self.classes[targets]
        found, p = softmax(states, self.w["c"], cls, weight)
        if weight is None:
            found = found.astype(np.float64)
        else:
            d_states = p @ self.w["c"].T
            update("c", ..., states.T @ p)
        # few classes sort fastest by radix
        order = np.argsort(cls.astype(np.uint16) if len(self.edges) < 2**16 else cls, kind="stable")
        bounds = np.searchsorted(cls[order], np.arange(len(self.edges)))
        dealt, spots = states[order], targets[order]
        for c in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[c], bounds[c + 1])
            at, span = order[part], slice(self.edges[c], self.edges[c + 1])
            words, s, spot = self.w["w"][span], dealt[part], spots[part] - self.edges[c]
            more, p = softmax(s, words.T, spot, None if weight is None else weight[at])
            if weight is None:
                found[at] += more
            else:
                dealt[part], gradient = p @ words, p.T @ s
                update("w", span, gradient)
        if weight is None:
            return found
        d_states[order] += dealt
        return d_states

    def learn(self, window, state, sums, used):
        """One step on a window (T, B); returns the state that the next window starts with.

        ``used`` are the input rows of the block, which the window's ``spots`` count.
        """
        inputs, spots, targets, fresh, weight = window
        h, u = HIDDEN, self.w["u"]

        def update(name, part, gradient):
            total = sums[name][part] + gradient * gradient
            sums[name][part] = total
            self.w[name][part] -= RATE * gradient / np.sqrt(total)

        states, last, saved = self.run(inputs, fresh, state, keep=True)
        scale = (weight / max(weight.sum(), 1)).astype(np.float32).ravel()
        d_states = self.outputs(states.reshape(-1, h + 1), targets.ravel(), scale, update)
        d_states = d_states.reshape(states.shape)
        d_x = np.empty((*inputs.shape, 2 * h), np.float32)
        d_u, d_next = np.zeros_like(u), np.zeros_like(last)
        for t in range(len(inputs) - 1, -1, -1):
            old, f, n, gn = saved[t]
            d = d_states[t, :, :h] + d_next
            d_f = d * (n - old)
            d_n = d * f
            d -= d_n
            d_n *= 1 - n * n
            d_f += d_n * gn
            d_f *= f * (1 - f)
            d_x[t, :, :h], d_x[t, :, h:] = d_f, d_n
            d_n *= f
            d_u[:, :h] += old.T @ d_f
            d_u[:, h:] += old.T @ d_n
            d += d_f @ u[:, :h].T
            d += d_n @ u[:, h:].T
            d *= fresh[t][:, None]
            d_next = d
        cells = spots.reshape(-1, 1) * (2 * h) + np.arange(2 * h)
        rows = np.bincount(cells.ravel(), d_x.ravel(), len(used) * 2 * h)
        update("x", used, rows.reshape(len(used), -1).astype(np.float32))
        update("u", ..., d_u)
        return last

    def train(self, texts: list[np.ndarray]) -> int:
        """One pass over texts, side by side in streams; returns the number of tokens."""
        if not texts:
            return 0
        sums = {k: np.full_like(v, CALM) for k, v in self.w.items()}
        targets = np.concatenate(texts).astype(np.int64)
        inputs = np.r_[self.start, targets[:-1]]
        starts = np.cumsum([0, *map(len, texts)])[:-1]
        inputs[starts] = self.start
        fresh = np.ones(len(targets), np.float32)
        fresh[starts] = 0
        streams = -(-len(targets) // STREAM)
        long = -(-len(targets) // streams)
        pad = long * streams - len(targets)
        weight = np.r_[np.ones(len(targets), np.float32), np.zeros(pad, np.float32)]
        inputs, targets = np.r_[inputs, np.zeros(pad, int)], np.r_[targets, np.zeros(pad, int)]
        fresh = np.r_[fresh, np.zeros(pad, np.float32)]
        used, spots = np.unique(inputs, return_inverse=True)
        columns = [a.reshape(streams, long).T for a in (inputs, spots, targets, fresh, weight)]
        state = np.zeros((streams, HIDDEN), np.float32)
        for at in range(0, long, STEPS):
            window = [np.ascontiguousarray(c[at : at + STEPS]) for c in columns]
            state = self.learn(window, state, sums, used)
        return int(weight.sum())

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text; texts run side by side, the longest first."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        sizes = np.array([len(texts[i]) for i in order])
        starts = np.cumsum([0, *sizes])[:-1]
        flat = np.concatenate([texts[i] for i in order]).astype(np.int64)
        found = np.zeros(len(flat))
        state = np.zeros((len(texts), HIDDEN), np.float32)
        at = 0
        while at < sizes[0]:
            live = int((sizes > at).sum())
            steps = min(max(WINDOW, LEAST // live), int(sizes[0]) - at)
            spots = np.arange(at, at + steps)[:, None]
            inside = spots < sizes[None, :live]
            places = starts[None, :live] + np.minimum(spots, sizes[None, :live] - 1)
            inputs = np.where(spots > 0, flat[np.maximum(places - 1, 0)], self.start)
            states, state, _ = self.run(inputs, None, state[:live], keep=False)
            used = places[inside]
            found[used] = self.outputs(states[inside], flat[used])
            at += steps
        out = np.empty(len(texts))
        out[order] = np.add.reduceat(found, starts) / np.log(10)
        return out


def _split(row) -> list[np.ndarray]:
    return np.split(_unpacked(row["tokens"]), np.cumsum(row["sizes"])[:-1])


def _averaged(spark, coded: DataFrame, model: Gru, part: int) -> np.ndarray:
    """Weights after a round of training on the documents of ``part``, averaged over blocks."""
    start = spark.sparkContext.broadcast(model)

    def run(batches):
        shares, sums = 0, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                own = copy.deepcopy(start.value)
                texts = _split(row)
                seen = own.train(
                    [t for i, t in enumerate(texts) if not row["held"][i] and i % ROUNDS == part]
                )
                if seen:
                    share = -(-seen // SHARE)
                    whole = np.rint(own.vector() / PART).astype(np.int64) * share
                    shares, sums = shares + share, whole if sums is None else sums + whole
        if shares:
            yield pa.RecordBatch.from_arrays(
                [pa.array([shares], pa.int64()), pa.array([sums], pa.list_(pa.int64()))],
                names=["shares", "sums"],
            )

    made = coded.select("held", "sizes", "tokens").mapInArrow(run, "shares long, sums array<long>")
    rows = made.select("shares", F.posexplode("sums").alias("at", "w")).groupBy("at").agg(
        F.sum("w").alias("w"), F.sum("shares").alias("shares")
    )
    table = rows.toArrow()  # one row per weight of the model
    vector = model.vector().astype(np.float64)
    mean = table["w"].to_numpy() / table["shares"].to_numpy()
    vector[table["at"].to_numpy()] = mean * PART
    return vector


def language_scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: counts, the unigram base score and the score of the model."""
    paths: list = []
    key = docs.schema["doc_id"].dataType.simpleString()
    blocks = staged(spark, _blocks(docs, key), "blocks", paths)
    listed = blocks.where("words is not null").select(
        "block", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "w")
    )
    counts = listed.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("c"))
    counts = staged(spark, counts, "counts", paths)
    power = F.when(F.col("c") <= 1, 0).otherwise(F.length(F.bin("c")) - 1)
    trained = counts.where("c > 0")
    n, v = trained.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    most = int(np.ceil(HEAD * v ** (1 / 3)))
    head = trained.orderBy(F.desc("c"), "word").limit(most).toArrow()
    first, size = head.num_rows, max(1, round(most**0.5))
    ranks = pa.table({"word": head["word"], "rank": pa.array(range(first), pa.int32())})
    ranks = F.broadcast(spark.createDataFrame(ranks))  # most rows, a cube root of all words
    placed = trained.join(ranks, "word", "left").select("word", "c", "rank", power.alias("p"))
    rare = placed.where("rank is null")
    types = {r["p"]: r["n"] for r in rare.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    widths = [max(1, round(TAIL * types.get(p, 0) ** (1 / 3))) for p in range(max(types, default=0) + 1)]
    starts = first + np.cumsum([0, *widths])
    edges = np.unique([*range(0, first, size), *starts])
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("p") + 1)
    begin = F.element_at(F.array(*[F.lit(int(x)) for x in starts[:-1]]), F.col("p") + 1)
    dealt = (begin + F.pmod(F.xxhash64("word"), width)).cast("int")
    known = placed.select("word", "c", F.coalesce("rank", dealt).alias("token"))
    known = staged(spark, known, "known", paths)
    sums = known.groupBy("token").agg(F.sum("c").alias("c")).toArrow()  # one row per model row
    totals = np.zeros(starts[-1], np.int64)
    totals[sums["token"].to_numpy()] = sums["c"].to_numpy()
    totals[first] += 1  # words without a count
    model = Gru(totals, edges)
    given = (
        listed.select("block", "number", F.col("w.words").alias("word"))
        .join(known, "word", "left")
        .select(
            F.col("block").alias("of"), "number", F.coalesce("c", F.lit(0)).alias("c"),
            F.coalesce("token", F.lit(first)).alias("token"),
        )
    )

    def attach(rows: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        count = np.zeros(len(given), np.int64)
        token = np.zeros(len(given), np.uint32)
        count[given["number"]], token[given["number"]] = given["c"], given["token"]
        out = []
        for row in rows.to_dict("records"):
            numbers = _unpacked(row["tokens"])
            starts = np.cumsum([0, *row["sizes"]])[:-1]
            base = np.log10((count + 1) / (n + v + 1))[numbers]
            inner = np.log10(np.maximum(count, 1) / totals[token])[numbers]
            out.append(
                {
                    "doc_ids": row["doc_ids"], "held": row["held"], "sizes": row["sizes"],
                    "known": np.add.reduceat((count > 0)[numbers].astype(np.int64), starts),
                    "base": np.add.reduceat(base, starts),
                    "inner": np.add.reduceat(inner, starts), "tokens": _packed(token[numbers]),
                }
            )
        columns = ["doc_ids", "held", "sizes", "known", "base", "inner", "tokens"]
        return pd.DataFrame(out, columns=columns)

    whole = blocks.where("tokens is not null").select("block", "doc_ids", "held", "sizes", "tokens")
    coded = whole.groupBy("block").cogroup(given.groupBy("of")).applyInPandas(
        attach,
        f"{_DOCS.format(key=key)}, known array<long>, base array<double>, inner array<double>, "
        "tokens binary",
    )
    coded = staged(spark, coded, "coded")
    release(spark, paths)
    for part in range(ROUNDS):
        model.load(_averaged(spark, coded, model, part))
    final = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                held, sizes, known, base, inner = (
                    row.column(c).flatten() for c in ("held", "sizes", "known", "base", "inner")
                )
                texts = _split(row.select(["tokens", "sizes"]).to_pylist()[0])
                score = pa.array(final.value.score(texts) + inner.to_numpy(), pa.float64())
                total = pa.array(np.full(len(texts), n), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        row.column("doc_ids").flatten(), held, sizes.cast(pa.int64()), known,
                        total, base, score,
                    ],
                    names=[
                        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                        "base_score", "score",
                    ],
                )

    return coded.mapInArrow(
        run,
        f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double",
    )
