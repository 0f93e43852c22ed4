"""Language-model scores from a log-bilinear model.

The context, two preceding tokens, predicts a vector, ``sum_j C_j r(w_j)``, whose
dot product with a word's target vector plus its bias is the word's score.  The
vocabulary follows the counts: every word whose share of the training tokens is one
in ``SHARE`` or more, and one entry for all others, within which words share its
mass by their counts, plus one.  The words stand in classes by frequency, each with a
target vector and a bias of its own; a softmax over the classes times one over
the words of a class, matrix products for batches of different contexts, turns
scores into normalised probabilities: those of all words, seen or not, add up to one.

Training is noise-contrastive, for words and classes alike, and uses every training
document: each task runs stochastic gradients over its own blocks of documents,
starting from the same parameters, and the tasks' parameters are averaged in Spark;
``rounds`` times.

Word counts are exact counts of the whole corpus.  They are joined to the words of
bounded blocks of documents, never broadcast: a block carries its different words
once, so what is shuffled is words per block, not tokens.

Defined cases: a null text is empty and has the end token only; a null
``doc_id`` counts as the empty text in the fold; repeated rows count and are scored
one by one; words of equal counts stand in order of their text; a text of any length
is one document of a block, a word of any length one word; other columns than
``doc_id`` and ``text``, whatever their names, are left aside; an empty table gives
an empty result; without training documents N
and V are 0 and every word is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import LOWER, held_out, text_blocks, word_hashes, words_of, written

FOLDS, TEST_FOLD = 7, 2
#: The vocabulary holds the words with a share of the training tokens of one in so many
#: (so no more words than that, whatever the input) that occur so often at least.
SHARE, LEAST = 1 << 16, 5
#: Size of the vectors.
SIZE = 16
#: Noise samples shared by a batch, noise per data token, different triples of a batch, step, rounds of averaging.
SAMPLES, NOISE, BATCH, RATE, ROUNDS = 96, 12.0, 2048, 0.05, 2
#: Highest count of a triple in one step; triples of one context that stay together.
HEAVY, GROUP = 8, 32
#: Text bytes of a block.
BLOCK = 16 << 20
#: The end token; no word holds white space.
END_WORD = "\n"
_END_HASH = np.uint64(0)

_BLOCKS = ("block long, doc_ids array<long>, held array<boolean>, ends array<int>, tokens binary, "
           "words array<string>, counts array<long>")


def token_blocks(docs: DataFrame) -> DataFrame:
    """Documents gathered into blocks: token numbers local to the block, its
    different words, and how often each occurs in training documents."""

    class Block:
        def __init__(self):
            self.bytes, self.hashes, self.sizes, self.ids, self.held, self.words = 0, [], [], [], [], {}

        def add(self, ids, held, raw, off):
            low = LOWER[raw]
            start, end, row = words_of(low, off)
            h = word_hashes(low, start, end) | np.uint64(1)  # 0 is the end token
            u, first = np.unique(h, return_index=True)
            for k, a, z in zip(u.tolist(), start[first].tolist(), end[first].tolist()):
                if k not in self.words:
                    self.words[k] = low[a:z].tobytes().decode("utf-8", "replace")
            n = np.bincount(row, minlength=len(off) - 1)
            self.hashes.append(np.insert(h, np.cumsum(n), _END_HASH))
            self.sizes.append(n + 1)
            self.ids += ids
            self.held += held
            self.bytes += len(raw)

        def rows(self, number: int) -> pa.RecordBatch:
            h, ends = np.concatenate(self.hashes), np.cumsum(np.concatenate(self.sizes))
            u, local = np.unique(h, return_inverse=True)
            train = np.repeat(~np.array(self.held, bool), np.diff(np.r_[0, ends]))
            counts = np.bincount(local[train], minlength=len(u))
            words = [END_WORD if k == 0 else self.words[k] for k in u.tolist()]
            one = lambda v, t: pa.array([v], pa.list_(t))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), one(self.ids, pa.int64()), one(self.held, pa.bool_()),
                 one(ends.astype(np.int32), pa.int32()), pa.array([local.astype("<i4").tobytes()], pa.binary()),
                 one(words, pa.string()), one(counts, pa.int64())],
                names=["block", "doc_ids", "held", "ends", "tokens", "words", "counts"])

    def run(batches):
        block, number = Block(), TaskContext.get().partitionId() << 32
        for b in batches:
            ids, held = b.column(0).to_pylist(), b.column(2).to_pylist()
            for i, j, raw, off in text_blocks(b):
                block.add(ids[i:j], held[i:j], raw, off)
                if block.bytes >= BLOCK:
                    yield block.rows(number)
                    block, number = Block(), number + 1
        if block.ids:
            yield block.rows(number)

    return docs.select("doc_id", "text", held_out("doc_id", FOLDS, TEST_FOLD).alias("held")).mapInArrow(run, _BLOCKS)


# --- model ------------------------------------------------------------------

class Model:
    """Parameters in one vector: context vectors R, target vectors Q, context
    matrices C (two) and biases of the ``k`` words; target vectors and biases of
    their classes, runs of ``width`` words each, the square root of ``k``."""

    def __init__(self, flat: np.ndarray, k: int, d: int = SIZE):
        self.flat, self.k, self.d = flat, k, d
        self.width = max(1, int(np.ceil(np.sqrt(k))))
        self.n_classes = n = -(-k // self.width)
        at = np.cumsum([0, k * d, k * d, 2 * d * d, k, n * d, n])
        self.r, self.q, self.c, self.b, self.qc, self.bc = (flat[i:j] for i, j in zip(at, at[1:]))
        self.r, self.q, self.c = self.r.reshape(k, d), self.q.reshape(k, d), self.c.reshape(2, d, d)
        self.qc = self.qc.reshape(n, d)

    @staticmethod
    def length(k: int, d: int = SIZE) -> int:
        n = -(-k // max(1, int(np.ceil(np.sqrt(k)))))
        return 2 * k * d + 2 * d * d + k + n * d + n

    def class_share(self, share: np.ndarray) -> np.ndarray:
        return np.add.reduceat(share, np.arange(0, self.k, self.width))

    @classmethod
    def start(cls, share: np.ndarray, d: int = SIZE, seed: int = 3) -> Model:
        k, rng = len(share), np.random.default_rng(seed)
        m = cls(np.zeros(cls.length(k, d), np.float32), k, d)
        for own in (m.r, m.q, m.qc):
            own[:] = rng.normal(0, 0.1, own.shape)
        m.c[:] = np.eye(d) * 0.5
        m.b[:], m.bc[:] = np.log(share), np.log(m.class_share(share))
        return m

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.r[one] @ self.c[0] + self.r[two] @ self.c[1]

    def log_probs(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
        """Natural log of the normalised probabilities: of the word's class, times
        of the word in it.  Every different context meets all classes once, and the
        words of each class that follows it there."""
        u, back = np.unique((one.astype(np.int64) * self.k + two) * self.k + word, return_inverse=True)
        out = np.empty(len(u), np.float64)
        for i in range(0, len(u), chunk):
            out[i:i + chunk] = self._of_triples(u[i:i + chunk])
        return out[back]

    def _of_triples(self, triples: np.ndarray) -> np.ndarray:
        word, context = triples % self.k, triples // self.k
        first, which = _runs(context)
        p = self.predicted(context[first] // self.k, context[first] % self.k)
        kind = word // self.width
        s = p @ self.qc.T
        s += self.bc
        out = (s[which, kind] - _log_sum_exp(s)[which]).astype(np.float64)
        # words of one class in order of their contexts, each context once
        order = np.argsort(kind, kind="stable")
        cut = np.searchsorted(kind[order], np.arange(self.n_classes + 1))
        for c in np.flatnonzero(np.diff(cut)):
            at = order[cut[c]:cut[c + 1]]
            lo, hi = c * self.width, min((c + 1) * self.width, self.k)
            begins, row = _runs(which[at])
            s = p[which[at][begins]] @ self.q[lo:hi].T
            s += self.b[lo:hi]
            out[at] += s[row, word[at] - lo] - _log_sum_exp(s)[row]
        return out


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal values, and each place's run."""
    new = np.r_[True, values[1:] != values[:-1]][:len(values)]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _log_sum_exp(s: np.ndarray) -> np.ndarray:
    top = s.max(axis=1, keepdims=True)
    return np.log(np.exp(s - top).sum(axis=1)) + top[:, 0]


def _drawn_batches(triples: np.ndarray, weight: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Different triples with their counts in random order.  A triple with a high
    count comes several times with a share of it; triples of one context stay
    together in groups of ``GROUP`` or so, whose prediction is computed once."""
    parts = -(-weight // HEAVY)
    triples, weight = np.repeat(triples, parts), np.repeat((weight / parts).astype(np.float32), parts)
    first, which = _runs(triples // k)
    groups = -(-np.diff(np.r_[first, len(triples)]) // GROUP)
    group = (np.cumsum(groups) - groups)[which] + rng.integers(0, groups[which])
    order = np.argsort(rng.permutation(groups.sum())[group], kind="stable")
    return triples[order], weight[order]


def train_block(model: Model, squares: np.ndarray, share: np.ndarray, one, two, word, rng, rate: float = RATE) -> None:
    """One pass of noise-contrastive AdaGrad over the tokens of a block, words
    and classes at once.  Equal triples of context and word are one step with
    their count as weight."""
    k = model.k
    acc = Model(squares, k, model.d)
    share_c = model.class_share(share)
    base, base_c = (np.log(NOISE * x).astype(np.float32) for x in (share, share_c))
    mass_c = (NOISE * share_c).astype(np.float32)
    pick = np.cumsum(share)
    triples, weight = np.unique((one.astype(np.int64) * k + two) * k + word, return_counts=True)
    triples, weight = _drawn_batches(triples, weight, k, rng)

    def sums(index, grad):
        order = np.argsort(index, kind="stable")
        first, _ = _runs(index[order])
        return index[order][first], np.add.reduceat(grad[order], first)

    def step(own, sq, rows, g):
        g = g / total
        sq[rows] += g * g
        own[rows] += rate * g / np.sqrt(sq[rows] + 1e-8)
    for at in range(0, len(triples), BATCH):
        t, wt = triples[at:at + BATCH], weight[at:at + BATCH]
        w, context = t % k, t // k
        kind = w // model.width
        first, which = _runs(context)
        a, b = context[first] // k, context[first] % k
        total, seen = wt.sum(), np.add.reduceat(wt, first)[:, None]
        noise = np.minimum(np.searchsorted(pick, rng.random(SAMPLES)), k - 1)
        ra, rb = model.r[a], model.r[b]
        p = ra @ model.c[0] + rb @ model.c[1]
        pw, qw, qk, qn = p[which], model.q[w], model.qc[kind], model.q[noise]
        # data: pushed up by what it lacks; noise: pushed down by what it has
        up = wt / (1 + np.exp(np.einsum("ij,ij->i", pw, qw) + model.b[w] - base[w]))
        up_c = wt / (1 + np.exp(np.einsum("ij,ij->i", pw, qk) + model.bc[kind] - base_c[kind]))
        down = NOISE / SAMPLES * seen / (1 + np.exp(p @ -qn.T - (model.b[noise] - base[noise])))
        # of the classes the noise is not drawn but taken at its expectation
        down_c = mass_c * seen / (1 + np.exp(p @ -model.qc.T - (model.bc - base_c)))
        dp = np.add.reduceat(up[:, None] * qw + up_c[:, None] * qk, first) - down @ qn - down_c @ model.qc
        targets = sums(np.r_[w, noise], np.c_[np.r_[up[:, None] * pw, -(down.T @ p)], np.r_[up, -down.sum(axis=0)]])
        classes, g = sums(kind, np.c_[up_c[:, None] * pw, up_c])
        grad_c = np.c_[-(down_c.T @ p), -down_c.sum(axis=0)]
        grad_c[classes] += g
        contexts = sums(np.r_[a, b], np.r_[dp @ model.c[0].T, dp @ model.c[1].T])
        every = slice(None)
        step(model.c, acc.c, every, np.stack([ra.T @ dp, rb.T @ dp]))
        step(model.r, acc.r, *contexts)
        step(model.q, acc.q, targets[0], targets[1][:, :-1])
        step(model.b, acc.b, targets[0], targets[1][:, -1])
        step(model.qc, acc.qc, every, grad_c[:, :-1])
        step(model.bc, acc.bc, every, grad_c[:, -1])


def _classes(words: list[str], number: dict[str, int], k: int) -> np.ndarray:
    return np.array([number.get(w, k - 1) for w in words], np.int64)


def _contexts(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two tokens back; before a document stands its end token (class 0)."""
    one = np.r_[0, tokens[:-1]]
    begins = np.r_[0, ends[:-1]]
    one[begins[begins < len(one)]] = 0
    two = np.r_[0, one[:-1]]
    two[begins[begins < len(two)]] = 0
    return one, two


#: Numbers of a piece of the parameters, tasks whose pieces are added first.
PIECE, FAN = 4096, 256
_PIECES = "at int, near int, n long, sums binary"


def _piece(at: int, near: int, n: int, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([at], pa.int32()), pa.array([near], pa.int32()), pa.array([n], pa.int64()),
         pa.array([sums.tobytes()], pa.binary())], names=["at", "near", "n", "sums"])


def train(blocks: DataFrame, words: list[tuple[str, int]], total: int, rounds: int = ROUNDS) -> Model:
    """Fit on all training tokens.  ``words``: the vocabulary (end token
    first) with its counts.  The tasks' parameters travel in pieces of ``PIECE``
    numbers, which Spark adds up, by ``FAN`` tasks first and then all; one parameter
    vector reaches the driver a round."""
    k = len(words) + 1
    counts = np.array([c for _, c in words] + [max(0, total - sum(c for _, c in words))], np.float64) + 1
    share = counts / counts.sum()
    spark = blocks.sparkSession
    number = spark.sparkContext.broadcast({w: i for i, (w, _) in enumerate(words)})
    model = Model.start(share)

    def task(state, seed):
        def run(batches):
            flat = state.value.copy()
            m, squares, n, rng = Model(flat, k), np.zeros(len(flat), np.float32), 0, None
            for b in batches:
                for r in range(b.num_rows):
                    row = {c: b.column(c)[r] for c in ("block", "held", "ends", "tokens", "words")}
                    rng = rng or np.random.default_rng([seed, row["block"].as_py()])
                    ends = row["ends"].values.to_numpy().astype(np.int64)
                    tokens = _classes(row["words"].as_py(), number.value, k)[np.frombuffer(row["tokens"].as_py(), "<i4")]
                    one, two = _contexts(tokens, ends)
                    held = np.array(row["held"].as_py(), bool)
                    use = np.flatnonzero(np.repeat(~held, np.diff(np.r_[0, ends])))
                    if len(use):
                        train_block(m, squares, share, one[use], two[use], tokens[use], rng)
                        n += len(use)
            if n:
                near = TaskContext.get().partitionId() // FAN
                for i in range(0, len(flat), PIECE):
                    yield _piece(i // PIECE, near, n, n * flat[i:i + PIECE].astype(np.float64))
        return run

    def added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = whole = 0
        for b in batches:
            for r in range(b.num_rows):
                n += b.column(2)[r].as_py()
                whole = whole + np.frombuffer(b.column(3)[r].as_py())
        yield _piece(key[0].as_py(), key[1].as_py(), n, whole)

    for i in range(rounds):
        state = spark.sparkContext.broadcast(model.flat)  # bounded by SHARE and SIZE
        pieces = blocks.select("block", "held", "ends", "tokens", "words").mapInArrow(task(state, i), _PIECES)
        for key in (F.col("near"), F.lit(0).alias("near")):
            pieces = pieces.select("at", key, "n", "sums").groupBy("at", "near").applyInArrow(added, _PIECES)
        mean = pieces.collect()
        if mean:
            flat = np.zeros(len(model.flat), np.float32)
            for r in mean:
                flat[r["at"] * PIECE:(r["at"] + 1) * PIECE] = np.frombuffer(r["sums"]) / r["n"]
            model = Model(flat, k)
    return model


def lm_score(docs: DataFrame, share: int = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """``docs(doc_id, text)`` as ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score`` (log10)."""
    spark = docs.sparkSession
    blocks = written(token_blocks(docs.select("doc_id", "text")), "token-blocks")
    each = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("t")).select(
        F.col("t.words").alias("word"), F.col("t.counts").alias("c")).where("c > 0")
    counts = written(each.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(LEAST, -(-total // share))
    top = counts.where((F.col("word") != END_WORD) & (F.col("c") >= least)).orderBy(F.desc("c"), "word").collect()
    ends = counts.where(F.col("word") == END_WORD).first()
    words = [(END_WORD, ends["c"] if ends else 0)] + [(r["word"], r["c"]) for r in top]
    model = train(blocks, words, total, rounds)
    k = len(words) + 1
    other_tokens = total - sum(c for _, c in words)
    other_words = max(0, distinct - sum(c > 0 for _, c in words))
    number = spark.sparkContext.broadcast({w: i for i, (w, _) in enumerate(words)})
    state = spark.sparkContext.broadcast(model.flat)

    looked = blocks.select("block", F.posexplode("words").alias("at", "word")).join(counts, "word", "left").select(
        "block", "at", F.coalesce("c", F.lit(0)).alias("c"), "word")
    # only the vocabulary's words are needed by name, all others by their count
    looked = looked.select("block", "at", "c", F.when((F.col("c") >= least) | (F.col("word") == END_WORD), F.col("word")).alias("w"))

    def score(body: pa.Table, found: pa.Table) -> pa.Table:
        at = found["at"].to_numpy()
        c = np.zeros(len(at), np.int64)
        c[at] = found["c"].to_numpy()
        kind = np.full(len(at), k - 1, np.int64)
        named = found.filter(found["w"].is_valid())
        kind[named["at"].to_numpy()] = [number.value[w] for w in named["w"].to_pylist()]
        local = np.frombuffer(body["tokens"][0].as_py(), "<i4")
        ends = body["ends"][0].values.to_numpy().astype(np.int64)
        tokens = kind[local]
        one, two = _contexts(tokens, ends)
        p = Model(state.value, k).log_probs(one, two, tokens) / np.log(10)
        within = np.log10((c + 1) / (other_tokens + other_words + 1))  # of a word in the class of all others
        p = p + np.where(tokens == k - 1, within[local], 0)
        base = np.log10((c + 1) / (total + distinct + 1))[local]
        first = np.r_[0, ends[:-1]]
        n = len(ends)
        return pa.table({
            "doc_id": body["doc_ids"][0].values, "held_out": body["held"][0].values,
            "n_tokens": ends - first, "n_known": np.add.reduceat((c > 0)[local].astype(np.int64), first),
            "train_tokens": np.full(n, total, np.int64), "base_score": np.add.reduceat(base, first),
            "score": np.add.reduceat(p, first)})

    bodies = blocks.select(F.col("block").alias("body"), "doc_ids", "held", "ends", "tokens")
    return bodies.groupBy("body").cogroup(
        looked.groupBy("block")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")
