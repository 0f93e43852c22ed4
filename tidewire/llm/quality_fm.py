"""Quality classifier: a factorisation machine.

A text's score is ``sigma(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``
over hashed words (log counts, scaled to a fixed length), binned statistics of its
structure and its binned ``n_chars``.  The pairwise sum costs linear time by
``(sum v_i x_i)^2 - sum (v_i x_i)^2``, halved and summed over the factors.

The model is fitted on the driver with numpy on at most ``max_train`` labelled
documents, chosen by a hash of their id; scoring is one pass over all
documents, without a shuffle.  ``lang``, ``source`` and ``doc_id`` are no inputs.

Defined cases: a null or empty text is scored by its structure bins; a null
``n_chars`` has a bin of its own; a null ``doc_id`` counts as the empty text in
the fold; repeated rows are scored one by one; without labelled rows every
score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import held_out
from tidewire.llm.features import BINS, N_STATS, feature_rows, labelled_sample

BITS, FACTORS, MAX_TRAIN, EPOCHS = 16, 6, 12_000, 8
#: Length of a text's word vector against its statistics, and how much more a
#: rejected training document weighs than a kept one.
WORD_SCALE, REJECT_WEIGHT = 0.5, 3.0
#: Documents that must show a word before it gets weights.
MIN_DOCS = 8
#: Training documents whose words are counted together.
PORTION = 256
FOLDS, TEST_FOLD, THRESHOLD = 5, 0, 0.3


def values(rows, counts, n) -> np.ndarray:
    """Feature values: words scaled to length ``WORD_SCALE`` per text, statistics to length one."""
    word = counts > 0
    x = np.where(word, np.log1p(counts), 0).astype(np.float32)
    norm = np.sqrt(np.bincount(rows, weights=x * x, minlength=n))
    return np.where(word, WORD_SCALE * x / np.maximum(norm, 1e-9)[rows], 1 / np.sqrt(N_STATS)).astype(np.float32)


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` (1 or 2 columns deep) by sorted ``rows``."""
    out = np.zeros((n, *values.shape[1:]), dtype=np.float32)
    if len(rows):
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[rows[first]] = np.add.reduceat(values, first, axis=0)
    return out


def scores(model: dict, rows: np.ndarray, feats: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    vx = model["v"][feats] * x[:, None]
    pairs = 0.5 * (_sums(vx, rows, n) ** 2 - _sums(vx * vx, rows, n)).sum(axis=1)
    z = model["w0"] + _sums(model["w"][feats] * x, rows, n) + pairs
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def fit(sample: list, bits: int = BITS, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7,
        rate: float = 0.1, l2: float = 1e-4, batch: int = 64) -> dict:
    """AdaGrad on the log loss, in mini-batches."""
    size = (1 << bits) + N_STATS * BINS
    rng = np.random.default_rng(seed)
    model = {"w0": 0.0, "w": np.zeros(size, np.float32),
             "v": rng.normal(0, 0.05, (size, factors)).astype(np.float32)}
    if not sample:
        model["v"][:] = 0
        return model
    df = np.zeros(size, np.int64)
    for at in range(0, len(sample), PORTION):
        df += np.bincount(np.concatenate([s[1] for s in sample[at:at + PORTION]]), minlength=size)
    known = df >= min(MIN_DOCS, max(1, len(sample) // 100))
    model["v"][~known] = 0
    y = np.array([s[4] for s in sample], dtype=np.float64)
    mean = float(np.clip(y.mean(), 0.01, 0.99))
    model["w0"] = float(np.log(mean / (1 - mean)))
    # two arrays for all texts, a text's features from ``edge`` on
    edge = np.r_[0, np.cumsum([np.count_nonzero(known[s[1]]) for s in sample])]
    feats, xs = np.empty(edge[-1], np.int32), np.empty(edge[-1], np.float32)
    for i, (_, f, c, _, _) in enumerate(sample):
        ok = known[f]
        feats[edge[i]:edge[i + 1]] = f[ok]
        xs[edge[i]:edge[i + 1]] = values(np.zeros(len(f), np.int64), c, 1)[ok]
    gw, gv, g0 = np.full(size, 1e-6, np.float32), np.full((size, factors), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(sample))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            f = np.concatenate([feats[edge[k]:edge[k + 1]] for k in pick]).astype(np.int64)
            x = np.concatenate([xs[edge[k]:edge[k + 1]] for k in pick])
            r = np.repeat(np.arange(len(pick)), edge[pick + 1] - edge[pick])
            heavy = np.where(y[pick] > 0, 1.0, REJECT_WEIGHT)
            err = ((scores(model, r, f, x, len(pick)) - y[pick]) * heavy).astype(np.float32) / len(pick)
            total = _sums(model["v"][f] * x[:, None], r, len(pick))
            ex = err[r] * x
            dv = ex[:, None] * (total[r] - model["v"][f] * x[:, None])
            u, inv = np.unique(f, return_inverse=True)
            sw = np.bincount(inv, weights=ex, minlength=len(u)).astype(np.float32) + l2 * model["w"][u]
            sv = np.stack([np.bincount(inv, weights=dv[:, k], minlength=len(u)) for k in range(factors)],
                          axis=1).astype(np.float32) + l2 * model["v"][u]
            gw[u] += sw * sw
            gv[u] += sv * sv
            model["w"][u] -= rate * sw / np.sqrt(gw[u])
            model["v"][u] -= 0.5 * rate * sv / np.sqrt(gv[u])
            g0 += float(err.sum()) ** 2
            model["w0"] -= rate * float(err.sum()) / np.sqrt(g0)
    return model


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", max_train: int = MAX_TRAIN) -> dict:
    """Fit on labelled documents outside the held-out fold."""
    keep = ~held_out("doc_id", FOLDS, TEST_FOLD)
    return fit(labelled_sample(docs, labels, target, keep, max_train, BITS, "n_chars"))


def score_quality(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``docs(doc_id, text, n_chars)`` as ``doc_id, score, predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS rows, whatever the corpus

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for i, j, rows, feats, tf, _ in feature_rows(b, BITS, "n_chars"):
                s = scores(shared.value, rows, feats, values(rows, tf, j - i), j - i)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text", "n_chars").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_quality(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all its columns) whose text scores ``threshold``
    at least, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            kept = np.zeros(b.num_rows, dtype=bool)
            for i, j, rows, feats, tf, _ in feature_rows(b, BITS, "n_chars"):
                kept[i:j] = scores(shared.value, rows, feats, values(rows, tf, j - i), j - i) >= threshold
            yield b.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted``."""
    scored = score_quality(docs, train(docs, labels, max_train=max_train))
    return scored.select("doc_id", held_out("doc_id", FOLDS, TEST_FOLD).alias("held_out"), "score", "predicted")
