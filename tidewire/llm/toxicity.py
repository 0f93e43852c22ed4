"""Toxicity by cumulative-link ordinal regression.

Severity grades 0 < 1 < 2 < 3 share one weight vector over hashed words;
``P(grade > k) = sigma(f(x) - b_k)`` with ordered thresholds ``b_0 <= b_1 <= b_2``.
The expected severity is the sum of those probabilities.

Labels only say toxic or not, so the grades of training documents come from
the labelled sample itself: grade 0 is not toxic, and toxic documents are split
into three parts by how many of their words are markers, words found several
times as often in toxic documents as in others.

The model is fitted on the driver on at most ``max_train`` labelled documents,
chosen by a hash of their id; scoring is one pass over all documents, without a
shuffle.

Defined cases: a null or empty text has no features and gets the grade of the
thresholds alone; repeated rows are scored one by one; without labelled toxic
rows every severity is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import held_out
from tidewire.llm.features import feature_rows, labelled_sample

BITS, MAX_TRAIN, STEPS, GRADES = 18, 20_000, 400, 3
FOLDS, TEST_FOLD = 5, 0
MIN_DOCS, MARKER_RATIO = 4, 3.0
#: A word is a marker, and gets a weight, if its document share is that many times
#: as high in toxic documents as in others, and this many standard errors higher;
#: all other words say nothing and would only be learned by heart.
MIN_Z = 4.0


def marker_words(sample: list, size: int) -> np.ndarray:
    """The mask of the features that get a weight."""
    tox = np.zeros(size)
    rest = np.zeros(size)
    n_tox = n_rest = 0
    for _, f, _, _, label in sample:
        if label:
            tox[f] += 1
            n_tox += 1
        else:
            rest[f] += 1
            n_rest += 1
    ratio = ((tox + 0.1) / (n_tox + 1)) / ((rest + 0.1) / (n_rest + 1))
    both = (tox + rest) / max(1, n_tox + n_rest)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / max(1, n_tox) + 1 / max(1, n_rest)))
    z = (tox / max(1, n_tox) - rest / max(1, n_rest)) / error
    return (tox + rest >= MIN_DOCS) & (z >= MIN_Z) & (ratio >= MARKER_RATIO)


def grades_of(sample: list, marker: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Training grades: 0 if not toxic, else 1.. by the number of marker words."""
    many = np.array([c[marker[f]].sum() for _, f, c, _, _ in sample])
    y = np.array([s[4] for s in sample], dtype=np.int64)
    if y.any():
        cuts = np.quantile(many[y > 0], np.arange(1, grades) / grades)
        y = np.where(y > 0, 1 + np.searchsorted(cuts, many, side="left"), 0)
    return y


def cut_points(t: np.ndarray) -> np.ndarray:
    """Ordered thresholds: the first, then positive steps (exponentials)."""
    return t[0] + np.r_[0.0, np.cumsum(np.exp(t[1:]))]


def _values(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts).astype(np.float32)


def above(model: dict, f: np.ndarray) -> np.ndarray:
    """``P(grade > k)`` per text (rows) and k (columns)."""
    return 1 / (1 + np.exp(-np.clip(f[:, None] - cut_points(model["t"])[None, :], -40, 40)))


def fit(sample: list, bits: int = BITS, steps: int = STEPS, rate: float = 0.1, l2: float = 1e-5) -> dict:
    """Full-batch Adam on the negative log-likelihood of the grades; only the
    words with a weight are in the design matrix."""
    size = 1 << bits
    model = {"w": np.zeros(size, np.float32), "t": np.array([40.0] + [0.0] * (GRADES - 1))}
    if not any(s[4] for s in sample):
        return model
    known = marker_words(sample, size)
    y = grades_of(sample, known)
    share = np.clip((y > 0).mean(), 0.001, 0.999)
    model["t"][0] = np.log((1 - share) / share)
    n, own = len(sample), np.flatnonzero(known)
    column = np.full(size, -1)
    column[own] = np.arange(len(own))
    r = np.repeat(np.arange(n), [len(f[known[f]]) for _, f, _, _, _ in sample])
    f = column[np.concatenate([f[known[f]] for _, f, _, _, _ in sample])]
    x = np.concatenate([_values(c[known[f]]) for _, f, c, _, _ in sample])
    par = np.r_[np.zeros(len(own)), model["t"]]
    m, v, i = np.zeros(len(par)), np.zeros(len(par)), np.arange(n)
    for step in range(1, steps + 1):
        w, t = par[:len(own)], par[len(own):]
        p = np.c_[np.ones(n), above({"t": t}, np.bincount(r, weights=w[f] * x, minlength=n)), np.zeros(n)]
        slope = p * (1 - p)
        mass = np.maximum(1e-9, p[i, y] - p[i, y + 1])  # P(>= y) - P(>= y + 1)
        dz = -(slope[i, y] - slope[i, y + 1]) / mass / n
        db = np.zeros((n, GRADES + 2))
        db[i, y] = slope[i, y] / mass / n
        db[i, y + 1] = -slope[i, y + 1] / mass / n
        db = db[:, 1:-1].sum(axis=0)
        dt = np.r_[db.sum(), [db[j:].sum() * np.exp(t[j]) for j in range(1, GRADES)]]
        g = np.r_[np.bincount(f, weights=dz[r] * x, minlength=len(own)) + l2 * w, dt]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model["w"][own], model["t"] = par[:len(own)], par[len(own):]
    return model


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> dict:
    keep = ~held_out("doc_id", FOLDS, TEST_FOLD)
    return fit(labelled_sample(docs, labels, "toxic", keep, max_train, BITS, binned=False))


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs(doc_id, text)`` as ``doc_id, held_out, severity`` (0 to 3), the
    probabilities ``p_1 .. p_3`` of at least that grade, ``grade`` (the most
    likely) and ``toxic`` (grade 1 or more likelier than not)."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_train))  # 2**BITS floats

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for i, j, rows, feats, tf, _ in feature_rows(b, BITS, binned=False):
                m = shared.value
                p = above(m, np.bincount(rows, weights=m["w"][feats] * _values(tf), minlength=j - i))
                each = np.c_[np.ones(j - i), p] - np.c_[p, np.zeros(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(p.sum(axis=1)), *[pa.array(p[:, k]) for k in range(GRADES)],
                     pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0] >= 0.5)],
                    names=["doc_id", "severity", *[f"p_{k + 1}" for k in range(GRADES)], "grade", "toxic"])

    out = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, severity double, " + ", ".join(f"p_{k + 1} double" for k in range(GRADES))
             + ", grade int, toxic boolean")
    return out.withColumn("held_out", held_out("doc_id", FOLDS, TEST_FOLD))
