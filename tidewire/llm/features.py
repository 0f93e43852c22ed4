"""Sparse features of texts for the trained classifiers: hashed words,
statistics of a text's structure, and its metadata, as rows of (feature, value)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidewire.llm.core import (LOWER, SPACE, distinct_per_row, shingle_hashes, text_blocks, word_hashes,
                               words_of)

_U = np.uint64
#: Letters, digits and all bytes of non-ASCII characters make words.
GAP = np.ones(256, dtype=bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = GAP[128:] = False
BINS = 16
#: Binned statistics of ``structure`` plus the metadata column.
N_STATS = 10


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    run = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=run[1:])
    return run[off[1:]] - run[off[:-1]]


def _row_counts(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.float64)


def _is(*chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for s in chars for c in s]] = True
    return out


_SYMBOL, _UPPER, _SHOUT, _DIGIT = _is("#*$%&|<>"), np.zeros(256, bool), _is("!?"), np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT[48:58] = True


def structure(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of statistics per text, each in 0..1."""
    n = len(off) - 1
    size = np.maximum(1, np.diff(off))
    start, end, row = words_of(raw, off)
    words = _row_counts(row, n)
    per = np.maximum(1, words)
    h = word_hashes(raw, start, end)
    sh, srow, scount = distinct_per_row(*shingle_hashes(h, row, 3))
    again = np.bincount(srow, weights=np.where(scount > 1, scount, 0), minlength=n)
    dh, drow, _ = distinct_per_row(h, row)
    distinct = _row_counts(drow, n)
    same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    stutter = np.bincount(row[1:][same], minlength=n)
    # lines: cut after every newline, compared by their words' hashes
    cut = np.flatnonzero(raw == 10) + 1
    edge = np.unique(np.r_[off[:-1], cut[cut < len(raw)]]) if len(raw) else np.zeros(0, np.int64)
    line = np.searchsorted(edge, start, side="right") - 1
    if len(h):
        first = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (row[1:] != row[:-1])])
        place = (np.arange(len(h)) - np.repeat(first, np.diff(np.r_[first, len(h)]))).astype(np.uint64)
        lh = np.add.reduceat(h * (place * _U(2) + _U(1)), first)
        _, lrow, lcount = distinct_per_row(lh, row[first])
        lines = np.maximum(1, np.bincount(row[first], minlength=n))
        dup = np.bincount(lrow, weights=lcount - 1, minlength=n)
    else:
        lines, dup = np.ones(n), np.zeros(n)
    return np.stack([
        np.minimum(1, _per_row(_SYMBOL[raw], off) / per / 2),
        np.minimum(1, _per_row(_UPPER[raw], off) / size),
        np.minimum(1, _per_row(_SHOUT[raw], off) / per),
        np.minimum(1, _per_row(_DIGIT[raw], off) / size * 2),
        np.minimum(1, again / per),
        np.minimum(1, distinct / np.sqrt(per) / 16),
        np.minimum(1, dup / lines),
        np.minimum(1, stutter / per * 2),
        np.minimum(1, np.log2(1 + words) / 16),
    ], axis=1)


def feature_rows(batch: pa.RecordBatch, bits: int, meta: str | None = None,
                 binned: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, last row, row, feature, tf, words)`` for blocks of a
    batch with a ``text`` column: distinct hashed words of each row and their
    counts, then, as features from ``2 ** bits`` on with count 0, the bins of
    its statistics and of ``meta``; ``words`` has each row's number of words."""
    for i, j, raw, off in text_blocks(batch):
        n = j - i
        low = LOWER[raw]
        start, end, row = words_of(low, off, GAP)
        h = (word_hashes(low, start, end) >> _U(64 - bits)).astype(np.int64)
        key = np.sort((row << bits) | h)
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        tf = np.diff(np.r_[new, len(key)])
        key = key[new]
        rows, feats = key >> bits, key & ((1 << bits) - 1)
        words = np.bincount(row, minlength=n)
        if binned:
            s = structure(raw, off)
            if meta:
                m = batch.column(batch.schema.get_field_index(meta)).slice(i, n)
                m = np.array([-1.0 if v is None else float(v) for v in m.to_pylist()])
                m = np.where(m < 0, 1.0, np.minimum(14.5, np.log2(1 + np.maximum(0, m))) / 16)
            else:
                m = np.ones(n)
            s = np.c_[s, m]
            b = np.minimum(BINS - 1, (s * BINS).astype(np.int64))
            own = (1 << bits) + np.arange(N_STATS) * BINS + b
            rows = np.r_[rows, np.repeat(np.arange(n), N_STATS)]
            feats = np.r_[feats, own.ravel()]
            tf = np.r_[tf, np.zeros(n * N_STATS, np.int64)]
            order = np.argsort(rows, kind="stable")
            rows, feats, tf = rows[order], feats[order], tf[order]
        yield i, j, rows, feats, tf, words


FEATURE_ROWS = "doc_id long, features binary, counts binary, words long"


def feature_table(docs, bits: int, meta: str | None = None, binned: bool = True):
    """``docs(doc_id, text[, meta])`` as one row per document with its
    features (32-bit) and counts (32-bit) in binary columns."""
    def run(batches):
        for b in batches:
            ids, out = b.column(0).to_pylist(), []
            for i, j, rows, feats, tf, words in feature_rows(b, bits, meta, binned):
                cut = np.searchsorted(rows, np.arange(j - i + 1))
                for k in range(j - i):
                    a, z = cut[k], cut[k + 1]
                    out.append((ids[i + k], feats[a:z].astype("<i4").tobytes(), tf[a:z].astype("<i4").tobytes(),
                                int(words[k])))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.int64())], names=["doc_id", "features", "counts", "words"])
    return docs.mapInArrow(run, FEATURE_ROWS)


def _views(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The 32-bit integers of each value of a binary column, where they are: small copies
    would leave the driver's memory in pieces."""
    out = []
    for c in column.cast(pa.large_binary()).chunks:
        _, off, data = c.buffers()
        off = np.frombuffer(off, np.int64)[c.offset:c.offset + len(c) + 1].tolist()
        out += [np.frombuffer(data, "<i4", (b - a) // 4, a) if b > a else np.zeros(0, "<i4") for a, b in zip(off, off[1:])]
    return out


def labelled_sample(docs, labels, target: str, keep, limit: int, bits: int, meta: str | None = None,
                    binned: bool = True) -> list:
    """At most ``limit`` documents with a label for ``target`` among those
    that ``keep`` admits, chosen by a hash of their id, as feature rows on the
    driver (bounded by ``limit``)."""
    from pyspark.sql import functions as F
    chosen = (labels.select("doc_id", F.col(target).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & keep)
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect())
    if not chosen:
        return []
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["label"]) for r in chosen], "doc_id long, label int")
    cols = ["doc_id", "text", *([meta] if meta else [])]
    some = docs.select(*cols).join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    rows = feature_table(some, bits, meta, binned).toArrow()
    label = {r["doc_id"]: r["label"] for r in chosen}
    names = rows["doc_id"].to_pylist()
    often = Counter(names)
    feats, counts = (_views(rows[c]) for c in ("features", "counts"))
    order = sorted(range(len(names)), key=lambda i: (names[i], feats[i].tobytes() if often[names[i]] > 1 else b""))
    words = rows["words"].to_pylist()
    return [(names[i], feats[i], counts[i], words[i], label[names[i]]) for i in order]
