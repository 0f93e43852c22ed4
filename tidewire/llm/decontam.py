"""Benchmark decontamination by q-gram lemma filtering.

An item of length m that stands in a text with at most e edits shares
``m - q + 1 - q e`` of its character q-grams with the text at least, and all of
them lie on diagonals (text place minus item place) at most e apart.  So the
shared q-grams of a document are counted, per item, in overlapping bands of
diagonals, each wide enough to hold such an alignment whole; a band below the
bound cannot hold one, a band that reaches it is verified by banded alignment,
together with those that overlap it.  Runs of one q-gram (blanks, one letter) are counted as
intervals, not place by place, and all counting is done in portions of bounded size.

Texts and items are compared as bytes, A-Z lower-cased and every white space
byte as a space.  The edit budget is ``RATE`` of the item's length, less for items
too short for the bound to stay positive; an item shorter than ``q`` must occur
exactly.

The documents are read in one pass without a shuffle.  The items go to the
executors in parts of at most ``PART_BYTES`` of text, one pass over the
documents for each, so no size of the benchmark table is assumed.

Defined cases: null or blank items match nothing; a null or blank text holds no
item; equal items are found each for itself; repeated documents are searched one by one; of
places with equally few edits the first one counts; a very long text is searched whole, as a
block of its own; columns besides the named ones are not read by ``contaminated`` and kept by
``drop_contaminated``, whatever their names; an empty table on either side gives an empty
result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import LOWER, SPACE, text_blocks, written

Q, RATE, LEAST = 12, 0.06, 8
PART_BYTES = 16 << 20
#: Longest run of one q-gram in a text, entries counted at a time, and diagonals aligned together.
CUT, ENTRIES, WIDE = 4096, 1 << 19, 1 << 16

_U = np.uint64
_FOLD = LOWER.copy()
_FOLD[SPACE] = 32
_FOLD[0] = 32  # so that 0 is free as the mark between texts


def fold(text: bytes) -> bytes:
    return _FOLD[np.frombuffer(text, np.uint8)].tobytes()


def gram_keys(raw: np.ndarray) -> np.ndarray:
    """A 64-bit key of the Q bytes from each place on."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    two = raw[:-1].astype(np.uint64) | (raw[1:].astype(np.uint64) << _U(8))
    four = two[:-2] | (two[2:] << _U(16))
    eight = four[:n] | (four[4:4 + n] << _U(32))
    return (eight ^ (four[8:8 + n] * _U(0xC2B2AE3D27D4EB4F))) * _U(0x9E3779B97F4A7C15)


def edit_budget(m: int, q: int = Q, rate: float = RATE, least: int = LEAST) -> int:
    """Edits allowed in an item of length m: ``rate`` of it, as long as ``least`` shared q-grams are asked for."""
    return max(0, min(int(rate * m), (m - q + 1 - least) // q))


def _steps(n: np.ndarray) -> np.ndarray:
    """``0 .. n[0] - 1, 0 .. n[1] - 1, ...``"""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


class Items:
    """The q-grams of a part of the benchmark, sorted by key."""

    def __init__(self, items: list[tuple[int, str]]):
        folded = [(i, fold((t or "").encode())) for i, t in items]
        folded = sorted((i, t) for i, t in folded if t.strip())
        self.short = [(i, t) for i, t in folded if len(t) < Q]
        self.ids = [i for i, t in folded if len(t) >= Q]
        self.texts = [t for _, t in folded if len(t) >= Q]
        self.size = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.budget = np.array([edit_budget(len(t)) for t in self.texts], dtype=np.int64)
        self.need = self.size - Q + 1 - Q * self.budget
        self.step = self.budget + 1  # bands start at its multiples and are two steps wide
        keys = [gram_keys(np.frombuffer(t, np.uint8)) for t in self.texts]
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        place = np.concatenate([np.arange(len(k)) for k in keys]) if keys else np.zeros(0, np.int64)
        # places that follow each other with one and the same q-gram are one entry
        order = np.argsort(key, kind="stable")
        key, item, place = key[order], item[order], place[order]
        opens = np.ones(len(key), bool)
        opens[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1)
        entry = np.flatnonzero(opens)
        self.item, self.place, self.run = item[entry], place[entry], np.diff(np.r_[entry, len(key)])
        self.key, self.first, self.count = np.unique(key[entry], return_index=True, return_counts=True)
        #: The bytes of a text that a band reaches over at most.
        self.span = int((2 * self.step + self.size).max()) if len(self.ids) else 0
        # one byte per slot says whether any key falls there: most places of a text end here
        self.bits = max(16, min(27, int(16 * len(self.key) + 1).bit_length()))
        self.slot = np.zeros(1 << self.bits, dtype=bool)
        self.slot[(self.key >> _U(64 - self.bits)).astype(np.int64)] = True

    def shared(self, low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text place, key number, length)`` of the text's q-grams that items have; places
        that follow each other with one q-gram are one run, cut after ``CUT``."""
        key = gram_keys(low)
        at = np.flatnonzero(self.slot[(key >> _U(64 - self.bits)).astype(np.int64)])
        k = np.searchsorted(self.key, key[at])
        ok = (k < len(self.key)) & (self.key[np.minimum(k, max(0, len(self.key) - 1))] == key[at]) \
            if len(self.key) else np.zeros(len(at), bool)
        ok &= at + Q <= off[np.searchsorted(off, at, side="right").clip(max=len(off) - 1)]  # within one text
        at, k = at[ok], k[ok]
        opens = np.ones(len(at), bool)
        opens[1:] = (k[1:] != k[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(opens)
        run = np.diff(np.r_[first, len(at)])
        pieces = -(-run // CUT)
        behind = CUT * _steps(pieces)
        return (np.repeat(at[first], pieces) + behind, np.repeat(k[first], pieces),
                np.minimum(CUT, np.repeat(run, pieces) - behind))

    def counted(self, pos: np.ndarray, key: np.ndarray, run: np.ndarray, off: np.ndarray):
        """``(row, item, band)`` of the bands that reach the bound with these runs.  A run
        of the text and one of an item share, in a band, an interval of item places; what counts is
        the length of the intervals' union."""
        n = self.count[key]
        entry = np.repeat(self.first[key], n) + _steps(n)
        row = np.searchsorted(off, pos, side="right") - 1
        p, last, row = np.repeat(pos - off[row], n), np.repeat(run - 1, n), np.repeat(row, n)
        item, place, more = self.item[entry], self.place[entry], self.run[entry] - 1
        step = self.step[item]
        low_band = (p - place - more) // step - 1  # a diagonal lies in two bands that overlap
        n = (p + last - place) // step - low_band + 1
        band = np.repeat(low_band, n) + _steps(n)
        p, last, row, item, place, more, step = (np.repeat(v, n) for v in (p, last, row, item, place, more, step))
        lo = np.maximum(place, p - (band + 2) * step + 1)
        hi = np.minimum(place + more, p + last - band * step)
        order = np.lexsort((lo, band, item, row))
        row, item, band, lo, hi = (v[order] for v in (row, item, band, lo, hi))
        if not len(row):
            return row, item, band
        opens = np.ones(len(row), bool)
        opens[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        base = (np.cumsum(opens) - 1) * (int(self.size.max()) + 1)  # above every place of the group before
        reach = np.maximum.accumulate(base + hi)
        before = np.r_[-1, reach[:-1]]
        fresh = np.maximum(0, base + hi - np.maximum(base + lo - 1, before))
        first = np.flatnonzero(opens)
        hit = first[np.add.reduceat(fresh, first) >= self.need[item[first]]]
        return row[hit], item[hit], band[hit]

    def regions(self, low: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(row, item, first diagonal, last diagonal)`` of the bands that reach the bound;
        bands that overlap are one region, up to ``WIDE`` diagonals.  Runs are counted at
        most about ``ENTRIES`` entries at a time: each portion goes on as far as a band reaches that
        starts in it, so every band is whole in one of them."""
        pos, key, run = self.shared(low, off)
        cost = np.cumsum(self.count[key] * (2 + run // max(1, int(self.step.min(initial=1)))))
        found, begin = [], 0
        while begin < len(pos):
            end = max(begin + 1, int(np.searchsorted(cost, (cost[begin - 1] if begin else 0) + ENTRIES, side="right")))
            stop = int(np.searchsorted(pos, pos[end - 1] + self.span + CUT, side="right"))
            found.append(np.stack(self.counted(pos[begin:stop], key[begin:stop], run[begin:stop], off), axis=1))
            begin = end
        if not found:
            return []
        out: list[list[int]] = []
        for row, item, band in np.unique(np.concatenate(found), axis=0).tolist():
            step = int(self.step[item])
            lo, hi = band * step, (band + 2) * step - 1
            if out and out[-1][:2] == [row, item] and lo <= out[-1][3] and hi - out[-1][2] < max(WIDE, 2 * step):
                out[-1][3] = hi
            else:
                out.append([row, item, lo, hi])
        return [tuple(x) for x in out]

    def align(self, text: bytes, item: int, lo: int, hi: int) -> tuple[int, int, int] | None:
        """Best placing of an item whose diagonals lie in ``lo .. hi``:
        ``(start, stop, edits)`` within its budget, or None."""
        t, budget = self.texts[item], int(self.budget[item])
        at = text.find(t, max(0, lo), hi + len(t) + 1)
        if at >= 0:
            return at, at + len(t), 0
        lo, hi = lo - budget, hi + budget
        width, far = hi - lo + 1, 1 << 30
        body = np.full(len(t) + width + 1, 0, np.uint8)  # text bytes from place lo on; 0 matches nothing
        a, z = max(0, lo), min(len(text), lo + len(body))
        if z > a:
            body[a - lo:z - lo] = np.frombuffer(text, np.uint8)[a:z]
        where = np.arange(width)
        cost = np.where((lo + where >= 0) & (lo + where <= len(text)), 0, far)
        start = lo + where
        for i, c in enumerate(t):
            text_at = lo + i + where  # place of the byte that a step along the diagonal takes
            diag = np.where(text_at < len(text), cost + (body[i:i + width] != c), far)
            diag = np.where(text_at >= 0, diag, far)
            skip = np.r_[cost[1:], far] + 1  # the item's byte is missing in the text
            best = np.minimum(diag, skip)
            from_ = np.where(diag <= skip, start, np.r_[start[1:], 0])
            # bytes that only the text has: a step to the next diagonal
            run = np.minimum.accumulate(best - where)
            src = np.maximum.accumulate(np.where(best - where == run, where, -1))
            cost, start = run + where, from_[src]
        k = int(np.argmin(cost))
        if cost[k] > budget:
            return None
        return int(start[k]), int(lo + len(t) + k), int(cost[k])

    def search(self, low: np.ndarray, off: np.ndarray):
        """``(row, item id, start, stop, edits)``, the best place per row and item."""
        best: dict[tuple[int, int], tuple] = {}
        for row, item, lo, hi in self.regions(low, off):
            old = best.get((row, item))
            if old and old[2] == 0:
                continue
            got = self.align(low[off[row]:off[row + 1]].tobytes(), item, lo, hi)
            if got and (old is None or got[2] < old[2]):
                best[row, item] = got
        out = [(row, self.ids[item], *v) for (row, item), v in best.items()]
        if self.short:
            for row in range(len(off) - 1):
                text = low[off[row]:off[row + 1]].tobytes()
                out += [(row, i, at, at + len(t), 0) for i, t in self.short if (at := text.find(t)) >= 0]
        return sorted(out)


def _search(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most PART_BYTES of text

    def run(batches):
        index = Items(shared.value)
        for b in batches:
            ids = b.column(0).to_pylist()
            out = []
            for i, _, raw, off in text_blocks(b):
                out += [(ids[i + row], *rest) for row, *rest in index.search(_FOLD[raw], off)]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["doc_id", "item_id", "start", "stop", "edits"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, item_id long, start long, stop long, edits long")


def _parts(benchmark: DataFrame, part_bytes: int):
    """The benchmark's items in parts of about ``part_bytes`` of text, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_bytes))
    for p in range(parts):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p)
        yield parts, [(r["item_id"], r["text"]) for r in some.collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id,
    item_id, start, stop`` (bytes of the text), ``edits``."""
    found = []
    for parts, items in _parts(benchmark, part_bytes):
        hits = _search(docs, items)
        found.append(hits if parts == 1 else written(hits, "contaminated"))
    return reduce(DataFrame.union, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` (all its columns) in which no item is found,
    without a shuffle."""
    def clean(shared):
        def run(batches):
            index = Items(shared.value)
            for b in batches:
                keep = np.ones(b.num_rows, dtype=bool)
                for i, _, raw, off in text_blocks(b):
                    keep[[i + hit[0] for hit in index.search(_FOLD[raw], off)]] = False
                yield b.filter(pa.array(keep))
        return run

    for _, items in _parts(benchmark, part_bytes):
        docs = docs.mapInArrow(clean(docs.sparkSession.sparkContext.broadcast(items)), docs.schema)
    return docs
