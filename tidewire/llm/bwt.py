"""Burrows-Wheeler transform and common prefixes of a collection of strings,
built column by column: each round puts one more symbol of every string, from
the right, in front of the suffixes inserted so far.

The transform and the common-prefix lengths lie in two files that a round reads
front to back and writes anew, in chunks; memory holds one chunk and a few numbers
per string.
"""

from __future__ import annotations

import contextlib
import tempfile

import numpy as np

#: Marks that a whole string is inserted; no UTF-8 text holds this byte.
END = 0xFF
CHUNK = 1 << 22


def collection_bwt(strings: list[bytes], least: int, chunk: int = CHUNK):
    """``(string, length, lcp)`` of all suffixes of ``least`` symbols or more,
    in sorted order; ``lcp`` is the common prefix with the suffix before, 0 where
    a shorter suffix stands between."""
    m = len(strings)
    if not m:
        z = np.zeros(0, np.int64)
        return z, z, z
    size = np.array([len(s) for s in strings], dtype=np.int64)
    longest = int(size.max())
    # column j: the symbol before the suffix of length j
    text = np.full((longest + 1, m), END, np.uint8)
    for i, s in enumerate(strings):
        text[:len(s), i] = np.frombuffer(s, np.uint8)[::-1]
    with contextlib.ExitStack() as stack:
        old, new = (tuple(stack.enter_context(tempfile.TemporaryFile(buffering=0)) for _ in range(2))
                    for _ in range(2))
        text[0].tofile(old[0])  # the empty suffixes, in the strings' order
        np.zeros(m, np.uint8).tofile(old[1])
        totals = np.bincount(text[0], minlength=256)
        totals[END] = 0
        place, rows = np.arange(m), m
        whole = np.arange(m)  # strings whose last inserted suffix can still grow
        tag_row = np.zeros(0, np.int64)
        tag_string, tag_length = tag_row, tag_row
        for j in range(1, longest + 1):
            keep = size[whole] >= j
            whole, place = whole[keep], place[keep]
            order = np.argsort(place, kind="stable")
            whole, place = whole[order], place[order]
            c, occ, prev, after = _extend(old, place, chunk, rows)
            # the first suffix of each symbol stands behind the empty ones and all smaller symbols
            start = m + np.r_[0, np.cumsum(totals)[:-1]]
            target = start[c] + occ
            by = np.argsort(target, kind="stable")
            target, c_, whole = target[by], c[by], whole[by]
            nxt = np.where(after[by] < 0, -1, after[by])
            _merge(old, new, target, text[j][whole], prev[by], nxt, chunk, rows)
            rows += len(target)
            totals += np.bincount(text[j][whole], minlength=256)
            totals[END] = 0
            # rows of long suffixes move down by what was inserted before them
            if len(tag_row):
                tag_row = tag_row + _shift(tag_row, target)
            place = target
            if j >= least:
                tag_row = np.r_[tag_row, target]
                tag_string = np.r_[tag_string, whole]
                tag_length = np.r_[tag_length, np.full(len(whole), j)]
            old, new = new, old
        old[1].seek(0)
        lcp = np.fromfile(old[1], np.uint8, rows)
    order = np.argsort(tag_row)
    row = tag_row[order]
    near = np.r_[False, row[1:] == row[:-1] + 1] if len(row) else np.zeros(0, bool)
    return tag_string[order], tag_length[order], np.where(near, lcp[row], 0).astype(np.int64)


def _chunks(files: tuple, chunk: int, rows: int):
    """``(first row, symbols, common prefixes)`` of the two files, front to back."""
    for f in files:
        f.seek(0)
    for at in range(0, rows, chunk):
        n = min(chunk, rows - at)
        yield at, np.fromfile(files[0], np.uint8, n), np.fromfile(files[1], np.uint8, n)


def _shift(row: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How many of the new rows (final places, ascending) come before an old row."""
    return np.searchsorted(target - np.arange(len(target)), row, side="right")


def _extend(files: tuple, place: np.ndarray, chunk: int, rows: int):
    """For the rows ``place`` (ascending): their symbol, its number of
    occurrences before, and the common prefix that the grown suffix has with the
    neighbours of the same symbol before and after (-1: there is none)."""
    n = len(place)
    c, occ = np.zeros(n, np.int64), np.zeros(n, np.int64)
    prev, after = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    seen = np.zeros(256, np.int64)
    low = np.full(256, -1, np.int64)  # per symbol: least lcp since its last row; -1: not seen yet
    owner = np.full(256, -1, np.int64)  # the asking row that still waits for its follower
    k = 0
    for at, b, lcp in _chunks(files, chunk, rows):
        z = np.searchsorted(place, at + len(b))
        ask = place[k:z] - at
        order = np.argsort(b, kind="stable")
        count = np.bincount(b, minlength=256)
        first = np.r_[0, np.cumsum(count)[:-1]]
        own = b[ask].astype(np.int64)
        c[k:z] = own
        rank = np.empty(len(b), np.int32)
        rank[order] = np.arange(len(b), dtype=np.int32)
        at_rank = rank[ask].astype(np.int64)
        r = at_rank - first[own]
        occ[k:z] = seen[own] + r
        # rows between the neighbour of the same symbol before (in this chunk) and the row
        inner = r > 0
        if inner.any():
            a = order[at_rank[inner] - 1]
            prev[k:z][inner] = 1 + _range_min(lcp, a + 1, ask[inner] + 1)
        for i in np.flatnonzero(~inner):
            s = own[i]
            if low[s] >= 0:
                prev[k + i] = 1 + min(low[s], int(lcp[:ask[i] + 1].min()))
        follows = r + 1 < count[own]
        if follows.any():
            d = order[at_rank[follows] + 1]
            after[k:z][follows] = 1 + _range_min(lcp, ask[follows] + 1, d + 1)
        if len(b) == rows:  # one chunk holds all: nothing waits
            return c, occ, prev, after
        # rows asked in earlier chunks that find their follower here
        for s in np.flatnonzero((owner >= 0) & (count > 0)):
            after[owner[s]] = 1 + min(int(low[s]), int(lcp[:order[first[s]] + 1].min()))
            owner[s] = -1
        everywhere = int(lcp.min())
        low = np.where(low >= 0, np.minimum(low, everywhere), low)
        for s in np.flatnonzero(count):
            last = order[first[s] + count[s] - 1]
            low[s] = int(lcp[last + 1:].min()) if last + 1 < len(b) else 255
        for i in np.flatnonzero(~follows):
            owner[own[i]] = k + i
        seen += count
        k = z
    return c, occ, prev, after


def _range_min(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minimum of each ``values[start:stop]`` (none is empty)."""
    pairs = np.empty(2 * len(start), np.int64)
    pairs[::2], pairs[1::2] = start, stop
    padded = np.r_[values, np.uint8(255)]
    return np.minimum.reduceat(padded, pairs)[::2].astype(np.int64)


def _merge(old: tuple, new: tuple, target: np.ndarray, symbol: np.ndarray, prev: np.ndarray, after: np.ndarray,
           chunk: int, rows: int) -> None:
    """Write the files anew with the new rows at ``target`` (final places,
    ascending); an old row behind a new one gets its new common prefix."""
    before = target - np.arange(len(target))  # old rows in front of each new one
    cap = lambda v: np.minimum(v, 254).astype(np.uint8)
    k = 0
    for f in new:
        f.seek(0)
    for at, b, lcp in _chunks(old, chunk, rows):
        last = at + len(b) >= rows
        z = len(target) if last else int(np.searchsorted(before, at + len(b), side="left"))
        put = before[k:z] - at
        # the follower of the last new row at a place is an old row of the same symbol, if it has one
        tail = np.flatnonzero(np.r_[put[1:] != put[:-1], True]) if z > k else np.zeros(0, np.int64)
        tail = tail[(after[k:z][tail] >= 0) & (put[tail] < len(b))]
        lcp[put[tail]] = cap(after[k:z][tail])
        mine = put + np.arange(len(put))
        there = np.ones(len(b) + len(put), bool)
        there[mine] = False
        for f, was, is_ in ((new[0], b, symbol[k:z]), (new[1], lcp, cap(prev[k:z]))):
            both = np.empty(len(there), np.uint8)
            both[there], both[mine] = was, is_
            both.tofile(f)
        k = z
