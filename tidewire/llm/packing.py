"""Sequence packing by non-negative least squares.

Documents become token streams; each stream is cut at every full window, so
that all that needs packing is one rest per document, shorter than the window.
The histogram of those lengths (at most ``window`` numbers, whatever the
corpus) is all that the driver needs: it enumerates shallow combinations of
lengths that fill a window exactly, solves for non-negative repeat counts whose
sum matches the histogram, rounds them, and packs what is left best-fit
decreasing, also by histogram.  The plan says, for every length, which ranks go
to which place of which sequence; Spark then places each piece by its rank.

Tokenising happens once: a piece's checksum is computed where its ids are, and
only lengths and checksums are written.  Ranks are counted in two steps, within
a task and over the tasks' counts, so no length, however frequent, meets in one
task.

Defined cases: a null or empty text still gives the end id; a null ``doc_id`` is
kept; repeated rows are packed one by one; pieces of equal length, which are all
alike to the plan, take its places in the order of their tasks and rows; an empty table gives an
empty result; columns besides the id and the text are not read, whatever their names.  A
very long document is a block of its own, held in memory whole by its task, no other
state grows with it; a word over ``LONGEST`` characters is encoded each time it occurs.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.core import FILES_PER_CORE, text_blocks, written

WINDOW = 2048
END_ID = 1
#: Bytes of text whose words are looked up together.
BLOCK = 4 << 20
#: Words that a Python worker remembers at least, each of at most ``LONGEST`` characters.
WORDS, LONGEST = 400_000, 64
#: Gradient, as a share of the largest count, at which the least squares are solved, and the
#: passes between two looks at all gradients.
SLOPE, LOOK = 1e-4, 20
#: Combinations that are Python numbers at a time; all are kept as arrays.
PORTION = 4096

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long")


# --- tokens ---------------------------------------------------------------

class WordTokens(dict):
    """Words to the little-endian 32-bit ids of a word-level BPE tokenizer.

    The tokenizer never joins what white space parts, so words are encoded one
    by one and remembered, in two generations: beyond ``WORDS`` words, those not
    met since the last change are forgotten.  Plain words of Latin letters, with at
    most a full stop or comma behind, skip the normaliser and go to the BPE model at
    once; everything else is encoded in full.
    """

    plain = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.bytes_of = {i: "".join(_byte_chars()[b] for b in chr(i).encode()) for i in range(128, 256)}
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            if m := self.plain.fullmatch(word):
                stem, mark = m.groups()
                low = stem.lower()
                if low == word:
                    out = _packed([t.id for t in self.model.tokenize(low.translate(self.bytes_of))])
                else:
                    out = self[low] + self[mark] if mark else self[low]
            else:
                out = _packed(self.whole.encode(word, add_special_tokens=False).ids)
        if len(word) <= LONGEST:
            self[word] = out
        return out

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)`` of the texts of a block, each with the end id behind: the
        different words of the block are looked up once, all else is done on arrays."""
        cut = np.zeros(len(raw) + 1, dtype=bool)
        cut[off] = True
        cut[1:] |= (raw == 32) | (raw == 10)
        start = np.flatnonzero(cut).astype(np.int32)  # a word goes on until the next one starts
        words = pa.StringArray.from_buffers(len(start) - 1, pa.py_buffer(start), pa.py_buffer(raw)).dictionary_encode()
        known = [self[w] for w in pc.utf8_rtrim(words.dictionary, " \n").to_pylist()]
        known.append(_packed([END_ID]))
        if len(self) > WORDS:
            self.old = dict(self)
            self.clear()
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = np.frombuffer(b"".join(known), "<u4")
        before = np.searchsorted(start[:-1], off[1:])  # words up to the end of each text
        word = np.insert(words.indices.to_numpy(), before, len(known) - 1)
        first, size = (np.cumsum(size) - size)[word], size[word]
        stop = np.cumsum(size)
        at = np.repeat(first - (stop - size), size) + np.arange(stop[-1])
        return ids[at], np.r_[0, stop[before + np.arange(len(before))]]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in kept}
    out.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in out)})
    return out


_tokenizers: dict[str, WordTokens] = {}


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text)`` as pieces of at most ``window`` ids, with the
    task that made each piece and its rank among that task's pieces of its
    length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _tokenizers:
            _tokenizers[tokenizer_path] = WordTokens(tokenizer_path)
        tok = _tokenizers[tokenizer_path]
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        for b in batches:
            for i, j, raw, off in text_blocks(b, limit=BLOCK):
                ids, bound = tok.encode(raw, off)
                tokens = np.diff(bound)
                pieces = -(-tokens // window)
                row = np.repeat(np.arange(j - i), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, tokens[row] - start)
                view, at = memoryview(ids).cast("B"), 4 * (bound[row] + start)
                crc = [zlib.crc32(view[x:y]) for x, y in zip(at.tolist(), (at + 4 * length).tolist())]
                # rank among the task's pieces of the same length
                order = np.argsort(length, kind="stable")
                sorted_ = length[order]
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - np.searchsorted(sorted_, sorted_) + seen[sorted_]
                seen += np.bincount(length, minlength=window + 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(i + row)), pa.array(start), pa.array(length),
                     pa.array(crc, pa.int64()), pa.array(tokens[row]),
                     pa.array(np.full(len(row), part, np.int32)), pa.array(nth)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


# --- plan -----------------------------------------------------------------

def combination_table(lengths: list[int], window: int) -> np.ndarray:
    """All combinations of one to three of ``lengths`` that add up to ``window``, a row
    each, longest length first and 0 behind the last one."""
    have = np.zeros(window + 1, dtype=bool)
    have[[v for v in lengths if v <= window]] = True
    out = [np.array([[window, 0, 0]])] if have[window] else []
    for a in np.flatnonzero(have[:window])[::-1].tolist():
        rest = window - a
        b = np.arange(min(a, rest), (rest - 1) // 2, -1)
        b = b[have[b] & ((b == rest) | have[rest - b])]
        out.append(np.stack([np.full(len(b), a), b, rest - b], axis=1))
    return np.concatenate([np.zeros((0, 3), np.int64), *out]).astype(np.int32)


def fill_combinations(lengths: list[int], window: int) -> list[tuple[int, ...]]:
    """The same as tuples without the zeros."""
    return [tuple(v for v in c if v) for c in combination_table(lengths, window).tolist()]


def repeat_counts(combos, hist: list[int], passes: int | None = None) -> np.ndarray:
    """Non-negative least squares, ``min |A x - hist|``, by coordinate descent
    from zero: one column of A per combination, its entries the number of times
    each length occurs.  Starting from zero the long pieces, which fit few
    combinations, are served first.  ``combos``: tuples, or a ``combination_table``.

    It ends when every gradient, of a positive count to both sides and of a zero count
    upwards, is at most half a piece or ``SLOPE`` of the largest count.  Between two looks at all
    gradients only combinations that are used or still want to rise are worked on.
    ``passes`` ends it earlier."""
    if not isinstance(combos, np.ndarray):
        combos = np.array([(*c, 0, 0)[:3] for c in combos], dtype=np.int32).reshape(-1, 3)
    rest, x = [0.0, *map(float, hist[1:])], np.zeros(len(combos))  # length 0 only fills up
    twice = sum((combos[:, i] == combos[:, j]) & (combos[:, i] > 0) for i, j in ((0, 1), (0, 2), (1, 2)))
    norm = (combos > 0).sum(axis=1) + 2 * twice
    bound = max(0.5, SLOPE * max(hist, default=0))
    todo, done = np.arange(len(combos)), 0
    while len(todo) and done != passes:
        for _ in range(1 if not done else min(LOOK, (passes or done + LOOK) - done)):
            for at in range(0, len(todo), PORTION):
                some = todo[at:at + PORTION]
                counts = x[some].tolist()
                for i, ((a, b, c), n) in enumerate(zip(combos[some].tolist(), norm[some].tolist())):
                    dot = rest[a] + rest[b] + rest[c]
                    if dot > 0 or counts[i]:
                        step = max(dot / n, -counts[i])
                        counts[i] += step
                        rest[a] -= step
                        rest[b] -= step
                        rest[c] -= step
                        rest[0] = 0.0
                x[some] = counts
            done += 1
        slope, used = np.array(rest)[combos].sum(axis=1), x > 0
        if (np.where(used, np.abs(slope), slope) <= bound).all():
            break
        todo = np.flatnonzero(used | (slope > bound / 2))
    return x


def best_fit(hist: list[int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: groups ``(lengths, how often)``."""
    open_at: dict[int, list[list]] = {}
    sizes: list[int] = []

    def put(left: int, held: tuple, n: int) -> None:
        if left not in open_at:
            open_at[left] = []
            insort(sizes, left)
        open_at[left].append([held, n])

    for v in range(len(hist) - 1, 0, -1):
        n = hist[v]
        while n:
            at = bisect_left(sizes, v)
            if at == len(sizes):
                k = min(n, window // v)
                put(window - k * v, (v,) * k, n // k)
                n -= (n // k) * k
                continue
            left = sizes[at]
            held, have = open_at[left][-1]
            use = min(have, n)
            if use == have:
                open_at[left].pop()
                if not open_at[left]:
                    del open_at[left]
                    sizes.pop(at)
            else:
                open_at[left][-1][1] -= use
            put(left - v, (*held, v), use)
            n -= use
    return [(held, n) for groups in open_at.values() for held, n in groups]


def pack_plan(hist: list[int], window: int = WINDOW) -> dict[str, np.ndarray]:
    """Where the pieces of each length go: ranks ``[rank, rank + n)`` of
    ``length`` stand at ``offset`` of the sequences ``sequence ...``."""
    left = list(hist)
    lengths = [v for v in range(1, window + 1) if left[v]]
    combos = combination_table(lengths, window)
    groups: list[tuple[tuple[int, ...], int]] = []
    counts = repeat_counts(combos, left)
    for i in np.argsort(-counts, kind="stable").tolist():
        n = int(counts[i] + 0.5)
        if n < 1:
            break
        c = tuple(v for v in combos[i].tolist() if v)
        n = min(n, *(left[v] // c.count(v) for v in c))
        if n > 0:
            groups.append((c, n))
            for v in c:
                left[v] -= n
    groups += best_fit(left, window)
    taken, rows, sequence = [0] * (window + 1), [], 0
    for held, n in groups:
        offset = 0
        for v in held:
            rows.append((v, taken[v], sequence, offset))
            taken[v] += n
            offset += v
        sequence += n
    rows.sort()
    cols = list(zip(*rows)) or [(), (), (), ()]
    return {k: np.array(c, dtype=np.int64) for k, c in zip(("length", "rank", "sequence", "offset"), cols)}


# --- operator ---------------------------------------------------------------

def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text)`` packed: one row per piece."""
    pieces = written(token_pieces(docs, tokenizer_path, window), "pieces")
    counts = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts", FILES_PER_CORE)
    hist = [0] * (window + 1)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `window` rows
        hist[r["length"]] = r["n"]
    plan = pack_plan(hist, window)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("nth")).alias("rank"))

    shared = docs.sparkSession.sparkContext.broadcast(plan)  # grows with the window alone

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        key = (plan["length"] << 44) | plan["rank"]
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 5))
            at = np.searchsorted(key, (length << 44) | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(plan["sequence"][at] + rank - plan["rank"][at]),
                 pa.array(plan["offset"][at])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked.mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
               "sequence_id long, offset long")
