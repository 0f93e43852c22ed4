"""Cross-tokenizer alignment by galloping intersection.

A text is encoded by two tokenizers; both cut the same bytes, so each gives a rising list
of byte offsets where its tokens end.  The shorter of a text's two lists drives: for
each of its ends the longer list is searched from a guess, in steps that double until the
end is bracketed, then by halving.  That gives the end's rank in the longer list and
whether it stands there.  Common ends cut both lists into groups; the ranks of a token's
two ends differ by the tokens of the other list that overlap it, so overlap pairs are
ranges, too.  The searches of a block of texts run side by side in numpy.

One pass over the texts encodes, aligns and writes, per text, its different id pairs with
their number, and, per task, the counts of id pairs (merged in the task as long as they fit
``HELD``).  Corpus-wide counts are one aggregation by pair, the highest count of a B id one
by id.  A second pass looks the texts' pairs up: the most frequent pairs, as many as
``HOT`` entries hold, are broadcast (16 bytes each: a fixed bound); all others are joined by
pair.  Pairs are never expanded per occurrence in a shuffle.

Defined cases: a null or empty text, or one whose joined token bytes differ from a space and
the text for either tokenizer, has no tokens, zero counts and an empty digest; its links count
nowhere.  A blank text is a text like others.  Special tokens' strings are plain text.  Repeated rows
are texts of their own, a null ``doc_id`` is kept.  Of pairs that tie for the highest
count of a B id all are best.  A very long text is encoded whole, as a block of its own.  An
empty table gives an empty result; columns besides the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import FILES_PER_CORE, text_blocks, written

#: Bytes of text encoded together.
BLOCK = 1 << 20
#: Words whose ids a Python worker remembers at least; those not met for as many new ones are forgotten.
WORDS = 300_000
#: Different pairs whose counts a task merges before it hands them on.
HELD = 1 << 19
#: Entries of the table of frequent pairs that every task gets.
HOT = 1 << 19
_SHIFT = 20  # a pair is the A id above 20 bits of the B id


# --- tokenizers -----------------------------------------------------------

class ByteTokens:
    """A byte-level BPE tokenizer (A): ids, and the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of = {chr(b): b for b in kept}
        of.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)})
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class PieceTokens:
    """A sentence-piece BPE tokenizer with byte fallback (B)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.tok = SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(self.tok.id_to_piece(i)[3:5], 16)]) if self.tok.is_byte(i)
                      else self.tok.id_to_piece(i).replace("▁", " ").encode()
                      for i in range(self.tok.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tok.encode(texts, num_threads=1)


#: A space at either end, or behind something that may be white space itself.
odd_space = re.compile("^ | $|[^!-~\u00a1-\u024f\u0391-\u03ce\u0410-\u044f\u2010-\u2026] ")

_loaded: dict = {}


def _tokenizer(kind, *paths: str):
    """One of a kind for each Python worker."""
    if (kind, *paths) not in _loaded:
        _loaded[kind, *paths] = kind(*paths)
    return _loaded[kind, *paths]


# --- alignment ------------------------------------------------------------

def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every value of ``short`` its rank in ``long`` (how many values are smaller)
    and whether it stands there; both rise.  From ``guess`` steps of 1, 2, 4, ...
    bracket the value on its side, halving finds it."""
    n = len(long)
    at = np.clip(guess, 0, n - 1)
    below = long[at] < short  # the rank lies above the guess
    lo = np.where(below, at + 1, 0)  # rank in [lo, hi]
    hi = np.where(below, n, at)
    live, step = np.arange(len(short)), 1
    while len(live):
        up = below[live]
        probe = np.where(up, at[live] + step, at[live] - step)
        inside = (probe >= 0) & (probe < n)
        live, probe, up = live[inside], probe[inside], up[inside]
        less = long[probe] < short[live]
        lo[live[less]] = probe[less] + 1
        hi[live[~less]] = probe[~less]
        live = live[less == up]
        step *= 2
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        less = long[mid] < short[live]
        lo[live[less]] = mid[less] + 1
        hi[live[~less]] = mid[~less]
        live = live[lo[live] < hi[live]]
    return lo, (lo < n) & (long[np.minimum(lo, n - 1)] == short)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` (``size[i]`` numbers) for all i in a row."""
    total = int(size.sum())
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(total)


def align(a_ends: np.ndarray, a_first: np.ndarray, b_ends: np.ndarray,
          b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, a_cut, b_cut)`` of texts side by side: the token numbers of all overlapping
    pairs, and which A and B tokens end a group.  ``*_ends`` rise through all texts (each
    text stands behind the one before), text ``t`` has the tokens ``first[t] .. first[t + 1]``; both
    tokenizers end each text at the same place."""
    n_a, n_b = np.diff(a_first), np.diff(b_first)
    a_text, b_text = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
    a_drives = n_a <= n_b
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    links = []
    for swap in (False, True):
        ends, first, n, text, cut = (b_ends, b_first, n_b, b_text, b_cut) if swap else (a_ends, a_first, n_a, a_text, a_cut)
        far, far_first, far_n, far_cut = (a_ends, a_first, n_a, a_cut) if swap else (b_ends, b_first, n_b, b_cut)
        mine = np.flatnonzero((~a_drives if swap else a_drives)[text])
        if not len(mine):
            continue
        t = text[mine]
        guess = far_first[t] + (mine - first[t]) * far_n[t] // n[t]
        rank, same = gallop(ends[mine], far, guess)
        cut[mine[same]] = True
        far_cut[rank[same]] = True
        # a token starts where the one before it ends; a text's first token where the text starts
        begin = np.empty(len(mine), np.int64)
        begin[1:] = rank[:-1] + same[:-1]
        opens = mine == first[t]
        begin[opens] = far_first[t[opens]]
        size = rank + 1 - begin
        pair = np.repeat(mine, size), _ranges(begin, size)
        links.append(pair[::-1] if swap else pair)
    if not links:
        none = np.zeros(0, np.int64)
        return none, none, a_cut, b_cut
    return np.concatenate([x[0] for x in links]), np.concatenate([x[1] for x in links]), a_cut, b_cut


def _digests(a_ids, a_first, a_cut, b_ids, b_first, b_cut, names) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each text."""
    a_names, b_names = names
    # group number of each token, then all tokens in the order group, A before B
    a_group = np.cumsum(a_cut) - a_cut
    b_group = np.cumsum(b_cut) - b_cut
    key = np.concatenate([2 * a_group, 2 * b_group + 1])
    order = np.argsort(key, kind="stable")
    spelled = a_names.take(2 * a_ids + a_cut), b_names.take(2 * b_ids + b_cut)
    words = np.concatenate(spelled)[order].tolist()
    out, at = [], 0
    for i in range(len(a_first) - 1):
        n = int(a_first[i + 1] - a_first[i] + b_first[i + 1] - b_first[i])
        out.append(hashlib.sha256("".join(words[at:at + n])[:-1].encode()).hexdigest() if n else "")
        at += n
    return out


class Aligner:
    """Texts to their alignment, block by block."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _tokenizer(ByteTokens, path_a), _tokenizer(PieceTokens, path_b)
        self.sizes = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        #: No piece goes on behind a space, so words can be encoded one by one.
        self.by_words = not any(b" " in x.lstrip(b" ") for x in self.b.bytes)
        self.young: dict = {}
        self.old: dict = {}
        # what an id is spelled as inside a group and at its end
        self.names = [np.array([f"{i}{end}" for i in range(len(t.bytes)) for end in (",", last)], dtype=object)
                      for t, last in ((self.a, "|"), (self.b, ";"))]

    def _both(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids (four bytes each) of both tokenizers; None where the tokens are not a space and the text."""
        a, b = (t.encode(texts) for t in (self.a, self.b))
        out = []
        for x, i, j in zip(texts, a, b):
            want = b" " + x.encode()
            same = all(b"".join([t.bytes[k] for k in ids]) == want for t, ids in ((self.a, i), (self.b, j)))
            out.append((np.array(i, "<i4").tobytes(), np.array(j, "<i4").tobytes()) if same else None)
        return out

    def _words(self, words: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The same for words, most of which have been seen before."""
        out = [self.young.get(w, 0) for w in words]
        for k in [k for k, x in enumerate(out) if x == 0]:
            out[k] = self.old.get(words[k], 0)
            if out[k] != 0:
                self.young[words[k]] = out[k]
        new = [k for k, x in enumerate(out) if x == 0]
        for k, x in zip(new, self._both([words[k] for k in new])):
            out[k] = x
            if len(words[k]) <= 64:
                self.young[words[k]] = x
        if len(self.young) > WORDS:
            self.young, self.old = {}, self.young
        return out

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and bounds per text of both tokenizers; none for texts that do not come back whole.

        Neither tokenizer joins a letter or mark with a space behind it, so texts whose spaces all
        follow one (and do not end them) are encoded by their different words, the others whole."""
        plain = [t.decode() for t in texts]
        n = len(plain)
        parted = np.array([bool(t) and self.by_words and not odd_space.search(t) for t in plain], bool)
        at = np.flatnonzero(parted)
        lists = pc.split_pattern(pa.array([plain[k] for k in at], pa.string()), " ")
        coded = lists.flatten().dictionary_encode()
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(at, np.diff(lists.offsets.to_numpy()))
        known = self._words(coded.dictionary.to_pylist())
        bad = np.array([x is None for x in known], bool)
        if bad.any():
            parted[of[bad[word]]] = False
        rest = [k for k in range(n) if plain[k] and not parted[k]]
        whole = dict(zip(rest, self._both([plain[k] for k in rest])))
        out = []
        for side in (0, 1):
            parts = [x[side] if x else b"" for x in known]
            flat = np.frombuffer(b"".join(parts), "<i4").astype(np.int64)
            size = np.array([len(x) // 4 for x in parts], np.int64)
            first = np.cumsum(size) - size
            use = parted[of]
            ids = flat[_ranges(first[word[use]], size[word[use]])]
            count = np.bincount(of[use], weights=size[word[use]], minlength=n).astype(np.int64)
            if rest:  # put the texts encoded whole between the others
                own = {k: np.frombuffer(x[side], "<i4").astype(np.int64) for k, x in whole.items() if x}
                edge = np.r_[0, np.cumsum(count)]
                ids = np.concatenate([own[k] if k in own else ids[edge[k]:edge[k + 1]] for k in range(n)])
                for k, x in own.items():
                    count[k] = len(x)
            out.append((ids, np.r_[0, np.cumsum(count)]))
        return out

    def __call__(self, texts: list[bytes]) -> tuple[dict, np.ndarray, np.ndarray]:
        """``(columns per text, text of each link, pair of each link)``."""
        (a, a_first), (b, b_first) = self.encode(texts)
        a_ends, b_ends = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        i, j, a_cut, b_cut = align(a_ends, a_first, b_ends, b_first)
        text = np.searchsorted(a_first, i, side="right") - 1
        n = len(texts)
        groups = np.add.reduceat(np.r_[a_cut, False], np.minimum(a_first[:-1], len(a))) if n else np.zeros(0, np.int64)
        groups = np.where(np.diff(a_first) > 0, groups, 0)
        cols = {"n_a": np.diff(a_first), "n_b": np.diff(b_first), "n_groups": groups.astype(np.int64),
                "n_links": np.bincount(text, minlength=n).astype(np.int64),
                "groups_sha256": _digests(a, a_first, a_cut, b, b_first, b_cut, self.names)}
        return cols, text, (a[i] << _SHIFT) | b[j]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, rising, with their counts added up."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])[:len(key)]
    return key[at], np.add.reduceat(n, at) if len(at) else n


ROWS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs binary, times binary, pair long, n long")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One pass over the texts, two kinds of rows: of each text its columns and its different
    pairs (rising, eight bytes each) with their numbers (four bytes each); and
    ``(pair, n)``, the links that a task has seen of a pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _tokenizer(Aligner, path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in ROWS.split(", ")]
        held: tuple[list, list] = ([], [])
        many = 0

        def counted():
            key, n = _merged(*held)
            empty = [pa.nulls(len(key), t) for t in [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]]
            return key, n, pa.RecordBatch.from_arrays([*empty, pa.array(key), pa.array(n)], names=names)

        for b in batches:
            for i, j, raw, off in text_blocks(b, limit=BLOCK):
                data = raw.tobytes()
                cols, text, pair = aligner([data[s:e] for s, e in zip(off[:-1], off[1:])])
                n = j - i
                # the different pairs of each text
                order = np.lexsort((pair, text))
                text, pair = text[order], pair[order]
                new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])][:len(pair)])
                times = np.diff(np.r_[new, len(pair)])
                text, pair = text[new], pair[new]
                edge = np.searchsorted(text, np.arange(n + 1))
                packed, packed_n = pair.astype("<i8").tobytes(), times.astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), b.column(0).slice(i, n),
                     *[pa.array(cols[c], pa.string() if c == "groups_sha256" else pa.int64()) for c in names[2:7]],
                     pa.array([packed[8 * s:8 * e] for s, e in zip(edge[:-1], edge[1:])], pa.binary()),
                     pa.array([packed_n[4 * s:4 * e] for s, e in zip(edge[:-1], edge[1:])], pa.binary()),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
                row += n
                key, num = _merged([pair], [times])
                held[0].append(key)
                held[1].append(num)
                many += len(key)
                if many > 2 * HELD:
                    key, num, full = counted()
                    if len(key) > HELD:
                        yield full
                        key, num = key[:0], num[:0]
                    held, many = ([key], [num]), len(key)
        yield counted()[2]

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many links hold a pair, and whether that is the
    highest number of its B id."""
    counts = rows.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("b", F.col("pair").bitwiseAND((1 << _SHIFT) - 1)), "pair-counts", FILES_PER_CORE)
    top = counts.groupBy("b").agg(F.max("n").alias("top"))  # one row per id of a vocabulary
    return counts.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def frequent(counts: DataFrame, most: int = HOT) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(pair, n, best, least)`` of all pairs that occur ``least`` times or more, at most
    ``most`` of them; ``least`` is a power of two."""
    by_size = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("size")).agg(F.count(F.lit(1)).alias("c"))
    room, least = most, 0
    sizes = sorted(by_size.collect(), key=lambda r: -r["size"])  # 64 rows at most
    for r in sizes:
        room -= r["c"]
        if room < 0:
            break
        least = 1 << r["size"]
    if not least:  # not even the most frequent size fits
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool), 1 << 62
    got = counts.where(F.col("n") >= least).toArrow()  # at most `most` rows
    order = np.argsort(got["pair"].to_numpy())
    return (got["pair"].to_numpy()[order], got["n"].to_numpy()[order],
            got["best"].to_numpy(zero_copy_only=False).astype(bool)[order], least)


def cross_alignment(docs: DataFrame, path_a: str, path_b: str, hot: int = HOT) -> DataFrame:
    """``docs(doc_id, text)`` as ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``, one row per row."""
    rows = written(aligned(docs, path_a, path_b), "aligned")
    counts = written(pair_counts(rows), "best-pairs", FILES_PER_CORE)
    key, num, top, least = frequent(counts, hot)
    state = docs.sparkSession.sparkContext.broadcast((key, num, top))  # at most `hot` entries

    def look_up(batches):
        key, num, top = state.value
        names = ["row", "n_best", "count_sum", "pair", "n"]
        for b in batches:
            size = np.array([len(x) // 8 for x in b.column(1).to_pylist()], np.int64)
            pair = np.frombuffer(b"".join(b.column(1).to_pylist()), "<i8")
            times = np.frombuffer(b"".join(b.column(2).to_pylist()), "<i4").astype(np.int64)
            text = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(key, pair), max(0, len(key) - 1))
            found = key[at] == pair if len(key) else np.zeros(len(pair), bool)
            n = len(size)
            best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(best, text[found], (top[at[found]] * times[found]) if len(key) else 0)
            np.add.at(total, text[found], num[at[found]] * times[found] if len(key) else 0)
            row = b.column(0).to_numpy(zero_copy_only=False)
            rest = ~found
            none = pa.nulls(int(rest.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(best), pa.array(total), pa.nulls(n, pa.int64()),
                                              pa.nulls(n, pa.int64())], names=names)
            if rest.any():
                yield pa.RecordBatch.from_arrays([pa.array(row[text[rest]]), none, none, pa.array(pair[rest]),
                                                  pa.array(times[rest])], names=names)

    texts = rows.where("row is not null")
    got = written(texts.select("row", "pairs", "times").mapInArrow(
        look_up, "row long, n_best long, count_sum long, pair long, n long"), "links")
    rare = counts.where(F.col("n") < least).select("pair", F.col("n").alias("count"), "best")
    cold = got.where("pair is not null").select("row", "pair", "n").join(rare, "pair").select(
        "row", F.when(F.col("best"), F.col("n")).otherwise(F.lit(0)).alias("n_best"),
        (F.col("n") * F.col("count")).alias("count_sum"))
    sums = got.where("pair is null").select("row", "n_best", "count_sum").union(cold).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return texts.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
