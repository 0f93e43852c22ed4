"""Exact removal of long repeated byte strings, across and within documents.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier.  The strings to compare are found in three steps:

1. Every window of ``LENGTH`` bytes is filed under the smallest hash of its
   ``GRAM``-byte substrings, which only depends on its bytes, so equal windows
   meet.  Neighbouring windows under one hash form a run, and runs with the same
   bytes collapse to the earliest, first within a task, then per bucket; all
   later ones go as a whole.  Hashes that hold more than a bucket's share of all
   runs (counted over the whole corpus; there cannot be more of them than buckets) are
   filed by their single windows instead, which spreads them.
2. Hashes left with different runs are compared by a collection suffix index:
   the runs' bytes, cut again by the smallest hash of ``CORE``-byte substrings and
   collapsed, go column by column into a Burrows-Wheeler transform with common
   prefixes; neighbouring suffixes with a prefix of ``LENGTH`` or more are repeats.
3. Repeats are joined to the documents, whose bytes are cut in one pass.

The text itself is shuffled only by document, never by group.  Defined cases: a
null text is empty; a null ``doc_id`` is earlier than all others; rows with the
same ``doc_id`` count as one document for the order, so identical rows get the same
result and a byte removed at a place of one is removed at that place of all; an
empty table gives an empty result.  Runs are collapsed by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.bwt import collection_bwt
from tidewire.llm.core import FILES_PER_CORE, mix, text_blocks, written

LENGTH, GRAM, CORE = 100, 32, 80
#: Text bytes that are looked at together (a longer document is a block of its own):
#: their hashes and minima take a dozen arrays of eight bytes a place.
BLOCK = 1 << 18
#: Windows in a run at most (one without equal hashes has 69 at most); runs that a task gathers before it collapses them.
RUN = 96
GATHER = 2_000_000
#: Runs of one hash in a gathering from which on it may be a frequent one.
FREQUENT = 16
NULL_ID = -(1 << 63)

_U = np.uint64
_M = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the GRAM (32) bytes from each place on."""
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    two = raw[:-1].astype(np.uint64) | (raw[1:].astype(np.uint64) << _U(8))
    four = two[:-2] | (two[2:] << _U(16))
    eight = four[:-4] | (four[4:] << _U(32))
    x = eight[:n] * _M[0]
    for j in (1, 2, 3):
        x ^= x >> _U(32)
        x += eight[8 * j:8 * j + n]
        x *= _M[j]
    return mix(x)


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values."""
    have, m = 1, h
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:len(h) - width + 1], m[width - have:width - have + len(h) - width + 1]) if have < width else m


def runs_of(key: np.ndarray, off: np.ndarray, length: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first window, number of windows, row)`` of the runs of windows of
    ``length`` bytes with the same key that lie within a row, cut at ``limit``."""
    valid = np.zeros(len(key) + 1, np.int8)
    long_enough = np.diff(off) >= length
    np.add.at(valid, off[:-1][long_enough], 1)
    np.add.at(valid, off[1:][long_enough] - length + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    edge = np.ones(len(key), bool)
    edge[1:] = (key[1:] != key[:-1]) | ~valid[:-1]
    edge[off[:-1][long_enough]] = True
    first = np.flatnonzero(valid & edge)
    last = np.flatnonzero(valid & np.r_[edge[1:] | ~valid[1:], True])
    n = last - first + 1
    cuts = -(-n // limit)
    which = np.repeat(np.arange(len(n)), cuts)
    part = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    start = first[which] + part * limit
    return start, np.minimum(limit, last[which] - start + 1), np.searchsorted(off, start, side="right") - 1


def repeats_inside(h: np.ndarray, m: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a run may hold two equal windows; ``m``: the window minima of
    ``h``.  The first of them has its leftmost minimum before the second one
    begins, so there is a window of the run that begins with its minimum and
    whose follower in the run has an equal one."""
    at = np.flatnonzero((h[:len(m) - 1] == m[:-1]) & (m[1:] == m[:-1]))
    return np.searchsorted(at, start + n - 1) > np.searchsorted(at, start)


def block_runs(raw: np.ndarray, off: np.ndarray):
    """``(gram hashes, key, content, start, windows, row)`` of a block's runs;
    128 is added to the windows of a run that may repeat inside."""
    h = gram_hashes(raw)
    if len(raw) < LENGTH:
        z = np.zeros(0, np.int64)
        return h, z.astype(np.uint64), z.astype(np.uint64), z, z, z
    key = sliding_min(h, LENGTH - GRAM + 1)
    start, n, row = runs_of(key, off, LENGTH, RUN)
    inside = repeats_inside(h, key, start, n)
    return h, key[start], contents(h, start, n), start, n + 128 * inside, row


def contents(h: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of all bytes that the windows ``start .. start + n - 1`` cover."""
    end = start + n - 1 + LENGTH - GRAM
    x = n.astype(np.uint64) * _M[1]
    for j in range(0, RUN + LENGTH, GRAM):
        x = mix(x * _M[0] + h[np.minimum(start + j, end)])
    return x


def single_windows(h: np.ndarray, start: np.ndarray, n: np.ndarray):
    """The windows of some runs one by one: ``(which run, key, content, start)``."""
    which = np.repeat(np.arange(len(n)), n)
    at = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    a, b = h[at], h[at + GRAM]
    c, d = h[at + 2 * GRAM], h[at + LENGTH - GRAM]
    return which, mix(a * _M[0] + mix(b * _M[1] + mix(c + d * _M[2]))), mix(d * _M[3] + mix(c * _M[0] + mix(b + a))), at


class Runs:
    """Runs gathered by a task: key, content, document, start, windows."""

    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)

    def __init__(self):
        self.parts: list[tuple] = []
        self.n = 0

    def add(self, *cols) -> None:
        self.parts.append(cols)
        self.n += len(cols[0])

    def collapsed(self):
        """``(earliest of each key and content, the later ones)``, each as five arrays sorted by key."""
        cols = [np.concatenate([p[i] for p in self.parts]).astype(k) if self.parts else np.zeros(0, k)
                for i, k in enumerate(self.kinds)]
        self.parts, self.n = [], 0
        order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
        cols = [c[order] for c in cols]
        key, content, doc, start, _ = cols
        new = np.r_[True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])] if len(key) else np.zeros(0, bool)
        lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)) if len(key) else np.zeros(0, np.int64)
        later = (doc != doc[lead]) | (start != start[lead])
        return [c[new] for c in cols], [c[later] for c in cols]


def _rows(b: pa.RecordBatch, i: int, j: int) -> np.ndarray:
    return np.array([NULL_ID if v is None else v for v in b.column(0).slice(i, j - i).to_pylist()], np.int64)


def frequent_hashes(docs: DataFrame, buckets: int) -> np.ndarray:
    """Hashes with more than a bucket's share of all runs, at most ``2 * buckets``."""
    def run(batches):
        runs = Runs()

        def out():
            total = runs.n
            (key, *_), _ = runs.collapsed()
            k, c = np.unique(key, return_counts=True)
            many = c >= max(FREQUENT, total // (2 * buckets))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.r_[k[many].view(np.int64), 0]), pa.array(np.r_[c[many], 0]),
                 pa.array(np.r_[np.zeros(many.sum(), np.int64), total])], names=["key", "n", "total"])
        for b in batches:
            for _, _, raw, off in text_blocks(b, limit=BLOCK):
                _, key, content, start, n, row = block_runs(raw, off)
                runs.add(key, content, row, start, n)
                if runs.n > GATHER:
                    yield out()
        if runs.n:
            yield out()

    found = docs.select("doc_id", "text").mapInArrow(run, "key long, n long, total long")
    found = written(found.groupBy("key").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "frequent-hashes", FILES_PER_CORE)
    total = found.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    rows = found.where((F.col("n") >= max(FREQUENT, total // (2 * buckets))) & (F.col("n") > 0)).select("key").collect()
    return np.sort(np.array([r["key"] for r in rows], np.int64).view(np.uint64))


_RUN_ROWS = "bucket int, later boolean, cols binary"


def _pack(cols, kinds) -> bytes:
    return b"".join(c.astype(k).tobytes() for c, k in zip(cols, kinds))


def _unpack(blob: bytes, kinds) -> list[np.ndarray]:
    width = sum(np.dtype(k).itemsize for k in kinds)
    n, at, out = len(blob) // width, 0, []
    for k in kinds:
        out.append(np.frombuffer(blob, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


_WIRE = ("<u8", "<u8", "<i8", "<u4", "<u1")
_PLACES = "doc_id long, later boolean, place long"


def _places(doc, start, n, later: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(np.full(len(doc), later)), pa.array(start * 128 + (n & 127))],
        names=["doc_id", "later", "place"])


def run_places(docs: DataFrame, buckets: int) -> DataFrame:
    """Step 1: ``(doc_id, later, place)``; ``place`` is 128 times a run's start
    plus its number of windows; ``later``: an equal run starts earlier, else: a run
    whose hash others with other bytes share, or that may repeat inside."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_hashes(docs, buckets))  # at most 2 * buckets

    def run(batches):
        runs, hot = Runs(), frequent.value

        def out():
            first, later = runs.collapsed()
            rows = []
            for what, cols in ((False, first), (True, later)):
                bucket = (cols[0] % _U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                cols = [c[order] for c in cols]
                rows += [(k, what, _pack([c[cut[k]:cut[k + 1]] for c in cols], _WIRE))
                         for k in range(buckets) if cut[k + 1] > cut[k]]
            ks, ls, bs = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(ls, pa.bool_()),
                                               pa.array(bs, pa.binary())], names=["bucket", "later", "cols"])
        for b in batches:
            for i, j, raw, off in text_blocks(b, limit=BLOCK):
                h, key, content, start, n, row = block_runs(raw, off)
                doc = _rows(b, i, j)
                if len(hot) and len(key):
                    often = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
                    which, k2, c2, at = single_windows(h, start[often], n[often] & 127)
                    r2 = row[often][which]
                    runs.add(k2, c2, doc[r2], at - off[r2], np.ones(len(at), np.int64))
                    key, content, start, n, row = (x[~often] for x in (key, content, start, n, row))
                runs.add(key, content, doc[row] if len(row) else row, start - off[row] if len(row) else start, n)
                if runs.n > GATHER:
                    yield out()
        if runs.n:
            yield out()

    def bucket(table: pa.Table) -> pa.Table:
        runs, batches = Runs(), []
        for late, blob in zip(table["later"].to_pylist(), table["cols"].to_pylist()):
            cols = _unpack(blob, _WIRE)
            if late:
                batches.append(_places(cols[2], cols[3].astype(np.int64), cols[4].astype(np.int64), True))
            else:
                runs.add(*cols)
        (key, _, doc, start, n), (_, _, d2, s2, n2) = runs.collapsed()
        batches.append(_places(d2, s2, n2, True))
        other = n > 127  # the run may repeat inside, or its hash also stands for other bytes
        if len(key):
            same = key[1:] == key[:-1]
            other[1:] |= same
            other[:-1] |= same
        batches.append(_places(doc[other], start[other], n[other], False))
        return pa.Table.from_batches(batches)

    return docs.select("doc_id", "text").mapInArrow(run, _RUN_ROWS).groupBy("bucket").applyInArrow(bucket, _PLACES)


def _per_document(places: DataFrame) -> DataFrame:
    return places.groupBy("doc_id").agg(F.collect_list("place").alias("places"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text")


def repeats_among(texts: list[bytes], doc: np.ndarray, start: np.ndarray):
    """``(doc, start)`` of the windows of ``texts`` that occur earlier among
    them; ``doc`` and ``start`` say where each text stands."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    off = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    h = gram_hashes(raw)
    core = mix(h[:len(h) - (CORE - GRAM)] * _M[0]
               + mix(h[GRAM:len(h) - (CORE - 2 * GRAM)] * _M[1] + h[CORE - GRAM:]))  # CORE bytes from each place on
    key = sliding_min(core, LENGTH - CORE + 1)
    at, n, row = runs_of(key, off, LENGTH, LENGTH - CORE + 1)
    runs = Runs()
    inside = repeats_inside(core, key, at, n)
    runs.add(key[at], contents(h, at, n), doc[row], start[row] + at - off[row], n + 128 * inside)
    # the bytes of a run, by its place: equal places have equal bytes
    where = {(int(d), int(s)): (int(a), int(k)) for d, s, a, k in
             zip(doc[row], start[row] + at - off[row], at, n)}
    first, later = runs.collapsed()
    many = later[4] & 127
    out_d = [np.repeat(later[2], many)]
    out_s = [np.repeat(later[3], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
    k = first[0]
    if len(k):
        same = k[1:] == k[:-1]
        shared = np.r_[False, same] | np.r_[same, False] | (first[4] > 127)
        fd, fs = first[2][shared], first[3][shared]
        strings = []
        for d, s in zip(fd.tolist(), fs.tolist()):
            a, m = where[d, s]
            strings.append(raw[a:a + m - 1 + LENGTH].tobytes())
        string, length, lcp = collection_bwt(strings, LENGTH)
        if len(string):
            size = np.array([len(x) for x in strings])
            d = fd[string]
            s = fs[string] + size[string] - length
            cluster = np.cumsum(lcp < LENGTH)
            order = np.lexsort((s, d, cluster))
            lead = np.r_[True, cluster[order][1:] != cluster[order][:-1]]
            head = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
            again = (d[order] != d[head]) | (s[order] != s[head])
            out_d.append(d[order][again])
            out_s.append(s[order][again])
    return np.concatenate(out_d), np.concatenate(out_s)


def suffix_places(docs: DataFrame, candidates: DataFrame, buckets: int) -> DataFrame:
    """Step 2: the repeated windows among runs that share a hash, as step 1's rows."""
    both = _keyed(docs).join(_per_document(candidates), "doc_id")
    kinds = ("<i8", "<i8", "<i8")

    def cut(batches):
        for b in batches:
            hold: dict[int, list] = {}
            for doc, text, places in zip(b["doc_id"].to_pylist(), b["text"], b["places"].to_pylist()):
                raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                place = np.unique(np.array(places, np.int64))
                start, n = place >> 7, place & 127
                fits = start + n - 1 + LENGTH <= len(raw)
                h = gram_hashes(raw)
                for s, k in zip(start[fits].tolist(), n[fits].tolist()):
                    key = int(h[s:s + k - 1 + LENGTH - GRAM + 1].min())
                    hold.setdefault(key % buckets, []).append((doc, s, raw[s:s + k - 1 + LENGTH].tobytes()))
            ks, heads, bodies = [], [], []
            for k, items in hold.items():
                d, s, t = zip(*items)
                ks.append(k)
                heads.append(_pack([np.array(d), np.array(s), np.array([len(x) for x in t])], kinds))
                bodies.append(b"".join(t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ks, pa.int32()), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())],
                names=["bucket", "head", "body"])

    def bucket(table: pa.Table) -> pa.Table:
        doc, start, texts = [], [], []
        for head, body in zip(table["head"].to_pylist(), table["body"].to_pylist()):
            d, s, n = _unpack(head, kinds)
            e = np.r_[0, np.cumsum(n)]
            texts += [body[e[i]:e[i + 1]] for i in range(len(n))]
            doc.append(d)
            start.append(s)
        d, s = repeats_among(texts, np.concatenate(doc), np.concatenate(start))
        return pa.Table.from_batches([_places(d, s, np.ones(len(d), np.int64), True)])

    return both.select("doc_id", "text", "places").mapInArrow(
        cut, "bucket int, head binary, body binary").groupBy("bucket").applyInArrow(bucket, _PLACES)


def kept_bytes(raw: np.ndarray, places: list | None) -> tuple[np.ndarray, int]:
    """The mask of the bytes that stay, and the number of runs of those that go."""
    n = len(raw)
    edge = np.zeros(n + 1, np.int64)
    if places:
        place = np.unique(np.array(places, np.int64))
        start, stop = place >> 7, (place >> 7) + (place & 127) - 1 + LENGTH
        fits = stop <= n
        np.add.at(edge, start[fits], 1)
        np.add.at(edge, stop[fits], -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()) if n else 0
    return ~gone, spans


def repeated_places(docs: DataFrame) -> DataFrame:
    """``(doc_id, places)``: per document, all windows that also start
    earlier, written to the shared scratch folder."""
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * docs.rdd.getNumPartitions())
    docs = docs.select("doc_id", "text")
    first = written(run_places(docs, buckets), "runs", FILES_PER_CORE)
    more = written(suffix_places(docs, first.where("not later"), buckets), "suffix-repeats", FILES_PER_CORE)
    return _per_document(first.where("later").union(more))


def _with_places(docs: DataFrame) -> DataFrame:
    places = repeated_places(docs).withColumnRenamed("doc_id", "__doc")
    return docs.join(places, F.coalesce(docs["doc_id"], F.lit(NULL_ID)) == places["__doc"], "left").drop("__doc")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` as ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    def run(batches):
        for b in batches:
            out = []
            for text, places in zip(b["text"], b["places"].to_pylist()):
                data = (text.as_py() or "").encode()
                raw = np.frombuffer(data, np.uint8)
                keep, spans = kept_bytes(raw, places)
                rest = raw[keep].tobytes() if spans else data
                out.append((len(raw), len(raw) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_places(docs.select("doc_id", "text")).select("doc_id", "text", "places").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (all its columns) with the repeated bytes cut out of ``text``;
    characters that lose some of their bytes go whole, and a given ``n_chars``
    follows the text."""
    out_schema = docs.schema

    def run(batches):
        for b in batches:
            texts = []
            for text, places in zip(b["text"], b["places"].to_pylist()):
                t = text.as_py()
                if t is not None and places:
                    raw = np.frombuffer(t.encode(), np.uint8)
                    t = raw[kept_bytes(raw, places)[0]].tobytes().decode("utf-8", "ignore")
                texts.append(t)
            cols = {f.name: b[f.name] for f in out_schema}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                size = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                cols["n_chars"] = size.cast(b["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return _with_places(docs).mapInArrow(run, out_schema)
