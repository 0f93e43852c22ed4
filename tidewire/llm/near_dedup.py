"""Near-duplicate documents by an LSH forest of MinHash signatures.

Documents with the same shingle set collapse to one representative.  Each
representative has a signature per tree; a tree sorts all signatures, and
neighbours in that order with a long enough common prefix are candidates.  The
depth adapts to the region: documents that share only the least prefix are
neighbours where a region is sparse; in a crowded one the sort by the deeper
values brings those with longer common prefixes together.  A crowded region
also compares each of its documents with its most central one, the document
that meets most others over all trees, so that a group of copies hangs
together through the text they were copied from.

Candidates are pruned by set size and by parity bitmaps of the sets, which rule out
no link, and confirmed on the full shingle sets: first each document's best candidate,
then, for documents not yet in one component, all others.  A document has at most
``NEAR + 1`` candidates per tree, so trees miss links in crowded regions.  What they
miss an exact prefix-filter join finds: documents of different components that share
a shingle among their rarest ones, early enough for a link, are confirmed too.

Tables of documents, pairs and shingles have no size bound and are shuffled by key at
every size, never broadcast; those of the trees are deleted when their components are
written.

Defined cases: a null or blank text has no shingles and links with nothing; a
text of fewer words than a shingle has one shingle, all its words; a null
``doc_id`` links with nothing, has a null component and is kept; repeated rows
are copies of each other, with one ``doc_id`` all of them are kept; different
texts under one ``doc_id`` are one document that is linked through any of them; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.components import components
from tidewire.llm.core import (FILES_PER_CORE, LOWER, batch_bytes, discard, mix, shingle_hashes, text_blocks, word_hashes,
                               words_of, written)

WORDS, PERCENT = 4, 80
#: Trees, signature values of the least common prefix, and deeper values in the order.
TREES, DEPTH, DEEPER = 24, 4, 3
#: Following neighbours that each document is compared with in each tree.
NEAR = 3
#: Bits of a set's parity bitmap.
BITS = 1024
#: Cells of the counts that order shingles from rare to frequent (any order is right,
#: a sharper one is cheaper).
CELLS = 1 << 20
#: Documents of a shingle that one task compares with others, and parts of a shingle's
#: documents where they meet its counts.
TOGETHER, PARTS = 2000, 16
#: Bytes of text worked on together: a Python worker holds a dozen arrays of that many words.
BLOCK = 1 << 18
#: Bytes of an Arrow batch on its way to Python.
BATCH = 1 << 21

_U = np.uint64


def _seeds(n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def block_shingles(raw: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of the distinct shingles of each text of a block."""
    low = LOWER[raw]
    start, end, row = words_of(low, off)
    h, row = shingle_hashes(word_hashes(low, start, end), row, words)
    # one sort of plain integers: the row above, as many bits of the hash as fit below
    bits = _U(max(1, int(len(off)).bit_length()))
    order = np.argsort((row.astype(np.uint64) << (_U(64) - bits)) | (h >> bits))
    h, row = h[order], row[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.zeros(0, bool)
    return h[new], row[new]


def signatures(docs: DataFrame, words: int = WORDS, trees: int = TREES, depth: int = DEPTH,
               deeper: int = DEEPER) -> DataFrame:
    """Per document: the number of shingles, a 128-bit key of the set, per tree
    a key of the first ``depth`` values and one of the deeper ones, and a bitmap
    of the set: bit ``i`` is the parity of the shingles whose hash is ``i`` mod ``BITS``."""
    n_values = trees * depth

    def run(batches):
        mul, add = _seeds(n_values)
        at = (np.arange(trees)[:, None] * depth + np.arange(depth + deeper)) % (trees * depth)
        for b in batches:
            for i, j, raw, off in text_blocks(b, limit=BLOCK):
                n = j - i
                x, row = block_shingles(raw, off, words)
                count = np.bincount(row, minlength=n)
                have = np.flatnonzero(count)
                first = np.cumsum(count)[have] - count[have]
                hi, lo = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                sig = np.zeros((n, n_values), np.uint32)
                bitmap = np.zeros((n, BITS // 8), np.uint8)
                np.bitwise_xor.at(bitmap, (row, ((x % _U(BITS)) >> _U(3)).astype(np.int64)),
                                  np.uint8(1) << (x & _U(7)).astype(np.uint8))
                if len(have):
                    hi[have] = np.add.reduceat(x, first)
                    lo[have] = np.add.reduceat(mix(x + _U(1)), first)
                    small = (x >> _U(32)).astype(np.uint32)
                    for p in range(n_values):
                        sig[have, p] = np.minimum.reduceat(small * mul[p] + add[p], first)
                wide = sig[:, at].astype(np.uint64)  # (n, trees, depth + deeper)
                head = np.broadcast_to(np.arange(trees, dtype=np.uint64), (n, trees)).copy()
                for d in range(depth):
                    head = mix(head * _U(0x9E3779B97F4A7C15) + wide[:, :, d] + _U(1))
                tail = np.zeros((n, trees), np.uint64)
                for d in range(depth, depth + deeper):
                    tail = (tail << _U(21)) | (wide[:, :, d] >> _U(11))
                lists = np.arange(n + 1, dtype=np.int32) * trees
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), pa.array(count.astype(np.int64)), pa.array(hi.view(np.int64)),
                     pa.array(lo.view(np.int64)),
                     pa.ListArray.from_arrays(lists, pa.array(head.view(np.int64).ravel())),
                     pa.ListArray.from_arrays(lists, pa.array(tail.view(np.int64).ravel())),
                     pa.array([r.tobytes() for r in bitmap], pa.binary())],
                    names=["doc_id", "n", "hi", "lo", "head", "tail", "bits"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, hi long, lo long, head array<long>, tail array<long>, bits binary")


def forest(reps: DataFrame) -> DataFrame:
    """``(head, tail, doc_id)``: the place of each representative in each tree,
    where its least prefix is shared."""
    rows = reps.select("doc_id", F.explode(F.arrays_zip("head", "tail")).alias("t")).select(
        F.col("t.head").alias("head"), F.col("t.tail").alias("tail"), "doc_id")
    shared = rows.groupBy("head").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    return rows.join(shared.hint("merge"), "head")


def neighbours(places: DataFrame, near: int = NEAR) -> DataFrame:
    """Pairs of documents at most ``near`` apart in the sorted order of a
    tree with a common prefix.  The order is a range partitioning by the whole
    signature, so a crowded region spreads over tasks; what stands at the edges of
    two partitions is compared in a second, small step."""
    def link(head: np.ndarray, doc: np.ndarray):
        a, b = [], []
        for d in range(1, near + 1):
            same = head[d:] == head[:-d]
            a.append(doc[:-d][same])
            b.append(doc[d:][same])
        return np.concatenate(a), np.concatenate(b)

    def run(batches):
        part = TaskContext.get().partitionId()
        names = ["kind", "part", "head", "a", "b"]

        def out(kind, heads, a, b):
            n = len(a)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(heads),
                 pa.array(a), pa.array(b)], names=names)
        none = np.zeros(0, np.int64)
        last_h, last_d, begun = none, none, False
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            d = batch.column(2).to_numpy(zero_copy_only=False)
            if not len(h):
                continue
            if not begun:
                yield out(1, h[:near], d[:near], d[:near])
                begun = True
            a, b = link(np.r_[last_h, h], np.r_[last_d, d])
            yield out(0, np.zeros(len(a), np.int64), a, b)
            last_h, last_d = np.r_[last_h, h][-near:], np.r_[last_d, d][-near:]
        yield out(2, last_h, last_d, last_d)

    ordered = places.select("head", "tail", "doc_id").repartitionByRange("head", "tail", "doc_id")
    got = written(ordered.sortWithinPartitions("head", "tail", "doc_id").mapInArrow(
        run, "kind int, part int, head long, a long, b long"), "neighbours")  # one task per range: `part` counts them
    first = got.where("kind = 1").select("head", F.col("a").alias("b"), F.col("part").alias("at"))
    last = got.where("kind = 2").select("head", "a", (F.col("part") + 1).alias("at"))
    return got.where("kind = 0").select("a", "b").union(last.join(first, ["head", "at"]).select("a", "b"))


def hubs(places: DataFrame) -> DataFrame:
    """Pairs of each document with the most central one of its region."""
    central = places.groupBy("doc_id").agg(F.sum(F.log("crowd")).alias("central"))
    rows = places.select("head", "doc_id").join(central.hint("merge"), "doc_id")
    best = rows.groupBy("head").agg(F.max(F.struct("central", -F.col("doc_id"))).alias("m")).select(
        "head", (-F.col("m")["col2"]).alias("hub"))
    return rows.join(best.hint("merge"), "head").select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))


def likely(pairs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(a, b, share)``: pairs whose set sizes and bitmaps allow a link.  Sets
    differ in at least as many shingles as their bitmaps in bits, so no link is lost;
    ``share`` only tells which candidate to confirm first."""
    p = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    s = reps.select("doc_id", "n", "bits")
    left = s.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    right = s.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
    both = p.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select(
        "a", "b", (F.col("na") + F.col("nb")).alias("size"), "ba", "bb")

    def run(batches):
        for x in batches:
            if not x.num_rows:
                continue
            u, v = (np.frombuffer(b"".join(x.column(k).to_pylist()), np.uint64).reshape(x.num_rows, -1) for k in (3, 4))
            differ = np.bitwise_count(u ^ v).sum(axis=1, dtype=np.int64)
            size = x.column(2).to_numpy(zero_copy_only=False)
            ok = pa.array((100 + percent) * differ <= (100 - percent) * size)
            yield pa.RecordBatch.from_arrays([x.column(0).filter(ok), x.column(1).filter(ok),
                                              pa.array(1 - differ / size).filter(ok)], names=["a", "b", "share"])
    # ids with several texts have several bitmaps
    return both.mapInArrow(run, "a long, b long, share double").groupBy("a", "b").agg(F.max("share").alias("share"))


def packed_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, packed)``: texts compressed one by one, for a shuffle that moves them all."""
    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([pack((t.as_py() or "").encode()) for t in b.column(1)], pa.binary())],
                names=["doc_id", "packed"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, packed binary")


def shingle_sets(packed: DataFrame, words: int = WORDS) -> DataFrame:
    """``(doc_id, s)``: the distinct shingles of each text as 64-bit hashes."""
    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            begin, texts, size = 0, [], 0
            for end, t in enumerate(b.column(1), 1):  # a few packed bytes can be a long text
                texts.append(unpack(t.as_py()))
                size += len(texts[-1])
                if size < BLOCK and end < b.num_rows:
                    continue
                some = pa.RecordBatch.from_arrays(
                    [b.column(0).slice(begin, end - begin), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "text"])
                begin, texts, size = end, [], 0
                for i, j, raw, off in text_blocks(some, limit=BLOCK):
                    flat, row = block_shingles(raw, off, words)
                    flat = flat.view(np.int64)
                    edge = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).slice(i, j - i), pa.ListArray.from_arrays(edge, pa.array(flat))],
                        names=["doc_id", "s"])
    return packed.mapInArrow(run, "doc_id long, s array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = pairs.select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    both = both.withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("i") >= percent * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b")


def shingle_counts(docs: DataFrame, words: int = WORDS, cells: int = CELLS) -> np.ndarray:
    """How often shingles fall into each of ``cells`` cells of their hash."""
    slices = 64
    width = cells // slices

    def run(batches):
        have = np.zeros(cells, np.int32)
        for b in batches:
            for _, _, raw, off in text_blocks(b, limit=BLOCK):
                cell = (block_shingles(raw, off, words)[0] % _U(cells)).astype(np.int64)
                have += np.bincount(cell, minlength=cells).astype(np.int32)
        if have.any():
            part = have.reshape(slices, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(slices, dtype=np.int32)), pa.array([p.tobytes() for p in part], pa.binary())],
                names=["slice", "counts"])

    def add(parts: pa.Table) -> pa.Table:  # as many rows as tasks, that is, cores
        total = np.zeros(width, np.int64)
        for c in parts["counts"]:
            total += np.frombuffer(c.as_py(), "<i4")
        total = np.minimum(total, np.iinfo(np.int32).max).astype("<i4")
        return pa.table({"slice": parts["slice"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    tasks = docs.select("text").coalesce(docs.sparkSession.sparkContext.defaultParallelism)
    got = tasks.mapInArrow(run, "slice int, counts binary").groupBy("slice").applyInArrow(add, "slice int, counts binary")
    out = np.zeros((slices, width), np.int32)
    for r in got.collect():  # 64 rows, CELLS * 4 bytes
        out[r["slice"]] = np.frombuffer(r["counts"], "<i4")
    return out.ravel()


def rare_shingles(docs: DataFrame, counts: np.ndarray, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n, shingles, most)``: of each text the shingles, from rare to frequent,
    that can be the first one in common with a linked text, and the most shingles such a
    text can have.  Two sets whose first common shingle stands before ``r`` and ``q``
    remaining ones share at most the smaller of them, so a link needs
    ``(100 + percent) * r >= percent * (n + m)``, and the same of ``q``."""
    cells = len(counts)
    state = docs.sparkSession.sparkContext.broadcast(counts)  # fixed by CELLS

    def run(batches):
        for b in batches:
            for i, j, raw, off in text_blocks(b, limit=BLOCK):
                x, row = block_shingles(raw, off, words)
                order = np.lexsort((x, state.value[(x % _U(cells)).astype(np.int64)], row))
                x, row = x[order], row[order]
                n = np.bincount(row, minlength=j - i)
                left = np.repeat(np.cumsum(n), n) - np.arange(len(x))  # this one and those after it
                most = (100 + percent) * left // percent - n[row]
                use = 100 * most >= percent * n[row]
                x, row, most = x[use], row[use], most[use]
                edge = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(edge, pa.array(x.view(np.int64))),
                     pa.ListArray.from_arrays(edge, pa.array(most.astype(np.int32)))],
                    names=["doc_id", "n", "shingles", "most"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, shingles array<long>, most array<int>")


def unmet(docs: DataFrame, reps: DataFrame, at: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(a, b)``: every pair of representatives of different components ``at(node,
    root)`` that can be linked by its rare shingles and set sizes.  Shingles that only one
    component has are dropped by their counts; of the others, documents outside the largest
    component meet all documents, ``TOGETHER`` at a time."""
    ids = reps.select("doc_id").distinct().join(at.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("root"))
    rare = rare_shingles(docs, shingle_counts(docs, words), words, percent)
    rows = written(rare.join(ids.hint("merge"), "doc_id").select("doc_id", "n", "root", "shingles", "most").dropDuplicates(
        ["doc_id", "shingles"]), "rare-shingles", FILES_PER_CORE)
    rows = rows.select(F.explode(F.arrays_zip("shingles", "most")).alias("t"), "doc_id", "n", "root").select(
        F.col("t.shingles").alias("g"), F.col("t.most").alias("most"), "doc_id", "n", "root",
        F.pmod(F.hash("doc_id"), F.lit(PARTS)).alias("part"))
    shared = rows.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least"),
                                   F.count(F.lit(1)).alias("crowd")).where("lo <> hi")
    shared = shared.select("g", "least", "crowd", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    rows = written(rows.join(shared.hint("merge"), ["g", "part"]).where("most >= least").select(
        "g", "doc_id", "n", "most", "root", F.ceil(F.col("crowd") / TOGETHER).cast("int").alias("blocks")),
        "met-shingles", FILES_PER_CORE)
    main = rows.groupBy("g", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("g").agg(
        F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    main = main.select("g", F.col("m.root").alias("main"), F.explode(
        F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    rows = rows.withColumn("part", F.pmod(F.hash("doc_id"), F.lit(PARTS))).join(main.hint("merge"), ["g", "part"])
    some = rows.where("root <> main").select(
        "g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("doc_id").alias("a"),
        F.col("n").alias("na"), F.col("most").alias("ma"), F.col("root").alias("ra"))
    all_ = rows.select("g", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"), F.col("doc_id").alias("b"),
                       F.col("n").alias("nb"), F.col("most").alias("mb"), F.col("root").alias("rb"))
    pairs = some.join(all_.hint("merge"), ["g", "block"]).where("ra <> rb and nb <= ma and na <= mb").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def merged(at: DataFrame, links: DataFrame) -> DataFrame:
    """``at(node, root)`` after ``links(a, b)`` have joined its components; a node without
    links need not be in it."""
    ra = at.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = at.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    above = components(links.join(ra.hint("merge"), "a", "left").join(rb.hint("merge"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    up = above.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return at.join(up.hint("merge"), "root", "left").select("node", F.coalesce("top", "root").alias("root")).union(
        above.join(at.select("node").hint("merge"), "node", "left_anti"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs(doc_id, text)`` as ``doc_id, n_shingles, component_id, kept``.  All that
    Python works on is written here; what is left to the caller's statement are joins."""
    with batch_bytes(docs.sparkSession, BATCH):
        return _near_duplicates(docs, words, percent)


def _near_duplicates(docs: DataFrame, words: int, percent: int) -> DataFrame:
    docs = docs.select("doc_id", "text")
    sigs = written(signatures(docs, words), "signatures")
    own = sigs.where("n > 0 and doc_id is not null")
    groups = written(own.groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("rep")), "set-groups", FILES_PER_CORE)
    reps = own.join(groups.select(F.col("rep").alias("doc_id"), "n", "hi", "lo").hint("merge"), ["doc_id", "n", "hi", "lo"])
    reps = reps.dropDuplicates(["doc_id", "n", "hi", "lo"])
    places = written(forest(reps), "forest", FILES_PER_CORE)
    pairs = written(likely(neighbours(places).union(hubs(places)), reps, percent), "candidates", FILES_PER_CORE)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    some = packed_texts(docs).join(ends.hint("merge"), "doc_id", "left_semi").dropDuplicates()
    sets = written(shingle_sets(some, words), "sets", FILES_PER_CORE)
    # first the best candidate of every document
    best = pairs.select(F.explode(F.array("a", "b")).alias("d"), "share").groupBy("d").agg(F.max("share").alias("top"))
    tops = [pairs.join(best.withColumnRenamed("d", c).hint("merge"), c).where("share = top").groupBy(c).agg(
        F.min("b" if c == "a" else "a").alias("b" if c == "a" else "a")).select("a", "b") for c in ("a", "b")]
    at = components(confirmed(tops[0].union(tops[1]).distinct(), sets, percent))
    # then those that could still join two components
    ra = at.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = at.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    apart = pairs.join(ra.hint("merge"), "a", "left").join(rb.hint("merge"), "b", "left").withColumns(
        {"ra": F.coalesce("ra", "a"), "rb": F.coalesce("rb", "b")}).where("ra <> rb")
    at = written(merged(at, confirmed(apart, sets, percent)), "roots", FILES_PER_CORE)
    discard(places, pairs, sets)
    # last, what no tree brought together
    pairs = written(likely(unmet(docs, reps, at, words, percent), reps, percent), "unmet", FILES_PER_CORE)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    some = packed_texts(docs).join(ends.hint("merge"), "doc_id", "left_semi").dropDuplicates()
    sets = written(shingle_sets(some, words), "unmet-sets", FILES_PER_CORE)
    roots = merged(at, confirmed(pairs, sets, percent))
    member = own.select("doc_id", "n", "hi", "lo").join(groups.hint("merge"), ["n", "hi", "lo"]).select("doc_id", "n", "rep")
    linked = member.join(roots.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").select(
        "doc_id", "n", F.coalesce("root", "rep").alias("component_id"))
    alone = sigs.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.union(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` (all its columns) with one document of each group of near
    duplicates, the one with the smallest ``doc_id``; of repeated rows one stays.  Rows
    without a ``doc_id`` are copies of nothing and stay."""
    kept = near_duplicates(docs, words, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept.hint("merge"), "doc_id", "left_semi").select(*docs.columns)
    return named.dropDuplicates(["doc_id"]).union(docs.where("doc_id is null"))
