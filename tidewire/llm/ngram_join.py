"""Set-similarity join of word n-grams under several global token orders.

Whatever order all documents sort their n-grams by, two sets that reach the similarity share
one among the first ``n - ceil(t n) + 1`` of each.  That holds for every order at the same
time, so a pair is a candidate only if its prefixes meet under all ``ORDERS`` orders: the first one
makes the pairs (an inverted list per n-gram, cut by position and set size), the others throw out
those whose prefixes are disjoint, and full sets confirm what is left.

Every order puts rare n-grams first.  Counts come from one pass over all texts, in a table of
``CELLS`` cells for each order, with a cell hash of its own, and equal counts stand in the order of another
hash: the orders are independent of each other, and what many documents share comes last
in all of them.  Any order gives the right result; a sharper one makes shorter lists.

Links only decide which documents hang together, so no group of copies becomes pairs.
Equal sets collapse to one representative.  Then each document is compared with the most central
document of the lists it stands in, the one that shares most lists with it; last, every list
that still holds documents of several components brings those together, documents outside
the list's largest component against all, ``TOGETHER`` at a time.  No list is capped.

Defined cases: a null or blank text has no n-grams and links with nothing; a text of fewer words
than an n-gram has one, all its words; a null ``doc_id`` links with nothing and has a null
component; repeated rows are copies of each other; different texts under one ``doc_id``
are one document that is linked through any of them; ties of any kind change the work, not the
result.  A very long text is held whole by its task.  An empty table gives an empty
result; columns besides the id and the text are not read.  Within a crowd of documents whose similarity is
just below the limit the last step compares pairs, so its time grows with the square of that crowd.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.components import components
from tidewire.llm.core import FILES_PER_CORE, mix, text_blocks, written
from tidewire.llm.near_dedup import block_shingles, merged, packed_texts, shingle_sets

WORDS, PERCENT = 5, 80
#: Token orders, and cells of the count table of each.
ORDERS, CELLS = 3, 1 << 18
#: Slices of a count table that are added up apart.
SLICES = 16
#: Documents of a list that one task compares with others.
TOGETHER = 2000
#: Bytes of text worked on together.
BLOCK = 1 << 18

_U = np.uint64


def _cells(x: np.ndarray, order: int) -> np.ndarray:
    return (mix(x + _U(order * 0x9E3779B9)) >> _U(40)).astype(np.int64) & (CELLS - 1)


def keys_and_counts(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One pass, two kinds of rows: ``(doc_id, n, hi, lo)`` of each text, the number of its
    n-grams and a 128-bit key of the set; and what a task has counted, per order and slice
    the cells that are not zero and their counts."""
    width = CELLS // SLICES
    names = ["doc_id", "n", "hi", "lo", "slice", "cells", "counts"]

    def run(batches):
        have = np.zeros((ORDERS, CELLS), np.int64)
        for b in batches:
            for i, j, raw, off in text_blocks(b, limit=BLOCK):
                x, row = block_shingles(raw, off, words)
                n = np.bincount(row, minlength=j - i)
                used = np.flatnonzero(n)
                first = np.cumsum(n)[used] - n[used]
                hi, lo = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                if len(used):
                    hi[used], lo[used] = np.add.reduceat(x, first), np.add.reduceat(mix(x + _U(1)), first)
                for k in range(ORDERS):
                    have[k] += np.bincount(_cells(x, k), minlength=CELLS)
                none = pa.nulls(j - i, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(hi.view(np.int64)),
                     pa.array(lo.view(np.int64)), pa.nulls(j - i, pa.int32()), none, none], names=names)
        for k in range(ORDERS * SLICES):
            part = have.reshape(ORDERS * SLICES, width)[k]
            at = np.flatnonzero(part)
            if len(at):
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, none, none, none, pa.array([k], pa.int32()), pa.array([at.astype("<i4").tobytes()], pa.binary()),
                     pa.array([part[at].astype("<i8").tobytes()], pa.binary())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, hi long, lo long, slice int, cells binary, counts binary")


def count_tables(parts: DataFrame) -> np.ndarray:
    """The corpus' counts, one table per order.  Each core first adds up what it reads."""
    width = CELLS // SLICES

    def add(total: np.ndarray, batch) -> None:
        for k, cells, counts in zip(*(c.to_pylist() for c in batch.columns)):
            np.add.at(total[k], np.frombuffer(cells, "<i4"), np.frombuffer(counts, "<i8"))

    def rows(total: np.ndarray):
        used = np.flatnonzero(total.any(axis=1))
        at = np.arange(width, dtype="<i4").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([at] * len(used), pa.binary()),
             pa.array([total[k].astype("<i8").tobytes() for k in used], pa.binary())], names=["slice", "cells", "counts"])

    def run(batches):
        total = np.zeros((ORDERS * SLICES, width), np.int64)
        for b in batches:
            add(total, b)
        yield rows(total)

    def fold(group: pa.Table) -> pa.Table:  # a row per core
        total = np.zeros((ORDERS * SLICES, width), np.int64)
        for b in group.select(["slice", "cells", "counts"]).to_batches():
            add(total, b)
        return pa.Table.from_batches([rows(total)])

    kind = "slice int, cells binary, counts binary"
    cores = parts.sparkSession.sparkContext.defaultParallelism
    got = parts.coalesce(cores).mapInArrow(run, kind).groupBy("slice").applyInArrow(fold, kind)
    out = np.zeros((ORDERS * SLICES, width), np.int64)
    for r in got.select("slice", "counts").collect():  # ORDERS * CELLS numbers
        out[r["slice"]] = np.frombuffer(r["counts"], "<i8")
    return out.reshape(ORDERS, CELLS)


def prefixes(docs: DataFrame, counts: np.ndarray, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n, hi, lo, grams, others, central)``: of each text the prefixes under all orders, and
    how frequent the first one is."""
    state = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 62)))  # fixed by ORDERS and CELLS

    def run(batches):
        table = state.value
        for b in batches:
            for i, j, raw, off in text_blocks(b, limit=BLOCK):
                x, row = block_shingles(raw, off, words)
                n = np.bincount(row, minlength=j - i).astype(np.int64)
                before = np.cumsum(n) - n
                hi, lo = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                used = np.flatnonzero(n)
                if len(used):
                    hi[used], lo[used] = np.add.reduceat(x, before[used]), np.add.reduceat(mix(x + _U(1)), before[used])
                place = np.arange(len(x)) - before[row]
                prefix = place < (n - (percent * n + 99) // 100 + 1)[row]
                edge = np.r_[0, np.cumsum(np.bincount(row[prefix], minlength=j - i))].astype(np.int32)
                lists = []
                for k in range(ORDERS):
                    count = table[k][_cells(x, k)]
                    # texts apart, rare first, equal counts by a hash; the sort keeps the order of x among equals
                    order = np.lexsort((mix(x ^ _U(k + 1)), count, row))
                    lists.append(x[order][prefix])
                    if not k:
                        weight = np.log(np.maximum(1, count[order][prefix]))
                central = np.bincount(row[prefix], weights=weight, minlength=j - i) / np.maximum(1, np.diff(edge))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)),
                     pa.ListArray.from_arrays(edge, pa.array(lists[0].view(np.int64))),
                     *[pa.ListArray.from_arrays(edge, pa.array((g >> _U(32)).astype(np.uint32).view(np.int32)))
                       for g in lists[1:]], pa.array(central.astype(np.float32))],
                    names=["doc_id", "n", "hi", "lo", "grams", *_OTHERS, "central"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, hi long, lo long, grams array<long>, "
             + "".join(f"{c} array<int>, " for c in _OTHERS) + "central float")


_OTHERS = [f"order{k}" for k in range(1, ORDERS)]


def shared_grams(reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(g, doc_id, n, most, crowd, hub)``: the rows of the first order's inverted lists that hold
    several documents.  ``most`` is the largest set that can still be linked if this is the first n-gram in
    common; ``hub`` is a most central document of the list."""
    rows = reps.select(F.posexplode("grams").alias("place", "g"), "doc_id", F.col("n").cast("int").alias("n"), "central")
    # lists of one document, most of them, go before anything else is known of them
    held = written(rows.groupBy("g").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1"), "held", FILES_PER_CORE)
    rows = written(rows.join(held.hint("merge"), "g"), "several", FILES_PER_CORE)
    lists = written(rows.groupBy("g").agg(F.max_by("doc_id", "central").alias("hub"), F.min("n").alias("least")),
                    "lists", FILES_PER_CORE)
    most = F.floor((100 + percent) * (F.col("n") - F.col("place")) / percent) - F.col("n")
    return rows.join(lists.hint("merge"), "g").withColumn("most", most.cast("int")).where("most >= least").select(
        "g", "doc_id", "n", "most", "crowd", "hub")


def in_all_orders(pairs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` whose set sizes allow a link and whose prefixes meet under the other orders, too."""
    def side(id_, tag):
        return reps.select(F.col("doc_id").alias(id_), F.col("n").alias(f"n{tag}"),
                           *[F.col(c).alias(f"{c}{tag}") for c in _OTHERS])
    both = pairs.join(side("a", "a").hint("merge"), "a").join(side("b", "b").hint("merge"), "b").where(
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    for c in _OTHERS:
        both = both.where(F.arrays_overlap(f"{c}a", f"{c}b"))
    return both.select("a", "b").distinct()  # ids with several texts come several times


def linked(pairs: DataFrame, docs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """The pairs whose full sets reach the similarity.  Nothing bounds the pairs, so they are
    never broadcast: both joins are shuffles at every size."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    some = packed_texts(docs).join(ends.hint("merge"), "doc_id", "left_semi").dropDuplicates()
    sets = written(shingle_sets(some, words), f"{name}-sets", FILES_PER_CORE)
    left = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")).hint("merge")
    right = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")).hint("merge")
    both = pairs.join(left, "a").join(right, "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return both.where(100 * F.col("i") >= percent * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b")


def _pair(x, y) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def to_hubs(shared: DataFrame) -> DataFrame:
    """Each document with the hub it meets in most lists."""
    votes = shared.where("doc_id <> hub").groupBy("doc_id", "hub").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("doc_id").agg(F.max_by("hub", "votes").alias("hub"))
    return best.select(*_pair("doc_id", "hub")).distinct()


def across(shared: DataFrame, at: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs of documents of different components ``at(node, root)`` that meet in a list,
    early enough for their sizes."""
    rows = written(shared.drop("hub").join(at.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "root", F.coalesce("root", "doc_id")), "rooted", FILES_PER_CORE)
    held = rows.groupBy("g", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = written(held.groupBy("g").agg(F.max_by("root", "c").alias("main"), F.count(F.lit(1)).alias("roots")).where(
        "roots > 1").select("g", "main"), "mixed-lists", FILES_PER_CORE)
    rows = written(rows.join(mixed.hint("merge"), "g").withColumn("blocks", F.ceil(F.col("crowd") / TOGETHER).cast("int")),
                   "mixed-rows", FILES_PER_CORE)
    some = rows.where("root <> main").select(
        "g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("doc_id").alias("x"),
        F.col("n").alias("nx"), F.col("most").alias("mx"), F.col("root").alias("rx"))
    all_ = rows.select("g", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int").alias("block"),
                       F.col("doc_id").alias("y"), F.col("n").alias("ny"), F.col("most").alias("my"),
                       F.col("root").alias("ry"), "main")
    # of two documents outside the main component one meets the other
    met = some.join(all_, ["g", "block"]).where("rx <> ry and (ry = main or x < y) and ny <= mx and nx <= my").where(
        100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
    return met.select(*_pair("x", "y")).distinct()


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs(doc_id, text)`` as ``doc_id, n_shingles, component_id``, one row per row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = written(keys_and_counts(docs, words), "keys")
    counts = count_tables(seen.where("slice is not null").select("slice", "cells", "counts"))
    keys = seen.where("slice is null").select("doc_id", "n", "hi", "lo")
    own = keys.where("n > 0 and doc_id is not null")
    groups = written(own.groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("rep")), "groups", FILES_PER_CORE)
    reps = prefixes(docs, counts, words, percent).join(
        groups.select(F.col("rep").alias("doc_id"), "n", "hi", "lo"), ["doc_id", "n", "hi", "lo"])
    reps = written(reps.dropDuplicates(["doc_id", "n", "hi", "lo"]), "prefixes", FILES_PER_CORE)
    shared = written(shared_grams(reps, percent), "shared", FILES_PER_CORE)
    pairs = written(in_all_orders(to_hubs(shared), reps, percent), "hub-pairs", FILES_PER_CORE)
    at = written(components(linked(pairs, docs, words, percent, "hub")), "hub-roots", FILES_PER_CORE)
    pairs = written(in_all_orders(across(shared, at, percent), reps, percent), "pairs", FILES_PER_CORE)
    roots = merged(at, linked(pairs, docs, words, percent, "pair"))
    member = own.join(groups, ["n", "hi", "lo"]).select("doc_id", "n", "rep")
    found = member.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id"))
    alone = keys.where("n = 0 or doc_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(alone)
