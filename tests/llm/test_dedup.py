"""Near-duplicates, repeated passages and the BWT against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.rows import edge_docs, empty_docs, prose, words
from tidewire.llm.bwt import collection_bwt
from tidewire.llm.components import components
from tidewire.llm.near_dedup import keep_first, near_duplicates
from tidewire.llm.suffix_dedup import cut_repeats, run_places, suffix_dedup

SF = "/root/testdata/sf0.001"


def _set(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _components(rows, k=4):
    sets = [(i, _set(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: find(i) for i, _ in sets}


def _near_rows():
    """Copies of three texts with a growing number of changed words, and
    texts right at the limit."""
    rows, rng, n = [], random.Random(4), 100
    for base in range(3):
        w = words(150, 50 + base)
        for k in range(14):
            v = list(w)
            for _ in range(k // 2):
                v[rng.randrange(len(v))] = f"new{rng.randrange(10**6)}"
            rows.append((n, " ".join(v).upper() if k == 3 else " ".join(v)))
            n += 1
    a = words(19, 77)  # 16 shingles; with one word more or less at the end 16/17
    rows += [(n, " ".join(a)), (n + 1, " ".join(a[:-1])), (n + 2, " ".join(a[:16])), (n + 3, "one two three")]
    return rows


def test_near_duplicates_against_brute_force(spark):
    docs = edge_docs(spark, _near_rows()).union(spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id + 1000", "text", "lang", "source", "n_chars", "0.0D", "true", "''"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = near_duplicates(docs).collect()
    assert len(out) == len(rows)
    want = _components(rows)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == want
    assert sorted(((r.doc_id, r.n_shingles) for r in out), key=str) == sorted(((i, len(_set(t))) for i, t in rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)]


def test_keep_first_keeps_one_row_of_each_group(spark):
    docs = edge_docs(spark, _near_rows())
    want = _components([(r.doc_id, r.text) for r in docs.collect()], 5)
    out = keep_first(docs, words=5)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in want.items() if i == c)
    assert ids.count(None) == 1


def test_near_duplicates_at_the_limit_whatever_their_signatures(spark):
    """Pairs at 8 of 10 shingles whose signatures, by chance, agree in fewer values."""
    rows = []
    for p in (1158, 1474, 2667, 23609):
        w = [f"p{p}w{i}" for i in range(13)]
        rows += [(2 * p, " ".join(w[:12])), (2 * p + 1, " ".join(w[1:]))]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: i - i % 2 for i, _ in rows}


def test_near_duplicates_in_a_crowd_of_one_template(spark):
    """All texts share 154 of 180 shingles (similarity 0.748), each pair 162 (0.818)."""
    rows, head = [], " ".join(f"t{i}" for i in range(157))
    for p in range(1500):
        both = " ".join(f"p{p}w{i}" for i in range(8))
        rows += [(i, " ".join([head, both, *(f"d{i}w{j}" for j in range(18))])) for i in (2 * p, 2 * p + 1)]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: i - i % 2 for i, _ in rows}


def test_near_duplicates_hand_python_batches_of_bounded_bytes(spark, monkeypatch):
    """Ten thousand texts of a real table are tens of MB, held several times for each core."""
    import pyarrow as pa

    from tidewire.llm import components as stars
    from tidewire.llm import core, near_dedup
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, sizes = spark.conf.get(name), []

    def sized(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])
    rows = [(i, prose(300, i // 2)) for i in range(200)]
    docs = spark.createDataFrame(rows * 20, "doc_id long, text string").coalesce(1)

    def written(df, *args):
        sizes.append(docs.mapInArrow(sized, "n long, size long").collect())
        return core.written(df, *args)
    monkeypatch.setattr(near_dedup, "written", written)
    monkeypatch.setattr(stars, "written", written)
    got = near_duplicates(docs).select("doc_id", "component_id").distinct().collect()
    assert {tuple(r) for r in got} == {(i, i - i % 2) for i, _ in rows}
    assert len(sizes) > 6
    assert all(sum(r.n for r in x) == 4000 and max(r.size for r in x) < 2 * near_dedup.BATCH for x in sizes)
    assert spark.conf.get(name) == before


def test_shingle_sets_of_texts_that_pack_well(spark):
    from tidewire.llm.near_dedup import packed_texts, shingle_sets
    rows = [(1, "a b c d e " * 60000), (2, "a b c d e"), (3, ""), (4, "x " * 300000), (5, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: set(r.s) for r in shingle_sets(packed_texts(docs)).collect()}
    assert {i: len(s) for i, s in got.items()} == {i: len(_set(t)) for i, t in rows}
    assert got[2] < got[1]


def test_a_block_of_fewer_words_than_a_shingle():
    from tidewire.llm.near_dedup import block_shingles
    for k in (4, 5):
        for n in range(1, 7):
            text = np.frombuffer(b"w " * n, np.uint8)
            x, row = block_shingles(text, np.array([0, len(text)]), k)
            assert len(x) == 1 and row.tolist() == [0]


def test_components_of_paths_and_stars(spark):
    e = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 140)] + [(7, 7)]
    random.Random(1).shuffle(e)
    got = {r.node: r.root for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{j: 100 for j in range(100, 140)}}


def test_components_run_no_round_for_links_that_are_settled(spark, monkeypatch):
    """Each round is some ten stages whose plans and threads the driver holds."""
    import sys
    module, core = sys.modules["tidewire.llm.components"], sys.modules["tidewire.llm.core"]
    rounds, let_go = [], []
    monkeypatch.setattr(module, "written", lambda *a, f=module.written, **k: rounds.append(a[1]) or f(*a, **k))
    monkeypatch.setattr(core, "release", lambda s, f=core.release: let_go.append(s) or f(s))
    stars = [(2, 1), (1, 3), (3, 1), (5, 6), (None, 4), (8, 8)]
    out = components(spark.createDataFrame(stars, "a long, b long")).collect()
    assert sorted(map(tuple, out)) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)]
    assert len(rounds) == len(let_go) == 1
    out = components(spark.createDataFrame([(1, 3), (2, 3), (3, 4)], "a long, b long")).collect()
    assert sorted(map(tuple, out)) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    assert len(rounds) == len(let_go) > 2
    with pytest.raises(RuntimeError, match="did not settle in 1 rounds"):
        components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"), 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=14).map(lambda b: bytes(x % 3 for x in b)), max_size=8),
       st.integers(1, 4), st.sampled_from([2, 3, 5, 1000]))
def test_bwt_against_sorted_suffixes(strings, least, chunk):
    string, length, lcp = collection_bwt(strings, least, chunk)
    got = [strings[i][len(strings[i]) - n:] for i, n in zip(string, length)]
    assert got == sorted(got)
    assert sorted(zip(string.tolist(), length.tolist())) == sorted(
        (i, n) for i, s in enumerate(strings) for n in range(least, len(s) + 1))
    for k in range(1, len(got)):
        common = next((i for i, (x, y) in enumerate(zip(got[k - 1], got[k])) if x != y), min(len(got[k - 1]), len(got[k])))
        assert lcp[k] == common if common >= least else lcp[k] < least


def _cut(rows, n=100):
    """Brute force: rows by id, every window of n bytes looked up among the earlier ones."""
    seen, out = {}, {}
    docs = sorted({(-1 if i is None else i, (t or "").encode()) for i, t in rows})
    for i, x in docs:
        for s in range(len(x) - n + 1):
            seen.setdefault(x[s:s + n], (i, s))
    for i, x in docs:
        gone = np.zeros(len(x), bool)
        for s in range(len(x) - n + 1):
            if seen[x[s:s + n]] < (i, s):
                gone[s:s + n] = True
        rest = bytes(b for b, g in zip(x, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[i] = (len(x), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest())
    return out


def _passages():
    p, q = prose(60, 11), prose(25, 12)
    return [(30, prose(50, 13) + p + prose(40, 14)), (31, p + prose(10, 15)), (32, prose(7, 16) + p[20:300]),
            (33, "ab" * 400), (34, "abc" * 100 + "ab" * 70), (35, q + "\n" + q + "\n" + q), (36, "x" * 99),
            (37, "x" * 100), (38, "x" * 350), (39, p + q + p), *[(40 + i, f"{i} " + p) for i in range(30)]]


def test_suffix_dedup_against_brute_force(spark):
    docs = edge_docs(spark, _passages()).union(spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id + 1000", "text", "lang", "source", "n_chars", "0.0D", "true", "''"))
    want = _cut([(r.doc_id, r.text) for r in docs.collect()])
    out = suffix_dedup(docs.repartition(5)).collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[-1 if r.doc_id is None else r.doc_id], r.doc_id


def test_frequent_hashes_are_filed_by_window(spark):
    """A passage in most documents: its hashes go by single windows, with the same result."""
    from tidewire.llm.suffix_dedup import frequent_hashes
    p = prose(40, 21)
    rows = [(i, f"{prose(6, 100 + i)} {p} {prose(6, 900 + i)}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len(frequent_hashes(docs, 64)) > 0
    assert run_places(docs, 64).where("later").count() > 0
    want = _cut(rows)
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in suffix_dedup(docs).collect())


def test_cut_repeats_keeps_columns_and_whole_characters(spark):
    docs = edge_docs(spark, [(50, "ü" * 60 + prose(30, 31)), (51, "a" + "ü" * 60 + prose(30, 31)), (52, "x" + "ü" * 55)])
    out = cut_repeats(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text is None and rows[7].text == "" and rows[7].n_chars == 0 and rows[6].text == prose(120, 1)
    assert rows[51].text == "a"


def test_empty_tables(spark):
    assert near_duplicates(empty_docs(spark)).count() == 0
    assert keep_first(empty_docs(spark)).count() == 0
    assert suffix_dedup(empty_docs(spark)).count() == 0
    assert cut_repeats(empty_docs(spark)).count() == 0
