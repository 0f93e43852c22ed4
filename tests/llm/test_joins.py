"""Centroid clustering, the n-gram join and the tokenizer alignment against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.rows import edge_docs, empty_docs, prose, words
from tests.llm.test_dedup import _components, _near_rows, _set
from tidewire.llm.alignment import align, cross_alignment, gallop
from tidewire.llm.bisector_kmeans import bisectors, centroid_clusters, tournament
from tidewire.llm.core import word_hashes, words_of
from tidewire.llm.ngram_join import jaccard_components
from tidewire.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = (str(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# --- clusters -------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10**6))
def test_tournament_leaves_the_nearest_the_smaller_at_a_tie(k, seed):
    rng = np.random.default_rng(seed)
    c, x = rng.integers(-3, 4, (k, 3)), rng.integers(-3, 4, (40, 3))
    want = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)  # the first of the least
    assert tournament(x, *bisectors(c)).tolist() == want.tolist()


def _clusters(rows, k=8, rounds=10, dims=64):
    v = [(i, [math.floor(1024 * float(x)) for x in e]) for i, e in rows
         if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    c = [x for _, x in sorted(v, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                                                np.array(r[1], "<i4").tobytes()))[:k]]

    def near(x):
        gaps = [sum((p - q) ** 2 for p, q in zip(x, m)) for m in c]
        return gaps.index(min(gaps)), min(gaps)
    for _ in range(rounds):
        held = collections.defaultdict(list)
        for _, x in v:
            held[near(x)[0]].append(x)
        for j, xs in held.items():
            c[j] = [sum(z) // len(xs) for z in zip(*xs)]
    out = [(i, *near(x)) for i, x in v]
    total = collections.Counter()
    for _, j, d in out:
        total[j] += d
    return sorted(((i, j, d, total[j], sum(total.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
                   for i, j, d in out), key=str)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster string, distance string")


def test_clusters_with_nulls_ties_repeats_and_clashing_names(spark):
    rng = random.Random(3)
    good = [[rng.choice([-0.5, 0.0, 0.25]) for _ in range(64)] for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(good)] + [(5, good[5]), (5, good[6]), (None, good[7]), (90, None), (91, []),
            (92, good[0][:63]), (93, good[0] + [0.0]), (94, [None] + good[0][1:]), (95, [math.nan] + good[0][1:]),
            (96, [math.inf] + good[0][1:])]
    df = _vectors(spark, [(*r, "x", "y") for r in rows])
    got = sorted((tuple(r) for r in centroid_clusters(df).collect()), key=str)
    assert got == _clusters([(r.vec_id, r.embedding) for r in df.collect()])


def test_clusters_of_few_equal_and_no_vectors(spark):
    one = [(i, [0.125] * 64, "", "") for i in range(3)]
    got = centroid_clusters(_vectors(spark, one)).collect()
    assert sorted((r.vec_id, r.cluster, r.distance, r.inertia) for r in got) == [(i, 0, 0, 0) for i in range(3)]
    none = centroid_clusters(_vectors(spark, []))
    assert none.count() == 0 and dict(none.dtypes)["cluster"] == "int"


def test_vectors_too_large_for_exact_distances_fail_clearly(spark):
    with pytest.raises(Exception, match="too large for exact distances"):
        centroid_clusters(_vectors(spark, [(1, [3e6] * 64, "", "")])).collect()


def test_registered_clusters_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = sorted((tuple(r) for r in QUERIES["op11_bisector_clusters"](spark, SF).collect()), key=str)
    assert got == _clusters([(r.vec_id, r.embedding) for r in rows])


# --- n-gram join ------------------------------------------------------------

def test_ngram_join_against_brute_force(spark):
    docs = edge_docs(spark, _near_rows()).union(spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id + 1000", "text", "lang", "source", "n_chars", "0.0D", "true", "''"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = jaccard_components(docs).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == _components(rows, 5)
    assert [r.component_id for r in out if r.doc_id is None] == [None]
    assert sorted(((r.doc_id, r.n_shingles) for r in out), key=str) == sorted(((i, len(_set(t, 5))) for i, t in rows), key=str)


def test_ngram_join_in_a_crowd_of_one_template(spark, monkeypatch):
    """All texts share 153 of 180 n-grams (similarity 0.739), each pair more than enough; lists
    are met a few documents at a time."""
    monkeypatch.setattr("tidewire.llm.ngram_join.TOGETHER", 70)
    rows, head = [], " ".join(f"t{i}" for i in range(157))
    for p in range(150):
        both = " ".join(f"p{p}w{i}" for i in range(9))
        rows += [(i, " ".join([head, both, *(f"d{i}w{j}" for j in range(18))])) for i in (2 * p, 2 * p + 1)]
    out = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: i - i % 2 for i, _ in rows}


def test_ngram_join_chains_and_the_limit(spark):
    """A chain whose ends are not similar, and pairs at exactly 80 %: 8 of 10 n-grams."""
    rows, w = [], words(140, 5)
    for i in range(12):
        rows.append((i, " ".join(w[3 * i:3 * i + 90])))
    for p in range(40):
        v = [f"p{p}w{i}" for i in range(14)]
        rows += [(100 + 2 * p, " ".join(v[:13])), (101 + 2 * p, " ".join(v[1:]))]
    out = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == _components(rows, 5)


def test_ngram_join_of_nothing(spark):
    assert jaccard_components(empty_docs(spark)).collect() == []


def test_words_of_the_same_letter_pattern_differ():
    """Word hashes do not cancel out over long words (a polynomial mod 2^64 does)."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    text = f"{a} {a.translate(str.maketrans('ab', 'ba'))} {a} abcdefgh abcdefghi bcdefgh {'x' * 64} {'x' * 65}".encode()
    raw = np.frombuffer(text, np.uint8)
    start, end, _ = words_of(raw, np.array([0, len(raw)]))
    by_word = collections.defaultdict(set)
    for w, h in zip(text.split(), word_hashes(raw, start, end).tolist()):
        by_word[w].add(h)
    assert all(len(h) == 1 for h in by_word.values())
    assert len(set.union(*by_word.values())) == len(by_word)


# --- alignment ----------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(1, 400), max_size=60), st.sets(st.integers(1, 400), min_size=1, max_size=200), st.integers(-5, 300))
def test_gallop_finds_ranks_from_any_guess(short, long, guess):
    s, g = np.array(sorted(short), np.int64), np.array(sorted(long), np.int64)
    rank, same = gallop(s, g, np.full(len(s), guess))
    assert rank.tolist() == [sum(x < v for x in long) for v in sorted(short)]
    assert same.tolist() == [v in long for v in sorted(short)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 29)), st.sets(st.integers(1, 29)), st.booleans()), min_size=1, max_size=5))
def test_align_against_all_pairs(texts):
    a, b, a_first, b_first = [], [], [0], [0]
    for i, (x, y, empty) in enumerate(texts):
        if not empty:
            a += sorted(30 * i + v for v in {*x, 30})
            b += sorted(30 * i + v for v in {*y, 30})
        a_first.append(len(a))
        b_first.append(len(b))
    i, j, a_cut, b_cut = align(*(np.array(v, np.int64) for v in (a, a_first, b, b_first)))
    a_from, b_from = ([0 if k in first else ends[k - 1] for k in range(len(ends))]
                      for ends, first in ((a, set()), (b, set())))
    for k in range(len(texts)):  # a text begins where it stands, not where the last token ended
        for ends, first, start in ((a, a_first, a_from), (b, b_first, b_from)):
            if first[k] < first[k + 1]:
                start[first[k]] = 30 * k
    want = {(p, q) for p in range(len(a)) for q in range(len(b)) if a_from[p] < b[q] and b_from[q] < a[p]}
    assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want
    assert [v for v, c in zip(a, a_cut) if c] == [v for v, c in zip(b, b_cut) if c] == sorted(set(a) & set(b))


def _aligned(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(c): c for c in kept} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in kept)}
    docs, count = [], collections.Counter()
    for d, text in rows:
        ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        pieces = b.encode(text) if text else []
        x = [bytes(of[c] for c in a.id_to_token(i)) for i in ids]
        y = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
             for i in pieces]
        if not text or b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            docs.append((d, None))
            continue
        x_end, y_end = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
        groups, i, j = [], 0, 0
        x_place, y_place = ({c: k + 1 for k, c in enumerate(ends)} for ends in (x_end, y_end))
        for c in sorted(set(x_end) & set(y_end)):
            p, q = x_place[c], y_place[c]
            groups.append(",".join(map(str, ids[i:p])) + "|" + ",".join(map(str, pieces[j:q])))
            i, j = p, q
        links, j = [], 0
        for i in range(len(ids)):
            begin = x_end[i - 1] if i else 0
            while y_end[j] <= begin:
                j += 1
            k = j
            while k < len(pieces) and (y_end[k - 1] if k else 0) < x_end[i]:
                links.append((ids[i], pieces[k]))
                k += 1
        count.update(links)
        docs.append((d, (len(ids), len(pieces), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    top = collections.Counter()
    for (_, q), n in count.items():
        top[q] = max(top[q], n)
    return sorted(((d, 0, 0, 0, 0, 0, 0, "") if v is None else
                   (d, *v[:3], len(v[3]), sum(count[p] == top[p[1]] for p in v[3]), sum(count[p] for p in v[3]), v[4])
                   for d, v in docs), key=str)


ODD_TEXTS = [(1, None), (2, ""), (3, " \n\t  x"), (4, "a▁b"), (5, "<|endoftext|> <s> </s> <unk> <0x0A>"),
             (6, "日本語 🙂🙂 é\x00x"), (7, "x" * 5000), (8, " " * 3000), (None, "Hello world"), (7, "x" * 5000),
             (9, "\r\n tab\tend "), (10, "ﬁ ｆｕｌｌ nbsp  b​ c"), (11, "two  spaces"), (12, "end "), (13, " begin"),
             (14, "word\n next  em"), (15, "plain words only, twice plain words"), (16, "a▁ b c")]


@pytest.mark.parametrize("hot", [1 << 19, 300, 0])
def test_alignment_against_both_tokenizers(spark, hot):
    docs = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string").union(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    want = _aligned([tuple(r) for r in docs.collect()])
    assert sorted((tuple(r) for r in cross_alignment(docs, A, B, hot).collect()), key=str) == want


def test_alignment_merges_its_counts_when_they_grow(spark, monkeypatch):
    monkeypatch.setattr("tidewire.llm.alignment.HELD", 500)
    monkeypatch.setattr("tidewire.llm.alignment.BLOCK", 4000)
    monkeypatch.setattr("tidewire.llm.alignment.WORDS", 50)
    rows = [(i, prose(300, i)) for i in range(30)]
    got = cross_alignment(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), A, B)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _aligned(rows)


def test_alignment_of_clashing_columns_and_nothing(spark):
    docs = edge_docs(spark).selectExpr("*", "'x' as n_a", "1 as row", "2 as pair", "'y' as pairs")
    want = _aligned([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in cross_alignment(docs, A, B).collect()), key=str) == want
    assert cross_alignment(empty_docs(spark), A, B).collect() == []


def test_alignment_of_a_very_long_text(spark):
    """2.5 MB in one text, one word of 10,000 letters and a run of 20,000 spaces in it."""
    text = prose(300_000, 8) + " " + "q" * 10_000 + " " * 20_000 + "end"
    got = cross_alignment(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).collect()
    assert [tuple(r) for r in got] == _aligned([(1, text)])
