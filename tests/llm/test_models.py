"""Classifiers, language model, packing and decontamination."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.rows import edge_docs, empty_docs, labels, prose
from tidewire.llm import quality_fm, toxicity
from tidewire.llm.decontam import Items, contaminated, drop_contaminated, edit_budget, fold
from tidewire.llm.lm_score import Model, lm_score, train_block
from tidewire.llm.packing import WINDOW, best_fit, fill_combinations, pack, pack_plan, repeat_counts

SF, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def _crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


# --- factorisation machine

def test_fm_pair_sum_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = {"w0": 0.3, "w": rng.normal(size=20).astype(np.float32), "v": rng.normal(size=(20, 4)).astype(np.float32)}
    f, x = np.array([2, 5, 11, 19]), rng.random(4).astype(np.float32)
    z = m["w0"] + m["w"][f] @ x + sum(m["v"][f[i]] @ m["v"][f[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    got = quality_fm.scores(m, np.zeros(4, np.int64), f, x, 1)[0]
    assert got == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-5)


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = quality_fm.quality(docs, lab)
    rows = out.join(lab, "doc_id").where("held_out").collect()
    assert sum((r.predicted == 1) == (r.quality == 1) for r in rows) / len(rows) > 0.97
    assert sum(r.predicted == 0 for r in rows if r.quality == 1) <= 0.01 * len(rows)
    assert all(r.held_out == (_crc(r.doc_id) % 5 == 0) for r in rows)


def test_quality_edge_cases(spark):
    docs = edge_docs(spark)
    lab = labels(spark, [(6, 1, 0), (8, 0, 0), (99, 1, 0), (4, None, None)])
    out = quality_fm.quality(docs, lab).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.score == 0.5 for r in quality_fm.quality(docs, labels(spark)).collect())
    assert quality_fm.quality(empty_docs(spark), lab).count() == 0
    kept = quality_fm.keep_quality(docs, quality_fm.train(docs, lab))
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out)


def test_training_sample_is_read_in_place(spark):
    """Texts' features are views of the columns the driver got, in the order of ids and
    features; copies of each text's would leave its memory in pieces."""
    from tidewire.llm.features import _views, labelled_sample
    cut = [pa.array([b"abcd", b"", b"efghijkl", b"mnop"])[1:], pa.array([b""])]
    assert [v.tobytes() for v in _views(pa.chunked_array(cut))] == [b"", b"efghijkl", b"mnop", b""]
    rows = [(i, prose(40, i)) for i in (3, 1, 2)] + [(2, prose(40, 9)), (None, "no id"), (4, "no label")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    some = labelled_sample(docs, labels(spark, [(i, i % 2, 0) for i in (1, 2, 3)]), "quality", F.lit(True), 10, 16)
    assert [(s[0], s[4]) for s in some] == [(1, 1), (2, 0), (2, 0), (3, 1)]
    assert some[1][1].tobytes() <= some[2][1].tobytes() and all(len(s[1]) == len(s[2]) for s in some)
    for column in (1, 2):
        place = sorted((s[column].ctypes.data, s[column].nbytes) for s in some)
        assert all(a + n == b for (a, n), (b, _) in zip(place, place[1:]))


# --- toxicity

def test_ordinal_thresholds_are_ordered():
    t = toxicity.cut_points(np.array([0.5, -3.0, 2.0]))
    assert (np.diff(t) > 0).all()
    p = toxicity.above({"t": np.array([0.5, -3.0, 2.0])}, np.array([-1.0, 0.0, 4.0]))
    assert (np.diff(p, axis=1) < 0).all() and (np.diff(p, axis=0) > 0).all()


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("toxic", "is_toxic")
    out = toxicity.toxicity(docs, lab.withColumnRenamed("is_toxic", "toxic"))
    rows = out.join(lab, "doc_id").where("held_out").collect()
    assert sum(r.toxic for r in rows if r.is_toxic) / sum(r.is_toxic for r in rows) > 0.8
    assert sum(r.toxic for r in rows if not r.is_toxic) / len(rows) < 0.02
    assert all(r.severity == pytest.approx(r.p_1 + r.p_2 + r.p_3) for r in rows)


def test_toxicity_edge_cases(spark):
    docs = edge_docs(spark)
    out = toxicity.toxicity(docs, labels(spark)).collect()
    assert len(out) == docs.count() and all(r.severity < 1e-9 and not r.toxic and r.grade == 0 for r in out)
    assert toxicity.toxicity(empty_docs(spark), labels(spark)).count() == 0


# --- language model

def test_lm_base_and_counts(spark):
    docs = edge_docs(spark).union(spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id + 1000", "text", "lang", "source", "n_chars", "0.0D", "true", "''"))
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + ["END"]) for r in docs.collect()]
    c = Counter(w for i, t in rows if _crc(i) % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(t), sum(c[w] > 0 for w in t), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 4))
                  for i, t in rows)
    out = lm_score(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in out) == want
    assert {r.train_tokens for r in out} == {n}
    assert all(r.held_out == (_crc(r.doc_id) % 7 == 2) and r.score < 0 for r in out)


def test_lm_is_normalised_and_beats_counts(spark):
    rng = np.random.default_rng(2)
    k = 9
    m = Model.start(np.full(k, 1 / k))
    m.flat[:] = rng.normal(size=len(m.flat))
    one, two = np.repeat(np.arange(k), k), np.tile(np.arange(k), k)
    p = sum(np.exp(m.log_probs(one, two, np.full(k * k, w), chunk=5)) for w in range(k))
    assert np.allclose(p, 1, atol=1e-5)
    out = lm_score(spark.read.parquet(f"{SF_CHECK}/documents.parquet")).where("held_out")
    r = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_lm_training_comes_near_the_true_conditionals():
    """Words drawn from known conditionals: noise-contrastive training reaches their
    entropy, whatever the triples' counts, and stays far from the unigram share."""
    rng = np.random.default_rng(5)
    k, n = 12, 60_000
    true = rng.dirichlet(np.full(k, 0.3), k)
    cdf, word, u = true.cumsum(axis=1), np.zeros(n, np.int64), rng.random(n)
    for i in range(1, n):
        word[i] = min(k - 1, np.searchsorted(cdf[word[i - 1]], u[i]))
    one, two = np.r_[0, word[:-1]], np.r_[0, 0, word[:-2]]
    share = (np.bincount(word, minlength=k) + 1) / (n + k)
    m = Model.start(share)
    squares = np.zeros(len(m.flat), np.float32)
    for _ in range(300):
        train_block(m, squares, share, one, two, word, rng)
    own, unigram = m.log_probs(one, two, word).mean(), np.log(share[word]).mean()
    best = np.log(true[one, word]).mean()
    assert best - own < 0.15 * (best - unigram)


def test_lm_probabilities_by_brute_force():
    rng = np.random.default_rng(6)
    k = 23
    m = Model.start(np.full(k, 1 / k))
    m.flat[:] = rng.normal(0, 0.7, len(m.flat))
    one, two, word = rng.integers(0, k, (3, 400))
    want = []
    for a, b, w in zip(one, two, word):
        p = m.r[a] @ m.c[0] + m.r[b] @ m.c[1]
        kinds = m.qc @ p + m.bc
        lo = w // m.width * m.width
        words = (m.q @ p + m.b)[lo:lo + m.width]
        want.append(kinds[w // m.width] - np.log(np.exp(kinds).sum()) + words[w - lo] - np.log(np.exp(words).sum()))
    assert np.allclose(m.log_probs(one, two, word, chunk=37), want, atol=1e-4)


def test_lm_empty_table(spark):
    assert lm_score(empty_docs(spark)).count() == 0


# --- packing

def _tokenizer():
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def test_pack_every_id_once(spark):
    from tokenizers import Tokenizer
    odd = [(70, "It's A.B, x́ <|endoftext|> ½ 1,2 ẞß İ \x1c\x85\xa0z"), (71, "don't\tWON'T\r\n#tag ere*** 2nd été,"),
           (72, prose(9000, 3))]
    docs = edge_docs(spark, odd)
    tok = Tokenizer.from_file(_tokenizer())
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append([*tok.encode(r.text or "", add_special_tokens=False).ids, 1])
    out = pack(docs.repartition(3), _tokenizer()).collect()
    seqs, by_doc = defaultdict(list), defaultdict(Counter)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= WINDOW
    for doc, texts in want.items():
        expected = Counter()
        for ids in texts:
            for s in range(0, len(ids), WINDOW):
                part = np.array(ids[s:s + WINDOW], "<u4").tobytes()
                expected[s, len(part) // 4, zlib.crc32(part), len(ids)] += 1
        assert by_doc[doc] == expected, doc
    assert pack(empty_docs(spark), _tokenizer()).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=120))
def test_pack_plan_places_every_rank_once(lengths):
    hist = np.bincount(lengths, minlength=25).tolist() if lengths else [0] * 25
    p = pack_plan(hist, 24)
    fill = Counter()
    for v in range(1, 25):
        own = np.flatnonzero(p["length"] == v)
        starts = p["rank"][own]
        if hist[v]:
            assert starts[0] == 0 and (np.diff(starts) > 0).all()
        for rank in range(hist[v]):
            k = own[np.searchsorted(starts, rank, side="right") - 1]
            s, o = p["sequence"][k] + rank - p["rank"][k], p["offset"][k]
            for x in range(o, o + v):
                fill[s, x] += 1
    assert all(n == 1 for n in fill.values()) and sum(fill.values()) == sum(lengths)
    assert all(x < 24 for _, x in fill)
    used = Counter(s for s, _ in fill)
    assert all(sorted(x for t, x in fill if t == s) == list(range(n)) for s, n in used.items())


def test_least_squares_fits_a_histogram_made_of_combinations():
    combos = fill_combinations(list(range(1, 17)), 16)
    assert all(sum(c) == 16 and len(c) <= 3 for c in combos) and len(set(combos)) == len(combos)
    hist = [0] * 17
    for c, n in (((10, 6), 50), ((9, 4, 3), 20), ((16,), 7)):
        for v in c:
            hist[v] += n
    x = repeat_counts(combos, hist, passes=300)
    made = [0.0] * 17
    for c, n in zip(combos, x):
        assert n >= 0
        for v in c:
            made[v] += n
    assert max(abs(a - b) for a, b in zip(made, hist)) < 1
    assert sum(n for _, n in best_fit(hist, 16)) >= 77


def test_least_squares_reach_the_gradient_bound_at_production_settings():
    rng = np.random.default_rng(4)
    hist = [0, *rng.geometric(0.01, 128).tolist()]
    hist[7], hist[64] = 0, 3000
    combos = fill_combinations([v for v in range(1, 129) if hist[v]], 128)
    x = np.array(repeat_counts(combos, hist))
    a = np.zeros((129, len(combos)))
    for i, c in enumerate(combos):
        for v in c:
            a[v, i] += 1
    slope = a.T @ (np.array(hist) - a @ x)
    bound = max(0.5, 1e-4 * max(hist))
    assert (x >= 0).all() and slope.max() <= bound + 1e-6 and np.abs(slope[x > 0]).max() <= bound + 1e-6
    # no worse than a thousand passes over all combinations
    plain, rest = np.zeros(len(combos)), np.array(hist, float)
    for _ in range(1000):
        for i, c in enumerate(combos):
            step = max(rest[list(c)].sum() / (a[:, i] ** 2).sum(), -plain[i])
            plain[i] += step
            for v in c:
                rest[v] -= step
    error = ((np.array(hist) - a @ x) ** 2).sum()
    assert error <= (rest ** 2).sum() + bound * (np.abs(x).sum() + np.abs(plain).sum())


def test_packed_ids_of_long_blank_and_odd_texts():
    from tidewire.llm.packing import WordTokens
    tok = WordTokens(_tokenizer())
    rng = np.random.default_rng(3)
    alphabet = list("abcdeXYZ .,\n\t éÉß÷×ñ!3") + ["\u00a0", "\u0301", "中", "<s>", "[SEP]"]
    texts = ["", " ", "\n \n", "w" * 10_000, " " * 300_000, prose(30, 1) * 4000, "Éa. b,, c.,\n."] + [
        "".join(rng.choice(alphabet, int(rng.integers(0, 60)))) for _ in range(3000)]
    data = [t.encode() for t in texts]
    off = np.r_[0, np.cumsum([len(d) for d in data])]
    ids, bound = tok.encode(np.frombuffer(b"".join(data), np.uint8), off)
    for k, t in enumerate(texts):
        assert ids[bound[k]:bound[k + 1]].tolist() == [*tok.whole.encode(t, add_special_tokens=False).ids, 1], t[:60]


# --- decontamination

def _distance(item, text):
    """Least edits of ``item`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 9), st.integers(0, 40))
def test_band_search_against_edit_distance(seed, edits, before):
    rng = np.random.default_rng(seed)
    item = prose(22, seed)[:110]
    text = list(prose(before, seed + 1) + " " + item + " " + prose(10, seed + 2))
    for _ in range(edits):
        at = before + int(rng.integers(len(item)))
        if at < len(text):
            kind = rng.integers(3)
            text[at:at + 1] = [] if kind == 0 else ["§"] if kind == 1 else [text[at], "q"]
    folded = fold("".join(text).encode())
    got = Items([(5, item)]).search(np.frombuffer(folded, np.uint8), np.array([0, len(folded)]))
    want = _distance(fold(item.encode()), folded)
    if want <= edit_budget(len(item.encode())):
        assert len(got) == 1 and got[0][4] == want
    else:
        assert not got


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_bands_count_distinct_places_also_in_runs_and_portions(seed):
    from tidewire.llm import decontam
    rng = np.random.default_rng(seed)

    def made(n):
        return b"".join(rng.choice([b"a", b"b", b" ", b"ab", b"xyz"]) * int(rng.integers(1, 40)) for _ in range(n))
    items = Items([(i, made(6).decode() + "end") for i in range(3)])
    texts = [made(12), b"", items.texts[-1][:40] + made(3) if items.texts else b"", b"a" * 200]
    low = np.frombuffer(b"".join(texts), np.uint8)
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    want = set()
    for row, t in enumerate(texts):
        for item, u in enumerate(items.texts):
            step, places = int(items.step[item]), defaultdict(set)
            for y in range(len(u) - decontam.Q + 1):
                at = t.find(u[y:y + decontam.Q])
                while at >= 0:
                    for b in ((at - y) // step, (at - y) // step - 1):
                        places[b].add(y)
                    at = t.find(u[y:y + decontam.Q], at + 1)
            want |= {(row, item, b) for b, have in places.items() if len(have) >= items.need[item]}
    whole = items.counted(*items.shared(low, off), off)
    assert set(zip(*(v.tolist() for v in whole))) == want
    before = decontam.CUT, decontam.ENTRIES, decontam.WIDE
    try:
        plain = items.regions(low, off)
        decontam.CUT, decontam.ENTRIES, decontam.WIDE = 7, 20, 1
        got = {(r, i, lo // int(items.step[i])) for r, i, lo, _ in items.regions(low, off)}
    finally:
        decontam.CUT, decontam.ENTRIES, decontam.WIDE = before
    assert got == want
    covered = {(r, i, b) for r, i, lo, hi in plain for b in range(lo // int(items.step[i]), hi // int(items.step[i]))}
    assert covered == want


def test_long_runs_of_one_letter_take_seconds():
    import time
    item = prose(8, 3)[:40] + " " * 200 + prose(8, 4)[:40]
    other = "z" * 250 + "unlike anything else"
    index = Items([(1, item), (2, other)])
    hidden = b" " * 700_000 + fold(item.encode()) + b" " * 700_000
    began = time.process_time()
    for text, want in ((b" " * 2_000_000, []), (b"z" * 2_000_000, []), (hidden, [(0, 1)])):
        got = index.search(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert [g[:2] for g in got] == want and all(g[4] == 0 for g in got)
    assert time.process_time() - began < 120


def test_contaminated_documents(spark):
    item = "The quick movement of twelve painted wagons surprised nobody in the old harbour town that winter morning."
    near = item.replace("painted", "pajnted").replace("old ", "olde ")
    docs = edge_docs(spark, [(60, prose(80, 1) + " " + item + " " + prose(50, 2)), (61, near.upper()),
                             (62, item[:60] + " " + prose(20, 3)), (63, item.replace(" ", "\n")), (64, "zq7 x")])
    bench = spark.createDataFrame([(1, item), (2, None), (3, "  "), (4, item), (5, "ZQ7")],
                                  "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in contaminated(docs, bench).collect())
    assert got == sorted([(d, i) for d in (60, 61, 63) for i in (1, 4)] + [(64, 5)])
    assert sorted((r.doc_id, r.item_id) for r in contaminated(docs, bench, part_bytes=64).collect()) == got
    clean = drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(
        str(r.doc_id) for r in docs.collect() if r.doc_id not in (60, 61, 63, 64))
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(docs, none).count() == 0 and contaminated(empty_docs(spark), bench).count() == 0


def test_all_exact_benchmark_passages_are_found(spark):
    docs, bench = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [(r.doc_id, fold((r.text or "").encode())) for r in docs.collect()]
    want = {(d, r.item_id) for r in bench.collect() for d, t in texts if fold(r.text.encode()) in t}
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert want and want <= got
