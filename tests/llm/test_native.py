"""License scan, quality rules and URL filter against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import edge_docs, empty_docs, prose
from tidewire.llm import quality_rules
from tidewire.llm.license_scan import PHRASES, license_scan
from tidewire.llm.quality_rules import weak_quality
from tidewire.llm.url_graph import RULES, fitting_rule, spread, url_filter, url_parts

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _license_base(text):
    w, places, found = WORD.findall(_lower(text)), [], set()
    for label, phrase in PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        found |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(found))


def test_license_base_columns(spark):
    extra = [(20, "The MIT License. the mit license the mit license"), (21, "Apache License, Version 2.0 cc by-nc"),
             (22, "Licensed under CC BY-NC 4.0. " + prose(30, 3) + " Released under the MIT License.")]
    docs = edge_docs(spark, extra).union(
        spark.read.parquet(f"{SF}/documents.parquet").select(
            F.col("doc_id") + 100, "text", "lang", "source", "n_chars", F.lit(0.0), F.lit(True), F.lit("")))
    got = sorted([tuple(r) for r in license_scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()], key=str)
    want = sorted([(r.doc_id, *_license_base(r.text)) for r in docs.collect()], key=str)
    assert got == want
    for r in license_scan(docs).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_phrases_are_the_contracts(spark):
    """``the mit license`` alone is a label of the method, not a place of the base."""
    docs = spark.createDataFrame([
        (1, "The MIT License"), (2, "sold under the MIT license; under the mit license"), (3, "cc by-nc the mit license"),
        (4, "Apache License, Version 2")], "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in license_scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels").collect()}
    assert got == {1: (3, 0, None, None, "", "mit"), 2: (9, 2, 1, 5, "mit", "mit"), 3: (6, 1, 0, 0, "cc-by-nc", "cc-by-nc,mit"),
                   4: (4, 1, 0, 0, "apache-2", "apache-2")}


def test_license_votes_find_a_changed_copy(spark):
    """One word dropped and one put in: the votes lie on three diagonals."""
    t = ("permission is hereby granted free of charge to any person obtaining a copy of this fine software and "
         "associated files the software to deal in the software without restriction")
    docs = spark.createDataFrame([(1, prose(40, 7) + " " + t + " " + prose(40, 8)), (2, prose(90, 9))],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.n_base) for r in license_scan(docs).collect()}
    assert got == {1: ("mit", 0), 2: ("", 0)}


def _counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_quality_rules_base_columns(spark):
    extra = [(20, "a b c a b c a b c"), (21, "x y\nx y\n\n \nx y"), (22, "# * a|b <c> & $%"), (23, "a a a a a")]
    docs = edge_docs(spark, extra).union(spark.read.parquet(f"{SF}/documents.parquet").select(
        F.col("doc_id") + 100, "text", "lang", "source", "n_chars", F.lit(0.0), F.lit(True), F.lit("")))
    got = sorted([tuple(r) for r in weak_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()], key=str)
    want = []
    for r in docs.collect():
        c = _counts(r.text)
        want.append((r.doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want, key=str)


def test_quality_rules_posterior_by_plain_em(spark):
    """The posterior of every document against EM in plain numpy, run until it settles."""
    names = list(quality_rules.RULES)
    rows = weak_quality(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    v = np.array([[r[f"vote_{k}"] for k in names] for r in rows])
    table = {y: np.tile(np.array(b), (len(names), 1)) for y, b in quality_rules.BELIEF.items()}  # votes 0, -1, 1
    at, prior, weight = np.where(v == 0, 0, np.where(v < 0, 1, 2)), 0.8, max(1.0, quality_rules.BELIEF_WEIGHT * len(v))
    rule = np.arange(len(names))

    def posterior():
        good, bad = (np.log(table[y][rule, at]).sum(axis=1) for y in ("good", "bad"))
        return 1 / (1 + np.exp(bad - good - np.log(prior / (1 - prior))))
    for _ in range(2000):
        p = posterior()
        for y, share in (("good", p), ("bad", 1 - p)):
            seen = np.array([[share[at[:, i] == c].sum() for c in range(3)] for i in rule])
            table[y] = (seen + weight * np.array(quality_rules.BELIEF[y])) / (share.sum() + weight)
        prior = (p.sum() + 0.8 * weight) / (len(p) + weight)
    assert np.abs(posterior() - np.array([r.posterior for r in rows])).max() < 0.01


def test_quality_rules_long_texts(spark):
    """Over two megabytes of text, of blanks, and one word of 10,000 letters."""
    many = prose(150_000, 4)
    texts = [many, many[:200_000] + " " + many[:200_000], " " * 2_500_000, "x" * 10_000, "x" * 10_000 + " a b " + "x" * 10_000 + " a b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in weak_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert got == {i: _counts(t) for i, t in enumerate(texts)}


def test_quality_rules_keep_clean_and_drop_junk(spark):
    sf = "/root/testdata/sf0.01"
    out = weak_quality(spark.read.parquet(f"{sf}/documents.parquet"))
    j = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    r = {(x.quality, x.kept): x["count"] for x in j.groupBy("quality", "kept").count().collect()}
    assert r.get((1, False), 0) <= 0.02 * r[1, True]
    assert r.get((0, True), 0) <= 0.1 * r[0, False]


def test_native_operators_run_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (license_scan(docs), weak_quality(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables(spark):
    assert license_scan(empty_docs(spark)).count() == 0
    assert weak_quality(empty_docs(spark)).count() == 0
    assert url_filter(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


URLS = ["http://Example.NET/en/x?y", "http://a.example.net/de/1", "https://x.org/fr/", "https://x.org/fr", "http://b.net?x",
        "http://b.net", "ftp://h#f", None, "no url", "://", "http://a.example.com/de/#t", "http://notexample.com/de/",
        "x://y://z/q"]


def _url(u):
    if u is None or "://" not in u:
        return "", "", None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = _lower(host)
    fit = [(len(h + p), h + p) for _, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1] if fit else None


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rule, _ = fitting_rule()
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_parts(pages).withColumn("rule", rule).collect()}
    assert got == {i: _url(u) for i, u in enumerate(URLS)}


def test_url_verdicts(spark):
    """A host that links to blocked ones is blocked, one that trusted hosts link to is not."""
    rows = [(1, "http://bad.net/x", ""), (2, "http://farm.com/a", '<a href="http://bad.net/x">'),
            (3, "http://good.org/fr/1", '<a href="https://Friend.com/q"> <a href=/rel>'),
            (4, "http://friend.com/z", None), (5, "http://alone.com/", "<a href='//alone.com/x'>"), (6, None, None)]
    pages = spark.createDataFrame([(*r, "v", 1.0) for r in rows],
                                  "page_id long, url string, html string, verdict string, trust double")
    got = {r.page_id: r for r in url_filter(pages).collect()}
    assert {k: v.verdict for k, v in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}
    assert got[4].trust > 0 and got[2].distrust > 0 and got[6].host == "" and got[6].rule is None


def test_page_rank_against_power_iteration(spark):
    links = {("a", "b"): 1.0, ("a", "c"): 0.5, ("b", "c"): 1.0, ("c", "a"): 0.25, ("c", "d"): 0.75}
    edges = spark.createDataFrame([(s, d, 0, w) for (s, d), w in links.items()], "src string, dst string, kind int, w double")
    seeds = spark.createDataFrame([("a", 0, 0.6), ("c", 0, 0.4)], "host string, kind int, mass double")
    got = {r.host: r["rank"] for r in spread(edges, seeds, rounds=5).collect()}
    seed = {"a": 0.6, "c": 0.4}
    rank = {k: 0.15 * v for k, v in seed.items()}
    for _ in range(5):
        nxt = {k: 0.15 * v for k, v in seed.items()}
        for (s, d), w in links.items():
            nxt[d] = nxt.get(d, 0) + 0.85 * rank.get(s, 0) * w
        rank = nxt
    assert got.keys() == rank.keys() and all(got[k] == pytest.approx(rank[k]) for k in rank)


def test_distrust_reaches_the_far_end_of_a_chain(spark):
    """Thirty hosts, each linking to the next, the last one to a bad host: all are suspect, and a host
    that only they link to is not."""
    rows = [(i, f"http://h{i}.org/", f'<a href="http://h{i + 1}.org/"> <a href="http://seen.com/">') for i in range(30)]
    rows += [(30, "http://h30.org/", '<a href="http://bad.net/">'), (31, "http://bad.net/x", ""), (32, "http://seen.com/", None)]
    got = {r.page_id: r for r in url_filter(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == set(range(32))
    assert all(0 < got[i].distrust < got[i + 1].distrust for i in range(28))


def test_page_rank_ends_where_power_iteration_ends(spark):
    links = {("a", "b"): 1.0, ("b", "a"): 0.5, ("b", "c"): 0.5, ("c", "a"): 1.0}
    edges = spark.createDataFrame([(s, d, 0, w) for (s, d), w in links.items()], "src string, dst string, kind int, w double")
    seeds = spark.createDataFrame([("a", 0, 1.0)], "host string, kind int, mass double")
    rank = {"a": 0.15}
    for _ in range(300):
        nxt = {"a": 0.15}
        for (s, d), w in links.items():
            nxt[d] = nxt.get(d, 0) + 0.85 * rank.get(s, 0) * w
        rank = nxt
    got = {r.host: r["rank"] for r in spread(edges, seeds).collect()}
    assert got.keys() == rank.keys() and all(got[k] == pytest.approx(rank[k], abs=2e-6) for k in rank)
    assert spread(edges, seeds.where("false")).collect() == []
