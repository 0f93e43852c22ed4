"""Registered queries of this package and their DuckDB SQL.

Each query reads whole tables, applies its operator with production
parameters and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.core import documents, ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(gap: str) -> str:
    """Lower-cased words of every document, ``d(doc_id, w)``."""
    return f"""d as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{gap}'), lambda x: x <> '') as w
  from documents)"""


def _license_sql() -> str:
    from tidewire.llm.license_scan import GAP, K, MAX_STRETCH, MIN_COVER, PHRASES, TEMPLATES
    rows = []
    for tid, (label, text, phrase) in enumerate([(*p, True) for p in PHRASES] + [(*t, False) for t in TEMPLATES]):
        w = text.split()
        rows += [f"({tid}, '{label}', {phrase}, {len(w) - K + 1}, {i}, '{' '.join(w[i:i + K])}')"
                 for i in range(len(w) - K + 1)]
    return rf"""
with {_words_sql(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")},
t(tid, label, phrase, grams, t, gram) as (values {", ".join(rows)}),
g as (
  select doc_id, i - 1 as pos, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram
  from (select doc_id, w, unnest(range(1, len(w) - {K - 2})) as i from d)),
v as (
  select doc_id, tid, label, phrase, grams, pos - t as diagonal, count(*) as votes, min(pos) as a, max(pos) + {K} as z
  from g join t using (gram) group by all),
r as (
  select *, sum(case when phrase or step is null or step > {GAP} then 1 else 0 end)
            over (partition by doc_id, tid order by diagonal rows unbounded preceding) as run
  from (select *, diagonal - lag(diagonal) over (partition by doc_id, tid order by diagonal) as step from v)),
m as (
  select doc_id, label, phrase, grams, sum(votes) as votes, min(a) as a, max(z) as z
  from r group by doc_id, tid, label, phrase, grams, run),
f as (
  select *, least(1.0, votes::double / grams) as cover from m
  where case when phrase then votes = grams
             else votes::double / grams >= {MIN_COVER} and z - a <= {MAX_STRETCH} * (grams + {K - 1}) end)
select d.doc_id, len(d.w)::bigint as n_words, count(f.a) filter (f.phrase) as n_base,
       (min(f.a) filter (f.phrase))::bigint as first_word, (max(f.a) filter (f.phrase))::bigint as last_word,
       coalesce(string_agg(distinct f.label, ',' order by f.label) filter (f.phrase), '') as base_labels,
       coalesce(string_agg(distinct f.label, ',' order by f.label), '') as labels,
       coalesce(max(f.cover), 0.0)::double as score
from d left join f on d.doc_id = f.doc_id group by d.doc_id, d.w
"""


ORACLE_SQL["op6_license_scan"] = _license_sql()

def _linked_sql(k: int) -> str:
    """Components of documents whose sets of ``k``-word shingles reach 80 %: ``d(doc_id)``, set
    sizes ``n(doc_id, n)``, and ``r(node, seen)``, what each document reaches."""
    gram = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(k))
    return rf"""
with recursive {_words_sql(r"[\x20\x09-\x0D]+")},
s as (
  select distinct doc_id, unnest(case
    when len(w) >= {k} then list_transform(range(1, len(w) - {k - 2}), lambda i: {gram})
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g
  from d),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select x.doc_id as a, y.doc_id as b, count(*) as i
  from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
l as (
  select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * i >= 80 * (na.n + nb.n - i)),
e as (select a, b from l union select b, a from l),
r as (
  select doc_id as node, doc_id as seen from d
  union
  select r.node, e.b from r join e on e.a = r.seen)"""


ORACLE_SQL["op8_near_dedup"] = _linked_sql(4) + """
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.seen) as component_id, d.doc_id = min(r.seen) as kept
from d join r on r.node = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
"""

ORACLE_SQL["op12_ngram_join"] = _linked_sql(5) + """
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.seen) as component_id
from d join r on r.node = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
"""


def _clusters_sql(rounds: int = 10, k: int = 8, dims: int = 64) -> str:
    """Every round in two steps: ``a``, the nearest centroid of each vector (the smaller of
    ``distance * k + number``), and ``c``, the new centroids."""
    each = f"range(1, {dims + 1})"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select vec_id, x, min(list_sum(list_transform({each}, lambda i: (x[i] - m[i]) * (x[i] - m[i])))::bigint * {k} + c) as best
  from v cross join c{r} group by vec_id, x)""")
        if r < rounds:
            steps.append(f"""s{r} as (
  select best % {k} as c, i, sum(x[i]) as s, count(*)::hugeint as n from a{r} cross join (select unnest({each}) as i) group by 1, 2),
c{r + 1} as materialized (
  select c{r}.c, coalesce(u.m, c{r}.m) as m from c{r} left join (
    select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as m from s{r} group by c) u on u.c = c{r}.c)""")
    return f"""
with v as materialized (
  select vec_id, list_transform(embedding, lambda x: floor({1024} * x::double)::bigint) as x
  from embeddings
  where len(embedding) = {dims} and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
c0 as materialized (
  select row_number() over (order by sha256('3:' || vec_id)) - 1 as c, x as m
  from v order by sha256('3:' || vec_id) limit {k}),
{", ".join(steps)}
select vec_id, (best % {k})::integer as "cluster", (best // {k})::bigint as distance,
       sum(best // {k}) over (partition by best % {k})::bigint as cluster_inertia,
       sum(best // {k}) over ()::bigint as inertia, sha256(array_to_string(m, ',')) as centroid_sha256
from a{rounds} join c{rounds} on c = best % {k}
"""


ORACLE_SQL["op11_bisector_clusters"] = _clusters_sql()

ORACLE_SQL["op5_suffix_dedup"] = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as materialized (
  select doc_id, s, md5_number(substr(h, 2 * s + 1, 200)) as k
  from (select doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 99))) as s from d)),
f as (select k, min(doc_id * 1000000000 + s) as first from w group by k having count(*) > 1),
g as (
  select doc_id, s, s - lag(s) over (partition by doc_id order by s) as step
  from w join f using (k) where doc_id * 1000000000 + s > first),
r as (
  select doc_id, min(s) as a, max(s) + 100 as z
  from (select doc_id, s, sum(case when step is null or step > 100 then 1 else 0 end)
                          over (partition by doc_id order by s rows unbounded preceding) as run from g)
  group by doc_id, run),
c as (
  select r.doc_id, substr(any_value(d.h), 2 * coalesce(lag(r.z) over (partition by r.doc_id order by r.a), 0) + 1,
                          2 * (r.a - coalesce(lag(r.z) over (partition by r.doc_id order by r.a), 0))) as part, r.a, r.z
  from r join d using (doc_id) group by r.doc_id, r.a, r.z),
k as (
  select doc_id, string_agg(part, '' order by a) as front, max(z) as z, sum(z - a) as gone, count(*) as spans
  from c group by doc_id)
select d.doc_id, len(h) // 2 as n_bytes, coalesce(gone, 0)::bigint as n_removed, coalesce(spans, 0) as n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(z, 0) + 1))) as kept_sha256
from d left join k using (doc_id)
"""


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.license_scan import license_scan
    ready(spark)
    return license_scan(documents(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.quality_rules import weak_quality
    ready(spark)
    return weak_quality(documents(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidewire.llm.packing import pack
    ready(spark)
    return pack(documents(spark, sf_dir, "documents", "doc_id", "text"),
                str(public_tokenizers.path("word_bpe_49k.json")))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.toxicity import toxicity
    ready(spark)
    return toxicity(documents(spark, sf_dir, "documents", "doc_id", "text"), documents(spark, sf_dir, "labels"))


@query
def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.quality_fm import quality
    ready(spark)
    return quality(documents(spark, sf_dir, "documents", "doc_id", "text", "n_chars"),
                   documents(spark, sf_dir, "labels"))


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.near_dedup import near_duplicates
    ready(spark)
    return near_duplicates(documents(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.decontam import contaminated
    ready(spark)
    return contaminated(documents(spark, sf_dir, "documents", "doc_id", "text"), documents(spark, sf_dir, "benchmark"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.suffix_dedup import suffix_dedup
    ready(spark)
    return suffix_dedup(documents(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.lm_score import lm_score
    ready(spark)
    return lm_score(documents(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.url_graph import url_filter
    ready(spark)
    return url_filter(documents(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op11_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.bisector_kmeans import centroid_clusters
    ready(spark)
    return centroid_clusters(documents(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidewire.llm.alignment import cross_alignment
    ready(spark)
    return cross_alignment(documents(spark, sf_dir, "documents", "doc_id", "text"),
                           str(public_tokenizers.path("byte_bpe_50k.json")),
                           str(public_tokenizers.path("piece_bpe_32k.model")))


@query
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewire.llm.ngram_join import jaccard_components
    ready(spark)
    return jaccard_components(documents(spark, sf_dir, "documents", "doc_id", "text"))
