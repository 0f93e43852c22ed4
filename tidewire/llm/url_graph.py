"""URL filter by rules and link-graph propagation.

A page that a rule fits gets the rule's verdict.  All others are judged by host:
trust starts at hosts with allowed pages and follows links, distrust starts at
hosts most of whose pages a rule for whole hosts blocks (a rule for one path says
little about the rest) and follows links backwards (who links to a bad host is
suspect); both are personalised PageRanks, computed side by side by
repeated joins over the host edges until they have settled (``SETTLED``) and reach no
further host.  A host is blocked where its distrust outweighs its trust.

Edges are the absolute links of the pages' html, weighted by how many pages hold them, and, both ways, a link between a host and its parent domain, so that subdomains
share their fate.  Links are counted per pair of hosts before anything is joined,
and ranks are summed within tasks first, so a hub host is no hot key.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no
rule and is allowed; null html has no links; a host without trust and distrust, or with
equal ones, is allowed; of rules of equal length the later one wins; repeated rows are judged one by
one, their links count each; a very long html is read whole; an empty table gives an empty
result; columns besides ``page_id``, ``url`` and ``html`` are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import written

#: (verdict, host, path) of the rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]
DAMPING = 0.85
#: The walks end when all that is still to move is at most this share of all rank, of trust and of distrust
#: alike, and no host was reached for the first time.
SETTLED = 1e-6
#: A host is blocked if its distrust is more than this many times its trust.
BALANCE = 1.0
#: A host starts distrust if more than this share of its pages is blocked by rules
#: whose path is ``/``.
BLOCKED_SHARE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HREF = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def url_parts(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url)`` with ``host`` and ``path``."""
    has = F.coalesce(F.instr("url", "://") > 0, F.lit(False))
    rest = F.when(has, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    p = pages.select("page_id", rest.alias("rest"))
    raw = F.regexp_extract("rest", r"^[^/?#]*", 0)
    p = p.select("page_id", "rest", raw.alias("raw"))
    return p.select("page_id", F.translate("raw", _UPPER, _LOWER).alias("host"),
                    F.regexp_extract(F.expr("substring(rest, char_length(raw) + 1)"), r"^[^?#]*", 0).alias("path"))


def fitting_rule(rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits ``host`` and ``path``."""
    rule = verdict = F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``(src, dst, w)``: counted links between different hosts, and between
    each known host and its parent domain."""
    own = pages.select("page_id", "url", "html").where(F.col("html").isNotNull())
    links = own.select("page_id", "url", F.explode(F.array_distinct(
        F.regexp_extract_all("html", F.lit(_HREF), F.lit(1)))).alias("to"))
    src = url_parts(links.select(F.struct("page_id", "to").alias("page_id"), "url"))
    links = src.select(F.col("host").alias("src"), F.translate("page_id.to", _UPPER, _LOWER).alias("dst"))
    links = links.where("src <> dst and src <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("w"))
    links = written(links, "host-links")
    known = hosts.select("host").union(links.select(F.col("dst").alias("host"))).distinct()
    labels = F.split("host", r"\.")
    # a host and all its parents with two labels or more
    chain = known.select(F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(labels) - 2)),
        lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")).alias("up"))
    steps = chain.where(F.size("up") > 1).select(F.explode(F.arrays_zip(
        F.expr("slice(up, 1, size(up) - 1)").alias("a"), F.expr("slice(up, 2, size(up) - 1)").alias("b"))).alias("s"))
    kin = steps.select("s.a", "s.b").distinct()
    one = F.lit(1.0).alias("w")
    both = links.union(kin.select(F.col("a").alias("src"), F.col("b").alias("dst"), one)).union(
        kin.select(F.col("b").alias("src"), F.col("a").alias("dst"), one))
    return both.groupBy("src", "dst").agg(F.sum("w").alias("w"))


def spread(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING,
           settled: float = SETTLED) -> DataFrame:
    """``(host, kind, rank)`` of personalised PageRank from ``seeds(host, kind, mass)`` over
    ``edges(src, dst, kind, w)``; ``w`` are shares of what a host passes on, a host without links
    passes on nothing.  Each round moves on what the last one moved (``delta``), so what moves shrinks by
    ``damping`` a round and the walks end by themselves, however long the paths are.  Every round is
    written, since it reads the one before twice; two rows reach the driver.  ``rounds`` stops after so many, for comparison."""
    rank = written(seeds.select("host", "kind", (F.col("mass") * (1 - damping)).alias("rank"),
                                (F.col("mass") * (1 - damping)).alias("delta")), "ranks", per_core=1)
    step = edges.select(F.col("src").alias("host"), "kind", "dst", "w")
    done, reached = 0, -1
    while rounds is None or done < rounds:
        moved = rank.where("delta > 0").join(step, ["host", "kind"]).select(
            F.col("dst").alias("host"), "kind", (F.col("delta") * F.col("w") * damping).alias("delta"))
        rank = rank.select("host", "kind", "rank", F.lit(0.0).alias("delta")).union(
            moved.select("host", "kind", F.col("delta").alias("rank"), "delta")).groupBy("host", "kind").agg(
            F.sum("rank").alias("rank"), F.sum("delta").alias("delta"))
        done += 1
        rank = written(rank, "ranks", per_core=1)
        if rounds is None:
            now = rank.groupBy("kind").agg(F.sum("delta").alias("d"), F.sum("rank").alias("r"), F.count(F.lit(1)).alias("n")).collect()
            hosts = sum(r["n"] for r in now)
            if hosts == reached and all(r["d"] * damping / (1 - damping) <= settled * r["r"] for r in now):
                break
            reached = hosts
            if not now:
                break
    return rank.select("host", "kind", "rank")


def host_scores(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """``(host, trust, distrust)`` of all hosts that the walks reach.
    ``judged(host, rule, verdict)`` has one row per page."""
    per = written(judged.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"),
        F.count(F.when((F.col("verdict") == "block") & F.col("rule").rlike("^[^/]*/$"), 1)).alias("blocked")), "hosts")
    edges = written(host_edges(pages, per), "host-edges")
    # trust follows links, distrust goes against them; both kinds in one table and one join a round
    fan = edges.groupBy("src").agg(F.sum("w").alias("all"))
    ahead = edges.join(fan, "src").select("src", "dst", F.lit(0).alias("kind"), (F.col("w") / F.col("all")).alias("w"))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    fan = back.groupBy("src").agg(F.sum("w").alias("all"))
    back = back.join(fan, "src").select("src", "dst", F.lit(1).alias("kind"), (F.col("w") / F.col("all")).alias("w"))
    steps = written(ahead.union(back), "host-steps")
    trusted = per.where(f"allowed > 0 and blocked <= {BLOCKED_SHARE} * pages").select(
        "host", F.lit(0).alias("kind"), F.col("allowed").cast("double").alias("mass"))
    bad = per.where(f"blocked > {BLOCKED_SHARE} * pages").select(
        "host", F.lit(1).alias("kind"), F.col("blocked").cast("double").alias("mass"))
    seeds = written(trusted.union(bad), "seeds", per_core=1)
    whole = {r["kind"]: r["m"] for r in seeds.groupBy("kind").agg(F.sum("mass").alias("m")).collect()}  # two rows
    share = F.when(F.col("kind") == 0, F.col("mass") / whole.get(0, 1.0)).otherwise(F.col("mass") / whole.get(1, 1.0))
    rank = spread(steps, seeds.withColumn("mass", share))
    return rank.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == 1, F.col("rank")).otherwise(0.0)).alias("distrust"))


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, balance: float = BALANCE) -> DataFrame:
    """``pages(page_id, url, html)`` as ``page_id, host, path, rule, verdict,
    trust, distrust``."""
    rule, verdict = fitting_rule(rules)
    parts = url_parts(pages.select("page_id", "url")).withColumns({"rule": rule, "ruled": verdict})
    scores = host_scores(pages, parts.select("host", "rule", F.col("ruled").alias("verdict")))
    scored = parts.join(scores, "host", "left").withColumns(
        {k: F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust")})
    own = F.when(F.col("distrust") > balance * F.col("trust"), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
                         "trust", "distrust")
