"""Quality rules as weak supervision.

Rules look at counts of a text and vote good, bad or abstain.  How far each
rule can be trusted is not set by hand: expectation-maximisation over the
vote patterns of all documents estimates, per rule, how often it votes good
on good and bad on bad documents, together with the share of good ones.  The
posterior probability of "good" given all votes then replaces a filter that
every rule must pass.

Only DataFrame functions are used.  Counting stays inside a row (no
shuffle); EM runs over the distinct vote patterns, at most 3 to the power of
the number of rules, whatever the size of the corpus.

Defined cases: a null text counts as empty; a document without words gets
no vote and the prior as its posterior; repeated rows are judged one by one
and each counts in EM; a text of any length is judged whole; a posterior of exactly
the threshold is kept; other columns than ``doc_id`` and ``text``, whatever their
names, are left aside; an empty table gives an empty result.  Windows of three words
that share a hash are compared by their words, so their count is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import written

#: name -> (value, bad if, good if); neither, or no condition: the rule abstains.
RULES: dict[str, tuple[str, str, str]] = {
    "symbols": ("n_symbols / n_words", "> 0.4", "< 0.05"),
    "marks": ("n_symbols / word_chars", "> 0.07", ""),
    "shouting": ("n_upper / word_chars", "> 0.5", ""),
    "exclaims": ("n_exclaims / n_words", "> 0.5", ""),
    "repeats": ("n_repeat_words / n_words", "> 0.4", "< 0.1"),
    "variety": ("n_distinct / sqrt(n_words)", "< 3.0", ""),
    "lines": ("n_dup_lines / n_lines", "> 0.3", ""),
}
#: What a rule is believed to vote before any document is seen, P(bad), P(abstain),
#: P(good), and how many documents, as a share of all, that belief weighs.
BELIEF = {"good": (0.05, 0.475, 0.475), "bad": (0.4, 0.4, 0.2)}
BELIEF_WEIGHT = 0.02

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SPACE = " \t\n\x0b\x0c\r"


def text_counts(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the counts that the rules look at."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    t = t.select(
        "doc_id", "text",
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("w"),
        F.filter(F.split("text", "\n"), lambda x: F.translate(x, _SPACE, "") != "").alias("l"))
    without = lambda chars: F.char_length("text") - F.char_length(F.translate("text", chars, ""))
    t = t.select(
        "doc_id", "w",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.translate("text", _SPACE, "")).cast("long").alias("word_chars"),
        without("#*$%&|<>").cast("long").alias("n_symbols"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        without("!").cast("long").alias("n_exclaims"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))
    # each 3-word window: a hash whose low bits are replaced by its place, so that
    # one sort of plain longs brings equal windows together and keeps their places
    t = t.withColumn("bits", F.expr("int(ceil(log2(n_words + 1)))"))
    t = t.withColumn("s", F.expr(
        "sort_array(case when n_words >= 3 then transform(sequence(0L, n_words - 3), i -> "
        "shiftleft(shiftright(xxhash64(get(w, int(i)), get(w, int(i) + 1), get(w, int(i) + 2)), bits), bits) | i) "
        "else cast(array() as array<bigint>) end)"))
    t = t.withColumn("again", F.expr(
        "filter(s, (x, k) -> shiftright(x, bits) = shiftright(get(s, k - 1), bits) "
        "or shiftright(x, bits) = shiftright(get(s, k + 1), bits))"))
    # all windows found twice are among these; their words, which hold no blank, decide
    t = t.withColumn("s", F.expr(
        "sort_array(transform(transform(again, x -> int(x & (shiftleft(1L, bits) - 1))), p -> "
        "named_struct('words', concat_ws(' ', get(w, p), get(w, p + 1), get(w, p + 2)), 'p', bigint(p))))"))
    t = t.withColumn("n_repeat_words", F.expr(
        "aggregate(sort_array(transform(filter(s, (x, k) -> x.words <=> get(s, k - 1).words "
        "or x.words <=> get(s, k + 1).words), x -> x.p)), "
        "named_struct('till', 0L, 'n', 0L), "
        "(a, p) -> named_struct('till', p + 3, 'n', a.n + p + 3 - greatest(a.till, p)), a -> a.n)"))
    return t.drop("w", "bits", "s", "again")


def votes(counts: DataFrame, rules: dict = RULES) -> DataFrame:
    """``counts`` with one column ``vote_<rule>``: 1 good, 0 bad, -1 abstain."""
    def vote(value: str, bad: str, good: str) -> Column:
        return F.expr(f"case when n_words = 0 then -1 when ({value}) {bad} then 0 "
                      + (f"when ({value}) {good} then 1 " if good else "") + "else -1 end")
    return counts.withColumns({f"vote_{k}": vote(*v) for k, v in rules.items()})


#: Votes in the order of the model's tables.
_VOTES = (0, -1, 1)


#: EM ends when no parameter moves by more.
SETTLED = 1e-5


def fit_rules(patterns: DataFrame, names: list[str], rounds: int | None = None, prior: float = 0.8) -> dict:
    """EM over ``patterns(vote_*, n)`` until no parameter moves by more than
    ``SETTLED``, or for ``rounds``.  One small aggregation a round; only its sums, two
    per rule and vote, reach the driver."""
    model = {"prior": prior} | {y: {k: BELIEF[y] for k in names} for y in BELIEF}
    cells = F.posexplode(F.array(*[f"vote_{k}" for k in names])).alias("rule", "vote")
    done, moved = 0, 1.0
    while moved > SETTLED and done != rounds:
        p = patterns.select("n", posterior(model, names).alias("p"), cells)
        rows = p.groupBy("rule", "vote").agg(F.sum(F.col("n") * F.col("p")).alias("good"),
                                             F.sum(F.col("n") * (1 - F.col("p"))).alias("bad")).collect()
        hit = {(r["rule"], r["vote"]): r for r in rows}
        whole = {y: sum(r[y] for r in rows if r["rule"] == 0) for y in BELIEF}
        n = whole["good"] + whole["bad"]
        weight = max(1.0, BELIEF_WEIGHT * n)
        seen = lambda i, v, y: hit[i, v][y] if (i, v) in hit else 0.0  # noqa: E731, B023
        before = model
        model = {"prior": (whole["good"] + prior * weight) / (n + weight)} | {
            y: {k: tuple((seen(i, v, y) + weight * b) / (whole[y] + weight) for v, b in zip(_VOTES, BELIEF[y]))
                for i, k in enumerate(names)} for y in BELIEF}
        moved = max(abs(model["prior"] - before["prior"]), *(
            abs(a - b) for y in BELIEF for k in names for a, b in zip(model[y][k], before[y][k])))
        done += 1
    return model


def posterior(model: dict, names: list[str]) -> Column:
    """P(good | votes) as an expression over the ``vote_*`` columns.  The
    log-odds stand in one array literal, so that every round of EM runs the
    same compiled code."""
    odds = [math.log(model["prior"] / (1 - model["prior"]))]
    for k in names:
        by = dict(zip(_VOTES, zip(model["good"][k], model["bad"][k])))
        odds += [math.log(by[v][0] / by[v][1]) for v in (-1, 0, 1)]
    table = F.lit(odds)
    total = F.get(table, F.lit(0) * F.col(f"vote_{names[0]}"))
    for i, k in enumerate(names):
        total = total + F.get(table, F.col(f"vote_{k}") + (3 * i + 2))
    return 1 / (1 + F.exp(-total))


def weak_quality(docs: DataFrame, rules: dict = RULES, rounds: int | None = None,
                 threshold: float = 0.5) -> DataFrame:
    """``docs(doc_id, text)`` judged: the base counts, ``base_failed``,
    ``kept``, ``posterior`` and the votes.  The counts are computed once and
    written to the shared scratch folder."""
    counts = written(votes(text_counts(docs), rules), "rule-votes")
    cols = [f"vote_{k}" for k in rules]
    patterns = written(counts.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    model = fit_rules(patterns, list(rules), rounds)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (counts.withColumn("posterior", posterior(model, list(rules)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
            .select("doc_id", *BASE, "base_failed", "kept", "posterior", *cols))
