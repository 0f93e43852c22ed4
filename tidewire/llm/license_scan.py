"""License scans by diagonal voting.

Every rolling k-gram of a document's words that also occurs in a license
template at place ``t`` votes for the diagonal ``place - t``.  An unbroken
copy puts all its votes on one diagonal; an inserted or dropped word moves the
rest to a neighbouring one, so neighbouring diagonals are merged.  A merged
span counts as a finding when it covers enough of the template and is not
much longer than it.

Only DataFrame functions are used.  The templates are a fixed list (some
hundred k-grams), which is why their side of the join may be broadcast; the
documents' k-grams are hashed and joined within one stage, only votes and one
row per document are shuffled.

Defined cases: a null text counts as empty; a document without words gets
zeros, nulls and empty labels; a null ``doc_id`` is kept; repeated rows are
scanned one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Words are 3-grams; all templates have three words at least.
K = 3
#: Phrases whose places are counted exactly, and their labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Longer passages, found by votes (fixed values: public license wordings).
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("mit", "the mit license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
]
#: Share of a template's k-grams that a span must show, and how long it may be
#: against the template.
MIN_COVER, MAX_STRETCH, GAP = 0.6, 1.5, 2

_WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_grams(spark, k: int = K) -> DataFrame:
    """``(tid, label, phrase, grams, t, gram, g)``: the k-grams of all
    templates; ``g`` is the hash that the join uses."""
    rows = []
    for tid, (label, text, phrase) in enumerate([(*p, True) for p in PHRASES] + [(*t, False) for t in TEMPLATES]):
        w = text.split()
        rows += [(tid, label, phrase, len(w) - k + 1, i, w[i:i + k]) for i in range(len(w) - k + 1)]
    df = spark.createDataFrame(rows, "tid int, label string, phrase boolean, grams int, t int, ws array<string>")
    return df.select("tid", "label", "phrase", "grams", "t", F.concat_ws(" ", "ws").alias("gram"),
                     F.xxhash64(*[F.get("ws", F.lit(j)) for j in range(k)]).alias("g"))


def gram_votes(docs: DataFrame, k: int = K) -> DataFrame:
    """One row per vote ``(rid, doc_id, n_words, pos, tid, label, phrase,
    grams, t)`` and, for documents without one, a row with a null ``tid``."""
    w = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("rid"),
        F.array_remove(F.split(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), _WORD_GAP), "").alias("w"))
    grams = w.select("doc_id", "rid", "w", F.size("w").cast("long").alias("n_words"),
                     F.posexplode_outer("w").alias("pos", "w0"))
    ws = [F.col("w0"), *[F.get("w", F.col("pos") + j) for j in range(1, k)]]
    grams = grams.select("doc_id", "rid", "n_words", "pos", F.concat_ws(" ", *ws).alias("own"),
                         F.xxhash64(*ws).alias("g"))
    t = F.broadcast(template_grams(docs.sparkSession, k))
    hit = grams.join(t, (grams["g"] == t["g"]) & (grams["own"] == t["gram"]), "left")
    return (hit.where(F.col("tid").isNotNull() | F.coalesce(F.col("pos") == 0, F.lit(True)))
            .select("rid", "doc_id", "n_words", "pos", "tid", "label", "phrase", "grams", "t"))


def scan_spans(docs: DataFrame, k: int = K) -> DataFrame:
    """The verified spans ``(rid, doc_id, n_words, label, phrase, start, stop,
    votes, cover)``, ``stop`` exclusive; a row with null label for a document
    without any."""
    diagonals = gram_votes(docs, k).groupBy(
        "rid", "doc_id", "n_words", "tid", "label", "phrase", "grams",
        (F.col("pos") - F.col("t")).alias("diagonal")).agg(
        F.count("tid").alias("votes"), F.min("pos").alias("start"), (F.max("pos") + k).alias("stop"))
    # a phrase needs all its votes on one diagonal; other templates merge neighbours
    same = Window.partitionBy("rid", "tid").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(same)
    merged = (diagonals
              .withColumn("new", F.when(step.isNull() | F.col("phrase") | (step > GAP), 1).otherwise(0))
              .withColumn("run", F.sum("new").over(same.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("rid", "doc_id", "n_words", "tid", "label", "phrase", "grams", "run")
              .agg(F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("stop").alias("stop")))
    cover = F.least(F.lit(1.0), F.col("votes") / F.col("grams"))
    size = F.col("grams") + k - 1
    ok = F.when(F.col("phrase"), F.col("votes") == F.col("grams")).otherwise(
        (cover >= MIN_COVER) & (F.col("stop") - F.col("start") <= MAX_STRETCH * size))
    none = F.lit(None)
    return merged.select(
        "rid", "doc_id", "n_words", F.when(ok, F.col("label")).otherwise(none).alias("label"),
        F.when(ok, F.col("phrase")).otherwise(none).alias("phrase"),
        F.when(ok, F.col("start")).alias("start"), F.when(ok, F.col("stop")).alias("stop"),
        "votes", F.coalesce(cover, F.lit(0.0)).alias("cover"))


def license_scan(docs: DataFrame, k: int = K) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: places of the phrases, their first
    and last start, labels of the phrases, labels of all spans, and the share
    of the best template that the document shows."""
    labels = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    phrase = F.col("phrase")
    return scan_spans(docs, k).groupBy("rid", "doc_id", "n_words").agg(
        F.count(F.when(phrase, 1)).alias("n_base"),
        F.min(F.when(phrase, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("start"))).cast("long").alias("last_word"),
        labels(F.when(phrase, F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"),
        F.max(F.when(F.col("label").isNotNull(), F.col("cover")).otherwise(0.0)).alias("score")).drop("rid")
