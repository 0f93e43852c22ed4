"""Corpus pipeline: from raw documents to packed training sequences.

Five stages, in order: the quality classifier rejects junk, of each group of near
duplicates one document stays, passages that repeat elsewhere are cut out,
documents that hold benchmark items go, and what is left is packed.  Every stage
reads what its predecessor wrote and returns the columns of ``documents``, the last
one returns the pieces of the packed sequences.

Defined cases: nulls, blank texts, texts of any length, ties and repeated rows are
what each stage's module says of them; an empty table gives an empty result; other
columns than those of ``documents`` are passed on as they are up to packing, which
leaves them aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.core import documents, ready, release, written
from tidewire.llm.queries import QUERIES


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewire.llm.quality_fm import keep_quality, train
    ready(spark)
    return keep_quality(docs, train(docs, documents(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewire.llm.near_dedup import keep_first
    ready(spark)
    return keep_first(docs, words=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewire.llm.suffix_dedup import cut_repeats
    ready(spark)
    return cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from tidewire.llm.decontam import drop_contaminated
    ready(spark)
    return drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidewire.llm.packing import pack
    ready(spark)
    return pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates),
          ("suffix-array dedup", repeated_passages), ("benchmark decontamination", decontamination),
          ("packing", packing)]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes Parquet below the shared
    checkpoint folder, which the next one reads."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        release(spark)
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
