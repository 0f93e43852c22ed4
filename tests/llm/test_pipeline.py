"""The corpus pipeline and the registry."""

import os

import corpus_pipeline as P
from tests.llm.rows import empty_docs
from tidewire.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_registry():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(ORACLE_SQL) <= set(QUERIES)


def test_stages_hand_on_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.collect()}
    now, seen = docs, []
    for _, stage in P.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
        rows = now.collect()
        kept = {r.doc_id for r in rows}
        assert len(kept) == len(rows) and kept <= ids
        seen.append(len(rows))
        now = spark.createDataFrame(rows, docs.schema)
    assert seen[0] < len(ids) and seen[1] < seen[0]
    pieces = P.STAGES[-1][1](spark, now, SF).collect()
    assert {r.doc_id for r in pieces} == kept
    ran = P.run(spark, SF).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32) for r in ran} == {
        (r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces}


def test_stages_take_an_empty_table(spark):
    now = empty_docs(spark)
    for _, stage in P.STAGES:
        now = stage(spark, now, SF)
    assert now.count() == 0


def test_nothing_else_imports_this_package():
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(top, "tidewire")):
        if not folder.endswith("llm"):
            for f in files:
                if f.endswith(".py"):
                    assert "tidewire.llm" not in open(os.path.join(folder, f)).read(), f
