import inspect

import corpus_pipeline
from jobmart.llm.queries import ORACLES, QUERIES
from tests.llm.test_near_dedup import shingles
from tests.oracle_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"


def test_queries_and_oracles():
    assert [k.split("_")[0] for k in sorted(QUERIES, key=lambda k: int(k[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 11)]
    assert set(ORACLES) <= set(QUERIES)


def test_same_as_sql(spark):
    for key, sql in ORACLES.items():
        assert difference(QUERIES[key](spark, SF_DIR), connect(SF_DIR), sql) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    benchmark = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        docs = stage(spark, docs, SF_DIR)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns and len(rows) <= before
        before = len(rows)
        if name == "exact duplicates":
            plain = ["".join(c for c in r.text or "" if c not in " \t\n\x0b\x0c\r") for r in rows]
            assert len(set(plain)) == len(plain)
        if name == "near duplicates":
            sets = [shingles(r.text, 5) for r in rows]
            assert not any(a and 100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
        if name == "decontamination":
            assert not any(b in (r.text or "") for b in benchmark for r in rows)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in rows}


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == columns, name
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.where("text IS NULL OR doc_id = 9").count() == 0
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
