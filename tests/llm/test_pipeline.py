import duckdb
import pytest

import corpus_pipeline
from marketlens.llm import decontaminate, near_dedup


def test_stages_in_order(spark, monkeypatch):
    """Every stage works on what the one before it kept, and its decisions take effect."""
    sf = "/root/testdata/sf0.001"
    seen = []

    def watched(name, stage):
        def run(session, docs, folder):
            out = stage(session, docs, folder)
            seen.append((name, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}, docs.columns))
            return out

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert [n for n, _, _ in seen] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(c == columns for _, _, c in seen)
    rows = [d for _, d, _ in seen]
    assert len(rows[0]) == duckdb.sql(f"select count(*) from '{sf}/documents.parquet'").fetchall()[0][0]
    largest = {t: k for k, t in sorted(rows[1].items())}
    assert rows[2] == {k: t for t, k in largest.items()}
    docs = spark.createDataFrame(list(rows[2].items()), "doc_id long, text string")
    first = {r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert rows[3].keys() == first
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = spark.createDataFrame(list(rows[3].items()), "doc_id long, text string")
    bad = {r.doc_id for r in decontaminate.with_verdict(decontaminate.contamination(docs, items)).filter("contaminated").collect()}
    assert rows[4].keys() == rows[3].keys() - bad
    assert {p.doc_id for p in pieces} == rows[4].keys()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_on_odd_rows(spark, odd_docs, keyless, no_docs, name, stage):
    """Null, empty and long texts, repeated rows, null keys, clashing names: rows go or stay as they are, none is changed."""
    sf = "/root/testdata/sf0.001"
    docs = odd_docs.unionByName(keyless)
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns
    assert out.exceptAll(docs).count() == 0
    assert out.filter("doc_id IS NULL").count() == 2 or name == "exact_dedup"
    assert stage(spark, no_docs, sf).count() == 0
