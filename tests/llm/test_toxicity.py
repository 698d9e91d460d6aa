import duckdb
import numpy as np
import pyarrow as pa

from marketlens.llm import toxicity as X


def test_unlabelled_documents_with_known_words(spark):
    """Learned from the labels only; held against the documents whose labels it has not seen."""
    sf = "/root/testdata/sf0.1"
    words = "|".join(X.INSULTS + X.CONTEMPT)
    rows = duckdb.sql(
        f"select d.doc_id, toxic, regexp_matches(lower(text), '\\b({words})\\b') from '{sf}/documents.parquet' d left join '{sf}/labels.parquet' using (doc_id)"
    ).fetchall()
    found = {r.doc_id: r for r in X.op6_toxicity(spark, sf).collect()}
    assert len(found) == len(rows)
    unseen = [(found[k].toxic, has) for k, label, has in rows if label is None]
    assert sum(t for t, has in unseen if has) > 0.95 * sum(has for _, has in unseen)
    clean = [found[k].toxic for k, label, _ in rows if label == 0]
    assert sum(clean) <= 0.001 * len(clean)
    assert all(0 <= p <= 1 for r in found.values() for p in (r.p_insult, r.p_contempt, r.p_toxic))


def test_features_do_not_depend_on_neighbours(odd_rows):
    texts = [r[1] for r in odd_rows]
    owner, bucket = X.features(pa.array(texts))
    for i, t in enumerate(texts):
        assert bucket[owner == i].tolist() == X.features(pa.array([t], pa.string()))[1].tolist()


def test_earlier_probabilities_help_later_models():
    """The second category is the first one plus a feature; the chain finds both."""
    rng = np.random.default_rng(0)
    has = rng.random((2_000, 2)) < 0.3
    owner, bucket = np.nonzero(has)
    labels = np.stack([has[:, 0], has[:, 0] & has[:, 1]], axis=1).astype(int)
    chain = X.fit_chain(np.array([0, 1]), np.arange(2_000) % X.FOLDS, owner, bucket, labels)
    p = chain.probabilities(2_000, owner, chain.columns[bucket])
    assert ((p > 0.5) == labels).mean() > 0.99 and len(chain.weights[1]) == len(chain.weights[0]) + 1


def test_odd_tables(spark, odd_docs, no_docs, keyless):
    labels = spark.createDataFrame([(1, 1), (28, 0), (7, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    for docs, known in ((odd_docs, labels), (odd_docs, labels.limit(0)), (no_docs, labels), (keyless, labels)):
        assert X.judged(docs, X.train_on_tables(docs, known)).count() == docs.count()


def test_stage_keeps_clean_rows_and_columns(spark, odd_docs, monkeypatch):
    labels = spark.createDataFrame([(1, 0), (28, 0)], "doc_id long, toxic int")
    monkeypatch.setattr(X, "table", lambda *a: labels)
    kept = X.not_toxic(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd_docs.collect()))
