import duckdb
import numpy as np

from marketlens.llm import quality


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.op2_quality(spark, sf).collect()
    assert len(rows) == duckdb.sql(f"select count(*) from '{sf}/documents.parquet'").fetchall()[0][0]
    label = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([p == y for p, y in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_flat_trees_equal_a_walk_from_node_to_node():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    trees = quality.train(x, (x[:, 0] * x[:, 1] > 0).astype(float))
    raw = []
    for row in x:
        total = trees.base
        for feature, limit, leaf in zip(trees.feature, trees.limit, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > limit[node] else 1)
            total += leaf[node - len(feature)]
        raw.append(total)
    assert np.allclose(raw, trees.raw(x))
    assert np.mean((trees.probability(x) > 0.5) == (x[:, 0] * x[:, 1] > 0)) > 0.9


def test_statistics_do_not_depend_on_neighbours(odd_rows):
    import pyarrow as pa

    texts = [r[1] for r in odd_rows]
    together = quality.statistics(pa.array(texts))
    alone = np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.isfinite(together).all() and np.allclose(together, alone)
    names = dict(zip(quality.STATISTICS, quality.statistics(pa.array(["A b b.\nA b b."]))[0], strict=True))
    assert names["distinct_lines"] == 0.5 and names["stopped_lines"] == 1 and names["same_as_last"] == 2 / 6 and names["top_word"] == 4 / 6


def test_odd_tables(spark, odd_docs, no_docs, keyless):
    labels = spark.createDataFrame([(1, 1), (4, 0), (7, None), (None, 1), (999, 1)], "doc_id long, quality int")
    model = quality.train(*quality.sample(odd_docs, labels, "quality", "doc_id", "text"))
    assert quality.scored(odd_docs, model).count() == odd_docs.count()
    none = quality.train(*quality.sample(no_docs, labels.limit(0), "quality", "doc_id", "text"))
    assert {r.score for r in quality.scored(keyless, none).collect()} == {0.5}
    assert quality.scored(no_docs, none).count() == 0
