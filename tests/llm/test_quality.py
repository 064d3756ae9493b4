"""The line field: marginals by brute force, held-out accuracy, edge rows."""

import itertools

import numpy as np

from menulake.llm.common import table
from menulake.llm.line_quality import features, fit, good_documents, line_quality, marginals
from menulake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_marginals_are_those_of_all_labelings():
    rng = np.random.default_rng(1)
    for _ in range(5):
        u, ties = rng.normal(size=5) * 2, rng.normal(size=(2, 2))
        p, z = np.zeros(5), 0.0
        for s in itertools.product((0, 1), repeat=5):
            e = np.exp(sum(u[i] for i in range(5) if s[i]) + sum(ties[s[i], s[i + 1]] for i in range(4)))
            z, p = z + e, p + e * np.array(s)
        assert np.allclose(marginals(u, ties), p / z)


def test_neighbours_are_features():
    x, n = features("Good line here.\n\n*** ### ***\nAnother good line.")
    own = x.shape[1] // 3
    assert len(x) == 3 and list(n) == [15, 11, 18]
    assert (x[1, own:2 * own] == x[0, :own]).all() and (x[1, 2 * own:3 * own] == x[2, :own]).all()
    assert (x[0, own:2 * own] == 0).all() and x[0, -2] == 1 and x[2, -1] == 1


def test_fit_ignores_order():
    docs = [(features("a good plain line.\nand one more.")[0], 1), (features("### *** $$$\n%%% &&&")[0], 0)] * 5
    a, b = fit(docs, 20), fit(docs[::-1], 20)
    assert np.allclose(a.weights, b.weights)


def test_held_out_accuracy(spark):
    r = QUERIES["op2_line_quality"](spark, SF).toPandas()
    assert len(r) == table(spark, SF, "documents").count() and r.score.between(0, 1).all()
    m = r.merge(table(spark, SF, "labels").toPandas(), on="doc_id")
    held = m[m.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.97
    import zlib
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in r.itertuples())


def test_edge_rows(spark):
    labels = table(spark, SF, "labels")
    d = spark.createDataFrame([(1, None, "a", 1), (2, "x y z", "b", 1), (2, "x y z", "b", 1), (3, "", None, 2), (None, "q\n\n \n", "c", 1), (5, "w " * 50_000, "a", 1)],
                              "doc_id long, text string, label string, quality int")
    r = line_quality(d, labels).collect()
    assert len(r) == 6 and all(0 <= x.score <= 1 for x in r)
    assert len({x.score for x in r if x.doc_id in (1, 3)}) == 1
    assert line_quality(d.limit(0), labels.limit(0)).count() == 0
    assert {x.score for x in line_quality(d, labels.limit(0)).collect()} <= {0.5} | {x.score for x in line_quality(d, labels.limit(0)).collect()}
    assert good_documents(d, labels).columns == d.columns


def test_held_out_labels_are_not_seen(spark):
    from pyspark.sql import functions as F

    from menulake.llm.line_quality import fit_quality, held_out
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit_quality(docs, labels), fit_quality(docs, turned)
    assert (a.weights == b.weights).all() and (a.ties == b.ties).all()
