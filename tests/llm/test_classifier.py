"""The classifier by held-out accuracy, and its gradients by differences."""

import numpy as np

from edge import edge_docs, empty_docs
from samesense.llm import classifier
from samesense.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    scored = QUERIES["op8_quality_classifier"](spark, FOLDER)
    assert scored.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert scored.where("score IS NULL OR score < 0 OR score > 1 OR predicted <> cast(score >= 0.3 AS int)").count() == 0
    tested = scored.join(labels, "doc_id").where("held_out")
    assert tested.count() > 40
    assert tested.where("predicted = quality").count() / tested.count() > 0.95


def test_no_label_of_a_held_out_row_is_learned(spark):
    """Turning the held-out labels round changes no score."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    turned = labels.withColumn("quality", classifier.held_out("doc_id").cast("int").bitwiseXOR(labels["quality"]))
    one, two = classifier.fit(docs, labels), classifier.fit(docs, turned)
    assert all(np.array_equal(one.weights[k], two.weights[k]) for k in one.weights)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 0), (7, 1), (7, 0), (9, 1), (12, 0), (None, 1), (5, None), (999, 1)], "doc_id bigint, quality int"
    )
    scored, name = classifier.score(docs, classifier.fit(docs, labels))
    rows = scored.collect()
    assert len(rows) == docs.count() and all(0 <= r[name] <= 1 for r in rows)
    assert len({r[name] for r in rows if r["doc_id"] == 7}) == 1
    none = labels.limit(0)
    assert {r["score"] for r in classifier.score(docs, classifier.fit(docs, none))[0].collect()} == {0.5}
    assert classifier.score(empty_docs(spark), classifier.fit(empty_docs(spark), labels))[0].count() == 0


def test_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    sample = classifier.labelled_sample(docs, labels, "quality", rows=50)
    assert sample.count() == 50 and sample.where(classifier.held_out("doc_id")).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    bags = [rng.standard_normal((n, classifier.SIZE)) for n in (1, 3, 2)]
    x, starts, y = np.concatenate(bags), np.array([0, 1, 4]), np.array([1.0, 0.0, 1.0])
    shape = lambda *s: rng.standard_normal(s) * 0.3
    h, g = classifier.HIDDEN, classifier.GATE
    w = {
        "mean": np.zeros(classifier.SIZE), "scale": np.ones(classifier.SIZE), "encode": shape(classifier.SIZE, h),
        "encode0": shape(h), "tanh": shape(h, g), "gate": shape(h, g), "attend": shape(g), "score": shape(h), "score0": 0.1,
    }

    def loss(w):
        p = classifier._forward(w, x, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = classifier._gradients(w, x, starts, y)
    for k, grad in found.items():
        flat = np.atleast_1d(np.asarray(w[k], float))
        for i in rng.choice(flat.size, min(4, flat.size), replace=False):
            moved = []
            for step in (1e-5, -1e-5):
                other = flat.copy()
                other.flat[i] += step
                moved.append(loss({**w, k: other if np.ndim(w[k]) else float(other[0])}))
            assert abs((moved[0] - moved[1]) / 2e-5 - np.atleast_1d(grad).flat[i]) < 1e-4


def test_attention_sums_to_one():
    model = classifier.learn([np.ones((2, classifier.SIZE), "float32"), np.zeros((1, classifier.SIZE), "float32")] * 4, np.array([1, 0] * 4, "float32"))
    f = classifier._forward(model.weights, np.ones((5, classifier.SIZE), "float32"), np.array([0, 2]))
    assert np.allclose(np.add.reduceat(f["a"], [0, 2]), 1)
