import numpy as np

from postscope.llm import quality_fm as M
from postscope.llm.queries import QUERIES


def test_sum_of_squares_identity():
    machine = M.Machine(M.Settings(bits=6, factors=3))
    rng = np.random.default_rng(1)
    machine.w, machine.bias = rng.normal(size=machine.w.shape).astype(np.float32), np.float32(0.3)
    index, value = np.array([1, 7, 30, 70]), rng.normal(size=4).astype(np.float32)
    z = machine.bias + sum(machine.w[i] * x for i, x in zip(index, value))
    z += sum(machine.v[index[a]] @ machine.v[index[b]] * value[a] * value[b] for a in range(4) for b in range(a))
    assert abs(machine.score(index, value) - 1 / (1 + np.exp(-z))) < 1e-5


def test_learns_an_interaction():
    """Labels that no weight per feature can tell: both or neither of two features."""
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(400):
        a, b = rng.integers(0, 2, 2)
        rows.append((np.array([[0, 1][a], [2, 3][b]]), np.ones(2, dtype=np.float32)))
        labels.append(a == b)
    machine = M.Machine(M.Settings(bits=3, factors=4, steps=400, rate=0.1)).fit(rows, np.array(labels))
    assert np.mean([(machine.score(*r) > 0.5) == y for r, y in zip(rows, labels)]) == 1.0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op9_factorisation_quality"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    assert len(good) > 50 and len(bad) > 10
    assert np.mean([g > b for g in good for b in bad]) > 0.9  # area under the curve
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.95


def test_features():
    index, value = M.features("Some words, some WORDS\nand more", 12, 10)
    assert len(set(index.tolist())) == len(index) and (np.diff(index) > 0).all()
    assert np.array_equal(M.features("", None, 10)[0], np.sort(M.features("", None, 10)[0])) and len(M.features("", None, 10)[0]) == M.FIELDS
