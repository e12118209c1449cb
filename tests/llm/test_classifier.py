import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segrisk.llm import classifier, queries
from segrisk.llm.buffers import slices

SF = "/root/testdata/sf0.01"


def statistics(texts):
    return np.concatenate([classifier.describe_slice(d, o) for _, _, d, o in slices(pa.array(texts, pa.large_string()))])


def named(text):
    return dict(zip(classifier.STATISTICS, statistics([text])[0].tolist(), strict=True))


def test_statistics_of_a_text():
    s = named("Aa b! b!\nAa b! b!\nx9 é")
    assert s["bytes"] == pytest.approx(np.log1p(23)) and s["words"] == pytest.approx(np.log1p(8))
    assert s["upper"] == pytest.approx((2 / 23) ** 0.5) and s["exclamations"] == pytest.approx((4 / 23) ** 0.5)
    assert s["beyond_ascii"] == pytest.approx((2 / 23) ** 0.5) and s["digits"] == pytest.approx((1 / 23) ** 0.5)
    assert s["distinct_words"] == pytest.approx(4 / 8) and s["same_as_before"] == pytest.approx((2 / 8) ** 0.5)
    assert s["lines"] == pytest.approx(np.log1p(3)) and s["distinct_lines"] == pytest.approx(2 / 3)
    assert s["marked_ends"] == pytest.approx(0.5**0.5)
    assert s["distinct_pairs"] == pytest.approx(5 / 7)


def test_statistics_do_not_depend_on_neighbours():
    texts = ["", "a", "\n", "\n\n", "one two\n", "Ä " * 3000, " ", "w", "last line"]
    together = statistics(texts)
    assert np.array_equal(together, np.concatenate([statistics([t]) for t in texts]))
    assert np.isfinite(together).all()


def test_cosines_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (40, len(classifier.STATISTICS)))
    n = len(classifier.STATISTICS)
    z = classifier.draw(np.zeros(n), np.ones(n), features=20_000)(x)[:, :-1]
    far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-far / (2 * classifier.WIDTH**2))).max() < 0.05


def test_increasing_is_the_closest_increasing_line():
    rng = np.random.default_rng(3)
    raw, n = np.arange(30.0), rng.integers(1, 9, 30).astype(float)
    positive = rng.binomial(n.astype(int), np.linspace(0.1, 0.9, 30)).astype(float)
    points, value = classifier.increasing(raw, n, positive)
    assert (np.diff(value) >= 0).all() and (np.diff(points) > 0).all() and 0 < value[0] and value[-1] < 1
    # Against the definition: the largest of all averages up to a place that begin anywhere before it, least over the ends.
    best = [max(min(positive[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, 30)) for a in range(i + 1)) for i in range(30)]
    got = np.interp(raw, points, value)
    assert np.abs(got - best).max() < 0.3 and np.corrcoef(got, best)[0, 1] > 0.99


def test_normal_equations_equal_numpy(spark):
    rng = np.random.default_rng(1)
    n = len(classifier.STATISTICS)
    rows = [([float(v) for v in rng.normal(0, 1, n)], float(i % 3 == 0), i % 5) for i in range(200)]
    labelled = spark.createDataFrame(rows, "statistics array<float>, label double, fold int")
    cosines = classifier.draw(np.zeros(n), np.ones(n), features=8)
    x = np.array([r[0] for r in rows], np.float32).astype(float)
    z = np.column_stack([cosines(x), [r[1] for r in rows]])
    folds = classifier.sums_by_fold(labelled.repartition(3), cosines)
    for f in range(5):
        own = z[[r[2] == f for r in rows]]
        assert np.allclose(folds[f], own.T @ own)
    w = classifier.solve(folds.sum(axis=0), 0.01)
    held = np.diag([0.01 * 200] * 8 + [1e-9])
    assert np.allclose(w, np.linalg.solve(z[:, :-1].T @ z[:, :-1] + held, z[:, :-1].T @ z[:, -1]))
    assert classifier.loss(folds.sum(axis=0), w) == pytest.approx(((z[:, :-1] @ w - z[:, -1]) ** 2).sum())


def auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()).item()


@pytest.fixture(scope="module")
def found(spark):
    return queries.op12_quality_classifier(spark, SF).collect()


def test_held_out_quality(spark, found):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(found) == docs.count() and len({r["doc_id"] for r in found}) == len(found)
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["score"], label[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in label]
    score, truth, predicted = (np.array(x) for x in zip(*held, strict=True))
    assert len(held) > 50 and auc(score, truth) > 0.95
    assert (predicted == truth).mean() > 0.9


def test_held_out_labels_are_never_seen(spark, found, tmp_path):
    """Turning every held-out label around changes no score, nor do other columns of the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)}).write.parquet(f"{tmp_path}/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(f"{tmp_path}/labels.parquet")
    again = {r["doc_id"]: r["score"] for r in queries.op12_quality_classifier(spark, str(tmp_path)).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], abs=1e-6) for r in found)


def test_odd_rows_and_empty_tables(spark, tmp_path):
    kind = "doc_id long, text string, statistics int, label string"
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (None, "text", 1, "x"), (3, "w " * 500_000, 1, "x"), (3, "again", 1, "x")]
    for n, (docs, labels) in enumerate([(rows, []), (rows, [(1, 1), (3, 0), (None, 1), (2, None)]), (rows, [(3, 1), (3, 0)]), ([], [(1, 1)])]):
        at = f"{tmp_path}/{n}"
        spark.createDataFrame(docs, kind).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{at}/labels.parquet")
        got = queries.op12_quality_classifier(spark, at).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in docs)
        assert all(0 <= r["score"] <= 1 for r in got)
        if not labels:
            assert {r["score"] for r in got} == {0.5}
