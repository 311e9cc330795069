import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from topicforge.operators import matrix_fit as MF
from topicforge.operators import model as MO
from topicforge.operators import splits as SP
from topicforge.operators.scoring import add_predictions
from topicforge.plans import evaluate as EV


def toy(spark):
    rows = [(i, ("alpha beta " if i % 2 else "gamma delta ") + f"x{i % 5}", [i % 2, 1 - i % 2, int(i % 5 == 0), 0])
            for i in range(120)]
    return spark.createDataFrame(rows, "id long, text string, labels array<int>")


def test_per_label_fit_learns_and_handles_single_class(spark):
    df = toy(spark)
    m = MO.fit_topic_classifier(df, "text", "labels", ("a", "b", "c", "never"), num_features=1 << 10, max_iter=30)
    assert isinstance(m.heads[3], float) and m.heads[3] < 0          # constant logit for an all-zero label
    got = add_predictions(MO.score_topics(df, m, "logits"), "logits").select("labels", "preds").collect()
    assert sum(r["labels"] == r["preds"] for r in got) == len(got)


def test_matrix_fit_equals_the_fit_of_each_label(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(160):
        words = rng.choice([f"w{k}" for k in range(12)], size=rng.integers(0, 9)).tolist()
        y = [int(("w1" in words) != (rng.random() < 0.2)), int("w2" in words or rng.random() < 0.1), 0, 1]
        rows.append((i, " ".join(words), y))
    df = spark.createDataFrame(rows, "id long, text string, labels array<int>")
    names = ("a", "b", "never", "always")
    matrix = MO.fit_topic_classifier(df, "text", "labels", names, num_features=64, max_iter=200, reg=0.01, strategy="matrix")
    got = {r["id"]: r["logits"] for r in MO.score_topics(df, matrix, "logits").collect()}
    assert MO.score_topics(df, matrix, "logits").columns == [*df.columns, "logits"]
    feats = matrix.features.transform(df)
    for k in (0, 1):
        lr = LogisticRegression(featuresCol="features", labelCol="y", maxIter=500, tol=1e-12, regParam=0.01, standardization=False)
        one = lr.fit(feats.withColumn("y", F.get("labels", k).cast("double"))).setRawPredictionCol("raw")
        for r in one.transform(feats).select("id", F.get(vector_to_array("raw"), 1).alias("z")).collect():
            assert got[r["id"]][k] == pytest.approx(r["z"], abs=2e-3)
    assert {round(z[2], 9) for z in got.values()} == {round(math.log(0.5 / 160.5), 9)} and all(z[3] > 5 for z in got.values())


def test_gradient_is_the_sum_over_rows(spark):
    rng = np.random.default_rng(1)
    x = np.where(rng.random((70, 9)) < 0.4, rng.normal(size=(70, 9)), 0.0)
    y, u = rng.random((70, 3)), rng.normal(size=(10, 3))
    rows = [(Vectors.sparse(9, {int(j): float(v) for j, v in enumerate(r) if v}) if i % 3 else Vectors.dense(r.tolist()), t.tolist()) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["f", "t"]).repartition(5)
    z = x @ u[:-1] + u[-1]
    p = 1 / (1 + np.exp(-z))
    for block, most in ((512, 1 << 15), (4, 6)):
        MF.BLOCK, MF.SLICE = block, most
        grad, loss, n = MF._gradient(df, "f", "t", u, 9, 3)
        assert n == 70 and np.allclose(loss, -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum(0))
        assert np.allclose(grad, np.concatenate([x.T @ (p - y), (p - y).sum(0)[None]]))
    MF.BLOCK, MF.SLICE = 512, 1 << 15


def test_matrix_fit_without_rows(spark):
    none = spark.createDataFrame([(Vectors.dense([1.0]), [1.0])], ["f", "t"]).limit(0)
    fit = MF.fit_matrix(none, "f", "t", 1, 1)
    assert not fit.weights.any() and not fit.intercepts.any()
    with pytest.raises(ValueError):
        MO.fit_topic_classifier(toy(spark), "text", "labels", ("a", "b", "c", "d"), strategy="other")


def test_train_evaluate_validate_on_the_test_split(spark):
    rows = [(i, f"{'sun moon' if i % 2 else 'tree leaf'} {'bird' if i % 3 else 'fish'}", [i % 2, 1 - i % 2, int(i % 3 > 0), int(i % 3 == 0)]) for i in range(400)]
    names = ("sky", "wood", "air", "water")
    df = spark.createDataFrame(rows, "id long, text string, labels array<int>")
    df = df.withColumn("categories", F.array_remove(F.array(*[F.when(F.get("labels", k) == 1, F.lit(t)).otherwise("") for k, t in enumerate(names)]), ""))
    ds = SP.train_test_split(df, "id", 0.2)
    model = EV.train(ds, "text", "labels", names, strategy="matrix", num_features=256, max_iter=40)
    got = {r["metric"]: r["value"] for r in EV.evaluate(SP.dense_ordinal(ds.where("split = 'test'"), "id", "ordinal"), model, "text", "labels", "ordinal",
                                                        categories="categories").collect()}
    n = ds.where("split = 'test'").count()
    assert got["accuracy"] == got["batch_mean_accuracy"] == 1.0 and got["loss"] < 0.05
    assert got["total"] == got["good"] == n and got["bad"] == 0 and got["bad_ratio"] == 0


def test_student_follows_soft_targets(spark):
    df = toy(spark)
    teacher = MO.fit_topic_classifier(df, "text", "labels", ("a", "b", "c", "never"), num_features=1 << 10, max_iter=30)
    t = MO.score_topics(df, teacher, "teacher")
    student = MO.fit_student(t, "text", "labels", "teacher", ("a", "b", "c", "never"), alpha=0.5, num_features=1 << 8)
    s = add_predictions(MO.score_topics(t, student, "student"), "student", out="sp")
    s = add_predictions(s, "teacher", out="tp").select("sp", "tp").collect()
    agree = sum(r["sp"] == r["tp"] for r in s) / len(s)
    assert agree > 0.9


def test_a_pass_over_many_partitions_gives_few_gradients(spark):
    feats = spark.createDataFrame([(Vectors.sparse(4, {i % 4: 1.0}), [i % 2]) for i in range(400)], ["f", "t"])
    many = feats.repartition(90)
    assert MF._few_tasks(many).rdd.getNumPartitions() <= max(spark.sparkContext.defaultParallelism, 16)
    u = np.arange(5.0).reshape(5, 1) / 10
    one, spread = (MF._gradient(d, "f", "t", u, 4, 1) for d in (feats.coalesce(1), many))
    assert all(np.allclose(a, b) for a, b in zip(one, spread)) and spread[2] == 400
