"""Topic classifiers with Spark ML.

Re-aimed from fine-tuning a transformer: the same multi-label task and
loss (one independent sigmoid per label, binary cross-entropy) with a
linear model over hashed TF-IDF features -- binary relevance.  Features
are computed once and persisted.  Two strategies fit the same model:
``"per_label"``, one ``LogisticRegression`` per label from a small driver
thread pool, and ``"matrix"``, all labels in shared passes over the rows
(``matrix_fit``), for many labels.  A label with a single class gets a
constant logit instead of a degenerate fit.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.functions.arrays import sigmoid
from topicforge.functions.text import WS
from topicforge.operators.matrix_fit import fit_matrix, scorer

NUM_FEATURES = 1 << 18


@dataclass
class TopicModel:
    features: PipelineModel
    heads: list = field(default_factory=list)  # LogisticRegressionModel or float logit
    names: tuple[str, ...] = ()
    text_col: str = "text"
    matrix: LogisticRegressionModel | None = None  # all heads in one, set by the matrix strategy


# The matrix strategy holds features x labels weights in the driver, with some copies.
MATRIX_FEATURES = 1 << 14


def feature_pipeline(text: str, num_features: int = NUM_FEATURES) -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=WS + "+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="features"),
    ])


def _fit_features(rows: DataFrame, hashing: HashingTF, keep: list[str],
                  pre: list | None = None) -> tuple[PipelineModel, DataFrame]:
    """Hash once, fit IDF on the persisted term frequencies, and return the
    (tokenise/hash/IDF) model plus the persisted training features.  The
    source rows are computed exactly once."""
    stages = list(pre or [])
    cur = rows
    for st in stages:
        cur = st.transform(cur)
    tf = hashing.transform(cur).select(hashing.getOutputCol(), *keep).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf_model = IDF(inputCol=hashing.getOutputCol(), outputCol="features").fit(tf)
        feats = idf_model.transform(tf).select("features", *keep).persist(StorageLevel.MEMORY_AND_DISK)
        feats.count()
    finally:
        tf.unpersist()
    return PipelineModel(stages=stages + [hashing, idf_model]), feats


def _label_stats(feats: DataFrame, labels: str, width: int) -> tuple[list[int], int]:
    row = feats.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.get(F.col(labels), i)).alias(f"p{i}") for i in range(width)],
    ).first()
    return [int(row[f"p{i}"] or 0) for i in range(width)], int(row["n"])


def _constant_logit(pos: int, n: int) -> float:
    return math.log((pos + 0.5) / (n - pos + 0.5))


def _fit_matrix_model(df: DataFrame, text: str, targets: str, names: tuple[str, ...], num_features: int,
                      max_iter: int, reg: float) -> TopicModel:
    """All heads in one matrix: each row is read once a pass, whatever the number of labels."""
    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=WS + "+", toLowercase=True)
    pipe, feats = _fit_features(df, HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
                                [targets], pre=[tok])
    try:
        fit = fit_matrix(feats, "features", targets, num_features, len(names), max_passes=max_iter, reg=reg)
    finally:
        feats.unpersist()
    return TopicModel(features=pipe, names=tuple(names), text_col=text, matrix=scorer(fit, "features", "_raw"))


def fit_topic_classifier(df: DataFrame, text: str, labels: str, names: tuple[str, ...],
                         num_features: int | None = None, max_iter: int = 50, reg: float = 0.0,
                         parallelism: int = 8, strategy: str = "per_label") -> TopicModel:
    """One logistic regression per label over hashed TF-IDF of ``text``;
    ``labels`` is an array<int> of width ``len(names)``.

    ``strategy="matrix"`` fits all labels in shared passes (at most
    ``max_iter``); ``"per_label"`` fits one model per label concurrently
    from a driver thread pool.  ``num_features`` is ``MATRIX_FEATURES`` or
    ``NUM_FEATURES`` if not given."""
    if strategy == "matrix":
        return _fit_matrix_model(df, text, labels, names, num_features or MATRIX_FEATURES, max_iter, reg)
    if strategy != "per_label":
        raise ValueError(f"no strategy {strategy!r}")
    num_features = num_features or NUM_FEATURES
    width = len(names)
    tok = RegexTokenizer(inputCol=text, outputCol="_tok", pattern=WS + "+", toLowercase=True)
    pipe, feats = _fit_features(df, HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
                                [labels], pre=[tok])
    try:
        pos, n = _label_stats(feats, labels, width)

        def fit_one(i: int):
            if pos[i] == 0 or pos[i] == n:
                return _constant_logit(pos[i], n)
            lr = LogisticRegression(featuresCol="features", labelCol="_y", maxIter=max_iter, regParam=reg)
            return lr.fit(feats.withColumn("_y", F.get(F.col(labels), i).cast("double")))

        with ThreadPoolExecutor(max(1, min(parallelism, width))) as pool:
            heads = list(pool.map(fit_one, range(width)))
    finally:
        feats.unpersist()
    return TopicModel(features=pipe, heads=heads, names=tuple(names), text_col=text)


def score_topics(df: DataFrame, model: TopicModel, out: str = "logits") -> DataFrame:
    """Append ``out`` = array<double> of per-label logits (margins)."""
    feats = model.features.transform(df)
    if model.matrix is not None:  # one pass over each row's features for all labels
        margins = F.slice(vector_to_array(F.col("_raw")), 1, len(model.names))
        return model.matrix.transform(feats).withColumn(out, margins).drop("_raw", "_tok", "_tf", "features")
    raw_cols = []
    for i, head in enumerate(model.heads):
        if isinstance(head, LogisticRegressionModel):
            col = f"_raw{i}"
            m = head.copy()
            m.setRawPredictionCol(col).setProbabilityCol("").setPredictionCol("")
            feats = m.transform(feats)
            raw_cols.append(F.get(vector_to_array(F.col(col)), 1))
        else:
            raw_cols.append(F.lit(float(head)))
    drop = [c for c in feats.columns if c.startswith("_raw") or c in ("_tok", "_tf", "features")]
    return feats.withColumn(out, F.array(*raw_cols)).drop(*drop)


def fit_student(df: DataFrame, text: str, labels: str, teacher_logits: str, names: tuple[str, ...],
                alpha: float = 0.5, temperature: float = 1.0, num_features: int = 1 << 12,
                max_iter: int = 50) -> TopicModel:
    """A smaller student trained on soft targets
    q = alpha * y + (1 - alpha) * sigmoid(teacher / T).

    The targets go as they are into the matrix fit, whose loss on soft
    targets has the distillation gradient; no row is repeated."""
    q = F.transform(F.arrays_zip(F.col(labels).alias("y"), F.col(teacher_logits).alias("t")), lambda x:
                    F.lit(alpha) * x["y"].cast("double") + F.lit(1.0 - alpha) * sigmoid(x["t"] / F.lit(temperature)))
    return _fit_matrix_model(df.select(text, q.alias("_q")), text, "_q", names, num_features, max_iter, 0.0)
