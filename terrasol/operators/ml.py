"""Supervised classifiers with Spark ML (M5 M6), evaluated by accuracy.

Transformer fine-tuning is not built; the text classifier is a Spark ML
pipeline over token chunks (tokenise → hashed term frequencies → IDF →
logistic regression) and the few-shot embedding classifier is a logistic
regression on the embedding vectors.  Both train on the 80 % side of the
stratified split and report accuracy on the 20 % side.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import array_to_vector
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _accuracy(pred: DataFrame, label: str = "label") -> DataFrame:
    return pred.agg(F.count("*").alias("n_test"),
                    F.avg((F.col("prediction") == F.col(label).cast("double")).cast("double")).alias("accuracy"))


def text_classifier(chunks: DataFrame, text: str = "chunk_text", label: str = "label", split: str = "split",
                    num_features: int = 1 << 16, max_iter: int = 20) -> DataFrame:
    """Train on chunk rows with ``split == 'train'``; one row (n_train, n_test, accuracy).
    The chunk table is persisted (memory, spilling to disk) for the several
    passes of IDF and the optimiser, then released."""
    # one partition per core for the iterative passes (not the SQL shuffle width)
    n = chunks.sparkSession.sparkContext.defaultParallelism
    data = (chunks.select(text, F.col(label).cast("double").alias(label), split).repartition(n)
                  .persist(StorageLevel.MEMORY_AND_DISK))
    train = data.where(F.col(split) == "train")
    test = data.where(F.col(split) == "test")
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"\W+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label, maxIter=max_iter, regParam=0.01),
    ])
    model = pipe.fit(train)
    n_train = train.count()
    res = _accuracy(model.transform(test), label).select(F.lit(n_train).alias("n_train"), "n_test", "accuracy")
    out = res.cache()          # one-row result kept before the training data is released
    out.count()
    data.unpersist()
    return out


def embedding_classifier(df: DataFrame, embedding: str = "embedding", label: str = "label", split: str = "split",
                         max_iter: int = 100) -> DataFrame:
    """Multinomial logistic regression on embedding vectors (M6)."""
    n = df.sparkSession.sparkContext.defaultParallelism
    vec = (df.withColumn("_features", array_to_vector(F.col(embedding))).withColumn(label, F.col(label).cast("double"))
             .select("_features", label, split).repartition(n))
    train, test = vec.where(F.col(split) == "train"), vec.where(F.col(split) == "test")
    model = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=max_iter, regParam=0.001).fit(train)
    res = _accuracy(model.transform(test), label)
    return res.select(F.lit(train.count()).alias("n_train"), "n_test", "accuracy")


def linear_weights(train: DataFrame, text: str, label: str, num_features: int = 1 << 14, max_iter: int = 10):
    """One label's text classifier as plain numbers: the weight of each hashed term with its IDF, and the intercept.

    The pipeline of :func:`text_classifier`; ``num_features`` numbers reach the driver, for
    :class:`terrasol.operators.scorers.LinearScorer`."""
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"\W+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="_y", maxIter=max_iter, regParam=0.01),
    ])
    data = train.select(text, F.col(label).cast("double").alias("_y")).persist(StorageLevel.MEMORY_AND_DISK)
    model = pipe.fit(data)
    data.unpersist()
    idf, regression = model.stages[2], model.stages[3]
    return idf.idf.toArray() * regression.coefficients.toArray(), float(regression.intercept)
