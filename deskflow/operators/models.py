"""Text vectors and intent classifiers on MLlib."""

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    IDF, CountVectorizerModel, ElementwiseProduct, HashingTF, IndexToString, Normalizer, RegexTokenizer,
    StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from deskflow import fixed
from deskflow.functions.kernels import list_array, matrix_of
from deskflow.functions.text import WORD_CLASS, embed_input
from deskflow.operators.linear import SquaredHinge
from deskflow.operators.terms import term_stats, terms
from deskflow.sources.stage import exists

ROWS_PER_PART = 8192
# Blocks of the SVM should have more rows than the vocabulary has terms, to know the curvature.
ROWS_PER_BLOCK = 16384
_TEXT, _VECTOR = "_text", "_vector"


class TextEncoder:
    """Text to unit vector: hashed word counts, weighted by inverse document frequency.

    ``vectorize`` swaps in another encoder: a function from a list of texts to a (n, dim) matrix, called per
    Arrow batch inside the tasks.
    """

    def __init__(self, model: PipelineModel | None = None,
                 vectorize: Callable[[list[str]], np.ndarray] | None = None) -> None:
        self.model, self.vectorize = model, vectorize

    @classmethod
    def fit(cls, df: DataFrame, text: str = "tweet", dim: int = fixed.EMBEDDING_DIM) -> "TextEncoder":
        steps = Pipeline(stages=[
            RegexTokenizer(inputCol=_TEXT, outputCol="_words", pattern=f"[{WORD_CLASS}]{{2,}}", gaps=False),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol=_VECTOR, p=2.0),
        ])
        return cls(steps.fit(df.select(cls._input(text))))

    @staticmethod
    def _input(text: str):
        return F.coalesce(embed_input(F.col(text)), F.lit(" ")).alias(_TEXT)

    def encode(self, df: DataFrame, text: str = "tweet", output: str = "embedding") -> DataFrame:
        """Adds an array<float> unit vector."""
        if self.vectorize is not None:
            return df.withColumn(output, _external(self.vectorize)(self._input(text)))
        encoded = self.model.transform(df.withColumn(_TEXT, self._input(text)))
        return encoded.select(*df.columns, vector_to_array(_VECTOR, "float32").alias(output))


def _external(vectorize: Callable[[list[str]], np.ndarray]):
    @arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            m = np.asarray(vectorize(batch.to_pylist()), dtype=np.float32)
            length = np.linalg.norm(m, axis=1, keepdims=True)
            m = m / np.where(length > 0, length, 1)
            yield list_array(pa.array(m.ravel(), pa.float32()), m.shape[1], len(m))

    return encode


def class_weights(df: DataFrame, label: str = "intent") -> DataFrame:
    """Balanced weight n / (classes x class rows) of each class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.select(F.struct(F.sum("n").alias("n"), F.count("*").alias("k")))
    t = totals.scalar()
    return counts.select(label, "n", (t["n"] / (t["k"] * F.col("n"))).alias("weight"))


def _training_parts(n: int) -> int:
    """Every iteration is one job over these parts: enough rows in each to outweigh starting a task."""
    return max(1, math.ceil(n / ROWS_PER_PART))


def _label_table(df: DataFrame, label: str) -> tuple[StringIndexerModel, int, Column]:
    """Indexer of the sorted labels, number of rows, and a map label -> balanced weight.

    One pass; the driver sees one row per class.
    """
    counts = {r[label]: (r["n"], r["weight"]) for r in class_weights(df.filter(F.col(label).isNotNull()), label).collect()}
    names = sorted(counts)
    indexer = StringIndexerModel.from_labels(names, inputCol=label, outputCol="_label", handleInvalid="skip")
    weights = F.create_map(*[F.lit(v) for name in names for v in (name, counts[name][1])])
    return indexer, sum(n for n, _ in counts.values()), weights


class IntentClassifier:
    """Multinomial logistic regression on text vectors."""

    def __init__(self, model: LogisticRegressionModel, labels: StringIndexerModel) -> None:
        self.model, self.labels = model, labels

    @classmethod
    def fit(cls, df: DataFrame, label: str = "intent", vector: str = "embedding", c: float = 1.0,
            max_iter: int = 1000, tol: float = 1e-4) -> "IntentClassifier":
        """Balanced classes, L2 penalty 1/(2C), features as they are.

        ``tol`` bounds the relative change of the objective; ``slope`` tells how near its optimum a fit has come.
        """
        labels, n, weights = _label_table(df, label)
        rows = labels.transform(df.withColumn("weight", weights[F.col(label)])).select(
            "_label", "weight", array_to_vector(F.col(vector)).alias("_dense")
        )
        # The assembler packs vectors that are mostly zero.
        rows = VectorAssembler(inputCols=["_dense"], outputCol=_VECTOR).transform(rows).drop("_dense")
        learner = LogisticRegression(
            featuresCol=_VECTOR, labelCol="_label", weightCol="weight", family="multinomial",
            regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False, maxIter=max_iter,
            tol=tol,
        )
        # Read by every iteration.
        rows = rows.repartition(_training_parts(n)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return cls(learner.fit(rows), labels)
        finally:
            rows.unpersist()

    def predict(self, df: DataFrame, vector: str = "embedding") -> DataFrame:
        """Adds intent, confidence (unrounded) and class_probabilities."""
        names = list(self.labels.labels)
        label_array = F.array(*[F.lit(n) for n in names])
        scored = self.model.transform(df.withColumn(_VECTOR, array_to_vector(F.col(vector))))
        probs = scored.select(*df.columns, vector_to_array(self.model.getProbabilityCol()).alias("_p"))
        return best_class(probs, "_p", label_array).withColumn(
            "class_probabilities", F.map_from_arrays(label_array, "_p")
        ).drop("_p")

    def slope(self, df: DataFrame, label: str = "intent", vector: str = "embedding", c: float = 1.0) -> float:
        """Largest partial derivative of the penalised objective at the coefficients, on the training rows.

        Near 0 when the fit is at its optimum.  Each task sums its rows; one row of sums per task is added up.
        """
        labels, n, weights = _label_table(df, label)
        coefficients, start = self.model.coefficientMatrix.toArray(), self.model.interceptVector.toArray()
        place = {name: i for i, name in enumerate(labels.labels)}

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, weight = np.zeros((len(start), coefficients.shape[1] + 1)), 0.0
            for batch in batches:
                if not len(batch):
                    continue
                x = matrix_of(batch.column(1))
                w = batch.column(2).to_numpy()
                scores = x @ coefficients.T + start
                p = np.exp(scores - scores.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(x)), [place[y] for y in batch.column(0).to_pylist()]] -= 1
                total += (p * w[:, None]).T @ np.hstack([x, np.ones((len(x), 1))])
                weight += w.sum()
            flat = np.append(total.ravel(), weight)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], ["i", "s"])

        rows = df.filter(F.col(label).isNotNull()).select(label, vector, weights[F.col(label)].alias("w"))
        found = rows.mapInArrow(sums, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).toArrow().sort_by("i")
        flat = found.column("s").to_numpy()
        slopes = (flat[:-1] / flat[-1]).reshape(len(start), -1)
        slopes[:, :-1] += coefficients / (c * max(n, 1))
        return float(np.abs(slopes).max())

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/classifier")
        self.labels.write().overwrite().save(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "IntentClassifier":
        if not exists(spark, f"{path}/classifier/metadata"):
            raise FileNotFoundError(f"No saved classifier at {path}: fit and save one first.")
        return cls(LogisticRegressionModel.load(f"{path}/classifier"), StringIndexerModel.load(f"{path}/labels"))


def best_class(df: DataFrame, probabilities: str, labels) -> DataFrame:
    """Adds the label of the largest value (the first of equal ones) and the value as ``confidence``."""
    top = F.array_max(probabilities)
    place = (F.array_position(probabilities, top) - 1).cast("int")
    return df.withColumn("intent", F.get(labels, place)).withColumn("confidence", top)


def encode_labels(df: DataFrame, classes: Sequence[str], label: str = "intent") -> DataFrame:
    """Adds ``label_index``, the place of the label among the sorted classes."""
    model = StringIndexerModel.from_labels(sorted(classes), inputCol=label, outputCol="label_index",
                                           handleInvalid="error")
    return model.transform(df)


def decode_labels(df: DataFrame, classes: Sequence[str], output: str = "decoded") -> DataFrame:
    return IndexToString(inputCol="label_index", outputCol=output, labels=sorted(classes)).transform(df)


class SvmBaseline:
    """TF-IDF of words and word pairs, one linear SVM per class, with squared hinge loss and a penalised intercept.

    The vocabulary is that of ``term_stats``, ties by term, and a term weighs ln((1 + n) / (1 + df)) + 1, so a fit is
    the same every time.
    """

    def __init__(self, features: PipelineModel, model: SquaredHinge, labels: StringIndexerModel) -> None:
        self.features, self.model, self.labels = features, model, labels

    @staticmethod
    def _terms(df: DataFrame, text: str) -> DataFrame:
        return df.withColumn("_terms", terms(F.coalesce(F.col(text), F.lit(""))))

    def _sparse(self, rows: DataFrame) -> DataFrame:
        """Adds the entries of the vector, ``columns`` and ``cells``."""
        made = self.features.transform(rows).withColumn("_parts", F.unwrap_udt(_VECTOR))
        return made.withColumns({"columns": F.col("_parts.indices"), "cells": F.col("_parts.values")})

    @classmethod
    def fit(cls, df: DataFrame, text: str = "tweet", label: str = "intent", c: float = 1.0,
            vocabulary: int = 5000, max_steps: int = 100, tol: float = 1e-7, rows_per_block: int = ROWS_PER_BLOCK) -> "SvmBaseline":
        """``tol`` bounds the slope by row that is left; ``max_steps`` only guards against a fit that does not converge."""
        labels, n, _ = _label_table(df, label)
        # At most ``vocabulary`` rows come to the driver.
        known = term_stats(df.filter(F.col(label).isNotNull()), text, vocabulary).select("term", "df").collect()
        weights = [math.log((1 + n) / (1 + r["df"])) + 1 for r in known]
        features = PipelineModel(stages=[
            CountVectorizerModel.from_vocabulary([r["term"] for r in known], inputCol="_terms", outputCol="_counts"),
            ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol=_VECTOR, p=2.0),
        ])
        empty = cls(features, SquaredHinge(np.zeros((len(known) + 1, len(labels.labels))), 0, 0.0), labels)
        rows = empty._sparse(labels.transform(cls._terms(df, text))).select(
            F.col("_label").cast("int").alias("label"), "columns", "cells", F.xxhash64("_terms").alias("_order"))
        empty.model = SquaredHinge.fit(rows, len(known), len(labels.labels), c, tol, max_steps, rows_per_block)
        return empty

    def predict(self, df: DataFrame, text: str = "tweet", output: str = "intent") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.model)

        @arrow_udf("int")
        def best(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for columns, cells in batches:
                size = np.diff(columns.offsets.to_numpy())
                scores = shared.value.scores(size, columns.flatten().to_numpy(), cells.flatten().to_numpy()) if len(size) else []
                yield pa.array(np.argmax(scores, axis=1) if len(size) else [], pa.int32())

        scored = self._sparse(self._terms(df, text)).withColumn("_class", best("columns", "cells"))
        names = F.array(*[F.lit(n) for n in self.labels.labels])
        return scored.select(*[c for c in df.columns if c != output], F.get(names, F.col("_class")).alias(output))
