"""Classifiers over embeddings with Spark ML, their registry, and example augmentation."""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptloom.operators.positions import number_rows
from promptloom.storage import materialise

# Regularisation strength and iteration bound of the reference classifier.
C = 1.0
MAX_ITER = 500
MAX_BROADCAST_CLASSES = 100_000
MAX_BROADCAST_BYTES = 64 << 20


def small(classes: DataFrame) -> DataFrame:
    """A table with a row per class, broadcast when its rows and their bytes (as JSON text) show that it is small, so that rows of a dominant
    class need not meet in one task. A larger one joins by shuffle, where adaptive execution splits skew."""
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("b")).first()
    return F.broadcast(classes) if size["n"] <= MAX_BROADCAST_CLASSES and size["b"] <= MAX_BROADCAST_BYTES else classes


def class_registry(examples: DataFrame, class_name: str = "class_name", position: str = "position", **options) -> DataFrame:
    """(class_id, class_name): ids from 0 in order of first appearance."""
    # Stored because numbering reads it twice; it has a row per class.
    first = materialise(examples.groupBy(class_name).agg(F.min(position).alias("_first")), "classes")
    numbered = number_rows(first, ["_first", class_name], name="_n", **options)
    return numbered.select((F.col("_n") - 1).cast("int").alias("class_id"), F.col(class_name).alias("class_name"))


def few_shot(df: DataFrame, class_name: str, example_id: str, example: str, seed: int = 0, n: int = 2) -> DataFrame:
    """``n`` examples per class in a seeded order, as text. The window keeps n rows per class in every task
    before the shuffle, so a large class does not gather in one."""
    key = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(example_id).cast("string")))
    order = Window.partitionBy(class_name).orderBy("_k", example_id)
    picked = (
        df.select(class_name, example_id, F.col(example).alias("_x"), key.alias("_k"))
        .withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n)
    )
    listed = F.array_sort(F.collect_list(F.struct("_r", "_x")))
    return picked.groupBy(class_name).agg(F.array_join(F.transform(listed, lambda e: e["_x"]), "\n").alias("examples"))


@dataclass
class EmbeddingClassifier:
    """A fitted model and its registry (class_id, class_name[, metadata])."""

    model: LogisticRegressionModel
    registry: DataFrame

    @classmethod
    def fit(cls, rows: DataFrame, registry: DataFrame, vector: str = "embedding", class_name: str = "class_name"):
        """L2 logistic regression. ``regParam = 1 / (C n)`` gives the objective 0.5·|w|² + C·Σ loss."""
        known = registry.count()
        # The number of classes is the registry's, so that a class without rows keeps its place among the probabilities.
        nominal = {"ml_attr": {"type": "nominal", "num_vals": known, "name": "label"}}
        filled = rows.filter(F.col(vector).isNotNull()).join(small(registry), class_name)
        labelled = filled.select(
            array_to_vector(F.col(vector)).alias("features"), F.col("class_id").cast("double").alias("label", metadata=nominal))
        sizes = labelled.agg(F.count("*").alias("n"), F.count_distinct("label").alias("classes")).first()
        if sizes.classes < 2:
            raise ValueError(f"training needs at least two classes, got {sizes.classes}")
        if sizes.classes < known:
            empty = registry.join(filled.select("class_id").distinct(), "class_id", "left_anti").orderBy("class_id").limit(20)
            names = empty.agg(F.collect_list("class_name").alias("names")).first().names
            warnings.warn(f"classes without rows: {names}", stacklevel=2)
        estimator = LogisticRegression(
            regParam=1.0 / (C * sizes.n), elasticNetParam=0.0, standardization=False, maxIter=MAX_ITER, tol=1e-9,
            family="binomial" if known == 2 else "multinomial",
        )
        return cls(estimator.fit(labelled), registry)

    def probabilities(self, df: DataFrame, vector: str = "embedding", name: str = "probs") -> DataFrame:
        """Add the array of class probabilities, indexed by class id; null where the vector is."""
        zeros = F.array_repeat(F.lit(0.0), self.model.numFeatures)
        scored = self.model.transform(df.withColumn("features", array_to_vector(F.coalesce(F.col(vector).cast("array<double>"), zeros))))
        given = F.when(F.col(vector).isNotNull(), vector_to_array("probability"))
        return scored.withColumn(name, given).drop("features", "rawPrediction", "probability", "prediction")

    def long_probabilities(self, df: DataFrame, ids: Sequence[str], vector: str = "embedding") -> DataFrame:
        """One row per record and class: (ids, class_id, class_name, prob)."""
        probs = self.probabilities(df, vector).select(*ids, F.posexplode("probs").alias("class_id", "prob"))
        return probs.join(small(self.registry), "class_id").select(*ids, "class_id", "class_name", "prob")

    def predict(self, df: DataFrame, vector: str = "embedding") -> DataFrame:
        """Add ``class_id`` and ``class_name`` of the most probable class; the first wins a tie."""
        scored = self.probabilities(df, vector).withColumn("class_id", argmax("probs")).drop("probs")
        return scored.join(small(self.registry), "class_id", "left")

    def classify(self, df: DataFrame, row: str, vector: str = "embedding", top_n: int | None = None,
                 threshold: float | None = None, metadata: DataFrame | None = None) -> DataFrame:
        """Ranked classes of each record: (row, class_id, class_name, prob, rank[, metadata columns])."""
        ranked = top_classes(self.long_probabilities(df, [row], vector), row, top_n, threshold)
        return ranked if metadata is None else with_metadata(ranked, metadata)

    def binary(self, df: DataFrame, vector: str = "embedding", negative: str = "negative", positive: str = "positive") -> DataFrame:
        """Add ``p_negative``, ``p_positive`` and ``prediction`` (1 for positive) of a two-class model."""
        ids = self.registry.agg(*[F.max(F.when(F.col("class_name") == n, F.col("class_id"))).alias(n) for n in (negative, positive)]).first()
        if None in tuple(ids):
            raise ValueError(f"the registry lacks {negative!r} or {positive!r}")
        scored = self.probabilities(df, vector)
        for name, class_id in zip(("p_negative", "p_positive"), ids):
            scored = scored.withColumn(name, F.element_at("probs", int(class_id) + 1))
        return scored.drop("probs").withColumn("prediction", binary_prediction(F.col("p_negative"), F.col("p_positive")))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.registry.write.mode("overwrite").parquet(f"{path}/classes")

    @classmethod
    def load(cls, spark: SparkSession, path: str):
        return cls(LogisticRegressionModel.load(f"{path}/model"), spark.read.parquet(f"{path}/classes"))


def argmax(probs: str) -> Column:
    """Position of the greatest value, the first of several."""
    return (F.array_position(F.col(probs), F.array_max(probs)) - 1).cast("int")


def top_classes(probs: DataFrame, row: str, top_n: int | None = None, threshold: float | None = None,
                prob: str = "prob") -> DataFrame:
    """Classes of each row, best first (``rank``): at most ``top_n``, each with a probability strictly above the
    threshold; without either, all of them.

    ``probs`` has a row per record and class; a tie goes to the lower class id.
    """
    order = Window.partitionBy(row).orderBy(F.col(prob).desc(), "class_id")
    likely = probs if threshold is None else probs.filter(F.col(prob) > threshold)
    ranked = likely.withColumn("rank", F.row_number().over(order))
    return ranked if top_n is None else ranked.filter(F.col("rank") <= top_n)


def binary_prediction(negative: Column, positive: Column) -> Column:
    """1 only when the positive class is strictly more probable."""
    return F.when(positive > negative, 1).otherwise(0)


def with_metadata(predictions: DataFrame, metadata: DataFrame) -> DataFrame:
    """Attach class metadata by class id."""
    return predictions.join(small(metadata), "class_id", "left")


def examples_needed(examples: DataFrame, target: int, class_name: str = "class_name", classes: DataFrame | None = None) -> DataFrame:
    """(class_name, have, need): how many examples each class lacks; classes without any appear when
    ``classes`` lists them."""
    have = examples.groupBy(class_name).agg(F.count("*").alias("have"))
    if classes is not None:
        have = classes.select(class_name).distinct().join(have, class_name, "left").fillna(0, ["have"])
    return have.withColumn("need", F.greatest(F.lit(target) - F.col("have"), F.lit(0)).cast("long"))


Round = Callable[[DataFrame], DataFrame]


def augment_examples(examples: DataFrame, target: int, rounds: Sequence[Round], class_name: str = "class_name",
                     example: str = "example", classes: DataFrame | None = None) -> DataFrame:
    """Fill classes up to ``target`` with generated examples, new ones before the original ones. ``classes`` names those that may have none yet.

    ``rounds`` is a list, or a function of the round's number and the examples so far that is asked until no class lacks any. A round takes (class_name, need) of the classes that still lack examples and returns (class_name,
    example, sort_key). No class gets more than it needs; full classes are left alone.
    """
    current = examples.select(class_name, example).withColumn("is_new", F.lit(False))
    for turn in itertools.count() if callable(rounds) else range(len(rounds)):
        fill = rounds(turn, current) if callable(rounds) else rounds[turn]
        need = materialise(examples_needed(current, target, class_name, classes).filter("need > 0").select(class_name, "need"), "needs")
        if need.isEmpty():
            break
        made = materialise(fill(need), "examples")  # a round may call a model
        if callable(rounds) and made.join(need, class_name, "left_semi").isEmpty():
            raise ValueError(f"a round made no example although classes still lack some; target {target}")
        ranked = number_rows(made, ["sort_key", example], [class_name], "_r").filter(F.col("_r") <= target)
        kept = ranked.join(small(need), class_name).filter(F.col("_r") <= F.col("need"))
        current = materialise(kept.select(class_name, example, F.lit(True).alias("is_new")).unionByName(current), "examples")
    return current
