"""Training and scoring with ``pyspark.ml``: stacked forests and a sequence classifier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    PCA,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.functions import decode
from strideframe.operators.scoring import accuracy
from strideframe.operators.series import number_rows
from strideframe.operators.splitting import split_rows
from strideframe.schemas import WINDOW_KEYS, WINDOW_META_COLUMNS, feature_columns
from strideframe.sources.storage import table_exists


def fit_label_index(df: DataFrame, label: str = "activity_label", out: str = "label") -> StringIndexerModel:
    """Classes by frequency, then by name; an unseen label gets the index after the last."""
    return StringIndexer(inputCol=label, outputCol=out, handleInvalid="keep").fit(df)


def label_index_table(df: DataFrame, label: str = "activity_label", out: str = "label") -> DataFrame:
    """The same index as a DataFrame: (label, index), numbered where the counts are. Rows
    without a label have no index."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg((-F.count(F.lit(1))).alias("_less"))
    placed = number_rows(counts, [], ["_less", label], "_place", hot=None)  # one row for each class
    return placed.select(label, F.col("_place").cast("double").alias(out))


def with_label_index(df: DataFrame, index: DataFrame, label: str = "activity_label", out: str = "label") -> DataFrame:
    """``df`` with the class index of each row; null where the index lacks the label."""
    return df.join(index.select(label, out), label, "left").select(*df.columns, out)


def vector_stages(feature_cols: Sequence[str], prefix: str) -> list:
    """Assemble (rows with a null or NaN are skipped) and standardize."""
    return [
        VectorAssembler(inputCols=list(feature_cols), outputCol=f"{prefix}_raw", handleInvalid="skip"),
        StandardScaler(inputCol=f"{prefix}_raw", outputCol=f"{prefix}_scaled", withMean=True, withStd=True),
    ]


def build_base_pipeline(
    feature_cols: Sequence[str],
    indexer: StringIndexerModel | StringIndexer,
    prefix: str,
    trees: int = 100,
    seed: int = 42,
) -> Pipeline:
    forest = RandomForestClassifier(
        featuresCol=f"{prefix}_scaled", labelCol="label", numTrees=trees, seed=seed
    )
    return Pipeline(stages=[indexer, *vector_stages(feature_cols, prefix), forest])


def split_tree(
    df: DataFrame, feature_cols: Sequence[str], label: str = "label", depth: int = 1, bins: int = 32, forest: bool = False, seed: int = 42
) -> PipelineModel:
    """A single tree: by itself, or as a forest of one that sees all rows and all features.

    Splits fall between values; with at most ``bins`` distinct values in a column every
    cut between two of them is tried.
    """
    how = {"featuresCol": "split_features", "labelCol": label, "maxDepth": depth, "maxBins": bins, "seed": seed}
    if forest:
        tree = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", **how)
    else:
        tree = DecisionTreeClassifier(**how)
    features = VectorAssembler(inputCols=list(feature_cols), outputCol="split_features", handleInvalid="skip")
    return Pipeline(stages=[features, tree]).fit(df)


def _meta_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=["from_watch", "from_phone"], outputCol="both_devices")


@dataclass(frozen=True)
class StackedModel:
    """Two base models and the tree that judges by their probabilities."""

    watch: PipelineModel
    phone: PipelineModel
    meta: DecisionTreeClassificationModel
    on: tuple[str, ...] = WINDOW_KEYS

    def base_probabilities(self, watch: DataFrame, phone: DataFrame) -> DataFrame:
        """One row per window that both devices have: label and both probability vectors."""
        return _base_probabilities(self.watch, self.phone, watch, phone, self.on)

    def transform(self, watch: DataFrame, phone: DataFrame) -> DataFrame:
        """Score windows; adds prediction, probability and the decoded activity."""
        scored = self.meta.transform(_meta_assembler().transform(self.base_probabilities(watch, phone)))
        names = dict(enumerate(self.labels))
        return scored.withColumn(
            "activity", decode(F.col("label").cast("int"), names)
        ).withColumn("predicted_activity", decode(F.col("prediction").cast("int"), names))

    @property
    def labels(self) -> list[str]:
        return self.watch.stages[0].labels

    def save(self, path: str) -> None:
        for name in ("watch", "phone", "meta"):
            getattr(self, name).write().overwrite().save(f"{path.rstrip('/')}/{name}")

    @classmethod
    def load(cls, path: str, on: Sequence[str] = WINDOW_KEYS) -> StackedModel:
        return cls(
            PipelineModel.load(f"{path.rstrip('/')}/watch"),
            PipelineModel.load(f"{path.rstrip('/')}/phone"),
            DecisionTreeClassificationModel.load(f"{path.rstrip('/')}/meta"),
            tuple(on),
        )


def _base_probabilities(watch_model, phone_model, watch, phone, on) -> DataFrame:
    left = watch_model.transform(watch).select(*on, "label", F.col("probability").alias("from_watch"))
    right = phone_model.transform(phone).select(*on, F.col("probability").alias("from_phone"))
    return left.join(right, list(on), "inner")


def stack_fit(
    watch: DataFrame,
    phone: DataFrame,
    split: DataFrame,
    on: Sequence[str] = WINDOW_KEYS,
    subject: str = "subject_id",
    label: str = "activity_label",
    meta_columns: frozenset[str] = WINDOW_META_COLUMNS,
    trees: int = 100,
    seed: int = 42,
) -> StackedModel:
    """Fit a forest per device on the training subjects and the judging tree on
    the validation subjects. Both devices share one label index.

    Training passes over its input many times: give written tables.
    """
    indexer = fit_label_index(split_rows(watch, split, "train", subject), label)

    def fit_base(df: DataFrame, prefix: str) -> PipelineModel:
        # what memory does not hold is read again from the written table, not kept on disk once more
        train = split_rows(df, split, "train", subject).persist(StorageLevel.MEMORY_ONLY)
        try:
            cols = feature_columns(df, meta_columns)
            return build_base_pipeline(cols, indexer, prefix, trees, seed).fit(train)
        finally:
            train.unpersist()

    # The two forests do not depend on each other; their jobs share the cluster.
    with ThreadPool(2) as pool:
        watch_model, phone_model = pool.map(
            inheritable_thread_target(watch.sparkSession)(lambda job: fit_base(*job)),
            [(watch, "watch"), (phone, "phone")],
        )
    validation = _base_probabilities(
        watch_model,
        phone_model,
        split_rows(watch, split, "val", subject),
        split_rows(phone, split, "val", subject),
        on,
    )
    meta = DecisionTreeClassifier(featuresCol="both_devices", labelCol="label", seed=seed)
    return StackedModel(watch_model, phone_model, meta.fit(_meta_assembler().transform(validation)), tuple(on))


def feature_importance(model: PipelineModel, names: Sequence[str], k: int | None = None) -> DataFrame:
    """The features of a fitted base model, most important first; the first ``k`` if given."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    ordered = table.orderBy(F.desc("importance"), F.asc("feature"))
    return ordered if k is None else ordered.limit(k)


def channel_vectors(df: DataFrame, channels: str = "channels", out: str = "raw") -> DataFrame:
    """Channel arrays as one flat ML vector. Windows with an empty cell are left
    out, as a missing value has no place in the network's input."""
    flat = F.flatten(F.col(channels))
    whole = ~F.exists(flat, lambda v: v.isNull() | F.isnan(v))
    return df.where(whole).withColumn(out, array_to_vector(flat.cast("array<double>")))


@dataclass(frozen=True)
class SequenceCandidate:
    """One network to try: principal components, hidden layers, iterations."""

    components: int = 40
    hidden: tuple[int, ...] = (64,)
    iterations: int = 100


_HISTORY = "tried int, components int, hidden array<int>, iterations int, accuracy double, chosen boolean"


@dataclass(frozen=True)
class SequenceModel:
    model: PipelineModel
    candidate: SequenceCandidate
    validation_accuracy: float
    history: list[tuple[SequenceCandidate, float]] = field(default_factory=list)

    def transform(self, df: DataFrame, channels: str = "channels") -> DataFrame:
        return self.model.transform(channel_vectors(df, channels))

    def save(self, path: str) -> None:
        """The model at ``path``, and beside it the table of all candidates and their scores."""
        self.model.write().overwrite().save(path)
        rows = [(i, c.components, list(c.hidden), c.iterations, score, c == self.candidate) for i, (c, score) in enumerate(self.history)]
        SparkSession.active().createDataFrame(rows, _HISTORY).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}-history")

    @classmethod
    def load(cls, path: str) -> SequenceModel:
        """A saved model with its candidate and its validation history, if one lies beside it."""
        spark, model, beside = SparkSession.active(), PipelineModel.load(path), f"{path.rstrip('/')}-history"
        layers = model.stages[-1].getLayers()
        candidate = SequenceCandidate(layers[0], tuple(layers[1:-1]), model.stages[-1].getMaxIter())
        if not table_exists(spark, beside):
            return cls(model, candidate, float("nan"))
        rows = spark.read.schema(_HISTORY).parquet(beside).orderBy("tried").collect()  # one row for each candidate
        history = [(SequenceCandidate(r["components"], tuple(r["hidden"]), r["iterations"]), r["accuracy"]) for r in rows]
        chosen = next(h for h, r in zip(history, rows, strict=True) if r["chosen"])
        return cls(model, *chosen, history)


def sequence_fit(
    train: DataFrame,
    val: DataFrame,
    n_classes: int,
    candidates: Sequence[SequenceCandidate] = (SequenceCandidate(),),
    channels: str = "channels",
    label: str = "label",
    seed: int = 42,
    save_to: str | None = None,
) -> SequenceModel:
    """Train every candidate on raw windows, keep the best on the validation rows.

    The best model so far is saved to ``save_to`` as soon as it is found, with the history
    of all candidates so far.
    """
    train = channel_vectors(train, channels).select("raw", label).persist()
    val = channel_vectors(val, channels).select("raw", label).persist()
    try:
        most = max(c.components for c in candidates)
        scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
        shared = Pipeline(stages=[scaler, PCA(k=most, inputCol="scaled", outputCol="all_components")]).fit(train)
        seen = shared.transform(train).select("all_components", label).persist()
        best, history = None, []
        for c in candidates:
            network = [
                VectorSlicer(inputCol="all_components", outputCol="components", indices=list(range(c.components))),
                MultilayerPerceptronClassifier(
                    featuresCol="components",
                    labelCol=label,
                    layers=[c.components, *c.hidden, n_classes],
                    maxIter=c.iterations,
                    seed=seed,
                ),
            ]
            model = PipelineModel([*shared.stages, *Pipeline(stages=network).fit(seen).stages])
            score = accuracy(model.transform(val), label).first()["accuracy"] or 0.0
            history.append((c, score))
            if best is None or score > best[2]:
                best = (model, c, score)
            if save_to:
                SequenceModel(*best, history).save(save_to)
        seen.unpersist()
        return SequenceModel(*best, history)
    finally:
        train.unpersist()
        val.unpersist()
