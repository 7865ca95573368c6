"""Training and scoring of the two menu-choice classifiers with ``pyspark.ml``."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mealmarts.operators.metrics import binary_metrics, share, to_class
from mealmarts.plans import factor_machine
from mealmarts.session import scratch_path

# Training settings of the factorization machine.
FM_PARAMS = {"factorSize": 8, "maxIter": 50, "stepSize": 0.01, "fitIntercept": True, "fitLinear": True, "solver": "gd"}
GBT_PARAMS = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "seed": 7}

GBT_FEATURES = (
    "gender_code", "user_age",
    *[f"{s}_{k}_{m}" for k in ("tag", "category") for m in ("overlap", "ratio") for s in ("A", "B")],
    *[f"{s}_avg_score_on_{k}" for k in ("tags", "categories") for s in ("A", "B")],
    "menu_regret", "pre_vote",
)


def sparse_vectors(rows: DataFrame, size: int) -> DataFrame:
    """``features`` entries as ML vectors.

    A sparse vector is stored as a struct of these four fields. Written like that and read back
    under the vector type, it never leaves the JVM.
    """
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.col("features.idx").cast("array<int>").alias("indices"),
        F.col("features.value").alias("values"),
    )
    path = scratch_path(rows.sparkSession, "vectors")
    rows.withColumn("features", stored).write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == "features" else f.dataType) for f in rows.schema]
    return rows.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def fit_sample(rows: DataFrame, limit: int, key: str = "review_id") -> DataFrame:
    """Repeatable choice of about ``limit`` rows for a trial fit; all of them if there are no more. No query fits on it."""
    total = rows.count()
    if total <= limit:
        return rows
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < int(1_000_000 * limit / total))


def _scored(model, rows: DataFrame, *keys: str) -> DataFrame:
    score = vector_to_array("probability")[1]
    scored = model.transform(rows).select(*keys, F.col("label").cast("int").alias("label"), score.alias("score"))
    return scored.withColumn("predicted", to_class("score"))


def fit_partitions(rows: DataFrame) -> DataFrame:
    """Rows in as many ranges of users as the cluster has cores.

    Every step of the descent passes over all rows, a partition per task; the files they come from are few, however
    many rows they hold. Ranges keep a user's rows together, so a task's gradient is zero outside its users and
    takes little room when sent. The review id behind the user parts a user with very many rows.
    """
    return rows.repartitionByRange(rows.sparkSession.sparkContext.defaultParallelism, "user_id", "review_id")


def packed_rows(rows: DataFrame, size: int) -> DataFrame:
    """Sparse rows as blocks of ranges of users, which both a fit and its scores read."""
    if "block" in rows.columns:
        return rows
    return factor_machine.packed(fit_partitions(sparse_vectors(rows, size)).sortWithinPartitions("user_id", "review_id"))


def train_fm(rows: DataFrame, size: int, **params) -> factor_machine.FactorModel:
    """A model of all rows, packed or not."""
    return factor_machine.fit(packed_rows(rows, size), size, **{**FM_PARAMS, "seed": 7, **params})


def predict_fm(model: factor_machine.FactorModel, rows: DataFrame, size: int) -> DataFrame:
    """Score and class per review id, of rows packed or not."""
    return factor_machine.scores(model, packed_rows(rows, size)).withColumn("predicted", to_class("score"))


def gbt_inputs(training_rows: DataFrame) -> DataFrame:
    """Numbers only; affinity without a shared value and unknown age become 0."""
    coded = training_rows.withColumn(
        "gender_code", F.when(F.col("user_gender") == "f", 1.0).when(F.col("user_gender") == "m", 0.0).otherwise(0.5)
    )
    return coded.fillna(0, list(GBT_FEATURES))


def in_holdout(fraction: float):
    """Repeatable choice of held-out rows by a hash of the row key."""
    bucket = F.pmod(F.xxhash64("user_id", "train_date", "menu_id"), F.lit(10_000))
    return bucket < F.lit(int(fraction * 10_000))


def train_gbt(training_rows: DataFrame, holdout: float = 0.0, **params) -> PipelineModel:
    rows = training_rows if holdout == 0 else training_rows.filter(~in_holdout(holdout))
    stages = [
        VectorAssembler(inputCols=list(GBT_FEATURES), outputCol="features"),
        GBTClassifier(**{**GBT_PARAMS, **params}),
    ]
    return Pipeline(stages=stages).fit(gbt_inputs(rows).withColumn("label", F.col("label").cast("double")))


def predict_gbt(model: PipelineModel, training_rows: DataFrame) -> DataFrame:
    """Score and class per user, date and menu."""
    return _scored(model, gbt_inputs(training_rows), "user_id", "train_date", "menu_id")


def gbt_metrics(predictions: DataFrame) -> DataFrame:
    return binary_metrics(predictions, "label", "predicted").select("accuracy", "precision", "recall", "f1_score")


def fm_metrics(predictions: DataFrame) -> DataFrame:
    """Error of the scores, and precision and recall of the classes at 0.5."""
    y, p = F.col("label"), F.col("predicted")
    sums = predictions.agg(
        F.sqrt(F.avg(F.pow(F.col("score") - y, 2))).alias("rmse"),
        F.count_if((y == 1) & (p == 1)).alias("hits"),
        F.count_if(p == 1).alias("called"),
        F.count_if(y == 1).alias("positive"),
    )
    hits = F.col("hits")
    return sums.select("rmse", share(hits, F.col("called")).alias("precision"), share(hits, F.col("positive")).alias("recall"))
