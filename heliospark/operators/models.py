"""Distributed model operators (M1-M6) on Spark ML.

Training runs on executors (``GBTRegressor`` builds trees from distributed
histograms); the driver only holds the fitted trees. Boosted trees here are
Spark's gradient-boosted trees, not a second-order booster: quality is
compared by tolerance, not equality.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import BoostedTreeParams
from ..session import ensure_checkpoint_dir, kept
from . import analytics as A
from .global_order import with_global_index


def chronological_split(df: DataFrame, order_cols: list[str], train_fraction: float = 0.8) -> DataFrame:
    """M1: the first int(fraction * n) rows in global order are ``train``.

    The global row index comes from range partitions (no single-partition
    window); ties in the order key are broken by the remaining key columns.
    """
    # The range bounds are sampled from the rows before they are written.
    with kept(df):
        indexed = with_global_index(df, order_cols, "row_index")
    cut = F.floor(F.col("_total") * F.lit(train_fraction)).cast("bigint")
    return indexed.select(
        *df.columns,
        F.col("row_index").cast("bigint").alias("row_index"),
        F.when(F.col("row_index") < cut, F.lit("train")).otherwise(F.lit("test")).alias("split"),
    )


def boosted_tree_estimator(features: list[str], label: str, params: BoostedTreeParams) -> Pipeline:
    """M2: assembler + gradient-boosted regression trees."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    gbt = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        stepSize=params.step_size,
        maxDepth=params.max_depth,
        maxIter=params.max_iter,
        subsamplingRate=params.subsampling_rate,
        featureSubsetStrategy=params.feature_subset_strategy,
        seed=params.seed,
    )
    return Pipeline(stages=[assembler, gbt])


def score(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """M3: holdout predictions with a residual column."""
    out = model.transform(df).drop("features")
    return out.withColumn("residual", F.col(label) - F.col("prediction"))


def feature_importances(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """M4: impurity-based importances (normalised to sum 1) zipped to names."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, [float(v) for v in imp])), "feature string, importance double")


TRAIN_TASK_ROWS = 20_000  # of a task in a fit; fewer rows share one
TRAIN_TASKS = 24  # of a fit; with more rows tasks grow instead
LARGEST_TRAIN_TASK_ROWS = 400_000  # that a task keeps in memory


def training_tasks(rows: int) -> int:
    """Tasks of a fit over ``rows``. Each of its hundreds of passes starts all
    tasks, and each task ships the histograms of every node of the level
    whatever its rows, so their number must not follow the rows for long."""
    size = min(max(TRAIN_TASK_ROWS, -(-rows // TRAIN_TASKS)), LARGEST_TRAIN_TASK_ROWS)
    return max(1, -(-rows // size))


def train_targets(df: DataFrame, features: list[str], labels: dict[str, str], params: BoostedTreeParams) -> dict[str, PipelineModel]:
    """M2 for several targets on one frame with a ``split`` column.

    The features are assembled once and kept for all fits, which run side by
    side: a boosted tree is a chain of short jobs that leave a cluster idle
    between them, and chains of different targets fill each other's gaps.
    (Spark bins the features once per fit and cuts the lineage of the running
    prediction every ``checkpointInterval`` trees in the shared folder.) Tasks
    are sized by rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    # Rows stay in memory or on disk for all fits.
    rows = df.filter(F.col("split") == "train")
    train = assembler.transform(rows).select("features", *labels.values())
    # A fit runs over a thousand short jobs, so a task without enough rows costs
    # more to start than it works, each time.
    train = train.coalesce(training_tasks(rows.count())).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(label: str) -> PipelineModel:
        gbt = boosted_tree_estimator(features, label, params).getStages()[-1]
        return PipelineModel([assembler, gbt.fit(train.filter(F.col(label).isNotNull()))])

    with ThreadPoolExecutor(len(labels)) as pool:
        fits = [pool.submit(inheritable_thread_target(df.sparkSession)(fit), label) for label in labels.values()]
        models = {target: f.result() for target, f in zip(labels, fits, strict=True)}
    train.unpersist()
    return models


def evaluate(model: PipelineModel, split: DataFrame, label: str, model_name: str) -> tuple[DataFrame, DataFrame]:
    """M3 and A22 on the test rows: (scored rows, metrics with the number of train rows)."""
    rows = split.filter(F.col(label).isNotNull())
    scored = score(model, rows.filter(F.col("split") == "test"), label)
    named = scored.select(F.lit(model_name).alias("model_name"), F.col(label).alias("actual"), F.col("prediction").alias("predicted"))
    n_train = rows.filter(F.col("split") == "train").count()
    return scored, A.regression_metrics(named, ["model_name"]).withColumn("n_train", F.lit(n_train).cast("bigint"))


def train_and_evaluate(
    df: DataFrame, features: list[str], label: str, params: BoostedTreeParams, model_name: str
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """M6 for one target: M1 -> M2 -> M3 -> A22. Returns (model, scored test, metrics)."""
    model = train_targets(df, features, {label: label}, params)[label]
    return model, *evaluate(model, df, label, model_name)


def promotion_gate(candidates: DataFrame, champion: DataFrame) -> DataFrame:
    """M5 keyed by target: lowest-RMSE candidate vs. the recorded champion;
    promote when there is no champion or the RMSE is strictly lower.

    Both inputs are metric registries (one row per model and target).
    """
    w = Window.partitionBy("target").orderBy(F.col("rmse").asc(), F.col("model_name").asc())
    best = (
        candidates.select("target", "model_name", "rmse", F.row_number().over(w).alias("_rn"))
        .filter(F.col("_rn") == 1)
        .select("target", F.col("model_name").alias("candidate_model"), F.col("rmse").alias("candidate_rmse"))
    )
    champ = champion.select(
        "target", F.col("model_name").alias("champion_model"), F.col("rmse").alias("champion_rmse")
    )
    out = best.join(champ, "target", "left")
    return out.withColumn(
        "promote", F.col("champion_rmse").isNull() | (F.col("candidate_rmse") < F.col("champion_rmse"))
    )
